"""Removal of deleted accounts from a set of tables."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.tables import joinable, new_keys, purge_flagged
from ..session import materialized

PAYLOAD = "event"


def new_deleted_users(deletions: DataFrame, known_users: DataFrame, null_safe: bool = False) -> DataFrame:
    """Deleted accounts not yet listed. A pair with a null id is found again each time."""
    return new_keys(deletions, known_users, ["hashed_user_id", "user_id"], null_safe)


def new_deleted_emails(email_map: DataFrame, deleted_users: DataFrame, known_emails: DataFrame) -> DataFrame:
    """Addresses of deleted users not yet listed."""
    ids = deleted_users.select("user_id")
    of_deleted = email_map.join(ids, "user_id", "left_semi")
    return new_keys(of_deleted, known_emails, ["email"])


@dataclass(frozen=True)
class Rule:
    """How rows of one kind of table name an account.

    ``keys`` lists (where, kind): a column, or a JSON path that starts with ``$`` inside
    the column ``payload``; an array's first object is ``$[0]``. A row goes if one of its
    keys is a deleted one of that kind: a key list's name, as ``user_id`` or ``email``.
    With ``only_if``, a (path, value) pair, other rows stay.
    """

    keys: tuple[tuple[str, str], ...]
    payload: str = PAYLOAD
    only_if: tuple[str, object] | None = None

    def _value(self, where: str) -> Column:
        return F.get_json_object(F.col(self.payload), where) if where.startswith("$") else F.col(where).cast("string")

    def columns(self) -> list[tuple[str, Column]]:
        """(kind, key as text) of each key; null where the rule does not hold for the row."""
        found = []
        for where, kind in self.keys:
            key = self._value(where)
            if self.only_if is not None:
                path, value = self.only_if
                key = F.when(self._value(path) == F.lit(str(value)), key)
            found.append((kind, key))
        return found


def account_keys(deleted_users: DataFrame, deleted_emails: DataFrame) -> DataFrame:
    """All deleted keys as rows (``kind``, ``key``), each once."""
    kinds = {"user_id": deleted_users, "hashed_user_id": deleted_users, "email": deleted_emails}
    lists = [
        held.filter(F.col(kind).isNotNull()).select(F.lit(kind).alias("kind"), F.col(kind).cast("string").alias("key"))
        for kind, held in kinds.items()
    ]
    return reduce(DataFrame.unionByName, lists).distinct()


def present_keys(table: DataFrame, rule: Rule, keys: DataFrame) -> DataFrame:
    """The deleted keys that rows of the table name.

    Only the columns of the keys are read, and each key leaves a map task once, so the
    rows stay where they are however many keys have been deleted over the years.
    """
    named = [F.struct(F.lit(kind).alias("kind"), key.alias("key")) for kind, key in rule.columns()]
    found = table.select(F.inline(F.array(*named))).filter("key IS NOT NULL").distinct()
    return keys.join(found, ["kind", "key"], "left_semi")


def purge_table(table: DataFrame, rule: Rule, keys: DataFrame) -> DataFrame:
    """A table without the rows that name a deleted account; ``keys`` as from :func:`account_keys`.

    The table meets only the keys it names: few, so that Spark broadcasts them and the
    rows are filtered in one pass without a shuffle; where they are many, each key of the
    rule is one anti-join. Null keys match nothing.
    """
    found = materialized(present_keys(table, rule, keys), "purge-keys")
    names = [F.col(f"`{c}`") for c in table.columns]
    for kind, key in rule.columns():
        doomed = found.filter(F.col("kind") == kind).select(F.col("key").alias("_purge_key"))
        table = table.withColumn("_purge_key", joinable(key)).join(doomed, "_purge_key", "left_anti").select(*names)
    return table


def purge_deleted_accounts(
    tables: Mapping[str, DataFrame],
    rules: Mapping[str, Rule],
    flagged: Mapping[str, str],
    account_deletions: DataFrame,
    email_map: DataFrame,
    known_users: DataFrame,
    known_emails: DataFrame,
) -> dict[str, DataFrame]:
    """New states of the given tables and of the two key lists.

    First the lists of deleted users and addresses grow, then every table with a rule is
    purged, then tables in ``flagged`` lose the rows whose named column is true. Tables
    without a rule are not in the result; a rule without its table fails.
    """
    missing = sorted((set(rules) | set(flagged)) - set(tables))
    if missing:
        raise KeyError(f"no table for the rules of {missing}")
    columns = ["hashed_user_id", "user_id"]
    users = known_users.select(*columns).unionByName(new_deleted_users(account_deletions, known_users))
    emails = known_emails.select("email").unionByName(new_deleted_emails(email_map, users, known_emails))
    # The lists are read by every rule: computed once.
    users, emails = materialized(users, "deleted-users"), materialized(emails, "deleted-emails")
    keys = materialized(account_keys(users, emails), "account-keys")
    result = {"deleted_users": users, "deleted_emails": emails}
    for name, rule in rules.items():
        result[name] = purge_table(tables[name], rule, keys)
    for name, flag in flagged.items():
        result[name] = purge_flagged(tables[name], flag)
    return result
