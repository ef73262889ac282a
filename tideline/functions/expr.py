"""Column expressions shared by the jobs. All are built-in and stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed_values as fv


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def feed_name(country, locale) -> Column:
    """Feed of a (country, locale) pair; null for pairs that have none."""
    country, locale = _col(country), _col(locale)
    result = F
    for feed, countries, locales in fv.FEEDS:
        result = result.when(country.isin(countries) & locale.isin(locales), feed)
    return result


def major_version(version) -> Column:
    """Number before the first dot; null where it is no number."""
    return F.split_part(_col(version), F.lit("."), F.lit(1)).try_cast("bigint")


def starts_with_digit_1_to_9(text) -> Column:
    return _col(text).rlike("^[1-9]")


def flag_on(flags, bit: int) -> Column:
    return _col(flags).bitwiseAND(F.lit(bit)) == F.lit(bit)


def safe_boolean(text) -> Column:
    """'true' / 'false' in any case; null otherwise."""
    lowered = F.lower(_col(text))
    return F.when(lowered == "true", F.lit(True)).when(lowered == "false", F.lit(False))


def map_get(pairs, key: str) -> Column:
    """Value of the first entry with ``key`` in an array of (key, value) structs."""
    return F.get(F.filter(_col(pairs), lambda entry: entry["key"] == key), F.lit(0))["value"]


def iso8601(ts) -> Column:
    return F.date_format(_col(ts), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def parse_iso8601(text) -> Column:
    """Timestamp of an ISO-8601 text with optional fraction; null for null, any other text fails the job."""
    text = _col(text)
    shape = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d{1,6})?(Z|[+-]\d{2}:\d{2})$"
    moment = F.when(text.rlike(shape), text.try_cast("timestamp"))
    wrong = F.raise_error(F.concat(F.lit("not an ISO-8601 time: "), text)).cast("timestamp")
    return F.when(text.isNotNull(), F.coalesce(moment, wrong))


def empty_to_null(text) -> Column:
    return F.nullif(_col(text), F.lit(""))


def mask_email(email) -> Column:
    """Local part kept, domain replaced; null for null and empty addresses."""
    email = _col(email)
    return F.when(
        email.isNotNull() & (email != ""),
        F.concat(F.split_part(email, F.lit("@"), F.lit(1)), F.lit(fv.MASKED_DOMAIN)),
    )


def valid_email(email) -> Column:
    return _col(email).rlike(fv.EMAIL_PATTERN)


def like_any(text, patterns: list[str]) -> Column:
    """True where one of the LIKE patterns matches ('_' and '%' are wildcards)."""
    result = F.lit(False)
    for pattern in patterns:
        result = result | _col(text).like(pattern)
    return result


def slash_key(*parts) -> Column:
    """Parts joined by '/'; null as soon as one part is null."""
    pieces = []
    for part in parts:
        pieces += [F.lit("/"), _col(part).cast("string")]
    return F.concat(*pieces[1:])


def zoned_to_utc(ts, zone: str) -> Column:
    """Wall-clock time of ``zone`` to UTC."""
    return F.to_utc_timestamp(_col(ts), zone)


def as_timestamp(value) -> Column:
    """A literal for a string, date or datetime; a Column passes through."""
    return value if isinstance(value, Column) else F.lit(value).cast("timestamp")


def days_before(ts, days: int) -> Column:
    return as_timestamp(ts) - F.expr(f"INTERVAL {int(days)} DAYS")


def day_of(ts) -> Column:
    return F.to_date(as_timestamp(ts))


def python_str(column, data_type: str) -> Column:
    """Text of a value as Python's ``str`` prints it: 'None', 'nan', 'True'."""
    column = _col(column)
    if data_type == "boolean":
        text = F.initcap(column.cast("string"))
    elif data_type in ("double", "float"):
        number = column.cast("double")
        # Python prints plain decimals from 1e-4 up to 1e16, Spark only from 1e-3 up to 1e7.
        text = (
            F.when(F.isnan(number), F.lit("nan"))
            .when(number == float("inf"), F.lit("inf"))
            .when(number == float("-inf"), F.lit("-inf"))
            .when(number == 0, number.cast("string"))
            .when(
                (F.abs(number) >= 1e-4) & (F.abs(number) < 1e16),
                _plain_decimal(number),
            )
            .otherwise(_python_exponent(number))
        )
    else:
        text = column.cast("string")
    return F.coalesce(text, F.lit("None"))


def _plain_decimal(number: Column) -> Column:
    """Shortest decimal of a double without exponent, with at least one decimal place."""
    shortest = number.cast("string")
    digits = F.rtrim(shortest.cast("decimal(38,20)").cast("string"), F.lit("0"))
    padded = F.when(digits.endswith("."), F.concat(digits, F.lit("0"))).otherwise(digits)
    return F.when(shortest.contains("E"), padded).otherwise(shortest)


def _python_exponent(number: Column) -> Column:
    """'1.0E-5' -> '1e-05', '1.5E16' -> '1.5e+16'."""
    text = number.cast("string")
    mantissa = F.regexp_replace(F.split_part(text, F.lit("E"), F.lit(1)), r"\.0$", "")
    exponent = F.split_part(text, F.lit("E"), F.lit(2)).try_cast("int")
    sign = F.when(exponent < 0, F.lit("-")).otherwise(F.lit("+"))
    filler = F.when(F.abs(exponent) < 10, F.lit("0")).otherwise(F.lit(""))
    return F.concat(mantissa, F.lit("e"), sign, filler, F.abs(exponent).cast("string"))
