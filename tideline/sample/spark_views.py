"""The sample views as DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed_values as fv
from ..session import configure
from .rules import SPARK, TILES, view_columns

_VIEWS = view_columns(SPARK)


class Views:
    """Views over the tables of one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = configure(spark)
        self.sf_dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def plain(self, view: str) -> DataFrame:
        table, columns = _VIEWS[view]
        return self.table(table).selectExpr(*[f"{expression} AS `{name}`" for name, expression in columns.items()])

    def legacy_pings(self) -> DataFrame:
        tile = (
            "named_struct('id', CASE WHEN week_user THEN CAST({i} AS BIGINT) ELSE (event_id * 7 + {i} * 13) % {n} END, "
            "'pos', CASE WHEN week_user THEN {i} WHEN event_id % 6 = 0 THEN NULL "
            "ELSE CAST((event_id + {i} * 5) % 21 AS INT) END)"
        )
        tiles = ", ".join(tile.format(i=i, n=TILES) for i in range(3))
        array = f"CASE tile_count WHEN 3 THEN array({tiles}) WHEN 0 THEN slice(array({tiles}), 1, 0) END"
        return self.plain("legacy_pings").withColumn("tiles", F.expr(array)).drop("tile_count", "week_user")

    def spoc_tiles(self) -> DataFrame:
        return self.plain("spoc_tiles")

    def nested_pings(self) -> DataFrame:
        def event(j: int) -> str:
            entry = "named_struct('key', '{key}', 'value', {value})"
            identified = "event_id % 11 <> 0"
            entries = [
                f"CASE WHEN {identified} AND (event_id + {j}) % 3 <> 2 THEN "
                + entry.format(key="recommendation_id", value="CAST(event_id - event_id % 4 AS STRING)")
                + " END",
                f"CASE WHEN {identified} THEN "
                + entry.format(key="tile_id", value=f"CAST((event_id * 7 + {j} * 13) % {TILES} AS STRING)")
                + " END",
                entry.format(
                    key="position",
                    value=f"CASE WHEN event_id % 37 = 0 THEN 'x' ELSE CAST((event_id + {j} * 5) % 21 AS STRING) END",
                ),
                entry.format(
                    key="is_sponsored",
                    value="CASE event_id % 4 WHEN 0 THEN 'true' WHEN 1 THEN 'maybe' ELSE 'false' END",
                ),
            ]
            name = "first_name" if j == 0 else "'impression'"
            extra = f"array_compact(array({', '.join(entries)}))"
            return f"named_struct('category', category, 'name', {name}, 'extra', {extra})"

        return self.plain("nested_pings").select(
            "event_id",
            "document_id",
            "submission_timestamp",
            "normalized_country_code",
            "normalized_channel",
            "app_build",
            F.struct(
                F.struct("newtab_locale").alias("string"),
                F.struct(
                    F.col("section_on").alias(fv.NESTED_SECTION_FLAG),
                    F.col("sponsored_on").alias(fv.NESTED_SPONSORED_FLAG),
                ).alias("boolean"),
            ).alias("metrics"),
            F.struct("client_id", "app_display_version").alias("client_info"),
            F.expr(f"array({event(0)}, {event(1)})").alias("events"),
        )

    def approved(self) -> DataFrame:
        return self.plain("approved_items")

    def scheduled(self) -> DataFrame:
        return self.plain("scheduled_once").unionByName(self.plain("scheduled_again"))

    def topics(self) -> DataFrame:
        """One row per topic of the approved items, with made-up set ids."""
        topics = self.approved().select(F.col("topic").alias("corpus_topic_id")).distinct()
        return topics.select(
            "corpus_topic_id",
            F.concat(F.lit("en-"), F.lower("corpus_topic_id")).alias("curated_catalog_candidate_set_id"),
            F.concat(F.lit("de-"), F.lower("corpus_topic_id")).alias("german_curated_catalog_candidate_set_id"),
            F.concat(F.lit("legacy-"), F.lower("corpus_topic_id")).alias("legacy_curated_catalog_candidate_set_id"),
        )

    def deleted_users(self) -> DataFrame:
        listed = self.plain("account_deletions").filter("is_deletion")
        return listed.select("hashed_user_id", "user_id")

    def known_users(self) -> DataFrame:
        return self.plain("known_users").filter("is_known").select("hashed_user_id", "user_id")

    def known_emails(self) -> DataFrame:
        return self.plain("email_map").filter("is_known").select("email")

    def score_groups(self) -> DataFrame:
        """Counters per (supplier, part); even parts get ids above the small-id limit."""
        big = f"CASE WHEN l_partkey % 2 = 0 THEN l_partkey + {fv.SCORE_MAX_SMALL_ID} ELSE l_partkey END"
        return (
            self.table("lineitem")
            .groupBy(F.col("l_suppkey").alias("publisher_id"), F.expr(big).alias("content_id"))
            .agg(
                F.sum(F.col("l_quantity").cast("bigint")).alias("quantity"),
                F.count(F.lit(1)).alias("lines"),
            )
        )

    def score_queue(self) -> DataFrame:
        return self.score_groups().select("publisher_id", "content_id")

    def lifetime(self) -> DataFrame:
        """Counters; some groups have none, some have zeros only, some a null."""
        counted = self.score_groups().filter("(publisher_id + content_id) % 10 <> 0")
        zero = "(publisher_id + content_id) % 10 = 1"
        return counted.selectExpr(
            "publisher_id",
            "content_id",
            f"CASE WHEN {zero} THEN 0 ELSE quantity END AS save_cnt",
            f"CASE WHEN {zero} THEN 0 ELSE lines * 7 END AS open_cnt",
            f"CASE WHEN {zero} THEN 0 WHEN (publisher_id + content_id) % 10 = 2 THEN NULL ELSE lines END AS favorite_cnt",
            f"CASE WHEN {zero} THEN 0 ELSE lines + quantity % 5 END AS share_cnt",
        )
