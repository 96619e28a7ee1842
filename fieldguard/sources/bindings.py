"""The driver tables bound as report collections.

* ``order_reports``     one report per order; nested metrics, metadata section
* ``event_reports``     one report per event; ``props`` is JSON of its own
* ``document_reports``  one report per document; labels are often absent
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FLAGS = ("A", "N", "R")
LEAVES = ("fps", "loss")
METRIC = ".<report>.[<ruleCode>=<line_stats>].<rawDataMetric>.[<name>=<{flag}>].<rawData>.<{leaf}>"
METADATA = (
    ".<report>.[<ruleCode>=<metadata_raw>].<rawDataMetric>.[<name>=<metadata.json>]"
    ".<rawData>.<{leaf}>"
)
NUMERIC_FIELDS = tuple(METRIC.format(flag=f, leaf=x) for x in LEAVES for f in FLAGS)
TEXT_FIELDS = (METADATA.format(leaf="sn"), METADATA.format(leaf="status"))
ORDER_FIELDS = NUMERIC_FIELDS + TEXT_FIELDS
EVENT_FIELDS = (".<value>", ".<props>.<k>")
DOCUMENT_FIELDS = (".<n_chars>", ".<labels>.<quality>", ".<labels>.<toxic>")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, key: str) -> DataFrame:
    """Hash the rows over the cores before document work: a small file is a single split."""
    return df.repartition(F.col(key))


def order_episodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys and attributes of the orders as episodes, without documents."""
    return _orders(spark, sf_dir).drop("_key")


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The episodes with their order's number as ``_key``: numbers are cheaper to move and compare than texts."""
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    return (
        table(spark, sf_dir, "orders")
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("c_mktsegment").alias("model"),
            F.concat(F.lit("c"), F.col("o_custkey")).alias("taskid"),
            F.col("o_orderkey").cast("string").alias("episode_id"),
            F.col("r_name").alias("area"),
            F.col("n_name").alias("sn"),
            F.date_format("o_orderdate", "yyyy-MM-dd").alias("collected_at"),
            F.col("o_orderstatus").alias("status"),
            F.col("o_orderkey").alias("_key"),
        )
    )


def order_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """model, taskid, episode_id, area, sn, collected_at, filename, path, raw."""
    def largest(column: str, flag: str) -> Column:
        return F.max(F.when(F.col("l_returnflag") == flag, F.col(column)))

    metrics = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("_order"))
        .agg(
            *[largest("l_quantity", f).alias(f"fps_{f}") for f in FLAGS],
            *[largest("l_discount", f).alias(f"loss_{f}") for f in FLAGS],
        )
    )
    entries = F.array_compact(
        F.array(
            *[
                F.when(
                    F.col(f"fps_{f}").isNotNull(),
                    F.struct(
                        F.lit(f).alias("name"),
                        F.struct(
                            F.col(f"fps_{f}").alias("fps"), F.col(f"loss_{f}").alias("loss")
                        ).alias("rawData"),
                    ),
                )
                for f in FLAGS
            ]
        )
    )
    episodes = spread(_orders(spark, sf_dir), "_key")
    joined = episodes.join(metrics, F.col("_key") == F.col("_order"), "left")
    metadata = F.to_json(
        F.struct(
            F.lit("metadata_raw").alias("ruleCode"),
            F.array(
                F.struct(
                    F.lit("metadata.json").alias("name"),
                    F.struct("status", "sn").alias("rawData"),
                )
            ).alias("rawDataMetric"),
        )
    )
    raw = F.concat(
        F.lit('{"episodeId":"'),
        F.col("episode_id"),
        F.lit('","createdAt":"'),
        F.col("collected_at"),
        F.lit('","report":[{"ruleCode":"line_stats","rawDataMetric":'),
        F.to_json(entries),
        F.lit("},"),
        metadata,
        F.lit("]}"),
    )
    return with_paths(joined).select(
        "model",
        "taskid",
        "episode_id",
        "area",
        "sn",
        "collected_at",
        "filename",
        "path",
        raw.alias("raw"),
    )


def with_paths(episodes: DataFrame) -> DataFrame:
    """Add the file name and path a report of these keys would have."""
    name = F.concat(F.col("episode_id"), F.lit("_collect.json"))
    return episodes.withColumn("filename", name).withColumn(
        "path", F.concat_ws("/", "model", "taskid", "episode_id", name)
    )


def event_episodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys and attributes of the events as episodes, without documents (and so not spread)."""
    return _event_episodes(table(spark, sf_dir, "events"))


def event_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.concat(
        F.lit('{"value":'), F.col("value"), F.lit(',"props":'), F.col("props"), F.lit("}")
    )
    return _event_episodes(spread(table(spark, sf_dir, "events"), "event_id"), raw.alias("raw"))


def _event_episodes(events: DataFrame, *more: Column) -> DataFrame:
    return events.select(
        F.col("event_type").alias("model"),
        F.col("user_id").cast("string").alias("taskid"),
        F.col("event_id").cast("string").alias("episode_id"),
        F.lit("stream").alias("area"),
        F.concat(F.lit("u"), F.col("user_id")).alias("sn"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("collected_at"),
        *more,
    )


def document_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    labels = table(spark, sf_dir, "labels")
    joined = documents.join(labels, "doc_id", "left")
    labelled = F.when(
        F.col("quality").isNotNull() | F.col("toxic").isNotNull(), F.struct("quality", "toxic")
    )
    reports = joined.select(
        F.col("lang").alias("model"),
        F.concat_ws("-", "source", F.col("doc_id") % 20).alias("taskid"),
        F.col("doc_id").cast("string").alias("episode_id"),
        F.col("source").alias("area"),
        F.to_json(F.struct("n_chars", labelled.alias("labels"))).alias("raw"),
    )
    return with_paths(reports)
