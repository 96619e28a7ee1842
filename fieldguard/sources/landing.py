"""Reports landed in buckets of tasks: work by task leaves the documents where they are.

Landing shuffles every document once, into a table bucketed and sorted by task and salt. Afterwards a list of
tasks, however long, is dealt to the buckets and meets the documents there; only keys are exchanged.

A task that holds more than one bucket's share of the rows is hot: its rows are dealt to as many salts as
it holds shares, by their path. There are fewer hot tasks than buckets, so their table may be broadcast.

Defined results: a NULL task is a group of its own (it can be hot, is kept by left joins and met by nothing);
rows with a NULL path or equal paths all stay; an empty collection makes an empty table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldguard.session import MAX_BROADCAST_ROWS, settle, shared_dir
from fieldguard.sources.reports import COLLECT_SUFFIX, MISSING_MODEL, detect_model

SALT = "_salt"
_HOT = "_hot"


@dataclass(frozen=True)
class Landed:
    """The bucketed table (with its salt column) and the hot tasks with their number of salts."""

    table: DataFrame
    hot: DataFrame

    @property
    def reports(self) -> DataFrame:
        return self.table.drop(SALT)


def hot_tasks(reports: DataFrame, buckets: int) -> DataFrame:
    """(taskid, salts) of tasks with more than one bucket's share of all rows.

    At most ``buckets - 1`` tasks can hold so many; their salts add up to less than twice ``buckets``.
    """
    sizes = settle(reports.groupBy("taskid").agg(F.count(F.lit(1)).alias("n")))
    total = sizes.agg(F.sum("n")).first()[0] or 0
    salts = F.ceil(F.col("n") * buckets / F.lit(max(total, 1))).cast("int")
    return sizes.where(F.col("n") * buckets > total).select("taskid", salts.alias("salts"))


def _with_salts(rows: DataFrame, hot: DataFrame) -> DataFrame:
    """Rows with the number of salts of their task."""
    side = F.broadcast(hot.withColumnsRenamed({"taskid": _HOT, "salts": "_salts"}))
    return rows.join(side, F.col("taskid").eqNullSafe(F.col(_HOT)), "left").drop(_HOT)


def _salt_of_path(rows: DataFrame, hot: DataFrame) -> DataFrame:
    salt = F.pmod(F.xxhash64("path"), F.coalesce("_salts", F.lit(1)).cast("long")).cast("int")
    return _with_salts(rows, hot).withColumn(SALT, salt).drop("_salts")


def land_by_task(reports: DataFrame, name: str, buckets: int | None = None) -> Landed:
    """Write reports (with taskid and path) as table ``name``, bucketed by task.

    Choose ``buckets`` so that one bucket's share of the documents is a good task, and not below the
    session's shuffle partitions (the default): Spark prefers the finer side of a join. Files lie in
    the shared folder; the catalog knows the buckets.
    """
    spark = reports.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    folder = f"{shared_dir(spark).rstrip('/')}/landed-{name}"
    hot = settle(hot_tasks(reports, buckets))
    dealt = _salt_of_path(reports, hot).repartition(buckets, "taskid", SALT)
    writer = dealt.write.bucketBy(buckets, "taskid", SALT).sortBy("taskid", SALT).format("parquet")
    writer.option("path", f"{folder}/reports").mode("errorifexists").saveAsTable(name)
    hot.write.mode("errorifexists").parquet(f"{folder}/hot")
    return Landed(spark.table(name), spark.read.schema(hot.schema).parquet(f"{folder}/hot"))


def landed(spark: SparkSession, name: str) -> Landed:
    """The landing ``name`` of an earlier job."""
    folder = f"{shared_dir(spark).rstrip('/')}/landed-{name}"
    return Landed(spark.table(name), spark.read.schema("taskid string, salts int").parquet(f"{folder}/hot"))


def _meet(place: Landed, keys: DataFrame, how: str, max_rows: int) -> DataFrame:
    """Join by task: few keys are broadcast, more are dealt to the buckets, once per salt of their task."""
    keys = settle(keys)
    if keys.limit(max_rows + 1).count() <= max_rows:
        return place.table.join(F.broadcast(keys), "taskid", how).drop(SALT)
    last = F.coalesce("_salts", F.lit(1)) - 1
    salted = _with_salts(keys, place.hot).withColumn(SALT, F.explode(F.sequence(F.lit(0), last)))
    return place.table.join(salted.drop("_salts"), ["taskid", SALT], how).drop(SALT)


def restrict_tasks(place: Landed, tasks: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Reports of the listed tasks."""
    return _meet(place, tasks.select("taskid").distinct(), "left_semi", max_rows)


def assign_model(
    place: Landed, default: str = MISSING_MODEL, max_rows: int = MAX_BROADCAST_ROWS
) -> DataFrame:
    """Reports with the model detected for their task; those without a task have none and go."""
    bare = Landed(place.table.drop("model"), place.hot)
    return _meet(bare, detect_model(place.table, default), "inner", max_rows)


def tag_area(
    place: Landed, task_area: DataFrame, default: str | None = "N/A", max_rows: int = MAX_BROADCAST_ROWS
) -> DataFrame:
    """Add the area of the task (the smallest recorded one); ``default`` where there is none."""
    areas = task_area.filter("area != ''").groupBy("taskid").agg(F.min("area").alias("area"))
    tagged = _meet(Landed(place.table.drop("area"), place.hot), areas, "left", max_rows)
    return tagged if default is None else tagged.withColumn("area", F.coalesce("area", F.lit(default)))


def sample_reports(place: Landed, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """One report per model and task: the smallest path, ``*_collect.json`` preferred.

    A path tells its salt, so every choice goes to one bucket. The paths are compared by two bounds: with
    an equality Spark would take the path into the join's keys and deal the documents anew by it.
    """
    order = F.struct(~F.col("path").endswith(COLLECT_SUFFIX), F.col("path"))
    best = place.table.groupBy("model", "taskid").agg(F.min_by("path", order).alias("path"))
    chosen = settle(best.select("taskid", "path").distinct())
    if chosen.limit(max_rows + 1).count() <= max_rows:
        return place.table.join(F.broadcast(chosen), ["taskid", "path"], "left_semi").drop(SALT)
    rows, side = place.table.alias("r"), _salt_of_path(chosen, place.hot).alias("c")
    at = (F.col("r.taskid") == F.col("c.taskid")) & (F.col(f"r.{SALT}") == F.col(f"c.{SALT}"))
    same = (F.col("r.path") <= F.col("c.path")) & (F.col("r.path") >= F.col("c.path"))
    return rows.join(side, at & same, "left_semi").drop(SALT)
