"""Report files and what their location tells."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldguard.session import balanced, small_side

# Fixed value: characters not allowed in a model name.
ILLEGAL_CHARACTERS = r'[<>:"/\\|?*\x00-\x1F]'
COLLECT_SUFFIX = "_collect.json"
MISSING_MODEL = "MODEL_MISSING"


def scan_reports(spark: SparkSession, root: str, suffix: str = ".json") -> DataFrame:
    """One row per report file below ``root``: path (relative to it), filename, raw text.

    Millions of small files list and open slowly: scan them once and keep the result as Parquet
    (:func:`land_reports`); everything else starts from there. Names starting with ``.`` or ``_``
    are not read, which leaves source markers out.
    """
    files = (
        spark.read.option("recursiveFileLookup", True)
        .option("pathGlobFilter", f"*{suffix}")
        .text(root, wholetext=True)
        .select(F.col("_metadata.file_path").alias("_file"), F.col("value").alias("raw"))
    )
    location = F.url_decode(F.replace(F.col("_file"), F.lit("+"), F.lit("%2B")))
    base = root.rstrip("/").split(":", 1)[-1].lstrip("/")
    path = F.regexp_replace(location, r"^.*?\Q" + base + r"\E/+", "")
    return files.select(
        path.alias("path"),
        F.element_at(F.split(path, "/"), -1).alias("filename"),
        F.regexp_replace("raw", r"^\uFEFF", "").alias("raw"),
    )


def episode_of_file(filename: Column) -> Column:
    """File name without ``_collect.json`` or ``.json``."""
    return F.regexp_replace(filename, r"(_collect)?\.json$", "")


def with_path_keys(reports: DataFrame, default: str = "N/A") -> DataFrame:
    """Add model, taskid and episode_id from ``<model>/<taskid>/<episode>/.../<file>``.

    ``name=value`` folders count as their value. Without an episode folder the file name tells the
    episode.
    """
    parts = F.transform(
        F.split("path", "/"), lambda p: F.regexp_replace(p, r"^[A-Za-z_]+=(?!.*\.json$)", "")
    )
    depth = F.size(parts)
    from_name = episode_of_file(F.col("filename"))
    return reports.select(
        "*",
        F.coalesce(F.when(depth > 1, F.get(parts, 0)), F.lit(default)).alias("model"),
        F.coalesce(F.when(depth > 2, F.get(parts, 1)), F.lit(default)).alias("taskid"),
        F.when(depth > 3, F.get(parts, 2))
        .otherwise(F.when(from_name != "", from_name).otherwise(default))
        .alias("episode_id"),
    )


def named_model(raw: Column) -> Column:
    """Model named in the text of a report: ``model`` in any case, else ``robotModel``, else either
    key in exact case anywhere. NULL if there is none."""

    def filled(pattern: str) -> Column:
        text = F.trim(F.regexp_extract(raw, pattern, 1))
        return F.when(text != "", text)

    return F.coalesce(
        filled(r'(?i)"model"\s*:\s*"([^"]+)"'),
        filled(r'(?i)"robotModel"\s*:\s*"([^"]+)"'),
        filled(r'"(?:model|robotModel)"\s*:\s*"((?:[^"\\]|\\.)*)"'),
    )


def clean_name(name: Column, fallback: str = MISSING_MODEL) -> Column:
    text = F.regexp_replace(F.trim(name), ILLEGAL_CHARACTERS, "_")
    text = F.regexp_replace(text, r"^[ .]+|[ .]+$", "")
    return F.coalesce(F.when(text != "", text), F.lit(fallback))


def detect_model(reports: DataFrame, default: str = MISSING_MODEL) -> DataFrame:
    """(taskid, model): one report decides for its whole task.

    That is the smallest path among files named ``*_collect.json``, else among all. Only the name
    found in each text travels, so documents are not shuffled.
    """
    named = reports.select("taskid", "path", named_model(F.col("raw")).alias("_name"))
    other = ~F.col("path").endswith(COLLECT_SUFFIX)
    first = named.groupBy("taskid").agg(
        F.min_by(F.struct("_name"), F.struct(other.alias("_other"), "path")).alias("_first")
    )
    return first.select("taskid", clean_name(F.col("_first._name"), default).alias("model"))


def assign_model(reports: DataFrame, default: str = MISSING_MODEL) -> DataFrame:
    """Reports with the model detected for their task."""
    return reports.drop("model").join(small_side(detect_model(reports, default)), "taskid")


def task_list(
    spark: SparkSession,
    path: str,
    column: str | None = "taskid",
    index: int = 0,
    skip_header: bool = False,
) -> DataFrame:
    """Task ids of a CSV file, by column name or (``column=None``) by position."""
    reader = spark.read.option("mode", "PERMISSIVE")
    if column is not None:
        table = reader.option("header", True).csv(path)
        cell = F.col(f"`{column}`") if column in table.columns else F.lit(None).cast("string")
    else:
        table = reader.option("header", skip_header).csv(path)
        inside = 0 <= index < len(table.columns)
        cell = F.col(f"`{table.columns[index]}`") if inside else F.lit(None).cast("string")
    return clean_tasks(table.select(cell.alias("taskid")))


def clean_tasks(tasks: DataFrame) -> DataFrame:
    """Trimmed, without surrounding slashes, blanks dropped, each once."""
    text = F.regexp_replace(F.trim("taskid"), r"^/+|/+$", "")
    return tasks.select(text.alias("taskid")).filter("taskid != ''").distinct()


def restrict_tasks(reports: DataFrame, tasks: DataFrame) -> DataFrame:
    return reports.join(small_side(tasks.select("taskid")), "taskid", "left_semi")


def sources_of(choice: str, presets: Sequence[str], production: Sequence[str] = ()) -> list[str]:
    """Areas a run reads: ``prod_all``, ``all`` or a single one."""
    if choice == "prod_all":
        chosen = list(production)
    elif choice == "all":
        chosen = list(presets)
    else:
        chosen = [choice]
    if not chosen:
        raise ValueError(f"no areas for {choice!r}")
    unknown = [a for a in chosen if a not in presets]
    if unknown:
        raise KeyError(f"unknown areas: {unknown}")
    return chosen


def union_sources(scans: Mapping[str, DataFrame]) -> DataFrame:
    """Scans of several areas as one collection, each row tagged with its area."""
    tagged = [df.withColumn("area", F.lit(area)) for area, df in scans.items()]
    return reduce(DataFrame.unionByName, tagged)


def landing_conflicts(reports: DataFrame) -> DataFrame:
    """(model, taskid, sources): tasks that would land in the same place from several areas."""
    return (
        reports.groupBy("model", "taskid")
        .agg(F.count_distinct(F.coalesce("area", F.lit(""))).alias("sources"))
        .filter("sources > 1")
    )


def land_reports(reports: DataFrame, path: str) -> None:
    """Write reports partitioned by model; any landing conflict aborts before anything is written."""
    clash = landing_conflicts(reports).limit(1).collect()
    if clash:
        raise RuntimeError(f"landing conflict: {clash[0].asDict()}")
    balanced(reports, "model").write.mode("errorifexists").partitionBy("model").parquet(path)


def tag_area(reports: DataFrame, task_area: DataFrame, default: str | None = "N/A") -> DataFrame:
    """Add the area of the task; ``default`` where none is recorded.

    ``task_area`` has one row per task; its own duplicates are resolved to the smallest area.
    """
    areas = task_area.filter("area != ''").groupBy("taskid").agg(F.min("area").alias("area"))
    tagged = reports.drop("area").join(small_side(areas), "taskid", "left")
    if default is None:
        return tagged
    return tagged.withColumn("area", F.coalesce("area", F.lit(default)))


def filter_areas(reports: DataFrame, areas: Sequence[str] | None) -> DataFrame:
    """Keep reports of the enabled areas; None keeps all, an empty list is an error."""
    if areas is None:
        return reports
    if not areas:
        raise ValueError("the list of enabled areas is empty; use None for all areas")
    return reports.filter(F.col("area").isin(*areas))


def discover_models(reports: DataFrame) -> DataFrame:
    """Model names, without those that look like a task id (32 hexadecimal digits)."""
    names = reports.select("model").distinct()
    return names.filter(~F.col("model").rlike("^[0-9a-fA-F]{32}$")).orderBy("model")


def select_models(
    models: Sequence[str],
    only: Sequence[str] = (),
    skip: Sequence[str] = (),
    start_from: str | None = None,
) -> list[str]:
    """Subset of a model list in its order; a ``start_from`` that is not left is an error."""
    left = [m for m in models if (not only or m in only) and m not in skip]
    if start_from is None or start_from == "":
        return left
    if start_from not in left:
        raise ValueError(f"{start_from!r} is not among {left}")
    return left[left.index(start_from) :]


def filter_models(
    reports: DataFrame,
    only: Sequence[str] = (),
    skip: Sequence[str] = (),
    start_from: str | None = None,
) -> DataFrame:
    """The same on rows, models in name order: filters that reach the partitions of the scan.

    With ``start_from`` the model names (a short list) are read first, as its place in them counts.
    """
    model = F.col("model")
    if start_from:
        names = sorted(r[0] for r in reports.select("model").distinct().collect() if r[0] is not None)
        return reports.filter(model.isin(*select_models(names, only, skip, start_from)))
    if only:
        reports = reports.filter(model.isin(*only))
    if skip:
        reports = reports.filter(~model.isin(*skip))
    return reports
