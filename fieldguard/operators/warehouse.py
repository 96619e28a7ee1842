"""Star schema: episodes, fields, values, thresholds, raw documents."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldguard.functions import labels
from fieldguard.operators.extract import select_cells
from fieldguard.session import balanced, small_side

# Where reports keep the episode attributes, and the tables with their keys.
EPISODE_SELECTORS = {
    "sn": (
        ".<report>.[<ruleCode>=<metadata_raw>].<rawDataMetric>.[<name>=<metadata.json>]"
        ".<rawData>.<metadata>.<equipment_info>.<sn>"
    ),
    "collected_at": (
        ".<report>.[<ruleCode>=<metadata_raw>].<rawDataMetric>.[<name>=<metadata.json>]"
        ".<rawData>.<metadata>.<collected_at>"
    ),
}
TABLE_KEYS = {
    "episode": ["model", "episode_id"],
    "field": ["model", "field_id"],
    "thresholds_base": ["model", "field"],
    "thresholds_full": ["model", "field"],
    "field_value": ["model", "episode_id", "field_id"],
    "collect_json": ["model", "episode_id"],
}


def object_uri(
    bucket: Column, taskid: Column, episode_id: Column, filename: Column, default: str = "N/A"
) -> Column:
    """Address of the stored report, or the default if any part is unknown."""

    def known(part: Column) -> Column:
        return part.isNotNull() & (part != "") & (part != default)

    def inner(part: Column) -> Column:
        return F.regexp_replace(F.trim(part), r"^/+|/+$", "")

    whole = known(bucket) & known(taskid) & known(episode_id) & (F.length(filename) > 0)
    uri = F.concat(
        F.lit("obs://"),
        bucket,
        F.lit("/collect/"),
        inner(taskid),
        F.lit("/"),
        inner(episode_id),
        F.lit("/"),
        F.regexp_replace(F.trim(filename), r"^/+", ""),
    )
    return F.when(whole, uri).otherwise(default)


def with_uri(episodes: DataFrame, presets: DataFrame, default: str = "N/A") -> DataFrame:
    """Add ``obs_uri`` from the presets (area, bucket): a short configuration table."""
    buckets = presets.select("area", F.col("bucket").alias("_bucket"))
    uri = object_uri(
        F.col("_bucket"), F.col("taskid"), F.col("episode_id"), F.col("filename"), default
    )
    return episodes.join(buckets, "area", "left").withColumn("obs_uri", uri).drop("_bucket")


def first_per_episode(rows: DataFrame) -> DataFrame:
    """One row per (model, episode_id): the one with the smallest path.

    An aggregate rather than a window: copies collapse before the shuffle, however many there are.
    """
    keys = ["model", "episode_id"]
    rest = [c for c in rows.columns if c not in keys]
    return (
        rows.groupBy(*keys)
        .agg(F.min_by(F.struct(*rest), F.col("path")).alias("_first"))
        .select(*keys, *[F.col(f"_first.{c}").alias(c) for c in rest])
    )


def episode_dim(
    reports: DataFrame,
    presets: DataFrame,
    columns: Mapping[str, str] | None = None,
    *,
    default: str = "N/A",
) -> DataFrame:
    """Episode dimension: keys, area, object URI, extracted columns, file name.

    The documents themselves are dropped before the rows are shuffled.
    """
    columns = EPISODE_SELECTORS if columns is None else columns
    keep = ["model", "taskid", "episode_id", "area", "filename", "path"]
    rows = first_per_episode(select_cells(reports, columns, keep=keep, default=default))
    return with_uri(rows, presets, default).select(
        "episode_id", "taskid", "model", "area", "obs_uri", *columns, "filename"
    )


def field_dim(fields: DataFrame, ranges: DataFrame | None = None, order: str = "field") -> DataFrame:
    """field_id 1..N per model in ``order``, display name, rule code and type.

    The field list has one row per (model, field), so numbering it per model is cheap.
    """
    place = Window.partitionBy("model").orderBy(order)
    rows = fields.withColumn("field_id", F.row_number().over(place).cast("bigint"))
    if ranges is None:
        rows = rows.withColumn("type", F.lit(""))
    else:
        kinds = ranges.select(
            "model",
            "field",
            F.when(F.col("is_non_numeric"), "non_numeric").otherwise("numeric").alias("type"),
        )
        rows = rows.join(kinds, ["model", "field"], "left").withColumn(
            "type", F.coalesce("type", F.lit(""))
        )
    return rows.select(
        "model",
        "field_id",
        "field",
        labels.display_name(F.col("field")).alias("field_name"),
        labels.rule_code(F.col("field")).alias("rule_code"),
        "type",
    )


def field_value_fact(values: DataFrame, fields: DataFrame) -> DataFrame:
    """(model, episode_id, field_id, value); missing cells stay as NULL rows."""
    ids = small_side(fields.select("model", "field", "field_id"))
    return values.join(ids, ["model", "field"]).select("model", "episode_id", "field_id", "value")


def to_long(wide: DataFrame, keys: Sequence[str] = ("model", "episode_id")) -> DataFrame:
    """Wide table (one column per field) to (keys, field, value)."""
    cells = [c for c in wide.columns if c not in keys]
    texts = wide.select(*keys, *[F.col(f"`{c}`").cast("string").alias(c) for c in cells])
    return texts.unpivot(
        [F.col(k) for k in keys], [F.col(f"`{c}`") for c in cells], "field", "value"
    )


def to_wide(values: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Export form: one row per episode, one column per field."""
    return (
        values.groupBy("model", "episode_id").pivot("field", list(fields)).agg(F.max("value"))
    )


def thresholds(ranges: DataFrame, variant: str) -> DataFrame:
    """Ranges of one variant with all statistics columns (NULL where missing)."""
    kinds = {"pass_count": "bigint", "fail_count": "bigint", "pass_rate": "double"}
    stats = [
        (F.col(c) if c in ranges.columns else F.lit(None)).cast(t).alias(c)
        for c, t in kinds.items()
    ]
    mark = F.col("is_non_numeric")
    return ranges.filter(F.col("variant") == variant).select(
        "model",
        "field",
        F.when(mark, "true").otherwise(F.col("lo").cast("string")).alias("min"),
        F.when(mark, "true").otherwise(F.col("hi").cast("string")).alias("max"),
        *stats,
    )


def with_extra_columns(
    df: DataFrame, extra: Mapping[str, str | None], default: str | None = "N/A"
) -> DataFrame:
    """Configured constant columns; the default text "N/A" is stored as NULL."""
    filler = None if default == "N/A" else default
    return df.withColumns({name: F.lit(filler).cast("string") for name in extra})


def merged_columns(columns: Mapping[str, str], legacy: Mapping[str, str]) -> dict[str, str]:
    """Configured columns, plus those of the older setting that are not configured already."""
    return {**columns, **{k: v for k, v in legacy.items() if k not in columns}}


def latest_documents(existing: DataFrame | None, arriving: DataFrame) -> DataFrame:
    """Upsert of raw documents by (model, episode_id): an arriving document wins over a stored one.

    Both tables hold (model, episode_id, filename, json). Among arriving copies the one with the
    largest file name wins. Only names and origins decide, so copies collapse map-side.
    """
    new = arriving.select("model", "episode_id", "filename", "json", F.lit(1).alias("_round"))
    rows = new
    if existing is not None:
        rows = existing.select(
            "model", "episode_id", "filename", "json", F.lit(0).alias("_round")
        ).unionByName(new)
    return (
        rows.groupBy("model", "episode_id")
        .agg(F.max_by(F.struct("filename", "json"), F.struct("_round", "filename")).alias("_d"))
        .select("model", "episode_id", "_d.filename", "_d.json")
    )


def write_star(tables: Mapping[str, DataFrame], path: str, *, mode: str = "overwrite") -> None:
    """Full refresh of the named tables, partitioned by model.

    Only the partitions present in the data are replaced. Values of a field lie together, so that
    reading a few fields skips most files and row groups.
    """
    for name, df in tables.items():
        blank = F.col("model").isNull() | (F.trim("model") == "")
        unnamed = F.raise_error(F.lit(f"a row of {name} has no model"))
        df = df.withColumn("model", F.when(blank, unnamed.cast("string")).otherwise(F.col("model")))
        if name == "field_value":
            df = balanced(df, "model", "field_id").sortWithinPartitions("model", "field_id")
        else:
            df = balanced(df, "model")
        (
            df.write.mode(mode)
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("model")
            .parquet(f"{path}/{name}")
        )


def read_star(spark: SparkSession, path: str, name: str) -> DataFrame:
    """A table of the star with all columns that any of its files has; models are text.

    A partial refresh may have added columns: rows written before hold NULL there.
    """
    folder = f"{path}/{name}"
    merged = spark.read.option("mergeSchema", True).parquet(folder).schema
    fixed = [T.StructField(f.name, T.StringType() if f.name == "model" else f.dataType) for f in merged]
    return spark.read.schema(T.StructType(fixed)).parquet(folder)


def _count(df: DataFrame, table: str, check: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("violations")).select(
        F.lit(table).alias("table"), F.lit(check).alias("check"), "violations"
    )


def _key_checks(df: DataFrame, table: str) -> DataFrame:
    """Repeated keys, and rows with a NULL in the key, from one pass over the table."""
    keys = TABLE_KEYS[table]
    absent = F.lit(False)
    for key in keys:
        absent = absent | F.col(key).isNull()
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).agg(
        F.count_if(F.col("_n") > 1).alias("duplicate_key"),
        F.coalesce(F.sum(F.when(absent, F.col("_n"))), F.lit(0)).alias("null_key"),
    )
    checks = F.array(
        *[
            F.struct(F.lit(c).alias("check"), F.col(c).alias("violations"))
            for c in ("duplicate_key", "null_key")
        ]
    )
    return counted.select(F.lit(table).alias("table"), F.inline(checks))


def integrity_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Violations per table and check: key duplicates, key NULLs, field name duplicates, orphans."""
    parts = [_key_checks(df, name) for name, df in tables.items()]
    if "field" in tables:
        names = tables["field"].groupBy("model", "field").agg(F.count(F.lit(1)).alias("_n"))
        parts.append(_count(names.filter("_n > 1"), "field", "duplicate_field"))
    if {"field_value", "episode"} <= set(tables):
        values, episodes = tables["field_value"], tables["episode"]
        orphans = (
            values.select("model", "episode_id")
            .distinct()
            .join(episodes.select("model", "episode_id"), ["model", "episode_id"], "left_anti")
        )
        parts.append(_count(orphans, "field_value", "orphan_episode"))
    if {"field_value", "field"} <= set(tables):
        used = tables["field_value"].select("model", "field_id").distinct()
        orphans = used.join(
            tables["field"].select("model", "field_id"), ["model", "field_id"], "left_anti"
        )
        parts.append(_count(orphans, "field_value", "orphan_field"))
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part)
    return report
