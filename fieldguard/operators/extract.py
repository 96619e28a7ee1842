"""Field values out of report documents."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldguard.functions import selectors as sel
from fieldguard.session import balanced, small_side

# A plan is compiled from the field list, so the list must stay plan-sized.
MAX_FIELDS = 20_000

FieldSets = Sequence[str] | Mapping[str, Sequence[str]]


def field_sets(fields: DataFrame, order: str = "field") -> dict[str, list[str]]:
    """Field list per model from a (model, field) table; refuses lists that are not plan-sized."""
    rows = fields.select("model", "field", order).distinct().limit(MAX_FIELDS + 1).collect()
    if len(rows) > MAX_FIELDS:
        raise ValueError(f"more than {MAX_FIELDS} fields: extract model by model")
    out: dict[str, list[str]] = {}
    for row in sorted(rows, key=lambda r: (r["model"], r[order])):
        out.setdefault(row["model"], []).append(row["field"])
    return out


def _layout(fields: FieldSets) -> tuple[list[str], dict[str, list[int]] | None]:
    if not isinstance(fields, Mapping):
        return list(dict.fromkeys(fields)), None
    names = list(dict.fromkeys(f for group in fields.values() for f in group))
    at = {name: i for i, name in enumerate(names)}
    lists = {model: [at[f] for f in dict.fromkeys(group)] for model, group in fields.items()}
    if lists and all(positions == list(range(len(names))) for positions in lists.values()):
        # Same list everywhere; only the models named take part.
        return names, lists
    return names, lists


def extract_values(
    reports: DataFrame,
    fields: FieldSets,
    *,
    keys: Sequence[str] = ("model", "episode_id"),
    match: str = "typed",
    strict: bool = False,
) -> DataFrame:
    """One row per (report, selected field): ``keys``, ``field``, ``value`` (text, NULL if absent).

    ``fields`` is a list for all models, or a list per model (other models then yield nothing).
    The rows are unfolded from one parsed document, so there is no join and no shuffle. Reports
    that are not JSON are left out; with ``strict`` they, and malformed selectors, are errors.
    """
    names, per_model = _layout(fields)
    if len(names) > MAX_FIELDS:
        raise ValueError(f"more than {MAX_FIELDS} fields: extract model by model")
    keep = list(dict.fromkeys([*keys, *(["model"] if per_model is not None else [])]))
    schema = T.StructType([reports.schema[k] for k in keys])
    schema = schema.add("field", T.StringType()).add("value", T.StringType())
    if not names:
        return reports.sparkSession.createDataFrame([], schema)
    if per_model is not None:
        reports = reports.filter(F.col("model").isin(*per_model))
    parsed = sel.parse_reports(reports, names, match=match, keep=keep, lenient=not strict)
    if strict:
        unreadable = F.raise_error(F.lit("report is not JSON"))
        parsed = parsed.withColumn("_cells", F.coalesce("_cells", unreadable))
    # The outer form keeps the optimizer from re-parsing the document in a derived filter.
    cells = parsed.select(*keep, F.posexplode_outer("_cells").alias("_at", "value"))
    cells = cells.filter(F.col("_at").isNotNull())
    if per_model is not None:
        everywhere = list(range(len(names)))
        cut = {m: p for m, p in per_model.items() if sorted(p) != everywhere}
        if cut:
            allowed = F.create_map(
                *[
                    c
                    for m, p in cut.items()
                    for c in (F.lit(m), F.array(*[F.lit(i) for i in p]).cast("array<int>"))
                ]
            )
            listed = F.try_element_at(allowed, F.col("model"))
            cells = cells.filter(
                F.coalesce(F.array_contains(listed, F.col("_at")), F.lit(True))
            )
    name = F.element_at(F.array(*[F.lit(n) for n in names]), F.col("_at") + 1)
    return cells.select(*keys, name.alias("field"), "value")


def selector_violations(fields: DataFrame) -> DataFrame:
    """Rows of a field table whose selector is malformed."""
    return fields.filter(~sel.well_formed(F.col("field")))


def select_cells(
    reports: DataFrame,
    columns: Mapping[str, str],
    *,
    keep: Sequence[str],
    match: str = "text",
    default: str | None = "N/A",
) -> DataFrame:
    """A few selectors as columns of their own; what is missing becomes ``default``."""
    names = list(columns)
    parsed = sel.parse_reports(reports, [columns[n] for n in names], match=match, keep=keep)
    cell = [F.get(F.col("_cells"), i) for i in range(len(names))]
    if default is not None:
        cell = [F.coalesce(c, F.lit(default)) for c in cell]
    row = F.struct(F.lit(True).alias("_row"), *[c.alias(n) for c, n in zip(cell, names)])
    rows = F.when(F.col("_cells").isNotNull(), F.array(row))
    # Unfolding (outer) instead of filtering: a filter would be pushed down and parse twice.
    return parsed.select(*keep, F.inline_outer(rows)).filter("_row").drop("_row")


def count_cells(values: DataFrame) -> DataFrame:
    """(model, field, value, _count): how often each text stands in a field.

    Learning and the audit of fields take such counts in place of the values themselves, so reports that are
    used for both are read once. Counts of a task are added up before the shuffle.
    """
    return values.groupBy("model", "field", "value").agg(F.count(F.lit(1)).alias("_count"))


def is_filled(value: Column) -> Column:
    """Neither missing, nor blank text, nor an empty container."""
    return F.coalesce(~F.trim(value).isin("", "[]", "{}"), F.lit(False))


def drop_empty_fields(values: DataFrame) -> DataFrame:
    """Remove fields that are empty in every report of their model.

    The list of surviving fields has one row per (model, field) and is broadcast after a check of
    its size.
    """
    alive = values.filter(is_filled(F.col("value"))).select("model", "field").distinct()
    return values.join(small_side(alive), ["model", "field"], "left_semi")


def drop_empty_cells(values: DataFrame) -> DataFrame:
    """Long output with the empty rows left out."""
    return values.filter(is_filled(F.col("value")))


def safe_name(field: Column) -> Column:
    """Selector as a file-system name: special characters and dots to ``_``, 120 characters."""
    return F.substring(F.regexp_replace(field, r'[<>:"/\\|?*\[\]=.]', "_"), 1, 120)


def with_folder_names(values: DataFrame) -> DataFrame:
    """Add ``field_file``: the safe name; selectors that would share it get a digest after it.

    The list of fields is small and read for this.
    """
    fields = values.select("field").distinct().withColumn("_name", safe_name(F.col("field")))
    shared = F.count(F.lit(1)).over(Window.partitionBy("_name")) > 1
    digest = F.concat("_name", F.lit("-"), F.substring(F.md5("field"), 1, 12))
    named = fields.select("field", F.when(shared, digest).otherwise(F.col("_name")).alias("field_file"))
    return values.join(small_side(named), "field")


def write_per_field(values: DataFrame, path: str) -> None:
    """One folder per model and field."""
    (
        balanced(with_folder_names(values), "model", "field_file")
        .write.partitionBy("model", "field_file")
        .mode("errorifexists")
        .parquet(path)
    )


# Fixed value: where reports keep the serial number of the device.
SN_SELECTOR = (
    ".<report>.[<ruleCode>=<metadata_raw>].<rawDataMetric>.[<name>=<metadata.json>]"
    ".<rawData>.<metadata>.<equipment_info>.<sn>"
)


def episode_info(
    reports: DataFrame,
    extra: Sequence[Mapping[str, object]] = (),
    *,
    sn_selector: str = SN_SELECTOR,
    default: str = "N/A",
) -> DataFrame:
    """File, ids, model, serial number, creation time and configured columns of every report.

    ``extra`` entries hold ``column_name``, ``selector`` and optionally ``models``: elsewhere the
    column is NULL.
    """
    columns = {"episodeId": ".<episodeId>", "SN": sn_selector, "createdAt": ".<createdAt>"}
    restricted: dict[str, list[str]] = {}
    for entry in extra:
        name = str(entry["column_name"])
        columns[name] = str(entry.get("selector") or "")
        if entry.get("models"):
            restricted[name] = [str(m) for m in entry["models"]]
    cells = select_cells(
        reports.withColumn("taskid", F.coalesce("taskid", F.lit(default))),
        columns,
        keep=["filename", "taskid", "model"],
        default=default,
    )
    names = [n for n in columns if n not in ("episodeId", "SN", "createdAt")]
    return cells.select(
        F.col("filename").alias("file"),
        "episodeId",
        "taskid",
        "model",
        "SN",
        "createdAt",
        *[
            (F.when(F.col("model").isin(*restricted[n]), F.col(n)) if n in restricted else F.col(n))
            .alias(n)
            for n in names
        ],
    )
