"""Ranges as publishable data: packed literals, update statements, versioned exports, payloads."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def escape_literal(text: Column) -> Column:
    r"""Text as one line: ``\`` doubled first, then line ends to ``\n``. Reversible."""
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    text = F.replace(F.replace(text, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))
    return F.replace(text, F.lit("\n"), F.lit("\\n"))


def unescape_literal(text: Column) -> Column:
    r"""Inverse of :func:`escape_literal` (line ends come back as ``\n``)."""
    parts = F.split(text, r"\\\\", -1)
    return F.array_join(
        F.transform(parts, lambda p: F.replace(p, F.lit("\\n"), F.lit("\n"))), "\\"
    )


def csv_cell(text: Column) -> Column:
    """Quote a CSV cell where needed."""
    quoted = F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))
    return F.when(text.rlike('[",\r\n]'), quoted).otherwise(F.coalesce(text, F.lit("")))


RANGE_COLUMNS = ("field", "min", "max", "pass_count", "fail_count", "pass_rate")


def csv_lines(ranges: DataFrame) -> DataFrame:
    """(model, variant, field, line): the ranges table as CSV lines.

    Non-numeric fields carry the mark "true" as both bounds. Statistics appear if present.
    """
    mark = F.col("is_non_numeric")
    shown = {
        "field": F.col("field"),
        "min": F.when(mark, "true").otherwise(F.col("lo").cast("string")),
        "max": F.when(mark, "true").otherwise(F.col("hi").cast("string")),
    }
    for name in RANGE_COLUMNS[3:]:
        if name in ranges.columns:
            shown[name] = F.col(name).cast("string")
    line = F.concat_ws(",", *[csv_cell(c) for c in shown.values()])
    return ranges.select("model", "variant", "field", line.alias("line"))


def pack_ranges(ranges: DataFrame) -> DataFrame:
    """(model, variant, literal): header and lines in field order, as one escaped literal.

    A group holds one short line per field of a model, so gathering it is bounded by the field
    list.
    """
    header = ",".join(c for c in RANGE_COLUMNS if c in ("field", "min", "max") or c in ranges.columns)
    packed = (
        csv_lines(ranges)
        .groupBy("model", "variant")
        .agg(F.sort_array(F.collect_list(F.struct("field", "line"))).alias("_lines"))
    )
    body = F.array_join(F.transform("_lines", lambda e: e["line"]), "\n")
    text = F.concat(F.lit(header + "\n"), body, F.lit("\n"))
    return packed.select("model", "variant", escape_literal(text).alias("literal"))


def update_statements(packed: DataFrame) -> DataFrame:
    """One UPDATE per (model, variant), single quotes doubled."""

    def quoted(c: str) -> Column:
        return F.replace(F.col(c), F.lit("'"), F.lit("''"))

    statement = F.concat(
        F.lit("UPDATE rule_config SET payload_json='"),
        quoted("literal"),
        F.lit("' WHERE model='"),
        quoted("model"),
        F.lit("';"),
    )
    return packed.select("model", "variant", statement.alias("statement")).orderBy(
        "variant", "model"
    )


def version_path(prefix: str, model: Column, variant: Column, tag: str) -> Column:
    """Folder of one export: prefix/model/variant/tag."""
    return F.concat_ws("/", F.lit(prefix.strip("/")), model, variant, F.lit(tag))


def export_version(ranges: DataFrame, root: str, tag: str, prefix: str = "range") -> DataFrame:
    """Write one CSV export per model and variant; returns the manifest (model, variant, last_path).

    Every export lies at its recorded path below ``root``. None is overwritten: a path that exists
    fails its write. A range table has some models and two variants, so its pairs are a short list.
    """
    noted = manifest(ranges, tag, prefix)
    columns = [c for c in ("field", "min", "max", *RANGE_COLUMNS[3:]) if c in (*ranges.columns, "min", "max")]
    mark = F.col("is_non_numeric")
    cells = ranges.withColumns(
        {
            "min": F.when(mark, "true").otherwise(F.col("lo").cast("string")),
            "max": F.when(mark, "true").otherwise(F.col("hi").cast("string")),
        }
    )
    for model, variant, path in noted.collect():
        own = cells.filter((F.col("model") == model) & (F.col("variant") == variant))
        own.select(*columns).coalesce(1).sortWithinPartitions("field").write.mode(
            "errorifexists"
        ).option("header", True).option("escape", '"').csv(f"{root.rstrip('/')}/{path}")
    return noted


def manifest(ranges: DataFrame, tag: str, prefix: str = "range") -> DataFrame:
    pairs = ranges.select("model", "variant").distinct()
    path = version_path(prefix, F.col("model"), F.col("variant"), tag)
    return pairs.select("model", "variant", path.alias("last_path"))


def rule_ids(spark: SparkSession, id_to_model: Mapping[object, object]) -> DataFrame:
    """(model, rule_id) from a configured id -> model map; unusable entries are dropped."""
    usable: dict[str, int] = {}
    for rid, model in id_to_model.items():
        name = str(model).strip() if model is not None else ""
        try:
            number = int(rid)
        except (TypeError, ValueError):
            continue
        if name:
            usable[name] = number
    return spark.createDataFrame(sorted(usable.items()), "model string, rule_id bigint")


def reversed_ids(ids: DataFrame) -> DataFrame:
    """The same from a table (id_text, model): one id per model, the last one listed wins."""
    text = F.trim("id_text")
    whole = F.when(text.rlike("^[+-]?[0-9]+$"), F.expr("try_cast(trim(id_text) AS bigint)"))
    clean = ids.select(F.trim("model").alias("model"), whole.alias("rule_id"), "pos")
    clean = clean.filter((F.col("model") != "") & F.col("rule_id").isNotNull())
    return clean.groupBy("model").agg(F.max_by("rule_id", "pos").alias("rule_id"))


# Body keys per variant, for the packed text and for the path of its export.
BODY_KEYS = {"base": ("config", "csvPath"), "full": ("configFull", "csvFullPath")}


def payload_rows(
    packed: DataFrame, ids: DataFrame, paths: DataFrame | None = None, on_missing: str = "skip"
) -> DataFrame:
    """(model, rule_id, key, body): JSON bodies to send.

    Models without an id yield nothing, or with ``on_missing="error"`` an error that names them.
    """
    if on_missing not in ("skip", "error"):
        raise ValueError(f"on_missing is {on_missing!r}")
    if on_missing == "error":
        lost = [r[0] for r in missing_ids(packed, ids).limit(20).collect()]
        if lost:
            raise KeyError(f"models without a rule id: {sorted(lost)}")
    pieces = [(packed.withColumnRenamed("literal", "_content"), 0)]
    if paths is not None:
        pieces.append((paths.withColumnRenamed("last_path", "_content"), 1))
    rows: DataFrame | None = None
    for table, slot in pieces:
        key = F.when(F.col("variant") == "full", BODY_KEYS["full"][slot]).otherwise(
            BODY_KEYS["base"][slot]
        )
        part = table.select("model", "_content", key.alias("key"))
        rows = part if rows is None else rows.unionByName(part)
    joined = rows.join(ids, "model")
    content = F.to_json(F.struct(F.col("_content").alias("v")))
    value = F.substring(content, F.lit(6), F.length(content) - 6)
    body = F.format_string('{"id":%d,"%s":%s}', F.col("rule_id"), F.col("key"), value)
    return joined.select("model", "rule_id", "key", body.alias("body"))


def missing_ids(packed: DataFrame, ids: DataFrame) -> DataFrame:
    """Models that have ranges but no rule id."""
    return packed.select("model").distinct().join(ids, "model", "left_anti")
