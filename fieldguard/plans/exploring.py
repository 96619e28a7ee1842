"""Queries for the star schema (W) and the drill-down (X)."""

from __future__ import annotations

from datetime import date
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldguard.functions import labels
from fieldguard.operators import explore, learn, warehouse
from fieldguard.operators.learn import LearnParams
from fieldguard.plans import oracle as sql
from fieldguard.plans.learning import (
    PART_FIELDS,
    document_values,
    event_values,
    order_cells,
    part_fields,
)
from fieldguard.session import settle, shared_dir
from fieldguard.sources import bindings as b

AS_OF = date(2024, 1, 30)
# Areas known to the presets; the other regions have no bucket.
BUCKETS = {"ASIA": "reports-asia", "EUROPE": "reports-europe", "AFRICA": "reports-africa"}


def presets(spark: SparkSession, d: str) -> DataFrame:
    """Area and bucket of every region; regions outside BUCKETS have none."""
    bucket = F.lit(None).cast("string")
    for area, name in BUCKETS.items():
        bucket = F.when(F.col("r_name") == area, name).otherwise(bucket)
    return b.table(spark, d, "region").select(
        F.col("r_name").alias("area"), bucket.alias("bucket")
    )


EPISODE_COLUMNS = {
    "sn": b.METADATA.format(leaf="sn"),
    "collected_at": ".<createdAt>",
    "first_fps": b.NUMERIC_FIELDS[0],
}


def w1_episode_dim(spark, d):
    """Every report twice, the second time under a later path: the first path wins."""
    once = b.order_reports(spark, d)
    again = once.withColumn("path", F.concat(F.lit("~/"), "path")).withColumn(
        "filename", F.concat(F.lit("copy_"), "filename")
    )
    return warehouse.episode_dim(
        once.unionByName(again), presets(spark, d), EPISODE_COLUMNS
    )


_URI = """CASE area WHEN 'ASIA' THEN 'obs://reports-asia/collect/'
 WHEN 'EUROPE' THEN 'obs://reports-europe/collect/'
 WHEN 'AFRICA' THEN 'obs://reports-africa/collect/' END"""
W1_SQL = f"""WITH {sql.EP}, {sql.M}
SELECT ep.episode_id, taskid, model, area,
 coalesce({_URI} || taskid || '/' || ep.episode_id || '/' || ep.episode_id || '_collect.json', 'N/A') AS obs_uri,
 sn, collected_at, coalesce(CAST(m.fps AS VARCHAR), 'N/A') AS first_fps,
 ep.episode_id || '_collect.json' AS filename
FROM ep LEFT JOIN m ON m.episode_id = ep.episode_id AND m.flag = 'A'"""


def w2_object_uri(spark, d):
    rows = b.with_paths(b.order_episodes(spark, d))
    return warehouse.with_uri(rows, presets(spark, d)).select("model", "episode_id", "obs_uri")


W2_SQL = f"""WITH {sql.EP} SELECT model, episode_id,
 coalesce({_URI} || taskid || '/' || episode_id || '/' || episode_id || '_collect.json', 'N/A') AS obs_uri
FROM ep"""


def part_field_list(spark, d):
    return part_fields(spark, d).groupBy("model", "field").agg(F.min("pos").alias("pos"))


PART_DIM = f"""{PART_FIELDS},
pd AS (SELECT model, field, min(pos) AS pos FROM pf GROUP BY 1, 2)"""
_PART_RULE = r"regexp_extract(field, '\[<ruleCode>=<([^>]+)>\]', 1)"
_PART_NAME = r"regexp_extract(field, '\[<name>=<([^>]+)>\]', 1) || '-' || regexp_extract(field, '\.<(size_[^>]+)>$', 1)"


def w3_field_dim(spark, d):
    return warehouse.field_dim(part_field_list(spark, d), order="pos").select(
        "model", "field_id", "field", "field_name", "rule_code"
    )


W3_SQL = f"""WITH {PART_DIM}
SELECT model, row_number() OVER (PARTITION BY model ORDER BY pos) AS field_id, field,
 {_PART_NAME} AS field_name, {_PART_RULE} AS rule_code FROM pd"""


def w4_rule_code(spark, d):
    rows = part_fields(spark, d).withColumn("rule_code", labels.rule_code(F.col("field")))
    return rows.groupBy("rule_code").agg(F.count(F.lit(1)).alias("fields"))


def metadata_selectors(spark, d):
    """Selectors below each metadata section, named after suppliers and nations."""
    key = F.col("s_suppkey").cast("string")
    head = F.lit(
        ".<report>.[<ruleCode>=<metadata_raw>].<rawDataMetric>.[<name>=<metadata.json>].<rawData>"
    )
    section = (
        F.when(F.col("s_suppkey") % 4 == 0, ".<metadata>.<data_info>.<camera_info>.<")
        .when(F.col("s_suppkey") % 4 == 1, ".<metadata>.<data_info>.<joint_info>.<")
        .when(F.col("s_suppkey") % 4 == 2, ".<metadata>.<")
        .otherwise(".<")
    )
    field = F.concat(head, section, F.col("s_name"), F.lit(">.[<name>=<n"), key, F.lit(">].<type>"))
    other = F.concat(F.lit(".<plain>.<"), F.col("s_name"), F.lit(">"))
    suppliers = b.table(spark, d, "supplier")
    return suppliers.select(field.alias("field")).union(suppliers.select(other.alias("field")))


def w5_display_name(spark, d):
    return metadata_selectors(spark, d).select(
        "field", labels.display_name(F.col("field")).alias("field_name")
    )


W5_SQL = """WITH s AS (SELECT *, '.<report>.[<ruleCode>=<metadata_raw>].<rawDataMetric>.[<name>=<metadata.json>].<rawData>' AS head
 FROM supplier)
SELECT head || CASE s_suppkey % 4 WHEN 0 THEN '.<metadata>.<data_info>.<camera_info>.<'
  WHEN 1 THEN '.<metadata>.<data_info>.<joint_info>.<' WHEN 2 THEN '.<metadata>.<' ELSE '.<' END
  || s_name || '>.[<name>=<n' || s_suppkey || '>].<type>' AS field,
 CASE s_suppkey % 4 WHEN 3 THEN 'rawData-' ELSE '' END || s_name || '-name-n' || s_suppkey || '-type' AS field_name
FROM s
UNION ALL SELECT '.<plain>.<' || s_name || '>', s_name FROM s"""


def order_field_list(values: DataFrame) -> DataFrame:
    return values.select("model", "field").distinct()


def w6_field_type(spark, d):
    values = order_cells(spark, d)
    ranges = learn.learn_ranges(values, LearnParams(expand_pct=0.1)).filter(
        ~F.col("field").contains("<N>")
    )
    return warehouse.field_dim(order_field_list(values), ranges).select(
        "model", "field_id", "field", "type"
    )


W6_SQL = f"""WITH {sql.O_TEXT}, f AS (SELECT DISTINCT model, field FROM texts)
SELECT model, row_number() OVER (PARTITION BY model ORDER BY field) AS field_id, field,
 CASE WHEN contains(field, '<N>') THEN '' WHEN contains(field, 'metadata_raw') THEN 'non_numeric'
  ELSE 'numeric' END AS type FROM f"""


def event_star(spark, d) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(episodes, fields, fact) of the events."""
    # Fields and fact read the values once each, and queries the fields more often.
    values = settle(event_values(spark, d))
    fields = warehouse.field_dim(values.select("model", "field").distinct())
    fields = settle(fields.withColumn("type", F.lit("numeric")))
    return b.event_episodes(spark, d), fields, warehouse.field_value_fact(values, fields)


V_FACT = f"""{sql.V_EP}, {sql.V_CELLS},
fact AS (SELECT model, episode_id, CAST(CASE field WHEN '.<props>.<k>' THEN 1 ELSE 2 END AS BIGINT) AS field_id,
 field, x FROM cells)"""


def document_star(spark, d) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(episodes, fields, fact) of the documents; quality counts as non-numeric."""
    values = settle(document_values(spark, d))
    fields = warehouse.field_dim(values.select("model", "field").distinct()).withColumn(
        "type", F.when(F.col("field").contains("quality"), "non_numeric").otherwise("numeric")
    )
    fields = settle(fields)
    episodes = b.document_reports(spark, d).drop("raw").select(
        "*",
        F.concat(F.lit("s"), "area").alias("sn"),
        F.lit("2024-01-15").alias("collected_at"),
    )
    return episodes, fields, warehouse.field_value_fact(values, fields)


# .<labels>.<quality> 1, .<labels>.<toxic> 2, .<n_chars> 3
D_FACT = f"""{sql.D_CELLS},
fact AS (SELECT c.model, c.episode_id, dep.area, dep.taskid, 's' || dep.area AS sn,
 CAST(CASE field WHEN '.<labels>.<quality>' THEN 1 WHEN '.<labels>.<toxic>' THEN 2 ELSE 3 END AS BIGINT) AS field_id,
 field, x FROM cells c JOIN dep ON c.model = dep.model AND c.episode_id = dep.episode_id)"""


def w7_fact(spark, d):
    return document_star(spark, d)[2]


W7_SQL = f"""WITH {D_FACT} SELECT model, episode_id, field_id, CAST(CAST(x AS BIGINT) AS VARCHAR) AS value FROM fact"""


def w7_wide_to_long(spark, d):
    """Suppliers as a wide table, one column per field."""
    wide = b.table(spark, d, "supplier").select(
        F.col("s_nationkey").cast("string").alias("model"),
        F.col("s_suppkey").cast("string").alias("episode_id"),
        F.col("s_name").alias(".<name>"),
        F.when(F.col("s_suppkey") % 3 != 0, F.col("s_suppkey") * 2).alias(".<twice>"),
    )
    return warehouse.to_long(wide)


W7_LONG_SQL = """SELECT CAST(s_nationkey AS VARCHAR) AS model, CAST(s_suppkey AS VARCHAR) AS episode_id,
 '.<name>' AS field, s_name AS value FROM supplier
UNION ALL SELECT CAST(s_nationkey AS VARCHAR), CAST(s_suppkey AS VARCHAR), '.<twice>',
 CASE WHEN s_suppkey % 3 <> 0 THEN CAST(s_suppkey * 2 AS VARCHAR) END FROM supplier"""


def w8_thresholds(spark, d):
    values = order_cells(spark, d)
    ranges = learn.learn_ranges(values, LearnParams(expand_pct=0.1))
    return warehouse.thresholds(ranges, "base")


W8_SQL = (
    "WITH "
    + ",\n".join(
        [
            sql.O_CELLS,
            sql.cover(0.95),
            sql.sign("s1", "cover"),
            sql.expand("s2", "s1", 0.1),
            sql.keep_sign("s3", "s2"),
            sql.clamp("s4", "s3"),
        ]
    )
    + f""", out AS (
 SELECT model, field, CAST(round(lo, 6) AS VARCHAR) AS min, CAST(round(hi, 6) AS VARCHAR) AS max FROM s4
 UNION ALL SELECT DISTINCT model, '{sql.SN}', 'true', 'true' FROM ep
 UNION ALL SELECT DISTINCT model, '{sql.STATUS}', 'true', 'true' FROM ep)
SELECT *, CAST(NULL AS BIGINT) AS pass_count, CAST(NULL AS BIGINT) AS fail_count,
 CAST(NULL AS DOUBLE) AS pass_rate FROM out"""
)


def w9_extra_columns(spark, d):
    fields = warehouse.field_dim(part_field_list(spark, d)).select("model", "field_id", "field")
    with_null = warehouse.with_extra_columns(fields, {"note": None})
    return warehouse.with_extra_columns(with_null, {"unit": None}, default="none")


W9_SQL = f"""WITH {PART_DIM}
SELECT model, row_number() OVER (PARTITION BY model ORDER BY field) AS field_id, field,
 CAST(NULL AS VARCHAR) AS note, 'none' AS unit FROM pd"""


def w10_write_star(spark, d):
    """Write the event star, refresh it, and count what is read back."""
    episodes, fields, fact = event_star(spark, d)
    path = f"{shared_dir(spark)}/star-{uuid4().hex}"
    tables = {"episode": episodes, "field": fields, "field_value": fact}
    warehouse.write_star(tables, path)
    warehouse.write_star({"field": fields}, path)
    back = [
        warehouse.read_star(spark, path, name)
        .groupBy(F.col("model").cast("string").alias("model"))
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("table", F.lit(name))
        for name in tables
    ]
    return back[0].unionByName(back[1]).unionByName(back[2])


W10_SQL = f"""WITH {V_FACT}
SELECT model, count(*) AS n, 'episode' AS "table" FROM vep GROUP BY 1
UNION ALL SELECT model, count(*), 'field_value' FROM fact GROUP BY 1
UNION ALL SELECT model, count(DISTINCT field_id), 'field' FROM fact GROUP BY 1"""


def w11_documents(spark, d):
    """Orders from 1998 on arrive again with another document; the arriving one wins."""
    reports = b.order_reports(spark, d)
    stored = reports.select("model", "episode_id", "filename", F.col("raw").alias("json"))
    arriving = reports.filter("collected_at >= '1998-01-01'").select(
        "model",
        "episode_id",
        "filename",
        F.concat(F.lit('{"id":"'), "episode_id", F.lit('"}')).alias("json"),
    )
    merged = warehouse.latest_documents(stored, arriving)
    return merged.select(
        "model", "episode_id", "filename", F.get_json_object("json", "$.id").alias("id")
    )


W11_SQL = f"""WITH {sql.EP} SELECT model, episode_id, episode_id || '_collect.json' AS filename,
 CASE WHEN collected_at >= '1998-01-01' THEN episode_id END AS id FROM ep"""


def w12_integrity(spark, d):
    """Line items as values (orders as episodes, parts as fields): repeated keys, repeated names,
    and values of unknown episodes and fields show up. The tables are read whole; the episodes of pending
    orders and the fields of economy parts carry other keys, some without any, so their values are orphans."""
    one = F.lit("all").alias("model")
    lines = b.table(spark, d, "lineitem").select(
        one,
        F.col("l_orderkey").cast("string").alias("episode_id"),
        F.col("l_partkey").alias("field_id"),
    )
    order = F.col("o_orderkey")
    pending = F.when(order % 2 == 0, -order)
    episodes = b.table(spark, d, "orders").select(
        one, F.when(F.col("o_orderstatus") == "P", pending).otherwise(order).cast("string").alias("episode_id")
    )
    part = F.col("p_partkey")
    fields = b.table(spark, d, "part").select(
        one, F.when(F.col("p_type") == "ECONOMY", -part).otherwise(part).alias("field_id"), F.col("p_name").alias("field")
    )
    return warehouse.integrity_report({"field_value": lines, "episode": episodes, "field": fields})


W12_SQL = """WITH fv AS (SELECT l_orderkey AS e, l_partkey AS f FROM lineitem),
e AS (SELECT CASE WHEN o_orderstatus <> 'P' THEN o_orderkey WHEN o_orderkey % 2 = 0 THEN -o_orderkey END AS e FROM orders),
f AS (SELECT CASE WHEN p_type = 'ECONOMY' THEN -p_partkey ELSE p_partkey END AS f, p_name AS nm FROM part)
SELECT 'field_value' AS "table", 'duplicate_key' AS "check", count(*) AS violations FROM (SELECT e, f FROM fv GROUP BY 1, 2 HAVING count(*) > 1)
UNION ALL SELECT 'field_value', 'null_key', count(*) FROM fv WHERE e IS NULL OR f IS NULL
UNION ALL SELECT 'episode', 'duplicate_key', count(*) FROM (SELECT e FROM e GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'episode', 'null_key', count(*) FROM e WHERE e IS NULL
UNION ALL SELECT 'field', 'duplicate_key', count(*) FROM (SELECT f FROM f GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'field', 'null_key', count(*) FROM f WHERE f IS NULL
UNION ALL SELECT 'field', 'duplicate_field', count(*) FROM (SELECT nm FROM f GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'field_value', 'orphan_episode', count(*) FROM (SELECT DISTINCT e FROM fv WHERE e NOT IN (SELECT e FROM e WHERE e IS NOT NULL))
UNION ALL SELECT 'field_value', 'orphan_field', count(*) FROM (SELECT DISTINCT f FROM fv WHERE f NOT IN (SELECT f FROM f))"""

QUERIES = {
    "w1_episode_dim": w1_episode_dim,
    "w2_object_uri": w2_object_uri,
    "w3_field_dim": w3_field_dim,
    "w4_rule_code": w4_rule_code,
    "w5_display_name": w5_display_name,
    "w6_field_type": w6_field_type,
    "w7_fact": w7_fact,
    "w7_wide_to_long": w7_wide_to_long,
    "w8_thresholds": w8_thresholds,
    "w9_extra_columns": w9_extra_columns,
    "w10_write_star": w10_write_star,
    "w11_documents": w11_documents,
    "w12_integrity": w12_integrity,
}
SQL = {
    "w1_episode_dim": W1_SQL,
    "w2_object_uri": W2_SQL,
    "w3_field_dim": W3_SQL,
    "w4_rule_code": "SELECT p_type AS rule_code, count(*) AS fields FROM part GROUP BY 1",
    "w5_display_name": W5_SQL,
    "w6_field_type": W6_SQL,
    "w7_fact": W7_SQL,
    "w7_wide_to_long": W7_LONG_SQL,
    "w8_thresholds": W8_SQL,
    "w9_extra_columns": W9_SQL,
    "w10_write_star": W10_SQL,
    "w11_documents": W11_SQL,
    "w12_integrity": W12_SQL,
}


# --- drill-down ----------------------------------------------------------------------------------


def part_dim(spark, d):
    """Field dimension of the parts, with the name blanked for every third field."""
    fields = warehouse.field_dim(part_field_list(spark, d))
    return fields.withColumn(
        "field_name", F.when(F.col("field_id") % 3 == 0, " ").otherwise(F.col("field_name"))
    )


def x1_models(spark, d):
    return explore.list_models(part_dim(spark, d))


def x2_rule_codes(spark, d):
    return explore.list_rule_codes(part_dim(spark, d))


def x3_fields_of_rule(spark, d):
    return explore.fields_of_rule(part_dim(spark, d), "Brand#2", "ECONOMY").drop("type", "field_name")


def x4_search(spark, d):
    """Display names of all fields of all models, marking the one searched for."""
    fields = part_dim(spark, d)
    name = ".<report>.[<ruleCode>=<ECONOMY>].<rawDataMetric>.[<name>=<small ring>].<rawData>.<size_11>"
    found = explore.search_field(fields, "Brand#2", f" {name} ").select(
        F.lit("Brand#2").alias("model"), "field_id", F.lit(True).alias("found")
    )
    shown = explore.with_display_name(fields).join(found, ["model", "field_id"], "left")
    return shown.select("model", "field_id", "field", "display_name", "found")


X4_SQL = f"""WITH {PART_DIM},
dim AS (SELECT model, field, row_number() OVER (PARTITION BY model ORDER BY field) AS field_id FROM pd)
SELECT model, field_id, field, CASE WHEN field_id % 3 = 0 THEN field ELSE {_PART_NAME} END AS display_name,
 CASE WHEN model = 'Brand#2' AND contains(field, '<ECONOMY>') AND contains(field, '<small ring>') AND contains(field, '<size_11>') THEN true END AS found
FROM dim"""


def part_thresholds(spark, d):
    """Thresholds from part sizes and prices; some are marks, some are missing."""
    parts = part_fields(spark, d).join(
        b.table(spark, d, "part").select(F.col("p_partkey").alias("pos"), "p_size", "p_retailprice"),
        "pos",
    )
    keyed = parts.groupBy("model", "field").agg(
        F.min("p_size").alias("size"), F.min("p_retailprice").alias("price")
    )
    mark = F.col("size") % 5 == 0
    base = keyed.filter("size % 4 <> 0").select(
        "model",
        "field",
        F.when(mark, "true").otherwise(F.col("size").cast("string")).alias("min"),
        F.when(mark, "true").otherwise(F.col("price").cast("string")).alias("max"),
    )
    full = keyed.filter("size % 3 = 0").select(
        "model", "field", F.lit("0").alias("min"), F.when(F.col("size") % 2 == 0, "9.5").alias("max")
    )
    return base, full


def x5_thresholds(spark, d):
    base, full = part_thresholds(spark, d)
    return explore.threshold_lookup(part_dim(spark, d), base, full)


X5_SQL = f"""WITH {PART_FIELDS},
keyed AS (SELECT pf.model, pf.field, min(p_size) AS size, min(p_retailprice) AS price
 FROM pf JOIN part ON pf.pos = p_partkey GROUP BY 1, 2)
SELECT model, field, row_number() OVER (PARTITION BY model ORDER BY field) AS field_id,
 CASE WHEN size % 4 <> 0 AND size % 5 <> 0 THEN CAST(size AS DOUBLE) END AS base_lo,
 CASE WHEN size % 4 <> 0 AND size % 5 <> 0 THEN price END AS base_hi,
 CASE WHEN size % 3 = 0 THEN 0.0::DOUBLE END AS full_lo,
 CASE WHEN size % 3 = 0 AND size % 2 = 0 THEN 9.5::DOUBLE END AS full_hi,
 (size % 4 <> 0 AND size % 5 <> 0) OR size % 3 = 0 AS has_threshold FROM keyed"""


def x6_field_data(spark, d):
    episodes, _, fact = event_star(spark, d)
    window = explore.relative_window("7d", AS_OF)
    rows = explore.field_data(fact, episodes, [2], "click", window, ordered=True)
    return rows.withColumn("value", F.col("value").cast("double"))


X6_SQL = f"""WITH {V_FACT} SELECT f.model, f.episode_id, f.field_id, f.x AS value, sn, taskid, area, collected_at
FROM fact f JOIN vep ON f.model = vep.model AND f.episode_id = vep.episode_id
WHERE f.model = 'click' AND field_id = 2 AND ts >= '2024-01-23' AND ts < '2024-01-31'
ORDER BY collected_at, field_id"""


def x7_windows(spark, d):
    episodes = b.event_reports(spark, d).drop("raw")
    out = None
    for kind, days in (("7d", None), ("30d", None), ("90d", 3), ("all", 5), ("all", None)):
        window = explore.relative_window(kind, AS_OF, days)
        rows = episodes.filter(explore.in_window(F.col("collected_at"), window))
        rows = rows.groupBy("model").agg(F.count(F.lit(1)).alias("n"))
        rows = rows.withColumn("window", F.lit(f"{kind}:{days or ''}"))
        out = rows if out is None else out.unionByName(rows)
    return out


X7_SQL = """SELECT event_type AS model, count(*) AS n, '7d:' AS "window" FROM events
 WHERE ts >= '2024-01-23' AND ts < '2024-01-31' GROUP BY 1
UNION ALL SELECT event_type, count(*), '30d:' FROM events WHERE ts >= '2023-12-31' AND ts < '2024-01-31' GROUP BY 1
UNION ALL SELECT event_type, count(*), '90d:3' FROM events WHERE ts >= '2023-11-01' AND ts < '2024-01-31' GROUP BY 1
UNION ALL SELECT event_type, count(*), 'all:5' FROM events WHERE ts >= '2024-01-25' AND ts < '2024-01-31' GROUP BY 1
UNION ALL SELECT event_type, count(*), 'all:' FROM events GROUP BY 1"""


def x8_sample(spark, d):
    return explore.stratified_sample(b.order_episodes(spark, d), 35, "7")


X8_SQL = f"""WITH {sql.EP},
rk AS (SELECT model, taskid, episode_id,
 row_number() OVER (PARTITION BY model, taskid ORDER BY md5('7' || episode_id), episode_id) AS rn,
 count(*) OVER (PARTITION BY model, taskid) AS n FROM ep)
SELECT model, taskid, episode_id FROM rk WHERE rn <= greatest(1, floor(n * 0.35))"""


def x8_null_tasks(spark, d):
    """Quotas where tasks are NULL, ranked in one sort and in many chunks."""
    documents = b.document_reports(spark, d)
    labelled = b.table(spark, d, "labels").select(F.col("doc_id").cast("string").alias("episode_id"), F.lit(1).alias("known"))
    episodes = documents.join(labelled.distinct(), "episode_id", "left").withColumn(
        "taskid", F.when(F.col("known").isNotNull(), F.col("area"))
    )
    routes = [
        explore.stratified_sample(episodes, 50, "n", chunk_rows=rows).withColumn("route", F.lit(name))
        for name, rows in (("one sort", 1 << 20), ("chunks", 64))
    ]
    return routes[0].union(routes[1])


X8_NULL_SQL = """WITH ep AS (
 SELECT lang AS model, CASE WHEN l.doc_id IS NOT NULL THEN source END AS taskid,
        CAST(d.doc_id AS VARCHAR) AS episode_id
 FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l ON d.doc_id = l.doc_id),
rk AS (SELECT *, row_number() OVER (PARTITION BY model, taskid ORDER BY md5('n' || episode_id), episode_id) AS rn,
 count(*) OVER (PARTITION BY model, taskid) AS n FROM ep)
SELECT model, taskid, episode_id, route FROM rk, (VALUES ('one sort'), ('chunks')) r(route)
WHERE rn <= greatest(1, floor(n * 0.5))"""


def x9_filters(spark, d):
    episodes = b.order_episodes(spark, d)
    chosen = explore.stratified_sample(episodes, 50, "s")
    kept = explore.only_episodes(explore.exclude_areas(episodes, ["ASIA", "EUROPE"]), chosen)
    return kept.groupBy("model", "area").agg(F.count(F.lit(1)).alias("n"))


X9_SQL = f"""WITH {sql.EP},
rk AS (SELECT *, row_number() OVER (PARTITION BY model, taskid ORDER BY md5('s' || episode_id), episode_id) AS rn,
 count(*) OVER (PARTITION BY model, taskid) AS c FROM ep)
SELECT model, area, count(*) AS n FROM rk WHERE rn <= greatest(1, floor(c * 0.5)) AND area NOT IN ('ASIA', 'EUROPE')
GROUP BY 1, 2"""


def document_rows(spark, d):
    episodes, fields, fact = document_star(spark, d)
    return explore.field_data(fact, episodes), fields


def x10_plot_values(spark, d):
    rows, fields = document_rows(spark, d)
    shown = explore.series(explore.plot_values(rows, fields))
    return shown.select("model", "episode_id", "field_id", "value_num")


X10_SQL = f"""WITH {D_FACT} SELECT model, episode_id, field_id,
 CASE WHEN field_id = 1 THEN CASE WHEN x IS NULL THEN 1.0 ELSE 0.0 END ELSE x END::DOUBLE AS value_num
FROM fact WHERE field_id = 1 OR x IS NOT NULL"""


def x11_index(spark, d):
    """Places on the axis: per field by sn and task, and over all fields of a model by time."""
    episodes, fields, fact = event_star(spark, d)
    rows = explore.series(explore.plot_values(explore.field_data(fact, episodes), fields))
    rows = explore.with_time(rows).select("model", "episode_id", "field_id", "sn", "taskid", "_time")
    rows = settle(rows)
    single = explore.episode_index(rows, "sn", "taskid", settled=True)
    common = explore.model_axis(rows, "time", "week").withColumnRenamed("episode_index", "common_index")
    return single.select("model", "episode_id", "field_id", "episode_index").join(
        common, ["model", "episode_id"]
    )


X11_SQL = f"""WITH {V_FACT},
g AS (SELECT model, episode_id, row_number() OVER (PARTITION BY model ORDER BY date_trunc('second', ts), episode_id) AS common_index FROM vep)
SELECT f.model, f.episode_id, f.field_id,
 row_number() OVER (PARTITION BY f.model, f.field_id ORDER BY sn, taskid, date_trunc('second', ts), f.episode_id) AS episode_index,
 common_index
FROM fact f JOIN vep ON f.model = vep.model AND f.episode_id = vep.episode_id
JOIN g ON g.model = f.model AND g.episode_id = f.episode_id"""


def x12_labels(spark, d):
    episodes = b.order_episodes(spark, d)
    for by in ("sn", "taskid", "area", "day", "week", "month"):
        episodes = explore.with_group(episodes, by, f"by_{by}")
    return episodes.select("model", "episode_id", *[c for c in episodes.columns if c.startswith("by_")])


X12_SQL = f"""WITH {sql.EP} SELECT model, episode_id, area || ': ' || sn AS by_sn, taskid AS by_taskid, area AS by_area,
 collected_at AS by_day, strftime(CAST(collected_at AS DATE), '%Y-W%W') AS by_week, substr(collected_at, 1, 7) AS by_month
FROM ep"""


def _bounds(fields: DataFrame) -> DataFrame:
    """Base bounds for the document fields."""
    is_size = F.col("field").contains("n_chars")
    return fields.select(
        "model",
        "field_id",
        "field",
        F.when(is_size, 500.0).when(F.col("field").contains("toxic"), 0.0).alias("base_lo"),
        F.when(is_size, 5000.0).when(F.col("field").contains("toxic"), 0.0).alias("base_hi"),
        F.lit(None).cast("double").alias("full_lo"),
        F.lit(None).cast("double").alias("full_hi"),
        F.lit(True).alias("has_threshold"),
    )


def _rounded(stats: DataFrame) -> DataFrame:
    return stats.withColumns(
        {c: F.round(c, 4) for c in ("mean", "pass_rate", "missing_rate")}
    )


def x13_numeric_stats(spark, d):
    """All fields by area, numeric and text ones in one pass."""
    rows, fields = document_rows(spark, d)
    return _rounded(explore.group_stats(rows, fields, _bounds(fields), "area"))


def x14_text_stats(spark, d):
    """All fields by task, numeric and text ones in one pass."""
    rows, fields = document_rows(spark, d)
    return _rounded(explore.group_stats(rows, fields, _bounds(fields), "taskid"))


def _stats_sql(group: str) -> str:
    return f"""WITH {D_FACT},
b AS (SELECT *, CASE field_id WHEN 3 THEN 500 ELSE 0 END AS lo, CASE field_id WHEN 3 THEN 5000 ELSE 0 END AS hi
 FROM fact)
SELECT model, field_id, {group} AS group_key, CASE WHEN field_id <> 1 THEN round(avg(x), 4) END AS mean,
 CASE WHEN field_id = 1 THEN round(count(x) / count(*) * 100, 4)
  ELSE round(count(*) FILTER (x BETWEEN lo AND hi) / nullif(count(x), 0) * 100, 4) END AS pass_rate,
 CAST(count(*) FILTER (field_id = 1 AND x IS NOT NULL OR field_id <> 1 AND x BETWEEN lo AND hi) AS BIGINT) AS pass_count,
 CAST(count(*) FILTER (field_id <> 1 AND x NOT BETWEEN lo AND hi) AS BIGINT) AS fail_count,
 CAST(count(*) FILTER (x IS NULL) AS BIGINT) AS missing_count,
 round(count(*) FILTER (x IS NULL) / count(*) * 100, 4) AS missing_rate
FROM b GROUP BY 1, 2, 3"""


X13_SQL = _stats_sql("area")
X14_SQL = _stats_sql("taskid")


def indexed_documents(spark, d):
    rows, fields = document_rows(spark, d)
    drawn = explore.series(explore.plot_values(rows, fields))
    return explore.episode_index(drawn, "taskid", "area"), fields


def x15_legend(spark, d):
    rows, _ = indexed_documents(spark, d)
    return explore.legend(rows, "area")


def x15_segments(spark, d):
    rows, fields = indexed_documents(spark, d)
    return explore.threshold_segments(rows, _bounds(fields))


_INDEXED = f"""WITH {D_FACT},
ix AS (SELECT *, row_number() OVER (PARTITION BY model, field_id ORDER BY taskid, area, episode_id) AS i
 FROM fact WHERE field_id = 1 OR x IS NOT NULL)"""
X15_SQL = f"""{_INDEXED}, g AS (SELECT model, area AS group_key, min(i) AS first_index FROM ix GROUP BY 1, 2)
SELECT *, row_number() OVER (PARTITION BY model ORDER BY first_index, group_key) AS place FROM g"""
X15_SEG_SQL = f"""{_INDEXED}
SELECT model, field_id, min(i) AS first_index, max(i) AS last_index,
 CASE field_id WHEN 3 THEN 500.0 WHEN 2 THEN 0.0 END::DOUBLE AS base_lo,
 CASE field_id WHEN 3 THEN 5000.0 WHEN 2 THEN 0.0 END::DOUBLE AS base_hi,
 CAST(NULL AS DOUBLE) AS full_lo, CAST(NULL AS DOUBLE) AS full_hi FROM ix GROUP BY 1, 2"""


def x16_pages(spark, d):
    return explore.page_fields(part_dim(spark, d)).select(
        "model", "rule_code", "field", "place", "page", "pages"
    )


X16_SQL = f"""WITH {PART_DIM}, rk AS (SELECT model, {_PART_RULE} AS rule_code, field FROM pd)
SELECT *, CAST(row_number() OVER w AS INTEGER) AS place, CAST(ceil((row_number() OVER w) / 9) AS BIGINT) AS page,
 CAST(ceil(count(*) OVER (PARTITION BY model, rule_code) / 9) AS BIGINT) AS pages
FROM rk WINDOW w AS (PARTITION BY model, rule_code ORDER BY field)"""


def x17_detail(spark, d):
    """Attributes and document of one episode by key."""
    reports = b.order_reports(spark, d)
    detail = explore.episode_detail(reports, "FURNITURE", "0")
    return detail.select(
        "model", "episode_id", "taskid", "area", "sn", "collected_at", "filename",
        F.get_json_object("raw", "$.createdAt").alias("created_at"),
    )


X17_SQL = f"""WITH {sql.EP} SELECT model, episode_id, taskid, area, sn, collected_at,
 episode_id || '_collect.json' AS filename, collected_at AS created_at
FROM ep WHERE model = 'FURNITURE' AND episode_id = '0'"""

QUERIES |= {
    "x1_models": x1_models,
    "x2_rule_codes": x2_rule_codes,
    "x3_fields_of_rule": x3_fields_of_rule,
    "x4_search": x4_search,
    "x5_thresholds": x5_thresholds,
    "x6_field_data": x6_field_data,
    "x7_windows": x7_windows,
    "x8_sample": x8_sample,
    "x8_null_tasks": x8_null_tasks,
    "x9_filters": x9_filters,
    "x10_plot_values": x10_plot_values,
    "x11_index": x11_index,
    "x12_labels": x12_labels,
    "x13_numeric_stats": x13_numeric_stats,
    "x14_text_stats": x14_text_stats,
    "x15_legend": x15_legend,
    "x15_segments": x15_segments,
    "x16_pages": x16_pages,
    "x17_detail": x17_detail,
}
SQL |= {
    "x1_models": "SELECT DISTINCT p_brand AS model FROM part ORDER BY 1",
    "x2_rule_codes": "SELECT DISTINCT p_brand AS model, p_type AS rule_code FROM part ORDER BY 1, 2",
    "x3_fields_of_rule": f"""WITH {PART_DIM},
 dim AS (SELECT model, field, row_number() OVER (PARTITION BY model ORDER BY field) AS field_id FROM pd)
 SELECT field_id, field FROM dim WHERE model = 'Brand#2' AND contains(field, '<ruleCode>=<ECONOMY>') ORDER BY field""",
    "x4_search": X4_SQL,
    "x5_thresholds": X5_SQL,
    "x6_field_data": X6_SQL,
    "x7_windows": X7_SQL,
    "x8_sample": X8_SQL,
    "x8_null_tasks": X8_NULL_SQL,
    "x9_filters": X9_SQL,
    "x10_plot_values": X10_SQL,
    "x11_index": X11_SQL,
    "x12_labels": X12_SQL,
    "x13_numeric_stats": X13_SQL,
    "x14_text_stats": X14_SQL,
    "x15_legend": X15_SQL,
    "x15_segments": X15_SEG_SQL,
    "x16_pages": X16_SQL,
    "x17_detail": X17_SQL,
}
