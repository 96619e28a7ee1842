"""Queries for sources (S), field discovery (D), extraction (E) and publishing (P)."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldguard.functions import selectors as sel
from fieldguard.operators import discover, extract, flatten, learn, publish
from fieldguard.operators.discover import BlockRule, FieldFilter
from fieldguard.operators.learn import TextRule
from fieldguard.plans import oracle as sql
from fieldguard.plans.learning import PART_FIELDS, order_values, part_fields
from fieldguard.session import settle, shared_dir
from fieldguard.sources import bindings as b
from fieldguard.sources import landing
from fieldguard.sources import reports as src

# --- sources -------------------------------------------------------------------------------------


def nation_files(spark: SparkSession, d: str) -> str:
    """Write one report file per nation, holding figures over all its customers; returns the root."""
    nation = b.table(spark, d, "nation")
    region = b.table(spark, d, "region")
    figures = b.table(spark, d, "customer").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(
        F.count(F.lit(1)).alias("customers"), F.min("c_acctbal").alias("lowest")
    )
    root = f"{shared_dir(spark)}/scan-{uuid4().hex}"
    (
        nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .join(figures, "n_nationkey")
        .select(
            F.col("r_name").alias("model"),
            F.concat(F.lit("t"), F.col("n_nationkey") % 3).alias("taskid"),
            F.col("n_name").alias("episode"),
            F.col("n_name").alias("episodeId"),
            "customers",
            "lowest",
        )
        .repartition("model", "taskid", "episode")
        .write.partitionBy("model", "taskid", "episode")
        .json(root)
    )
    return root


def s1_scan(spark, d):
    scanned = src.scan_reports(spark, nation_files(spark, d))
    return scanned.select(
        F.get_json_object("raw", "$.episodeId").alias("nation"),
        F.get_json_object("raw", "$.customers").cast("bigint").alias("customers"),
        F.get_json_object("raw", "$.lowest").cast("double").alias("lowest"),
    )


def s2_path_keys(spark, d):
    scanned = src.with_path_keys(src.scan_reports(spark, nation_files(spark, d)))
    return scanned.select(
        "model", "taskid", "episode_id", F.get_json_object("raw", "$.customers").alias("customers")
    )


def s3_detect_model(spark, d):
    """Reports naming their model in one of two ways, or not at all, depending on the status."""
    rows = b.with_paths(b.order_episodes(spark, d))
    raw = (
        F.when(F.col("status") == "F", F.concat(F.lit('{"x":{"MODEL" : " '), "model", F.lit(': "}}')))
        .when(F.col("status") == "O", F.concat(F.lit('{"model":" ","robotModel":"r/'), "model", F.lit('"}')))
        .otherwise(F.lit('{"other":1}'))
    )
    path = F.concat_ws("/", "taskid", "episode_id")
    return src.detect_model(rows.select("taskid", path.alias("path"), raw.alias("raw")))


S3_SQL = f"""WITH {sql.EP}, f AS (SELECT *, row_number() OVER (PARTITION BY taskid ORDER BY taskid || '/' || episode_id) AS rn FROM ep)
SELECT taskid, CASE status WHEN 'F' THEN model || '_' WHEN 'O' THEN 'r_' || model ELSE 'MODEL_MISSING' END AS model
FROM f WHERE rn = 1"""


def s4_restrict_tasks(spark, d):
    """Only tasks of customers in debt, from a list with blanks and slashes around the names."""
    listed = b.table(spark, d, "customer").filter("c_acctbal < 0")
    listed = listed.select(F.concat(F.lit(" /c"), "c_custkey", F.lit("/ ")).alias("taskid"))
    blanks = b.table(spark, d, "region").select(F.lit("  ").alias("taskid"))
    kept = src.restrict_tasks(b.order_episodes(spark, d), src.clean_tasks(listed.union(blanks)))
    return kept.groupBy("model").agg(F.count(F.lit(1)).alias("n"))


S4_SQL = f"""WITH {sql.EP} SELECT model, count(*) AS n FROM ep
WHERE taskid IN (SELECT 'c' || c_custkey FROM customer WHERE c_acctbal < 0) GROUP BY 1"""


def _landed(spark, d):
    return landing.land_by_task(b.order_reports(spark, d), f"orders_{uuid4().hex}")


def s4_landed(spark, d):
    """Tasks of customers in debt, met in the buckets of landed reports; every document is looked at."""
    listed = b.table(spark, d, "customer").filter("c_acctbal < 0")
    tasks = src.clean_tasks(listed.select(F.concat(F.lit("c"), "c_custkey").alias("taskid")))
    kept = landing.restrict_tasks(_landed(spark, d), tasks, max_rows=0)
    same = F.get_json_object("raw", "$.episodeId") == F.col("episode_id")
    return kept.groupBy("model").agg(F.count(F.lit(1)).alias("n"), F.count_if(same).alias("whole"))


S4_LANDED_SQL = f"""WITH {sql.EP} SELECT model, count(*) AS n, count(*) AS whole FROM ep
WHERE taskid IN (SELECT 'c' || c_custkey FROM customer WHERE c_acctbal < 0) GROUP BY 1"""


def d7_landed(spark, d):
    """One landed report per task, fetched from its bucket."""
    picked = landing.sample_reports(_landed(spark, d), max_rows=0)
    return picked.select("model", "taskid", "path", F.get_json_object("raw", "$.episodeId").alias("episode"))


D7_LANDED_SQL = f"""WITH {sql.EP}, p AS (SELECT model, taskid, episode_id AS episode,
  model || '/' || taskid || '/' || episode_id || '/' || episode_id || '_collect.json' AS path FROM ep)
SELECT model, taskid, path, episode FROM p QUALIFY row_number() OVER (PARTITION BY model, taskid ORDER BY path) = 1"""


def s5_union_sources(spark, d):
    scans = {
        "shop": b.order_episodes(spark, d).select("model", "taskid", "episode_id"),
        "stream": b.event_reports(spark, d).select("model", "taskid", "episode_id"),
        "library": b.document_reports(spark, d).select("model", "taskid", "episode_id"),
    }
    areas = src.sources_of("all", list(scans))
    merged = src.union_sources({a: scans[a] for a in areas})
    return merged.groupBy("area", "model").agg(
        F.count(F.lit(1)).alias("reports"), F.count_distinct("taskid").alias("tasks")
    )


S5_SQL = f"""WITH {sql.EP}, {sql.V_EP}, {sql.D_EP},
u AS (SELECT 'shop' AS area, model, taskid FROM ep UNION ALL SELECT 'stream', model, taskid FROM vep
 UNION ALL SELECT 'library', model, taskid FROM dep)
SELECT area, model, count(*) AS reports, count(DISTINCT taskid) AS tasks FROM u GROUP BY 1, 2"""


def s6_conflicts(spark, d):
    """Tasks whose reports come from several sources (statuses stand in for sources)."""
    return src.landing_conflicts(b.order_episodes(spark, d).withColumn("area", F.col("status")))


S6_SQL = f"""WITH {sql.EP} SELECT model, taskid, count(DISTINCT status) AS sources FROM ep
GROUP BY 1, 2 HAVING count(DISTINCT status) > 1"""


def _task_area(spark, d):
    """Areas are recorded for tasks of customers without debt only."""
    return (
        b.order_episodes(spark, d)
        .select("taskid", "area")
        .distinct()
        .join(
            b.table(spark, d, "customer").filter("c_acctbal >= 0").select(
                F.concat(F.lit("c"), "c_custkey").alias("taskid")
            ),
            "taskid",
            "left_semi",
        )
    )


def s7_tag_area(spark, d):
    tagged = src.tag_area(b.order_episodes(spark, d), _task_area(spark, d))
    return tagged.groupBy("model", "area").agg(F.count(F.lit(1)).alias("n"))


_TAGGED = f"""WITH {sql.EP}, t AS (SELECT model, CASE WHEN c_acctbal >= 0 THEN area END AS area
 FROM ep JOIN customer ON taskid = 'c' || c_custkey)"""


def s8_filter_areas(spark, d):
    tagged = src.tag_area(b.order_episodes(spark, d), _task_area(spark, d), default=None)
    kept = src.filter_areas(tagged, ["ASIA", "AMERICA"])
    return kept.groupBy("model", "area").agg(F.count(F.lit(1)).alias("n"))


def s9_models(spark, d):
    """Reports not grouped yet sit under their task id, which looks like a model name."""
    rows = b.order_episodes(spark, d)
    name = F.when(F.col("status") == "P", F.md5("taskid")).otherwise(F.col("model"))
    return src.discover_models(rows.withColumn("model", name))


def s10_subset(spark, d):
    kept = src.filter_models(
        b.order_episodes(spark, d), skip=["HOUSEHOLD"], start_from="BUILDING"
    )
    return kept.groupBy("model").agg(F.count(F.lit(1)).alias("n"))


QUERIES = {
    "s1_scan": s1_scan,
    "s2_path_keys": s2_path_keys,
    "s3_detect_model": s3_detect_model,
    "s4_restrict_tasks": s4_restrict_tasks,
    "s4_landed": s4_landed,
    "d7_landed": d7_landed,
    "s5_union_sources": s5_union_sources,
    "s6_conflicts": s6_conflicts,
    "s7_tag_area": s7_tag_area,
    "s8_filter_areas": s8_filter_areas,
    "s9_models": s9_models,
    "s10_subset": s10_subset,
}
_FIGURES = """SELECT r_name, n_nationkey, n_name, count(*) AS customers, min(c_acctbal) AS lowest
 FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2, 3"""
SQL = {
    "s1_scan": f"SELECT n_name AS nation, customers, lowest FROM ({_FIGURES})",
    "s2_path_keys": f"""SELECT r_name AS model, 't' || (n_nationkey % 3) AS taskid, n_name AS episode_id,
 CAST(customers AS VARCHAR) AS customers FROM ({_FIGURES})""",
    "s3_detect_model": S3_SQL,
    "s4_restrict_tasks": S4_SQL,
    "s4_landed": S4_LANDED_SQL,
    "d7_landed": D7_LANDED_SQL,
    "s5_union_sources": S5_SQL,
    "s6_conflicts": S6_SQL,
    "s7_tag_area": f"{_TAGGED} SELECT model, coalesce(area, 'N/A') AS area, count(*) AS n FROM t GROUP BY 1, 2",
    "s8_filter_areas": f"{_TAGGED} SELECT model, area, count(*) AS n FROM t WHERE area IN ('ASIA', 'AMERICA') GROUP BY 1, 2",
    "s9_models": f"WITH {sql.EP} SELECT DISTINCT model FROM ep WHERE status <> 'P' ORDER BY 1",
    "s10_subset": f"WITH {sql.EP} SELECT model, count(*) AS n FROM ep WHERE model >= 'BUILDING' AND model <> 'HOUSEHOLD' GROUP BY 1",
}

# --- discovery -----------------------------------------------------------------------------------


def d1_flatten(spark, d):
    """Every leaf of every order report, counted per model and selector."""
    leaves = flatten.count_leaves(b.order_reports(spark, d), ("model",))
    return leaves.groupBy("model", "field").agg(F.sum("n").alias("n"), F.count("value").alias("kinds"))


_LINE = ".<report>.[<ruleCode>=<line_stats>]"
_META = ".<report>.[<ruleCode>=<metadata_raw>]"
_MFILE = f"{_META}.<rawDataMetric>.[<name>=<metadata.json>]"
D1_SQL = f"""WITH {sql.EP}, {sql.M},
leaf AS (
 SELECT model, '.<episodeId>' AS field, episode_id AS value FROM ep
 UNION ALL SELECT model, '.<createdAt>', collected_at FROM ep
 UNION ALL SELECT model, '{_LINE}.<ruleCode>', 'line_stats' FROM ep
 UNION ALL SELECT model, '{_LINE}.<rawDataMetric>', '[]' FROM ep
  WHERE episode_id NOT IN (SELECT episode_id FROM m)
 UNION ALL SELECT model, '{_LINE}.<rawDataMetric>.[<name>=<' || flag || '>].<name>', flag
  FROM ep JOIN m ON m.episode_id = ep.episode_id
 UNION ALL SELECT model, '{_LINE}.<rawDataMetric>.[<name>=<' || flag || '>].<rawData>.<fps>', CAST(fps AS VARCHAR)
  FROM ep JOIN m ON m.episode_id = ep.episode_id
 UNION ALL SELECT model, '{_LINE}.<rawDataMetric>.[<name>=<' || flag || '>].<rawData>.<loss>', CAST(loss AS VARCHAR)
  FROM ep JOIN m ON m.episode_id = ep.episode_id
 UNION ALL SELECT model, '{_META}.<ruleCode>', 'metadata_raw' FROM ep
 UNION ALL SELECT model, '{_MFILE}.<name>', 'metadata.json' FROM ep
 UNION ALL SELECT model, '{_MFILE}.<rawData>.<status>', status FROM ep
 UNION ALL SELECT model, '{_MFILE}.<rawData>.<sn>', sn FROM ep)
SELECT model, field, count(*) AS n, count(DISTINCT value) AS kinds FROM leaf GROUP BY 1, 2"""


def d2_escape(spark, d):
    """Whole pages as tokens: markup is full of characters to escape."""
    pages = b.table(spark, d, "pages")
    text = sel.token(F.concat(F.col("html"), F.lit("\\>"), F.col("url")))
    return pages.select("page_id", F.md5(text).alias("digest"), F.length(text).alias("size"))


D2_SQL = r"""SELECT page_id, md5(t) AS digest, CAST(length(t) AS INTEGER) AS size FROM (
 SELECT page_id, '<' || replace(replace(html || '\>' || url, '\', '\\'), '>', '\>') || '>' AS t FROM pages)"""

_TOKENS = ("ECONOMY", "small ring", "size_7")
_SEQUENCES = (("STANDARD", "ring"), ("size_1", "<ruleCode>"), ("PROMO",))


def d3_tokens(spark, d):
    field = F.col("field")
    return part_fields(spark, d).select(
        "pos",
        discover.tokens_allowed(field, _TOKENS).alias("exact"),
        discover.tokens_allowed(field, _TOKENS, "contains").alias("inside"),
    )


D3_SQL = f"""WITH {PART_FIELDS} SELECT pos,
 list_has_any(regexp_extract_all(field, '<([^<>]+)>', 1), ['ECONOMY', 'small ring', 'size_7']) AS exact,
 contains(field, 'ECONOMY') OR contains(field, 'small ring') OR contains(field, 'size_7') AS inside FROM pf"""


def d4_sequences(spark, d):
    field = F.col("field")
    folded = [["standard", "RING"], ["Size_1"]]
    return part_fields(spark, d).select(
        "pos",
        discover.sequences_allowed(field, _SEQUENCES).alias("together"),
        discover.sequences_allowed(field, _SEQUENCES, "ordered").alias("in_order"),
        discover.sequences_allowed(field, [["<size_", "4"], ["[<name>", "=<big"]], "adjacent").alias("adjacent"),
        discover.sequences_allowed(field, folded, "both", False).alias("folded"),
    )


D4_SQL = f"""WITH {PART_FIELDS} SELECT pos,
 (contains(field, 'STANDARD') AND contains(field, 'ring')) OR (contains(field, 'size_1') AND contains(field, '<ruleCode>'))
  OR contains(field, 'PROMO') AS together,
 regexp_matches(field, 'STANDARD.*ring') OR regexp_matches(field, 'size_1.*<ruleCode>') OR contains(field, 'PROMO') AS in_order,
 contains(field, '<size_4') OR contains(field, '[<name>=<big') AS adjacent,
 (contains(lower(field), 'standard') AND contains(lower(field), 'ring')) OR contains(lower(field), 'size_1') AS folded FROM pf"""

_BLOCK = (
    BlockRule(["ring", "size_3"]),
    BlockRule(["ECONOMY"], ["BRAND#2", "brand#11"]),
    BlockRule([], ["Brand#3"]),
)
_BLOCK_SQL = """((contains(field, 'ring') AND contains(field, 'size_3'))
 OR (contains(field, 'ECONOMY') AND model IN ('Brand#2', 'Brand#11')))"""


def d5_block(spark, d):
    fields = part_fields(spark, d)
    return fields.filter(~discover.blocked(F.col("field"), F.col("model"), _BLOCK))


def d6_filter(spark, d):
    """The full filter, and three ways of leaving the allow lists out."""
    fields = part_fields(spark, d)
    field, model = F.col("field"), F.col("model")
    settings = {
        "full": FieldFilter(tokens=_TOKENS, sequences=_SEQUENCES, sequence_mode="ordered", block=_BLOCK),
        "all": FieldFilter(block=_BLOCK),
        "none": FieldFilter(block=_BLOCK, allow_all_if_empty=False),
        "off": FieldFilter(tokens=_TOKENS, use_tokens=False, use_block=False, block=_BLOCK),
    }
    return fields.select(
        "pos", *[discover.keeps(field, model, s).alias(f"kept_{n}") for n, s in settings.items()]
    )


D6_SQL = f"""WITH {PART_FIELDS} SELECT pos,
 (list_has_any(regexp_extract_all(field, '<([^<>]+)>', 1), ['ECONOMY', 'small ring', 'size_7'])
  OR regexp_matches(field, 'STANDARD.*ring') OR regexp_matches(field, 'size_1.*<ruleCode>') OR contains(field, 'PROMO'))
  AND NOT {_BLOCK_SQL} AS kept_full,
 NOT {_BLOCK_SQL} AS kept_all, false AS kept_none, false AS kept_off FROM pf"""


def d7_sample(spark, d):
    """One report per task; some tasks hold files of the other suffix only."""
    reports = b.order_reports(spark, d)
    plain = F.regexp_replace("path", "_collect.json$", ".json")
    path = F.when(F.col("episode_id").cast("bigint") % 3 == 0, plain).otherwise(F.col("path"))
    reports = reports.withColumn("path", path)
    picked = discover.sample_reports(reports).select("model", "taskid", "path", F.md5("raw").alias("got"))
    own = reports.select("path", F.md5("raw").alias("want"))
    return picked.join(own, "path").select(
        "model", "taskid", "path", F.col("got").eqNullSafe(F.col("want")).alias("fetched")
    )


D7_SQL = f"""WITH {sql.EP}, p AS (SELECT model, taskid, model || '/' || taskid || '/' || episode_id || '/' || episode_id
  || CASE WHEN CAST(episode_id AS BIGINT) % 3 = 0 THEN '.json' ELSE '_collect.json' END AS path FROM ep)
SELECT model, taskid, path, true AS fetched FROM p
QUALIFY row_number() OVER (PARTITION BY model, taskid ORDER BY (path NOT LIKE '%\\_collect.json' ESCAPE '\\'), path) = 1"""

_DOC_SAMPLE = f"""WITH {sql.D_EP},
smp AS (SELECT *, model || '/' || taskid || '/' || episode_id || '/' || episode_id || '_collect.json' AS path FROM dep
 QUALIFY row_number() OVER (PARTITION BY model, taskid ORDER BY path) = 1),
tf AS (SELECT model, taskid, '.<n_chars>' AS field FROM smp
 UNION ALL SELECT model, taskid, '.<labels>.<quality>' FROM smp WHERE quality IS NOT NULL
 UNION ALL SELECT model, taskid, '.<labels>.<toxic>' FROM smp WHERE toxic IS NOT NULL),
tasks AS (SELECT model, count(*) AS tasks FROM smp GROUP BY 1),
un AS (SELECT tf.model, field, count(*) AS tasks_with_field, tasks FROM tf JOIN tasks ON tf.model = tasks.model GROUP BY 1, 2, 4)"""


def document_samples(spark, d):
    return discover.sample_reports(b.document_reports(spark, d))


def d8_union(spark, d):
    return discover.union_fields(document_samples(spark, d))


def d9_presence(spark, d):
    return discover.union_fields(
        document_samples(spark, d), min_ratio=0.4, ratio_by_model={"en": 0.9, "de": 0.1}
    )


def d10_consistency(spark, d):
    """Fields of every task against those of one sample per model."""
    reports = b.document_reports(spark, d)
    base = discover.task_fields(discover.sample_reports(reports, ["model"]))
    per_task = discover.task_fields(discover.sample_reports(reports))
    return discover.field_set_diff(per_task, base.select("model", "field"))


D10_SQL = f"""{_DOC_SAMPLE},
b1 AS (SELECT *, row_number() OVER (PARTITION BY model ORDER BY path) AS rn FROM smp),
bt AS (SELECT tf.model, tf.field FROM tf JOIN b1 ON tf.model = b1.model AND tf.taskid = b1.taskid AND b1.rn = 1),
diff AS (
 SELECT smp.model, smp.taskid, 'base' AS side, bt.field FROM smp JOIN bt ON smp.model = bt.model
  WHERE NOT EXISTS (SELECT 1 FROM tf WHERE tf.model = smp.model AND tf.taskid = smp.taskid AND tf.field = bt.field)
 UNION ALL SELECT tf.model, tf.taskid, 'sample', tf.field FROM tf
  WHERE NOT EXISTS (SELECT 1 FROM bt WHERE bt.model = tf.model AND bt.field = tf.field))
SELECT *, CAST(row_number() OVER (PARTITION BY model, taskid, side ORDER BY field) AS INTEGER) AS place FROM diff"""


def d11_clean_list(spark, d):
    """Part names as a hand-kept list: quotes, commas, blanks and comments in turn."""
    key, name = F.col("p_partkey"), F.col("p_name")
    line = (
        F.when(key % 5 == 0, F.concat(F.lit("  # "), name))
        .when(key % 5 == 1, F.concat(F.lit('  "'), name, F.lit('",')))
        .when(key % 5 == 2, F.concat(F.lit("'"), name, F.lit("' ,")))
        .when(key % 5 == 3, F.lit("   "))
        .otherwise(F.concat(F.lit('\\"'), name, F.lit('\\" ')))
    )
    lines = b.table(spark, d, "part").select(
        F.col("p_brand").alias("model"), key.alias("pos"), line.alias("line")
    )
    return discover.clean_field_list(lines)


D11_SQL = """WITH l AS (SELECT p_brand AS model, p_partkey AS pos,
 CASE WHEN p_partkey % 5 = 4 THEN '"' || p_name || '"' ELSE p_name END AS field
 FROM part WHERE p_partkey % 5 IN (1, 2, 4))
SELECT model, field, min(pos) AS pos FROM l GROUP BY 1, 2"""

QUERIES |= {
    "d1_flatten": d1_flatten,
    "d2_escape": d2_escape,
    "d3_tokens": d3_tokens,
    "d4_sequences": d4_sequences,
    "d5_block": d5_block,
    "d6_filter": d6_filter,
    "d7_sample": d7_sample,
    "d8_union": d8_union,
    "d9_presence": d9_presence,
    "d10_consistency": d10_consistency,
    "d11_clean_list": d11_clean_list,
}
SQL |= {
    "d1_flatten": D1_SQL,
    "d2_escape": D2_SQL,
    "d3_tokens": D3_SQL,
    "d4_sequences": D4_SQL,
    "d5_block": f"WITH {PART_FIELDS} SELECT * FROM pf WHERE NOT {_BLOCK_SQL}",
    "d6_filter": D6_SQL,
    "d7_sample": D7_SQL,
    "d8_union": f"{_DOC_SAMPLE} SELECT * FROM un",
    "d9_presence": f"""{_DOC_SAMPLE} SELECT * FROM un WHERE tasks_with_field / tasks >=
 CASE model WHEN 'en' THEN 0.9 WHEN 'de' THEN 0.1 ELSE 0.4 END""",
    "d10_consistency": D10_SQL,
    "d11_clean_list": D11_SQL,
}

# --- extraction ----------------------------------------------------------------------------------


def e1_extract(spark, d):
    return order_values(spark, d)


def e2_selector_forms(spark, d):
    """Bare names, positions, unquoted filters and a filter below a position."""
    columns = {
        "first_flag": ".report.(0).<rawDataMetric>.(0).<name>",
        "second_fps": ".<report>.( 0 ).<rawDataMetric>.(1).<rawData>.<fps>",
        "status": ".report.[ruleCode=metadata_raw].rawDataMetric.(0).rawData.status",
        "metric": ".<report>.(0).<rawDataMetric>.[<name>=<R>].<rawData>",
        "beyond": ".<report>.(9).<ruleCode>",
        "negative": ".<report>.(-1).<ruleCode>",
    }
    return extract.select_cells(
        b.order_reports(spark, d), columns, keep=["model", "episode_id"], default=None
    )


E2_SQL = f"""WITH {sql.EP}, {sql.M},
o AS (SELECT *, row_number() OVER (PARTITION BY episode_id ORDER BY flag) AS rn FROM m)
SELECT ep.model, ep.episode_id, o1.flag AS first_flag, CAST(o2.fps AS VARCHAR) AS second_fps, status,
 '{{"fps":' || r.fps || ',"loss":' || r.loss || '}}' AS metric,
 CAST(NULL AS VARCHAR) AS beyond, CAST(NULL AS VARCHAR) AS negative
FROM ep LEFT JOIN o o1 ON o1.episode_id = ep.episode_id AND o1.rn = 1
LEFT JOIN o o2 ON o2.episode_id = ep.episode_id AND o2.rn = 2
LEFT JOIN m r ON r.episode_id = ep.episode_id AND r.flag = 'R'"""


def typed_reports(spark, d):
    """Events with three candidates for the same discriminator: a number and twice its text."""
    k = F.get_json_object("props", "$.k")
    raw = F.concat(
        F.lit('{"items":[7,{"t":'), k, F.lit(',"v":"number"},{"t":"'), k,
        F.lit('","v":"first"},{"v":"none"},{"t":"'), k, F.lit('","v":"second"}]}'),
    )
    events = b.table(spark, d, "events").select("event_type", "event_id", "props")
    return b.spread(events, "event_id").select(
        F.col("event_type").alias("model"), F.col("event_id").cast("string").alias("episode_id"),
        raw.alias("raw"),
    )


def e3_typed_filter(spark, d):
    fields = [".<items>.[<t>=<50>].<v>", ".<items>.[t=50].<v>"]
    values = extract.extract_values(typed_reports(spark, d), fields)
    return values.groupBy("model", "field", "value").agg(F.count(F.lit(1)).alias("n"))


E3_SQL = """WITH k AS (SELECT event_type AS model, CAST(json_extract_string(props, '$.k') AS INT) = 50 AS hit FROM events),
v AS (SELECT model, '.<items>.[<t>=<50>].<v>' AS field, CASE WHEN hit THEN 'first' END AS value FROM k
 UNION ALL SELECT model, '.<items>.[t=50].<v>', CASE WHEN hit THEN 'number' END FROM k)
SELECT model, field, value, count(*) AS n FROM v GROUP BY 1, 2, 3"""


def e4_text_filter(spark, d):
    cells = extract.select_cells(
        typed_reports(spark, d), {"value": ".<items>.[<t>=<50>].<v>"}, keep=["model", "episode_id"]
    )
    return cells.groupBy("model", "value").agg(F.count(F.lit(1)).alias("n"))


E4_SQL = """SELECT event_type AS model,
 CASE WHEN CAST(json_extract_string(props, '$.k') AS INT) = 50 THEN 'number' ELSE 'N/A' END AS value, count(*) AS n
FROM events GROUP BY 1, 2"""


def e5_cells(spark, d):
    """Text form of every kind of JSON value."""
    k, value = F.get_json_object("props", "$.k"), F.col("value").cast("string")
    raw = F.concat(
        F.lit('{"null":null,"list":['), k, F.lit(',"a"],"object":{"k":'), k, F.lit('},"flag":true,"text":"x '), k,
        F.lit('","number":'), value, F.lit(',"empty":{},"nan":NaN}'),
    )
    rows = b.table(spark, d, "events").select(
        F.col("event_type").alias("model"), F.col("event_id").cast("string").alias("episode_id"), raw.alias("raw")
    )
    names = ["null", "list", "object", "flag", "text", "number", "empty", "nan"]
    return extract.select_cells(
        rows, {f"as_{n}": f".<{n}>" for n in names}, keep=["model", "episode_id"], match="typed", default=None
    ).withColumn("as_number", F.col("as_number").cast("double"))


E5_SQL = """WITH k AS (SELECT *, json_extract_string(props, '$.k') AS k FROM events)
SELECT event_type AS model, CAST(event_id AS VARCHAR) AS episode_id, CAST(NULL AS VARCHAR) AS as_null,
 '[' || k || ',"a"]' AS as_list, '{"k":' || k || '}' AS as_object, 'true' AS as_flag, 'x ' || k AS as_text,
 value AS as_number, '{}' AS as_empty, 'NaN' AS as_nan FROM k"""


def e6_empty_fields(spark, d):
    """Fields nobody fills disappear; so do labels in languages without any."""
    fields = [*b.DOCUMENT_FIELDS, ".<nothing>", ".<labels>.<nothing>"]
    values = extract.extract_values(b.document_reports(spark, d), fields)
    return extract.drop_empty_fields(values).groupBy("model", "field").agg(F.count(F.lit(1)).alias("n"))


E6_SQL = f"""WITH {sql.D_CELLS} SELECT model, field, count(*) AS n FROM cells GROUP BY 1, 2 HAVING count(x) > 0"""


def e7_long(spark, d):
    values = extract.drop_empty_cells(order_values(spark, d))
    return values.withColumn("field_file", extract.safe_name(F.col("field"))).groupBy(
        "model", "field_file"
    ).agg(F.count(F.lit(1)).alias("n"))


E7_SQL = rf"""WITH {sql.O_TEXT} SELECT model, substr(regexp_replace(field, '[<>:"/\\|?*\[\]=.]', '_', 'g'), 1, 120) AS field_file,
 count(*) AS n FROM texts WHERE value IS NOT NULL GROUP BY 1, 2"""


def e8_lenient(spark, d):
    """Broken reports are left out; selectors that are none give NULL."""
    reports = b.event_reports(spark, d)
    broken = F.when(F.col("model") == "error", F.lit("not json")).when(
        F.col("taskid").cast("bigint") % 10 == 0, F.concat("raw", F.lit(",")).substr(F.lit(1), F.length("raw") - 1)
    )
    reports = reports.withColumn("raw", F.coalesce(broken, "raw"))
    values = extract.extract_values(reports, [".<value>", "no selector", ".<props>.<k>"])
    return values.groupBy("model", "field").agg(F.count(F.lit(1)).alias("n"), F.count("value").alias("filled"))


E8_SQL = """WITH e AS (SELECT event_type AS model FROM events WHERE event_type <> 'error' AND user_id % 10 <> 0)
SELECT model, field, count(*) AS n, CASE WHEN field = 'no selector' THEN 0 ELSE count(*) END AS filled
FROM e CROSS JOIN (VALUES ('.<value>'), ('no selector'), ('.<props>.<k>')) f(field) GROUP BY 1, 2"""


def e9_info(spark, d):
    extra = [
        {"column_name": "status", "selector": b.METADATA.format(leaf="status")},
        {"column_name": "fps", "selector": b.NUMERIC_FIELDS[1], "models": ["BUILDING", "FURNITURE"]},
    ]
    return extract.episode_info(
        b.order_reports(spark, d), extra, sn_selector=b.METADATA.format(leaf="sn")
    )


E9_SQL = f"""WITH {sql.EP}, {sql.M} SELECT ep.episode_id || '_collect.json' AS file, ep.episode_id AS "episodeId", taskid, model,
 sn AS "SN", collected_at AS "createdAt", status,
 CASE WHEN model IN ('BUILDING', 'FURNITURE') THEN coalesce(CAST(fps AS VARCHAR), 'N/A') END AS fps
FROM ep LEFT JOIN m ON m.episode_id = ep.episode_id AND flag = 'N'"""

QUERIES |= {
    "e1_extract": e1_extract,
    "e2_selector_forms": e2_selector_forms,
    "e3_typed_filter": e3_typed_filter,
    "e4_text_filter": e4_text_filter,
    "e5_cells": e5_cells,
    "e6_empty_fields": e6_empty_fields,
    "e7_long": e7_long,
    "e8_lenient": e8_lenient,
    "e9_info": e9_info,
}
SQL |= {
    "e1_extract": f"WITH {sql.O_TEXT} SELECT model, episode_id, field, value FROM texts",
    "e2_selector_forms": E2_SQL,
    "e3_typed_filter": E3_SQL,
    "e4_text_filter": E4_SQL,
    "e5_cells": E5_SQL,
    "e6_empty_fields": E6_SQL,
    "e7_long": E7_SQL,
    "e8_lenient": E8_SQL,
    "e9_info": E9_SQL,
}

# --- publishing ----------------------------------------------------------------------------------


def order_ranges(spark, d) -> DataFrame:
    """Observed ranges of the numeric order fields, and their metadata marked as text: one aggregate, no ranks."""
    forced = learn.is_forced_non_numeric(F.col("model"), F.col("field"), [TextRule(["metadata_raw"])])
    found = learn.observed(order_values(spark, d)).withColumn("_text", forced | (F.col("n") == 0))
    bound = lambda c: F.when(~F.col("_text"), F.round(c, 6))
    return found.select(
        "model", F.lit("base").alias("variant"), "field", bound("smallest").alias("lo"), bound("largest").alias("hi"),
        F.col("_text").alias("is_non_numeric"),
    )


_PACKED = f"""WITH {sql.O_TEXT},
lines AS (SELECT model, field, field || ',' || coalesce(CAST(min(x) AS VARCHAR), 'true') || ','
  || coalesce(CAST(max(x) AS VARCHAR), 'true') AS line FROM texts GROUP BY 1, 2),
packed AS (SELECT model, 'base' AS variant,
 replace(replace('field,min,max' || chr(10) || string_agg(line, chr(10) ORDER BY field) || chr(10), '\\', '\\\\'), chr(10), '\\n') AS literal
 FROM lines GROUP BY 1)"""


def p1_pack(spark, d):
    packed = publish.pack_ranges(order_ranges(spark, d))
    back = publish.unescape_literal(F.col("literal"))
    return packed.withColumn("lines", F.size(F.split(back, "\n")) - 1)


def p1_escape(spark, d):
    """Documents and pages as literals, and back: whole texts, whatever they hold."""
    texts = b.table(spark, d, "documents").select(F.col("doc_id").alias("id"), "text").union(
        b.table(spark, d, "pages").select("page_id", F.concat("html", F.lit("\\n \\ \r\n"), "url"))
    )
    literal = publish.escape_literal(F.col("text"))
    plain = F.replace(F.replace("text", F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))
    return texts.select(
        "id",
        F.md5(literal).alias("digest"),
        (publish.unescape_literal(literal) == plain).alias("reversible"),
    )


P1E_SQL = r"""WITH t AS (SELECT doc_id AS id, text FROM documents
 UNION ALL SELECT page_id, html || '\n \ ' || chr(13) || chr(10) || url FROM pages)
SELECT id, md5(replace(replace(replace(replace(text, '\', '\\'), chr(13) || chr(10), chr(10)), chr(13), chr(10)), chr(10), '\n')) AS digest,
 true AS reversible FROM t"""


def p2_update(spark, d):
    return publish.update_statements(publish.pack_ranges(order_ranges(spark, d)))


P2_SQL = f"""{_PACKED} SELECT model, variant,
 'UPDATE rule_config SET payload_json=''' || replace(literal, '''', '''''') || ''' WHERE model=''' || model || ''';' AS statement
FROM packed"""


def p3_export(spark, d):
    """Write a new version model by model, then read every export at its recorded path."""
    ranges = settle(order_ranges(spark, d))
    root = f"{shared_dir(spark)}/export-{uuid4().hex}"
    tag = "20240130_120000"
    first = ranges.filter("model < 'C'")
    noted = [
        tuple(r)
        for part in (first, ranges.filter("NOT model < 'C'"))
        for r in publish.export_version(part, root, tag).collect()
    ]
    back = None
    for model, variant, path in noted:
        own = spark.read.option("header", True).option("escape", '"').csv(f"{root}/{path}")
        own = own.agg(F.count("field").alias("fields")).select(
            F.lit(model).alias("model"), F.lit(variant).alias("variant"), F.lit(tag).alias("version"),
            "fields", F.lit(path).alias("last_path"),
        )
        back = own if back is None else back.union(own)
    return back


P3_SQL = f"""{_PACKED} SELECT model, 'base' AS variant, '20240130_120000' AS version, count(*) AS fields,
 'range/' || model || '/base/20240130_120000' AS last_path FROM lines GROUP BY 1"""


def order_ids(spark, d) -> DataFrame:
    """Rule ids from the regions' and customers' tables; some entries are unusable."""
    segments = b.table(spark, d, "customer").groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"))
    listed = segments.select(
        F.when(F.col("c_mktsegment") == "MACHINERY", "x1").otherwise(F.col("n").cast("string")).alias("id_text"),
        F.concat(F.lit(" "), "c_mktsegment").alias("model"),
        F.lit(1).alias("pos"),
    )
    return publish.reversed_ids(listed)


def p4_payload(spark, d):
    ranges = order_ranges(spark, d)
    packed = publish.pack_ranges(ranges)
    paths = publish.manifest(ranges, "20240130_120000")
    return publish.payload_rows(packed, order_ids(spark, d), paths)


def p4_missing(spark, d):
    return publish.missing_ids(publish.pack_ranges(order_ranges(spark, d)), order_ids(spark, d))


P4_SQL = f"""{_PACKED},
ids AS (SELECT c_mktsegment AS model, count(*) AS rule_id FROM customer WHERE c_mktsegment <> 'MACHINERY' GROUP BY 1),
content AS (SELECT model, 'config' AS key, literal AS text FROM packed
 UNION ALL SELECT model, 'csvPath', 'range/' || model || '/base/20240130_120000' FROM packed)
SELECT content.model, rule_id, key, '{{"id":' || rule_id || ',"' || key || '":"' || replace(replace(text, '\\', '\\\\'), '"', '\\"') || '"}}' AS body
FROM content JOIN ids ON content.model = ids.model"""

QUERIES |= {
    "p1_pack": p1_pack,
    "p1_escape": p1_escape,
    "p2_update": p2_update,
    "p3_export": p3_export,
    "p4_payload": p4_payload,
    "p4_missing": p4_missing,
}
SQL |= {
    "p1_pack": f"{_PACKED} SELECT model, variant, literal, CAST((SELECT count(*) + 1 FROM lines l WHERE l.model = packed.model) AS INTEGER) AS lines FROM packed",
    "p1_escape": P1E_SQL,
    "p2_update": P2_SQL,
    "p3_export": P3_SQL,
    "p4_payload": P4_SQL,
    "p4_missing": "SELECT 'MACHINERY' AS model FROM customer WHERE c_mktsegment = 'MACHINERY' GROUP BY 1",
}
