"""Queries for range learning (R) and declared ranges (F)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldguard.functions.intervals import BoundRule
from fieldguard.operators import declare, learn
from fieldguard.operators.extract import count_cells, extract_values
from fieldguard.operators.learn import LearnParams, TextRule
from fieldguard.plans import oracle as sql
from fieldguard.session import settle
from fieldguard.sources import bindings as b

Query = Callable[[SparkSession, str], DataFrame]

# Nothing but the stage under test changes the ranges.
PLAIN = dict(
    sign_clamp=False,
    post_expand_sign_clamp=False,
    clamp_to_observed=False,
    region_adjust=False,
    expand_pct=0.0,
    round_decimals=None,
)


def order_values(spark: SparkSession, d: str, fields=b.ORDER_FIELDS) -> DataFrame:
    return extract_values(b.order_reports(spark, d), fields)


def order_cells(spark: SparkSession, d: str) -> DataFrame:
    """The counted values of the order reports, written once for all that is done with them."""
    return settle(count_cells(order_values(spark, d)))


def event_values(spark: SparkSession, d: str) -> DataFrame:
    return extract_values(b.event_reports(spark, d), b.EVENT_FIELDS)


def document_values(spark: SparkSession, d: str) -> DataFrame:
    return extract_values(b.document_reports(spark, d), b.DOCUMENT_FIELDS)


def balance_values(spark: SparkSession, d: str) -> DataFrame:
    """Values of either sign: balances, debts and event values."""
    customer = b.table(spark, d, "customer")
    events = b.table(spark, d, "events")
    owner = F.concat(F.lit("c"), F.col("c_custkey"))

    def cells(df, model, episode, field, x):
        return df.select(
            F.col(model).alias("model"),
            episode.alias("episode_id"),
            F.lit(field).alias("field"),
            x.cast("string").alias("value"),
        )

    balance = F.col("c_acctbal")
    debt = F.least(balance, F.lit(0.0))
    event = F.concat(F.lit("e"), F.col("event_id"))
    return (
        cells(customer, "c_mktsegment", owner, ".<acctbal>", balance)
        .unionByName(cells(customer, "c_mktsegment", owner, ".<debt>", debt))
        .unionByName(cells(events, "event_type", event, ".<value>", F.col("value")))
    )


def shown(ranges: DataFrame, decimals: int = 6) -> DataFrame:
    return ranges.select(
        "model",
        "field",
        "n",
        F.round("lo", decimals).alias("lo"),
        F.round("hi", decimals).alias("hi"),
    )


def refined(spark: SparkSession, d: str, **changes) -> DataFrame:
    p = LearnParams(method="iqr", **{**PLAIN, **changes})
    return learn.refine(learn.initial_ranges(balance_values(spark, d), p), p)


def with_cells(cells: str, *steps: str, final: str) -> str:
    return "WITH " + ",\n".join([cells, *steps]) + "\n" + final


def r1_numeric(spark, d):
    seen = learn.observed(order_values(spark, d).unionByName(event_values(spark, d)))
    return seen


R1_SQL = f"""WITH {sql.O_TEXT},
v{sql.V_CELLS},
both_cells AS (SELECT model, field, x FROM texts UNION ALL SELECT model, field, x FROM vcells)
SELECT model, field, CAST(count(x) AS BIGINT) AS n, min(x) AS smallest, max(x) AS largest
FROM both_cells GROUP BY 1, 2"""


def r2_range_iqr(spark, d):
    p = LearnParams(method="iqr")
    return shown(learn.initial_ranges(event_values(spark, d), p))


def r3_range_mad(spark, d):
    p = LearnParams(method="mad")
    return shown(learn.initial_ranges(event_values(spark, d), p))


R3_SQL = with_cells(
    sql.V_CELLS,
    sql.STATS,
    """med AS (SELECT model, field, median(x) AS md, mad(x) AS ad FROM cells
 WHERE x IS NOT NULL GROUP BY 1, 2)""",
    final="""SELECT s.model, s.field, CAST(s.n AS BIGINT) AS n,
 round(CASE WHEN ad = 0 THEN smallest ELSE md - 3.0 * (1.4826 * ad) END, 6) AS lo,
 round(CASE WHEN ad = 0 THEN largest ELSE md + 3.0 * (1.4826 * ad) END, 6) AS hi
 FROM stats s JOIN med ON s.model = med.model AND s.field = med.field""",
)


def r4_range_cover(spark, d):
    p = LearnParams(method="cover", cover_pct=0.95)
    values = order_values(spark, d, b.NUMERIC_FIELDS).unionByName(event_values(spark, d))
    return shown(learn.initial_ranges(values, p))


R4_SQL = (
    "WITH "
    + sql.O_CELLS.replace("cells AS", "ocells AS")
    + ", v"
    + sql.V_CELLS
    + """, cells AS (SELECT model, field, x FROM ocells UNION ALL SELECT model, field, x FROM vcells), """
    + sql.cover(0.95)
    + " "
    + sql.shown("cover")
)


def r5_min_valid(spark, d):
    """Groups below the required count keep their observed range."""
    size = 2000
    p = LearnParams(method="iqr", min_valid_count=size, sign_clamp=True, expand_pct=0.0)
    return shown(learn.initial_ranges(event_values(spark, d), p))


def r6_sign_clamp(spark, d):
    return shown(refined(spark, d, sign_clamp=True))


def r7_expand(spark, d):
    wide = shown(refined(spark, d, expand_pct=0.25)).withColumn("share", F.lit(0.25))
    return wide.unionByName(
        shown(refined(spark, d, expand_pct=-0.75)).withColumn("share", F.lit(-0.75))
    )


def r8_post_expand_sign(spark, d):
    return shown(refined(spark, d, expand_pct=0.5, post_expand_sign_clamp=True))


def r9_clamp_observed(spark, d):
    return shown(refined(spark, d, expand_pct=0.5, clamp_to_observed=True))


def r10_region_adjust(spark, d):
    factor = learn.region_multiplier({"EUROPE": 2.0}, "EUROPE")
    return shown(refined(spark, d, region_adjust=True, region_multiplier=factor))


BOUNDS = (
    BoundRule(["ACCT"], min_lo=-500.0, max_hi=9000.0),
    BoundRule(["acct", "bal"], max_lo=-600.0),
    BoundRule(["debt"], models=["building"], min_lo=-100.0, max_lo=-100.0, min_hi=-50.0, max_hi=-50.0),
    BoundRule(["debt"], min_lo=-1.0),
    BoundRule(["value"], min_lo=float("inf"), max_hi=50.0),
    BoundRule([], min_lo=1e9),
)
_BOUND_LO = """CASE
 WHEN field = '.<acctbal>' THEN least(greatest(lo, -500), -600)
 WHEN field = '.<debt>' AND model = 'BUILDING' THEN -100
 WHEN field = '.<debt>' THEN greatest(lo, -1) ELSE lo END"""
_BOUND_HI = """CASE
 WHEN field = '.<acctbal>' THEN least(hi, 9000)
 WHEN field = '.<debt>' AND model = 'BUILDING' THEN -50
 WHEN field = '.<value>' THEN least(hi, 50) ELSE hi END"""


def r11_bound_rules(spark, d):
    return shown(refined(spark, d, bound_rules=BOUNDS))


def r12_stage_order(spark, d):
    """Expanding before the sign stage, fields before the region stage."""
    return shown(
        refined(
            spark,
            d,
            stages=("expand", "sign", "field", "region_adjust"),
            expand_pct=0.1,
            sign_clamp=True,
            bound_rules=BOUNDS,
            region_adjust=True,
            region_multiplier=1.5,
        )
    )


def r13_forced_non_numeric(spark, d):
    p = LearnParams(non_numeric_rules=[TextRule(["loss"]), TextRule(["fps"], ["BUILDING"])])
    return learn.learn_ranges(order_values(spark, d), p).select("model", "field", "is_non_numeric")


def r14_round(spark, d):
    return refined(spark, d, expand_pct=0.1237, round_decimals=2).select("model", "field", "n", "lo", "hi")


def r15_learn(spark, d):
    p = LearnParams(non_numeric_rules=[TextRule(["metadata_raw"])], expand_pct=0.1)
    return learn.learn_ranges(order_values(spark, d), p).select(
        "model", "variant", "field", "lo", "hi", "is_non_numeric"
    )


_IQR_C = [sql.C_CELLS, sql.iqr()]
_bound_step = sql._step("b1", "iqr", _BOUND_LO, _BOUND_HI)

QUERIES: dict[str, Query] = {
    "r1_numeric": r1_numeric,
    "r2_range_iqr": r2_range_iqr,
    "r3_range_mad": r3_range_mad,
    "r4_range_cover": r4_range_cover,
    "r5_min_valid": r5_min_valid,
    "r6_sign_clamp": r6_sign_clamp,
    "r7_expand": r7_expand,
    "r8_post_expand_sign": r8_post_expand_sign,
    "r9_clamp_observed": r9_clamp_observed,
    "r10_region_adjust": r10_region_adjust,
    "r11_bound_rules": r11_bound_rules,
    "r12_stage_order": r12_stage_order,
    "r13_forced_non_numeric": r13_forced_non_numeric,
    "r14_round": r14_round,
    "r15_learn": r15_learn,
}

SQL: dict[str, str] = {
    "r1_numeric": R1_SQL,
    "r2_range_iqr": with_cells(sql.V_CELLS, sql.iqr(), final=sql.shown("iqr")),
    "r3_range_mad": R3_SQL,
    "r4_range_cover": R4_SQL,
    "r5_min_valid": with_cells(sql.V_CELLS, sql.iqr(min_valid=2000), final=sql.shown("iqr")),
    "r6_sign_clamp": with_cells(*_IQR_C, sql.sign("s1", "iqr"), final=sql.shown("s1")),
    "r7_expand": with_cells(
        *_IQR_C,
        sql.expand("w1", "iqr", 0.25),
        sql.expand("w2", "iqr", -0.75),
        final=sql.shown("w1").replace(" FROM", ", CAST(0.25 AS DOUBLE) AS share FROM")
        + " UNION ALL "
        + sql.shown("w2").replace(" FROM", ", CAST(-0.75 AS DOUBLE) AS share FROM"),
    ),
    "r8_post_expand_sign": with_cells(
        *_IQR_C, sql.expand("w1", "iqr", 0.5), sql.keep_sign("k1", "w1"), final=sql.shown("k1")
    ),
    "r9_clamp_observed": with_cells(
        *_IQR_C, sql.expand("w1", "iqr", 0.5), sql.clamp("k1", "w1"), final=sql.shown("k1")
    ),
    "r10_region_adjust": with_cells(
        *_IQR_C, sql.region("g1", "iqr", 2.0), final=sql.shown("g1")
    ),
    "r11_bound_rules": with_cells(*_IQR_C, _bound_step, final=sql.shown("b1")),
    "r12_stage_order": with_cells(
        *_IQR_C,
        sql.expand("w1", "iqr", 0.1),
        sql.sign("s1", "w1"),
        sql._step("b1", "s1", _BOUND_LO, _BOUND_HI),
        sql.region("g1", "b1", 1.5),
        final=sql.shown("g1"),
    ),
    "r13_forced_non_numeric": f"""WITH {sql.O_TEXT}
SELECT model, field, (count(x) = 0 OR field LIKE '%loss%' OR (field LIKE '%fps%' AND model = 'BUILDING'))
 AS is_non_numeric FROM texts GROUP BY model, field""",
    "r14_round": with_cells(
        *_IQR_C, sql.expand("w1", "iqr", 0.1237), final=sql.shown("w1", 2)
    ),
    "r15_learn": "WITH "
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
    + f"""
SELECT model, 'base' AS variant, field, round(lo, 6) AS lo, round(hi, 6) AS hi,
 n = 0 AS is_non_numeric FROM s4
UNION ALL SELECT DISTINCT model, 'base', '{sql.SN}', CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), true FROM ep
UNION ALL SELECT DISTINCT model, 'base', '{sql.STATUS}', CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), true FROM ep""",
}


# --- declared ranges -----------------------------------------------------------------------------


def part_fields(spark: SparkSession, d: str) -> DataFrame:
    """One selector per part: brands as models, types as rule codes, names and sizes inside."""
    selector = F.concat(
        F.lit(".<report>.[<ruleCode>=<"),
        F.col("p_type"),
        F.lit(">].<rawDataMetric>.[<name>=<"),
        F.col("p_name"),
        F.lit(">].<rawData>.<size_"),
        F.col("p_size").cast("string"),
        F.lit(">"),
    )
    return b.table(spark, d, "part").select(
        F.col("p_brand").alias("model"),
        selector.alias("field"),
        F.col("p_partkey").alias("pos"),
    )


PART_FIELDS = """pf AS (
 SELECT p_brand AS model, '.<report>.[<ruleCode>=<' || p_type || '>].<rawDataMetric>.[<name>=<'
  || p_name || '>].<rawData>.<size_' || p_size || '>' AS field, p_partkey AS pos FROM part)"""

DECLARED = [
    {"contains": ["economy", "ring"], "range": [0, 10]},
    {"contains": ["standard"], "range": [-5, 5]},
    {"contains": ["size_1"], "range": [1, 100]},
    {"contains": ["promo", "size_2"], "range": [0.5, 0.5]},
]
DECLARED_TEXT = [{"contains": ["small"]}]
_DECLARED_SQL = f"""WITH {PART_FIELDS},
df AS (SELECT DISTINCT model, field FROM pf),
hit AS (SELECT model, field, contains(lower(field), 'small') AS forced,
  contains(lower(field), 'economy') AND contains(lower(field), 'ring') AS h0,
  contains(lower(field), 'standard') AS h1, contains(lower(field), 'size_1') AS h2,
  contains(lower(field), 'promo') AND contains(lower(field), 'size_2') AS h3 FROM df),
cnt AS (SELECT *, CAST(h0 AS INT) + CAST(h1 AS INT) + CAST(h2 AS INT) + CAST(h3 AS INT) AS c FROM hit)"""


def _declared(spark: SparkSession, d: str):
    fields = part_fields(spark, d).select("model", "field").distinct()
    rules = declare.checked_rules(DECLARED, DECLARED_TEXT)
    return fields, rules, [r["contains"] for r in DECLARED_TEXT]


def f1_declare(spark, d):
    fields, rules, text = _declared(spark, d)
    return declare.declare_ranges(fields, rules, text).select(
        "model", "field", "lo", "hi", "is_non_numeric"
    )


def f2_violations(spark, d):
    fields, rules, text = _declared(spark, d)
    found = declare.declare_violations(fields, rules, text)
    return found.withColumn("hits", F.concat_ws(",", F.transform("hits", lambda h: h.cast("string"))))


def f3_rule_checks(spark, d):
    """Declared rules read from the suppliers: balance as lower, a multiple of the key as upper end."""
    key = F.col("s_suppkey")
    lo = F.when(key % 11 != 0, F.col("s_acctbal"))
    hi = (key * 50).cast("double")
    rules = b.table(spark, d, "supplier").select(
        key.alias("pos"),
        F.when(key % 7 == 0, F.array(F.lit("A"))).alias("models"),
        F.when(key % 5 != 0, F.array("s_name")).alias("contains"),
        F.when(key % 13 == 0, F.array(hi))
        .when(key % 3 != 0, F.array(lo, hi))
        .alias("ends"),
        F.when(key % 17 == 0, 1.0).alias("min_lo"),
        *[F.lit(None).cast("double").alias(c) for c in ("max_lo", "min_hi", "max_hi")],
    )
    return declare.rule_table_problems(rules)


QUERIES |= {"f1_declare": f1_declare, "f2_violations": f2_violations, "f3_rule_checks": f3_rule_checks}
SQL |= {
    "f1_declare": _DECLARED_SQL
    + """ SELECT model, field,
 CASE WHEN forced THEN NULL WHEN h0 THEN 0.0 WHEN h1 THEN -5.0 WHEN h2 THEN 1.0 ELSE 0.5 END::DOUBLE AS lo,
 CASE WHEN forced THEN NULL WHEN h0 THEN 10.0 WHEN h1 THEN 5.0 WHEN h2 THEN 100.0 ELSE 0.5 END::DOUBLE AS hi,
 forced AS is_non_numeric FROM cnt WHERE (forced AND c = 0) OR (NOT forced AND c = 1)""",
    "f2_violations": _DECLARED_SQL
    + """ SELECT model, field, CASE WHEN forced THEN 'non_numeric_collision' WHEN c = 0 THEN 'missing_rule'
 ELSE 'multiple_rules' END AS kind,
 concat_ws(',', CASE WHEN h0 THEN '0' END, CASE WHEN h1 THEN '1' END, CASE WHEN h2 THEN '2' END,
  CASE WHEN h3 THEN '3' END) AS hits
 FROM cnt WHERE (forced AND c > 0) OR (NOT forced AND c <> 1)""",
    "f3_rule_checks": """SELECT s_suppkey AS pos, 'names models' AS problem FROM supplier WHERE s_suppkey % 7 = 0
UNION ALL SELECT s_suppkey, 'no contains' FROM supplier WHERE s_suppkey % 5 = 0
UNION ALL SELECT s_suppkey, 'has clamp keys' FROM supplier WHERE s_suppkey % 17 = 0
UNION ALL SELECT s_suppkey, 'no range' FROM supplier WHERE s_suppkey % 3 = 0 AND s_suppkey % 13 <> 0
UNION ALL SELECT s_suppkey, 'range is not a pair' FROM supplier WHERE s_suppkey % 13 = 0
UNION ALL SELECT s_suppkey, 'range holds null' FROM supplier
 WHERE s_suppkey % 13 <> 0 AND s_suppkey % 3 <> 0 AND s_suppkey % 11 = 0
UNION ALL SELECT s_suppkey, 'lo above hi' FROM supplier
 WHERE s_suppkey % 13 <> 0 AND s_suppkey % 3 <> 0 AND s_suppkey % 11 <> 0 AND s_acctbal > s_suppkey * 50""",
}
