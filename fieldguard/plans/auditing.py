"""Queries for the audit (T)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldguard.operators import audit, learn
from fieldguard.operators.audit import AuditParams
from fieldguard.operators.learn import LearnParams, TextRule
from fieldguard.plans import oracle as sql
from fieldguard.plans.learning import document_values, event_values, order_cells
from fieldguard.sources import bindings as b

# Without widening, the learned ranges leave real failures in skewed values.
TIGHT = LearnParams(cover_pct=0.9, expand_pct=0.0, sign_clamp=False)
_TIGHT_SQL = sql.cover(0.9)

def event_ranges(values: DataFrame) -> DataFrame:
    return learn.learn_ranges(values, TIGHT)


def fixed_ranges(values: DataFrame, *rows: tuple) -> DataFrame:
    """Hand-written (variant, field, lo, hi, is_non_numeric) for every model of the values."""
    entries = [
        F.struct(
            F.lit(variant).alias("variant"),
            F.lit(field).alias("field"),
            F.lit(lo).cast("double").alias("lo"),
            F.lit(hi).cast("double").alias("hi"),
            F.lit(text).alias("is_non_numeric"),
        )
        for variant, field, lo, hi, text in rows
    ]
    return values.select("model").distinct().select("model", F.inline(F.array(*entries)))


def event_episodes(spark: SparkSession, d: str) -> DataFrame:
    return b.table(spark, d, "events").select(
        F.col("event_type").alias("model"), F.col("event_id").cast("string").alias("episode_id")
    )


def document_episodes(spark: SparkSession, d: str) -> DataFrame:
    return b.table(spark, d, "documents").select(
        F.col("lang").alias("model"), F.col("doc_id").cast("string").alias("episode_id")
    )


def _rate(df: DataFrame) -> DataFrame:
    return df.withColumn("pass_rate", F.round("pass_rate", 6))


DOC_RANGES = (
    ("base", ".<n_chars>", 100.0, 5000.0, False),
    ("base", ".<labels>.<quality>", None, None, True),
    ("base", ".<labels>.<toxic>", 0.0, 0.0, False),
    ("full", ".<n_chars>", 500.0, 20000.0, False),
    ("full", ".<labels>.<toxic>", 0.0, 1.0, False),
)
_DOC_RANGES_SQL = """rng(variant, field, lo, hi, txt) AS (VALUES
 ('base', '.<n_chars>', 100, 5000, false), ('base', '.<labels>.<quality>', NULL, NULL, true),
 ('base', '.<labels>.<toxic>', 0, 0, false), ('full', '.<n_chars>', 500, 20000, false),
 ('full', '.<labels>.<toxic>', 0, 1, false))"""
# ok: 1 pass, 0 fail per cell and range; missing values fail.
_DOC_JUDGED = f"""WITH {sql.D_CELLS}, {_DOC_RANGES_SQL},
judged AS (SELECT c.model, r.variant, c.field, c.episode_id, c.x, r.lo, r.hi, r.txt,
 CASE WHEN r.txt THEN x IS NOT NULL ELSE coalesce(x BETWEEN lo AND hi, false) END AS ok
 FROM cells c JOIN rng r ON c.field = r.field)"""
_EVENT_JUDGED = f"""WITH {sql.V_CELLS}, {_TIGHT_SQL},
judged AS (SELECT c.model, 'base' AS variant, c.field, c.episode_id, c.x, r.lo, r.hi,
 coalesce(c.x BETWEEN round(r.lo, 6) AND round(r.hi, 6), false) AS ok
 FROM cells c JOIN cover r ON c.model = r.model AND c.field = r.field)"""
_FIELD_STATS = """CAST(count(*) FILTER (ok) AS BIGINT) AS pass_count,
 CAST(count(*) FILTER (NOT ok) AS BIGINT) AS fail_count,
 round(count(*) FILTER (ok) / count(*), 6) AS pass_rate"""
_BY_FIELD = f"SELECT model, variant, field, {_FIELD_STATS} FROM judged GROUP BY 1, 2, 3"


def t1_field_audit(spark, d):
    values = event_values(spark, d)
    return _rate(audit.audit_fields(values, event_ranges(values), event_episodes(spark, d)))


def t1_learn_and_audit(spark, d):
    """The whole way: order reports, values, learned ranges, audit of the same reports."""
    values = order_cells(spark, d)
    p = LearnParams(expand_pct=0.1, non_numeric_rules=[TextRule(["metadata_raw"])])
    episodes = b.order_episodes(spark, d).select("model", "episode_id")
    return _rate(audit.audit_fields(values, learn.learn_ranges(values, p), episodes))


_LEARNED = ",\n".join(
    [
        sql.O_CELLS,
        sql.cover(0.95),
        sql.sign("s1", "cover"),
        sql.expand("s2", "s1", 0.1),
        sql.keep_sign("s3", "s2"),
        sql.clamp("s4", "s3"),
    ]
)
T1_FLOW_SQL = f"""WITH {_LEARNED},
judged AS (SELECT c.model, 'base' AS variant, c.field,
 coalesce(c.x BETWEEN round(r.lo, 6) AND round(r.hi, 6), false) AS ok
 FROM cells c JOIN s4 r ON c.model = r.model AND c.field = r.field)
{_BY_FIELD}
UNION ALL SELECT model, 'base', '{sql.SN}', CAST(count(*) AS BIGINT), 0::BIGINT, 1.0::DOUBLE FROM ep GROUP BY 1
UNION ALL SELECT model, 'base', '{sql.STATUS}', CAST(count(*) AS BIGINT), 0::BIGINT, 1.0::DOUBLE FROM ep GROUP BY 1"""


def t2_presence(spark, d):
    values = document_values(spark, d)
    ranges = fixed_ranges(
        values,
        ("base", ".<labels>.<quality>", None, None, True),
        ("base", ".<labels>.<toxic>", None, None, True),
        ("base", ".<n_chars>", None, None, True),
    )
    return _rate(audit.audit_fields(values, ranges, document_episodes(spark, d)))


def t3_nan_policy(spark, d):
    """Missing numbers left out of the totals."""
    values = document_values(spark, d)
    p = AuditParams(treat_nan_as_fail=False)
    ranges = fixed_ranges(values, *DOC_RANGES)
    return _rate(audit.audit_fields(values, ranges, document_episodes(spark, d), p))


def t4_absent_field(spark, d):
    values = document_values(spark, d)
    ranges = fixed_ranges(values, *DOC_RANGES, ("base", ".<absent>", 0.0, 1.0, False))
    return _rate(audit.audit_fields(values, ranges, document_episodes(spark, d)))


def t5_field_scope(spark, d):
    """All extracted fields in scope; those without a range fail everywhere."""
    values = document_values(spark, d)
    p = AuditParams(fields_mode="values_only", missing_range_is_fail=True)
    ranges = fixed_ranges(values, *DOC_RANGES, ("base", ".<absent>", 0.0, 1.0, False))
    return _rate(audit.audit_fields(values, ranges, document_episodes(spark, d), p))


def t6_unusable_bounds(spark, d):
    values = document_values(spark, d)
    ranges = fixed_ranges(
        values,
        ("base", ".<n_chars>", None, 5000.0, False),
        ("base", ".<labels>.<toxic>", None, None, False),
    )
    return _rate(audit.audit_fields(values, ranges, document_episodes(spark, d)))


def t7_write_back(spark, d):
    values = document_values(spark, d)
    ranges = fixed_ranges(values, *DOC_RANGES, ("base", ".<absent>", 0.0, 1.0, False))
    p = AuditParams(missing_value_col_is_fail=False)
    stats = audit.audit_fields(values, ranges, document_episodes(spark, d), p)
    return _rate(audit.with_stats(ranges, stats))


def t8_top_fields(spark, d):
    values = document_values(spark, d)
    stats = audit.audit_fields(
        values, fixed_ranges(values, *DOC_RANGES), document_episodes(spark, d)
    )
    return _rate(audit.top_failing_fields(stats, 2))


def t9_fail_details(spark, d):
    values = document_values(spark, d)
    ranges = fixed_ranges(values, *DOC_RANGES, ("base", ".<absent>", 0.0, 1.0, False))
    return audit.fail_details(values, ranges, 3)


def t10_model_pass_rate(spark, d):
    values = event_values(spark, d)
    return _rate(audit.model_pass_rate(values, event_ranges(values), event_episodes(spark, d)))


def t11_scorecard(spark, d):
    values = event_values(spark, d)
    ranges = event_ranges(values).unionByName(
        fixed_ranges(values, ("base", ".<absent>", 0.0, 1.0, False)), allowMissingColumns=True
    )
    return _rate(audit.episode_scorecard(values, ranges))


def t12_top_episodes(spark, d):
    values = document_values(spark, d)
    card = audit.episode_scorecard(values, fixed_ranges(values, *DOC_RANGES))
    return _rate(audit.top_failing_episodes(card, 10))


def t13_both_variants(spark, d):
    values = document_values(spark, d)
    ranges = fixed_ranges(values, *DOC_RANGES)
    return _rate(audit.audit_fields(values, ranges, document_episodes(spark, d)))


_DOC_MODELS = "(SELECT model, count(*) AS n FROM dep GROUP BY model)"
_ABSENT = f"""SELECT model, 'base' AS variant, '.<absent>' AS field, 0::BIGINT AS pass_count,
 CAST(n AS BIGINT) AS fail_count, 0.0::DOUBLE AS pass_rate FROM {_DOC_MODELS}"""

QUERIES = {
    "t1_field_audit": t1_field_audit,
    "t1_learn_and_audit": t1_learn_and_audit,
    "t2_presence": t2_presence,
    "t3_nan_policy": t3_nan_policy,
    "t4_absent_field": t4_absent_field,
    "t5_field_scope": t5_field_scope,
    "t6_unusable_bounds": t6_unusable_bounds,
    "t7_write_back": t7_write_back,
    "t8_top_fields": t8_top_fields,
    "t9_fail_details": t9_fail_details,
    "t10_model_pass_rate": t10_model_pass_rate,
    "t11_scorecard": t11_scorecard,
    "t12_top_episodes": t12_top_episodes,
    "t13_both_variants": t13_both_variants,
}

SQL = {
    "t1_field_audit": f"{_EVENT_JUDGED} {_BY_FIELD}",
    "t1_learn_and_audit": T1_FLOW_SQL,
    "t2_presence": f"""WITH {sql.D_CELLS},
judged AS (SELECT model, 'base' AS variant, field, x IS NOT NULL AS ok FROM cells) {_BY_FIELD}""",
    "t3_nan_policy": f"""{_DOC_JUDGED}
SELECT model, variant, field,
 CAST(count(*) FILTER (ok) AS BIGINT) AS pass_count,
 CAST(count(*) FILTER (NOT ok AND (txt OR x IS NOT NULL)) AS BIGINT) AS fail_count,
 coalesce(round(count(*) FILTER (ok) / nullif(count(*) FILTER (txt OR x IS NOT NULL), 0), 6), 0) AS pass_rate
FROM judged GROUP BY 1, 2, 3""",
    "t4_absent_field": f"{_DOC_JUDGED} {_BY_FIELD} UNION ALL {_ABSENT}",
    "t5_field_scope": f"""{_DOC_JUDGED} {_BY_FIELD}
UNION ALL SELECT model, 'full', '.<labels>.<quality>', 0::BIGINT, CAST(n AS BIGINT), 0.0::DOUBLE
FROM {_DOC_MODELS}""",
    "t6_unusable_bounds": f"""WITH {sql.D_CELLS},
judged AS (SELECT model, 'base' AS variant, field, false AS ok FROM cells
 WHERE field <> '.<labels>.<quality>') {_BY_FIELD}""",
    "t7_write_back": f"""{_DOC_JUDGED},
st AS ({_BY_FIELD})
SELECT st.model, st.variant, st.field, CAST(r.lo AS DOUBLE) AS lo, CAST(r.hi AS DOUBLE) AS hi,
 r.txt AS is_non_numeric, pass_count, fail_count, pass_rate
FROM st JOIN rng r ON st.variant = r.variant AND st.field = r.field
UNION ALL SELECT model, 'base', '.<absent>', 0.0::DOUBLE, 1.0::DOUBLE, false, NULL, NULL, NULL FROM {_DOC_MODELS}""",
    "t8_top_fields": f"""{_DOC_JUDGED},
st AS ({_BY_FIELD}),
rk AS (SELECT *, row_number() OVER (PARTITION BY model, variant
 ORDER BY fail_count DESC, pass_rate, field) AS rank FROM st)
SELECT * FROM rk WHERE rank <= 2""",
    "t9_fail_details": f"""{_DOC_JUDGED},
rk AS (SELECT *, row_number() OVER (PARTITION BY model, variant, field ORDER BY episode_id) AS n
 FROM judged WHERE NOT ok)
SELECT model, variant, field, episode_id,
 CASE WHEN txt THEN 'empty' WHEN x IS NULL THEN 'nan' ELSE 'out_of_range' END AS reason,
 x, CAST(lo AS DOUBLE) AS lo, CAST(hi AS DOUBLE) AS hi
FROM rk WHERE n <= 3
UNION ALL SELECT model, 'base', '.<absent>', '<all>', 'missing_value_column', NULL, 0, 1 FROM {_DOC_MODELS}""",
    "t10_model_pass_rate": f"""{_EVENT_JUDGED},
ep1 AS (SELECT model, variant, episode_id, bool_and(ok) AS clean FROM judged GROUP BY 1, 2, 3)
SELECT model, variant, CAST(count(*) FILTER (clean) AS BIGINT) AS pass_episodes,
 CAST(count(*) AS BIGINT) AS episodes, round(count(*) FILTER (clean) / count(*), 6) AS pass_rate
FROM ep1 GROUP BY 1, 2""",
    "t11_scorecard": f"""{_EVENT_JUDGED}
SELECT model, variant, episode_id, CAST(count(*) + 1 AS BIGINT) AS total_fields,
 CAST(count(*) FILTER (ok) AS BIGINT) AS pass_fields,
 CAST(count(*) + 1 - count(*) FILTER (ok) AS BIGINT) AS fail_fields,
 round(count(*) FILTER (ok) / (count(*) + 1), 6) AS pass_rate
FROM judged GROUP BY 1, 2, 3""",
    "t12_top_episodes": f"""{_DOC_JUDGED},
card AS (SELECT model, variant, episode_id, CAST(count(*) AS BIGINT) AS total_fields,
 CAST(count(*) FILTER (ok) AS BIGINT) AS pass_fields,
 CAST(count(*) FILTER (NOT ok) AS BIGINT) AS fail_fields,
 round(count(*) FILTER (ok) / count(*), 6) AS pass_rate FROM judged GROUP BY 1, 2, 3),
rk AS (SELECT *, row_number() OVER (PARTITION BY model, variant
 ORDER BY fail_fields DESC, pass_rate, episode_id) AS rank FROM card)
SELECT * FROM rk WHERE rank <= 10""",
    "t13_both_variants": f"{_DOC_JUDGED} {_BY_FIELD}",
}
