"""SQL fragments shared by the checking queries. All start from the base tables."""

from __future__ import annotations

from fieldguard.sources.bindings import FLAGS, LEAVES, METADATA, METRIC

# Orders as episodes.
EP = """ep AS (
 SELECT c.c_mktsegment AS model, 'c' || o.o_custkey AS taskid,
        CAST(o.o_orderkey AS VARCHAR) AS episode_id, r.r_name AS area, n.n_name AS sn,
        strftime(o.o_orderdate, '%Y-%m-%d') AS collected_at, o.o_orderstatus AS status
 FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
 JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey)"""

_SEL = ", ".join(
    f"('{METRIC.format(flag=f, leaf=x)}', '{f}', '{x}')" for x in LEAVES for f in FLAGS
)
M = """m AS (
 SELECT CAST(l_orderkey AS VARCHAR) AS episode_id, l_returnflag AS flag,
        max(l_quantity) AS fps, max(l_discount) AS loss
 FROM lineitem GROUP BY 1, 2)"""
# Numeric cells of orders: one row per episode and numeric field.
O_CELLS = f"""{EP}, {M},
sel(field, flag, leaf) AS (VALUES {_SEL}),
cells AS (
 SELECT ep.model, ep.episode_id, sel.field,
        CASE sel.leaf WHEN 'fps' THEN m.fps ELSE m.loss END AS x
 FROM ep CROSS JOIN sel
 LEFT JOIN m ON m.episode_id = ep.episode_id AND m.flag = sel.flag)"""
SN, STATUS = METADATA.format(leaf="sn"), METADATA.format(leaf="status")
# All cells of orders, as text.
O_TEXT = f"""{O_CELLS},
texts AS (
 SELECT model, episode_id, field, CAST(x AS VARCHAR) AS value, x FROM cells
 UNION ALL SELECT model, episode_id, '{SN}', sn, NULL FROM ep
 UNION ALL SELECT model, episode_id, '{STATUS}', status, NULL FROM ep)"""
# Events as episodes.
V_EP = """vep AS (
 SELECT event_type AS model, CAST(user_id AS VARCHAR) AS taskid,
        CAST(event_id AS VARCHAR) AS episode_id, 'stream' AS area, 'u' || user_id AS sn,
        strftime(ts, '%Y-%m-%d %H:%M:%S') AS collected_at, ts FROM events)"""
V_CELLS = """cells AS (
 SELECT event_type AS model, CAST(event_id AS VARCHAR) AS episode_id, '.<value>' AS field,
        value AS x FROM events
 UNION ALL
 SELECT event_type, CAST(event_id AS VARCHAR), '.<props>.<k>',
        CAST(json_extract_string(props, '$.k') AS DOUBLE) FROM events)"""
# Documents as episodes.
D_EP = """dep AS (
 SELECT lang AS model, source || '-' || (d.doc_id % 20) AS taskid,
        CAST(d.doc_id AS VARCHAR) AS episode_id, source AS area,
        CAST(n_chars AS DOUBLE) AS n_chars, CAST(quality AS DOUBLE) AS quality,
        CAST(toxic AS DOUBLE) AS toxic
 FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""
D_CELLS = f"""{D_EP}, cells AS (
 SELECT model, episode_id, '.<n_chars>' AS field, n_chars AS x FROM dep
 UNION ALL SELECT model, episode_id, '.<labels>.<quality>', quality FROM dep
 UNION ALL SELECT model, episode_id, '.<labels>.<toxic>', toxic FROM dep)"""
# Account balances (of either sign) as cells.
C_CELLS = """cells AS (
 SELECT c_mktsegment AS model, 'c' || c_custkey AS episode_id, '.<acctbal>' AS field,
        c_acctbal AS x FROM customer
 UNION ALL SELECT c_mktsegment, 'c' || c_custkey, '.<debt>', least(c_acctbal, 0) FROM customer
 UNION ALL SELECT event_type, 'e' || event_id, '.<value>', value FROM events)"""

STATS = """stats AS (
 SELECT model, field, count(x) AS n, min(x) AS smallest, max(x) AS largest
 FROM cells GROUP BY 1, 2)"""


def cover(share: float = 0.95) -> str:
    """``cover``: the shortest covering interval per (model, field) of ``cells``."""
    return f"""{STATS},
ranked AS (
 SELECT model, field, x, row_number() OVER (PARTITION BY model, field ORDER BY x) AS rn,
        count(*) OVER (PARTITION BY model, field) AS n
 FROM cells WHERE x IS NOT NULL),
wins AS (
 SELECT a.model, a.field, a.x AS lo, b.x AS hi, a.rn FROM ranked a JOIN ranked b
 ON a.model = b.model AND a.field = b.field
 AND b.rn = a.rn + CAST(greatest(1, least(ceil({share} * a.n), a.n)) AS BIGINT) - 1),
best AS (
 SELECT model, field, lo, hi FROM wins
 QUALIFY row_number() OVER (PARTITION BY model, field ORDER BY hi - lo, rn) = 1),
cover AS (
 SELECT s.model, s.field, s.n, s.smallest, s.largest, b.lo, b.hi
 FROM stats s LEFT JOIN best b ON s.model = b.model AND s.field = b.field)"""


def iqr(k: float = 1.5, min_valid: int = 2) -> str:
    """``iqr``: quartile range per (model, field) of ``cells``."""
    return f"""{STATS},
quart AS (
 SELECT model, field, quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.75) AS q3
 FROM cells WHERE x IS NOT NULL GROUP BY 1, 2),
iqr AS (
 SELECT s.model, s.field, s.n, s.smallest, s.largest,
        CASE WHEN s.n < {min_valid} OR q3 - q1 = 0 THEN s.smallest ELSE q1 - {k} * (q3 - q1) END AS lo,
        CASE WHEN s.n < {min_valid} OR q3 - q1 = 0 THEN s.largest ELSE q3 + {k} * (q3 - q1) END AS hi
 FROM stats s LEFT JOIN quart q ON s.model = q.model AND s.field = q.field)"""


def _step(name: str, source: str, lo: str, hi: str) -> str:
    fixed = f"SELECT model, field, n, smallest, largest, {lo} AS lo, {hi} AS hi FROM {source}"
    return f"""{name} AS (
 SELECT model, field, n, smallest, largest, lo, CASE WHEN lo > hi THEN lo ELSE hi END AS hi
 FROM ({fixed}))"""


def sign(name: str, source: str) -> str:
    return _step(
        name,
        source,
        "CASE WHEN smallest >= 0 THEN smallest ELSE lo END",
        "CASE WHEN largest <= 0 THEN largest ELSE hi END",
    )


def expand(name: str, source: str, share: float) -> str:
    d = f"(CASE WHEN hi = lo THEN greatest(abs(lo), abs(hi), 1) ELSE hi - lo END * {share})"
    return f"""{name} AS (
 SELECT model, field, n, smallest, largest,
        CASE WHEN a > b THEN (a + b) / 2 ELSE a END AS lo,
        CASE WHEN a > b THEN (a + b) / 2 ELSE b END AS hi
 FROM (SELECT *, lo - {d} AS a, hi + {d} AS b FROM {source}))"""


def keep_sign(name: str, source: str) -> str:
    return _step(
        name,
        source,
        "CASE WHEN smallest >= 0 THEN greatest(lo, 0) ELSE lo END",
        "CASE WHEN largest <= 0 THEN least(hi, 0) ELSE hi END",
    )


def clamp(name: str, source: str) -> str:
    return _step(name, source, "greatest(lo, smallest)", "least(hi, largest)")


def region(name: str, source: str, factor: float) -> str:
    return f"""{name} AS (
 SELECT model, field, n, smallest, largest,
        CASE WHEN hi = lo THEN lo ELSE (lo + hi) / 2 - (hi - lo) * {factor} / 2 END AS lo,
        CASE WHEN hi = lo THEN hi ELSE (lo + hi) / 2 + (hi - lo) * {factor} / 2 END AS hi
 FROM {source})"""


def shown(source: str, decimals: int = 6) -> str:
    return (
        f"SELECT model, field, CAST(n AS BIGINT) AS n, round(lo, {decimals}) AS lo, "
        f"round(hi, {decimals}) AS hi FROM {source}"
    )
