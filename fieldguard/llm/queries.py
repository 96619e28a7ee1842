"""The registered queries of this subpackage, and the SQL they must equal where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldguard.llm import align, bpe, chat, decontaminate, jaccard, phrases, pii, quality, sharding, substring, topk, toxicity, warc
from fieldguard.sources.bindings import table

QUERIES: dict = {}
SQL: dict[str, str] = {}

WORDS = r"coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), [])"


def _query(function):
    QUERIES[function.__name__] = function
    return function


@_query
def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring.dedup_substrings(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


SQL["op1_substring_dedup"] = f"""
WITH d AS (SELECT doc_id, {WORDS} AS w FROM documents),
win AS (
 SELECT doc_id, s, row_number() OVER (
  PARTITION BY array_to_string(w[s:s + 19], ' ') ORDER BY doc_id, s) AS nth
 FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS s FROM d)),
gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 20)) AS at FROM win WHERE nth > 1),
word AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS at FROM d),
kept AS (
 SELECT word.doc_id, string_agg(CASE WHEN gone.at IS NULL THEN x END, ' ' ORDER BY word.at) AS t,
        count(gone.at) AS n
 FROM word LEFT JOIN gone ON word.doc_id = gone.doc_id AND word.at = gone.at GROUP BY 1)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept ON d.doc_id = kept.doc_id"""


@_query
def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_leaks(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


# Words of ASCII letters, digits and all that is not ASCII, in lower case.
LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ALNUM = (
    f"coalesce(regexp_extract_all({LOWERED}, "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), [])"
)
SQL["op7_decontaminate"] = f"""
WITH d AS (SELECT doc_id, {ALNUM} AS w FROM documents),
b AS (SELECT item_id, {ALNUM} AS w FROM benchmark),
item AS (
 SELECT DISTINCT item_id, least(10, len(w)) AS n,
        array_to_string(w[s:s + least(10, len(w)) - 1], ' ') AS t
 FROM (SELECT *, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS s FROM b WHERE len(w) > 0)),
size AS (SELECT DISTINCT n FROM item),
win AS (
 SELECT doc_id, n, s, array_to_string(w[s:s + n - 1], ' ') AS t
 FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS s FROM d, size WHERE len(w) >= n)),
hit AS (SELECT doc_id, s, win.n, item_id FROM win JOIN item ON win.t = item.t AND win.n = item.n),
word AS (
 SELECT doc_id, count(DISTINCT pos) AS n_hit
 FROM (SELECT doc_id, unnest(range(s, s + n)) AS pos FROM hit) GROUP BY 1),
found AS (
 SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
 FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM hit) GROUP BY 1)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN word ON d.doc_id = word.doc_id LEFT JOIN found ON d.doc_id = found.doc_id"""


@_query
def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.link_components(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_shingles", "component_id"
    )


SQL["op5_jaccard_join"] = f"""
WITH RECURSIVE d AS (
 SELECT doc_id, {WORDS.replace("text", LOWERED)} AS w FROM documents),
s AS (
 SELECT DISTINCT doc_id, array_to_string(w[s:s + 2], ' ') AS t
 FROM (SELECT *, unnest(range(1, greatest(1, len(w) - 2) + 1)) AS s FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
link AS (
 SELECT a, b FROM (
  SELECT p.doc_id AS a, q.doc_id AS b, count(*) AS c FROM s p JOIN s q ON p.t = q.t
  GROUP BY 1, 2)
 JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id
 WHERE 100 * c >= 90 * (x.n + y.n - c)),
reach AS (SELECT a, b FROM link UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles,
       coalesce(m, d.doc_id) AS component_id
FROM d LEFT JOIN n ON d.doc_id = n.doc_id
LEFT JOIN (SELECT a, min(b) AS m FROM reach GROUP BY 1) r ON d.doc_id = r.a"""


@_query
def op6_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, vectors.where("vec_id % 50 = 0"))


SQL["op6_top_k"] = """
WITH v AS (
 SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
 FROM embeddings
 WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
 SELECT q.vec_id AS query_id, c.vec_id,
        CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
 FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(nth AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS nth FROM s)
WHERE nth <= 5"""


@_query
def op8_virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "virtual_slot",
    )


SQL["op8_virtual_slots"] = """
WITH RECURSIVE codes AS (
 SELECT list(c ORDER BY i) AS codes FROM (
  SELECT i, list_reduce(range(8), lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END, i) AS c
  FROM range(256) t(i))),
d AS (
 SELECT doc_id, CAST(coalesce(strlen(text), 0) + 1 AS BIGINT) AS size,
        CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) % 4096 AS v,
        list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'),
                       lambda x: CAST('0x' || x AS BIGINT)) AS b FROM documents),
crc AS (
 SELECT doc_id, size, v, xor(4294967295, list_reduce(b,
         lambda a, x: xor(a >> 8, codes[CAST((xor(a, x) & 255) + 1 AS INTEGER)]), 4294967295)) AS text_crc32
 FROM d, codes),
sums AS (
 SELECT i AS v, coalesce(sum(size), 0) AS bytes FROM range(4096) t(i) LEFT JOIN d ON d.v = i GROUP BY 1),
ranked AS (SELECT v, bytes, row_number() OVER (ORDER BY bytes DESC, v) AS nth FROM sums),
deal(nth, shard, load) AS (
 SELECT CAST(0 AS BIGINT), 0, list_transform(range(16), lambda x: CAST(0 AS HUGEINT))
 UNION ALL
 SELECT r.nth, list_position(load, list_min(load)) - 1,
        list_transform(load, lambda x, i: CASE WHEN i = list_position(load, list_min(load)) THEN x + bytes ELSE x END)
 FROM deal JOIN ranked r ON r.nth = deal.nth + 1)
SELECT doc_id, size, CAST(text_crc32 AS BIGINT) AS text_crc32, 'bytes' AS law,
       CAST(shard AS INTEGER) AS shard,
       row_number() OVER (PARTITION BY shard ORDER BY crc.v, doc_id, text_crc32, size) - 1 AS slot,
       CAST(NULL AS INTEGER) AS grown_shard, CAST(crc.v AS INTEGER) AS virtual_slot
FROM crc JOIN ranked ON crc.v = ranked.v JOIN deal ON deal.nth = ranked.nth"""


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@_query
def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = vocabulary()
    encoded = bpe.decode(bpe.encode(table(spark, sf_dir, "documents"), path), path)
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@_query
def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = warc.write_archives(table(spark, sf_dir, "pages"))
    return warc.read_archives(spark, path)


SQL["op4_warc"] = """
WITH p AS (
 SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes,
        sha1(coalesce(html, '')) AS hex FROM pages),
b AS (
 SELECT page_id, payload_bytes, array_to_string(list_transform(range(32), lambda i:
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(
          ((CAST('0x' || substr(hex, CAST(i // 4 * 5 + 1 AS INTEGER), 5) AS BIGINT)
            >> CAST(15 - 5 * (i % 4) AS BIGINT)) & 31) + 1 AS INTEGER), 1)), '') AS payload_digest
 FROM p),
m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS top FROM b)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = top THEN NULL ELSE top END AS refers_to
FROM m"""


@_query
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    )


@_query
def op9_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.perspectives(table(spark, sf_dir, "conversations"))


SQL["op9_perspectives"] = """
WITH t AS (
 SELECT conv_id, turn, coalesce(role, 'unknown') AS speaker,
        replace(coalesce(text, ''), '<|', '< |') AS content FROM conversations),
p AS (SELECT DISTINCT conv_id, speaker AS assistant FROM t WHERE speaker <> 'system'),
m AS (
 SELECT t.conv_id, assistant, turn, speaker, content,
        CASE WHEN speaker = 'system' THEN 'system' WHEN speaker = assistant THEN 'assistant' ELSE 'user' END AS role,
        CASE WHEN speaker <> 'system' AND speaker <> assistant THEN speaker END AS name
 FROM t JOIN p ON t.conv_id IS NOT DISTINCT FROM p.conv_id),
r AS (
 SELECT *, '<|im_start|>' || role || coalesce(' name=' || name, '') || chr(10) AS head FROM m),
x AS (SELECT *, head || content || '<|im_end|>' || chr(10) AS message FROM r),
w AS (
 SELECT *, CAST(sum(length(message)) OVER v AS BIGINT) AS z, row_number() OVER v AS n FROM x
 WINDOW v AS (PARTITION BY conv_id, assistant ORDER BY turn NULLS FIRST, speaker, content
              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT conv_id, assistant, turn, n - 1 AS nth, role, name, message, z - length(message) AS start,
       z AS "end", CASE WHEN role = 'assistant' THEN z - length(message) + length(head) END AS mask_start,
       CASE WHEN role = 'assistant' THEN z - 1 END AS mask_end
FROM w"""


@_query
def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.find(docs).drop("text")
    said = lambda c: F.array_join(
        F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in pii.KINDS],
        F.sha2(said("base"), 256).alias("base_sha256"),
        said("spans").alias("spans"),
    )


@_query
def op11_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return align.link_statistics(docs, vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"))


@_query
def op13_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@_query
def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


SQL["op12_phrases"] = rf"""
WITH t AS (
 SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS id,
        regexp_split_to_array({LOWERED}, '[.,;:!?\x0A-\x0D]') AS pieces FROM documents WHERE text IS NOT NULL),
w AS (
 SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM (SELECT lang, unnest(pieces) AS piece FROM t)),
n AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY 1),
f AS (
 SELECT lang, phrase, m, count(*) AS f FROM (
  SELECT lang, m, array_to_string(w[s:s + m - 1], ' ') AS phrase FROM (
   SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS s FROM (
    SELECT lang, w, unnest([1, 2, 3, 4, 5]) AS m FROM w)))
 GROUP BY 1, 2, 3 HAVING count(*) >= 100),
cut AS (
 SELECT lang, phrase, f AS a, string_split(phrase, ' ') AS w, unnest(range(1, m)) AS k FROM f WHERE m > 1),
score AS (
 SELECT c.lang, c.phrase, a, k, x.f AS l, y.f AS r, n,
        CAST(1000::HUGEINT * a * n // (x.f::HUGEINT * y.f) AS BIGINT) AS score
 FROM cut c JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(w[1:k], ' ')
 JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(w[k + 1:], ' ') JOIN n ON n.lang = c.lang),
worst AS (
 SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS nth FROM score) WHERE nth = 1),
held AS (
 SELECT lang, array_to_string(w[s:s + z - 1], ' ') AS phrase, max(a) AS longer FROM (
  SELECT *, unnest(range(1, len(w) - z + 2)) AS s FROM (
   SELECT lang, a, w, unnest(range(2, len(w))) AS z FROM cut WHERE k = 1 AND len(w) > 2))
 GROUP BY 1, 2)
SELECT lang, rank, phrase, a, l, r, n, score FROM (
 SELECT v.*, row_number() OVER (PARTITION BY v.lang ORDER BY score DESC, a DESC, v.phrase) AS rank
 FROM worst v LEFT JOIN held h ON h.lang = v.lang AND h.phrase = v.phrase WHERE longer IS NULL OR 100 * longer < 100 * a)
WHERE rank <= 2000"""
