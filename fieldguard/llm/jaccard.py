"""N-gram Jaccard join as a grouped prefix join.

A text's set holds the hashes of its distinct 3-word shingles. Sets are ordered by rarity (shingles that
stand out as common last, then the counts of a shingle's words over all documents, both kept in tables of
fixed size, then the hash), and two sets of Jaccard similarity 0.9 or more must share a token of their
prefixes. A passage that many texts hold is so in the prefixes of few. The join runs over groups:

1. texts with equal sets become one class, classes with identical prefix and size one group;
2. groups meet by prefix token. Each group is first paired with the hub it shares most tokens with,
   each class with its group's first class: as many pairs as groups and classes, not their square;
3. classes still in different components are expanded from their groups and paired by token under
   the length, positional and bitmap bounds. The first token a similar pair shares leaves enough
   elements behind it on both sides, so a pair comes up at places that can be the first only. All
   that is left is verified, so no link that could join two components is missed, while copies that
   are connected already never meet again.

Verification compares the real shingles of both texts. The bitmap holds the
parity of the elements in each cell, so two bitmaps differ in at most as many cells as the sets have
differences. It has 512 cells, four times as many for sets of over 2,000 elements (at 0.9; the more
differences the similarity allows, the fewer elements), and so on by fours; bitmaps of neighbouring
widths are compared after the wider one is folded.

Defined results: null and empty texts have no shingles and no links; a null doc_id has no component
and links with nothing; rows that share a doc_id are one document, linked by all its texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldguard.llm import words as W
from fieldguard.llm.graph import components
from fieldguard.session import settle

SHINGLE, PERCENT = 3, 90
# Longs of the narrowest bitmap, and the elements it serves at 90 percent; both grow by fours together.
LONGS, SERVED = 8, 2000
# The place that stands for a whole prefix where classes of one group meet.
SAME_PREFIX = -1
# Counts of words by hash, and of shingles; a fixed size, whatever the corpus.
CELL_BITS = 20
CELLS = 1 << CELL_BITS
_SLICES = 32
# A cell of shingles holds a common one if it is so many deviations over the mean, and so many counts.
_DEVIATIONS, _LEAST = 6, 8
_PIECE = 1 << 20
# Bytes of texts' sets that a task of the verification keeps for further pairs.
_KNOWN = 16 << 20
_SETS = "id long, n long, one long, two long, prefix array<long>, bits array<long>"


def _runs(found: W.Words, size: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Words of a shingle, first word and hash of every shingle. A text of fewer words is one shingle."""
    for k in range(size, 0, -1):
        if k == size:
            places = np.flatnonzero(W.same_text(found, k))
            if len(places):
                yield k, places, W.rolling(found.hash, k)[places]
        else:
            places = found.first[np.flatnonzero(found.counts == k)]
            if len(places):
                yield k, places, W.rolling(found.hash[(places[:, None] + np.arange(k)).ravel()], k)[::k]


def shingles(
    texts: pa.Array, size: int, rare: np.ndarray | None = None, common: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Document, hash and rank of every shingle, and the number of texts.

    The rank goes by the class of the shingle, then by the sum of its words' rarity classes: the lower,
    the less likely the shingle is to occur.
    """
    found = W.find_words(*W.text_arrays(texts), W.SPACED, W.LOWER)
    each = np.zeros(len(found.hash), np.uint32)
    if rare is not None:
        each = rare[_cell(found.hash)].astype(np.uint32)
    docs, hashes, ranks = [], [], []
    for k, places, own in _runs(found, size):
        docs.append(found.doc[places])
        hashes.append(own)
        rank = sum(each[places + i] for i in range(k))
        if common is not None:
            rank += common[_cell(own)].astype(np.uint32) * np.uint32(256 * size)
        ranks.append(rank)
    if not docs:
        return np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.uint32), len(found.counts)
    return np.concatenate(docs), np.concatenate(hashes), np.concatenate(ranks), len(found.counts)


def _cell(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - CELL_BITS)).astype(np.int64)


def tally(size: int):
    """Task side: counts of the words by cell, then of the shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, CELLS), np.int64)
        for batch in W.pieces(batches, limit=_PIECE):
            found = W.find_words(*W.text_arrays(batch.column("text")), W.SPACED, W.LOWER)
            counts[0] += np.bincount(_cell(found.hash), minlength=CELLS)
            for _, _, own in _runs(found, size):
                counts[1] += np.bincount(_cell(own), minlength=CELLS)
        if counts.any():
            press = zstandard.ZstdCompressor(level=1).compress
            parts = [press(x.tobytes()) for x in np.split(counts.ravel(), _SLICES)]
            yield pa.RecordBatch.from_pydict(
                {"slice": pa.array(range(_SLICES), pa.int32()), "counts": pa.array(parts, pa.binary())}
            )

    return run


def _add(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(2 * CELLS // _SLICES, np.int64)
    expand = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        for blob in batch.column("counts").to_pylist():
            total += np.frombuffer(expand(blob), np.int64)
    yield pa.RecordBatch.from_pydict(
        {"slice": pa.array([key[0].as_py()], pa.int32()), "counts": pa.array([total.tobytes()], pa.binary())}
    )


def rarity(docs: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Class of each cell of words, the logarithm of its count over all documents, and of each cell of
    shingles, the logarithm of what it has over other cells and chance, mostly 0 (1 MB each)."""
    parts = docs.select("text").mapInArrow(tally(size), "slice int, counts binary")
    summed = parts.groupBy("slice").applyInArrow(_add, "slice int, counts binary").collect()
    counts = np.zeros(2 * CELLS, np.int64)
    for i, blob in summed:
        at = 2 * CELLS // _SLICES * i
        counts[at : at + 2 * CELLS // _SLICES] = np.frombuffer(blob, np.int64)
    words, runs = counts[:CELLS], counts[CELLS:]
    mean = runs.mean()
    over = np.maximum(runs - (mean + _DEVIATIONS * np.sqrt(mean) + _LEAST), 0)
    return (4 * np.log2(words + 1)).astype(np.uint8), (4 * np.log2(over + 1)).astype(np.uint8)


def served(percent: int) -> int:
    """Elements the narrowest bitmap serves: as many differences are allowed as between SERVED at 90 percent."""
    return SERVED * 10 * (100 + percent) // (190 * max(1, 100 - percent))


def _bitmaps(doc: np.ndarray, hashes: np.ndarray, n: np.ndarray, serves: int = SERVED) -> pa.ListArray:
    """Parity of each text's elements by the low bits of their mixed hashes, as longs."""
    longs = np.full(len(n), LONGS, np.int64)
    while (n > serves).any():
        longs[n > serves] *= 4
        serves *= 4
    ends = np.concatenate([[0], np.cumsum(longs)])
    cells = ends[doc] * 64 + (W.mix(hashes) & (longs[doc] * 64 - 1).astype(np.uint64)).astype(np.int64)
    odd = (np.bincount(cells, minlength=int(ends[-1]) * 64) & 1).astype(np.uint8)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.packbits(odd).view(np.int64)))


def sets(classes, size: int, percent: int):
    """Task side: size, identity, prefix and bitmap of every text's set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.pieces(batches, limit=_PIECE):
            doc, hashes, rank, count = shingles(batch.column("text"), size, *classes.value)
            order = np.lexsort((hashes, rank, doc))
            doc, hashes = doc[order], hashes[order]
            new = np.ones(len(doc), bool)
            new[1:] = (doc[1:] != doc[:-1]) | (hashes[1:] != hashes[:-1])
            doc, hashes = doc[new], hashes[new]
            n = np.bincount(doc, minlength=count)
            first = np.concatenate([[0], np.cumsum(n)])
            sums = [np.concatenate([[np.uint64(0)], np.cumsum(W.mix(hashes ^ np.uint64(c)))]) for c in (7, 0xABCDEF)]
            one, two = [(s[first[1:]] - s[first[:-1]]).view(np.int64) for s in sums]
            keep = np.minimum(n, n - (percent * n + 99) // 100 + 1)
            inside = np.arange(len(doc)) - first[doc] < keep[doc]
            cuts = np.concatenate([[0], np.cumsum(keep)])
            prefix = pa.ListArray.from_arrays(
                pa.array(cuts, pa.int32()), pa.array(hashes[inside].view(np.int64))
            )
            bits = _bitmaps(doc, hashes, n, served(percent))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(n), pa.array(one), pa.array(two), prefix, bits],
                names=["id", "n", "one", "two", "prefix", "bits"],
            )

    return W.tidy(run)


def press(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pack = zstandard.ZstdCompressor(level=3).compress
    for batch in batches:
        texts = [pack((x or "").encode()) for x in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array(texts, pa.binary())], names=["id", "packed"]
        )


def _sets(texts: list[bytes], size: int) -> list[np.ndarray]:
    """The rising hashes of every text's set."""
    doc, hashes, _, count = shingles(pa.array(texts, pa.binary()).cast(pa.string()), size)
    order = np.lexsort((hashes, doc))
    doc, hashes = doc[order], hashes[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (hashes[1:] != hashes[:-1])
    ends = np.cumsum(np.bincount(doc[new], minlength=count))
    return np.split(hashes[new], ends[:-1])


def check_pairs(size: int, percent: int):
    """Task side of verification: pairs whose texts' real sets are similar enough.

    The sets of a slice of pairs are found at once; those found stay until they take ``_KNOWN`` bytes.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        expand = zstandard.ZstdDecompressor().decompress
        known: dict[bytes, np.ndarray] = {}
        for batch in batches:
            kept, at = [], 0
            columns = [batch.column(c) for c in ("text_a", "text_b")]
            ends = np.cumsum(sum(pc.binary_length(x).to_numpy(zero_copy_only=False).astype(np.int64) for x in columns))
            while at < batch.num_rows:
                before = ends[at - 1] if at else 0
                to = max(at + 1, int(np.searchsorted(ends, before + _PIECE // 2, side="right")))
                one, two = (x.slice(at, to - at).to_pylist() for x in columns)
                if sum(x.nbytes for x in known.values()) > _KNOWN:
                    known = {}
                new = [x for x in dict.fromkeys(one + two) if x not in known]
                if new:
                    known.update(zip(new, _sets([expand(x) for x in new], size), strict=True))
                for i, own, other in zip(range(at, to), map(known.get, one), map(known.get, two), strict=True):
                    both = len(np.intersect1d(own, other, assume_unique=True))
                    if 100 * both >= percent * (len(own) + len(other) - both):
                        kept.append(i)
                at = to
            yield batch.select(["a", "b"]).take(pa.array(kept, pa.int64()))

    return W.tidy(run)


def _texts_of(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """id, packed of the documents in ``pairs``.

    Documents are first held against the cells of the ids (a table of fixed size that may be broadcast),
    so that of the others hardly any is shuffled.
    """
    ids = settle(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct())
    cell = F.pmod(F.xxhash64("id"), F.lit(CELLS))
    cells = F.broadcast(settle(ids.select(cell.alias("cell")).distinct()))
    near = docs.withColumn("cell", cell).join(cells, "cell", "left_semi").select("id", "text")
    packed = near.mapInArrow(W.tidy(press), "id long, packed binary")
    return settle(packed.join(ids, "id", "left_semi"))


def verified(pairs: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs (a, b) that link."""
    pairs = settle(pairs)
    texts = _texts_of(docs, pairs)
    one = texts.select(F.col("id").alias("a"), F.col("packed").alias("text_a"))
    two = texts.select(F.col("id").alias("b"), F.col("packed").alias("text_b"))
    return pairs.join(two, "b").join(one, "a").mapInArrow(
        check_pairs(size, percent), "a long, b long"
    )


def _similar(percent: int, n: Column, m: Column) -> tuple[Column, Column]:
    """Whether sizes allow the similarity, and the shared elements it needs."""
    sizes = 100 * F.least(n, m) >= percent * F.greatest(n, m)
    return sizes, F.ceil(percent * (n + m) / F.lit(100 + percent))


def _reach(n: Column, i: Column, m: Column, j: Column) -> Column:
    """Elements two ordered sets can share if they share the one at places i and j."""
    return F.least(i, j) + F.least(n - i, m - j)


def _differ(x: Column, y: Column) -> Column:
    """A number of elements that are surely in one set only, from the bitmaps."""

    def fold(z: Column, longs: Column) -> Column:
        parts = lambda i: [F.get(z, (i + k * longs).cast("int")) for k in range(4)]
        return F.transform(F.sequence(F.lit(0), longs - 1), lambda i: reduce(Column.bitwiseXOR, parts(i)))

    def count(u: Column, v: Column) -> Column:
        each = F.zip_with(u, v, lambda a, b: F.bit_count(a.bitwiseXOR(b)))
        return F.aggregate(each, F.lit(0), lambda s, k: s + k)

    narrow = sum((F.bit_count(F.get(x, F.lit(i)).bitwiseXOR(F.get(y, F.lit(i)))) for i in range(LONGS)), start=F.lit(0))
    return (
        F.when((F.size(x) == LONGS) & (F.size(y) == LONGS), narrow)
        .when(F.size(x) == F.size(y), count(x, y))
        .when(F.size(x) < F.size(y), count(x, fold(y, F.size(x))))
        .otherwise(count(fold(x, F.size(y)), y))
    )


def _near(pairs: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of classes that sizes and bitmaps allow."""
    one = members.select(F.col("id").alias("a"), F.col("n").alias("n_a"), F.col("bits").alias("bits_a"))
    two = members.select(F.col("id").alias("b"), F.col("n").alias("n_b"), F.col("bits").alias("bits_b"))
    sizes, needs = _similar(percent, F.col("n_a"), F.col("n_b"))
    allowed = _differ(F.col("bits_a"), F.col("bits_b")) <= F.col("n_a") + F.col("n_b") - 2 * needs
    return pairs.join(one, "a").join(two, "b").where(sizes & allowed)


def link_components(
    docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT
) -> DataFrame:
    """doc_id, n_shingles, component_id (least doc_id reachable), class_id (least with an equal set)."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("id"), "text")
    classes = spark.sparkContext.broadcast(rarity(docs, size))
    rows = settle(docs.mapInArrow(sets(classes, size, percent), _SETS))
    full = rows.where("id IS NOT NULL AND n > 0")

    # Classes of equal sets, then groups of equal prefix and size.
    members = full.groupBy("one", "two", "n").agg(
        F.min(F.struct("id", "prefix", "bits")).alias("x")
    )
    members = members.select("one", "two", "n", "x.id", "x.prefix", "x.bits")
    members = settle(members.withColumn("grp", F.xxhash64("prefix", "n")))
    groups = members.groupBy("grp", "n").agg(F.min(F.struct("id", "prefix")).alias("x"))
    # A group goes by its first class. Dealt by token once, for the count and for the join with it.
    postings = groups.select(
        F.col("x.id").alias("id"), F.col("n").cast("int").alias("n"), F.posexplode("x.prefix").alias("pos", "token")
    ).repartition("token")
    # Most tokens have one posting: they go by the counts, before anything is sorted.
    shared = postings.groupBy("token").agg(F.count("*").alias("c")).where("c > 1").select("token")
    hub = F.min(F.struct("id", F.col("n").alias("m"), F.col("pos").alias("at"))).over(Window.partitionBy("token"))
    live = settle(postings.join(shared.hint("shuffle_hash"), "token").withColumn("hub", hub))

    # One hub per group, one first class per group.
    sizes, needs = _similar(percent, F.col("n"), F.col("hub.m"))
    met = live.where(F.col("id") != F.col("hub.id")).where(
        sizes & (_reach(F.col("n"), F.col("pos"), F.col("hub.m"), F.col("hub.at")) >= needs)
    )
    met = met.groupBy(F.col("hub.id").alias("a"), F.col("id").alias("b")).agg(F.count("*").alias("c"))
    hubs = _near(met, members, percent).groupBy("b").agg(F.max(F.struct("c", "a")).alias("x"))
    hubs = hubs.select(F.col("x.a").alias("a"), "b")
    first = members.groupBy("grp", "n").agg(F.min("id").alias("a"), F.count("*").alias("c"))
    first = first.where("c > 1").join(members.select("grp", "n", F.col("id").alias("b")), ["grp", "n"])
    several = settle(first.select("grp", "n", "a", "b"))
    own = _near(several.where("a <> b").select("a", "b"), members, percent).select("a", "b")
    stars = settle(hubs.union(own))
    links = settle(verified(stars, docs, size, percent))
    found = settle(components(links))

    # What is still apart: classes of the live groups, by token and by group.
    heads = members.groupBy("grp", "n").agg(F.min("id").alias("head"))
    cls = members.join(heads, ["grp", "n"]).join(found.withColumnRenamed("vertex", "id"), "id", "left")
    cls = settle(
        cls.select("head", "id", "n", F.coalesce("component", "id").alias("component"), "bits")
    )
    entries = live.select("token", F.col("id").alias("head"), "pos").join(cls, "head")
    alone = cls.join(several.select(F.col("a").alias("head")).distinct(), "head", "left_semi")
    entries = entries.unionByName(
        alone.withColumn("token", F.xxhash64("head")).withColumn("pos", F.lit(SAME_PREFIX))
    )
    entries = entries.select(
        "token", "id", F.col("n").cast("int").alias("n"), "pos", "component", "bits"
    ).repartition("token")
    weight = entries.groupBy("token", "component").agg(F.count("*").alias("c"))
    main = weight.groupBy("token").agg(
        F.max(F.struct("c", "component")).alias("x"), F.count("*").alias("kinds")
    )
    main = main.where("kinds > 1").select("token", F.col("x.component").alias("main"))
    apart = entries.join(main, "token")
    one = apart.where("component <> main").alias("p")
    two = apart.alias("q")
    p, q = (lambda c: F.col(f"p.{c}")), (lambda c: F.col(f"q.{c}"))
    sizes, needs = _similar(percent, p("n"), q("n"))
    together = (p("pos") == SAME_PREFIX) & (q("pos") == SAME_PREFIX)
    # Nothing before the first shared token is shared, so what follows it must do.
    behind = F.least(p("n") - p("pos"), q("n") - q("pos"))
    met = one.join(
        two,
        (p("token") == q("token"))
        & (p("component") != q("component"))
        & ((q("component") == q("main")) | (p("id") < q("id")))
        & sizes
        & (together | (behind >= needs))
        & (_differ(p("bits"), q("bits")) <= p("n") + q("n") - 2 * needs),
    )
    # A pair comes once for each token that may be its first.
    pairs = met.select(F.least(p("id"), q("id")).alias("a"), F.greatest(p("id"), q("id")).alias("b")).distinct()
    # A pair tried as a star and refused need not be tried again.
    tried = stars.union(stars.select("b", "a"))
    pairs = pairs.join(tried, ["a", "b"], "left_anti")
    more = verified(pairs, docs, size, percent)

    named = rows.join(members.select("one", "two", "n", F.col("id").alias("rep")), ["one", "two", "n"], "left")
    named = settle(named.select("id", "n", F.when(F.col("n") > 0, F.col("rep")).alias("rep")))
    own = named.where("id IS NOT NULL AND rep IS NOT NULL")
    several_texts = own.groupBy("id").agg(F.min("rep").alias("low"), F.max("rep").alias("high"))
    several_texts = several_texts.where("low <> high").select("id", "low")
    same = own.join(several_texts, "id").where("rep <> low").select(F.col("low").alias("a"), F.col("rep").alias("b"))
    final = components(links.union(more).union(same))
    out = named.join(final.withColumnRenamed("vertex", "rep"), "rep", "left")
    return out.select(
        F.col("id").alias("doc_id"),
        F.col("n").alias("n_shingles"),
        F.when(F.col("id").isNotNull(), F.coalesce("component", "rep", "id")).alias("component_id"),
        F.when(F.col("id").isNotNull(), F.coalesce("rep", "id")).alias("class_id"),
    )
