"""Phrase collocation mining after Toivonen.

A phrase is up to ``most_words`` neighbouring words of one piece of a text (pieces end at punctuation and
line ends). Its count within a language can be no higher than that of its parts, so:

1. A sample of the documents proposes phrases: those it holds at a threshold well below the one asked for.
2. A full pass counts exactly, over all documents, the proposed phrases and their negative border: every
   phrase that is not proposed although the phrase without its last and that without its first word are.
3. Border phrases that reach the threshold were missed by the sample. They join the proposed ones, and an
   expansion pass counts what this adds. It also admits every phrase of frequent words that holds a missed
   one, so it need not go word by word: a frequent phrase that was not counted yet holds a missed phrase, and
   each of its parts is proposed, or missed, or holds a missed one itself. After it the set is closed.

What a pass may count is told to tasks by a bit table of fixed size (``BITS``), filled from the hashes of
the proposed phrases. A hash that coincides only lets more phrases be counted; so does a full table. Counts go by
the words themselves: words are numbered per piece of input by content, counts of a piece leave it
with the phrase's text and are summed by Spark on (lang, phrase), combined before the shuffle.

Scores: f(phrase) * n / (f(first part) * f(rest)), of the worst cut, in exact whole numbers (decimals of
38 digits). A phrase is dropped if a longer candidate with at least ``cover_percent`` of its count holds it.

Defined results: null texts hold no words, a null lang is ``und``; rows with a null or repeated doc_id are
documents like others; ties are ranked by count, then by the phrase's bytes; an empty table gives no rows;
columns besides doc_id, text and lang are not read, so their names cannot clash. A text is one row of one task, however long.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldguard.llm import words as W
from fieldguard.session import settle

LEAST, MOST_WORDS, TOP = 100, 5, 2000
# One document in SAMPLE is in the sample; a phrase is proposed at this share of its due count there.
SAMPLE, LOWERED = 24, 0.7
BITS = 1 << 26
_PIECE = 3 << 20
_BUCKET = 1 << 15  # bits of a row of Spark's bitmap functions
_CUTS = np.zeros(256, bool)
_CUTS[list(b".,;:!?\n\v\f\r")] = True
_IS_WORD = ~_CUTS
_IS_WORD[[0x20, 0x09]] = False


def bits_of(phrases: DataFrame, bits: int) -> np.ndarray:
    """A table of ``bits`` bits with those of the phrases set. Its size bounds what reaches the driver."""
    places = phrases.select("lang", "phrase").mapInArrow(_places(bits), "place long")
    rows = places.groupBy(F.bitmap_bucket_number("place").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits")
    )
    out = np.zeros(bits // 8, np.uint8)
    for bucket, held in rows.collect():
        at = (bucket - 1) * _BUCKET // 8
        part = np.frombuffer(held, np.uint8)[: len(out) - at]
        out[at : at + len(part)] = part
    return out


def _has(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    place = (hashes % np.uint64(len(table) * 8)).astype(np.int64)
    return (table[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1


def _place(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Where a hash has its bit; Spark's bitmap functions count from 1."""
    return (hashes % np.uint64(bits)).astype(np.int64) + 1


class Piece:
    """The words of a few MB of texts, numbered by language and content, and where pieces of texts begin."""

    def __init__(self, batch: pa.RecordBatch):
        data, offsets = W.text_arrays(batch.column("text"))
        found = W.find_words(data, offsets, _IS_WORD, W.LOWER)
        coded = batch.column("lang").cast(pa.large_string()).dictionary_encode()
        self.langs = coded.dictionary
        lang = coded.indices.to_numpy().astype(np.int64)[found.doc]
        self.words_of = np.bincount(lang, minlength=len(self.langs))
        self.distinct = found.distinct.cast(pa.large_string())
        self.keys, self.number = np.unique(found.number.astype(np.int64) * max(1, len(self.langs)) + lang, return_inverse=True)
        seeds = np.fromiter((W.content_hash(x.encode()) for x in self.langs.to_pylist()), np.uint64, len(self.langs))
        self.hash = W.mix(found.hash + seeds[lang])
        stops = np.concatenate([[0], np.cumsum(_CUTS[found.data], dtype=np.int64)])[found.start]
        # Whether a word cannot follow the one before it in a phrase.
        self.begins = np.ones(len(lang), bool)
        self.begins[1:] = (stops[1:] != stops[:-1]) | (found.doc[1:] != found.doc[:-1])

    def text(self, columns: list[np.ndarray]) -> tuple[pa.Array, pa.Array]:
        """Languages and texts of phrases given by the numbers of their words."""
        langs = max(1, len(self.langs))
        held = [self.distinct.take(pa.array(self.keys[c] // langs)) for c in columns]
        said = held[0] if len(held) == 1 else pc.binary_join_element_wise(*held, pa.scalar(" ", pa.large_string()))
        return self.langs.take(pa.array(self.keys[columns[0]] % langs)), said


def count_piece(piece: Piece, most_words: int, now=None, missed=None) -> Iterator[tuple]:
    """(lang, phrase, count) arrays of what this pass counts, size by size.

    ``now``: bits of the proposed phrases (None: all phrases count); a phrase is admitted if those it
    begins and ends with, one word shorter, are proposed. ``missed``: in the expansion pass, bits of the
    frequent phrases that were not proposed. Phrases that hold one count as proposed while all their
    words are frequent; what the full pass admitted is counted already.
    """
    n = len(piece.number)
    if not n:
        return
    at, numbers, level = np.arange(n), piece.number, piece.hash
    expands = missed is not None
    old = np.full(n, expands)
    # By the first word of a window of the size before: whether it holds a missed phrase, and frequent words only.
    holds = _has(missed, level) if expands else None
    common = _has(now, level) | holds if expands else None
    for size in range(1, most_words + 1):
        if size > 1:
            last = at + size - 1
            fits = last < n
            fits[fits] = ~piece.begins[last[fits]]
            at, numbers, old = at[fits], numbers[fits], old[fits]
            if now is not None:
                proposed = _has(now, level)
                old = old & proposed[at] & proposed[at + 1]
                if expands:
                    proposed |= holds & common
                admitted = proposed[at] & proposed[at + 1]
                at, numbers, old = at[admitted], numbers[admitted], old[admitted]
            numbers = numbers * len(piece.keys) + piece.number[at + size - 1]
            level = W.rolling(piece.hash, size)
            if expands:
                holds = holds[:-1] | holds[1:] | _has(missed, level)
                common = common[:-1] & common[1:]
        if not len(at):
            return
        _, first, numbers, count = np.unique(numbers, return_index=True, return_inverse=True, return_counts=True)
        fresh = ~old[first]
        if fresh.any():
            begin = at[first[fresh]]
            said = piece.text([piece.number[begin + i] for i in range(size)])
            yield (*said, count[fresh])


def _counts(docs: DataFrame, most_words: int, least: int, now=None, missed=None) -> DataFrame:
    """One pass: lang, phrase, size, f of the phrases that occur ``least`` times, counted over ``docs``.

    Rows of size 0 (phrase '') have the number of all words of a language.
    """
    sc = docs.sparkSession.sparkContext
    now, missed = (None if x is None else sc.broadcast(x) for x in (now, missed))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = [None if x is None else x.value for x in (now, missed)]
        for batch in W.pieces(batches, limit=_PIECE):
            piece = Piece(batch)
            total = (piece.langs, pa.array([""] * len(piece.langs), pa.large_string()), piece.words_of)
            for lang, phrase, count in chain([total], count_piece(piece, most_words, *tables)):
                columns = [lang.cast(pa.string()), phrase.cast(pa.string()), pa.array(count.astype(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, names=["lang", "phrase", "f"])

    counted = docs.mapInArrow(run, "lang string, phrase string, f long").groupBy("lang", "phrase").agg(F.sum("f").alias("f"))
    size = F.when(F.col("phrase") == "", 0).otherwise(F.length("phrase") - F.length(F.replace("phrase", F.lit(" "), F.lit(""))) + 1)
    return settle(counted.where((F.col("f") >= least) | (F.col("phrase") == "")).withColumn("size", size))


def _places(bits: int):
    """Where the bit of each phrase is: by the hash that its words have in ``Piece``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, said = batch.column("lang").to_pylist(), batch.column("phrase").to_pylist()
            seeds = {x: W.content_hash(x.encode()) for x in set(langs)}
            sizes = np.array([x.count(" ") + 1 for x in said], np.int64)
            words = np.array([W.content_hash(w.encode()) for x in said for w in x.split(" ")] or [], np.uint64)
            lang = np.repeat(np.array([seeds[x] for x in langs], np.uint64), sizes)
            mixed, first = W.mix(words + lang), np.cumsum(sizes) - sizes
            out = np.zeros(len(said), np.int64)
            for size in np.unique(sizes).tolist():
                level = mixed if size == 1 else W.rolling(mixed, size)
                out[sizes == size] = _place(level[first[sizes == size]], bits)
            yield pa.RecordBatch.from_arrays([pa.array(out)], names=["place"])

    return run


def frequent(
    docs: DataFrame, least: int = LEAST, most_words: int = MOST_WORDS, sample: int = SAMPLE, lowered: float = LOWERED, bits: int = BITS
) -> DataFrame:
    """lang, phrase, size, f of every phrase with at least ``least`` occurrences in its language, counted exactly.

    Rows of size 0 (phrase '') give the number of words of each language.
    """
    docs = docs.select("doc_id", "text", F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"))
    some = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(sample)) == 0).select("text", "lang")
    docs = docs.select("text", "lang")
    proposed = _counts(some, most_words, max(1, math.ceil(lowered * least / sample)))
    now = bits_of(proposed.where("size > 0"), bits)
    found = _counts(docs, most_words, least, now)
    missed = bits_of(found.where("size > 0"), bits) & ~now
    if missed.any():
        further = _counts(docs, most_words, least, now, missed)
        found = found.unionByName(further.where("size > 0"))
    return found


def _joined(words: Column, first: Column, count: Column) -> Column:
    return F.array_join(F.slice(words, first, count), " ")


def collocations(
    docs: DataFrame, least: int = LEAST, most_words: int = MOST_WORDS, top: int = TOP, cover_percent: int = 100, **how
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's ``top`` phrases of two words and more."""
    found = settle(frequent(docs, least, most_words, **how))
    totals = found.where("size = 0").select("lang", F.col("f").alias("n"))
    parts = found.where("size > 0").select("lang", F.col("phrase").alias("part"), F.col("f").alias("count"))
    candidates = found.where("size > 1").select("lang", "phrase", "size", F.col("f").alias("a"))
    worded = candidates.withColumn("words", F.split("phrase", " "))

    cut = F.explode(F.sequence(F.lit(1), F.col("size") - 1))
    cuts = worded.select("lang", "phrase", "a", "size", "words", cut.alias("k"))
    cuts = cuts.select(
        "lang", "phrase", "a", "k", _joined(F.col("words"), F.lit(1), F.col("k")).alias("left"),
        _joined(F.col("words"), F.col("k") + 1, F.col("size") - F.col("k")).alias("right"),
    )
    cuts = cuts.join(parts.withColumnsRenamed({"part": "left", "count": "l"}), ["lang", "left"])
    cuts = cuts.join(parts.withColumnsRenamed({"part": "right", "count": "r"}), ["lang", "right"])
    whole = lambda c: F.col(c).cast("decimal(20,0)")
    over = F.lit(1000).cast("decimal(5,0)") * (whole("a") * whole("n")).cast("decimal(38,0)")
    cuts = cuts.join(totals, "lang").withColumns({"_over": over, "_under": whole("l") * whole("r")})
    scored = cuts.withColumn("score", F.expr("_over div _under"))
    scored = scored.groupBy("lang", "phrase").agg(
        F.min(F.struct("score", "k", "a", "l", "r", "n")).alias("worst")
    ).select("lang", "phrase", "worst.*")

    # Every shorter phrase inside a candidate, with the highest count of those that hold it.
    place = F.expr(
        "flatten(transform(sequence(2, size - 1), m -> transform(sequence(1, size - m + 1), s -> array_join(slice(words, s, m), ' '))))"
    )
    inside = worded.where("size > 2").select("lang", "a", F.explode(place).alias("phrase"))
    inside = inside.groupBy("lang", "phrase").agg(F.max("a").alias("_longer"))
    kept = scored.join(inside, ["lang", "phrase"], "left")
    kept = kept.where(F.coalesce(F.col("_longer") * 100 < F.col("a") * cover_percent, F.lit(True)))

    # The best of slices first, so that a hot language is not ranked in one task.
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    sliced = kept.withColumn("_slice", F.pmod(F.xxhash64("phrase"), F.lit(64)))
    sliced = sliced.withColumn("_nth", F.row_number().over(Window.partitionBy("lang", "_slice").orderBy(*order)))
    ranked = sliced.where(F.col("_nth") <= top)
    ranked = ranked.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return ranked.where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
