"""Toxicity scores with noisy-channel deobfuscation.

A writer who hides a word sends it through a channel: letters become look-alike digits and signs, are
repeated, or are set apart by spaces and dots. ``restore`` finds the places where that may have
happened, builds the lattice of what each character may stand for, and decodes it with Viterbi under
a character language model (4-grams, counted over all documents). The restored text is then scored
by a logistic model of the words it holds. Signs that plain text has as well (a letter doubled once,
a sign at a word's end, three spaced letters, wide blanks) add the decoded reading to the words as they stand.

The language model is a table of fixed size. The word model is fitted on at most ``TRAIN_ROWS`` labelled
rows (those with the least hash of their id), never on held-out ones; its features are the at most
``MOST_TRAITS`` words and beginnings of words that tell most in that sample. All documents are scored over their whole texts.

Defined results: null and empty texts get the score of no evidence; rows are scored one by one, so
repeats score alike; a null doc_id counts as held out; labels that are null teach nothing.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldguard.llm import words as W
from fieldguard.session import settle

TRAIN_ROWS, THRESHOLD = 10_000, 0.3
# Bytes of a word's beginnings that are features besides the word.
STEMS = (4, 5, 6)
MOST_TRAITS = 4000
_PIECE = 1 << 19
# The language model's letters: a to z, the edge of a word, any other letter.
EDGE, OTHER, LETTERS = 26, 27, 28
_CELLS, _SLICES = LETTERS**4, 16
# What a sign may stand for.
LOOKS_LIKE = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t",
}
SEPARATORS = " .-_*~"
# What may follow a word: look-alikes among it, and what is punctuation only.
CLOSERS, PUNCTUATION = "!*$%&#.,:;?)\"'|+~-_", ".,;:?\"'()[]{}"
# Costs in nats: a look-alike, a dropped repeat, a dropped separator, a kept one, a dropped sign.
SWAP, REPEAT, APART, BREAK, NOISE = 0.7, 0.4, 0.2, 2.0, 3.0
_STATES = 64
_CONTEXTS = LETTERS**3
_START = (EDGE * LETTERS + EDGE) * LETTERS + EDGE


def _set(*chars: str) -> np.ndarray:
    found = np.zeros(256, bool)
    for c in "".join(chars):
        found[ord(c)] = True
    return found


_ALPHA = "abcdefghijklmnopqrstuvwxyz"
_IS_LETTER = _set(_ALPHA, _ALPHA.upper())
_IS_DIGIT = _set("0123456789")
_IS_SIGN = _set("".join(LOOKS_LIKE), "*")
_IS_SEPARATOR = _set(SEPARATORS.strip())
_IS_WORD = _IS_LETTER | (W.SAME >= 0x80)
_CODE = np.full(256, EDGE, np.int32)
_CODE[np.flatnonzero(_IS_LETTER)] = [(chr(i).lower().encode()[0] - 97) for i in np.flatnonzero(_IS_LETTER)]
_CODE[0xC0:] = OTHER


# ---- language model


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(_CELLS, np.int64)
    for batch in W.pieces(batches, limit=_PIECE):
        data, _ = W.text_arrays(batch.column("text"))
        data = data[(data < 0x80) | (data >= 0xC0)]  # one byte for each character
        codes = _CODE[data]
        if len(codes) >= 4:
            grams = ((codes[:-3] * LETTERS + codes[1:-2]) * LETTERS + codes[2:-1]) * LETTERS + codes[3:]
            counts += np.bincount(grams, minlength=_CELLS)
    if counts.any():
        press = zstandard.ZstdCompressor(level=1).compress
        parts = [press(x.tobytes()) for x in np.split(counts, _SLICES)]
        yield pa.RecordBatch.from_pydict(
            {"slice": pa.array(range(_SLICES), pa.int32()), "counts": pa.array(parts, pa.binary())}
        )


def _sum(
    key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]
) -> Iterator[pa.RecordBatch]:
    total = np.zeros(_CELLS // _SLICES, np.int64)
    expand = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        for blob in batch.column("counts").to_pylist():
            total += np.frombuffer(expand(blob), np.int64)
    yield pa.RecordBatch.from_pydict(
        {"slice": pa.array([key[0].as_py()], pa.int32()), "counts": pa.array([total.tobytes()], pa.binary())}
    )


def language_model(docs: DataFrame) -> np.ndarray:
    """Cost of a letter after three others, smoothed by what follows two and one of them."""
    parts = docs.select("text").mapInArrow(_count, "slice int, counts binary")
    counts = np.zeros((_SLICES, _CELLS // _SLICES), np.float64)
    for i, blob in parts.groupBy("slice").applyInArrow(_sum, "slice int, counts binary").collect():
        counts[i] = np.frombuffer(blob, np.int64)
    four = counts.reshape((LETTERS,) * 4)
    lower = np.full(LETTERS, 1 / LETTERS)
    for axes in ((0, 1, 2), (0, 1), (0,), ()):
        n = four.sum(axis=axes) if axes else four
        total = n.sum(axis=-1, keepdims=True)
        lower = (n + 5 * lower) / (total + 5)
    return (-np.log(lower)).astype(np.float32)


# ---- decoding


def _options(text: str, i: int, repeat: float = REPEAT) -> list[tuple[str, float]]:
    """What the character may stand for, and the channel's cost; the empty string drops it."""
    c = text[i]
    if "a" <= c <= "z":
        again = i > 0 and text[i - 1] == c
        return [(c, 0.0), ("", repeat)] if again else [(c, 0.0)]
    out = [(x, SWAP) for x in LOOKS_LIKE.get(c, "")]
    if c in SEPARATORS:
        out += [("", APART), (" ", BREAK)]
        if c == "*":
            out += [(x, math.log(26)) for x in _ALPHA]
    elif c in LOOKS_LIKE:
        out += [("", NOISE if i == 0 or text[i - 1] != c else repeat), (" ", BREAK + SWAP)]
    else:
        out.append((c, 0.0))
    return out


def _letter(c: str) -> int:
    if "a" <= c <= "z":
        return ord(c) - 97
    return OTHER if c.isalpha() else EDGE


@lru_cache(maxsize=1 << 12)
def _choices(c: str, again: bool, repeat: float) -> tuple[tuple[str, float, int], ...]:
    """The options of a character that follows its like or not: text, cost and letter (-1: dropped)."""
    options = _options(c + c, 1, repeat) if again else _options(c, 0, repeat)
    return tuple((x, cost, _letter(x) if x else -1) for x, cost in options)


def decode(said: str, model: list[float], repeat: float = REPEAT) -> str:
    """The likeliest text behind an obfuscated one: Viterbi over the lattice of its characters.

    ``model``: the language model's costs as a flat list. A first search keeps the ``_STATES`` cheapest contexts
    a character. Where it had to leave some out, its reading is only a bound: the second search keeps every
    context that is not dearer than it already (costs are never negative), so the result is the exact best.
    """
    text = said.lower()
    found, cost, whole = _search(text, model, repeat, _STATES, math.inf)
    if not whole:
        found, _, _ = _search(text, model, repeat, None, cost + 1e-9)
    return found


def _search(text: str, model: list[float], repeat: float, most: int | None, bound: float) -> tuple[str, float, bool]:
    """Reading, its cost, and whether no context was left out for ``most``."""
    lattice = [_choices(c, c == before, repeat) for before, c in zip(["", *text], text)]
    bounded = bound < math.inf
    if bounded:
        # What the characters from each place on cost at least: their cheapest options.
        ahead = [0.0] * (len(text) + 1)
        for i in range(len(text) - 1, -1, -1):
            ahead[i] = ahead[i + 1] + min(cost for _, cost, _ in lattice[i])
    # By the last three letters, as one number: cost, and the letters so far as a chain.
    states: dict[int, tuple[float, tuple | None]] = {_START: (0.0, None)}
    tail, whole, limit = len(text.rstrip(SEPARATORS)), True, math.inf
    for i, options in enumerate(lattice):
        if bounded:
            limit = bound - ahead[i + 1]
        if i >= tail:  # a path that costs more than dropping all the rest can't be the best
            rest = APART * (len(text) - i) + 1e-6
            limit = min(limit if bounded else math.inf, *[cost + rest + model[c * LETTERS + EDGE] for c, (cost, _) in states.items()])
        elif len(states) == 1 and len(options) == 1 and not bounded:
            # One way so far and one way on, as with most letters.
            [(context, (cost, chain))], [(x, channel, code)] = states.items(), options
            at = context * LETTERS + code
            states = {at % _CONTEXTS: (cost + channel + model[at], (x, chain))}
            continue
        after: dict[int, tuple[float, tuple | None]] = {}
        for context, (cost, chain) in states.items():
            row = context * LETTERS
            for x, channel, code in options:
                if code < 0:
                    key, now, link = context, cost + channel, chain
                else:
                    key = (row + code) % _CONTEXTS
                    now, link = cost + channel + model[row + code], (x, chain)
                if now > limit:
                    continue
                if key not in after or now < after[key][0]:
                    after[key] = (now, link)
        if most is not None and len(after) > most:
            after = dict(sorted(after.items(), key=lambda s: s[1][0])[:most])
            whole = False
        states = after
    context, (cost, chain) = min(states.items(), key=lambda s: s[1][0] + model[s[0] * LETTERS + EDGE])
    out = []
    while chain is not None:
        x, chain = chain
        out.append(x)
    return "".join(reversed(out)), cost + model[context * LETTERS + EDGE], whole


# How a byte run may be obfuscated: as plain text never is, as plain text may be too, by spacing.
SURE, MAYBE, SPELLED = 0, 1, 2


def suspects(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and kind of the byte runs that may be obfuscated."""
    found = W.find_words(data, offsets, W.SPACED, numbered=False)
    n = len(data)
    letter, sign, digit = _IS_LETTER[data], _IS_SIGN[data], _IS_DIGIT[data]
    lowered, apart = W.LOWER[data], _IS_SEPARATOR[data]

    def ahead(x: np.ndarray, k: int) -> np.ndarray:
        out = np.zeros(n, bool)
        if k < n:
            out[: n - k] = x[k:]
        return out

    def behind(x: np.ndarray) -> np.ndarray:
        out = np.zeros(n, bool)
        out[1:] = x[:-1]
        return out

    begins = np.zeros(n, bool)
    begins[found.start] = True
    inner = sign & ahead(letter, 1) & (begins | behind(letter) | behind(sign))
    closing = digit & behind(letter)
    next_same = np.zeros(n, bool)
    next_same[:-1] = lowered[1:] == lowered[:-1]
    repeated = letter & next_same & ahead(next_same, 1)
    spelled = (begins | behind(apart)) & letter & ahead(apart, 1) & ahead(letter, 2) & ahead(apart, 3) & ahead(letter, 4)
    signed = sign & (behind(letter) | behind(sign))

    def held(x: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(x)])
        return sums[found.end] > sums[found.start]

    sure = held(inner | closing | repeated | spelled)
    maybe = held((letter & next_same) | signed) & held(letter)
    # A mark belongs to the word it begins in, and must not reach past it: texts may touch.
    single = (found.end - found.start == 1) & letter[found.start]
    joins = np.zeros(len(single), bool)
    gap = found.start[1:] - found.end[:-1]
    blanks = np.concatenate([[0], np.cumsum(data == 0x20)])
    blank = blanks[found.start[1:]] - blanks[found.end[:-1]] == gap
    joins[1:] = single[1:] & single[:-1] & (found.doc[1:] == found.doc[:-1]) & ((gap <= 2) | blank)
    head = np.flatnonzero(single & ~joins)
    run = np.cumsum(single & ~joins)
    lengths = np.bincount(run[single], minlength=len(head) + 1)[1:] if len(head) else np.empty(0, np.int64)
    spaced = head[lengths >= 3]
    spaced_end = spaced + lengths[lengths >= 3] - 1
    inside = np.zeros(len(single) + 1, np.int64)
    np.add.at(inside, spaced, 1)
    np.add.at(inside, spaced_end + 1, -1)
    alone = np.flatnonzero((sure | maybe) & (np.cumsum(inside)[:-1] == 0))
    kind = np.concatenate([np.where(sure[alone], SURE, MAYBE), np.full(len(spaced), SPELLED)])
    start = np.concatenate([found.start[alone], found.start[spaced]])
    end = np.concatenate([found.end[alone], found.end[spaced_end]])
    order = np.argsort(start, kind="stable")
    return start[order], end[order], kind[order]


class Restorer:
    def __init__(self, model: np.ndarray):
        self.model = model.ravel().tolist()
        self.known: dict[tuple[bytes, int], bytes] = {}
        self.decoded: dict[tuple[str, float], str] = {}

    def decode(self, said: str, repeat: float = REPEAT) -> str:
        """As ``decode``; short texts are decoded once, in whatever case and with whatever signs after them."""
        text = said.lower()
        if len(text) > 40:
            return decode(text, self.model, repeat)
        out = self.decoded.get((text, repeat))
        if out is None:
            if len(self.decoded) > 50_000:
                self.decoded.clear()
            out = self.decoded[text, repeat] = decode(text, self.model, repeat)
        return out

    def readings(self, text: str, kind: int) -> list[str]:
        if kind == SPELLED:
            parts = re.split("( {3,})", text)
            first = "".join([self.decode(x) if len(x.split()) >= 4 else x for x in parts])
            return [first] if len(parts) == 1 and first != text else [first, self.decode(text)]
        core, whole = text.rstrip(CLOSERS), text.rstrip(PUNCTUATION)
        out = [self.decode(core) + text[len(core) :]]
        if kind == MAYBE:
            out.insert(0, text)
        if kind == MAYBE or len(whole) > len(core):
            # A sign at the end may be a letter, and what is there twice may be meant twice.
            if len(whole) > len(core):
                out.append(self.decode(whole))
            out.append(self.decode(whole, NOISE))
        return out

    def one(self, said: bytes, kind: int) -> bytes:
        """The readings of a suspect, each once."""
        out = self.known.get((said, kind))
        if out is None:
            out = " ".join(dict.fromkeys(self.readings(said.decode(), kind))).encode()
            if len(said) <= 40:
                if len(self.known) > 100_000:
                    self.known.clear()
                self.known[said, kind] = out
        return out

    def restore(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Bytes and offsets of the restored texts."""
        data, offsets = W.text_arrays(texts)
        start, end, kinds = suspects(data, offsets)
        if not len(start):
            return data, offsets
        raw, parts, at = data.tobytes(), [], 0
        grown = np.zeros(len(start), np.int64)
        for i, (a, b, kind) in enumerate(zip(start.tolist(), end.tolist(), kinds.tolist(), strict=True)):
            new = self.one(raw[a:b], kind)
            parts += [raw[at:a], new]
            grown[i], at = len(new) - (b - a), b
        parts.append(raw[at:])
        shift = np.concatenate([[0], np.cumsum(grown)])
        out = np.frombuffer(b"".join(parts), np.uint8)
        return out, offsets + shift[np.searchsorted(end, offsets, side="right")]


# ---- the word model


@dataclass
class WordModel:
    words: np.ndarray  # sorted hashes of traits
    weights: np.ndarray
    bias: float

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        count = len(offsets) - 1
        doc, at = features(data, offsets, self.words)
        sums = np.bincount(doc, self.weights[at], minlength=count) + self.bias
        return 1 / (1 + np.exp(-np.clip(sums, -30, 30)))


def _traits(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Document and hash of every word and of its beginnings: stems come with many endings."""
    found = W.find_words(data, offsets, _IS_WORD, W.LOWER)
    docs, values = [found.doc], [found.hash]
    for size in STEMS:
        long = found.end - found.start > size
        start = found.start[long]
        docs.append(found.doc[long])
        values.append(W.mix(W.span_hashes(found.data, start, start + size) ^ np.uint64(size)))
    return np.concatenate(docs), np.concatenate(values)


def distinct_traits(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Document and hash of every distinct trait, in order of both."""
    doc, value = _traits(data, offsets)
    order = np.lexsort((value, doc))
    doc, value = doc[order], value[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])
    return doc[new], value[new]


def features(data, offsets, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Document and place in ``known`` of the known traits of each text, once each."""
    if not len(known):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    doc, value = _traits(data, offsets)
    at = np.searchsorted(known, value)
    at[at == len(known)] = 0
    hit = known[at] == value
    pairs = np.unique(doc[hit] * len(known) + at[hit])
    return pairs // len(known), pairs % len(known)


def telling(taught: DataFrame, most: int | None = MOST_TRAITS, least_z: float = 6.0) -> np.ndarray:
    """Sorted hashes of the traits whose count among toxic rows lies furthest over chance.

    ``taught``: traits (array<long>), toxic. At most ``most`` traits (None: all), each at least ``least_z``
    deviations over it and in 3 rows. Only signs of toxicity count, so a text without any scores low.
    """
    n, toxic = taught.agg(F.count("*"), F.sum("toxic")).first()
    share = min(max((toxic or 0) / max(n, 1), 1e-4), 1 - 1e-4)
    counts = taught.select(F.explode("traits").alias("trait"), "toxic").groupBy("trait")
    counts = counts.agg(F.count("*").alias("n"), F.sum("toxic").alias("among")).where("n >= 3")
    far = (F.col("among") - F.col("n") * share) / F.sqrt(F.col("n") * (share * (1 - share)))
    top = counts.withColumn("z", far).where(F.col("z") >= least_z).orderBy(F.desc("z"), "trait")
    top = top if most is None else top.limit(most)
    return np.sort(np.array([r[0] for r in top.select("trait").collect()], np.int64).view(np.uint64))


def fit(
    known: np.ndarray, rows: list[tuple[list[int], int]], rounds: int = 200, decay: float = 0.3
) -> WordModel:
    """Logistic regression on the presence of traits, with a ridge; ``rows``: places in ``known``, label."""
    if not rows:
        return WordModel(known[:0], np.empty(0), math.log(0.05 / 0.95))
    label = np.array([y for _, y in rows], np.float64)
    toxic = min(max(label.mean(), 1e-4), 1 - 1e-4)
    bias = math.log(toxic / (1 - toxic))
    row = np.repeat(np.arange(len(rows)), [len(x) for x, _ in rows])
    at = np.array([i for x, _ in rows for i in x], np.int64)
    weights, speed, speed_bias = np.zeros(len(known)), np.zeros(len(known)), 0.0
    # Steps are scaled by each trait's gradients so far, so frequent and rare ones move alike.
    for _ in range(rounds):
        sums = np.bincount(row, weights[at], minlength=len(rows)) + bias
        wrong = 1 / (1 + np.exp(-np.clip(sums, -30, 30))) - label
        gradient = np.bincount(at, wrong[row], minlength=len(known)) + decay * weights
        speed += gradient**2
        weights -= 0.3 * gradient / np.sqrt(speed + 1e-8)
        speed_bias += wrong.sum() ** 2
        bias -= 0.3 * wrong.sum() / math.sqrt(speed_bias + 1e-8)
    return WordModel(known, weights, float(bias))


def is_held_out(doc_id: Column) -> Column:
    text = doc_id.cast("string")
    return F.coalesce(F.crc32(F.encode(text, "UTF-8")) % 4 == 2, F.lit(True))


def training_sample(labels: DataFrame, limit: int = TRAIN_ROWS) -> DataFrame:
    """doc_id, toxic of at most ``limit`` labelled rows that are not held out."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
    known = known.where(~is_held_out(F.col("doc_id")))
    one = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").alias("toxic"))
    return one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)


def _restored_traits(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(model.value)
        for batch in W.pieces(batches, limit=_PIECE):
            doc, value = distinct_traits(*restorer.restore(batch.column("text")))
            cuts = np.searchsorted(doc, np.arange(batch.num_rows + 1))
            traits = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(value.view(np.int64)))
            yield pa.RecordBatch.from_arrays([traits, batch.column("toxic")], names=["traits", "toxic"])

    return W.tidy(run)


def _places(known):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("traits")
            sizes = np.diff(lists.offsets.to_numpy())
            flat = lists.flatten().to_numpy().view(np.uint64)
            row = np.repeat(np.arange(len(lists)), sizes)
            at = np.searchsorted(known.value, flat)
            at[at == len(known.value)] = 0
            hit = known.value[at] == flat if len(known.value) else np.zeros(len(flat), bool)
            cuts = np.searchsorted(row[hit], np.arange(len(lists) + 1))
            places = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(at[hit], pa.int64()))
            yield pa.RecordBatch.from_arrays([places, batch.column("toxic")], names=["places", "toxic"])

    return run


def _score(model, words):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(model.value)
        for batch in W.pieces(batches, limit=_PIECE):
            scores = words.value.scores(*restorer.restore(batch.column("text")))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(scores, pa.float64())], names=[*batch.schema.names, "_score"]
            )

    return W.tidy(run)


@dataclass
class Scorer:
    """The two fitted models, as broadcasts."""

    model: object
    words: object

    @classmethod
    def fit(cls, docs: DataFrame, labels: DataFrame, limit: int = TRAIN_ROWS) -> Scorer:
        sc = docs.sparkSession.sparkContext
        model = sc.broadcast(language_model(docs))
        # At most ``limit`` small rows, so they can be broadcast.
        sample = F.broadcast(settle(training_sample(labels, limit)))
        texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(sample, "doc_id")
        taught = settle(
            texts.select("text", (F.col("toxic") == 1).cast("int").alias("toxic")).mapInArrow(
                _restored_traits(model), "traits array<long>, toxic int"
            )
        )
        known = telling(taught)
        # A row of a few of the chosen traits for each sampled document.
        rows = taught.mapInArrow(_places(sc.broadcast(known)), "places array<long>, toxic int").collect()
        return cls(model, sc.broadcast(fit(known, [(r[0], r[1]) for r in rows])))

    def score(self, texts: DataFrame) -> DataFrame:
        """Adds (or replaces) ``_score`` in rows with a column ``text``; other columns are kept."""
        texts = texts.drop("_score")
        schema = T.StructType([*texts.schema.fields, T.StructField("_score", T.DoubleType())])
        return texts.mapInArrow(_score(self.model, self.words), schema)


def score_documents(
    docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, limit: int = TRAIN_ROWS
) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    scored = Scorer.fit(docs, labels, limit).score(docs.select("doc_id", "text"))
    return scored.select(
        "doc_id",
        is_held_out(F.col("doc_id")).alias("held_out"),
        F.col("_score").alias("score"),
        (F.col("_score") >= threshold).cast("int").alias("predicted"),
    )
