"""BPE encoding and decoding with tree concatenation for long texts.

Words between ASCII white space are encoded apart: the vocabulary files this is for drop white space
and never join over it (``Encoder`` refuses others). A task encodes each distinct word of a piece once
with the tokenizers library and puts the texts together from there. Where the file lower-cases and cuts
words into letters and signs (``by_kind``), common words are put together from the ids of these runs.

A text of more than ``LEAF`` characters is halved until no part is longer, wherever the cuts fall; the
parts are dealt to tasks as rows and encoded in parallel. Then halves are joined level by level: a
window around each join is encoded anew and grows until it begins and ends between words, both
halves hold exactly the window's own tokens there, and the first and last word of the window come out
as in the halves. A text without any white space is one word, so its window grows to the whole.

Defined results: a null text is encoded as the empty text; strings of special tokens in a text become
their ids, as in the library; repeated rows are encoded row by row; a null id is kept.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldguard.llm import words as W

LEAF = 16_384
_PIECE = 2 << 20
# Words kept between pieces of a task; beyond it the older half goes.
_REMEMBERED = 100_000
_LONG_WORD = 64
_TOKENS_AT_ONCE = 1 << 18
_SPACE = re.compile(r"[\t-\r ]")
# The settings under which words of the kinds below are cut into runs encoded each on its own.
_NORMAL = [
    {"type": "NFC"},
    {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
    {"type": "Lowercase"},
]
_CUT = [
    {
        "type": "Split",
        "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
        "behavior": "Removed",
        "invert": True,
    },
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
]
# Letters that are one character in NFC and in lower case; signs without the apostrophe and "<".
_LETTERS = r"A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u012F\u0131-\u017F"
_SIGNS = r"!-&(-/:;=-@[-`{-~"
_KIND = re.compile(f"([{_SIGNS}]*)([{_LETTERS}]*)([{_SIGNS}]*)")


def byte_characters() -> dict[int, str]:
    """The character that stands for each byte: itself where it prints, the next one from 256 on where not."""
    prints = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in prints]
    return {b: chr(256 + i) for i, b in enumerate(others)}


_BYTES = byte_characters()


def by_kind(file_text: str) -> bool:
    """Whether words that match ``_KIND`` may be encoded run by run, in lower case."""
    settings = json.loads(file_text)
    normal, cut, model = settings["normalizer"] or {}, settings["pre_tokenizer"] or {}, settings["model"]
    # A string of a special token must not lie inside such a word.
    apart = not any(_KIND.fullmatch(x["content"]) for x in settings["added_tokens"])
    settled = not (model.get("dropout") or model.get("continuing_subword_prefix"))
    return normal.get("normalizers") == _NORMAL and cut.get("pretokenizers") == _CUT and settled and apart


class Encoder:
    """The tokenizer of one vocabulary file, given as the file's text."""

    def __init__(self, file_text: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(file_text)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.known: dict[bytes, bytes] = {}
        self.by_kind, self.runs = by_kind(file_text), {"": b""}
        a, b = self.plain("ab"), self.plain("c")
        if self.plain(" ab\tc\n") != a + b or not a:
            raise ValueError("the vocabulary must split at white space and drop it")
        mark = self.plain("\x01")
        self.mark = mark[0] if len(mark) == 1 else None
        self.tokens = None

    def plain(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def distinct(self, said: list[str]) -> list[bytes]:
        """Ids of words, many in one call: a mark no other text yields stands between words."""
        out: list[bytes] = []
        if self.mark is None or any("\x01" in x for x in said):
            return [np.array(self.plain(x), np.int32).tobytes() for x in said]
        for low in range(0, len(said), 2000):
            part = said[low : low + 2000]
            ids = np.array(self.plain(" \x01 ".join(part)), np.int32)
            cuts = np.flatnonzero(ids == self.mark)
            assert len(cuts) == len(part) - 1
            out += [x[low > 0 :].tobytes() for low, x in enumerate(np.split(ids, cuts))]
        return out

    def run(self, said: str) -> bytes:
        """Ids of one run of letters or signs, by the library's model alone."""
        if not said.isascii():
            said = said.encode().decode("latin-1").translate(_BYTES)
        return array("i", [t.id for t in self.tokenizer.model.tokenize(said)]).tobytes()

    def words(self, said: list[str]) -> list[bytes]:
        """Ids of words that are not remembered; each run of letters or signs is encoded once."""
        if not self.by_kind:
            return self.distinct(said)
        self.runs = recent(self.runs, 2 * _REMEMBERED)
        runs, out, whole = self.runs, [], []
        for word in said:
            kind = _KIND.fullmatch(word)
            if kind is None or len(word) > _LONG_WORD:
                whole.append(word)
                out.append(None)
                continue
            ids = b""
            for x in kind.groups():
                x = x.lower()
                if x not in runs:
                    runs[x] = self.run(x)
                ids += runs[x]
            out.append(ids)
        others = iter(self.distinct(whole))
        return [next(others) if x is None else x for x in out]

    def batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and where each text ends."""
        found = W.find_words(*W.text_arrays(texts), W.SPACED, hashed=False)
        which, said = found.number, found.distinct.to_pylist()
        self.known = recent(self.known, _REMEMBERED)
        missing = [x for x in said if x not in self.known]
        made = dict(zip(missing, self.words([x.decode() for x in missing]), strict=True))
        ids = [made[x] if x in made else self.known[x] for x in said]
        self.known.update((x, i) for x, i in made.items() if len(x) <= _LONG_WORD)
        flat = np.frombuffer(b"".join(ids), np.int32)
        size = np.array([len(x) // 4 for x in ids], np.int64)
        begin = np.concatenate([[0], np.cumsum(size)])[:-1]
        each = size[which] if len(which) else np.empty(0, np.int64)
        ends = np.cumsum(each)
        total = int(ends[-1]) if len(ends) else 0
        place = np.arange(total) + np.repeat(begin[which] - (ends - each), each) if total else np.empty(0, np.int64)
        by_word = np.concatenate([[0], ends])
        return flat[place], by_word[found.first]

    def texts(self, ids: pa.ListArray) -> pa.Array:
        """What the library's decode gives for each list, with special tokens kept."""
        if self.tokenizer.decoder is not None:
            decode = self.tokenizer.decode
            return pa.array([decode(x or [], skip_special_tokens=False) for x in ids.to_pylist()], pa.string())
        if self.tokens is None:
            size = self.tokenizer.get_vocab_size(with_added_tokens=True)
            self.tokens = pa.array([self.tokenizer.id_to_token(i) for i in range(size)], pa.string())
        said = self.tokens.take(ids.flatten())
        ends = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(ids), 0).to_numpy())])
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), said)
        return pc.binary_join(lists, " ")


def recent(known: dict, limit: int) -> dict:
    """A memory without its older half where it holds more than ``limit``."""
    return known if len(known) <= limit else dict(islice(known.items(), len(known) // 2, None))


def join(encoder: Encoder, left: tuple[str, np.ndarray], right: tuple[str, np.ndarray], width: int = 64):
    """The encoding of two neighbouring parts from theirs: (text, ids)."""
    (a, ids_a), (b, ids_b) = left, right
    while True:
        at = max((a.rfind(c, 0, max(0, len(a) - width)) for c in "\t\n\v\f\r "), default=-1) + 1
        found = _SPACE.search(b, min(len(b), width))
        to = found.start() if found else len(b)
        tail, head = encoder.plain(a[at:]), encoder.plain(b[:to])
        middle = encoder.plain(a[at:] + b[:to])
        before, after = ids_a[: len(ids_a) - len(tail)], ids_b[len(head) :]
        agreed = np.array_equal(ids_a[len(before) :], tail) and np.array_equal(ids_b[: len(head)], head)
        # Words that end inside their own half must come out alike in the window.
        one, two = a[at:].split(maxsplit=1), b[:to].rsplit(maxsplit=1)
        if agreed and len(one) == 2:
            same = encoder.plain(one[0])
            agreed = middle[: len(same)] == same == tail[: len(same)]
        if agreed and len(two) == 2:
            same = encoder.plain(two[1])
            agreed = middle[-len(same) :] == same == head[-len(same) :]
        whole = at == 0 and to == len(b)
        if agreed or whole:
            if whole:
                before, after = ids_a[:0], ids_b[:0]
            return a + b, np.concatenate([before, np.array(middle, np.int32), after]).astype(np.int32)
        width *= 2


def concatenate(encoder: Encoder, parts: list[tuple[str, np.ndarray]]) -> np.ndarray:
    """Join encoded parts pairwise, level by level."""
    while len(parts) > 1:
        joined = [join(encoder, *parts[i : i + 2]) for i in range(0, len(parts) - 1, 2)]
        parts = joined + parts[2 * len(joined) :]
    return parts[0][1]


def halves(text: str, leaf: int) -> list[str]:
    if len(text) <= leaf:
        return [text]
    at = len(text) // 2
    return halves(text[:at], leaf) + halves(text[at:], leaf)


def _lists(ids: np.ndarray, ends: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32()))


def _encode(file_text, columns: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(file_text.value)
        for batch in W.pieces(batches, limit=_PIECE):
            ids = _lists(*encoder.batch(batch.column("text")))
            kept = batch.select(columns)
            yield pa.RecordBatch.from_arrays([*kept.columns, ids], names=[*columns, "ids"])

    return W.tidy(run)


def _cut(leaf: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            others = [n for n in batch.schema.names if n != "text"]
            for i, text in enumerate(batch.column("text").to_pylist()):
                parts = halves(text, leaf)
                row = batch.select(others).take(pa.array([i] * len(parts)))
                yield pa.RecordBatch.from_arrays(
                    [*row.columns, pa.array(range(len(parts)), pa.int32()), pa.array(parts, pa.string())],
                    names=[*others, "_part", "text"],
                )

    return run


def _encode_parts(file_text, columns: list[str]):
    """Parts of texts with their ids, both compressed for the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, pack = Encoder(file_text.value), zstandard.ZstdCompressor(level=3).compress
        for batch in W.pieces(batches, limit=_PIECE):
            ids, ends = encoder.batch(batch.column("text"))
            said = [pack(x.encode()) for x in batch.column("text").to_pylist()]
            made = [pack(ids[a:b].tobytes()) for a, b in zip(ends[:-1], ends[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*batch.select(columns).columns, pa.array(said, pa.binary()), pa.array(made, pa.binary())],
                names=[*columns, "_text", "_ids"],
            )

    return W.tidy(run)


def _join_parts(file_text, kept: list[str]):
    """Rows come sorted by document and part; a task holds the parts of one document at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, expand = Encoder(file_text.value), zstandard.ZstdDecompressor().decompress
        parts: list[tuple[str, np.ndarray]] = []
        row, number = None, None

        def whole() -> pa.RecordBatch:
            ids = concatenate(encoder, parts)
            lists = _lists(ids, np.array([0, len(ids)]))
            return pa.RecordBatch.from_arrays([*row.columns, lists], names=[*kept, "ids"])

        for batch in batches:
            said, made = batch.column("_text"), batch.column("_ids")
            for i, of in enumerate(batch.column("_row").to_pylist()):
                if parts and of != number:
                    yield whole()
                    parts.clear()
                row, number = batch.select(kept).slice(i, 1), of
                ids = np.frombuffer(expand(made[i].as_py()), np.int32)
                parts.append((expand(said[i].as_py()).decode(), ids))
        if parts:
            yield whole()

    return W.tidy(run)


def encode(
    docs: DataFrame, vocabulary: str, leaf: int = LEAF, keep: tuple[str, ...] = ()
) -> DataFrame:
    """doc_id, the ``keep`` columns and ids (array<int>) of every text.

    ``vocabulary`` is the path of a tokenizers JSON file.
    """
    with open(vocabulary, encoding="utf-8") as f:  # a fixed size, read on the driver
        file_text = docs.sparkSession.sparkContext.broadcast(f.read())
    kept = [f"_{c}" for c in ("doc_id", *keep)]
    docs = docs.select(
        *[F.col(c[1:]).alias(c) for c in kept], F.coalesce("text", F.lit("")).alias("text")
    )
    row = docs.schema.fields[:-1]
    ids = T.StructField("ids", T.ArrayType(T.IntegerType()))
    number, part = T.StructField("_row", T.LongType()), T.StructField("_part", T.IntegerType())
    text = docs.schema.fields[-1]
    packed = [T.StructField(c, T.BinaryType()) for c in ("_text", "_ids")]

    short = docs.where(F.length("text") <= leaf)
    encoded = short.mapInArrow(_encode(file_text, kept), T.StructType([*row, ids]))
    long = docs.where(F.length("text") > leaf).withColumn("_row", F.monotonically_increasing_id())
    long = long.select(*kept, "_row", "text")
    parts = long.mapInArrow(_cut(leaf), T.StructType([*row, number, part, text]))
    parts = parts.repartition("_row", "_part").mapInArrow(
        _encode_parts(file_text, [*kept, "_row", "_part"]), T.StructType([*row, number, part, *packed])
    )
    together = parts.repartition("_row").sortWithinPartitions("_row", "_part")
    joined = together.mapInArrow(_join_parts(file_text, kept), T.StructType([*row, ids]))
    made = encoded.unionByName(joined)
    return made.select(*[F.col(c).alias(c[1:]) for c in kept], "ids")


def decode(encoded: DataFrame, vocabulary: str) -> DataFrame:
    """Adds ``decoded``, the text of each row's ``ids``; other columns stay."""
    with open(vocabulary, encoding="utf-8") as f:
        file_text = encoded.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(file_text.value)
        for batch in batches:
            sizes = pc.fill_null(pc.list_value_length(batch.column("ids")), 0).to_numpy()
            total = np.concatenate([[0], np.cumsum(sizes)])
            at = 0
            while at < batch.num_rows:
                to = int(np.searchsorted(total, total[at] + _TOKENS_AT_ONCE, side="right")) - 1
                to = min(batch.num_rows, max(at + 1, to))
                part = batch.slice(at, to - at)
                texts = encoder.texts(part.column("ids"))
                yield pa.RecordBatch.from_arrays([*part.columns, texts], names=[*part.schema.names, "decoded"])
                at = to

    schema = T.StructType([*encoded.schema.fields, T.StructField("decoded", T.StringType())])
    return encoded.mapInArrow(W.tidy(run), schema)
