"""Cross-tokenizer alignment by diagonal run skipping.

Two tokenizers cut the same bytes (a space and the text) differently. Places where tokens of both end
cut the tokens into groups. ``runs`` finds them: while tokens correspond one to one, the arrays of
token ends agree at the current index shift, so slices of doubling length are compared and the first
difference is found by halving; an irregular group is walked token by token to the next common end,
which gives the next shift. Within a group every pair of tokens whose bytes overlap is a link.

``align`` gives the tokens and groups of every text. ``link_statistics`` also counts every (A id, B id)
pair over the whole corpus and tells each document how its links compare. A task writes its documents'
links with the number of their piece (a few MB of texts); the distinct pairs of each piece are summed
and looked up by a join on the pair and return to their piece, so no count table is ever in one place.

Token bytes: A's entry decoded from the byte-level alphabet; B's piece with U+2581 as space and <0xHH>
as a byte. Chunks between spaces are encoded once a piece, where the vocabularies never join over a space.
Defined results: texts that are null, empty, or that either tokenizer does not give back
byte for byte have no tokens; strings of special tokens inside texts are plain text; repeated rows are
documents of their own and all count; null ids are kept; an empty table gives an empty table; columns
besides doc_id and text are left out, so their names cannot clash. A text is one row of one task, however long.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldguard.llm import exchange
from fieldguard.llm import words as W
from fieldguard.session import settle

# Bytes of text whose distinct pairs are looked up together, and bytes encoded in one call.
PIECE, _CALL = 2 << 20, 256 << 10
_SPACE_MARK = "▁"
# Chunks whose ids a task remembers.
_REMEMBERED = 300_000


def _but(*codes: int) -> np.ndarray:
    found = np.ones(256, bool)
    found[list(codes)] = False
    return found


# Bytes before a cut, and bytes after its space: no white space (first bytes of Unicode's white space neither).
_VISIBLE = _but(*range(0x21), 0x7F)
_FOLLOWS = _VISIBLE & _but(0xC2, 0xE1, 0xE2, 0xE3)


def byte_alphabet() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for.

    Printable Latin-1 characters stand for themselves, all other bytes for U+0100 and on in their order.
    """
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(others)}


class Pair:
    """Both tokenizers of a task, and the bytes of their tokens. Lives as long as the task."""

    def __init__(self, file_a: str, file_b: bytes):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(file_a)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=file_b)
        letters = byte_alphabet()
        said = [self.a.id_to_token(i) or "" for i in range(self.a.get_vocab_size(with_added_tokens=True))]
        bytes_a = [bytes(letters.get(c, 0x3F) for c in x) for x in said]
        size_b = self.b.get_piece_size()
        named = [self.b.id_to_piece(i) for i in range(size_b)]
        bytes_b = [
            bytes([int(x[3:5], 16)]) if self.b.is_byte(i) else x.replace(_SPACE_MARK, " ").encode()
            for i, x in enumerate(named)
        ]
        self.size_b = size_b
        self.known: dict[bytes, tuple[bytes, bytes] | None] = {}
        pattern = json.loads(file_a)
        self.cuttable = (
            pattern.get("normalizer") is None
            and (pattern.get("pre_tokenizer") or {}).get("type") == "ByteLevel"
            and (pattern.get("pre_tokenizer") or {}).get("use_regex", True)
            and not any(_SPACE_MARK in x.lstrip(_SPACE_MARK) for x in named)
        )
        self.bytes_a, self.bytes_b = pa.array(bytes_a, pa.large_binary()), pa.array(bytes_b, pa.large_binary())
        self.long_a, self.long_b = (np.array([len(x) for x in xs], np.int64) for xs in (bytes_a, bytes_b))
        # Decimal ids with the sign that follows: inside a group, and at the end of its side.
        count = len(bytes_a)
        self.spelled = pa.array(
            [f"{i}{c}".encode() for n, c in ((count, ","), (count, "|"), (size_b, ","), (size_b, ";")) for i in range(n)],
            pa.large_binary(),
        )
        self.first_spelled = (0, count, 2 * count, 2 * count + size_b)

    def cut(self, data: np.ndarray, offsets: np.ndarray, whole: np.ndarray) -> tuple[pa.Array, np.ndarray]:
        """Chunks of texts (each with its leading space) that both tokenizers encode apart, and their texts.

        A chunk begins at a space after visible and before other than white space. There the byte-level
        pattern always begins a new word, and no piece of B runs on over a space. ``whole``: texts not to cut.
        """
        begins = np.zeros(len(data), bool)
        if self.cuttable and len(data) > 2:
            begins[1:-1] = (data[1:-1] == 0x20) & _VISIBLE[data[:-2]] & _FOLLOWS[data[2:]]
        for i in np.flatnonzero(whole):
            begins[offsets[i] : offsets[i + 1]] = False
        begins[offsets[:-1][np.diff(offsets) > 0]] = True
        start = np.flatnonzero(begins)
        text = np.searchsorted(offsets[1:], start, side="right")
        ends = np.append(start, len(data)).astype(np.int64)
        chunks = pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(ends), pa.py_buffer(data)])
        return chunks, text

    def one(self, chunk: bytes) -> tuple[bytes, bytes] | None:
        """A's and B's ids; None if a tokenizer does not give the chunk back."""
        said = chunk.decode()
        a = np.array(self.a.encode(said, add_special_tokens=False).ids, np.int32)
        b = np.array(self.b.encode(said[1:]), np.int32)
        same = joined(self.bytes_a, a) == chunk == joined(self.bytes_b, b)
        return (a.tobytes(), b.tobytes()) if same else None

    def learn(self, chunks: list[bytes]) -> None:
        """Encode chunks that are not known: those of the usual form many in one call."""
        usual = [c for c in chunks if len(c) > 1 and _FOLLOWS[c[1]] and _VISIBLE[c[-1]]]
        at = 0
        while at < len(usual):
            sizes = np.cumsum([len(c) for c in usual[at : at + 50_000]])
            to = at + max(1, int(np.searchsorted(sizes, _CALL, side="right")))
            part, said, ends = usual[at:to], b"".join(usual[at:to]), sizes[: to - at]
            text = said.decode()
            sides = []
            for ids, table, long in (
                (self.a.encode(text, add_special_tokens=False).ids, self.bytes_a, self.long_a),
                (self.b.encode(text[1:]), self.bytes_b, self.long_b),
            ):
                ids = np.array(ids, np.int32)
                token_ends = np.cumsum(long[ids])
                cuts = np.searchsorted(token_ends, ends)
                if joined(table, ids) != said or not np.array_equal(token_ends[cuts], ends):
                    break
                raw, cuts = ids.tobytes(), [0, *(4 * (cuts + 1)).tolist()]
                sides.append([raw[x:y] for x, y in zip(cuts[:-1], cuts[1:], strict=True)])
            if len(sides) == 2:
                self.known.update(zip(part, zip(*sides, strict=True), strict=True))
            at = to
        for c in chunks:
            if c not in self.known:
                self.known[c] = self.one(c)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of A and of B of all texts one after the other, and where each text begins among them."""
        data, offsets = W.text_arrays(pa.array([" " + x if x else "" for x in texts], pa.large_string()))
        data = np.ascontiguousarray(data)
        whole = np.zeros(len(texts), bool)
        while True:
            chunks, text = self.cut(data, offsets, whole)
            coded = chunks.dictionary_encode()
            distinct, which = coded.dictionary.to_pylist(), coded.indices.to_numpy()
            if len(self.known) > _REMEMBERED:  # the oldest go
                self.known = dict(islice(self.known.items(), len(self.known) // 2, None))
            self.learn([c for c in distinct if c not in self.known])
            made = [self.known[c] for c in distinct]
            lost = np.zeros(len(texts), bool)
            lost[text[np.array([x is None for x in made], bool)[which]]] = True
            if not (lost & ~whole).any():
                break
            whole |= lost  # a chunk is not given back: the whole text decides
        kept = ~lost[text]
        flat = []
        for side in (0, 1):
            ids = [b"" if x is None else x[side] for x in made]
            size = np.array([len(x) // 4 for x in ids], np.int64)
            first = np.cumsum(size) - size
            picked = which[kept]
            tokens = np.frombuffer(b"".join(ids), np.int32).astype(np.int64)[_spread(first[picked], size[picked])]
            per_text = np.bincount(text[kept], size[picked], minlength=len(texts)).astype(np.int64)
            flat += [tokens, np.concatenate([[0], np.cumsum(per_text)])]
        return tuple(flat)


def joined(table: pa.Array, ids: np.ndarray) -> memoryview:
    """The bytes of the entries one after the other."""
    if not len(ids):
        return memoryview(b"")
    taken = table.take(pa.array(ids))
    offsets = np.frombuffer(taken.buffers()[1], np.int64)[: len(ids) + 1]
    raw = taken.buffers()[2]
    return memoryview(raw).cast("B")[offsets[0] : offsets[-1]] if raw is not None else memoryview(b"")


def runs(ends_a: list[int], ends_b: list[int]):
    """One-to-one stretches as (i, j, n) lists, irregular groups as (end i, end j) lists, and their links.

    ``ends_a`` and ``ends_b`` rise strictly and end at the same place.
    """
    one_i, one_j, one_n, cut_i, cut_j, link_i, link_j = [], [], [], [], [], [], []
    i, shift, total = 0, 0, len(ends_a)
    while i < total:
        at, step = i, 1
        # Probe: slices of doubling length at this shift.
        while at < total and ends_a[at : at + step] == ends_b[at + shift : at + shift + step]:
            at += step
            step *= 2
        if at > i:
            # Halve: the first difference is among the last slice.
            while step > 1 and at < total:
                step >>= 1
                if ends_a[at : at + step] == ends_b[at + shift : at + shift + step]:
                    at += step
            if at > total:
                at = total
            one_i.append(i)
            one_j.append(i + shift)
            one_n.append(at - i)
            i = at
            if i == total:
                break
        # Irregular: walk to the next common end.
        j = i + shift
        x, y = ends_a[i], ends_b[j]
        while x != y:
            link_i.append(i)
            link_j.append(j)
            if x < y:
                i += 1
                x = ends_a[i]
            else:
                j += 1
                y = ends_b[j]
        link_i.append(i)
        link_j.append(j)
        i += 1
        cut_i.append(i)
        cut_j.append(j + 1)
        shift = j + 1 - i
    return (one_i, one_j, one_n), (cut_i, cut_j), (link_i, link_j)


def _spread(starts, sizes: np.ndarray) -> np.ndarray:
    """All places of the stretches, in order."""
    starts = np.array(starts, np.int64)
    ends = np.cumsum(sizes)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


@dataclass
class Aligned:
    """Tokens, groups and links of some texts, one after the other; the ``first_*`` have one entry more than texts."""

    ids_a: np.ndarray
    ids_b: np.ndarray
    first_a: np.ndarray
    first_b: np.ndarray
    group_a: np.ndarray  # where each group ends among the A tokens
    group_b: np.ndarray
    first_group: np.ndarray
    link_a: np.ndarray  # places of A and B tokens, text by text
    link_b: np.ndarray
    first_link: np.ndarray


def align_texts(pair: Pair, texts: list[str]) -> Aligned:
    """Texts that a tokenizer does not give back have no tokens."""
    flat_a, first_a, flat_b, first_b = pair.encode(texts)
    # Texts begin and end at common places, so all of them are one pair of token rows.
    stretches, cuts, links = runs(np.cumsum(pair.long_a[flat_a]).tolist(), np.cumsum(pair.long_b[flat_b]).tolist())
    sizes = np.array(stretches[2], np.int64)
    one_a, one_b = _spread(stretches[0], sizes), _spread(stretches[1], sizes)
    group_a = np.sort(np.concatenate([one_a + 1, np.array(cuts[0], np.int64)]))
    group_b = np.sort(np.concatenate([one_b + 1, np.array(cuts[1], np.int64)]))
    link_a = np.concatenate([one_a, np.array(links[0], np.int64)])
    link_b = np.concatenate([one_b, np.array(links[1], np.int64)])
    order = np.lexsort((link_b, link_a))
    link_a, link_b = link_a[order], link_b[order]
    first_group = np.searchsorted(group_a, first_a, side="right")
    first_link = np.searchsorted(link_a, first_a, side="left")
    return Aligned(flat_a, flat_b, first_a, first_b, group_a, group_b, first_group, link_a, link_b, first_link)


def spelled_groups(pair: Pair, x: Aligned) -> list[bytes]:
    """Each text's groups as ``a1,a2|b1;a3|b2,b3``."""
    size_a, size_b = np.diff(x.group_a, prepend=0), np.diff(x.group_b, prepend=0)
    place_a = np.arange(len(x.ids_a)) + np.repeat(x.group_b - size_b, size_a)
    place_b = np.arange(len(x.ids_b)) + np.repeat(x.group_a, size_b)
    in_a, last_a, in_b, last_b = pair.first_spelled
    entry = np.empty(len(x.ids_a) + len(x.ids_b), np.int64)
    entry[place_a] = x.ids_a + in_a
    entry[place_b] = x.ids_b + in_b
    entry[place_a[x.group_a - 1]] += last_a - in_a
    entry[place_b[x.group_b - 1]] += last_b - in_b
    taken = pair.spelled.take(pa.array(entry))
    offsets = np.frombuffer(taken.buffers()[1], np.int64)[: len(entry) + 1] if len(entry) else np.zeros(1, np.int64)
    raw = memoryview(taken.buffers()[2]) if len(entry) else memoryview(b"")
    cuts = offsets[x.first_a + x.first_b]
    return [bytes(raw[a : max(a, b - 1)]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def _lists(values: np.ndarray, first: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(values, pa.int32()))


def _texts(batch: pa.RecordBatch) -> list[str]:
    return [x or "" for x in batch.column("text").to_pylist()]


def _sent(docs: DataFrame, vocabulary_a: str, vocabulary_b: str):
    """Both vocabulary files, of fixed size, as broadcasts."""
    sc = docs.sparkSession.sparkContext
    with open(vocabulary_a, encoding="utf-8") as a, open(vocabulary_b, "rb") as b:
        return sc.broadcast(a.read()), sc.broadcast(b.read())


def align(docs: DataFrame, vocabulary_a: str, vocabulary_b: str) -> DataFrame:
    """doc_id, a_ids, b_ids, and where each group ends among them (a_ends, b_ends), per row of ``docs``.

    ``vocabulary_a``: a byte-level BPE file of the tokenizers library; ``vocabulary_b``: a sentencepiece model.
    """
    file_a, file_b = _sent(docs, vocabulary_a, vocabulary_b)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = Pair(file_a.value, file_b.value)
        for batch in W.pieces(batches, limit=PIECE):
            x = align_texts(pair, _texts(batch))
            in_text = np.repeat(np.arange(batch.num_rows), np.diff(x.first_group))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    _lists(x.ids_a, x.first_a),
                    _lists(x.ids_b, x.first_b),
                    _lists(x.group_a - x.first_a[in_text], x.first_group),
                    _lists(x.group_b - x.first_b[in_text], x.first_group),
                ],
                names=["doc_id", "a_ids", "b_ids", "a_ends", "b_ends"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, a_ids array<int>, b_ids array<int>, a_ends array<int>, b_ends array<int>"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


_COUNTS = ("n_a", "n_b", "n_groups", "n_links")


def _linked(file_a, file_b):
    """Per document the counts, the digest of its groups, and its distinct pairs with how often each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, task, number = Pair(file_a.value, file_b.value), TaskContext.get().partitionId(), 0
        for batch in W.pieces(batches, limit=PIECE):
            piece, number = (task << 32) + number, number + 1
            x = align_texts(pair, _texts(batch))
            keys = x.ids_a[x.link_a] * pair.size_b + x.ids_b[x.link_b]
            said = [hashlib.sha256(g).hexdigest() if g else "" for g in spelled_groups(pair, x)]
            pairs, times = [], []
            for low, high in zip(x.first_link[:-1], x.first_link[1:], strict=True):
                values, count = np.unique(keys[low:high], return_counts=True)
                pairs.append(exchange.pack(values))
                times.append(exchange.pack(np.cumsum(count)))
            counts = [np.diff(f) for f in (x.first_a, x.first_b, x.first_group, x.first_link)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    *[pa.array(c, pa.int64()) for c in counts],
                    pa.array(said, pa.string()),
                    pa.array([piece] * batch.num_rows, pa.int64()),
                    pa.array(pairs, pa.binary()),
                    pa.array(times, pa.binary()),
                ],
                names=["doc_id", *_COUNTS, "groups_sha256", "_piece", "_pairs", "_times"],
            )

    return run


def _unpacked(columns) -> tuple[list[np.ndarray], list[np.ndarray]]:
    pairs, times = (c.to_pylist() for c in columns)
    return [exchange.unpack(x) for x in pairs], [np.diff(exchange.unpack(x), prepend=0) for x in times]


def _pairs_of_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct pairs of each stretch of rows of one piece; a piece may give a pair more than once."""
    for batch in batches:
        pieces = batch.column("_piece").to_numpy()
        edges = [0, *(np.flatnonzero(np.diff(pieces)) + 1).tolist(), len(pieces)]
        for low, high in zip(edges[:-1], edges[1:], strict=True):
            if low == high:
                continue
            part = batch.slice(low, high - low)
            pairs, times = _unpacked((part.column("_pairs"), part.column("_times")))
            flat = np.concatenate(pairs)
            if len(flat):
                keys, which = np.unique(flat, return_inverse=True)
                n = np.bincount(which, np.concatenate(times)).astype(np.int64)
                piece = np.full(len(keys), pieces[low])
                yield pa.RecordBatch.from_arrays([pa.array(piece), pa.array(keys), pa.array(n)], names=["_piece", "pair", "n"])


def pair_counts(asked: DataFrame, size_b: int) -> DataFrame:
    """pair, count, is_best: how many links hold a pair, and whether no other pair of its B id has more."""
    counts = asked.groupBy("pair").agg(F.sum("n").alias("count"))
    counts = settle(counts.withColumn("b", F.col("pair") % size_b))
    best = counts.groupBy("b").agg(F.max("count").alias("most"))
    return counts.join(best, "b").select("pair", "count", (F.col("count") == F.col("most")).alias("is_best"))


def _answered(docs: pa.Table, counts: pa.Table) -> pa.Table:
    """Sums over the links of each document of one piece; the piece's pairs are all in ``counts``."""
    order = np.argsort(counts.column("pair").to_numpy(), kind="stable")
    known = counts.column("pair").to_numpy()[order]
    count = counts.column("count").to_numpy()[order]
    best = counts.column("is_best").to_numpy().astype(np.int64)[order]
    pairs, times = _unpacked((docs.column("_pairs"), docs.column("_times")))
    at = [np.searchsorted(known, x) for x in pairs]
    n_best = [int((best[i] * n).sum()) for i, n in zip(at, times, strict=True)]
    sums = [int((count[i] * n).sum()) for i, n in zip(at, times, strict=True)]
    out = docs.select(["doc_id", *_COUNTS])
    out = out.append_column("n_best", pa.array(n_best, pa.int64()))
    out = out.append_column("count_sum", pa.array(sums, pa.int64()))
    return out.append_column("groups_sha256", docs.column("groups_sha256"))


def link_statistics(docs: DataFrame, vocabulary_a: str, vocabulary_b: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 per row of ``docs``.

    A link's count is how many links of the corpus hold its pair of ids; n_best counts the links whose
    count is the highest of their B id, count_sum adds up the counts of all links.
    """
    import sentencepiece

    file_a, file_b = _sent(docs, vocabulary_a, vocabulary_b)
    size_b = sentencepiece.SentencePieceProcessor(model_proto=file_b.value).get_piece_size()
    kind = docs.schema["doc_id"].dataType.simpleString()
    row = f"doc_id {kind}, " + ", ".join(f"{c} long" for c in _COUNTS)
    linked = settle(
        docs.select("doc_id", "text").mapInArrow(
            _linked(file_a, file_b),
            f"{row}, groups_sha256 string, _piece long, _pairs binary, _times binary",
        )
    )
    asked = linked.select("_piece", "_pairs", "_times").mapInArrow(_pairs_of_pieces, "_piece long, pair long, n long")
    asked = settle(asked)
    known = pair_counts(asked, size_b)
    answers = asked.select("_piece", "pair").join(known, "pair")
    return (
        linked.groupBy("_piece")
        .cogroup(answers.groupBy("_piece"))
        .applyInArrow(_answered, f"{row}, n_best long, count_sum long, groups_sha256 string")
    )
