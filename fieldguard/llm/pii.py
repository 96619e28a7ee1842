"""Personal data: exact patterns plus a semi-Markov conditional random field.

Base spans come from fixed patterns (leftmost, per kind, with digit counts, Luhn and byte checks, no
second tries). The field then looks at regions around digits and the signs of addresses ("@", "dot", a
bracketed "at"): candidate segments of up to ``LONGEST`` tokens are scored by features of the whole span (its shape, its digits, whether a card
number's sum holds, what stands before and after), and dynamic programming over all segmentations of
the region picks boundaries and kinds together, with entities of bounded length. It adds what
patterns miss: numbers that run into each other, phones without a plus, spelled-out addresses.
Added spans never touch base spans.

The field is fitted on a bounded sample: regions of at most ``TRAIN_DOCS`` documents with base spans
(those with the least hash of their text), as they are and rewritten by ``VARIANTS`` (the base span
in a form the patterns miss). All documents are searched over their whole texts.

Defined results: null text is empty and has no spans; rows are searched one by one; offsets count
code points, the end is exclusive.
"""

from __future__ import annotations

import math
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldguard.llm import words as W

KINDS = ("email", "ip", "card", "phone")
TRAIN_DOCS, LONGEST, AROUND = 600, 24, 6
_PIECE = 2 << 20
Span = tuple[str, int, int]

# ---- base patterns

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        if i % 2:
            n = n * 2 - 9 * (n > 4)
        total += n
    return total % 10 == 0


def only_digits(text: str) -> str:
    return "".join([c for c in text if "0" <= c <= "9"])


def base_spans(text: str) -> list[Span]:
    """Matches of the patterns, by kind as listed, then by start."""
    out: list[Span] = []
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        found = _DOMAIN.match(text, at) if start < at else None
        if found:
            out.append(("email", start, found.end()))
            free = found.end()
        at = text.find("@", max(at + 1, free))
    for m in _IP.finditer(text):
        if all(int(x.lstrip("0")[:4] or 0) <= 255 for x in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        digits = only_digits(m[0])
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    for m in _PHONE.finditer(text):
        if 8 <= len(only_digits(m[0])) <= 15:
            out.append(("phone", *m.span()))
    return out


# ---- regions and features

_TOKEN = re.compile(r"[^\W\d_]+|[0-9]+|\S")


@dataclass
class Region:
    tokens: list[tuple[str, int, int]]


def regions(text: str, around: int = AROUND) -> list[Region]:
    """Runs of tokens near a digit or address sign, each with some tokens on both sides.

    A bracketed "at" has as many as an entity may have: the address around it may hold no other cue.
    """
    tokens = [(m[0], *m.span()) for m in _TOKEN.finditer(text)]
    runs: list[tuple[int, int]] = []
    for i, (x, _, _) in enumerate(tokens):
        if x[0] in "0123456789@" or x.lower() == "dot":
            reach = around
        elif x.lower() == "at" and 0 < i < len(tokens) - 1 and tokens[i - 1][0] in "[({" and tokens[i + 1][0] in "])}":
            reach = LONGEST
        else:
            continue
        low, high = max(0, i - reach), min(len(tokens), i + reach + 1)
        while runs and low <= runs[-1][1]:
            before = runs.pop()
            low, high = min(low, before[0]), max(high, before[1])
        runs.append((low, high))
    return [Region(tokens[low:high]) for low, high in runs]


def _shape(said: str) -> str:
    if said[0].isdigit():
        return "9" * min(len(said), 5)
    if said.lower() in ("at", "dot"):
        return said.lower()
    return "a" if said[0].isalpha() else said


def candidates(region: Region, text: str) -> list[tuple[int, int, dict[str, list[str]]]]:
    """Segments (first token, one after the last) that can be an entity, with features by kind."""
    tokens, out = region.tokens, []
    n = len(tokens)
    for i in range(n):
        head = tokens[i][0]
        if not (head[0].isalnum() or head in "+("):
            continue
        digits, letters, shape = 0, 0, []
        for j in range(i, min(n, i + LONGEST)):
            said, start, end = tokens[j]
            gap = start - tokens[j - 1][2] if j > i else 0
            if gap > 2 or (gap and "\n" in text[tokens[j - 1][2] : start]):
                break
            if said[0].isdigit():
                digits += len(said)
            elif said[0].isalpha():
                letters += 1
            elif said not in "+()[]{}.-_@%":
                break
            shape.append(" " * min(gap, 1) + _shape(said))
            if digits > 19 or letters > 10:
                break
            if not said[0].isalnum():
                continue
            traits = _traits(region, i, j + 1, shape, digits, text)
            if traits:
                out.append((i, j + 1, traits))
    return out


# Addresses with signs or spelled out: a plain "at" needs a spelled "dot".
_DOT = r"(?:\s?[\[({]\s?dot\s?[\])}]\s?|\sdot\s)"
_NAME = rf"[\w.%+-]+(?:{_DOT}[\w.%+-]+)*"
_HOST = rf"[\w-]+(?:(?:\.|{_DOT})[\w-]+)+"
_ADDRESS = re.compile(
    rf"{_NAME}(?:\s?@\s?|\s?[\[({{]\s?at\s?[\])}}]\s?){_HOST}|{_NAME}\sat\s(?=.*dot){_HOST}",
    re.IGNORECASE,
)
# Where nothing but words spells the address, it must end in one of these.
KNOWN_TOPS = frozenset("com org net edu gov info io de fr es it uk eu co us".split())
_SPELLED = re.compile(r"@|[\[({]\s?at\s?[\])}]|\sat\s", re.IGNORECASE)
_QUAD = re.compile(r"[0-9]{1,3}(?:\s?[\[(]?(?:\.|dot)[\])]?\s?[0-9]{1,3}){3}", re.IGNORECASE)


def _traits(region: Region, i: int, j: int, shape: list[str], digits: int, text: str) -> dict[str, list[str]]:
    """Whole-span features of a segment, by the kinds it can be at all."""
    tokens = region.tokens
    start, end = tokens[i][1], tokens[j - 1][2]
    said = text[start:end]
    before = tokens[i - 1] if i else None
    after = tokens[j] if j < len(tokens) else None
    glued_left = before is not None and before[2] == start and (before[0][0].isalnum() or before[0] in "@._-+(")
    glued_right = after is not None and after[1] == end and (after[0][0].isalnum() or after[0] in "@_-")
    more_right = after is not None and after[1] - end <= 1 and after[0][0].isdigit()
    more_left = before is not None and start - before[2] <= 1 and before[0][0].isdigit()
    edges = [f"left:{glued_left}", f"right:{glued_right}", f"edges:{glued_left or glued_right}"]
    out: dict[str, list[str]] = {}
    plain = only_digits(said)
    letters = any(c.isalpha() for c in said)
    if 16 <= digits <= 19 and not letters and "." not in said:
        groups = [len(x) for x in re.split(r"\D+", said)]
        even = groups in ([digits], [4, 4, 4, 4], [4, 4, 4, 4, 3], [4, 6, 5])
        right = luhn(plain)
        out["card"] = [f"luhn:{right}", f"length:{digits}", f"luhn:{right},even:{even}", f"groups:{min(len(groups), 6)}", f"start:{plain[0]}", *edges]
    if 8 <= digits <= 15 and not letters:
        groups = [len(x) for x in re.split(r"\D+", said) if x]
        style = "".join(dict.fromkeys(c for c in said if not c.isdigit()))
        plus, paren = said[0] == "+", "(" in said and ")" in said
        out["phone"] = [
            f"plus:{plus}", f"paren:{paren}", f"plus:{plus},paren:{paren}", f"shape:{re.sub('[0-9]+', '9', said)[:12]}", f"style:{style}",
            f"length:{digits}", f"groups:{'-'.join(map(str, groups))}", f"last:{groups[-1]}", f"more:{more_left},{more_right}", *edges,
        ]
    if 4 <= digits <= 12 and _QUAD.fullmatch(said):
        octets = [int(x) for x in re.findall(r"[0-9]+", said)]
        spelled = bool(re.search(r"\s|dot|[\[(]", said, re.IGNORECASE))
        if max(octets) <= 255:
            out["ip"] = [f"spelled:{spelled}", f"digits:{digits > 6}", f"more:{more_left},{more_right}", *edges]
    if _SPELLED.search(said) and _ADDRESS.fullmatch(said):
        dots = len(re.findall(r"(?i)\bdot\b", said))
        form = "@" if "@" in said else ("bracket" if re.search(r"[\[({]\s?at", said, re.IGNORECASE) else "word")
        last = re.split(r"[\W_]+", said)[-1]
        if form == "word" and last.lower() not in KNOWN_TOPS:
            return {k: [f"{k}|{x}" for x in v] + [k] for k, v in out.items()}
        out["email"] = [
            f"form:{form}", f"form:{form},dots:{dots > 0}", f"top:{last.isalpha() and 2 <= len(last) <= 6}",
            f"spaces:{min(said.count(' '), 6)}", *edges,
        ]
    return {k: [f"{k}|{x}" for x in v] + [k] for k, v in out.items()}


# ---- the field


@dataclass
class Field:
    """Weights by feature. A segmentation's score is the sum over its entities; other tokens score 0."""

    weights: dict[str, float] = field(default_factory=dict)

    def scored(self, found: list) -> list[tuple[int, int, str, float, list[str]]]:
        w = self.weights
        return [
            (i, j, kind, sum([w.get(x, 0.0) for x in names]), names)
            for i, j, traits in found
            for kind, names in traits.items()
        ]

    def best(self, n: int, segments: list) -> list[tuple[int, int, str]]:
        """The highest-scoring segmentation: Viterbi over token boundaries."""
        ending: dict[int, list] = {}
        for s in segments:
            ending.setdefault(s[1], []).append(s)
        score, back = [0.0] * (n + 1), [None] * (n + 1)
        for j in range(1, n + 1):
            score[j] = score[j - 1]
            for s in ending.get(j, ()):
                if score[s[0]] + s[3] > score[j]:
                    score[j], back[j] = score[s[0]] + s[3], s
        out, j = [], n
        while j > 0:
            if back[j] is None:
                j -= 1
            else:
                out.append(back[j][:3])
                j = back[j][0]
        return out[::-1]

    def chances(self, n: int, segments: list) -> list[float]:
        """Marginal probability of every segment: forward and backward sums over segmentations."""
        ending, starting = {}, {}
        for s in segments:
            ending.setdefault(s[1], []).append(s)
            starting.setdefault(s[0], []).append(s)

        def add(terms: list[float]) -> float:
            top = max(terms)
            return top + math.log(sum([math.exp(x - top) for x in terms]))

        fore, aft = [0.0] * (n + 1), [0.0] * (n + 1)
        for j in range(1, n + 1):
            fore[j] = add([fore[j - 1], *[fore[s[0]] + s[3] for s in ending.get(j, ())]])
        for i in range(n - 1, -1, -1):
            aft[i] = add([aft[i + 1], *[aft[s[1]] + s[3] for s in starting.get(i, ())]])
        return [math.exp(min(0.0, fore[s[0]] + s[3] + aft[s[1]] - fore[n])) for s in segments]

    def added(self, text: str, base: list[Span]) -> list[Span]:
        """Spans of the best segmentations that do not touch base spans."""
        out = []
        for region in regions(text):
            found = candidates(region, text)
            if found:
                for i, j, kind in self.best(len(region.tokens), self.scored(found)):
                    out.append((kind, region.tokens[i][1], region.tokens[j - 1][2]))
        return [s for s in out if not any(s[1] < e and b < s[2] for _, b, e in base)]


def fit(examples: list[tuple[str, list[Span]]], rounds: int = 5, rate: float = 0.3, decay: float = 1e-4) -> Field:
    """Maximum likelihood by stochastic gradient; ``examples``: texts with all their spans."""
    made = Field()
    cases = []
    for text, spans in examples:
        gold = {(b, e, k) for k, b, e in spans}
        for region in regions(text):
            found = candidates(region, text)
            if found:
                right = {
                    (i, j, k) for i, j, traits in found for k in traits
                    if (region.tokens[i][1], region.tokens[j - 1][2], k) in gold
                }
                cases.append((len(region.tokens), found, right))
    order = random.Random(7)
    for step in range(rounds):
        order.shuffle(cases)
        pace = rate / (1 + step)
        for n, found, right in cases:
            segments = made.scored(found)
            for s, chance in zip(segments, made.chances(n, segments), strict=True):
                wrong = ((s[0], s[1], s[2]) in right) - chance
                if abs(wrong) > 1e-4:
                    for x in s[4]:
                        w = made.weights.get(x, 0.0)
                        made.weights[x] = w + pace * (wrong - decay * w)
    return made


# Ways in which the patterns' kinds are written besides.
VARIANTS = {
    "email": (
        lambda s: s.replace("@", " at ").replace(".", " dot "),
        lambda s: s.replace("@", " [at] ").replace(".", " [dot] "),
        lambda s: s.replace("@", "(at)").replace(".", "(dot)"),
        lambda s: s.replace("@", " @ "),
        lambda s: s.replace("@", "[at]"),
    ),
    "ip": (
        lambda s: s.replace(".", "[.]"),
        lambda s: s.replace(".", " . "),
        lambda s: s.replace(".", " dot "),
        lambda s: s.replace(".", "(dot)"),
    ),
    "card": (
        lambda s: f"{s} {s}",
        lambda s: " - ".join(re.findall(r"[0-9]{1,4}", only_digits(s))),
        lambda s: "  ".join(re.findall(r"[0-9]{1,4}", only_digits(s))),
        lambda s: f"{s} {'4' + only_digits(s)[:3]}",
    ),
    "phone": (
        lambda s: s.lstrip("+"),
        lambda s: re.sub(r"\A\+?[0-9]+[ -]*", "", s),
        lambda s: "00" + s.lstrip("+"),
        lambda s: f"{s} {s}",
        lambda s: re.sub(r"[()]", "", s).replace(" ", "-").lstrip("+"),
    ),
}


def variants(text: str, spans: list[Span], order: random.Random) -> tuple[str, list[Span]]:
    """The text with every base span rewritten, and the spans where they are now."""
    out, at, now = [], 0, []
    size = 0
    for kind, b, e in sorted(spans, key=lambda s: s[1]):
        if b < at:
            continue
        out.append(text[at:b])
        size += b - at
        said = text[b:e]
        new = order.choice(VARIANTS[kind])(said)
        out.append(new)
        if new == f"{said} {said}":
            now += [(kind, size, size + len(said)), (kind, size + len(said) + 1, size + len(new))]
        elif kind == "card" and new.startswith(said + " "):
            now.append((kind, size, size + len(said)))
        elif len(only_digits(new)) >= 8 or kind != "phone":
            now.append((kind, size, size + len(new)))
        size += len(new)
        at = e
    out.append(text[at:])
    return "".join(out), now


def _window(text: str, spans: list[Span], around: int = 200) -> list[tuple[str, list[Span]]]:
    """The text near each span, with the spans that lie in it whole."""
    out = []
    for _, b, e in spans:
        low, high = max(0, b - around), min(len(text), e + around)
        inside = [(k, x - low, y - low) for k, x, y in spans if low <= x and y <= high]
        out.append((text[low:high], inside))
    return out


def has_cue(texts: pa.Array) -> np.ndarray:
    return pc.match_substring_regex(pc.fill_null(texts, ""), r"[0-9@]|\b[dD][oO][tT]\b|[\[({]\W?[aA][tT]\W?[\])}]").to_numpy(zero_copy_only=False)


def learn(docs: DataFrame, limit: int = TRAIN_DOCS) -> Field:
    """Fit the field on a bounded sample of documents that have base spans, and on their variants."""

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            for i in np.flatnonzero(has_cue(texts)):
                text = texts[i].as_py()
                found = base_spans(text)
                # Numbers that fail the checks teach what is no entity.
                if found or _CARD.search(text):
                    rows = _window(text, found) or _window(text, [("", *_CARD.search(text).span())])
                    said, spans = rows[0]
                    flat = [f"{k}:{b}:{e}" for k, b, e in spans if k]
                    yield pa.RecordBatch.from_pydict(
                        {"said": pa.array([said]), "spans": pa.array([flat], pa.list_(pa.string()))}
                    )

    found = docs.select("text").mapInArrow(sample, "said string, spans array<string>").distinct()
    rows = found.orderBy(F.xxhash64("said"), "said").limit(limit).collect()
    examples, order = [], random.Random(11)
    for said, flat in rows:
        spans = [(k, int(b), int(e)) for k, b, e in (x.split(":") for x in flat)]
        examples.append((said, spans))
        if spans:
            for _ in range(2):
                examples.append(variants(said, spans, order))
    return fit(examples)


# ---- the operator


def find(docs: DataFrame, text: str = "text", limit: int = TRAIN_DOCS) -> DataFrame:
    """Adds ``base`` and ``spans`` (arrays of kind, start, end): patterns alone, and with the field's.

    Columns of these names are replaced; all others are kept.
    """
    docs = docs.drop("base", "spans")
    model = docs.sparkSession.sparkContext.broadcast(learn(docs.select(F.col(text).alias("text")), limit))
    span = T.ArrayType(
        T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
    )
    kinds = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    rank = {k: i for i, k in enumerate(KINDS)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.pieces(batches, text, _PIECE):
            texts = batch.column(text)
            base: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            full = [[] for _ in range(batch.num_rows)]
            for i in np.flatnonzero(has_cue(texts)):
                said = texts[i].as_py()
                own = base_spans(said)
                more = own + model.value.added(said, own)
                more.sort(key=lambda s: (rank[s[0]], s[1], s[2]))
                base[i] = [{"kind": k, "start": b, "end": e} for k, b, e in own]
                full[i] = [{"kind": k, "start": b, "end": e} for k, b, e in more]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(base, kinds), pa.array(full, kinds)],
                names=[*batch.schema.names, "base", "spans"],
            )

    schema = T.StructType([*docs.schema.fields, T.StructField("base", span), T.StructField("spans", span)])
    return docs.mapInArrow(run, schema)


def redact(found: DataFrame) -> DataFrame:
    """``text`` with every span replaced by its kind in brackets; needs ``text`` and ``spans``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for i, spans in enumerate(batch.column("spans").to_pylist()):
                if spans:
                    said, parts, at = texts[i], [], 0
                    for s in sorted(spans, key=lambda s: (s["start"], -s["end"])):
                        if s["start"] >= at:
                            parts += [said[at : s["start"]], f"[{s['kind'].upper()}]"]
                        at = max(at, s["end"])
                    texts[i] = "".join([*parts, said[at:]])
            columns = [c if n != "text" else pa.array(texts, pa.string()) for n, c in zip(batch.schema.names, batch.columns, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return found.mapInArrow(run, found.schema)
