"""Selector text, and compiling sets of selectors to one JSON parse per report.

A selector addresses one place of a report:

* ``.<key>``       value of an object key (``.key`` is accepted as well)
* ``.(i)``         element of an array, counted from 0
* ``.[<k>=<v>]``   first object of an array whose key ``k`` equals ``v``

``\\`` and ``>`` inside angle brackets are written ``\\\\`` and ``\\>``. Parsing happens once per selector
while the plan is built; rows only ever see built-in expressions.
"""

from __future__ import annotations

import json
import re
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_ANGLE = r"<((?:\\.|[^>\\])*)>"
_STEP = (
    _ANGLE
    + r"|\(\s*(-?\d+)\s*\)"
    + r"|\[\s*(?:" + _ANGLE + r"|([^=<\]]+?))\s*=\s*(?:" + _ANGLE + r"|([^<\]][^\]]*?)?)\s*\]"
)
_PART = re.compile(r"\.(?:" + _STEP + r"|([^.<(\[][^.]*))")
# Selectors of episode attributes may leave dots out: report[<k>=<v>].<x>
_LOOSE_PART = re.compile(r"\.?(?:" + _STEP + r"|([^.<(\[][^.\[]*))")
# The same grammar as one Java pattern, for checking selectors held in a column.
SELECTOR_PATTERN = (
    r"^(?:\.(?:<(?:\\.|[^>\\])*>|\(\s*-?\d+\s*\)"
    r"|\[\s*(?:<(?:\\.|[^>\\])*>|[^=<\]]+?)\s*=\s*(?:<(?:\\.|[^>\\])*>|(?:[^<\]][^\]]*?)?)\s*\]"
    r"|[^.<(\[][^.]*))+$"
)
_LITERAL = re.compile(r"-?\d+(\.\d+)?([eE][+-]?\d+)?|true|false|null")


class SelectorError(ValueError):
    """The text is not a selector."""


@dataclass(frozen=True)
class Step:
    kind: str  # "key", "item" or "match"
    key: str = ""
    index: int = 0
    value: object = None


def _unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


def parse(text: str, loose: bool = False) -> tuple[Step, ...]:
    """Steps of a selector; raises SelectorError for anything else. ``loose`` dots are optional."""
    text = text.strip()
    part = _LOOSE_PART if loose else _PART
    steps: list[Step] = []
    at = 0
    while at < len(text):
        m = part.match(text, at)
        if not m:
            raise SelectorError(f"not a selector (at {at}): {text!r}")
        key, index, match_key, bare_key, match_value, bare_value, bare = m.groups()
        if index is not None:
            steps.append(Step("item", index=int(index)))
        elif match_key is not None or bare_key is not None:
            name = _unescape(match_key) if match_key is not None else bare_key.strip()
            if match_value is not None:
                value: object = _unescape(match_value)
            else:
                value = bare_value or ""
                if _LITERAL.fullmatch(value):
                    value = json.loads(value)
            steps.append(Step("match", key=name, value=value))
        else:
            steps.append(Step("key", key=_unescape(key) if key is not None else bare.strip()))
        at = m.end()
    if not steps:
        raise SelectorError("empty selector")
    return tuple(steps)


def escape(text: Column) -> Column:
    """Text as it stands inside angle brackets."""
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit(">"), F.lit("\\>"))


def token(text: Column) -> Column:
    return F.concat(F.lit("<"), escape(text), F.lit(">"))


def well_formed(selector: Column) -> Column:
    return F.trim(selector).rlike(SELECTOR_PATTERN)


# --- compiling ---------------------------------------------------------------------------------


@dataclass
class _Shape:
    """What all selectors together need to see at one place of the document."""

    leaf: bool = False
    typed: bool = False
    keys: dict[str, _Shape] = field(default_factory=dict)
    element: _Shape | None = None

    def is_text(self) -> bool:
        # Used as a leaf and as a container, or as two containers, or with keys no struct can
        # hold (empty, or equal but for case): such a place is read as text and parsed per use.
        uses = int(self.leaf) + int(bool(self.keys)) + int(self.element is not None)
        folded = {k.lower() for k in self.keys}
        return uses != 1 or len(folded) != len(self.keys) or "" in self.keys

    def data_type(self) -> T.DataType:
        if self.typed and not self.keys and self.element is None:
            return T.VariantType()
        if self.leaf or self.is_text():
            return T.StringType()
        if self.element is not None:
            return T.ArrayType(self.element.data_type())
        return T.StructType([T.StructField(k, s.data_type()) for k, s in self.keys.items()])


def _ambiguous(value: object) -> bool:
    """Could a JSON value that is not this very string print the same text?"""
    if not isinstance(value, str):
        return True
    return bool(_LITERAL.fullmatch(value)) or value[:1] in "{[" or value in ("NaN", "Infinity")


def _add(shape: _Shape, steps: Sequence[Step], match: str) -> None:
    if not steps:
        shape.leaf = True
        return
    head, rest = steps[0], steps[1:]
    if head.kind == "key":
        _add(shape.keys.setdefault(head.key, _Shape()), rest, match)
        return
    if shape.element is None:
        shape.element = _Shape()
    if head.kind == "match":
        discriminator = shape.element.keys.setdefault(head.key, _Shape())
        discriminator.leaf = True
        if match == "typed" and _ambiguous(head.value):
            discriminator.typed = True
    _add(shape.element, rest, match)


def _quoted(text: str) -> str:
    """SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _name(key: str) -> str:
    return "`" + key.replace("`", "``") + "`"


def _equals(found: str, value: object, typed: bool) -> str:
    """Condition: a discriminator equals the wanted value (as JSON if ``typed``, else as text)."""
    if not typed:
        return f"{found} = {_quoted(value if isinstance(value, str) else json.dumps(value))}"
    kind = f"schema_of_variant({found})"
    if value is None:
        return f"is_variant_null({found})"
    if isinstance(value, bool):
        same = f"try_variant_get({found}, '$', 'boolean') = {str(value).lower()}"
        return f"({kind} = 'BOOLEAN' AND {same})"
    if isinstance(value, (int, float)):
        number = f"({kind} IN ('BIGINT', 'DOUBLE', 'FLOAT') OR {kind} LIKE 'DECIMAL%')"
        same = f"try_variant_get({found}, '$', 'double') = double('{float(value)!r}')"
        return f"({number} AND {same})"
    return f"({kind} = 'STRING' AND try_variant_get({found}, '$', 'string') = {_quoted(value)})"


def _one_key(text: str, key: str, kind: str = "string") -> str:
    """Value of one key of an object held as JSON text."""
    if not key:
        return f"from_json({text}, 'map<string,{kind}>')['']"
    return f"from_json({text}, {_quoted(f'{_name(key)} {kind}')}).{_name(key)}"


def _is_typed(step: Step, match: str) -> bool:
    return match == "typed" and _ambiguous(step.value)


def _text_step(text: str, step: Step, match: str) -> str:
    """One step within a JSON text; arrays may mix objects and other values."""
    if step.kind == "key":
        return _one_key(text, step.key)
    if step.kind == "item":
        items = f"from_json({text}, 'array<string>')"
        return f"get({items}, {step.index})" if step.index >= 0 else "cast(null as string)"
    return _first_match(_members(text, step, match), step, match)


def _members(text: str, step: Step, match: str) -> str:
    """The members of an array held as JSON text, each with its discriminator: parsed once, however often compared."""
    found = _one_key("e", step.key, "variant" if _is_typed(step, match) else "string")
    return f"transform(from_json({text}, 'array<string>'), e -> struct(e as item, {found} as found))"


def _first_match(members: str, step: Step, match: str) -> str:
    return f"get(filter({members}, m -> {_equals('m.found', step.value, _is_typed(step, match))}), 0).item"


def cell_text(value: Column) -> Column:
    """JSON readers quote the bare words NaN and Infinity; take the quotes off again."""
    return F.when(
        value.isin('"NaN"', '"Infinity"', '"-Infinity"'), F.translate(value, '"', "")
    ).otherwise(value)


@dataclass
class _Spot:
    """A place some selectors pass: as a typed expression (if any) and as JSON text."""

    typed: str | None
    text: str
    shape: _Shape
    pending: list[tuple[tuple[Step, ...], int]]


def parse_reports(
    df: DataFrame,
    selectors: Sequence[str],
    *,
    raw: str = "raw",
    match: str = "typed",
    keep: Sequence[str] = (),
    lenient: bool = True,
) -> DataFrame:
    """``keep`` columns + ``_cells``: the text of every selector, in order; NULL if not JSON.

    All selectors share one ``from_json`` with a schema holding just the places they visit.
    Array look-ups shared by several selectors are evaluated once per report: each level of the
    selector tree is its own projection. Reports the schema does not fit (an array mixing
    objects and scalars, say) are walked as text instead, so results do not depend on the route;
    for all others the text columns stay NULL.
    """
    wanted: list[tuple[tuple[Step, ...], int]] = []
    root = _Shape()
    for at, text in enumerate(selectors):
        try:
            steps = parse(text, loose=match == "text")
        except SelectorError:
            if not lenient:
                raise
            continue
        wanted.append((steps, at))
        _add(root, steps, match)

    direct = bool(root.keys) and not root.is_text()
    if direct:
        mark = "_misfit"
        while mark in root.keys:
            mark += "_"
        schema = root.data_type().add(mark, T.StringType())
        doc = F.from_json(raw, schema, {"columnNameOfCorruptRecord": mark})
        misfit = f"_doc.{mark} is not null"
    else:
        doc = F.lit(None)
        misfit = "true"
    df = df.select(*keep, F.col(raw).alias("_raw"), doc.alias("_doc"))
    df = df.select(*keep, "_doc", F.expr(f"if({misfit}, _raw, null)").alias("_text"))

    absent = "cast(null as string)"
    typed_cells = [absent] * len(selectors)
    text_cells = list(typed_cells)
    kept = [*keep, "_doc", "_text"]
    level = [_Spot("_doc" if direct else None, "_text", root, wanted)]
    made = 0
    while level:
        lookups: list[str] = []
        # Array members looked at by several selectors of a level, by their expression.
        shared: dict[str, str] = {}

        def text_step(text: str, step: Step, shared: dict[str, str] = shared) -> str:
            if step.kind != "match":
                return _text_step(text, step, match)
            name = shared.setdefault(_members(text, step, match), f"_me{made}_{len(shared)}")
            return _first_match(name, step, match)

        following: list[_Spot] = []
        stack = list(level)
        while stack:
            here = stack.pop()
            # By type as well: 1 equals True in Python, but not in JSON.
            groups: dict[tuple[Step, type], list[tuple[tuple[Step, ...], int]]] = {}
            for steps, at in here.pending:
                if steps:
                    head = (steps[0], type(steps[0].value))
                    groups.setdefault(head, []).append((steps[1:], at))
                    continue
                text_cells[at] = here.text
                if here.typed is not None:
                    typed_cells[at] = f"cast({here.typed} as string)"
            for (step, _), rest in groups.items():
                if here.typed is None or here.shape.is_text():
                    # Held as text from here on.
                    whole = f"coalesce({here.typed}, {here.text})" if here.typed else here.text
                    below = _Spot(None, text_step(whole, step), _Shape(), rest)
                elif step.kind == "key":
                    stack.append(
                        _Spot(
                            f"{here.typed}.{_name(step.key)}",
                            _text_step(here.text, step, match),
                            here.shape.keys[step.key],
                            rest,
                        )
                    )
                    continue
                else:
                    below = _Spot(
                        _typed_lookup(here, step, match),
                        text_step(here.text, step),
                        here.shape.element,
                        rest,
                    )
                if below.typed is None and step.kind == "key":
                    stack.append(below)
                    continue
                made += 1
                if below.typed is not None:
                    lookups.append(f"{below.typed} as _at{made}")
                    below.typed = f"_at{made}"
                lookups.append(f"{below.text} as _tx{made}")
                below.text = f"_tx{made}"
                following.append(below)
        if shared:
            members = [f"{expression} as {name}" for expression, name in shared.items()]
            df = df.selectExpr(*[_name(c) for c in kept], *members)
        if lookups:
            df = df.selectExpr(*[_name(c) for c in kept], *lookups)
            kept += [x.rsplit(" as ", 1)[1] for x in lookups]
        level = following

    as_object = F.from_json("_text", T.MapType(T.StringType(), T.StringType())).isNotNull()
    as_array = F.from_json("_text", T.ArrayType(T.StringType())).isNotNull()
    texts = F.expr(f"array({', '.join(text_cells)})")
    if direct:
        # What the document holds as text was walked as text for every report.
        plain = [b if a == absent else a for a, b in zip(typed_cells, text_cells)]
        texts = F.when(F.col("_text").isNotNull(), texts).otherwise(
            F.expr(f"array({', '.join(plain)})")
        )
    broken = F.col("_text").isNotNull() & ~(as_object | as_array)
    if not direct:
        broken = F.coalesce(~(as_object | as_array), F.lit(True))
    return df.select(*keep, F.when(~broken, F.transform(texts, cell_text)).alias("_cells"))


def _typed_lookup(here: _Spot, step: Step, match: str) -> str:
    element = here.shape.element
    if step.kind == "item":
        if step.index < 0:
            return f"get(filter({here.typed}, e -> false), 0)"
        return f"get({here.typed}, {step.index})"
    if element.is_text():
        typed = _is_typed(step, match)
        found = _one_key("e", step.key, "variant" if typed else "string")
    else:
        typed = element.keys[step.key].typed
        found = f"e.{_name(step.key)}"
    return f"get(filter({here.typed}, e -> {_equals(found, step.value, typed)}), 0)"
