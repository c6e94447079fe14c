"""Elements by selector, from one pass over the tags of a page.

A page is cut into its tags, each with the text behind it.  Every opening tag gets the
set of the selector's compounds that fit the tag alone.  One fold over the tags then
keeps the open elements as a stack, and on each level of it which compounds the element
itself and which any element above it has matched: that is the state of an automaton
that a selector such as ``div.list > h2.title a`` stands for, and an element is found
when its last compound is reached.  Elements nest as they do for a lenient reader: a
closing tag closes everything opened since its partner and is passed over when it has
none, elements without content and ``<x/>`` close at once, and what is still open at
the end reaches to the end.

A selector may use ``tag``, ``*``, ``.class`` (several), ``#id``, ``[name]``,
``[name=value]`` with ``~= ^= $= *=``, a blank or ``>`` between compounds, and commas.
Tag and attribute names are compared without case, values with it.  Comments,
declarations, scripts and styles hold no elements.

Everything is column expressions; a page's work grows with its tags and their depth.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsloom.functions import html as H
from newsloom.functions import text as T

#: Elements without content.
VOID = "area base br col embed hr img input link meta param source track wbr".split()

_HIDDEN = r"(?is)<!--.*?(?:-->|\z)|<(script|style)\b[^>]*>.*?(?:</\1\s*>|\z)|<[!?](?!\[CDATA\[)[^>]*>"
_PIECE = rf"(?:{H.TAG})[^<]*+|[^<]++|<"
_NAME = r"^</?([A-Za-z][^\s/>]*)"
_OPENING = rf"^(?:{H.TAG})"
_ATTRIBUTE = r"[^\s\"'>/=]+(?:\s*=\s*(?:\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?"
_VALUE = r"(?s)^[^=]*=\s*(?:\"(.*)\"|'(.*)'|(.*))$"

_SIMPLE = re.compile(
    r"(?P<tag>[A-Za-z][\w-]*|\*)|\.(?P<cls>[\w-]+)|#(?P<id>[\w-]+)"
    r"|\[\s*(?P<name>[\w:-]+)\s*(?:(?P<how>[~^$*]?=)\s*(?:\"(?P<v1>[^\"]*)\"|'(?P<v2>[^']*)'|(?P<v3>[^\]\s]+))\s*)?\]"
)


@dataclass
class Compound:
    """What one element has to be, and whether it has to be a child of the one before."""

    child: bool = False
    tag: str | None = None
    classes: list[str] = field(default_factory=list)
    attributes: list[tuple[str, str | None, str | None]] = field(default_factory=list)


def parse(selector: str) -> list[list[Compound]]:
    """The alternatives of a selector, each a chain of compounds."""
    chains, chain, at, child = [], [], 0, False
    text = selector.strip()
    while at < len(text):
        gap = re.compile(r"\s*([>,])\s*|\s+").match(text, at)
        if gap and chain and at:
            at = gap.end()
            if gap[1] == ",":
                chains.append(chain)
                chain, child = [], False
            else:
                child = gap[1] == ">"
            continue
        compound = Compound(child)
        start = at
        while at < len(text) and (found := _SIMPLE.match(text, at)) and not (found["tag"] and at > start):
            if found["tag"]:
                compound.tag = None if found["tag"] == "*" else found["tag"].lower()
            elif found["cls"]:
                compound.classes.append(found["cls"])
            elif found["id"]:
                compound.attributes.append(("id", "=", found["id"]))
            else:
                value = next((found[v] for v in ("v1", "v2", "v3") if found[v] is not None), None)
                compound.attributes.append((found["name"].lower(), found["how"], value))
            at = found.end()
        if at == start:
            raise ValueError(f"not a selector: {selector!r} at {at}")
        chain.append(compound)
        child = False
    if not chain or child:
        raise ValueError(f"not a selector: {selector!r}")
    return [*chains, chain]


def _attributes(opening: Column) -> Column:
    """The attributes of an opening tag as written, name and value."""
    return F.regexp_extract_all(F.regexp_replace(opening, r"^<[A-Za-z][^\s/>]*", ""), F.lit(_ATTRIBUTE), F.lit(0))


def _attribute(attributes: Column, name: str) -> Column:
    """The value of an attribute, '' for one without; the last one counts; null when there is none."""
    own = F.filter(attributes, lambda a: F.lower(F.regexp_extract(a, r"^[^\s=]+", 0)) == name.lower())
    written = F.try_element_at(own, F.lit(-1))

    def value(a: Column) -> Column:
        bare = F.concat(*[F.coalesce(F.regexp_extract(a, _VALUE, g), F.lit("")) for g in (1, 2, 3)])
        return F.when(a.contains("="), H.decode_references(bare)).when(a.isNotNull(), "")

    return T.let(written, value)


def attribute(element: Column, name: str) -> Column:
    """The value of an attribute of an element's markup; null when it has none of the name."""
    return _attribute(_attributes(F.regexp_extract(element, _OPENING, 0)), name)


def _has_word(value: Column, word: str) -> Column:
    return F.array_contains(F.split(F.coalesce(value, F.lit("")), r"\s+"), word)


def _fits(compound: Compound, name: Column, piece: Column) -> Column:
    """Whether an opening tag is what a compound asks for, its place aside."""
    tests = []
    if compound.classes or compound.attributes:

        def both(attributes: Column) -> Column:
            own = []
            if compound.classes:
                own.append(T.let(_attribute(attributes, "class"), lambda c: reduce(and_, [_has_word(c, x) for x in compound.classes])))
            for asked, how, wanted in compound.attributes:
                own.append(T.let(_attribute(attributes, asked), _holder(how, wanted)))
            return reduce(and_, own)

        tests.append(T.let(_attributes(F.regexp_extract(piece, _OPENING, 0)), both))
    right = reduce(and_, tests) if tests else F.lit(True)
    # The name is looked at first: most tags are not taken apart any further.
    return right if compound.tag is None else F.when(name == compound.tag, right).otherwise(False)


def _holder(how: str | None, wanted: str | None) -> Callable[[Column], Column]:
    """The test of an attribute's value."""

    def holds(value: Column) -> Column:
        if how is None:
            return value.isNotNull()
        if not wanted and how != "=":
            return F.lit(False)
        held = F.coalesce(value, F.lit(""))
        if how == "~=":
            return _has_word(held, wanted)
        test = {"=": held == wanted, "^=": held.startswith(wanted), "$=": held.endswith(wanted), "*=": held.contains(wanted)}
        return value.isNotNull() & test[how]

    return holds


_STATE = "at INT, stack ARRAY<STRUCT<name: STRING, own: BIGINT, above: BIGINT, start: INT, hit: BOOLEAN>>, found ARRAY<STRUCT<start: INT, end: INT>>"


def _spans(pieces: Column, selector: str) -> Column:
    """The found elements as sorted (start, end) of pieces; one that closes at once ends before it starts."""
    chains = parse(selector)
    bits, chain_bits = {}, []
    for chain in chains:
        chain_bits.append([bits.setdefault(id(c), len(bits)) for c in chain])
    if len(bits) > 62:
        raise ValueError("a selector has at most 62 compounds")

    def tag(piece: Column) -> Column:
        def described(name: Column) -> Column:
            fits = reduce(
                lambda a, b: a + b,
                [F.when(_fits(c, name, piece), F.lit(1 << bits[id(c)])).otherwise(0).cast("long") for chain in chains for c in chain],
            )
            closing = piece.startswith("</")
            at_once = name.isin(VOID) | F.regexp_extract(piece, _OPENING, 0).endswith("/>")
            kind = F.when(name == "", 0).when(closing, 2).when(at_once, 3).otherwise(1)
            return F.struct(kind.alias("kind"), name.alias("name"), F.when((name == "") | closing, F.lit(0).cast("long")).otherwise(fits).alias("fits"))

        return T.let(F.lower(F.regexp_extract(piece, _NAME, 1)), described)

    def step(state: Column, piece: Column) -> Column:
        stack, at = state["stack"], state["at"]
        top = F.get(stack, F.lit(0))
        above_own = F.coalesce(top["own"], F.lit(0).cast("long"))
        above = F.coalesce(top["above"], F.lit(0).cast("long"))

        def opened(own: Column) -> Column:
            last = reduce(or_, [own.bitwiseAND(F.lit(1 << numbers[-1])) != 0 for numbers in chain_bits])
            entry = F.struct(
                piece["name"].alias("name"), own.alias("own"), above.bitwiseOR(own).alias("above"), at.alias("start"), last.alias("hit")
            )
            alone = F.struct(at.alias("start"), (at - 1).alias("end"))  # the tag without the text behind it
            return F.struct(
                (at + 1).alias("at"),
                F.when(piece["kind"] == 1, F.concat(F.array(entry), stack)).otherwise(stack).alias("stack"),
                F.when((piece["kind"] == 3) & last, F.concat(state["found"], F.array(alone))).otherwise(state["found"]).alias("found"),
            )

        reached = []
        for chain, numbers in zip(chains, chain_bits, strict=True):
            for k, (compound, number) in enumerate(zip(chain, numbers, strict=True)):
                fits = piece["fits"].bitwiseAND(F.lit(1 << number))
                if k:
                    before = (above_own if compound.child else above).bitwiseAND(F.lit(1 << numbers[k - 1]))
                    fits = F.when(before != 0, fits).otherwise(F.lit(0).cast("long"))
                reached.append(fits)
        own = reduce(lambda a, b: a.bitwiseOR(b), reached)

        def closed(depth: Column) -> Column:
            gone = F.filter(F.slice(stack, F.lit(1), depth), lambda level: level["hit"])
            ended = F.transform(gone, lambda level: F.struct(level["start"].alias("start"), (at - 1).alias("end")))
            return F.struct(
                (at + 1).alias("at"),
                F.when(depth > 0, F.slice(stack, depth + 1, F.size(stack))).otherwise(stack).alias("stack"),
                F.when(depth > 0, F.concat(state["found"], ended)).otherwise(state["found"]).alias("found"),
            )

        passed = F.struct((at + 1).alias("at"), stack.alias("stack"), state["found"].alias("found"))
        partner = F.array_position(F.transform(stack, lambda level: level["name"]), piece["name"]).cast("int")
        return F.when(piece["kind"] == 2, T.let(partner, closed)).when(piece["kind"] == 0, passed).otherwise(T.let(own, opened))

    def finish(state: Column) -> Column:
        left = F.filter(state["stack"], lambda level: level["hit"])
        ended = F.transform(left, lambda level: F.struct(level["start"].alias("start"), (state["at"] - 1).alias("end")))
        return F.array_sort(F.concat(state["found"], ended))

    start = F.expr(f"from_json('{{\"at\": 1, \"stack\": [], \"found\": []}}', '{_STATE}')")
    return F.aggregate(F.transform(pieces, tag), start, step, finish)


def elements(markup: Column, selector: str) -> Column:
    """The markup of all elements that fit, in the order of their opening tags; null for null.

    The closing tag is left out, a void element is its tag alone, and an element inside
    another that fits comes after it, by itself.
    """

    def of_pieces(pieces: Column) -> Column:
        return F.transform(
            _spans(pieces, selector),
            lambda span: F.when(
                span["end"] < span["start"], F.regexp_extract(F.element_at(pieces, span["start"]), _OPENING, 0)
            ).otherwise(F.array_join(F.slice(pieces, span["start"], span["end"] - span["start"] + 1), "")),
        )

    visible = F.when(markup.contains("<"), F.regexp_replace(markup, _HIDDEN, "")).otherwise(markup)
    return T.let(F.regexp_extract_all(visible, F.lit(_PIECE), F.lit(0)), of_pieces)


def first_text(markup: Column, selector: str, separator: str = " ") -> Column:
    """The text of the first element that fits; null when none does."""
    return T.collapse_spaces(H.plain_text(F.get(elements(markup, selector), F.lit(0)), separator))
