"""Elements of pages by selector (NODE-1, NODE-2, NODE-3, NODE-4, NODE-5, NODE-8, NODE-9, NODE-11).

``extract`` is the engine's only Python stage: an Arrow stage that reads each page once, tag by tag, and returns
per page one column for each request (``Want``).  All selectors of all requests run during the read as
one bit-parallel automaton over the stack of open elements: a bit stands for one part of a selector, an element's
set bits are the parts that it completes, and the parts that its children may complete follow from its own and its
ancestors' by two shifts.  Only requested fields of elements that match are built, so a page's output is as large as what
was asked for, and a page is never spread across rows, so no selector needs a shuffle.

Tree rules: void tags close themselves, and so does a start tag that ends in ``/>`` unless it is a ``<p/>``, which is read as ``<p>``;
an open ``<p>`` is closed by the next block-level start tag, by ``</p>``, or by its parent's end tag; a stray end tag
closes the nearest open element of that name (and everything inside it).  A ``>`` inside a quoted attribute value does not end a
tag.  ``text`` excludes script/style content and comments; entities are not decoded in it, but in attribute values.
"""

from __future__ import annotations

import html as html_lib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from ..functions.html import BLOCK_TAGS
from ..session import bound_batches

# Void elements.  The tags that close an open paragraph are shared with the native extraction.
VOID_TAGS = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source",
             "track", "wbr"}
P_CLOSERS = {*BLOCK_TAGS, "p"}
RAW_TEXT = {"script", "style"}

#: What a request may ask for.  ``depth`` counts ancestors, ``around`` has their classes from the outermost on,
#: ``link`` is the element itself if it is an ``a``, else its first descendant ``a`` (NODE-5).
FIELD_TYPES = {
    "node_id": pa.int32(), "tag": pa.string(), "elem_id": pa.string(), "classes": pa.list_(pa.string()), "attrs": pa.map_(pa.string(), pa.string()),
    "depth": pa.int32(), "around": pa.list_(pa.list_(pa.string())), "text": pa.string(), "inner_html": pa.string(), "open_tag": pa.string(),
    "link": pa.struct([("href", pa.string()), ("text", pa.string())]),
}
_SPARK_TYPES = {
    "node_id": "int", "tag": "string", "elem_id": "string", "classes": "array<string>", "attrs": "map<string,string>", "depth": "int",
    "around": "array<array<string>>", "text": "string", "inner_html": "string", "open_tag": "string", "link": "struct<href:string,text:string>",
}
_TEXT_FIELDS = {"text", "link"}
#: Characters of pages read before their results are sent on.
OUT_CHARS = 1_000_000

_TOKEN = re.compile(r"<(?:(/?)([A-Za-z][^\s/>]*)((?:[^>=]+|=\s*(?:\"[^\"]*\"|'[^']*')?)*+)>|!--.*?(?:-->|\Z)|[!?][^>]*(?:>|\Z))", re.S)
_ATTR = re.compile(r"([^\s/>=\"'][^\s/>=]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]*)))?")
_UNQUOTED_END = re.compile(r"=\s*[^\s\"']+/$")
_RAW_END = {tag: re.compile(rf"</{tag}\b", re.I) for tag in RAW_TEXT}


# ------------------------------------------------------------------------------------- requests and selectors

@dataclass(frozen=True)
class Want:
    """One request: the elements that match ``selector``, in document order, with ``fields``.

    Several selectors are tried in order, and the first that has any match counts (NODE-4; its number, from 1 on, is
    the column ``<name>_rank``, null without a match).  ``first`` gives the first match alone, as a struct or null (NODE-3).  ``within``
    names another request, of whose first match the elements must be descendants (NODE-11)."""

    selector: str | tuple[str, ...]
    fields: tuple[str, ...] = ("text",)
    first: bool = False
    within: str | None = None

    @property
    def selectors(self) -> tuple[str, ...]:
        return (self.selector,) if isinstance(self.selector, str) else tuple(self.selector)


@dataclass(frozen=True)
class Compound:
    """One part of a selector: what an element itself must be."""

    tag: str | None
    elem_id: str | None
    classes: tuple[str, ...]
    attrs: tuple[tuple[str, str | None], ...]

    def holds(self, attrs: dict[str, str]) -> bool:
        """The tests beside the tag."""
        if self.elem_id is not None and attrs.get("id") != self.elem_id:
            return False
        if self.classes:
            own = attrs.get("class", "").split()
            if not all(c in own for c in self.classes):
                return False
        return all(k in attrs and (v is None or attrs[k] == v) for k, v in self.attrs)


_COMPOUND = re.compile(r"^(?P<tag>[a-zA-Z][a-zA-Z0-9]*|\*)?(?P<rest>(?:[#.][A-Za-z0-9_-]+|\[[^\]]+\])*)$")


def _parse_compound(text: str) -> Compound:
    m = _COMPOUND.match(text)
    if not m or not text:
        raise ValueError(f"unsupported selector part {text!r}")
    tag, elem_id, classes, attrs = (m.group("tag") or "").lower(), None, [], []
    for part in re.findall(r"[#.][A-Za-z0-9_-]+|\[[^\]]+\]", m.group("rest")):
        if part[0] == "#":
            elem_id = part[1:]
        elif part[0] == ".":
            classes.append(part[1:])
        else:
            name, equals, value = part[1:-1].partition("=")
            attrs.append((name.strip(), value.strip().strip("\"'") if equals else None))
    return Compound(None if tag in ("", "*") else tag, elem_id, tuple(classes), tuple(attrs))


def parse_selector(selector: str) -> list[list[tuple[str, Compound]]]:
    """Selector text -> list (comma union) of chains [(combinator, compound), ...]; combinators are ``" "`` and ``">"``."""
    chains = []
    for alternative in selector.split(","):
        chain, combinator = [], " "
        for part in re.findall(r">|(?:\[[^\]]*\]|[^\s>\[])+", alternative.strip()):
            if part == ">":
                combinator = ">"
                continue
            chain.append((combinator, _parse_compound(part)))
            combinator = " "
        if not chain:
            raise ValueError(f"empty selector in {selector!r}")
        chains.append(chain)
    return chains


class Automaton:
    """All chains of all requests, one bit a part; the parts of a chain are neighbours."""

    def __init__(self, wants: dict[str, Want]):
        self.tests: dict[int, Compound] = {}  # bit -> compound that tests more than the tag
        self.start = self.child = self.descendant = self.finals = self.any_tag = 0
        self.finals_of: dict[int, list[tuple[str, int]]] = {}  # bit -> (request, selector's number)
        by_tag: dict[str, int] = {}
        bit = 1
        for name, want in wants.items():
            for number, selector in enumerate(want.selectors):
                for chain in parse_selector(selector):
                    for i, (combinator, compound) in enumerate(chain):
                        if i == 0:
                            self.start |= bit
                        elif combinator == ">":
                            self.child |= bit
                        else:
                            self.descendant |= bit
                        if compound.tag:
                            by_tag[compound.tag] = by_tag.get(compound.tag, 0) | bit
                        else:
                            self.any_tag |= bit
                        if compound.elem_id is not None or compound.classes or compound.attrs:
                            self.tests[bit] = compound
                        if i == len(chain) - 1:
                            self.finals |= bit
                            self.finals_of[bit] = [(name, number)]
                        bit <<= 1
        self.conditional = sum(self.tests)
        self.by_tag = {tag: bits | self.any_tag for tag, bits in by_tag.items()}

    def completed(self, tag: str, above: int, parent: int, attrs) -> int:
        """The parts that an element completes, from those that its ancestors (``above``) and its parent completed."""
        bits = self.by_tag.get(tag, self.any_tag)
        bits &= self.start | ((above << 1) & self.descendant) | ((parent << 1) & self.child)
        open_ = bits & self.conditional
        while open_:
            low = open_ & -open_
            if not self.tests[low].holds(attrs()):
                bits ^= low
            open_ ^= low
        return bits


def _attributes(text: str) -> dict[str, str]:
    """Attributes by lower-cased name; of equal names the first counts, a missing value is empty."""
    out: dict[str, str] = {}
    for m in _ATTR.finditer(text):
        name = m.group(1).lower()
        if name not in out:
            value = m.group(2) or m.group(3) or m.group(4) or ""
            out[name] = html_lib.unescape(value) if "&" in value else value
    return out


# ---------------------------------------------------------------------------------------------- one page

class _Node:
    __slots__ = ("node_id", "tag", "attrs", "depth", "around", "open_tag", "inner", "inner_end", "text", "text_end", "last")

    def close(self, at: int, text_at: int, last: int) -> None:
        self.inner_end, self.text_end, self.last = at, text_at, last


class Reader:
    """Reads pages for a set of requests."""

    def __init__(self, wants: dict[str, Want]):
        for name, want in wants.items():
            unknown = set(want.fields) - set(FIELD_TYPES)
            if unknown or not want.fields or want.within is not None and want.within not in wants:
                raise ValueError(f"request {name!r}: unknown or missing fields or container")
        self.wants = wants
        self.automaton = Automaton(wants)
        self.needs_text = any(_TEXT_FIELDS & set(w.fields) for w in wants.values())
        self.needs_links = any("link" in w.fields for w in wants.values())
        self.needs_around = any("around" in w.fields for w in wants.values())
        containers = {w.within for w in wants.values()}
        # of these requests the first match alone is held
        self.single = {n for n, w in wants.items() if (w.first or n in containers and not set(w.fields) - {"node_id"}) and w.within is None and len(w.selectors) == 1}

    def read(self, html: str | None) -> dict[str, tuple[int | None, list]]:
        """Of each request the number of the selector that matched and the fields of its matches."""
        found, links, full = self._scan(html or "")
        out = {}
        for name, want in self.wants.items():
            rank, nodes = self._matches(name, found)
            out[name] = rank, [self._fields(n, want.fields, html, full, links) for n in (nodes[:1] if want.first else nodes)]
        return out

    def _matches(self, name: str, found: dict) -> tuple[int | None, list[_Node]]:
        want = self.wants[name]
        box = None
        if want.within is not None:
            holders = self._matches(want.within, found)[1]
            if not holders:
                return None, []
            box = holders[0]
        for number in range(len(want.selectors)):
            nodes = found.get((name, number), [])
            if box is not None:
                nodes = [n for n in nodes if box.node_id < n.node_id <= box.last]
            if nodes:
                return number + 1, nodes
        return None, []

    def _fields(self, node: _Node, fields: tuple[str, ...], html: str, full: str, links: list[_Node]) -> dict:
        out = {}
        for f in fields:
            if f == "text":
                out[f] = full[node.text: node.text_end]
            elif f == "inner_html":
                out[f] = html[node.inner: node.inner_end]
            elif f == "elem_id":
                out[f] = node.attrs.get("id")
            elif f == "classes":
                out[f] = node.attrs.get("class", "").split()
            elif f == "attrs":
                out[f] = list(node.attrs.items())
            elif f == "link":
                a = node if node.tag == "a" else next((x for x in links if node.node_id < x.node_id <= node.last), None)
                out[f] = None if a is None else {"href": a.attrs.get("href"), "text": full[a.text: a.text_end]}
            else:
                out[f] = getattr(node, f)
        return out

    def _scan(self, html: str) -> tuple[dict, list[_Node], str]:
        auto, needs_text = self.automaton, self.needs_text
        found: dict[tuple[str, int], list[_Node]] = {}
        links: list[_Node] = []
        parts: list[str] = []
        # open elements: [tag, parts completed, parts completed by it and its ancestors, its node if it is wanted, classes]
        stack: list[list] = []
        text_at = count = 0
        at, end = 0, len(html)

        def close(depth: int, where: int) -> None:
            for frame in stack[depth:]:
                if frame[3] is not None:
                    frame[3].close(where, text_at, count - 1)
            del stack[depth:]

        def close_paragraph(where: int) -> None:
            """End the open paragraph, if no block lies between it and here."""
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == "p":
                    close(i, where)
                    return
                if stack[i][0] in P_CLOSERS:
                    return

        while at < end:
            m = _TOKEN.search(html, at)
            if m is None:
                break
            begin = m.start()
            if needs_text and begin > at:
                parts.append(html[at:begin])
                text_at += begin - at
            at = m.end()
            tag = m.group(2)
            if tag is None:
                continue
            tag = tag.lower()
            if m.group(1):
                if tag in P_CLOSERS and tag != "p":
                    close_paragraph(begin)
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] == tag:
                        close(i, begin)
                        break
                continue
            if tag in P_CLOSERS:
                close_paragraph(begin)
            raw = m.group(3)
            known: list[dict] = []

            def attrs() -> dict[str, str]:
                if not known:
                    known.append(_attributes(raw) if raw else {})
                return known[0]

            above, parent = (stack[-1][2], stack[-1][1]) if stack else (0, 0)
            own = auto.completed(tag, above, parent, attrs)
            node = None
            hits = own & auto.finals
            if hits or self.needs_links and tag == "a":
                node = _Node()
                node.node_id, node.tag, node.attrs, node.depth, node.open_tag = count, tag, attrs(), len(stack), m.group()
                node.inner, node.text = at, text_at
                node.around = [f[4].split() for f in stack] if self.needs_around else None
                if tag == "a":
                    links.append(node)
                while hits:
                    low = hits & -hits
                    for key in auto.finals_of[low]:
                        own_list = found.setdefault(key, [])
                        if not (own_list and (key[0] in self.single or own_list[-1] is node)):
                            own_list.append(node)
                    hits ^= low
            count += 1
            closed = tag in VOID_TAGS or tag != "p" and raw.endswith("/") and not _UNQUOTED_END.search(raw)
            if closed:
                if node is not None:
                    node.close(at, text_at, count - 1)
                continue
            stack.append([tag, own, above | own, node, attrs().get("class", "") if self.needs_around else None])
            if tag in RAW_TEXT:
                stop = _RAW_END[tag].search(html, at)
                at = stop.start() if stop else end
        if needs_text and at < end:
            parts.append(html[at:])
            text_at += end - at
        close(0, end)
        return found, links, "".join(parts)


# ---------------------------------------------------------------------------------------------- the stage

def extract(pages: DataFrame, wants: dict[str, Want], id_col: str = "page_id", keep: tuple[str, ...] = ("url",), html: str = "html") -> DataFrame:
    """NODE-1..5, NODE-11: (id_col, <keep>, <one column a request>), one row per page.

    A request's column is array<struct<fields>>, or struct<fields> with ``first``; ``<name>_rank`` int follows it where it has
    several selectors.  Null and empty pages match nothing.  Pages come in bounded batches, whatever the session's are, and one at a time
    out of these; results are sent on after about ``OUT_CHARS`` characters.  Filter and de-duplicate pages *before* this stage: predicates
    are not pushed through it."""
    bound_batches(pages.sparkSession)
    cols = [id_col, *(c for c in dict.fromkeys(keep) if c in pages.columns and c != id_col)]
    fields = [pages.schema[c] for c in cols]
    arrow, spark_types = {}, []
    for name, want in wants.items():
        own = pa.struct([(f, FIELD_TYPES[f]) for f in want.fields])
        kind = "struct<" + ",".join(f"{f}:{_SPARK_TYPES[f]}" for f in want.fields) + ">"
        arrow[name] = own if want.first else pa.list_(own)
        spark_types.append(f"`{name}` {kind}" if want.first else f"`{name}` array<{kind}>")
        if len(want.selectors) > 1:
            spark_types.append(f"`{name}_rank` int")
    schema = StructType([*(StructField(f.name, f.dataType) for f in fields), *StructType.fromDDL(", ".join(spark_types)).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(wants)
        for b in batches:
            sources = b.column(b.num_columns - 1)
            at = 0
            while at < len(sources):
                read, upto, size = [], at, 0
                while upto < len(sources) and size < OUT_CHARS:
                    source = sources[upto].as_py() or ""
                    read.append(reader.read(source))
                    size += len(source)
                    upto += 1
                out = [c.slice(at, upto - at) for c in b.columns[:-1]]
                for name, want in wants.items():
                    own = [r[name] for r in read]
                    out.append(pa.array([(x[0] if x else None) if want.first else x for _, x in own], arrow[name]))
                    if len(want.selectors) > 1:
                        out.append(pa.array([rank for rank, _ in own], pa.int32()))
                yield pa.RecordBatch.from_arrays(out, names=schema.names)
                at = upto

    return pages.select(*cols, F.col(html).alias("_source")).mapInArrow(run, schema)


def attr(node: Column, name: str) -> Column:
    """An attribute of a match whose ``attrs`` were asked for; null without it."""
    return F.try_element_at(node["attrs"], F.lit(name))


def attr_fallback(node: Column, first_attr: str, second_attr: str) -> Column:
    """NODE-8: first attribute if non-empty, else the second."""
    a = attr(node, first_attr)
    return F.when(a.isNotNull() & (a != ""), a).otherwise(attr(node, second_attr))
