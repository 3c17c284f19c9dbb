"""Pages of HTML as rows of nodes.

One Python step turns a page into its visible text and an array of nodes, each
with the stretch of text its subtree covers. Everything later is column
expressions on that row: no shuffle, however many pages there are.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator, Sequence, Sized
from html import unescape
from html.entities import html5
from html.parser import HTMLParser
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from veinworks.functions.text import strip

# Elements without content, and elements whose text is not shown.
VOID_TAGS = frozenset(
    "area base basefont bgsound br col command embed frame hr image img input isindex "
    "keygen link menuitem meta nextid param source spacer track wbr".split()
)
HIDDEN_TAGS = frozenset("script style template rt rp".split())
KEEP_SPACE_TAGS = frozenset("pre textarea".split())
TEXT_TAGS = frozenset("script style textarea title iframe noembed noframes noscript xmp plaintext".split())  # markup may end with them
ASCII_SPACES = " \n\t\f\r"

NODE_SCHEMA = (
    "array<struct<node:int,parent:int,previous:int,last:int,tag:string,attrs:map<string,string>,"
    "classes:array<string>,start:int,length:int,mark:string>>"
)
NODE_TYPES = {
    "node": pa.int32(), "parent": pa.int32(), "previous": pa.int32(), "last": pa.int32(), "tag": pa.string(),
    "attrs": pa.map_(pa.string(), pa.string()), "classes": pa.list_(pa.string()), "start": pa.int32(), "length": pa.int32(), "mark": pa.string(),
}
# Places of a node's fields while it is read.
LAST, TAG, START, LENGTH, MARK, NEWEST = 3, 4, 7, 8, 9, 10
NO_ATTRS: dict[str, str] = {}
NO_CLASSES: list[str] = []
NO_NODES: dict[str, Sequence] = {name: () for name in NODE_TYPES}
P_RULES = ("literal", "html5")
_PLAIN = re.compile(r"([^<&]*)<(/?)([a-zA-Z][a-zA-Z0-9]*)>")
PAGES_PER_LOT, CHARACTERS_PER_LOT = 256, 500_000  # a longer page is a lot of its own


class _Nodes(HTMLParser):
    """Collects nodes and visible text from parser events.

    An end tag closes the nearest open element of its name and everything in
    it; without one it is ignored. With ``p_rule='html5'`` a new paragraph also
    closes an open one.
    """

    def __init__(self, p_rule: str):
        super().__init__(convert_charrefs=False)
        self.p_rule = p_rule
        self.nodes: list[list] = []  # the fields of NODE_TYPES, and the last child so far
        self.top = [-1] * (NEWEST + 1)
        self.open: list[list] = []
        self.hidden = self.spaced = self.rows = 0  # open elements: not shown, with kept white space, rows of tables
        self.text: list[str] = []
        self.length = 0
        self.pending: list[str] = []
        self.trace: list[str] = []  # events inside rows of tables
        self.traced: list[int] = []  # where the trace of each open row begins

    def _flush(self) -> None:
        if not self.pending:
            return
        data = "".join(self.pending)
        self.pending = []
        if not data:
            return
        if not self.spaced and not data.strip(ASCII_SPACES):
            data = "\n" if "\n" in data else " "
        if self.rows:
            self.trace.append("\x00t" + data)
        if not self.hidden:
            self.text.append(data)
            self.length += len(data)

    def _close(self, depth: int) -> None:
        last = len(self.nodes) - 1
        while len(self.open) > depth:
            node = self.open.pop()
            node[LAST], node[LENGTH] = last, self.length - node[START]
            tag = node[TAG]
            if tag == "tr":
                own = "".join(self.trace[self.traced.pop() :])
                node[MARK] = hashlib.md5(own.encode("utf-8", "surrogatepass")).hexdigest()
                self.rows -= 1
                if not self.rows:
                    self.trace = []
            elif tag in HIDDEN_TAGS:
                self.hidden -= 1
            elif tag in KEEP_SPACE_TAGS:
                self.spaced -= 1
            if self.rows:
                self.trace.append("\x00e")

    def _begin(self, tag: str, attrs: dict[str, str]) -> None:
        if self.pending:
            self._flush()
        if tag == "p" and self.p_rule == "html5":
            self.handle_endtag("p")
        number, above = len(self.nodes), self.open[-1] if self.open else self.top
        classes = attrs.get("class", "").split() if attrs else NO_CLASSES
        node = [number, above[0], above[NEWEST], number, tag, attrs, classes, self.length, 0, None, -1]
        above[NEWEST] = number
        self.nodes.append(node)
        self.open.append(node)
        if tag == "tr":
            self.rows += 1
            self.traced.append(len(self.trace))
        elif tag in HIDDEN_TAGS:
            self.hidden += 1
        elif tag in KEEP_SPACE_TAGS:
            self.spaced += 1
        if self.rows:
            self.trace.append(f"\x00s{tag}{sorted(attrs.items())!r}" if attrs else f"\x00s{tag}[]")
        if tag in VOID_TAGS:
            self._close(len(self.open) - 1)

    def _plain(self, place: int) -> int:
        """Take text and tags without attributes from ``place`` on, up to anything else."""
        match, page = _PLAIN.match, self.rawdata
        while (found := match(page, place)) is not None:
            data, end, tag = found.groups()
            tag = tag.lower()
            if not end and tag in TEXT_TAGS:
                break
            if data:
                self.pending.append(data)
            if end:
                self.handle_endtag(tag)
            else:
                self._begin(tag, NO_ATTRS)
            place = found.end()
        return place

    def updatepos(self, i, j):
        return j  # line numbers are not asked for

    def parse_starttag(self, i):
        end = self._plain(i)
        if end == i:
            end = super().parse_starttag(i)
        return end if end < 0 or self.cdata_elem is not None else self._plain(end)

    def parse_endtag(self, i):
        end = super().parse_endtag(i)
        return end if end < 0 or self.cdata_elem is not None else self._plain(end)

    def handle_starttag(self, tag, attrs):
        self._begin(tag, {k: v if v is not None else "" for k, v in attrs})

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID_TAGS:
            self._close(len(self.open) - 1)

    def handle_endtag(self, tag):
        if self.pending:
            self._flush()
        for depth in range(len(self.open) - 1, -1, -1):
            if self.open[depth][TAG] == tag:
                self._close(depth)
                return

    def handle_data(self, data):
        self.pending.append(data)

    def handle_entityref(self, name):
        # Only whole names are replaced, with or without a semicolon.
        self.pending.append(html5.get(name + ";", "&" + name))

    def handle_charref(self, name):
        self.pending.append(unescape(f"&#{name};"))

    def handle_comment(self, data):
        self._flush()
        if self.rows:
            self.trace.append("\x00c" + data)

    def handle_decl(self, decl):
        self._flush()

    def handle_pi(self, data):
        self._flush()

    def unknown_decl(self, data):
        if data.upper().startswith("CDATA["):
            self.pending.append(data[len("CDATA[") :])

    def finish(self) -> tuple[str, dict[str, Sequence]]:
        """The text, and per field the values of all nodes."""
        self.close()
        self._flush()
        self._close(0)
        return "".join(self.text), dict(zip(NODE_TYPES, zip(*self.nodes, strict=True))) if self.nodes else NO_NODES


def _parsed(html: str, p_rule: str) -> tuple[str, dict[str, Sequence]]:
    parser = _Nodes(p_rule)
    parser.feed(html)
    return parser.finish()


def parse_page(html: str, p_rule: str = "literal") -> tuple[str, list[dict]]:
    text, fields = _parsed(html, p_rule)
    return text, [dict(zip(fields, node, strict=True)) for node in zip(*fields.values(), strict=True)]


def _offsets(lists: Iterable[Sized]) -> pa.Array:
    return pa.array([0, *accumulate(map(len, lists))], pa.int32())


def _node_lists(pages: Sequence[dict[str, Sequence]]) -> pa.Array:
    """The nodes of each page as one list of structs, made field by field."""
    fields = {name: [value for page in pages for value in page[name]] for name in NODE_TYPES}
    attrs, classes = fields["attrs"], fields["classes"]
    keys, values = [k for a in attrs for k in a], [v for a in attrs for v in a.values()]
    columns = fields | {
        "attrs": pa.MapArray.from_arrays(_offsets(attrs), pa.array(keys, pa.string()), pa.array(values, pa.string())),
        "classes": pa.ListArray.from_arrays(_offsets(classes), pa.array([c for own in classes for c in own], pa.string())),
    }
    arrays = [c if isinstance(c, pa.Array) else pa.array(c, NODE_TYPES[name]) for name, c in columns.items()]
    nodes = pa.StructArray.from_arrays(arrays, fields=[pa.field(name, kind) for name, kind in NODE_TYPES.items()])
    return pa.ListArray.from_arrays(_offsets([page["tag"] for page in pages]), nodes)


def lots(bodies: Iterable[str | None]) -> Iterator[tuple[int, int]]:
    """Stretches of few pages and few characters, in which nodes are made and handed on."""
    start = size = end = 0
    for place, body in enumerate(bodies):
        own, end = len(body) if body is not None else 0, place + 1
        if place > start and (place - start >= PAGES_PER_LOT or size + own > CHARACTERS_PER_LOT):
            yield start, place
            start, size = place, 0
        size += own
    if end:
        yield start, end


def parse_pages(
    pages: DataFrame, html: str = "html", keep: tuple[str, ...] = ("page_id", "url"), p_rule: str = "literal"
) -> DataFrame:
    """(kept columns, text, nodes, error): one row per page, whole pages.

    A page without a body (NULL) or one that cannot be parsed keeps its row,
    with the reason in ``error`` and no nodes.
    """
    if p_rule not in P_RULES:
        raise ValueError(f"p_rule must be one of: {', '.join(P_RULES)}")
    source = pages.select(*keep, F.col(html).alias("_html"))

    def read(body):
        if body is None:
            return None, NO_NODES, "no page body"
        try:
            return *_parsed(body, p_rule), None
        except (AssertionError, ValueError) as problem:
            return None, NO_NODES, str(problem)

    names = [*keep, "text", "nodes", "error"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bodies = batch.column(len(keep)).to_pylist()
            # Nodes take more room than their page: hand them on in small lots.
            for start, end in lots(bodies):
                text, nodes, error = zip(*map(read, bodies[start:end]), strict=True)
                lot = batch.slice(start, end - start).columns[: len(keep)]
                made = [pa.array(text, pa.string()), _node_lists(nodes), pa.array(error, pa.string())]
                yield pa.RecordBatch.from_arrays([*lot, *made], names)

    kept = ", ".join(f"`{c}` {source.schema[c].dataType.simpleString()}" for c in keep)
    return source.mapInArrow(run, f"{kept}, text string, nodes {NODE_SCHEMA}, error string")


def node_table(parsed: DataFrame, key: str = "page_id") -> DataFrame:
    """One row per node, for work on single nodes."""
    return parsed.select(key, F.inline("nodes"))


_SIMPLE = re.compile(
    r"(?P<tag>^[a-zA-Z][\w-]*|^\*)|\.(?P<cls>[\w-]+)|#(?P<id>[\w-]+)"
    r"|\[(?P<attr>[\w-]+)(?:=(?P<quote>[\"']?)(?P<value>[^\"'\]]*)(?P=quote))?\]"
)


def matches(node: Column, selector: str) -> Column:
    """Whether a node meets a selector list of tags, classes, ids and attributes."""
    any_of = F.lit(False)
    for part in (p.strip() for p in selector.split(",")):
        all_of, end = F.lit(True), 0
        for hit in _SIMPLE.finditer(part):
            if hit.start() != end:
                break
            end = hit.end()
            if hit["tag"] and hit["tag"] != "*":
                all_of = all_of & (node["tag"] == hit["tag"].lower())
            elif hit["cls"]:
                all_of = all_of & F.array_contains(node["classes"], hit["cls"])
            elif hit["id"]:
                all_of = all_of & F.coalesce(node["attrs"]["id"] == hit["id"], F.lit(False))
            elif hit["attr"] and hit["value"] is None:
                all_of = all_of & F.map_contains_key(node["attrs"], hit["attr"].lower())
            elif hit["attr"]:
                all_of = all_of & F.coalesce(node["attrs"][hit["attr"].lower()] == hit["value"], F.lit(False))
        if not part or end != len(part):
            raise ValueError(f"selector {part!r} is not supported: use tag, .class, #id, [attr] or [attr=\"value\"]")
        any_of = any_of | all_of
    return any_of


_COMPOUND = re.compile(r"(?:[^\s>+~,\[]|\[[^\]]*\])+")


def selector_steps(selector: str) -> list[list[tuple[str, str]]]:
    """Per part of a selector list the steps (relation to the step before, compound).

    Relations are `` `` (descendant, also of the first step), ``>``, ``+`` and ``~``.
    """
    parts, steps, relation, end = [], [], " ", 0
    for hit in _COMPOUND.finditer(selector):
        between = selector[end : hit.start()]
        marks = "".join(between.split())
        if "," in marks:
            parts.append(steps)
            steps, marks = [], marks.replace(",", "", 1)
        if len(marks) > 1 or (marks and (marks not in ">+~" or not steps)) or (parts and not parts[-1]):
            raise ValueError(f"selector {selector!r} is not supported")
        relation = marks or " "
        steps.append((relation, hit.group()))
        end = hit.end()
    if selector[end:].strip() or not steps:
        raise ValueError(f"selector {selector!r} is not supported")
    return [*parts, steps]


def _bound(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _flag(flags: Column, place: Column) -> Column:
    return F.coalesce(F.get(flags, place), F.lit(False))


def _flags_of(numbers: Column) -> Column:
    """True at the given ascending places, false before and between them."""
    before = F.slice(F.concat(F.array(F.lit(-1)), numbers), F.lit(1), F.size(numbers))
    return F.flatten(F.zip_with(numbers, before, lambda n, b: F.concat(F.array_repeat(F.lit(False), n - b - 1), F.array(F.lit(True)))))


def _related(nodes: Column, flags: Column, relation: str, compound: str) -> Column:
    """Flags of the nodes that meet ``compound`` and are related to a flagged one.

    Parents and previous siblings are looked up by number; descendants are the
    numbers that the flagged nodes' intervals cover. Only ``~`` looks through
    all flagged nodes for each candidate.
    """
    if relation == ">":
        return F.transform(nodes, lambda n: matches(n, compound) & _flag(flags, n["parent"]))
    if relation == "+":
        return F.transform(nodes, lambda n: matches(n, compound) & _flag(flags, n["previous"]))
    holders = F.filter(nodes, lambda n: _flag(flags, n["node"]))
    if relation == "~":
        return _bound(holders, lambda held: F.transform(
            nodes, lambda n: matches(n, compound) & F.exists(held, lambda h: (h["parent"] == n["parent"]) & (h["node"] < n["node"]))
        ))
    none = F.array().cast("array<int>")
    covered = F.flatten(F.transform(holders, lambda h: F.when(h["last"] > h["node"], F.sequence(h["node"] + 1, h["last"])).otherwise(none)))
    candidates = F.transform(F.filter(nodes, lambda n: matches(n, compound)), lambda n: n["node"])
    return _bound(F.array_intersect(candidates, covered), _flags_of)


def _selected(nodes: Column, steps: list[tuple[str, str]]) -> Column:
    """Flags of the nodes that the last of several steps reaches; the nodes are all those of a page."""
    *before, (relation, compound) = steps
    if not before:
        return F.transform(nodes, lambda n: matches(n, compound))
    return _bound(_selected(nodes, before), lambda flags: _related(nodes, flags, relation, compound))


def select_nodes(nodes: Column, selector: str) -> Column:
    """Matching nodes of a page in document order.

    A list of compounds (tags, classes, ids, attributes) with descendant (`` ``),
    child (``>``), next (``+``) and later sibling (``~``) steps between them.
    """
    parts = selector_steps(selector)
    plain = [steps[0][1] for steps in parts if len(steps) == 1]
    related = [steps for steps in parts if len(steps) > 1]
    if not related:
        return F.filter(nodes, lambda n: matches(n, selector))
    flags = F.array(*[_selected(nodes, steps) for steps in related])
    return _bound(flags, lambda f: F.filter(
        nodes, lambda n: F.exists(f, lambda one: _flag(one, n["node"])) | (matches(n, ", ".join(plain)) if plain else F.lit(False))
    ))


def inside(nodes: Column, outer: Column) -> Column:
    """Descendants of a node: the nodes that follow it, up to its last one."""
    return F.slice(nodes, outer["node"] + 2, outer["last"] - outer["node"])


def descendants(nodes: Column, outer: Column, selector: str) -> Column:
    """Matching nodes below one; steps before the last may lie outside of it."""
    if all(len(steps) == 1 for steps in selector_steps(selector)):
        return select_nodes(inside(nodes, outer), selector)
    return F.filter(select_nodes(nodes, selector), lambda n: (n["node"] > outer["node"]) & (n["node"] <= outer["last"]))


def first(nodes: Column) -> Column:
    return F.get(nodes, F.lit(0))


def node_text(text: Column, node: Column) -> Column:
    """Stripped text of a node's subtree."""
    return strip(F.substring(text, node["start"] + 1, node["length"]))


def node_texts(text: Column, nodes: Column) -> Column:
    return F.transform(nodes, lambda n: node_text(text, n))
