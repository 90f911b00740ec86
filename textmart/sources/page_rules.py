"""Stored pages by declarative rules: blocks and fields by tag and class, containers of any nesting.

A selector is ``"tag"``, ``"tag.class"`` or ``".class"``. Pages are parsed with
the standard library's tolerant HTML parser in Arrow batches, each page on its
own, so the job is one narrow stage.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmart import dictionaries as D

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
HIDDEN = frozenset(("script", "style"))
# An opening tag of the key ends the open elements of these tags, with the inline elements left open in them.
ENDS = {"p": ("p",), "li": ("p", "li"), "ul": ("p",), "ol": ("p",), "div": ("p",), "article": ("p",), "section": ("p",)}
INLINE = frozenset("a abbr b big cite code em font i label mark q s small span strong sub sup time u var".split())


class Node:
    __slots__ = ("tag", "attrs", "classes", "parts")

    def __init__(self, tag: str, attrs: dict[str, str]):
        self.tag, self.attrs, self.parts = tag, attrs, []
        self.classes = frozenset((attrs.get("class") or "").split())

    def all(self, selector: str) -> list[Node]:
        """Matching elements below this one, in page order; nothing is searched inside a match."""
        tag, _, cls = selector.partition(".")
        found, todo = [], [x for x in reversed(self.parts) if isinstance(x, Node)]
        while todo:
            n = todo.pop()
            if (not tag or n.tag == tag) and (not cls or cls in n.classes):
                found.append(n)
            else:
                todo += [x for x in reversed(n.parts) if isinstance(x, Node)]
        return found

    def text(self) -> str:
        out, todo = [], list(reversed(self.parts))
        while todo:
            x = todo.pop()
            if isinstance(x, str):
                out.append(x)
            elif x.tag not in HIDDEN:
                todo += reversed(x.parts)
        return "".join(out).strip()


class _Tree(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Node("", {})
        self.stack, self.open = [self.root], {}

    def _pop(self) -> None:
        self.open[self.stack.pop().tag] -= 1

    def handle_starttag(self, tag: str, attrs: list) -> None:
        ends = ENDS.get(tag, ())
        while any(self.open.get(e) for e in ends):
            at = len(self.stack) - 1
            while at and self.stack[at].tag in INLINE:
                at -= 1
            if self.stack[at].tag not in ends:
                break
            while len(self.stack) > at:
                self._pop()
        node = Node(tag, {k: v or "" for k, v in attrs})
        self.stack[-1].parts.append(node)
        if tag not in VOID:
            self.stack.append(node)
            self.open[tag] = self.open.get(tag, 0) + 1

    def handle_endtag(self, tag: str) -> None:
        if self.open.get(tag):
            while self.stack[-1].tag != tag:
                self._pop()
            self._pop()

    def handle_data(self, data: str) -> None:
        self.stack[-1].parts.append(data)


def tree(html: str | None) -> Node:
    t = _Tree()
    t.feed(html or "")
    t.close()
    return t.root


def listing(pages: DataFrame, block: str, fields: Mapping[str, tuple[str, str]], *, required: Sequence[str] = (),
            key: str = "page_id", html: str = "html") -> DataFrame:
    """One row ``(key, pos, *fields)`` per block; blocks without a ``required`` field are skipped.

    A field is ``(selector, what)``: ``text`` and ``@name`` (an attribute) take
    the first match, ``count`` the number of matches (a rating's filled stars).
    """
    kind = dict(pages.dtypes)[key]
    names = list(fields)
    schema = f"`{key}` {kind}, pos int, " + ", ".join(f"`{n}` {'int' if fields[n][1] == 'count' else 'string'}" for n in names)

    def value(n: Node, selector: str, what: str):
        got = n.all(selector)
        if what == "count":
            return len(got)
        if not got:
            return None
        return got[0].text() if what == "text" else got[0].attrs.get(what[1:])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, pos, cols = [], [], {n: [] for n in names}
            for i in range(batch.num_rows):
                for p, b in enumerate(tree(batch.column(1)[i].as_py()).all(block)):
                    row = {n: value(b, *fields[n]) for n in names}
                    if all(row[n] not in (None, "") for n in required):
                        at.append(i)
                        pos.append(p)
                        for n in names:
                            cols[n].append(row[n])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at, pa.int64())), pa.array(pos, pa.int32()),
                 *(pa.array(cols[n], pa.int32() if fields[n][1] == "count" else pa.string()) for n in names)], names=[key, "pos", *names])

    return pages.select(F.col(key), F.col(html)).mapInArrow(run, schema)


def body_text(pages: DataFrame, container: str, *, paragraphs: Sequence[str] = ("p",), key: str = "page_id", html: str = "html",
              not_found: str = D.CONTENT_NOT_FOUND) -> DataFrame:
    """``(key, content)``: the paragraphs of the first container, however nested, joined by a blank line, or the sentinel."""
    kind = dict(pages.dtypes)[key]

    def content(page: str | None) -> str:
        boxes = tree(page).all(container)
        if not boxes:
            return not_found
        found, todo = [], [boxes[0]]
        while todo:
            n = todo.pop()
            if n.tag in paragraphs and n is not boxes[0]:
                found.append(n.text())
            else:
                todo += [x for x in reversed(n.parts) if isinstance(x, Node)]
        return "\n\n".join(t for t in found if t)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [content(batch.column(1)[i].as_py()) for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=[key, "content"])

    return pages.select(F.col(key), F.col(html)).mapInArrow(run, f"`{key}` {kind}, content string")
