"""Anchor extraction from stored HTML pages (SC10), as a Spark job.

The original crawled live pages with an HTML parser on one machine.  Here
pages are rows of a table, a task reads the markup of each page once from start
to end, and every anchor is one output row.

The tokeniser knows what is markup and what is not: comments (also unclosed and
``<!-->``), declarations, the raw text of script, style and the like, quoted
attribute values with ``<`` and ``>`` in them, and a ``<`` that opens nothing,
which is text.  Over its tokens runs a state machine with the stack of open
elements of one anchor.

An anchor is an ``<a>`` with an ``href``; it ends at ``</a>`` or, where that is
missing, at the next anchor or the end of the page.  For each:
  * ``text``   - the anchor's first child when it is text (null when the
                 anchor is empty or starts with an element);
  * ``child1`` - the text right after a leading element, i.e. the second
                 child when the first one is an element (null otherwise).
                 The element ends at its own end tag, elements of its name or
                 others may be nested in it, an end tag closes what was left open
                 inside, one that closes nothing is ignored; a void or
                 self-closing element and raw text have no content.
Comments are no children; they and end tags end a text.  Character references are
decoded once in both and in ``href``: numeric ones, and the named ones below.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SITE_PATTERN = r"^(https?://[^/]+)"
# Named character references, elements without content, elements of raw text.
ENTITIES = {"amp": "&", "lt": "<", "gt": ">", "quot": '"', "apos": "'", "nbsp": "\u00a0"}
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
REFERENCE = r"^(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[a-zA-Z]+);"

_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
_ATTRIBUTE = re.compile(r"[\s/]*([^\s/>=]+)\s*")
_EQUALS, _UNQUOTED = re.compile(r"=\s*"), re.compile(r"[^\s>]*")
_TAG_END, _BETWEEN = re.compile(r"[\s/]*>"), re.compile(r"[\s/]*")
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])", re.IGNORECASE) for name in RAW}

TEXT, START, END, BREAK = range(4)


def _attributes(html: str, at: int) -> tuple[str | None, bool, int]:
    """(href, self-closing, place after the tag) of the tag whose name ends at
    ``at``; the place is -1 if the tag never ends."""
    href = None
    while True:
        end = _TAG_END.match(html, at)
        if end:
            return href, end.group().endswith("/>"), end.end()
        found = _ATTRIBUTE.match(html, at)
        if not found:  # a stray sign, or the end of the page
            at = _BETWEEN.match(html, at).end()  # type: ignore[union-attr]
            if at == len(html):
                return href, False, -1
            at += 1
            continue
        at, value = found.end(), None
        equals = _EQUALS.match(html, at)
        if equals:
            at = equals.end()
            quote = html[at:at + 1]
            if quote in ('"', "'"):
                stop = html.find(quote, at + 1)
                if stop < 0:
                    return href, False, -1
                value, at = html[at + 1:stop], stop + 1
            else:
                value = _UNQUOTED.match(html, at).group()  # type: ignore[union-attr]
                at += len(value)
        if href is None and found.group(1).lower() == "href":
            href = value


def tokens(html: str) -> Iterator[tuple[int, str, str | None, bool]]:
    """(kind, text or lower-case element name, href, has no content) in order."""
    at = 0
    while True:
        mark = html.find("<", at)
        if mark < 0:
            if at < len(html):
                yield TEXT, html[at:], None, False
            return
        found = _TAG.match(html, mark)
        follows = html[mark + 1:mark + 2]
        if not found and follows not in ("!", "?", "/"):
            yield TEXT, html[at:mark + 1], None, False
            at = mark + 1
            continue
        if mark > at:
            yield TEXT, html[at:mark], None, False
        if found:
            name = found.group(2).lower()
            href, closed, at = _attributes(html, found.end())
            if at < 0:
                return
            if found.group(1):
                yield END, name, None, False
                continue
            raw = name in RAW
            yield START, name, href, raw or closed or name in VOID
            if raw and not closed:
                end = _RAW_END[name].search(html, at)
                if not end:
                    return
                at = _attributes(html, end.end())[2]
                if at < 0:
                    return
            continue
        if html.startswith("<!--", mark):
            end = mark + 4 if html.startswith((">", "->"), mark + 4) else html.find("--", mark + 4)
            while end >= 0 and not html.startswith((">", "->"), end) and not html.startswith(("-->", "--!>"), end):
                end = html.find("--", end + 1)
            end = html.find(">", end) if end >= 0 else -1
        else:
            end = html.find(">", mark)
        yield BREAK, "", None, False
        if end < 0:
            return
        at = end + 1


class _Anchor:
    """The first two children of one open anchor, token by token."""

    FIRST, PAST, INSIDE, AFTER = range(4)

    def __init__(self, href: str):
        self.href, self.state, self.text, self.child1 = href, self.FIRST, "", ""
        self.open: list[str] = []
        self.names: Counter = Counter()  # of the open elements

    def _open(self, name: str) -> None:
        self.open.append(name)
        self.names[name] += 1

    def token(self, kind: int, value: str, empty: bool) -> None:
        if kind == TEXT:
            if self.state == self.FIRST:
                self.text += value
            elif self.state == self.AFTER:
                self.child1 += value
        elif self.state == self.INSIDE:
            if kind == START and not empty:
                self._open(value)
            elif kind == END and self.names[value]:
                while True:
                    name = self.open.pop()
                    self.names[name] -= 1
                    if name == value:
                        break
                if not self.open:
                    self.state = self.AFTER
        elif self.state == self.FIRST and not self.text:
            if kind == START:
                self.state = self.AFTER if empty else self.INSIDE
                if not empty:
                    self._open(value)
        elif kind == START or self.text or self.child1:
            self.state = self.PAST

    def row(self) -> tuple[str, str | None, str | None]:
        return self.href, self.text or None, self.child1 or None


def anchors_of(html: str) -> list[tuple[str, str | None, str | None]]:
    """(href, text, child1) of every anchor of a page, references not yet decoded."""
    out: list = []
    anchor = None
    for kind, value, href, empty in tokens(html):
        if value == "a" and kind in (START, END):
            if anchor is not None:
                out.append(anchor.row())
            anchor = _Anchor(href) if kind == START and href is not None else None
        elif anchor is not None:
            anchor.token(kind, value, empty)
    if anchor is not None:
        out.append(anchor.row())
    return out


def _resolved(part: Column) -> Column:
    """The text after an ampersand, its leading reference replaced if there is one."""
    name = F.regexp_extract(part, REFERENCE, 1)
    base16 = F.when(name.rlike("^#[xX]"), F.substring(name, 3, 6)).when(name.startswith("#"), F.conv(F.substring(name, 2, 7), 10, 16))
    code = F.conv(base16, 16, 10).cast("long")
    valid = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
    char = F.when(valid, F.decode(F.unhex(F.lpad(base16, 8, "0")), "UTF-32"))
    named = F.try_element_at(F.create_map(*[F.lit(x) for pair in ENTITIES.items() for x in pair]), F.when(name != "", name).otherwise("-"))
    found = F.coalesce(named, char)
    return F.when(found.isNotNull(), F.concat(found, F.substring(part, F.length(name) + 2, F.length(part)))).otherwise(F.concat(F.lit("&"), part))


def decoded(text: Column) -> Column:
    """``text`` with its character references replaced."""
    parts = F.split(text, "&", -1)
    rest = F.transform(F.slice(parts, F.lit(2), F.size(parts)), _resolved)
    return F.when(text.contains("&"), F.concat(F.get(parts, F.lit(0)), F.array_join(rest, ""))).otherwise(text)


def page_anchors(pages: DataFrame, html: str = "html", keep: list[str] | None = None) -> DataFrame:
    """(keep..., href, text, child1): the anchors of all pages; a null page has none."""
    keep = keep if keep is not None else ["page_id", "url"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, found = [], []
            for k, page in enumerate(batch.column(len(keep)).to_pylist()):
                rows = anchors_of(page) if page else []
                at += [k] * len(rows)
                found += rows
            taken = pa.array(at, pa.int64())
            cols = [batch.column(k).take(taken) for k in range(len(keep))]
            cols += [pa.array([r[k] for r in found], pa.string()) for k in range(3)]
            yield pa.RecordBatch.from_arrays(cols, names=[*[f"_k{k}" for k in range(len(keep))], "_href", "_text", "_child1"])

    kept = [F.col(c).alias(f"_k{k}") for k, c in enumerate(keep)]
    shape = ", ".join(f"_k{k} {pages.schema[c].dataType.simpleString()}" for k, c in enumerate(keep))
    found = pages.select(*kept, F.col(html).alias("_html")).mapInArrow(read, f"{shape + ', ' if keep else ''}_href string, _text string, _child1 string")
    return found.select(*[F.col(f"_k{k}").alias(c) for k, c in enumerate(keep)],
                        *[decoded(F.col(f"_{c}")).alias(c) for c in ("href", "text", "child1")])


def site_of(url) -> F.Column:
    return F.regexp_extract(url if not isinstance(url, str) else F.col(url), SITE_PATTERN, 1)
