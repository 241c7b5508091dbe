"""Main text of web pages by two-pass block rules."""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

# --- fixed values -------------------------------------------------------------------------

STOP_WORDS = frozenset("""
the of and to in a is that for it on was with be as are by this at from or an have not but had his they which she he you we were
been has their one all there can if more when will would who so no out up into than them its our my your these some do
der die das und in zu den mit von ist des sich nicht ein eine als auch es an er hat aus bei sind dem war wie nach im auf für wird
einer um am noch oder haben nur werden bis durch man sein über kann ich sie wir aber dass einen vor
le la les de des du et en un une que qui dans pour par sur au aux avec ne pas est sont ce cette il elle on nous vous plus se son sa
ses mais ou où comme été être leur leurs ont cela même
el los las del y un una que es por con para su se lo al como más pero sus le ya o este sí porque esta entre cuando muy sin sobre ser
son también me hasta hay donde quien desde todo nos era fue ha no
""".split())

BLOCK_TAGS = frozenset("""
address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset
h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section select summary table tbody td
tfoot th thead tr ul
""".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Contents that are no text: skipped up to the end tag.
RAW_TAGS = frozenset("script style title textarea xmp iframe noembed noframes".split())
HIDDEN_TAGS = frozenset("head noscript template svg math canvas object audio video map button select datalist dialog".split())
AROUND_TAGS = frozenset("nav footer aside menu search fieldset".split())
# What a form is filled in with; a form is article text from so many characters per control on.
CONTROL_TAGS = frozenset("input select textarea button".split())
FORM_TEXT = 300
MAIN_TAGS = frozenset("article main".split())
AROUND_ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alert alertdialog toolbar".split())
AROUND_NAMES = frozenset("""
ad ads adv advert adverts advertisement advertisements advertising sponsor sponsors sponsored promo promos promotion banner banners
sidebar sidebars menu menus nav navbar navigation breadcrumb breadcrumbs footer cookie cookies consent gdpr notice notices popup popups
modal overlay newsletter subscribe subscription signup login comment comments respond replies discussion disqus share sharing social
related recommended recommendations widget widgets toolbar pagination pager masthead alert disclaimer copyright teaser search form
""".split())
CONTENT_NAMES = frozenset("content article main post entry story text body page wrapper container layout".split())
LOOSE_NAMES = frozenset("has with no without is".split())

HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())

# Thresholds of the first pass.
SHORT, LONG = 70, 200
STOP_LOW, STOP_HIGH = 0.20, 0.30
LINKS_MOST = 0.5

_TAG = re.compile(r"</?([A-Za-z][^\s/>]*)")
_STOP = re.compile("[>\"']")
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
_HIDDEN_TYPE = re.compile(r"""type\s*=\s*["']?hidden""", re.I)
_WORD_EDGE = re.compile(r"^\W+|\W+$")


@dataclass
class Block:
    text: str
    linked: int
    shared: int  # enclosing block elements it has in common with the block before it
    main: int
    form: int
    around: bool
    tag: str
    label: str = ""


def _attributes(tag: str, name_end: int) -> dict[str, str]:
    out: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(tag, name_end):
        out.setdefault(m[1].lower(), unescape((m[2] or "").strip("\"'")))
    return out


def _around(name: str, tag: str, name_end: int) -> bool:
    """The element holds no article text: by its tag, role, visibility, or class and id names."""
    if name in AROUND_TAGS or name in HIDDEN_TAGS:
        return True
    if "=" not in tag and " hidden" not in tag or name in ("html", "body"):
        return False
    attrs = _attributes(tag, name_end)
    if "hidden" in attrs or attrs.get("aria-hidden") == "true" or attrs.get("role", "").lower() in AROUND_ROLES:
        return True
    if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", attrs.get("style", "")):
        return True
    if name == "main":
        return False
    for whole in (*attrs.get("class", "").split(), attrs.get("id", "")):
        parts = [p.lower() for p in _NAME_PARTS.findall(whole)]
        if not parts or LOOSE_NAMES.intersection(parts):
            continue
        if parts[-1] in AROUND_NAMES or (parts[0] in AROUND_NAMES and parts[-1] not in CONTENT_NAMES):
            return True
    return False


def blocks(html: str) -> list[Block]:
    """Text blocks of a page in page order, however broken its markup is.

    A block ends where a block element starts or ends, or at two line breaks in a row. Comments,
    declarations, scripts, styles and a tag cut off at the end of the page are no text. Reads
    the page once.
    """
    out: list[Block] = []
    stack: list[tuple[str, bool, bool, int, int]] = []  # name, around, header, main and form before
    held: list[str] = []  # open block elements
    controls: dict[int, int] = {}  # of every form
    open_tags: dict[str, int] = {}
    pieces: list[str] = []
    state = {"around": 0, "header": 0, "links": 0, "linked": 0, "main": 0, "number": 0, "heading": 0, "form": 0, "low": 0}
    quotes = {'"': True, "'": True}
    breaks = 0

    def flush() -> None:
        text = " ".join("".join(pieces).split())
        pieces.clear()
        if text:
            around = state["around"] > 0 or (state["header"] > 0 and not (state["main"] and state["heading"]))
            out.append(Block(text, state["linked"], state["low"], state["main"], state["form"], around, held[-1] if held else ""))
            state["low"] = len(held)
        state["linked"] = 0

    def pop() -> None:
        name, around, header, main, form = stack.pop()
        open_tags[name] -= 1
        if name in BLOCK_TAGS:
            held.pop()
            state["low"] = min(state["low"], len(held))
        state["around"] -= around
        state["header"] -= header
        state["links"] -= name == "a"
        state["heading"] -= name in HEADINGS
        state["main"], state["form"] = main, form

    def close(name: str) -> None:
        if open_tags.get(name):
            while stack[-1][0] != name:
                pop()
            pop()

    def add(text: str) -> None:
        nonlocal breaks
        if not text:
            return
        text = unescape(text) if "&" in text else text
        if not text.isspace():
            breaks = 0
        pieces.append(text)
        if state["links"]:
            state["linked"] += len(text.strip())

    pos, size = 0, len(html)
    while pos < size:
        i = html.find("<", pos)
        if i < 0:
            add(html[pos:])
            break
        add(html[pos:i])
        if html.startswith("<!--", i):
            end = html.find("-->", i + 4)
            if end < 0:
                break
            pos = end + 3
            continue
        m = _TAG.match(html, i)
        if m is None:
            if html[i + 1:i + 2] in ("!", "?", "/"):
                end = html.find(">", i)
                if end < 0:
                    break
                pos = end + 1
            else:
                add("<")
                pos = i + 1
            continue
        # The tag ends at the first > outside quotes; a quote without its partner is none.
        at = m.end()
        while True:
            stop = _STOP.search(html, at)
            if stop is None or stop[0] == ">":
                break
            at = stop.end()
            if quotes[stop[0]] and html[stop.start() - 1] in "= \t\r\n":
                partner = html.find(stop[0], at)
                if partner < 0:
                    quotes[stop[0]] = False
                else:
                    at = partner + 1
        if stop is None:
            break
        tag, pos, name = html[i:stop.start()], stop.end(), m[1].lower()
        if name == "br":
            breaks += 1
            pieces.append(" ")
            if breaks >= 2:
                flush()
            continue
        block = name in BLOCK_TAGS
        if block:
            flush()
            breaks = 0
        if tag[1] == "/":
            close(name)
            continue
        if name in CONTROL_TAGS and state["form"] and not _HIDDEN_TYPE.search(tag):
            controls[state["form"]] += 1
        if name in RAW_TAGS:
            end = re.compile(f"</{re.escape(name)}", re.I).search(html, pos)
            if end is None:
                break
            pos = end.start()
            closing = html.find(">", pos)
            if closing < 0:
                break
            pos = closing + 1
            continue
        if name in VOID_TAGS:
            continue
        if block and open_tags.get("p"):
            close("p")
        if name in ("li", "dt", "dd", "tr", "td", "th", "option") and stack and stack[-1][0] == name:
            pop()
        if name == "body":
            while open_tags.get("head"):
                pop()
        if tag.endswith("/") and not block:
            continue
        around = _around(name, tag, m.end() - i)
        state["number"] += 1
        stack.append((name, around, name == "header", state["main"], state["form"]))
        if block:
            held.append(name)
        if name == "form":
            state["form"] = state["number"]
            controls[state["form"]] = 0
        open_tags[name] = open_tags.get(name, 0) + 1
        state["around"] += around
        state["header"] += name == "header"
        state["links"] += name == "a"
        state["heading"] += name in HEADINGS
        if name in MAIN_TAGS or name == "div" and 'role="main"' in tag:
            state["main"] = state["main"] or state["number"]
    flush()
    # A form is judged by what it holds itself: fields with labels, or a page wrapped in a form.
    written = dict.fromkeys(controls, 0)
    for b in out:
        if b.form:
            written[b.form] += len(b.text) - min(b.linked, len(b.text))
    for b in out:
        b.around = b.around or b.form > 0 and written[b.form] < FORM_TEXT * max(1, controls[b.form])
    return out


def classify(found: list[Block], stop_words: frozenset[str] = STOP_WORDS) -> None:
    """Set ``label`` of every block to ``good`` or ``bad``.

    First pass, by the block alone: surroundings and blocks of links are bad; long blocks with
    many stop words are good; short ones, and those with few stop words inside an article, are
    open. On a page whose language has none of the stop words, length alone decides among blocks
    without links. Second pass: an open block takes the label of the nearest decided block before or after
    it: the one sharing more enclosing blocks, then of the same kind of element, then (for a
    heading) the one that follows, then the one fewer blocks away, then the bad one. Inside an article only its own blocks count, and without any the block is good.
    """
    density = []
    for b in found:
        words = [_WORD_EDGE.sub("", w).lower() for w in b.text.split()]
        density.append(sum(w in stop_words for w in words) / len(words))
    # Where no block of text has enough stop words, they are of other languages than the page.
    foreign = all(stops < STOP_LOW for b, stops in zip(found, density, strict=True) if not b.around and len(b.text) >= SHORT)
    for b, stops in zip(found, density, strict=True):
        if b.around:
            b.label = "bad"
        elif b.linked > LINKS_MOST * len(b.text):
            b.label = "bad"
        elif len(b.text) < SHORT:
            b.label = ""
        elif foreign and not b.main:
            b.label = "good" if len(b.text) > LONG else ""
        elif stops >= STOP_HIGH or len(b.text) > LONG and stops >= STOP_LOW:
            b.label = "good"
        elif stops >= STOP_LOW or b.main:
            b.label = ""
        else:
            b.label = "bad"
    # Nearest decided block on either side, and how many enclosing elements are shared with it: as
    # many as all blocks up to it share with the one before them.
    sides: list[list[tuple[int, int]]] = [[], []]
    for out, order in zip(sides, (range(len(found)), range(len(found) - 1, -1, -1)), strict=True):
        decided, common, step = -1, 0, order.step
        for i in order:
            if decided >= 0:
                common = min(common, found[max(i, i - step)].shared)
            out.append((decided, common))
            if found[i].label:
                decided, common = i, sys.maxsize
    before, after = sides[0], sides[1][::-1]
    labels = []
    for i, b in enumerate(found):
        if b.label:
            labels.append(b.label)
            continue
        best = None
        for j, common in (before[i], after[i]):
            if j < 0 or b.main and (found[j].main != b.main or found[j].around):
                continue
            rank = (-common, b.tag != found[j].tag, b.tag in HEADINGS and j < i, abs(i - j), found[j].label)
            if best is None or rank < best:
                best = rank
        labels.append(best[-1] if best else "good")
    for b, label in zip(found, labels, strict=True):
        b.label = label
    # With an article on the page, text elsewhere is not part of it.
    if any(b.main and b.label == "good" for b in found):
        for b in found:
            if not b.main:
                b.label = "bad"


def main_text(html: str | None, stop_words: frozenset[str] = STOP_WORDS) -> str:
    found = blocks(html or "")
    classify(found, stop_words)
    return "\n".join(b.text for b in found if b.label == "good")


def extract(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
    stop_words: frozenset[str] = STOP_WORDS,
) -> DataFrame:
    """``id_col, url_col, text``: main text of every page, blocks joined by a newline.

    NULL or empty pages give an empty text; every row is kept, repeated ids included; other
    columns are dropped. Rows are independent, nothing is shuffled.
    """
    types = {c: pages.schema[c].dataType.simpleString() for c in (id_col, url_col)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                part = batch.slice(i, 500)
                texts = [main_text(h, stop_words) for h in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string())],
                                                 [id_col, url_col, "text"])

    schema = f"`{id_col}` {types[id_col]}, `{url_col}` {types[url_col]}, text string"
    return pages.select(id_col, url_col, html_col).mapInArrow(run, schema)
