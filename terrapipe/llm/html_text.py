"""Main text of web pages by wrappers inferred per host.

A page's token stream (tags and text slots, nested by its tags) is aligned
with the host's wrapper, a union-free regular expression, one per element: where
both agree a child stays; a text mismatch becomes a text slot; children that
repeat become a repeated group; children that only one side has become
optional (:func:`align`, :func:`fold`). Aligning a host's pages one after the
other gives the wrapper, together with what is known of each slot (how much
text, whether it ever differs).

What belongs to the article follows from the page, as far as the page says it,
so that a page's text does not depend on how many others its host has:

- navigation, headers, footers, asides, forms, scripts and the like never do,
  nor do blocks whose words name adverts, comments, consent, newsletters or
  related articles, inside the article too, whatever their text;
- blocks of other template words (notice, share, search, widget) do only if they
  hold most of the page's paragraph text;
- else all text below ``article`` or ``main`` does.

The wrapper decides where a page has neither: strings that never differ between
three or more distinct pages (copies count once) are the template's, unless
nothing else is left or they are headings or inline parts of the article, and
the article is the container with most of the page's text and of the wrapper's.

Nothing recurses or copies paths: an element is known by a hash of its path, so
time and memory are linear in the page, however deep or broken it is. A label
has the words of the class that look like a name; of longer ones (a slug, an
identifier) only the words listed here, so that labels repeat between pages.

Every task folds its pages into one wrapper per host before anything is
shuffled, and hosts are merged in two steps (salted, then whole), so that a
host with a third of all pages is no single task's work. To its pages a host
sends 16 bytes for each slot that several pages have.
"""

from __future__ import annotations

import bisect
import html
import json
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrapipe.llm.shared import pieces, staged

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe xmp".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp "
                   "small span strike strong sub sup time tt u var wbr".split())
#: An opening tag of the first kind ends an open element of the second.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
        "option": {"option"}, "thead": {"tr", "td", "th"}, "tbody": {"thead", "tr", "td", "th"}}
#: Where the search for an element to end stops.
SCOPE = frozenset("article aside body div footer header html main nav ol section table td th ul dl form blockquote".split())
TEMPLATE_TAGS = frozenset("head nav header footer aside form button select option input svg canvas object dialog menu "
                          "script style textarea title noscript template iframe xmp".split())
TEMPLATE_WORDS = frozenset("ad ads adv advert adverts advertisement advertising alert aside banner breadcrumb breadcrumbs comment "
                           "commentlist comments complementary consent contentinfo cookie cookiebar cookies copyright dialog footer "
                           "gdpr header login masthead menu modal nav navbar navigation newsletter notice notices pager pagination "
                           "paywall popup promo recommended related replies reply respond search share sharing sidebar signup social "
                           "sponsor sponsored subscribe toolbar topbar widget".split())
#: Words of a container around the article ("has-sidebar"), which its template words do not make a template.
LAYOUT_WORDS = frozenset("container has layout main no page site with without wrap wrapper".split())
#: Of these, what is never part of an article, however much text it has.
NEVER_WORDS = frozenset("ad ads adv advert adverts advertisement advertising comment commentlist comments consent cookie cookiebar cookies "
                        "copyright footer gdpr nav navbar navigation newsletter recommended related replies reply respond sidebar signup "
                        "sponsor sponsored subscribe".split())
ARTICLE_TAGS = frozenset(("article", "main"))
#: In a tag a quote opens a value only right behind the equals sign.
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?"
                   r"|<(/?)([A-Za-z][^\s/>]*)((?:(?>=\s*\"[^\"]*\"|=\s*'[^']*'|[^>]))*+)>|<", re.S)
ATTRIBUTE = re.compile(r"(?<![^\s\"'/])(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Parts of an article, in which the search for its container ends.
CONTENT = INLINE | HEADINGS | frozenset("p ul ol dl li dt dd table caption thead tbody tfoot tr td th pre blockquote figure figcaption "
                                        "hgroup details summary address math".split())
#: Words that a name in a class may have to count whole.
NAME_WORDS = 2
#: Distinct pages from which a slot with one text is the template's; so many marks are kept per slot.
CONSTANT_FROM = 3
#: Hosts a task folds before it hands them on.
HELD_HOSTS = 2000


def label(tag: str, attributes: str) -> str:
    """The tag with the words of its class, id and role, without digits: what may be equal between pages."""
    if not attributes or "=" not in attributes:
        return tag
    words: set[str] = set()
    for m in ATTRIBUTE.finditer(attributes):
        for name in (m[2] or m[3] or m[4] or "").lower().split():
            found = [w for w in re.split(r"[^a-z]+", name) if w]
            whole = len(found) <= NAME_WORDS and m[1].lower() == "class"
            words.update(found if whole else (w for w in found if w in TEMPLATE_WORDS or w in LAYOUT_WORDS))
    return ".".join([tag, *sorted(words)])


def stream(page: str) -> Iterator[tuple[str, str]]:
    """``(kind, value)``: ``open``/``void`` with a label, ``close`` with a tag, ``text`` with a decoded string.

    Comments, declarations and marked sections are dropped; a ``<`` that opens
    no tag is text; the content of raw elements is one text.
    """
    at, text, last = 0, [], page.rfind(">") + 1  # behind the last ">" only comments can be, and text
    while m := TOKEN.search(page, at, last) or (TOKEN.search(page, at) if page.find("<!", at) >= 0 else None):
        text.append(page[at:m.start()])
        at = m.end()
        if m[2] is None:
            if m[0] == "<":
                text.append("<")
            continue
        if any(text):
            yield "text", html.unescape("".join(text))
        text = []
        tag = m[2].lower()
        if m[1]:
            yield "close", tag
        elif tag in VOID:
            yield "void", label(tag, m[3])
        else:
            yield "open", label(tag, m[3])
            if tag in RAW:
                end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
                stop, after = (end.start(), end.end()) if end else (len(page), len(page))
                if stop > at:
                    yield "text", page[at:stop]
                yield "close", tag
                at = after
    text.append(page[at:])
    if any(text):
        yield "text", html.unescape("".join(text))


ROOT = 0


class Page:
    """A page as events over its paths: ``(kind, path, text)``, kinds ``in`` and ``out`` of an element, ``void`` and ``text``.

    Paths are numbered, parents before children; the lists have for each its
    parent, tag, label, hash, nearest block, whether it is below an article,
    whether it can have no text of the article, and the innermost block around
    it that only holds some if it holds most (:attr:`soft`). Missing end tags
    are supplied.
    """

    def __init__(self, page: str):
        self.parent, self.tag, self.label, self.key, self.block = [-1], [""], [""], [0], [ROOT]
        self.inside, self.never, self.unless, self.soft = [False], [False], [False], [-1]
        self.known: dict[tuple[int, str], int] = {}
        self.events: list[tuple[str, int, str]] = []
        self._read(page)

    def path(self, parent: int, text: str) -> int:
        """The number of the child path, made if new."""
        at = self.known.get((parent, text))
        if at is not None:
            return at
        at = self.known[parent, text] = len(self.parent)
        tag, *words = text.split(".")
        inside = self.inside[parent] or tag in ARTICLE_TAGS
        self.parent.append(parent)
        self.tag.append(tag)
        self.label.append(text)
        self.key.append(xxhash.xxh64_intdigest(text, seed=self.key[parent]) >> 1)
        self.block.append(self.block[parent] if tag in INLINE else at)
        self.inside.append(inside)
        never, unless, soft = self.never[parent], self.unless[parent], self.soft[parent]
        if tag in ARTICLE_TAGS:
            unless = False  # what lies around an article as its layout is no template
        elif tag in TEMPLATE_TAGS and not (inside and tag == "header"):
            never = True
        elif tag not in ("html", "body"):
            found = TEMPLATE_WORDS.intersection(words) - ({"header"} if inside else set())
            if found and not LAYOUT_WORDS.isdisjoint(words):
                unless = True
            elif found & NEVER_WORDS:
                never = True
            elif found:
                soft = at
        self.never.append(never)
        self.unless.append(unless)
        self.soft.append(soft)
        return at

    def _read(self, page: str) -> None:
        here, events = [ROOT], self.events
        tags: Counter[str] = Counter()
        inline: list[Counter[str]] = [Counter()]  # open inline elements since each open block

        def leave() -> None:
            at = here.pop()
            tag = self.tag[at]
            tags[tag] -= 1
            if tag in INLINE:
                inline[-1][tag] -= 1
            else:
                inline.pop()
            events.append(("out", at, ""))

        for kind, value in stream(page):
            if kind == "text":
                events.append(("text", here[-1], value))
                continue
            tag = value.split(".", 1)[0]
            if kind == "close":
                # an inline end tag does not end a block around it
                if inline[-1][tag] if tag in INLINE else tags[tag]:
                    while self.tag[here[-1]] != tag:
                        leave()
                    leave()
                continue
            ended = ENDS.get(tag, set()) | ({"p"} if tag not in INLINE else set())
            if any(tags[t] for t in ended):
                for n in range(len(here) - 1, 0, -1):
                    if self.tag[here[n]] in ended:
                        while len(here) > n:
                            leave()
                        break
                    if self.tag[here[n]] in SCOPE:
                        break
            at = self.path(here[-1], value)
            if kind == "void":
                events.append(("void", at, ""))
            else:
                here.append(at)
                tags[tag] += 1
                if tag in INLINE:
                    inline[-1][tag] += 1
                else:
                    inline.append(Counter())
                events.append(("in", at, ""))
        while len(here) > 1:
            leave()

    def open(self, at: int) -> bool:
        """Whether text of the path can be the article's, as far as the words around it say."""
        return not (self.never[at] or self.unless[at])

    def below(self, weight: dict[int, int]) -> list[int]:
        """For each path the weight of all paths below it, itself included."""
        out = [0] * len(self.parent)
        for at, n in weight.items():
            out[at] = n
        for at in range(len(out) - 1, 0, -1):
            out[self.parent[at]] += out[at]
        return out

    def slots(self) -> dict[int, int]:
        """The paths whose text may be the article's, with their characters."""
        sizes, shown = {}, {}
        for kind, at, text in self.events:
            if kind == "text" and self.open(at) and (n := len(" ".join(text.split()))):
                sizes[at] = sizes.get(at, 0) + n
                if self.tag[self.block[at]] == "p":
                    shown[at] = shown.get(at, 0) + n
        whole = self.below(shown or sizes)
        article = sum(n for at, n in (shown or sizes).items() if self.inside[at])
        kept: dict[int, bool] = {-1: True}
        for at in range(len(self.parent)):  # soft blocks from the outermost in
            if self.soft[at] == at:
                kept[at] = kept[self.soft[self.parent[at]]] and 2 * whole[at] > (article if self.inside[at] else whole[ROOT])
        return {at: n for at, n in sizes.items() if kept[self.soft[at]]}


# ---- wrappers ----------------------------------------------------------------------
# An item is [label, items, optional, repeated]; "#" is a text slot, "()" a group, the only one with items.

def _name(item: list) -> str:
    return "(" + " ".join(map(_name, item[1])) + ")" if item[0] == "()" else item[0]


def merge(a: list, b: list) -> list:
    return [a[0], [merge(x, y) for x, y in zip(a[1], b[1])], a[2] or b[2], a[3] or b[3]]


def _rising(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Places of equal names that rise in both: of the k-th with the k-th of each name, the longest such run."""
    places: dict[str, list[int]] = {}
    for y, name in enumerate(b):
        places.setdefault(name, []).append(y)
    seen: Counter[str] = Counter()
    ends, top, before = [], [], []
    pairs: list[tuple[int, int]] = []
    for x, name in enumerate(a):
        k = seen[name]
        seen[name] += 1
        if k < len(places.get(name, ())):
            y = places[name][k]
            at = bisect.bisect_left(ends, y)
            before.append(top[at - 1] if at else -1)
            ends[at:at + 1], top[at:at + 1] = [y], [len(pairs)]
            pairs.append((x, y))
    run, at = [], top[-1] if top else -1
    while at >= 0:
        run.append(pairs[at])
        at = before[at]
    return run[::-1]


def align(a: list, b: list) -> list:
    """The union-free expression of two sequences: common items merged, others optional, repeats folded."""
    if a == b:
        return a
    out: list = []
    x = y = 0
    for to_x, to_y in [*_rising([_name(i) for i in a], [_name(i) for i in b]), (len(a), len(b))]:
        out += [[*item[:2], True, item[3]] for item in (*a[x:to_x], *b[y:to_y])]
        if to_x < len(a):
            out.append(merge(a[to_x], b[to_y]))
        x, y = to_x + 1, to_y + 1
    return fold(out)


def fold(items: list) -> list:
    """Fold neighbours that repeat: equal items, then pairs and triples, into repeated groups."""
    out: list = []
    for item in items:
        if out and item[0] != "()" and out[-1][0] == item[0]:
            both = merge(out[-1], item)
            out[-1] = [both[0], both[1], out[-1][2] and item[2], True]
        else:
            out.append(item)
        for size in (2, 3):
            last, before = out[-size:], out[-2 * size:-size]
            if len(before) == size and [_name(x) for x in last] == [_name(x) for x in before] and not any(x[0] == "()" for x in last):
                out[-2 * size:] = [["()", [merge(x, y) for x, y in zip(before, last, strict=True)], False, True]]
                break
            if len(out) > size and out[-size - 1][0] == "()" and [_name(x) for x in out[-size - 1][1]] == [_name(x) for x in last]:
                out[-size - 1:] = [["()", [merge(x, y) for x, y in zip(out[-size - 1][1], last, strict=True)], out[-size - 1][2], True]]
                break
    return out


def expression(items: dict[str, list], key: int = 0) -> str:
    """The wrapper as text, to be read: ``?`` optional, ``+`` repeated, ``*`` both."""
    def show(item: list) -> str:
        mark = "*" if item[2] and item[3] else "?" if item[2] else "+" if item[3] else ""
        if item[0] == "()":
            return f"({' '.join(map(show, item[1]))}){mark}"
        inner = "" if item[0] == "#" else expression(items, xxhash.xxh64_intdigest(item[0], seed=key) >> 1)
        return (f"{item[0]}[{inner}]" if inner else item[0]) + mark

    return " ".join(map(show, items.get(str(key), [])))


def observe(page: Page) -> tuple[dict[str, list], dict[str, list]]:
    """Per element (the hash of its path) the page's own expression, and per slot ``[pages' marks, least, greatest hash of its text, characters]``.

    A page's mark hashes its texts outside templates, so copies have one mark.
    """
    items: dict[str, list] = {}
    levels: list[list] = [[]]

    def done(at: int) -> None:
        own, key = fold(levels.pop()), str(page.key[at])
        items[key] = align(items[key], own) if key in items else own

    texts: dict[int, list[str]] = {}
    for kind, at, text in page.events:
        if kind == "in":
            levels[-1].append([page.label[at], [], False, False])
            levels.append([])
        elif kind == "out":
            done(at)
        elif kind == "void":
            levels[-1].append([page.label[at], [], False, False])
        elif text.strip():
            levels[-1].append(["#", [], False, False])
            if page.open(at):
                texts.setdefault(at, []).append(" ".join(text.split()))
    done(ROOT)
    slots, whole = {}, xxhash.xxh64()
    for at, found in texts.items():
        text = "\n".join(found)
        mark = xxhash.xxh64_intdigest(text) >> 1
        slots[str(page.key[at])] = [[], mark, mark, sum(map(len, found))]
        whole.update(f"{page.key[at]}\0{text}\0")
    for slot in slots.values():
        slot[0].append(whole.intdigest() >> 1)
    return items, slots


class Wrapper:
    def __init__(self):
        self.items: dict[str, list] = {}
        self.slots: dict[str, list] = {}

    def add(self, items: dict[str, list], slots: dict[str, list]) -> None:
        for key, own in items.items():
            known = self.items.get(key)
            self.items[key] = own if known is None else align(known, own)
        for key, (marks, low, high, size) in slots.items():
            known = self.slots.get(key)
            self.slots[key] = [marks, low, high, size] if known is None else [
                sorted({*known[0], *marks})[:CONSTANT_FROM], min(known[1], low), max(known[2], high), known[3] + size]

    def dump(self) -> str:
        return json.dumps([self.items, self.slots])

    def evidence(self) -> bytes:
        """What the host tells its pages: of each slot of several pages its hash and its characters, negative if its text never differs."""
        found = [(int(key), -size if len(marks) >= CONSTANT_FROM and low == high else size)
                 for key, (marks, low, high, size) in self.slots.items() if len(marks) > 1]
        return np.array(sorted(found), "<i8").tobytes()


def read_evidence(data: bytes | None) -> dict[int, int]:
    return dict(np.frombuffer(data or b"", "<i8").reshape(-1, 2).tolist())


def with_constants(page: Page, kept: set[int], constant: set[int]) -> set[int]:
    """``kept`` and the constant slots that belong to it: inline ones of a kept block, headings beside a kept slot."""
    blocks = {page.block[at] for at in kept}
    around: set[int] = set()
    for at in blocks:
        at = page.parent[at]
        while at >= 0 and at not in around:
            around.add(at)
            at = page.parent[at]
    return kept | {at for at in constant if (b := page.block[at]) in blocks or (page.tag[b] in HEADINGS and page.parent[b] in around)}


def region(page: Page, own: dict[int, int], mass: dict[int, int]) -> int:
    """The path of the container that holds the article of a page without an article element; ``own``: its slots' characters.

    The region narrows to a container only if that holds most of this page's
    text and most of what all pages have in this page's slots, so a page of
    another layout keeps its own. Blocks of content are never a region.
    """
    weights = [page.below(own), page.below(mass)]
    need = [0.6 * w[ROOT] for w in weights]
    at = ROOT
    for child in range(1, len(page.parent)):  # parents before children; two children cannot have 60 % each
        if page.parent[child] == at and page.tag[child] not in CONTENT and all(w[child] >= n for w, n in zip(weights, need)):
            at = child
    return at


def main_text(page: Page, evidence: dict[int, int]) -> str:
    """The page's article: the slots below its article element or, where there is none, its region of the others, constant ones if no other has text."""
    slots = page.slots()
    if inside := {at for at in slots if page.inside[at]}:
        return kept_text(page, inside)
    own = {at: n for at, n in slots.items() if evidence.get(page.key[at], n) > 0}
    if not own:
        return kept_text(page, set(slots))
    top = region(page, own, {at: evidence.get(page.key[at], n) for at, n in own.items()})
    under = [False] * len(page.parent)
    for at in range(top, len(under)):
        under[at] = at == top or (at > 0 and under[page.parent[at]])
    return kept_text(page, with_constants(page, {at for at in own if under[at]}, {at for at in slots if at not in own and under[at]}))


def kept_text(page: Page, keep: set[int]) -> str:
    """The blocks of the kept slots, in page order, joined by an empty line."""
    if not keep:
        return ""
    blocks: list[str] = []
    held: list[str] = []

    def close() -> None:
        block = " ".join("".join(held).split())
        held.clear()
        if block:
            blocks.append(block)

    for kind, at, text in page.events:
        if kind == "text":
            if at in keep:
                held.append(text)
            elif not text.strip():
                held.append(" ")
        elif page.tag[at] not in INLINE:
            close()
        elif page.tag[at] == "br":
            held.append(" ")
    close()
    return "\n\n".join(blocks)


# ---- Spark ---------------------------------------------------------------------------

def infer(pages: DataFrame) -> DataFrame:
    """``host, wrapper, evidence``: one wrapper per host of ``host, html``, and what it tells the host's pages."""
    out = pa.schema([("host", pa.string()), ("salt", pa.int32()), ("wrapper", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salt, held = TaskContext.get().partitionId() % 64, {}

        def emit() -> pa.RecordBatch:
            batch = pa.record_batch([list(held), [salt] * len(held), [w.dump() for w in held.values()]], schema=out)
            held.clear()
            return batch

        for batch in pieces(batches, "html"):
            for host, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                held.setdefault(host, Wrapper()).add(*observe(Page(page or "")))
            if len(held) >= HELD_HOSTS:
                yield emit()
        if held:
            yield emit()

    def joined(rows: pd.DataFrame) -> Wrapper:
        whole = Wrapper()
        for text in sorted(rows["wrapper"]):
            whole.add(*json.loads(text))
        return whole

    def together(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"host": rows["host"].iloc[:1], "salt": rows["salt"].iloc[:1], "wrapper": [joined(rows).dump()]})

    def whole(rows: pd.DataFrame) -> pd.DataFrame:
        wrapper = joined(rows)
        return pd.DataFrame({"host": rows["host"].iloc[:1], "wrapper": [wrapper.dump()], "evidence": [wrapper.evidence()]})

    shape = "host string, salt int, wrapper string"
    folded = pages.select("host", "html").mapInArrow(run, shape).groupBy("host", "salt").applyInPandas(together, shape)
    return folded.groupBy("host").applyInPandas(whole, "host string, wrapper string, evidence binary")


def extract(pages: DataFrame, url_column: str = "url", html_column: str = "html", id_column: str = "page_id") -> DataFrame:
    """``page_id, url, text, n_chars`` per row.

    Null html: no text. Null urls and urls without a host share one wrapper.
    Repeated rows stay, null ids too; other columns are not read. The wrappers
    are staged, so Spark sees their size and broadcasts them only if small;
    otherwise a sort-merge join, whose hot hosts adaptive execution splits.
    """
    host = F.lower(F.regexp_extract(F.coalesce(F.col(url_column), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    source = pages.select(F.col(id_column).cast("long").alias("page_id"), F.col(url_column).alias("url"), F.col(html_column).alias("html"), host.alias("host"))
    wrappers = staged(infer(source), "html-wrappers").select("host", "evidence")
    out = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, dict[int, int]] = {}
        for batch in pieces(batches, "html"):
            texts = []
            for host, evidence, page in zip(*(batch.column(c) for c in ("host", "evidence", "html")), strict=True):
                if (host := host.as_py()) not in known:
                    if len(known) >= HELD_HOSTS:
                        known.clear()
                    known[host] = read_evidence(evidence.as_py())
                page = page.as_py()
                texts.append(main_text(Page(page), known[host]) if page else "")
            yield pa.record_batch([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                                   pa.array([len(t) for t in texts], pa.int64())], schema=out)

    return source.join(wrappers, "host").mapInArrow(run, "page_id long, url string, text string, n_chars long")
