"""Main text of web pages: boosted trees over DOM nodes, decoded along the hierarchy.

A page is parsed into its block elements; inline markup belongs to the block around it. Every block gets features: its
tag and the kinds of its class, id and role words, the same of its ancestors, text, link and tag density of its subtree,
depth, and how it compares with its siblings. Boosted trees give the probability that a block holds main text. The labels
of a page are then chosen together: a block that is dropped drops all below it, and a block is kept only below kept ones, so
of all consistent labellings the most probable one is taken, in one pass from the leaves and one from the root.

The trees are fitted on at most ``training_pages`` pages (chosen by hash of the address). Their own markup says what is main
text (``article``, ``main``) and what is not; to learn more than one site's habits, the same text blocks are also laid out
in other page designs, with menus, sidebars, notices, adverts, forms and comments around them.

Defined results: null, empty or text-free html gives the empty text; broken markup is closed where HTML closes it, and
an element without main text (a button, a drawing) that is never closed ends at the next block;
repeated rows give a row each; without training pages everything is kept but scripts, styles and the like. Only
page_id, url and html are read; pages are parsed where they lie, nothing is shuffled.
"""

from __future__ import annotations

import random
import re
import zlib
from bisect import bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import partial
from html import escape, unescape
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.boosted import BoostedTrees
from tallyhouse.llm.common import drawn, read
from tallyhouse.llm.words import slices

TRAINING_PAGES = 300
DESIGNS = 4
LONGEST_TRAINED = 200_000

# Element names of HTML.
BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption
figure footer form h1 h2 h3 h4 h5 h6 header hgroup html legend li main menu nav ol p pre search section summary table tbody td
tfoot th thead tr ul""".split())
SILENT = frozenset("""script style noscript template head title iframe object svg math canvas audio video select datalist textarea
button option applet frameset noframes""".split())
RAW = frozenset("script style title textarea iframe noframes".split())  # text up to their own end tag
SCOPES = frozenset("applet object template svg math select".split())  # an end tag inside does not reach out of them
IN_HEAD = frozenset("html head base basefont bgsound link meta title noscript noframes style script template".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSES_ITSELF = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table", "tbody", "thead", "tfoot"),
                 "td": ("tr",), "th": ("tr",)}

# Words of class, id and role attributes, by what they say about a block.
KINDS = {
    "main": "article post entry content story main text prose blogpost articlebody body copytext",
    "menu": "nav menu navbar navigation breadcrumb breadcrumbs pagination pager toc tabs skip",
    "head": "header masthead banner topbar logo branding hero",
    "foot": "footer copyright legal colophon imprint bottom",
    "side": "sidebar side widget rail aside related recommended recommend trending popular tags more",
    "advert": "ad ads advert advertisement adbox adslot sponsor sponsored promo promotion dfp",
    "notice": "cookie cookies consent gdpr notice alert modal popup overlay newsletter subscribe signup paywall toast",
    "comment": "comment comments reply replies disqus discussion respond thread feedback",
    "form": "form search login register contact input",
    "share": "share sharing social follow buttons",
}
_KIND_OF = {word: kind for kind, words in KINDS.items() for word in words.split()}
_KIND_NAMES = list(KINDS)
_TAGS = ["article", "main", "section", "div", "nav", "header", "footer", "aside", "form", "list", "p", "heading", "table", "body"]
_TAG_OF = {**{t: t for t in _TAGS}, "ul": "list", "ol": "list", "li": "list", "dl": "list", "menu": "list", "search": "form",
           **{f"h{i}": "heading" for i in range(1, 7)}, "td": "table", "tr": "table", "html": "body", "fieldset": "form",
           "blockquote": "p", "pre": "p", "figure": "div"}
_SPLIT = re.compile(r"[^A-Za-z]+|(?<=[a-z])(?=[A-Z])")


class Block:
    __slots__ = ("tag", "kinds", "parent", "children", "texts", "links", "tags", "end")

    def __init__(self, tag: str, kinds: set, parent: int):
        self.tag, self.kinds, self.parent = tag, kinds, parent
        self.children: list[int] = []
        self.texts: list[tuple[int, str]] = []  # (place in the page, a run of text without a block inside)
        self.links = self.tags = 0
        self.end = 0


def _silent_ends(events: list[tuple[str, str, list]]) -> dict[int, int]:
    """For each start of a SILENT element that is closed, the event that closes it.

    An end tag of an enclosing block closes what is open inside it, which then has no end of its own.
    """
    own: dict[str, list[int]] = defaultdict(list)
    for i, (kind, tag, _) in enumerate(events):
        if kind == "end" and tag in RAW:
            own[tag].append(i)
    ends: dict[int, int] = {}
    stack: list[tuple[str, int]] = []
    blocks, silent = [Counter()], Counter()  # open blocks by scope, and open SILENT elements

    def pop() -> tuple[str, int]:
        name, at = stack.pop()
        if name in BLOCKS:
            blocks[-1][name] -= 1
        else:
            silent[name] -= 1
            if name in SCOPES:
                blocks.pop()
        return name, at

    skip = -1
    for i, (kind, tag, _) in enumerate(events):
        if i <= skip or kind == "data" or tag == "head":
            continue
        if kind == "start" and tag in RAW:
            after = bisect_right(own[tag], i)
            if after < len(own[tag]):
                ends[i] = skip = own[tag][after]
        elif kind == "start" and tag in SILENT:
            stack.append((tag, i))
            silent[tag] += 1
            if tag in SCOPES:
                blocks.append(Counter())
        elif kind == "start" and tag in BLOCKS:
            stack.append((tag, i))
            blocks[-1][tag] += 1
        elif kind == "end" and silent[tag] > 0:
            while (top := pop())[0] != tag:
                pass
            ends[top[1]] = i
        elif kind == "end" and tag in BLOCKS and blocks[-1][tag] > 0:
            while pop()[0] != tag:
                pass
    return ends


def _closed_part(html: str) -> tuple[str, str]:
    """The page up to its last ``>``, and what follows, which can hold no whole tag and is text.

    A comment that is never closed is text as well. The parser would look for these ends again from every place that opens one.
    """
    last = html.rfind(">") + 1
    closed, rest = html[:last], html[last:]
    unclosed = closed.find("<!--", closed.rfind("-->") + 1)
    if unclosed >= 0:
        closed = closed[:unclosed] + closed[unclosed:].replace("<!--", "&lt;!--")
    return closed, rest


class Tree(HTMLParser):
    """The block elements of a page in page order, the page itself first."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.blocks = [Block("body", set(), -1)]
        self.stack: list[tuple[str, int]] = [("", 0)]  # open elements, with the block that each belongs to
        self.open = Counter()  # how many of each are in the stack
        self.inside_link = 0
        self.run: list[str] = []
        self.place = 0
        self.events: list[tuple[str, str, list]] = []  # (start, end or data; tag or text; attributes)
        closed, rest = _closed_part(html)
        self.feed(closed)
        self.close()
        if rest:
            self.events.append(("data", unescape(rest), []))
        self._build()
        self.flush()

    def handle_starttag(self, tag: str, attrs: list) -> None:
        self.events.append(("start", tag, attrs))

    def handle_endtag(self, tag: str) -> None:
        self.events.append(("end", tag, []))

    def handle_data(self, data: str) -> None:
        self.events.append(("data", data, []))

    def _build(self) -> None:
        """Blocks from the events, without SILENT elements. One that is never closed ends where the next block starts or ends,
        ``head`` at the first thing that cannot stand in it."""
        events, ends, in_head, i = self.events, _silent_ends(self.events), False, 0
        while i < len(events):
            kind, name, attrs = events[i]
            if in_head:
                if kind == "end" and name == "head":
                    in_head = False
                elif kind == "end":
                    in_head = name not in ("body", "html", "br")
                else:
                    in_head = name in IN_HEAD if kind == "start" else not name.strip()
            if kind == "start" and name == "head":
                in_head = True
            elif kind == "start" and name in SILENT:
                if i in ends:
                    i = ends[i]
                else:
                    while i + 1 < len(events) and not self._ends_silence(name, *events[i + 1][:2]):
                        i = ends.get(i + 1, i + 1)
            elif not in_head and kind == "start":
                self._start(name, attrs)
            elif not in_head and kind == "end" and name not in SILENT:
                self._end(name)
            elif not in_head and kind == "data":
                self._text(name)
            i += 1
        self.events = []

    @staticmethod
    def _ends_silence(silent: str, kind: str, tag: str) -> bool:
        """Whether this ends a SILENT element that is never closed."""
        return kind != "data" and (tag in BLOCKS or silent == "title" and kind == "start")

    def flush(self) -> None:
        text = " ".join("".join(self.run).split())
        self.run = []
        if text:
            self.blocks[self.stack[-1][1]].texts.append((self.place, text))
            self.place += 1

    def _close_to(self, depth: int) -> None:
        self.flush()
        while len(self.stack) > depth:
            tag = self.stack.pop()[0]
            self.open[tag] -= 1
            if tag == "a":
                self.inside_link = max(0, self.inside_link - 1)

    def _push(self, tag: str, block: int) -> None:
        self.stack.append((tag, block))
        self.open[tag] += 1

    def _start(self, tag: str, attrs: list) -> None:
        if tag in VOID:
            if tag in ("br", "hr", "img", "input"):
                self.run.append(" ")
            self.blocks[self.stack[-1][1]].tags += 1
            return
        if tag in BLOCKS:
            self._open_block(tag, attrs)
            return
        self.blocks[self.stack[-1][1]].tags += 1
        self.inside_link += tag == "a"
        self._push(tag, self.stack[-1][1])

    def _open_block(self, tag: str, attrs: list) -> None:
        self.flush()
        owners = CLOSES_ITSELF.get(tag, ())
        ended = {"p", *(("dt", "dd") if tag in ("dt", "dd") else ("td", "th") if tag in ("td", "th") else (tag,) if owners else ())}
        # A block ends the paragraph that is open; an item ends the item before it. Nothing is looked for that is not open.
        if any(self.open[name] for name in ended):
            for depth in range(len(self.stack) - 1, 0, -1):
                name = self.stack[depth][0]
                if name in ended:
                    self._close_to(depth)
                    break
                if name in owners or name in BLOCKS and tag not in CLOSES_ITSELF:
                    break
        if tag in ("html", "body"):
            self._push(tag, self.stack[-1][1])
            return
        words = set()
        for name, value in attrs:
            if name in ("class", "id", "role", "itemprop", "aria-label") and value:
                words.update(w.lower() for w in _SPLIT.split(value) if w)
        parent = self.stack[-1][1]
        self.blocks.append(Block(tag, {_KIND_OF[w] for w in words if w in _KIND_OF}, parent))
        self.blocks[parent].children.append(len(self.blocks) - 1)
        self._push(tag, len(self.blocks) - 1)

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def _end(self, tag: str) -> None:
        if not self.open[tag]:
            return
        for depth in range(len(self.stack) - 1, 0, -1):
            name = self.stack[depth][0]
            if name == tag:
                if tag in BLOCKS:
                    self._close_to(depth)
                else:
                    self.inside_link -= tag == "a" and self.inside_link > 0
                    del self.stack[depth]
                    self.open[tag] -= 1
                return
            if name in BLOCKS and tag not in BLOCKS:
                return  # an inline end tag does not reach out of its block

    def _text(self, data: str) -> None:
        self.run.append(data)
        if self.inside_link:
            self.blocks[self.stack[-1][1]].links += len(data)


def features(blocks: list[Block]) -> np.ndarray:
    """One row per block: subtree, attribute, depth and sibling statistics."""
    n = len(blocks)
    own = np.array([sum(len(t) for _, t in b.texts) for b in blocks], float)
    parent = np.array([b.parent for b in blocks])
    total = {"chars": own.copy(), "links": np.array([b.links for b in blocks], float), "tags": np.array([b.tags for b in blocks], float),
             "words": np.array([sum(t.count(" ") + 1 for _, t in b.texts) for b in blocks], float),
             "stops": np.array([sum(t.count(".") + t.count("!") + t.count("?") for _, t in b.texts) for b in blocks], float),
             "blocks": np.ones(n), "paragraphs": np.array([b.tag == "p" for b in blocks], float),
             "items": np.array([b.tag == "li" for b in blocks], float)}
    for i in range(n - 1, 0, -1):  # children stand behind their parents
        for values in total.values():
            values[parent[i]] += values[i]
    depth, above = np.zeros(n), np.zeros((n, len(_KIND_NAMES)))
    kinds = np.array([[kind in b.kinds for kind in _KIND_NAMES] for b in blocks], float).reshape(n, -1)
    tags = np.array([[_TAG_OF.get(b.tag, "") == t for t in _TAGS] for b in blocks], float).reshape(n, -1)
    tags_above = np.zeros_like(tags)
    index, siblings, share = np.zeros(n), np.ones(n), np.ones(n)
    for i in range(1, n):
        p = parent[i]
        depth[i] = depth[p] + 1
        above[i] = np.maximum(above[p], kinds[p])
        tags_above[i] = np.maximum(tags_above[p], tags[p])
    for b in blocks:
        if b.children:
            here = np.array(b.children)
            index[here] = np.arange(len(here)) / len(here)
            siblings[here] = len(here)
            share[here] = total["chars"][here] / max(1.0, total["chars"][here].max())
    chars = np.maximum(total["chars"], 1)
    return np.column_stack([
        np.log1p(total["chars"]), total["links"] / chars, total["tags"] / np.maximum(total["blocks"], 1), total["words"] / total["blocks"],
        100 * total["stops"] / chars, total["chars"] / total["blocks"], total["paragraphs"] / total["blocks"], total["items"] / total["blocks"],
        total["chars"] / max(1.0, total["chars"][0]), np.log1p(own), depth, index, np.log(siblings), share,
        np.log1p(total["chars"][np.maximum(parent, 0)]), kinds, above, tags, tags_above,
    ])


def decode(blocks: list[Block], keep: np.ndarray) -> np.ndarray:
    """The most probable labels in which nothing is kept below a dropped block."""
    keep = np.clip(keep, 1e-6, 1 - 1e-6)
    yes, no = np.log(keep), np.log(1 - keep)
    for i in range(len(blocks) - 1, 0, -1):
        best = max(yes[i], no[i])
        yes[blocks[i].parent] += best
        no[blocks[i].parent] += np.log(1 - keep[i]) if not blocks[i].children else no[i]
    label = np.zeros(len(blocks), bool)
    label[0] = True  # the page itself
    for i in range(1, len(blocks)):
        label[i] = label[blocks[i].parent] and yes[i] >= no[i]
    return label


def text_of(blocks: list[Block], label: np.ndarray) -> str:
    texts = sorted(run for b, kept in zip(blocks, label, strict=True) if kept for run in b.texts)
    return "\n\n".join(text for _, text in texts)


# --- training -----------------------------------------------------------------------------------------------------

def weak_labels(blocks: list[Block]) -> np.ndarray:
    """1 for blocks with main text by their own markup: in article or main, and not in anything that says otherwise."""
    inside, against = np.zeros(len(blocks), bool), np.zeros(len(blocks), bool)
    for i, b in enumerate(blocks):
        p = max(b.parent, 0)
        inside[i] = (i > 0 and inside[p]) or b.tag in ("article", "main")
        against[i] = (i > 0 and against[p]) or b.tag in ("nav", "aside", "footer", "form") or (
            bool(b.kinds - {"main", "head"}) and "main" not in b.kinds)
    label = inside & ~against & (np.array([bool(b.texts) for b in blocks]) | False)
    return _upwards(blocks, label)


def _upwards(blocks: list[Block], label: np.ndarray) -> np.ndarray:
    label = label.copy()
    for i in range(len(blocks) - 1, 0, -1):
        label[blocks[i].parent] |= label[i]
    return label.astype(float)


_MARK = "\u2060"  # stands in front of main text in the designs, and is taken off before features are made


def design(paragraphs: list[str], snippets: list[str], rng: random.Random) -> str:
    """The paragraphs in a random page design; main text is marked."""
    def short() -> str:
        return escape(rng.choice(snippets))

    def attribute(kind: str) -> str:
        word = rng.choice(KINDS[kind].split())
        return rng.choice([f' class="{word}"', f' id="{word}"', f' class="{word} x{rng.randint(1, 9)}"', f' class="site-{word}"'])

    def links(n: int) -> str:
        return "<ul>" + "".join(f'<li><a href="/{i}">{short()}</a></li>' for i in range(n)) + "</ul>"

    def menu() -> str:
        tag = rng.choice(["nav", "div"])
        return f"<{tag}{attribute('menu') if tag == 'div' or rng.random() < 0.5 else ''}>{links(rng.randint(2, 9))}</{tag}>"

    def boiler(kind: str) -> str:
        plain = {"head": "header", "foot": "footer", "side": "aside", "form": "form"}.get(kind)
        tag = plain if plain and rng.random() < 0.5 else rng.choice(["div", "section", "div"])
        named = attribute(kind) if tag in ("div", "section") or rng.random() < 0.5 else ""
        if kind == "side":
            inner = f"<h3>{short()}</h3>" + (links(rng.randint(2, 6)) if rng.random() < 0.6 else f"<p>{short()}</p><p>{short()}</p>")
        elif kind == "comment":
            inner = f"<h3>{short()}</h3>" + "".join(
                rng.choice([f'<div class="comment"><b>{short()}</b><p>{short()} {short()}</p></div>', f"<p>{short()} {short()}</p>",
                            f"<li><p>{short()}</p></li>"]) for _ in range(rng.randint(1, 6)))
        elif kind == "form":
            inner = f"<label>{short()}</label><input name=q><p>{short()}</p>"
        elif kind == "head":
            inner = f"<h1>{short()}</h1>" + rng.choice(["", f"<p>{short()}</p>", menu()])
        else:
            inner = rng.choice([short(), f"<p>{short()}</p>", f'<p>{short()}</p><a href="#">{short()}</a>', f"&copy; {short()}"])
        return f"<{tag}{named}>{inner}</{tag}>"

    body = []
    heading = rng.choice(["h1", "h2"])
    if rng.random() < 0.8:
        first = f"<{heading}>{_MARK}{escape(paragraphs[0][:60])}</{heading}>"
        body.append(f"<header>{first}</header>" if rng.random() < 0.3 else first)
    for i, paragraph in enumerate(paragraphs):
        text = escape(paragraph)
        body.append(rng.choices([f"<p>{_MARK}{text}</p>", f"<p><b>{_MARK}{text}</b><br>", f"<blockquote>{_MARK}{text}</blockquote>",
                                 f"<ul><li>{_MARK}{text}</li></ul>", f"<div>{_MARK}{text}</div>", f"<h2>{_MARK}{text[:50]}</h2>"],
                                [20, 2, 1, 1, 2, 1])[0])
        if rng.random() < 0.12 and i:
            body.append(boiler(rng.choice(["advert", "share", "side", "notice", "form"])))
    if rng.random() < 0.3:
        body.append(boiler("comment"))
    holder = rng.choice(["article", "article", "main", "div", "section", "div"])
    main = f"<{holder}{attribute('main') if holder in ('div', 'section') or rng.random() < 0.3 else ''}>{''.join(body)}</{holder}>"
    if rng.random() < 0.4:
        main = f'<{rng.choice(["div", "main", "section"])}>{main}</div>'
    before = [make() for make in (menu, lambda: boiler("head"), lambda: boiler("advert"), lambda: boiler("notice"), lambda: boiler("form"),
                                  lambda: boiler("side")) if rng.random() < 0.45]
    after = [boiler(kind) for kind in ("comment", "side", "foot", "advert", "share", "notice", "form") if rng.random() < 0.45]
    rng.shuffle(before)
    return f"<html><body>{''.join(before)}{main}{''.join(after)}</body></html>"


def train(pages: DataFrame, training_pages: int = TRAINING_PAGES, designs: int = DESIGNS) -> BoostedTrees:
    """Trees fitted on a bounded number of pages and designs of their text.

    Pages of more than ``LONGEST_TRAINED`` characters are extracted like all others but not learned from, so that what the
    driver takes in is bounded. The pages are drawn by hash, at a rate that their number gives.
    """
    fit = pages.select(F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")).filter(
        F.length("html").between(1, LONGEST_TRAINED))
    order = F.xxhash64("url", "html")
    chosen = fit.filter(drawn(order, fit.count(), training_pages)).orderBy(order).limit(training_pages).collect()
    rows, labels, snippets, mains = [], [], [], []
    for row in chosen:
        blocks = Tree(row.html).blocks
        label = weak_labels(blocks)
        if label[0]:
            rows.append(features(blocks))
            labels.append(label)
        mains.append([t for b, kept in zip(blocks, label, strict=True) if kept and b.tag != "h1" for _, t in b.texts])
        snippets += [t[:80] for b in blocks for _, t in b.texts][:40]
    mains = [m for m in mains if m]
    for number, paragraphs in enumerate(mains):
        rng = random.Random(zlib.crc32(f"{number} {paragraphs[0]}".encode()))
        pool = [t for t in rng.sample(snippets, min(len(snippets), 30)) if t not in paragraphs] or snippets
        for _ in range(designs):
            count = rng.choice([1, 2, 3, 5, 8, len(paragraphs)])
            blocks = Tree(design(rng.sample(paragraphs, min(count, len(paragraphs))), pool, rng)).blocks
            marked = np.array([any(_MARK in t for _, t in b.texts) for b in blocks])
            for b in blocks:
                b.texts = [(place, t.replace(_MARK, "")) for place, t in b.texts]
            rows.append(features(blocks))
            labels.append(_upwards(blocks, marked))
    trees = BoostedTrees()
    if not rows:
        trees.base = 5.0
        return trees
    return trees.fit(np.concatenate(rows), np.concatenate(labels))


def _extract(batches: Iterator[pa.RecordBatch], trees) -> Iterator[pa.RecordBatch]:
    for part in slices(batches, "html"):
        pages = [Tree(html or "").blocks for html in part.column("html").to_pylist()]
        keep = trees.value.predict(np.concatenate([features(blocks) for blocks in pages]))
        ends = np.cumsum([len(blocks) for blocks in pages])
        texts = [text_of(blocks, decode(blocks, keep[end - len(blocks) : end])) for blocks, end in zip(pages, ends, strict=True)]
        yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), pa.array(texts, pa.string())],
                                         ["page_id", "url", "text"])


def extract(pages: DataFrame, trees: BoostedTrees) -> DataFrame:
    """Per page: page_id, url, text."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("html"))
    shared = pages.sparkSession.sparkContext.broadcast(trees)
    return rows.mapInArrow(partial(_extract, trees=shared), "page_id long, url string, text string")


def op4_html_extraction(spark, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages")
    return extract(pages, train(pages)).withColumn("n_chars", F.length("text").cast("long"))
