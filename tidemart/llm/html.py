"""Main text of web pages: boosted trees over DOM nodes, decoded along the tree.

A page becomes a tree of block elements and runs of text. Each node has features
of its own (tag, attribute tokens, depth), of what is below it (text, links,
signs), of its siblings and of its ancestors. Boosted trees give each node the
chance to be main text. Decoding picks the most likely labels under which a
node that is kept or dropped has all of its descendants kept or dropped; only a
node that is neither leaves the choice to its children.

Pages have no labels. The trees learn from a bounded sample of pages
(``SAMPLE_PAGES``) of any length, and of each from a bounded number of nodes
(``SAMPLE_NODES``): what their tags and attribute tokens say plainly is the
label; then widgets are put in, in one copy the plain signs are hidden at random
and in another the attribute tokens always, so that the trees also learn text, links, position
and siblings.

An element in a line of text is a node only if its attributes mark it; the text
around it stays one block. Handling: null or empty html has no text; rows that repeat are
pages of their own with equal results; only the named columns are read, so others may
have any name; the trees of pages are scored together, a bounded number of nodes at a time.
"""

from __future__ import annotations

import html as references
import random
import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tidemart.llm.boosting import Boosted, fit
from tidemart.llm.common import table

SAMPLE_PAGES = 600
SAMPLE_NODES = 400
GROUP_NODES = 20_000
SURE = 0.9

# HTML elements by what they do, and words that name parts of pages.
RAW = frozenset("script style textarea title xmp iframe noembed noframes head".split())
# May stand in a paragraph, and are nodes only if they have an end tag. A choice holds options, no other blocks.
PARTS = frozenset("noscript template svg select datalist object audio video canvas".split())
CHOICES = frozenset("select datalist option".split())
BLOCKS = frozenset("""html body address article aside blockquote center details dialog dd div dl dt fieldset figcaption figure footer form
h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul caption legend button label option""".split()) | PARTS
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSED_BY = {"li": ("li", {"ul", "ol", "menu"}), "dt": ("dt dd", {"dl"}), "dd": ("dt dd", {"dl"}), "tr": ("tr", {"table"}),
             "option": ("option", {"select", "datalist"}), "td": ("td th", {"tr", "table"}), "th": ("td th", {"tr", "table"})}
BAD_TAGS = frozenset("nav footer aside form menu dialog button label fieldset search select datalist option template".split())
GOOD_TAGS = frozenset(("article", "main"))
BAD_WORDS = frozenset("""nav navigation navbar menu breadcrumb breadcrumbs header masthead footer sidebar aside complementary contentinfo banner
ad ads adv advert adverts advertisement advertising promo promotion promoted sponsor sponsored cookie cookies consent gdpr notice notices alert
popup modal overlay comment comments commentlist disqus reply replies responses reader readers related recommended recommendations more
share sharing social follow newsletter subscribe subscription signup login search form widget widgets pagination pager tags
copyright legal disclaimer hidden skip toolbar paywall""".split())
GOOD_WORDS = frozenset("article content post entry story body main text maincontent articlebody".split())

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?/](?![a-zA-Z])[^>]*+>?|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
                   r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>?", re.S)
NAMES = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
HIDDEN = re.compile(r"display\s*:\s*none|(?:^|\s)hidden(?=[\s=]|$)|aria-hidden\s*=\s*[\"']?true", re.I)
WORDS = re.compile(r"[a-z]+")


class Tree:
    """Nodes in page order: tag, parent, own marks; a run of text is a node with tag ``#``.

    ``block`` numbers the blocks of text; runs of one block are apart only by an
    element within the line. ``edges`` tells whether white space stands before a run as
    text of its own, leads it and follows it.
    """

    def __init__(self) -> None:
        self.tag: list[str] = ["html"]
        self.parent: list[int] = [-1]
        self.bad: list[int] = [0]
        self.good: list[int] = [0]
        self.text: list[str] = [""]
        self.linked: list[int] = [0]
        self.links: list[int] = [0]
        self.block: list[int] = [0]
        self.edges: list[tuple[bool, bool, bool]] = [(False, False, False)]

    def add(self, tag: str, parent: int, bad: int = 0, good: int = 0, text: str = "", linked: int = 0, links: int = 0,
            block: int = 0, edges: tuple[bool, bool, bool] = (False, False, False)) -> int:
        for column, value in ((self.tag, tag), (self.parent, parent), (self.bad, bad), (self.good, good), (self.text, text),
                              (self.linked, linked), (self.links, links), (self.block, block), (self.edges, edges)):
            column.append(value)
        return len(self.tag) - 1


def marks(attributes: str) -> tuple[bool, bool]:
    """Whether attributes name something that is not main text or hide it, and whether they name main text."""
    words = {w for m in NAMES.finditer(attributes) for w in WORDS.findall((m[1] or m[2] or m[3] or "").lower())}
    return not words.isdisjoint(BAD_WORDS) or HIDDEN.search(attributes) is not None, not words.isdisjoint(GOOD_WORDS)


class Open:
    """The open elements: names, their nodes, and where each name stands, so that no tag looks through all of them."""

    def __init__(self) -> None:
        self.names, self.nodes = ["html"], [0]
        self.places: dict[str, list[int]] = {"html": [0]}
        self.within: list[int] = [0]  # open elements of the same name that are no nodes, within one in a line

    def push(self, name: str, node: int) -> None:
        self.places.setdefault(name, []).append(len(self.names))
        self.names.append(name)
        self.nodes.append(node)
        self.within.append(0)

    def last(self, *names: str) -> int:
        """The innermost place of some names; -1 if none is open."""
        return max((self.places[x][-1] for x in names if self.places.get(x)), default=-1)

    def first(self, names) -> int:
        return min((self.places[x][0] for x in names if self.places.get(x)), default=-1)

    def close(self, place: int) -> None:
        """Close everything from a place on; the page itself stays open."""
        while len(self.names) > max(1, place):
            self.places[self.names.pop()].pop()
            self.nodes.pop()
            self.within.pop()


def parse(page: str) -> Tree:
    tree, opened = Tree(), Open()
    pieces: list[str] = []
    linked = links = block = 0
    in_link = space = False
    at, end = 0, len(page)
    closes: dict[str, int] = {}  # the next end tag of a name, looked for once

    def flush(in_line: bool = False) -> None:
        nonlocal linked, links, block, space
        if pieces:
            raw = "".join(pieces)
            text = " ".join(raw.split())
            if text:
                tree.add("#", opened.nodes[-1], text=text, linked=min(linked, len(text)), links=links, block=block,
                         edges=(space, raw[0].isspace(), raw[-1].isspace()))
                space = False
            elif raw:
                space = True
            pieces.clear()
        linked = links = 0
        if not in_line:
            block += 1
            space = False

    def say(raw: str) -> None:
        nonlocal linked
        text = references.unescape(raw) if "&" in raw else raw
        pieces.append(text)
        if in_link:
            linked += len(text.strip())

    def end_tag(name: str) -> int:
        """Where the next end tag of a name begins; the end of the page if there is none."""
        if closes.get(name, -1) < at:
            found = re.compile(rf"</{re.escape(name)}(?=[\s/>]|\Z)", re.I).search(page, at)
            closes[name] = end if found is None else found.start()
        return closes[name]

    while at < end:
        found = TOKEN.search(page, at)
        if found is None:
            say(page[at:])
            break
        if found.start() > at:
            say(page[at:found.start()])
        at = found.end()
        name = found[2] or found[5]
        if not name:
            continue
        name = name.lower()
        closing = found[1] or found[4]
        if closing:
            if name == "a":
                in_link = False
            place = opened.last(name)
            if name in BLOCKS:
                flush()
                if place >= 0:
                    opened.close(place)
            elif place >= 0:
                if opened.within[place]:
                    opened.within[place] -= 1
                elif opened.last(*BLOCKS) < place:
                    flush(in_line=True)
                    opened.close(place)
            continue
        attributes = found[3] or found[6] or ""
        if name in RAW:
            if not attributes.rstrip().endswith("/"):
                # A head may lack its end: then it ends where the body begins.
                if name == "head" and end_tag(name) == end:
                    continue
                at = end_tag(name)
            continue
        if name in ("html", "body"):
            flush()
            continue
        if name == "br" or name == "img" or name == "wbr":
            pieces.append(" " if name != "wbr" else "")
            continue
        if name not in BLOCKS:
            if name == "a":
                in_link = True
                links += 1
            if name in VOID or attributes.rstrip().endswith("/"):
                continue
            if attributes and marks(attributes)[0]:
                kept = links
                flush(in_line=True)
                opened.push(name, tree.add(name, opened.nodes[-1], 1))
                links = kept if name == "a" else 0
            elif (place := opened.last(name)) >= 0:
                opened.within[place] += 1
            continue
        if name in PARTS and (end_tag(name) == end or attributes.rstrip().endswith("/")):
            continue
        flush()
        if name == "hr":
            continue
        if name != "option" and (place := opened.first(CHOICES)) >= 0:
            opened.close(place)
        if name in CLOSED_BY:
            same, wall = CLOSED_BY[name]
            place = opened.last(*same.split())
            if place > opened.last(*wall):
                opened.close(place)
        elif name not in ("button", "label", "option") and name not in PARTS and (place := opened.last("p")) >= 0:
            opened.close(place)
        bad, good = marks(attributes) if attributes else (False, False)
        opened.push(name, tree.add(name, opened.nodes[-1], int(bad or name in BAD_TAGS), int(good or name in GOOD_TAGS)))
    flush()
    return tree


TAG_GROUPS = ({"p"}, {"h1", "h2", "h3", "h4", "h5", "h6"}, {"li", "ul", "ol"}, {"td", "th", "tr", "table", "tbody"}, {"div", "section"},
              {"article", "main"}, {"nav", "menu"}, {"footer"}, {"header"}, {"aside"}, {"form", "button", "label", "fieldset"},
              {"blockquote", "pre", "figure", "figcaption"})
GROUP_OF = {tag: k for k, group in enumerate(TAG_GROUPS) for tag in group}
OWN = 14
WIDTH = OWN + len(TAG_GROUPS)


def features(tree: Tree, hide_good: bool = False, hide_bad_tags: bool = False, hide_words: bool = False) -> np.ndarray:
    """One row per node. The hide options blank the plain signs, for training."""
    n = len(tree.tag)
    parent = tree.parent
    tags = tree.tag
    if hide_good:
        tags = ["div" if t in GOOD_TAGS else t for t in tags]
    if hide_bad_tags:
        tags = ["div" if t in ("nav", "footer", "aside", "header") else t for t in tags]
    bad = [0 if hide_words or (hide_bad_tags and t in ("nav", "footer", "aside")) else b for b, t in zip(tree.bad, tree.tag)]
    good = [0 if hide_words or (hide_good and t in GOOD_TAGS) else g for g, t in zip(tree.good, tree.tag)]
    size = [len(t) for t in tree.text]
    signs = [t.count(".") + t.count(",") + t.count("!") + t.count("?") if t else 0 for t in tree.text]
    words = [t.count(" ") + 1 if t else 0 for t in tree.text]
    linked, links = list(tree.linked), list(tree.links)
    nodes = [1] * n
    children = [0] * n
    begin, seen = [0] * n, 0
    for i in range(n):
        begin[i] = seen
        seen += size[i] if tree.tag[i] == "#" else 0
    for i in range(n - 1, 0, -1):
        p = parent[i]
        size[p] += size[i]
        signs[p] += signs[i]
        words[p] += words[i]
        linked[p] += linked[i]
        links[p] += links[i]
        nodes[p] += nodes[i]
        children[p] += 1
    depth, bad_above, good_above, index = [0] * n, [0] * n, [0] * n, [0] * n
    last = [-1] * n
    before = [-1] * n
    for i in range(1, n):
        p = parent[i]
        depth[i] = depth[p] + 1
        bad_above[i] = bad_above[p] + bad[i]
        good_above[i] = good_above[p] + good[i]
        index[i] = index[last[p]] + 1 if last[p] >= 0 else 0
        before[i] = last[p]
        last[p] = i
    total = max(1, size[0])
    x = np.zeros((n, WIDTH))
    s = np.array(size, float)
    up = np.maximum(np.array(parent), 0)
    prior = np.array(before)
    x[:, 0] = depth
    x[:, 1] = np.log1p(s)
    x[:, 2] = np.array(linked) / np.maximum(1, s)
    x[:, 3] = np.array(signs) / np.maximum(1, np.array(words))
    x[:, 4] = s / np.array(nodes)
    x[:, 5] = np.log1p(children)
    x[:, 6] = index
    x[:, 7] = np.log1p(s[up] / np.maximum(1, np.array(children)[up]))
    x[:, 8] = np.where(prior >= 0, np.log1p(s[np.maximum(prior, 0)]), 0)
    x[:, 9] = np.array(begin) / total
    x[:, 10] = s / total
    x[:, 11] = bad_above
    x[:, 12] = good_above
    x[:, 13] = np.log1p(links)
    for i in range(n):
        tag = tags[i] if tags[i] != "#" or i == 0 else tags[parent[i]]
        if (k := GROUP_OF.get(tag, -1)) >= 0:
            x[i, OWN + k] = 1
    return x


def plain_labels(tree: Tree) -> list[int | None]:
    """What tags and attribute tokens say: 1 main text, 0 not, None for a node that has both."""
    n = len(tree.tag)
    has_zone = any(t in GOOD_TAGS for t in tree.tag)
    zone, off = [0] * n, [0] * n
    kept, all_text = [0] * n, [0] * n
    for i in range(1, n):
        p = tree.parent[i]
        zone[i] = zone[p] or tree.tag[i] in GOOD_TAGS
        off[i] = off[p] or tree.bad[i] or (tree.tag[i] == "header" and not zone[p])
        if tree.tag[i] == "#":
            all_text[i] = len(tree.text[i])
            words = tree.text[i].count(" ") + 1
            own = zone[i] if has_zone else (words >= 5 or tree.tag[p][0] == "h") and 2 * tree.linked[i] < all_text[i]
            kept[i] = all_text[i] if own and not off[i] else 0
    for i in range(n - 1, 0, -1):
        kept[tree.parent[i]] += kept[i]
        all_text[tree.parent[i]] += all_text[i]
    return [None if not a or 0 < k < a else int(k > 0) for k, a in zip(kept, all_text)]


# Parts that pages often have, to be put into sampled pages; {0} to {2} are taken from the page's words.
WIDGETS = (
    '<div class="comments"><h3>Comments</h3><div class="comment"><p>{0}</p></div><div class="comment"><p>{1}</p></div></div>',
    '<section id="comments"><ol><li class="comment"><p><b>{2}</b> {0}</p></li><li class="comment"><p>{1}</p></li></ol></section>',
    '<aside class="sidebar"><h4>{2}</h4><ul><li><a href="/a">{2}</a></li><li><a href="/b">{2}</a></li></ul><p>{0}</p></aside>',
    '<div class="related"><h3>{2}</h3><ul><li><a href="/c">{0}</a></li><li><a href="/d">{1}</a></li></ul></div>',
    '<div id="cookie-notice"><p>{0}</p><button>{2}</button></div>',
    '<form action="/s"><label>{2}</label><input name="q"><p>{0}</p><button>{2}</button></form>',
    '<div class="advert"><p>{0}</p><a href="/x">{2}</a></div>', '<div class="ad-banner">{0}</div>',
    '<header class="site-header"><p>{2}</p><a href="/">{2}</a></header>',
    '<div class="share"><a href="/f">{2}</a> <a href="/t">{2}</a></div>', '<div class="newsletter"><p>{0}</p></div>',
    '<p>{0}</p><p>{1}</p>', '<blockquote><p>{0}</p></blockquote>', '<ul><li>{0}</li><li>{1}</li></ul>', '<h2>{2}</h2><p>{0}</p>',
    '<table><tr><td>{2}</td><td>{0}</td></tr></table>',
)


def with_widgets(page: str, dice: random.Random) -> str:
    words = re.sub(r"<[^>]*>", " ", page).split() or ["word"]

    def some(low: int, high: int) -> str:
        start = dice.randrange(len(words))
        return " ".join(words[start:start + dice.randint(low, high)]) or "word"

    places = [m.start() for m in re.finditer(r"<p\b|<h2\b|</article>|<article\b|</body>|<footer\b", page)]
    for _ in range(dice.randint(1, 5)):
        if not places:
            break
        at = dice.choice(places)
        part = dice.choice(WIDGETS).format(some(5, 40), some(5, 40), some(1, 3))
        page = page[:at] + part + page[at:]
        places = [p + len(part) if p >= at else p for p in places]
    return page


def examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task: sampled pages to features and labels of their nodes, at most ``SAMPLE_NODES`` of a version of a page."""
    for batch in batches:
        rows, labels = [np.zeros((0, WIDTH))], [np.zeros(0, np.int32)]
        for page in batch.column(0).to_pylist():
            dice = random.Random(crc32(page.encode("utf-8", "replace")))
            some = lambda: dice.random() < 0.4
            for version, hidden in ((page, (False, False, False)), (with_widgets(page, dice), (some(), some(), some())),
                                    (with_widgets(page, dice), (some(), some(), True))):
                tree = parse(version)
                truth = plain_labels(tree)
                use = [i for i, label in enumerate(truth) if label is not None]
                if len(use) > SAMPLE_NODES:
                    use = sorted(dice.sample(use, SAMPLE_NODES))
                rows.append(features(tree, *hidden)[use])
                labels.append(np.array([truth[i] for i in use], np.int32))
        x = np.concatenate(rows)
        lists = pa.FixedSizeListArray.from_arrays(pa.array(x.reshape(-1)), WIDTH).cast(pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([lists, pa.array(np.concatenate(labels))], ["x", "label"])


def train(pages: DataFrame, sample_pages: int = SAMPLE_PAGES, html_column: str = "html") -> Boosted | None:
    """None if the sample has no nodes of both kinds. Pages that repeat are sampled once."""
    few = pages.select(F.col(html_column).alias("html")).filter(F.length("html") > 0).withColumn(
        "order", F.xxhash64("html"))
    # One row for each hash: then the sample is the rows with the smallest ones.
    share = min(1.0, 4 * sample_pages / max(1, pages.count()))
    sample = few.filter(F.pmod("order", F.lit(1 << 30)) < int(share * (1 << 30))).groupBy("order").agg(
        F.min("html").alias("html")).orderBy("order").limit(sample_pages)
    found = sample.select("html").mapInArrow(examples, "x array<double>, label int").toArrow()
    if not found.num_rows:
        return None
    x = found.column("x").combine_chunks().flatten().to_numpy().reshape(found.num_rows, WIDTH)
    labels = found.column("label").to_numpy().astype(float)
    if labels.min() == labels.max():
        return None
    # Order of the rows must not matter to the last digit.
    order = np.lexsort(np.column_stack([x, labels]).T)
    return fit(x[order], labels[order])


def decode(tree: Tree, chance: np.ndarray) -> str:
    """Text of the kept runs under the best labels without contradictions."""
    n = len(tree.tag)
    chance = np.clip(chance, 1e-6, 1 - 1e-6)
    keep, drop = np.log(chance).tolist(), np.log1p(-chance).tolist()
    keep[0] = drop[0] = 0.0
    mixed = [0.0] * n
    state = [0] * n  # 1 all kept, -1 all dropped, 0 the children decide
    neither = float(np.log(0.5))
    for i in range(n - 1, -1, -1):
        options = [(keep[i], 1), (drop[i], -1)]
        if tree.tag[i] != "#":
            options.append((mixed[i] + neither * (i > 0), 0))
        value, state[i] = max(options)
        if i:
            p = tree.parent[i]
            keep[p] += keep[i]
            drop[p] += drop[i]
            mixed[p] += value
    out: list[str] = []
    last, open_end = -1, False
    for i in range(n):
        if i and state[tree.parent[i]]:
            state[i] = state[tree.parent[i]]
        if tree.tag[i] != "#":
            continue
        before, leads, follows = tree.edges[i]
        if tree.block[i] == last:
            # A run that is left out takes its own white space with it, not what stands before it.
            if state[i] == 1:
                out[-1] += (" " if before or leads or open_end else "") + tree.text[i]
                open_end = follows
            else:
                open_end = open_end or before
        elif state[i] == 1:
            out.append(tree.text[i])
            last, open_end = tree.block[i], follows
    return "\n".join(out)


def main_text(pages: DataFrame, model: Boosted | None, html_column: str = "html", out: str = "text") -> DataFrame:
    """``pages`` with the main text. Null or empty html: empty text. Without a model the plain labels decide."""

    def texts_of(trees: list[Tree]) -> list[str]:
        if model is None:
            return [decode(tree, np.array([0.5 if label is None else 0.999 * label + 0.0005 for label in plain_labels(tree)]))
                    for tree in trees]
        found = [features(tree) for tree in trees]
        chances = np.split(model.chance(np.concatenate(found)), np.cumsum([len(x) for x in found])[:-1])
        return [decode(tree, chance) for tree, chance in zip(trees, chances)]

    @F.arrow_udf(StringType())
    def extract(column: pa.Array) -> pa.Array:
        texts: list[str] = []
        waiting: list[Tree] = []
        nodes = 0
        for value in column:
            waiting.append(parse(value.as_py() or ""))
            nodes += len(waiting[-1].tag)
            if nodes >= GROUP_NODES:
                texts += texts_of(waiting)
                waiting, nodes = [], 0
        return pa.array(texts + (texts_of(waiting) if waiting else []), pa.string())

    return pages.withColumn(out, extract(F.col(html_column)))


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars, a row for each row of ``pages``."""
    return main_text(pages.select("page_id", "url", F.col("html").alias("#html")), train(pages), "#html").select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op7_dom_boosting(spark: SparkSession, folder: str) -> DataFrame:
    return extract_pages(table(spark, folder, "pages"))
