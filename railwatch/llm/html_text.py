"""Main text of web pages by a tree-structured graphical model.

Every element of a page is a binary variable: content or not. Its node potential is the likelihood of what is seen of it
(tag, class and id words, role, amount of text, share of links), an edge potential ties it to its parent. One message
from each child to its parent, in order of falling depth, and one back down give the exact marginals; text whose element
is content with probability over a half is kept.

The potentials are smoothed counts over a bounded sample of labelled pages (about ``SAMPLE_PAGES``, drawn by a hash
of the id). Pages label themselves where they use landmarks: what stands in ``article`` or ``main`` is content, unless
it also stands in a landmark of another purpose. The landmarks themselves get counts beforehand (``PRIOR``), so that
ones the sample lacks are known too. What an element looks like is judged where it stands: by its tag, its share of
links and the kind of element around it. Only for places the sample lacks its tag, size and links count wherever they
were seen, and then nothing without links speaks against content: a list in an article is no menu because the sample
knows lists from menus, however long it is. Learned class words count in full.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import partial
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SAMPLE_PAGES = 600
PRIOR = 2000.0
# Bounds of what an element's looks may say: in a place the sample has, and elsewhere with links and without.
CLIP = (-1.5, 1.5)
CLIP_LINKED = (-0.1, 1.5)
CLIP_LINKLESS = (0.0, 1.5)
LANDMARK_CLIP = 12.0
# Element names of the HTML standard.
CONTENT_TAGS = frozenset("article main".split())
OTHER_TAGS = frozenset("nav header footer aside form menu dialog button select textarea label fieldset iframe object head title".split())
SILENT_TAGS = frozenset("script style noscript template svg math".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK_TAGS = frozenset(
    "address article aside blockquote body button caption center dd details dialog div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section select summary table tbody td"
    " textarea tfoot th thead title tr ul".split()
)
# Closed by the start of another one of their kind.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
LIST_TAGS = frozenset("li ul ol dl dt dd".split())
CLOSE_LIMITS = frozenset("ul ol dl table select body html article main section div".split())
# Words in class, id and role that tell the purpose of an element.
OTHER_WORDS = frozenset(
    "ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments consent contentinfo cookie cookies"
    " discussion disqus dropdown feedback foot footer form head header login masthead menu modal nav navbar navigation"
    " newsletter notice notices pagination pager popup promo promoted recommended related replies reply respond search share"
    " sharing sidebar signup social sponsor sponsored subscribe tags teaser toolbar topbar warning widget complementary".split()
)
CONTENT_WORDS = frozenset("article articlebody content entry main post story".split())
_WORD = re.compile(r"[a-zA-Z][a-z]+|[A-Z]+")


class _Tree(HTMLParser):
    """Elements in page order with their parents, and pieces of text with their element and block."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.parent, self.tag, self.words = [-1], ["#page"], [()]
        self.text: list[tuple[int, int, str]] = []
        self.open, self.block, self.silent = [0], 0, 0

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag == "br" or tag in VOID_TAGS:
            if tag == "hr":
                self.block += 1
            elif tag == "br":
                self.handle_data(" ")
            return
        if tag in BLOCK_TAGS:
            # A block ends an open paragraph, with whatever is still open in it.
            self._close({"p"}, frozenset("button td th li".split()) | CLOSE_LIMITS)
            self.block += 1
        if tag in CLOSES:
            self._close(CLOSES[tag], CLOSE_LIMITS)
        named = " ".join(v for k, v in attrs if v and k in ("class", "id", "role"))
        self.open.append(len(self.tag))
        self.parent.append(self.open[-2])
        self.tag.append(tag)
        self.words.append(tuple(sorted({w.lower() for w in _WORD.findall(named)})) if named else ())
        self.silent += tag in SILENT_TAGS

    def _close(self, tags: set[str], limits: frozenset[str]) -> None:
        for depth in range(len(self.open) - 1, 0, -1):
            tag = self.tag[self.open[depth]]
            if tag in tags:
                self._cut(depth)
                return
            if tag in limits:
                return

    def _cut(self, depth: int) -> None:
        self.silent -= sum(self.tag[i] in SILENT_TAGS for i in self.open[depth:])
        del self.open[depth:]

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCK_TAGS:
            self.block += 1
        for depth in range(len(self.open) - 1, 0, -1):
            if self.tag[self.open[depth]] == tag:
                self._cut(depth)
                return

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID_TAGS:
            self.handle_endtag(tag)

    def handle_data(self, data: str) -> None:
        if not self.silent:
            self.text.append((self.open[-1], self.block, data))


def parse(html: str) -> _Tree:
    tree = _Tree()
    tree.feed(html)
    tree.close()
    return tree


def features(tree: _Tree) -> list[list[str]]:
    """What is seen of each element."""
    n = len(tree.tag)
    words, linked = [0] * n, [0] * n
    in_link = [False] * n
    for i in range(1, n):
        in_link[i] = tree.tag[i] == "a" or in_link[tree.parent[i]]
    for i, _, data in tree.text:
        count = len(data.split())
        words[i] += count
        linked[i] += count * in_link[i]
    for i in range(n - 1, 0, -1):
        if tree.tag[i] not in BLOCK_TAGS:
            words[tree.parent[i]] += words[i]
            linked[tree.parent[i]] += linked[i]
    out = []
    share, around = ["-"] * n, ["-"] * n
    for i in range(n):
        p, tag, size = tree.parent[i], tree.tag[i], words[i]
        if p >= 0:
            # The nearest element around it that is neither part of a list nor inside a line.
            passed = tree.tag[p] in LIST_TAGS or p > 0 and tree.tag[p] not in BLOCK_TAGS
            around[i] = around[p] if passed else tree.tag[p]
        if p >= 0 and tag not in BLOCK_TAGS:
            share[i] = share[p]
        elif size:
            share[i] = str(4 * linked[i] // size)
        seen = ["at " + " ".join((tag, share[i], around[i])), "tag " + tag, "size " + str(min(size.bit_length(), 7))]
        if size:
            seen.append("links " + str(4 * linked[i] // size))
        seen += ["word " + w for w in tree.words[i]]
        out.append(seen)
    return out


def landmark_labels(tree: _Tree) -> list[int]:
    """1 for what stands in a content landmark and in none of another purpose."""
    label, banned = [0] * len(tree.tag), [False] * len(tree.tag)
    for i in range(1, len(tree.tag)):
        p, tag = tree.parent[i], tree.tag[i]
        banned[i] = banned[p] or tag in OTHER_TAGS or tag in SILENT_TAGS or not OTHER_WORDS.isdisjoint(tree.words[i])
        label[i] = int(not banned[i] and (label[p] or tag in CONTENT_TAGS))
    return label


def _landmark(feature: str) -> int | None:
    kind, _, name = feature.partition(" ")
    if kind == "tag" and name in CONTENT_TAGS or kind == "word" and name in CONTENT_WORDS:
        return 1
    if kind == "tag" and (name in OTHER_TAGS or name in SILENT_TAGS) or kind == "word" and name in OTHER_WORDS:
        return 0
    return None


class Model:
    """Log odds of features, and log potentials of (parent, child) labels."""

    def __init__(self, counts: Counter):
        self.totals = [counts["node", k] + 2.0 for k in (0, 1)]
        self.odds: dict[str, float] = {}
        names = {name for kind, name, *_ in counts if kind == "feature"}
        names |= {f"tag {t}" for t in CONTENT_TAGS | OTHER_TAGS | SILENT_TAGS} | {f"word {w}" for w in OTHER_WORDS | CONTENT_WORDS}
        for name in names:
            for_label = _landmark(name)
            seen = [counts["feature", name, k] + (PRIOR if for_label == k else 0) + 0.5 for k in (0, 1)]
            odds = float(np.log(seen[1] / self.totals[1]) - np.log(seen[0] / self.totals[0]))
            self.odds[name] = min(max(odds, -LANDMARK_CLIP), LANDMARK_CLIP)
        # Content may hold other things, but is rarely held by them, whatever the sample's pages look like.
        edge = np.array([[counts["edge", a, b] + (8 if a == b else 0.5) for b in (0, 1)] for a in (0, 1)], float)
        edge /= edge.sum(axis=1, keepdims=True)
        edge[0, 1], edge[1, 0] = np.clip(edge[0, 1], 0.01, 0.03), np.clip(edge[1, 0], 0.1, 0.15)
        edge[0, 0], edge[1, 1] = 1 - edge[0, 1], 1 - edge[1, 0]
        self.edge = edge

    def node_odds(self, seen: list[str]) -> float:
        place, *rest = seen
        if place in self.odds:
            looks, (low, high) = self.odds[place], CLIP
        else:
            looks = sum(self.odds.get(f, 0.0) for f in rest if _landmark(f) is None and not f.startswith("word "))
            low, high = CLIP_LINKLESS if place.split(" ")[2] in ("-", "0") else CLIP_LINKED
        words = sum(self.odds.get(f, 0.0) for f in rest if _landmark(f) is None and f.startswith("word "))
        landmarks = sum(self.odds.get(f, 0.0) for f in rest if _landmark(f) is not None)
        return min(max(looks, low), high) + min(max(words, -LANDMARK_CLIP), CLIP[1]) + landmarks


def train(pages: Iterator[str]) -> Counter:
    """Counts of labels, features and edges of self-labelled pages; those without a content landmark teach nothing."""
    counts: Counter = Counter()
    for html in pages:
        tree = parse(html)
        label = landmark_labels(tree)
        if not any(label):
            continue
        for i, seen in enumerate(features(tree)):
            counts["node", label[i]] += 1
            for f in seen:
                counts["feature", f, label[i]] += 1
            if i:
                counts["edge", label[tree.parent[i]], label[i]] += 1
    return counts


def marginals(parent: np.ndarray, odds: np.ndarray, edge: np.ndarray) -> np.ndarray:
    """Probability of content for nodes of many trees at once (parents before children; roots have parent -1)."""
    depth = np.zeros(len(parent), np.int64)
    rising = np.flatnonzero(parent >= 0)
    for i, p in zip(rising.tolist(), parent[rising].tolist(), strict=True):
        depth[i] = depth[p] + 1
    order = np.argsort(depth, kind="stable")
    cuts = np.searchsorted(depth[order], np.arange(depth.max(initial=0) + 2))
    # Beliefs and messages as log of (not content, content).
    belief = np.stack([np.zeros(len(odds)), odds], axis=1)
    up = np.zeros_like(belief)
    log_edge = np.log(edge)
    for d in range(len(cuts) - 2, 0, -1):
        nodes = order[cuts[d] : cuts[d + 1]]
        message = np.logaddexp(log_edge[:, 0] + belief[nodes, :1], log_edge[:, 1] + belief[nodes, 1:])
        up[nodes] = message - message.max(axis=1, keepdims=True)
        np.add.at(belief, parent[nodes], up[nodes])
    for d in range(1, len(cuts) - 1):
        nodes = order[cuts[d] : cuts[d + 1]]
        # What the parent believes without this child's own message.
        rest = belief[parent[nodes]] - up[nodes]
        message = np.logaddexp(log_edge[0] + rest[:, :1], log_edge[1] + rest[:, 1:])
        belief[nodes] += message - message.max(axis=1, keepdims=True)
    return 1 / (1 + np.exp(np.clip(belief[:, 0] - belief[:, 1], -700, 700)))


def assemble(tree: _Tree, content: np.ndarray) -> str:
    blocks: dict[int, list[str]] = {}
    for i, block, data in tree.text:
        if content[i] > 0.5:
            blocks.setdefault(block, []).append(data)
    texts = (" ".join("".join(b).split()) for b in blocks.values())
    return "\n\n".join(t for t in texts if t)


def extract(pages: list[str], model: Model) -> list[str]:
    trees = [parse(p) for p in pages]
    sizes = np.cumsum([0, *(len(t.tag) for t in trees)])
    parent = np.concatenate([np.where((p := np.array(t.parent)) < 0, -1, p + s) for t, s in zip(trees, sizes, strict=False)])
    odds = np.array([model.node_odds(seen) for t in trees for seen in features(t)])
    p = marginals(parent, odds, model.edge)
    return [assemble(t, p[a:b]) for t, a, b in zip(trees, sizes[:-1], sizes[1:], strict=True)]


def _extract_batches(batches: Iterator[pa.RecordBatch], model: Model, keep: list[str], together: int = 64) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for start in range(0, whole.num_rows, together):
            batch = whole.slice(start, together)
            texts = extract([h or "" for h in batch.column("html").to_pylist()], model)
            columns = [*(batch.column(c) for c in keep), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, [*keep, "text", "n_chars"])


def fit(pages: DataFrame, rows: int = SAMPLE_PAGES) -> Model:
    """A model from about ``rows`` pages; without any, it knows the landmarks alone."""
    there = pages.where(F.col("html").isNotNull())
    sample = there.where(F.pmod(F.xxhash64("page_id"), F.lit(1 << 20)) * max(1, there.count()) < rows << 20)
    counts = sample.select("html").mapInArrow(_count_batches, "kind string, name string, a int, b int, n long")
    total = counts.groupBy("kind", "name", "a", "b").agg(F.sum("n").alias("n")).collect()
    out: Counter = Counter()
    for kind, name, a, b, n in total:
        key = {"node": (kind, a), "edge": (kind, a, b), "feature": (kind, name, a)}[kind]
        out[key] = n
    return Model(out)


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()
    for batch in batches:
        counts.update(train(iter(batch.column("html").to_pylist())))
    rows = {c: [] for c in ("kind", "name", "a", "b", "n")}
    for key, n in counts.items():
        kind = key[0]
        name, a, b = (key[1], key[2], None) if kind == "feature" else (None, key[1], key[2] if kind == "edge" else None)
        for c, v in zip(rows, (kind, name, a, b, n), strict=True):
            rows[c].append(v)
    types = [pa.string(), pa.string(), pa.int32(), pa.int32(), pa.int64()]
    yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(rows.values(), types, strict=True)], list(rows))


def extract_pages(pages: DataFrame, model: Model, keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The columns ``keep`` of every row, the main ``text`` of its html and its code points ``n_chars``.

    Character references are decoded, white space in a block becomes one space, blocks are parted by an empty line. A
    null or empty html, or one without content, gives the empty text. Repeated rows each give a row.
    """
    work = pages.select(*[F.col(f"`{c}`") for c in dict.fromkeys((*keep, "html"))])
    types = {f.name: f.dataType.simpleString() for f in work.schema.fields}
    schema = ", ".join(f"`{c}` {types[c]}" for c in keep) + ", text string, n_chars long"
    return work.mapInArrow(partial(_extract_batches, model=model, keep=list(keep)), schema)
