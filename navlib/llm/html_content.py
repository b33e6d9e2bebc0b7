"""Main text of web pages: a tree-structured graphical model over the DOM.

Each block element and each text run of a page has a hidden label, content or
not.  An element's evidence is its tag, the roles that its class, id and role
names speak of, and how much of its text stands in links; a text run's is its
length and links by the kind of element it stands in, and its punctuation.
Parent and child labels are tied by potentials.  Two passes of sum-product messages, up
and down the tree, give every node's exact marginal; texts above one half
form the result.

The tables of evidence and ties are counts with smoothing, from labelled
pages: the small hand-labelled ones of html_seeds and a sample of at most
``TRAIN_PAGES`` pages whose blocks are labelled by whether they are lines of
known documents, in the smallest element that holds nearly all such text.  The model has a fixed number of entries.

Defined cases: null or empty html has an empty text; a page without any
content run has an empty text; repeated rows are alike; malformed pages are
read as browsers do, by implied end tags.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from navlib.llm import html_seeds
from navlib.llm._frames import pick, small_side, stored
from navlib.llm.html_dom import Node, parse

TRAIN_PAGES = 200
#: each sampled page counts as this part of a hand-labelled one
SAMPLE_WEIGHT = 0.1
SMOOTHING = 0.3
ARTICLE_SHARE = 0.9
BROADCAST_BLOCKS = 200_000

# Words in class, id and role names, by what they say.
ROLES: dict[str, str] = {
    "menu": "nav navbar navigation menu menubar topnav breadcrumb breadcrumbs pagination pager toc tabs",
    "header": "header masthead banner topbar heading logo branding top",
    "footer": "footer copyright colophon bottom legal contentinfo",
    "sidebar": "sidebar aside widget widgets related recommend recommended recommendations popular trending rail complementary teaser",
    "notice": "cookie cookies consent notice notices alert gdpr modal popup overlay dialog newsletter subscribe subscription signup paywall message warning",
    "advert": "ad ads advert adverts advertisement advertising adsense adbox sponsor sponsored sponsors promo promotion promoted",
    "form": "form search login register contact feedback",
    "comments": "comment comments commentlist reply replies respond responses disqus discussion",
    "share": "share sharing social follow like tags meta byline",
    "content": "article content post entry story main text body page",
}
# Kinds of elements that hold text runs.
KINDS = {
    "item": "li dt dd",
    "cell": "td th",
    "heading": "h1 h2 h3 h4 h5 h6 summary",
    "paragraph": "p blockquote pre xmp figcaption caption",
    "control": "button label option select legend fieldset form",
}
ROLE_OF = {word: role for role, words in ROLES.items() for word in words.split()}
TAGS = frozenset(
    "root html body div section article main header footer nav aside p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table tr td th"
    " blockquote pre figure figcaption form button select option label fieldset address details".split()
)
_WORD = re.compile("[a-z]+")


def roles(names: str) -> tuple[str, ...]:
    found = {ROLE_OF[w] for w in _WORD.findall(names.lower()) if w in ROLE_OF}
    if len(found) > 1:
        found.discard("content")  # "post-comments", "page-header"
    return tuple(sorted(found)) or ("none",)


KIND_OF = {tag: kind for kind, tags in KINDS.items() for tag in tags.split()}


def _links(node: Node) -> str:
    share = node.linked / node.size if node.size else 0
    return "none" if share == 0 else "some" if share < 0.5 else "most"


def evidence(node: Node) -> tuple[tuple[str, str], ...]:
    """(family, value) of what is seen at a node; values are few and fixed."""
    if node.text is None:
        role = (("role", r) for r in (roles(node.attrs) if node.attrs else ("none",)))
        return (("tag", node.tag if node.tag in TAGS else "other"), ("links", _links(node) if node.size else "empty"), *role)
    words = node.text.count(" ") + 1
    length = "1" if words < 4 else "2" if words < 10 else "3" if words < 25 else "4"
    stop = "sign" if "©" in node.text[:40] else "stop" if node.text[-1] in ".!?:;\"'”»)。" else "open"
    return (("length", KIND_OF.get(node.tag, "other") + length + _links(node)), ("end", stop))


_VALUES = {"tag": len(TAGS) + 1, "role": len(ROLES) + 1, "links": 4, "length": 12 * (len(KINDS) + 1), "end": 3}


def labels(nodes: list[Node], is_content) -> list[int]:
    """1 or 0 for each node: texts by ``is_content``, elements by most of the characters below."""
    weight = [[0, 0] for _ in nodes]
    out = [0] * len(nodes)
    for i in range(len(nodes) - 1, -1, -1):
        node = nodes[i]
        if node.text is not None:
            out[i] = int(is_content(node))
            weight[i][out[i]] += len(node.text)
        else:
            out[i] = int(weight[i][1] > weight[i][0])
        if i:
            up = weight[node.parent]
            up[0] += weight[i][0]
            up[1] += weight[i][1]
    return out


def within_article(nodes: list[Node], known: set[str]) -> set[int]:
    """Text runs that are known lines, in the lowest element with ``ARTICLE_SHARE`` of their characters."""
    size = [len(node.text) if node.text is not None and node.text in known else 0 for node in nodes]
    for i in range(len(nodes) - 1, 0, -1):
        size[nodes[i].parent] += size[i]
    inside, top = set(), 0
    for i in range(1, len(nodes)):  # parents come first
        if nodes[i].parent == top and nodes[i].text is None and size[i] >= ARTICLE_SHARE * size[0]:
            top = i
    holds = [i == top for i in range(len(nodes))]
    for i in range(top + 1, len(nodes)):
        holds[i] = holds[nodes[i].parent]
        if holds[i] and nodes[i].text is not None and nodes[i].text in known:
            inside.add(i)
    return inside


def tally(nodes: list[Node], label: list[int], counts: dict, weight: float) -> None:
    """Add a labelled page to the counts."""
    for i, node in enumerate(nodes):
        y = label[i]
        for family, value in evidence(node):
            counts[family, value, y] += weight
        if i:
            counts["tie", f"{'text' if node.text is not None else 'element'}{label[node.parent]}", y] += weight


class Model:
    """Log potentials from counts."""

    def __init__(self, counts: dict[tuple[str, str, int], float]):
        totals: dict = defaultdict(float)
        for (family, _, y), c in counts.items():
            totals[family, y] += c
        self.counts, self.totals = dict(counts), dict(totals)
        self.seen: dict = {}
        self.tie = {}
        for kind in ("text", "element"):
            table = [[counts.get(("tie", f"{kind}{p}", y), 0) + SMOOTHING for y in (0, 1)] for p in (0, 1)]
            self.tie[kind] = [[c / sum(row) for c in row] for row in table]

    def potential(self, node: Node) -> float:
        """Likelihood of the node's evidence under content, against not."""
        key = evidence(node)
        if key not in self.seen:
            total = 0.0
            for family, value in key:
                y0, y1 = (
                    (self.counts.get((family, value, y), 0) + SMOOTHING) / (self.totals.get((family, y), 0) + SMOOTHING * _VALUES[family])
                    for y in (0, 1)
                )
                total += math.log(y1 / y0)
            self.seen[key] = math.exp(total)
        return self.seen[key]

    def marginals(self, nodes: list[Node]) -> list[float]:
        """Probability of content of every node: messages from the leaves up, then down from the root."""
        n = len(nodes)
        up = [(1.0, 1.0)] * n  # message to the parent, for its label 0 and 1
        low, high = [1.0] * n, [1.0] * n  # evidence times messages from below
        for i in range(n - 1, -1, -1):
            node = nodes[i]
            a, b = low[i], high[i] * self.potential(node)
            s = a + b
            a, b = a / s, b / s
            low[i], high[i] = a, b
            if i:
                t0, t1 = self.tie["text" if node.text is not None else "element"]
                m0, m1 = t0[0] * a + t0[1] * b, t1[0] * a + t1[1] * b
                up[i] = (m0, m1)
                p = node.parent
                x, y = low[p] * m0, high[p] * m1
                s = x + y
                low[p], high[p] = x / s, y / s
        out = [0.0] * n
        down = [(0.5, 0.5)] * n  # belief of the node from above
        for i in range(n):
            node = nodes[i]
            if i:
                p = node.parent
                t0, t1 = self.tie["text" if node.text is not None else "element"]
                # the parent's belief without what this child told it
                a = down[p][0] * low[p] / up[i][0]
                b = down[p][1] * high[p] / up[i][1]
                x, y = a * t0[0] + b * t1[0], a * t0[1] + b * t1[1]
                down[i] = (x / (x + y), y / (x + y))
            a, b = down[i][0] * low[i], down[i][1] * high[i]
            out[i] = b / (a + b)
        return out

    def extract(self, page: str | None) -> str:
        nodes = parse(page)
        marginal = self.marginals(nodes)
        return "\n".join(node.text for node, p in zip(nodes, marginal, strict=True) if node.text is not None and p > 0.5)


def seed_counts() -> dict:
    counts: dict = defaultdict(float)
    for page in html_seeds.pages():
        nodes = parse(page)
        tally(nodes, labels(nodes, lambda node: bool(node.main)), counts, 1.0)
    return counts


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [(html, [node.text for node in parse(html) if node.text is not None]) for html in batch.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.list_(pa.string()))], ["html", "blocks"]
        )


def labelled_pages(pages: DataFrame, documents: DataFrame, n: int = TRAIN_PAGES) -> DataFrame:
    """(html, main): a sample of at most ``n`` pages, by a hash of page_id, with those of their blocks that are lines of documents."""
    rows = pick(pages, page_id="page_id", html="html").where(F.col("html").isNotNull())
    chosen = rows.select("page_id").distinct().orderBy(F.xxhash64("page_id"), "page_id").limit(n)
    sample = stored(rows.join(small_side(chosen, n), "page_id", "left_semi").mapInArrow(_blocks, "html string, blocks array<string>"))
    wanted = small_side(sample.select(F.explode("blocks").alias("block")).distinct(), BROADCAST_BLOCKS)
    line = F.trim(F.regexp_replace("line", r"\s+", " "))
    lines = pick(documents, text="text").select(F.explode(F.split("text", "\n")).alias("line")).select(line.alias("block"))
    known = lines.join(wanted, "block", "left_semi").distinct()
    one = sample.select("html", F.posexplode("blocks").alias("at", "block")).join(known, "block")
    return one.groupBy("html").agg(F.collect_set("block").alias("main"))


def _tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict = defaultdict(float)
    for batch in batches:
        for page, main in zip(batch.column("html").to_pylist(), batch.column("main").to_pylist(), strict=True):
            nodes = parse(page)
            inside = {id(nodes[i]) for i in within_article(nodes, set(main or ()))}
            tally(nodes, labels(nodes, lambda node, inside=inside: id(node) in inside), counts, 1.0)
    rows = [(*key, c) for key, c in counts.items()]
    yield pa.RecordBatch.from_pylist([{"family": f, "value": v, "label": y, "n": c} for f, v, y, c in rows], _COUNTS)


_COUNTS = pa.schema([("family", pa.string()), ("value", pa.string()), ("label", pa.int32()), ("n", pa.float64())])


def train(labelled: DataFrame | None = None, weight: float = SAMPLE_WEIGHT) -> Model:
    """The model from the seed pages and labelled pages (html, main: block texts).

    Only the table of counts comes to the driver, whose keys are a fixed set.
    """
    counts = seed_counts()
    if labelled is not None:
        found = labelled.mapInArrow(_tally, "family string, value string, label int, n double")
        for row in found.groupBy("family", "value", "label").agg(F.sum("n").alias("n")).collect():
            counts[row.family, row.value, row.label] += weight * row.n
    return Model(counts)


def _extract(counts):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(counts.value)
        for batch in batches:
            text = pa.array([model.extract(page) for page in batch.column("html").to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], text], ["page_id", "url", "text"])

    return run


def extract(pages: DataFrame, model: Model) -> DataFrame:
    """Per page: page_id, url, text, n_chars."""
    shared = pages.sparkSession.sparkContext.broadcast(model.counts)
    rows = pick(pages, page_id="page_id", url="url", html="html")
    out = rows.mapInArrow(_extract(shared), "page_id bigint, url string, text string")
    return out.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))


def main_text(pages: DataFrame, documents: DataFrame) -> DataFrame:
    """Train on a labelled sample of ``pages`` and extract all of them."""
    return extract(pages, train(labelled_pages(pages, documents)))
