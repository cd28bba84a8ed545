"""Main text of web pages by tag-path ratios.

Every text node has a path: the tags from the root down to it. For each path the length of its text
and its punctuation marks are added up and divided by its nodes. Both ratios are smoothed over
neighbouring text nodes, fused into one score, and the nodes whose score reaches a share of the page's
spread are content nodes. The answer is the text of all containers that hold content nodes themselves, and
of the smallest one around most of their weight (an article or main element at most), so that no content
node is lost and short paragraphs between long ones stay.

Elements that HTML itself sets apart (nav, footer, script, ...) are left out, and so are those whose class,
id and role tell of nothing but such a part (comments, ad-slot), and forms without
headings and paragraphs. Other forms, and elements whose names tell of it
among other things (search-result), are in doubt: their scores count a tenth, and one goes only if less than
half of its words still belong to content nodes. There is no doubt about elements around an article or main
element, nor, on a page without these, about one with most of the words where next to nothing would be left
without it.

Null or empty html, or a page without content, gives an empty text. Nothing is cut, however long. Time and
memory grow with the page, not with the depth of its tags; end tags without a start are passed over.
Repeated rows are extracted one by one; null page_id and url stay null; other columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of HTML: elements without end tag, with raw text, and those that end a line of text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp template svg math".split())
BLOCK = frozenset(
    "address article aside blockquote body caption dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol optgroup option p pre section summary table tbody td "
    "tfoot th thead tr ul".split()
)
#: Start tags that end an open element of these kinds.
CLOSES = {
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "tr": {"tr", "td", "th"},
    "td": {"td", "th"},
    "th": {"td", "th"},
    "option": {"option"},
}
#: Where the search for an element to end stops.
SCOPES = frozenset("html body article aside div footer form header main nav section table ul ol dl td th blockquote".split())
CONTAINERS = frozenset("html body div section td tr tbody table center blockquote".split())
ROOTS = frozenset(["article", "main"])
#: Elements that hold no content, and names of classes, ids and roles that often do not.
NO_CONTENT = frozenset(
    "head nav footer aside script style noscript template iframe button select textarea input dialog menu svg math "
    "canvas object title xmp".split()
)
DOUBTED_TAGS = frozenset(["form"])
WRITTEN = frozenset("p h1 h2 h3 h4 h5 h6".split())
DOUBTED_NAMES = re.compile(
    r"ads?|advert\w*|adsense|sponsor\w*|promo\w*|banner|cookies?|consent|gdpr|notice|alert|modal|popup|overlay|"
    r"nav|navbar|navigation|menu|breadcrumbs?|sidebar|side|aside|footer|foot|masthead|topbar|toolbar|widget|"
    r"comments?|replies|reply|disqus|respond|share|sharing|social|related|recommended|newsletter|subscribe|signup|"
    r"login|search|pagination|pager|skip"
)
#: Names that begin like this tell of a part elsewhere: no-sidebar, has-sidebar, with-nav.
ABOUT_OTHERS = frozenset("no not has have with without".split())
#: Parts of names that say nothing of the content.
PLAIN_PARTS = frozenset("area block body box button col column container content inner left link links list main outer right row section slot top wrap wrapper".split())
TAG = r"(/?)([a-zA-Z][^\s/<>]*)"
#: A comment, a declaration, a tag (with quotes in order, else up to its end), text, or a sign that opens nothing.
TOKEN = re.compile(
    rf"<!--.*?(?:-->|$)|<[!?][^>]*>|<{TAG}((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>|<{TAG}([^<>]*)>|[^<]+|<", re.S
)
NAMES = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
PUNCTUATION = re.compile(r"[.,;:!?…。、，！？；：¡¿«»„“”]")

#: Spread of the smoothing over neighbouring nodes, share of the mean score that a content node reaches,
#: and share of the weight that the container kept as a whole must hold.
SMOOTHING = 1.0
THRESHOLD = 0.3
CONTAINER_SHARE = 0.75
#: What the score of a doubted part counts, and the share of words outside of doubted parts that is next to nothing.
DOUBT = 0.1
NEXT_TO_NOTHING = 0.1


class Page:
    """Elements in page order, so that parents come before children, and the text nodes outside of silent ones."""

    def __init__(self) -> None:
        self.tag, self.parent, self.path = [""], [-1], [0]
        self.silent, self.rooted, self.doubted = [False], [False], [0]
        self.paths: dict[tuple[int, str], int] = {}
        #: (element, decoded text, block); nodes of one block are one line.
        self.nodes: list[tuple[int, str, int]] = []

    def add(self, tag: str, parent: int, attributes: str) -> int:
        rooted = self.rooted[parent] or tag in ROOTS
        # A header of an article belongs to it.
        silent = self.silent[parent] or tag in NO_CONTENT or (tag == "header" and not rooted)
        named = name_doubt(attributes) if attributes and tag not in ROOTS and tag not in ("html", "body") else 0
        self.tag.append(tag)
        self.parent.append(parent)
        self.path.append(self.paths.setdefault((self.path[parent], tag), len(self.paths) + 1))
        self.silent.append(silent)
        self.rooted.append(rooted)
        self.doubted.append(max(named, int(tag in DOUBTED_TAGS)))
        return len(self.tag) - 1

    def sums(self, values: list[float]) -> list[float]:
        """Values of elements with those of all elements inside."""
        out = list(values)
        for e in range(len(out) - 1, 0, -1):
            out[self.parent[e]] += out[e]
        return out


def name_doubt(attributes: str) -> int:
    """2 if the names of an element tell of nothing but a part without content, 1 if among other things, else 0."""
    kinds = set()
    for quoted, single, bare in NAMES.findall(attributes):
        for name in (quoted or single or bare).lower().split():
            parts = [p for p in re.split("[-_]+", name) if p]
            listed = [bool(DOUBTED_NAMES.fullmatch(p)) for p in parts]
            if not any(listed) or parts[0] in ABOUT_OTHERS:
                kinds.add(0)
            else:
                kinds.add(2 if all(x or p.isdigit() or p in PLAIN_PARTS for x, p in zip(listed, parts)) else 1)
    return 2 if kinds == {2} else 1 if kinds & {1, 2} else 0


def parsed(source: str) -> Page:
    page = Page()
    at, block, pos, size = 0, 0, 0, len(source)
    open_: Counter[str] = Counter()

    def leave(upto: int) -> int:
        """Close all open elements up to and with this one."""
        nonlocal at
        while at != upto:
            open_[page.tag[at]] -= 1
            at = page.parent[at]
        open_[page.tag[at]] -= 1
        return page.parent[at]

    while pos < size:
        token = TOKEN.match(source, pos)
        if token is None:
            break
        pos = token.end()
        ends, name, attributes = token.groups()[:3] if token.group(2) else token.groups()[3:]
        if name is None:
            if (token.group()[0] != "<" or token.group() == "<") and not page.silent[at]:
                page.nodes.append((at, html.unescape(token.group()), block))
            continue
        tag = name.lower()
        if tag in BLOCK:
            block += 1
        if ends:
            if open_[tag] > 0:
                up = at
                while page.tag[up] != tag:
                    up = page.parent[up]
                at = leave(up)
        elif tag == "br":
            if not page.silent[at]:
                page.nodes.append((at, " ", block))
        elif tag in VOID:
            continue
        elif tag in RAW:
            end = re.compile(rf"</{tag}\s*>", re.I).search(source, pos)
            pos = end.end() if end else size
        else:
            closed = CLOSES.get(tag, frozenset())
            if tag in BLOCK:
                closed = {*closed, "p"}
            if any(open_[c] > 0 for c in closed):
                up = at
                while up and page.tag[up] not in closed and page.tag[up] not in SCOPES - closed:
                    up = page.parent[up]
                if up and page.tag[up] in closed:
                    at = leave(up)
            if not attributes.rstrip().endswith("/") or tag in BLOCK:
                at = page.add(tag, at, attributes)
                open_[tag] += 1
    return page


def node_scores(page: Page) -> np.ndarray:
    """Smoothed and fused ratios of text and punctuation per tag path, for each node."""
    lengths = np.array([len("".join(t.split())) for _, t, _ in page.nodes], dtype=float)
    marks = np.array([len(PUNCTUATION.findall(t)) for _, t, _ in page.nodes], dtype=float)
    _, path = np.unique([page.path[e] for e, _, _ in page.nodes], return_inverse=True)
    full = np.bincount(path, lengths > 0)
    text_ratio = (np.bincount(path, lengths) / np.maximum(full, 1))[path]
    mark_ratio = (np.bincount(path, marks) / np.maximum(full, 1))[path]
    kernel = np.exp(-0.5 * (np.arange(-2, 3) / SMOOTHING) ** 2)
    kernel /= kernel.sum()

    def smooth(x: np.ndarray) -> np.ndarray:
        return np.convolve(np.pad(x, 2, mode="edge"), kernel, mode="valid")

    return smooth(text_ratio) * (1 + smooth(mark_ratio)) * (lengths > 0)


def without_named_parts(page: Page) -> None:
    """Leave out what lies in parts named as such; none of them is around an article or main element."""
    inside = page.sums([1.0 if t in ROOTS else 0.0 for t in page.tag])
    page.doubted = [0 if r else d for d, r in zip(page.doubted, inside)]
    # A form without headings and paragraphs is nothing but a form.
    written = page.sums([1.0 if t in WRITTEN else 0.0 for t in page.tag])
    gone = [d == 2 or (t in DOUBTED_TAGS and not (r or w)) for d, t, r, w in zip(page.doubted, page.tag, inside, written)]
    for e in range(1, len(gone)):
        gone[e] = gone[e] or gone[page.parent[e]]
    page.nodes = [node for node in page.nodes if not gone[node[0]]]


def doubted_parts(page: Page, words: list[float]) -> list[int]:
    """For each element the outermost doubted one around it, or -1."""
    n = len(page.tag)
    doubted = [d == 1 for d in page.doubted]
    weight = page.sums(words)
    total = weight[0]
    # Words of doubted parts inside an element, and of the element if it is one.
    within, covered = [0.0] * n, [0.0] * n
    for e in range(n - 1, -1, -1):
        covered[e] = weight[e] if doubted[e] else within[e]
        if e:
            within[page.parent[e]] += covered[e]
    certain = total - covered[0]
    declared = any(t in ROOTS and w > 0 for t, w in zip(page.tag, weight))
    # Elements with most of the words lie inside of each other.
    for e in range(n):
        if declared or certain >= NEXT_TO_NOTHING * total:
            break
        if doubted[e] and weight[e] > total / 2:
            certain += weight[e] - within[e]
            doubted[e] = False
    outer = [-1] * n
    for e in range(1, n):
        up = outer[page.parent[e]]
        outer[e] = up if up >= 0 else e if doubted[e] else -1
    return outer


def main_text(source: str | None) -> str:
    page = parsed(source or "")
    without_named_parts(page)
    if not any(t.strip() for _, t, _ in page.nodes):
        return ""
    n, elements = len(page.tag), np.array([e for e, _, _ in page.nodes])
    words = np.array([len(t.split()) for _, t, _ in page.nodes], dtype=float)
    outer = np.array(doubted_parts(page, np.bincount(elements, words, n).tolist()))[elements]
    scores = node_scores(page)
    certain = (outer < 0) & (scores > 0)
    usual = scores[scores > 0].mean()
    bar = THRESHOLD * (scores[certain].mean() if certain.any() else usual)
    content = np.where(outer < 0, scores >= bar, DOUBT * scores >= THRESHOLD * usual)
    # A doubted part stays or goes as a whole.
    part = np.maximum(outer, 0)
    stays = 2 * np.bincount(part, words * content, n) >= np.bincount(part, words, n)
    seen = (outer < 0) | stays[part]
    content &= seen
    weight = page.sums(np.bincount(elements, words * content, n).tolist())
    children: list[int] = [-1] * n  # the one with the most weight
    for e in range(1, n):
        heaviest = children[page.parent[e]]
        if heaviest < 0 or weight[e] > weight[heaviest]:
            children[page.parent[e]] = e
    root = 0
    while page.tag[root] not in ROOTS:
        best = children[root]
        if best < 0 or page.tag[best] not in CONTAINERS | ROOTS or weight[best] < CONTAINER_SHARE * weight[0]:
            break
        root = best
    inside, holder = [root == 0] * n, [0] * n
    for e in range(1, n):
        inside[e] = e == root or inside[page.parent[e]]
        holder[e] = e if page.tag[e] in CONTAINERS | ROOTS else holder[page.parent[e]]
    holders = {holder[e] for (e, _, _), chosen in zip(page.nodes, content) if chosen}
    blocks: dict[int, list[str]] = {}
    for (e, text, block), shown in zip(page.nodes, seen):
        if shown and (inside[e] or holder[e] in holders):
            blocks.setdefault(block, []).append(text)
    lines = (" ".join("".join(parts).split()) for parts in blocks.values())
    return "\n".join(line for line in lines if line)


def extract_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h) for h in batch.column(2).to_pylist()]
            sizes = pa.array([len(t) for t in texts], pa.int64())
            columns = [batch.column(0), batch.column(1), pa.array(texts, pa.string()), sizes]
            yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])

    rows = pages.select("page_id", F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    page_type = pages.schema["page_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"page_id {page_type}, url string, text string, n_chars long")
