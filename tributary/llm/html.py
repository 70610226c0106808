"""Main text of web pages by a minimum cut.

A page is read into blocks of text and the containers around them. Every block gets two costs, for being called content and for being
called boilerplate: a logistic classifier over the text (links, length, sentence ends), trained on blocks whose containers say what they are, and a
fixed weight for what the containers say, which a sure classifier and the neighbours can outvote. These costs are capacities to the
two terminals. Neighbouring blocks are joined by an edge, weaker the farther apart they are in the tree, and each block is joined
to its container and each container to the next one, so that a label changes where that is cheap. The minimum cut labels all blocks at once.

Blocks and containers whose own costs outweigh all their edges must take their own side in a minimum cut; they are settled first,
in turn, and their edges become costs of their neighbours. Maximum flow runs on what is left.

Null or empty html gives an empty text. Whole pages are read. A broken or unclosed tag, comment or script ends with the page. Pages are
independent: nothing is shuffled; repeated rows stay repeated, null ids and urls are kept, an empty table gives an empty result. Blocks that cost the
same on both sides count as boilerplate. Other columns are not read.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter, deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import hash_sample, over_batches

#: Words in class, id and role that name boilerplate or content. Fixed values.
BOILERPLATE = frozenset(
    "ad ads adv advert advertisement alert aside banner breadcrumb breadcrumbs comment comments complementary consent contentinfo "
    "cookie cookies dialog discussion disqus foot footer form gdpr header login masthead menu modal nav navbar navigation newsletter "
    "notice overlay pager pagination popup promo promotion rail recommended related replies reply respond search share sidebar "
    "signup skip social sponsor sponsored subscribe toolbar widget".split()
)
CONTENT = frozenset("article articlebody content entry main post story text".split())
LISTED = BOILERPLATE | CONTENT
BAD_TAGS = frozenset("nav header footer aside form menu dialog button select textarea fieldset option label".split())
#: Of those, the ones that hold no page.
ASIDE_TAGS = frozenset(["nav", "footer", "aside"])
GOOD_TAGS = frozenset(["article", "main"])
CONTAINERS = frozenset(
    "html body main article section div nav header footer aside form ul ol dl table figure blockquote details dialog fieldset "
    "menu address button select textarea option label center".split()
)
LEAVES = frozenset(
    "p h1 h2 h3 h4 h5 h6 li dt dd tr td th pre figcaption caption summary legend thead tbody tfoot br hr".split()
)
#: Elements whose inside is not text of the page. A head needs no end tag and holds no text but in these; formulas and what stands in
#: object, canvas, audio or video for browsers that cannot show those are text, the source code of a formula is not.
HIDDEN = frozenset("script style title noscript template iframe svg annotation annotation-xml".split())
#: Elements that stand between words.
SHOWN = frozenset("object canvas audio video".split())

TAG = re.compile(
    r"<(?:!--.*?(?:-->|\Z)|(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|[!?][^>]*(?:>|\Z)|/?[a-zA-Z][^>]*(?:>|\Z))", re.S
)
ATTRIBUTE = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)

#: Of those, the ones whose articles are other people's.
REPLIES = frozenset("comment comments discussion disqus recommended related replies reply respond".split())
#: Words of a compound that say nothing about its content, and such that make it speak of something else ("has-sidebar").
NEUTRAL = frozenset("area block body box container group inner item list outer section wrap wrapper".split())
MODIFIERS = frozenset("disable disabled enable enabled has hide hidden is js no open show toggle with without".split())
#: What a tag, a class, id or role of listed words, and one with other words in it ("has-sidebar") are worth against the
#: classifier, whose part is at most LIMIT; weights of edges. The text alone can outvote the words of a wrapper,
#: text and edges its tag.
TAGGED, WORDED, HINTED, LIMIT, BESIDE, INSIDE, ABOVE = 3.5, 2.5, 1.5, 3.0, 1.0, 0.5, 0.25
#: What a boilerplate name is worth on an element that is no layout wrapper: more than text and edges together.
FIRM = LIMIT + 2 * BESIDE + INSIDE + 0.5
#: Blocks further apart than so many steps in the tree have no edge.
FAR = 64
#: Pages and blocks that the classifier is trained on.
PAGES, BLOCKS = 2_000, 100_000


class Page:
    """blocks: (text, container, characters in links, what its tags say: above 0 for content); up: container -> its container."""

    def __init__(self, source: str) -> None:
        self.blocks: list[tuple[str, int, int, float]] = []
        self.up, self.depth = [0], [0]
        said, firm, names, stack = [0.0], [False], [""], [0]
        listed, holds, opened = [0], [0], Counter()
        parts: list[str] = []
        leaf = 0.0
        linked = at = 0
        link = False

        def close() -> None:
            nonlocal parts, linked
            if parts:
                text = " ".join("".join(parts).split())
                if text:
                    self.blocks.append((text, stack[-1], min(linked, len(text)), leaf or said[stack[-1]]))
                parts, linked = [], 0

        find, end = TAG.search, len(source)
        while at < end:
            m = find(source, at)
            stop = m.start() if m else end
            if stop > at:
                piece = source[at:stop]
                if "&" in piece:
                    piece = html.unescape(piece)
                parts.append(piece)
                if link:
                    linked += len(piece.strip())
            if not m:
                break
            at, name = m.end(), m[2]
            if name is None:
                continue
            name, closing = name.lower(), bool(m[1])
            if name == "a":
                link = not closing
            elif name in CONTAINERS:
                close()
                leaf, link = 0.0, False
                if closing:
                    if opened[name]:  # else there is nothing to close
                        while names[stack[-1]] != name:
                            opened[names[stack.pop()]] -= 1
                        stack.pop()
                        opened[name] -= 1
                else:
                    here = stack[-1]
                    self.up.append(here)
                    self.depth.append(self.depth[here] + 1)
                    says, keeps, boilerplate = cue(name, m[3], said[here], firm[here])
                    said.append(says)
                    firm.append(keeps)
                    listed.append(boilerplate)
                    holds.append(0)
                    names.append(name)
                    stack.append(len(self.up) - 1)
                    opened[name] += 1
                    kind = 2 if name == "main" else 1 if name == "article" else 0
                    while holds[here] < kind:  # every container is raised twice at most
                        holds[here] = kind
                        here = self.up[here]
            elif name in LEAVES:
                close()
                says, _, boilerplate = (0.0, False, 0) if closing or not m[3] or name == "br" else cue(name, m[3], 0.0, False)
                leaf = -FIRM if boilerplate else min(0.0, says)
            elif name in SHOWN:
                parts.append(" ")
            elif name in HIDDEN and not closing and not m[3].endswith("/"):
                over = re.compile(rf"</{re.escape(name)}\b[^>]*(?:>|\Z)", re.I).search(source, at)
                at = over.end() if over else end
        close()
        self.hold_firm(listed, holds)

    def hold_firm(self, listed: list[int], holds: list[int]) -> None:
        """Boilerplate names and tags on what is no layout wrapper cannot be outvoted.

        A wrapper holds an `article` or `main`, or, on a page without any, over half of the text. Replies, asides, menus and
        footers are no wrapper unless they hold a `main`.
        """
        inside = [0] * len(self.up)
        for text, container, _, _ in self.blocks:
            inside[container] += len(text)
        for c in range(len(self.up) - 1, 0, -1):
            inside[self.up[c]] += inside[c]
        strong = [False] * len(self.up)
        for c in range(1, len(self.up)):
            wrapper = holds[c] == 2 if listed[c] == 2 else holds[c] > 0 or (not holds[0] and 2 * inside[c] > inside[0])
            strong[c] = strong[self.up[c]] or (listed[c] > 0 and not wrapper)
        self.blocks = [(t, c, n, -FIRM if strong[c] else says) for t, c, n, says in self.blocks]


def cue(name: str, attributes: str, outer: float, firm: bool) -> tuple[float, bool, int]:
    """What a container says of its text, whether that holds for the articles in it, given both of the one around it, and whether
    its own tag and names are boilerplate: 1, or 2 if that holds for articles in it, too.

    Boilerplate keeps what is inside it, save `main`; an `article` leaves the boilerplate of a class, id or role again, unless that
    holds replies. A hint gives way to any other word.
    """
    if name in ("html", "body"):
        return 0.0, False, 0
    good, bad, replies = words_said(attributes)
    replies = replies and good < WORDED
    listed = 2 if replies else int(bad >= WORDED > good)
    if name in BAD_TAGS and not (name in ("header", "label") and outer > 0):
        return -TAGGED, name != "form", 2 if name in ASIDE_TAGS else max(listed, 1)
    if name == "main":
        return TAGGED, False, 0
    if outer < 0 and firm:
        return outer, True, listed
    if replies:
        return -WORDED, True, 2
    if name == "article":
        return (-WORDED if listed else TAGGED), False, listed
    if listed:
        return -WORDED, False, 1
    if good >= WORDED > bad:
        return (outer if outer <= -WORDED else max(outer, WORDED)), False, 0
    if bad:
        return min(outer, -HINTED), False, 0
    return (outer if outer < 0 else max(outer, good)), False, 0


def words_said(attributes: str) -> tuple[float, float, bool]:
    """How much a tag's class, id and role speak for content and for boilerplate, and whether they name replies.

    A name of listed and neutral words counts in full ("cookie-notice", "footer-wrapper"), and so does a compound whose last part is
    listed ("site-footer"). One with a modifier ("has-sidebar") or other words behind is a hint, and so is the header of a
    listed kind of content ("entry-header"), which may hold the title.
    """
    good = bad = 0.0
    replies = False
    if attributes and "=" in attributes:
        for m in ATTRIBUTE.finditer(attributes):
            for name in (m[1] or m[2] or m[3] or "").lower().split():
                parts = [x for x in re.split(r"[^a-z0-9]+", name) if x]
                words = set(parts)
                if not words & LISTED:
                    continue
                whole = words <= LISTED | NEUTRAL
                worth = WORDED if not words & MODIFIERS and (whole or parts[-1] in LISTED) else HINTED
                if words & BOILERPLATE == {"header"} and words & CONTENT:
                    worth = HINTED
                if words & BOILERPLATE if whole or worth == HINTED else parts[-1] in BOILERPLATE:
                    bad = max(bad, worth)
                    replies = replies or (worth == WORDED and bool(words & REPLIES))
                else:
                    good = max(good, worth)
    return good, bad, replies


def features(page: Page) -> np.ndarray:
    """Of each block's text alone: share of links, length, sentence end, words, a constant."""
    rows = []
    for text, _, linked, _ in page.blocks:
        words = text.count(" ") + 1
        rows.append((linked / len(text), math.log1p(len(text)), text[-1] in ".!?…:;\"'", math.log1p(words), 1.0))
    return np.array(rows, float).reshape(-1, 5)


# --- minimum cut -----------------------------------------------------------


def edges_of(page: Page) -> Iterator[tuple[int, int, float]]:
    """Edges between blocks 0.. and, after them, containers."""
    n = len(page.blocks)
    for i in range(n):
        a = page.blocks[i][1]
        yield i, n + a, INSIDE
        if i and (steps := steps_between(page, page.blocks[i - 1][1], a)) <= FAR:
            yield i - 1, i, BESIDE / (1 + steps)
    for c in range(1, len(page.up)):
        yield n + c, n + page.up[c], ABOVE


def steps_between(page: Page, a: int, b: int) -> int:
    """Steps in the tree from container to container, counted to FAR + 1."""
    count = 0
    while a != b and count <= FAR:
        if page.depth[a] < page.depth[b]:
            a, b = b, a
        a = page.up[a]
        count += 1
    return count


def minimum_cut(gain: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Which nodes are on the source side. gain: cost of the sink side less cost of the source side."""
    gain, near = list(gain), [{} for _ in gain]
    for a, b, w in edges:
        near[a][b] = near[a].get(b, 0.0) + w
        near[b][a] = near[b].get(a, 0.0) + w
    total = [sum(x.values()) for x in near]
    side: list[bool | None] = [None] * len(gain)
    queue = deque(range(len(gain)))
    while queue:
        v = queue.popleft()
        if side[v] is not None or abs(gain[v]) < total[v] - 1e-12 or (gain[v] == 0 and total[v] > 0):
            continue
        side[v] = gain[v] > 0
        for u, w in near[v].items():
            if side[u] is None:
                gain[u] += w if side[v] else -w
                total[u] -= w
                queue.append(u)
    rest = [v for v, s in enumerate(side) if s is None]
    if rest:
        number = {v: k for k, v in enumerate(rest)}
        inner = [(number[a], number[b], w) for a in rest for b, w in near[a].items() if a < b and b in number]
        for v, s in zip(rest, max_flow_side([gain[v] for v in rest], inner)):
            side[v] = s
    return [bool(s) for s in side]


def max_flow_side(gain: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Dinic's maximum flow; the nodes that the source still reaches."""
    n = len(gain)
    source, sink = n, n + 1
    to, room, out = [], [], [[] for _ in range(n + 2)]

    def add(a: int, b: int, there: float, back: float) -> None:
        for x, y, w in ((a, b, there), (b, a, back)):
            out[x].append(len(to))
            to.append(y)
            room.append(w)

    for v, g in enumerate(gain):
        if g > 0:
            add(source, v, g, 0.0)
        elif g < 0:
            add(v, sink, -g, 0.0)
    for a, b, w in edges:
        add(a, b, w, w)
    while True:
        level = [-1] * (n + 2)
        level[source], queue = 0, deque([source])
        while queue:
            v = queue.popleft()
            for e in out[v]:
                if room[e] > 1e-12 and level[to[e]] < 0:
                    level[to[e]] = level[v] + 1
                    queue.append(to[e])
        if level[sink] < 0:
            return [level[v] >= 0 for v in range(n)]
        following, path, v = [0] * (n + 2), [], source
        while True:
            if v == sink:
                flow = min(room[e] for e in path)
                for e in path:
                    room[e] -= flow
                    room[e ^ 1] += flow
                k = next(k for k, e in enumerate(path) if room[e] <= 1e-12)
                v = to[path[k] ^ 1]
                del path[k:]
            while following[v] < len(out[v]):
                e = out[v][following[v]]
                if room[e] > 1e-12 and level[to[e]] == level[v] + 1:
                    break
                following[v] += 1
            if following[v] < len(out[v]):
                path.append(out[v][following[v]])
                v = to[path[-1]]
            elif v == source:
                break
            else:
                level[v] = -1
                v = to[path.pop() ^ 1]


def labels(page: Page, weights: np.ndarray) -> list[bool]:
    """True for the blocks that are content."""
    text = np.clip(features(page) @ weights, -LIMIT, LIMIT)
    gain = [float(g) + block[3] for g, block in zip(text, page.blocks)]
    return minimum_cut(gain + [0.0] * len(page.up), list(edges_of(page)))[: len(page.blocks)]


def main_text(source: str, weights: np.ndarray) -> str:
    page = Page(source)
    return " ".join(block[0] for block, kept in zip(page.blocks, labels(page, weights)) if kept)


# --- tables ----------------------------------------------------------------


def train(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights of a logistic regression with a small square penalty, by Newton steps; zeros without both kinds.

    Both kinds count the same in all, so that the text does not repeat what the cues say by being frequent.
    """
    w = np.zeros(5)
    if not len(y) or y.min() == y.max():
        return w
    share = np.where(y > 0, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (share * (y - p)) - w
        curve = (x * (share * p * (1 - p))[:, None]).T @ x + np.eye(5)
        step = np.linalg.solve(curve, slope)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(pages: DataFrame, html_col: str = "html") -> np.ndarray:
    """Weights from at most PAGES different pages (smallest hash of the html) and BLOCKS blocks of them (smallest hash of page and place)."""
    names = ["f0", "f1", "f2", "f3", "f4"]

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        for number, source in zip(batch.column(0), batch.column(1)):
            page = Page(source.as_py())
            said = np.array([b[3] for b in page.blocks], float)
            plain = np.abs(said) >= WORDED
            x, y = features(page)[plain], (said[plain] > 0).astype(float)
            place = {"page": np.full(len(y), number.as_py()), "place": np.flatnonzero(plain)}
            yield {**place, **{n: x[:, k] for k, n in enumerate(names)}, "y": y}

    some = hash_sample(pages.where(F.col(html_col).isNotNull()).select(F.col(html_col).alias("h")), PAGES)
    numbered = some.select(F.xxhash64("h").alias("page"), "h")
    given = over_batches(numbered, run, "page long, place long, " + ", ".join(f"{n} double" for n in [*names, "y"]))
    got = hash_sample(given, BLOCKS).select(*names, "y").toPandas().to_numpy(float)
    return train(got[:, :5], got[:, 5])


def extract(
    pages: DataFrame, weights: np.ndarray, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """One row per page: id, url, text."""
    kind = pages.schema[id_col].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        texts = [main_text(h.as_py(), weights) for h in batch.column(2)]
        yield {"id": batch.column(0), "url": batch.column(1), "text": texts}

    source = F.coalesce(F.col(html_col), F.lit("")).alias("h")
    given = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), source)
    return over_batches(given, run, f"id {kind}, url string, text string")
