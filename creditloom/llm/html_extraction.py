"""Main text of web pages by a tree-structured graphical model.

The block elements of a page and its runs of text form a tree of nodes with two states, content or not. A node has
a potential from its tag, the words of its class, id and role, its length and share of links; a child has a potential
with its parent. Both are trained by counting on labelled pages. Messages passed from the leaves to the root and back
(the sum-product algorithm) give every node's marginal; text whose marginal for content is at least one half stays.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import rows_of

# Elements by their part in a page, and words of class, id and role by what they hint at.
RAW = frozenset("script style title textarea iframe noembed noframes".split())
DROPPED = frozenset("head template noscript svg object canvas audio video select datalist optgroup option button".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
BLOCKS = frozenset(
    "html body article main section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption "
    "blockquote pre figure figcaption address details summary nav header footer aside form fieldset menu dialog ins center".split()
)
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
WALLS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"}}
HINTS = {
    "ad": "ad ads advert adverts advertisement advertising adsense adsbygoogle sponsor sponsored promo promotion",
    "notice": "cookie cookies consent notice notices gdpr popup modal newsletter subscribe alert paywall",
    "comment": "comment comments respond reply replies disqus discussion",
    "side": "sidebar aside related recommended widget widgets more teaser",
    "menu": "nav navigation menu navbar breadcrumb breadcrumbs toolbar pagination pager",
    "edge": "header footer masthead copyright legal topbar contentinfo banner",
    "share": "share sharing social follow",
    "form": "form search login signup",
    "main": "article content main post entry story body text",
}
_HINT_OF = {word: hint for hint, words in HINTS.items() for word in words.split()}
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

# Pages to learn from: the attribute ``label`` says whether an element and what it holds is content.
LABELLED = (
    '<html><body><nav><ul><li><a>Home</a></li><li><a>News</a></li><li><a>About us</a></li></ul></nav><div class="ad">Buy two and get one for free this week.</div><article label="1"><h1>Rain is on its way</h1><p>The rain that fell in the north will reach the coast by the end of the week.</p><p>Take a coat.</p><p>Farmers say that they have waited for it since spring and hope for more.</p></article><footer>Printed in town. All rights reserved.</footer></body></html>',
    '<html><body><header><h1>The Daily</h1><p>News since the year of the flood</p></header><main label="1"><h1>A bridge</h1><p>It took four years to build the bridge, and it was opened on Monday by the mayor.</p><ul><li>It is long.</li><li>It is made of steel and of stone.</li></ul><aside class="sidebar" label="0"><h2>Read also</h2><p>Ten bridges that you should have seen before you are old.</p></aside><p>Traffic starts today.</p></main><footer><p>Write to us at the usual address.</p></footer></body></html>',
    '<html><body><div class="menu"><ul><li><a>One</a></li><li><a>Two</a></li></ul></div><div id="content" label="1"><h2>Bread</h2><p>Mix the flour with water and let it rest for an hour in a warm place.</p><blockquote><p>Good bread needs time, as my mother used to say.</p></blockquote><p>Bake it.</p><div class="share" label="0">Share this with all your friends</div></div><div class="comments"><h3>Comments</h3><div class="comment"><p>I have tried this and it was the best bread I ever had, thank you.</p></div><div class="comment"><p>Mine is flat.</p></div></div><div class="footer">About this site</div></body></html>',
    '<html><body><div class="cookie-notice"><p>We use cookies to make this site better for you and for our partners.</p></div><article label="1"><header><h1>Old clocks</h1></header><section><h2>Springs</h2><p>A spring drives the clock and has to be wound every week by hand.</p></section><section><p>Weights do the same.</p><pre>tick tock</pre><table><tr><td>Year</td><td>Maker</td></tr></table></section><section class="comments" label="0"><h2>Readers</h2><p>My clock has stopped, and nobody in this town can mend it any more.</p></section></article><form><label>Search</label></form><aside><p>Our newest watches are shown here every single day of the year.</p></aside></body></html>',
    '<html><body><p label="1">A page of plain paragraphs has nothing around them, and all of them belong to the text.</p><p label="1">There are few of these pages left.</p><div class="newsletter"><p>Get our letter every morning with all that you need to know about the day.</p></div></body></html>',
    '<html><body><div><div class="navbar"><a>Start</a><a>End</a></div></div><div><div class="post" label="1"><h1>Walking</h1><p>I walked for nine days along the river and met a man with a blue dog.</p><figure><figcaption>The dog</figcaption></figure><p>It barked.</p><div class="ad" label="0"><p>Shoes for long walks at half the price, only in our shop.</p></div><p>Then we went home by train, which was late.</p></div></div><div class="sidebar"><ul><li><a>Older</a></li></ul><p>This writer lives by the sea and has three cats and a boat.</p></div></body></html>',
    '<html><body><article label="1"><h1>Salt</h1><p>Salt was once worth its weight in gold along the road to the south.</p><div class="related" label="0"><h3>More</h3><ul><li><a>Pepper and its history</a></li></ul></div><nav label="0"><a>Next page</a></nav><p>Today it is cheap.</p><footer label="0"><p>Filed under spices, by the desk for food and for drink.</p></footer><form label="0"><p>Leave your address and we will send you a box of salt.</p></form></article></body></html>',
    '<html><body><div class="page"><div class="topbar"><p>Free delivery on every order until the end of the month.</p></div><div class="entry-content" label="1"><p>Short.</p><h3>Why</h3><ol><li>Because the wind turns in the evening and the boats come back.</li><li>So.</li></ol><dl><dt>Sail</dt><dd>A sheet that catches the wind.</dd></dl><details><summary>Note</summary><p>See <a>this old map</a> of the bay.</p></details></div><dialog class="popup"><p>Please sign in to read on, it takes you less than a minute.</p></dialog><section id="comments"><article class="comment"><p>The wind does not turn where I live, whatever you say about boats.</p></article><form class="comment-form"><p>Your reply</p></form></section><div class="related"><p>Five harbours that are worth a visit in summer and in winter.</p></div><menu><li><a>Map</a></li><li>Help</li></menu></div></body></html>',
    '<html><body><header class="site-header"><p>The paper that is read on both sides of the river.</p></header><nav><p>You are here</p></nav><main label="1"><article><h1>Ice</h1><p>Ice.</p><div><p>The lake froze over in one night and the children went out at once.</p></div></article></main><div class="login-form"><p>Sign in</p></div><div id="sidebar"><h2>Weather</h2><p>Cold and dry, with light wind from the east in the afternoon.</p></div><div id="footer"><p>Terms of use and all the rest of it can be found below.</p></div></body></html>',
    '<html><body><div><div><h1 label="1">Stone walls</h1><p label="1">A wall without mortar stands for a hundred years if its builder was patient.</p><p label="1">Some <a>walls</a> are older.</p></div></div><footer><p>Made by hand in the hills, as everything that we make.</p></footer></body></html>',
)


class _Left:
    """An open element that is left out: its tag, the open blocks around it, the one around it that is left out too."""

    __slots__ = ("tag", "depth", "outer", "closed", "blocks")

    def __init__(self, tag: str, depth: int, outer: "_Left | None"):
        self.tag, self.depth, self.outer, self.closed, self.blocks = tag, depth, outer, False, False


class Tree(HTMLParser):
    """Block elements and runs of text in page order; ``parents`` come before their children.

    Raw text (scripts, styles and the like) ends at its own end tag only, as in a browser. Other elements that are
    left out end with their parent at the latest. One that has its end tag is left out whole; one that never gets it
    holds no more than the text up to the next block. Time is linear in the page for blocks nested at any depth.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        # While a page is read: parent, features or pieces of text, label and the open elements left out.
        self._nodes: list[tuple] = [(-1, ("tag=root",), 0, None)]
        self._stack, self._open = [(0, "")], Counter()
        self._raw, self._left, self._all_left, self._inline, self._text = None, None, [], [], []

    def _flush(self) -> None:
        if self._text:
            self._nodes.append((self._stack[-1][0], self._text, None, None))
            self._text = []

    def _cut(self, at: int) -> None:
        """Close the blocks from ``at`` on, and what was left out inside them."""
        self._open.subtract(tag for _, tag in self._stack[at:])
        del self._stack[at:]
        while self._left and self._left.depth > at:
            self._end_left()

    def _end_left(self) -> None:
        self._open[self._left.tag] -= 1
        self._left = self._left.outer

    def _close_left(self, tag: str) -> None:
        """The end tag of an element that is left out: it goes with all it holds."""
        if not self._open[tag]:
            return
        while self._left.tag != tag:
            self._end_left()
        if len(self._stack) > self._left.depth:
            self._flush()
            self._cut(self._left.depth)
        self._left.closed = True
        self._end_left()

    def handle_starttag(self, tag, attrs):
        if self._raw:
            return
        if tag in RAW:
            self._raw = tag
        elif tag in DROPPED:
            if tag in ("option", "optgroup") and self._left and self._left.tag == "option":
                self._close_left("option")
            self._left = _Left(tag, len(self._stack), self._left)
            self._all_left.append(self._left)
            self._open[tag] += 1
        elif tag == "br":
            self._text.append((" ", False, None))
        elif tag == "hr":
            self._flush()
        elif tag in BLOCKS:
            self._block(tag, attrs)
        elif tag not in VOID:
            self._inline.append(tag)

    def _block(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self._flush()
        left = self._left
        while left and not left.blocks:
            left.blocks, left = True, left.outer
        floor = self._left.depth if self._left else 1
        if len(self._stack) > floor and self._stack[-1][1] == "p":
            self._cut(len(self._stack) - 1)
        if any(self._open[t] for t in CLOSED_BY.get(tag, ())):
            for at in range(len(self._stack) - 1, floor - 1, -1):
                if self._stack[at][1] in CLOSED_BY[tag]:
                    self._cut(at)
                    break
                if self._stack[at][1] in WALLS[tag]:
                    break
        self._inline.clear()
        named = " ".join(v for k, v in attrs if k in ("class", "id", "role") and v)
        hints = sorted({_HINT_OF[w.lower()] for w in _WORDS.findall(named) if w.lower() in _HINT_OF})
        # What is named a part around the text is not its main part, whatever else it is named.
        if len(hints) > 1 and "main" in hints:
            hints.remove("main")
        inside = "inner-" if tag == "header" and (self._open["article"] or self._open["main"]) else ""
        kind = "h" if len(tag) == 2 and tag[0] == "h" and tag[1].isdigit() else tag
        self._nodes.append((self._stack[-1][0], (f"tag={inside}{kind}", *(f"hint={h}" for h in hints)), dict(attrs).get("label"), self._left))
        self._stack.append((len(self._nodes) - 1, tag))
        self._open[tag] += 1

    def handle_endtag(self, tag):
        if self._raw:
            if tag == self._raw:
                self._raw = None
        elif tag in DROPPED:
            self._close_left(tag)
        elif tag not in BLOCKS:
            if tag in self._inline:
                self._inline.remove(tag)
        else:
            self._flush()
            self._inline.clear()
            if not self._open[tag]:
                return
            for at in range(len(self._stack) - 1, 0, -1):
                if self._stack[at][1] == tag:
                    self._cut(at)
                    return
                if tag == "p" and self._stack[at][1] in ("article", "div", "section", "body", "main"):
                    return

    def handle_data(self, data):
        if not self._raw and (self._left is None or self._left.blocks):
            self._text.append((data, "a" in self._inline, self._left))

    def _finish(self) -> None:
        """Leave out what stands in closed elements; give every run of text its features."""
        self._flush()
        for left in self._all_left:
            left.closed = left.closed or left.outer is not None and left.outer.closed
        self.parents, self.features, self.runs, self.labels, number = [], [], [], [], {}
        for at, (parent, own, label, around) in enumerate(self._nodes):
            run = None
            if isinstance(own, list):
                pieces = [(t, link) for t, link, left in own if left is None or not left.closed]
                run = " ".join("".join(t for t, _ in pieces).split())
                linked = sum(len(t) for t, link in pieces if link) / max(1, sum(len(t) for t, _ in pieces))
                n = run.count(" ") + 1
                length = "short" if n < 5 else "middle" if n < 12 else "long"
                own = (f"links={'none' if linked < 0.1 else 'some' if linked < 0.6 else 'most'}", f"length={length}")
            if run == "" or around is not None and around.closed:
                continue
            number[at] = len(self.parents)
            self.parents.append(number.get(parent, -1))
            self.features.append(own)
            self.runs.append(run)
            self.labels.append(self.labels[number[parent]] if label is None else int(label))

    @classmethod
    def of(cls, page: str) -> "Tree":
        tree = cls()
        tree.feed(page)
        tree.close()
        tree._finish()
        return tree


class Model:
    """Log potentials: per feature, content less other; per kind of child, parent state and child state.

    Fitted by gradient ascent on the likelihood of the labelled pages: the sum-product gives the expected counts.
    """

    def __init__(self, pages: Sequence[str] = LABELLED, steps: int = 300, decay: float = 0.01):
        self.features: dict[str, float] = {}
        self.edges = [[[0.0, 0.0], [0.0, 0.0]] for _ in (0, 1)]
        trees, seen = [Tree.of(page) for page in pages], Counter()
        for _ in range(steps):
            slope: Counter = Counter()
            for tree in trees:
                up, sent, out = self._messages(tree)
                for i in range(1, len(up)):
                    parent, kind, label = tree.parents[i], tree.runs[i] is not None, tree.labels[i]
                    wrong = label - _chance(out[i])
                    for f in tree.features[i]:
                        slope[f] += wrong
                    # Beliefs of parent and child together, by the parent's odds without this child.
                    above = _chance(out[parent] - sent[i])
                    e = self.edges[kind]
                    joint = [[(above if a else 1 - above) * math.exp(e[a][b] + (up[i] if b else 0.0)) for b in (0, 1)] for a in (0, 1)]
                    total = sum(map(sum, joint))
                    for a in (0, 1):
                        for b in (0, 1):
                            slope[kind, a, b] += (tree.labels[parent] == a and label == b) - joint[a][b] / total
            for at, own in slope.items():
                old = self.features.get(at, 0.0) if isinstance(at, str) else self.edges[at[0]][at[1]][at[2]]
                own -= decay * old
                seen[at] += own * own
                new = old + 0.3 * own / math.sqrt(seen[at] + 1e-9)
                if isinstance(at, str):
                    self.features[at] = new
                else:
                    self.edges[at[0]][at[1]][at[2]] = new

    def marginals(self, tree: Tree) -> list[float]:
        """Per node, the log odds of content given the page."""
        return self._messages(tree)[2]

    def _messages(self, tree: Tree) -> tuple[list[float], list[float], list[float]]:
        """What each node knows from below, what it sends up, and its log odds in the end; the root is not content."""
        up = [sum(self.features.get(f, 0.0) for f in features) for features in tree.features]
        up[0] = -30.0
        sent = [0.0] * len(up)
        for i in range(len(up) - 1, 0, -1):
            (s00, s01), (s10, s11) = self.edges[tree.runs[i] is not None]
            sent[i] = _sum(s10, s11 + up[i]) - _sum(s00, s01 + up[i])
            up[tree.parents[i]] += sent[i]
        out = up[:]
        for i in range(1, len(up)):
            (s00, s01), (s10, s11) = self.edges[tree.runs[i] is not None]
            rest = out[tree.parents[i]] - sent[i]
            out[i] = up[i] + _sum(s01, s11 + rest) - _sum(s00, s10 + rest)
        return up, sent, out


def _sum(a: float, b: float) -> float:
    return a + math.log1p(math.exp(b - a)) if a > b else b + math.log1p(math.exp(a - b))


def _chance(odds: float) -> float:
    return 1 / (1 + math.exp(-odds)) if odds > -500 else 0.0


def main_text(page: str, model: Model) -> str:
    """Blocks of content in page order, joined by an empty line."""
    if not page:
        return ""
    tree = Tree.of(page)
    return "\n\n".join(run for run, odds in zip(tree.runs, model.marginals(tree)) if run is not None and odds >= 0)


def extracted(pages: DataFrame, model: Model | None = None, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """One row per input row: page_id, url, text, n_chars (code points of the text).

    Null or empty html and pages without content give an empty text. Null ids and urls stay null, repeated rows
    are extracted each, an empty table gives no rows, other columns are not read. Very long and deeply nested pages
    take time in proportion to their length. Pages are independent: no shuffle.
    """
    model = model or Model()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, urls, found in rows_of(batches, "page_id", "url", "html"):
            texts = [main_text((h or b"").decode("utf-8", "replace"), model) for h in found]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array([None if u is None else u.decode() for u in urls], pa.string()), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    rows = pages.select(F.col(f"`{key}`").cast("long").alias("page_id"), *(F.col(f"`{c}`").cast("string").alias(n) for c, n in ((url, "url"), (html, "html"))))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
