"""Main text of web pages by a tree-structured graphical model over the DOM.

Every block element (and every inline element that a hint marks) is a node with one of three
states: ``OUTSIDE`` (a container of both), ``CONTENT`` and ``CHROME`` (menus, adverts and the
like). Text straight in the body, or on a page without markup, is a node of its own. Node potentials are likelihoods of the element's features, edge potentials the chances of
a child's state given its parent's. Sum-product messages go up and down the tree; a text stays
if its element's marginal of CONTENT is at least one half.

Both potentials are trained on labelled pages: those with an ``article``, ``main`` or
``role=main`` element, which label themselves (inside it, less marked parts, is content; what
holds it is a container; the rest is chrome). Elements, roles and ``hidden`` mark hard; names (class
and id) only weigh. ``AD_WORDS`` and ``COMMENT_WORDS`` (reader comments, which count as outside the
main element) weigh much, and so do ``CHROME_WORDS``, which content may have as well, where the element
holds mostly links or neither a heading over prose nor ``PROSE`` characters of it; else they weigh
little inside a main element, and their parts count as content in training. A form that holds half of a
page's prose is a container. Inline elements are
marked by ``AD_WORDS`` alone, and not in code. At most ``FIT_PAGES`` of them, chosen by a hash,
are counted by a grouped aggregation and joined to stated prior counts, so that marked parts that
no training page has (forms, reader comments) are known too.

Text: character references decoded, white space (``br`` too) inside a block as one space,
trimmed, non-empty blocks joined in page order by a line feed. Nothing is capped.

Cases: null or empty html gives '' and 0; markup that never ends is read to the end of the page;
unknown tags are inline; repeated rows give repeated rows. Only id, url and html are read.
"""

from __future__ import annotations

import html as references
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import hash_share, ship

FIT_PAGES = 2000        # labelled pages whose elements are counted, at most
OUTSIDE, CONTENT, CHROME = 0, 1, 2
TEMPER = 0.3            # weight of the soft features, which overlap
PROSE = 200             # characters outside links that are prose without a heading, too

# HTML's element classes.
BLOCKS = frozenset("""html body head div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption
article main section nav aside header footer form fieldset blockquote pre figure figcaption address details summary hr
center dialog menu search title option select button iframe object video audio canvas template noscript""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
UNSEEN = frozenset("head script style template noscript iframe object svg canvas video audio select option button textarea annotation annotation-xml".split())
#: Elements that a start tag of the key closes, when open in the same container.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
          "tbody": {"thead", "tr", "td", "th"}, "option": {"option"}}
STOPS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"}, "tbody": {"table"}}
CHROME_TAGS = UNSEEN | {"nav", "aside", "footer", "form", "dialog", "menu", "search", "fieldset"}
#: Names of chrome, and such as content may have as well.
AD_WORDS = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|sponsor\w*|nav(?:bar|menu)?|breadcrumbs?|sidebar|footer|masthead|topbar|toolbar|cookies?|"
    r"consent|gdpr|popup|newsletter|subscri\w*|pagination|pager|copyright|sr-only)(?:$|[\s_-])", re.I)
CHROME_WORDS = re.compile(
    r"(?:^|[\s_-])(?:side|notice|alert|related|discussion|widget|tags?|legal|disclaimer|search|form|promo\w*|banner|navigation|menu|modal|"
    r"overlay|signup|login|share|sharing|social|recommend\w*|skip|hidden)(?:$|[\s_-])", re.I)
COMMENT_WORDS = re.compile(r"(?:^|[\s_-])(?:(?:user|reader)?comments?|comment-?(?:list|thread|body|area|section|form)s?|replies|respond|responses|disqus)(?:$|[\s_-])", re.I)
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
CODE = frozenset(("pre", "code", "kbd", "samp", "tt"))
HARD, AD, MAY, BARE, COMMENT = -1, -2, -3, -4, -5     # hints of chrome: hard, by a name of either kind, such a name without prose, reader comments
MARKS = frozenset((HARD, AD, BARE, COMMENT))
CHROME_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
MAIN_WORDS = re.compile(r"(?:^|[\s_-])(?:article|articlebody|content|post|entry|story|main|body|text)(?:$|[\s_-])", re.I)

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*+)>|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"([a-zA-Z_:][-\w:.]*)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))|(?<!\S)(hidden)(?!\S)")
SPACE = re.compile(r"\s+")


class Page:
    """Elements in document order (parents first) and texts in page order."""

    __slots__ = ("tag", "parent", "hint", "main", "texts", "length", "linked", "inside", "loose", "at")

    def __init__(self, source: str):
        self.tag: list[str] = ["#page"]
        self.parent: list[int] = [-1]
        self.hint: list[int] = [0]          # 1: a main-like element, HARD, AD or MAY: chrome, 0: neither
        self.main: list[bool] = [False]
        self.texts: list[tuple[int, str, int]] = []     # model node, raw text, block number
        self.length: list[int] = [0]
        self.linked: list[int] = [0]
        self.loose: tuple[int, int] | None = None
        self._read(source)
        self._weigh()
        self.inside = [False] * len(self.tag)
        for i in range(1, len(self.tag)):
            self.inside[i] = self.main[i] or self.inside[self.parent[i]] and self.hint[i] != COMMENT

    def _weigh(self) -> None:
        """Hints that hang on what an element holds. Without a heading over prose and without
        ``PROSE`` characters of it, a part whose name may be chrome's is bare. A form round most of
        the page's prose is a container (some site builders put one round every page)."""
        n = len(self.tag)
        linked, prose = list(self.linked), [a - b for a, b in zip(self.length, self.linked)]
        headed, said = [t in HEADINGS for t in self.tag], [x >= 40 for x in prose]
        unseen = [t in UNSEEN for t in self.tag]
        for i in range(n - 1, 0, -1):
            p = self.parent[i]
            if not unseen[i]:
                linked[p] += linked[i]
                prose[p] += prose[i]
                headed[p] = headed[p] or headed[i]
                said[p] = said[p] or said[i]
        for i in range(1, n):
            if self.hint[i] == MAY and (prose[i] <= linked[i] or not (headed[i] and said[i] or prose[i] >= PROSE)):
                self.hint[i] = BARE
            elif self.tag[i] == "#text" and prose[0] < 40:
                self.hint[i] = BARE     # hardly anything on the page
            elif self.tag[i] == "form" and self.hint[i] == HARD and prose[i] >= PROSE and prose[i] > linked[i] and 2 * prose[i] >= prose[0]:
                self.hint[i] = 0

    def _read(self, source: str) -> None:
        stack: list[tuple[str, int]] = [("#page", 0)]       # open elements and their model nodes
        block, links, at, raw = 0, 0, 0, ""
        end = len(source)
        while at < end:
            if raw:
                m = re.compile(rf"</{raw}(?=[\s/>]|\Z)[^>]*>?", re.I).search(source, at)
                stop, after = (m.start(), m.end()) if m else (end, end)
                self._text(stack, source[at:stop], block, links)
                if len(stack) > 1:
                    stack.pop()
                block += 1
                at, raw = after, ""
                continue
            m = TOKEN.search(source, at)
            if m is None:
                self._text(stack, source[at:], block, links)
                break
            if m.start() > at:
                self._text(stack, source[at:m.start()], block, links)
            at = m.end()
            tag = (m[2] or m[5] or "").lower()
            if not tag:
                continue
            if m[1] or m[4]:
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k][0] == tag:
                        gone = [t for t, _ in stack[k:]]
                        del stack[k:]
                        links -= gone.count("a")
                        block += any(t in BLOCKS for t in gone)
                        break
                    if tag not in BLOCKS and stack[k][0] in BLOCKS:
                        break       # an inline end tag doesn't close a block
                continue
            if tag == "br":
                self._text(stack, " ", block, links)
                continue
            if tag in BLOCKS:
                block += 1
                links -= self._closed(stack, tag)
            attributes = m[3] or m[6] or ""
            if tag in VOID or attributes.endswith("/") and tag not in BLOCKS:
                continue
            code = "=" in attributes and (tag in CODE or any(t in CODE for t, _ in stack))
            stack.append((tag, self._node(stack[-1][1], tag, attributes, code)))
            links += tag == "a"
            if tag in RAW:
                raw = tag

    def _closed(self, stack: list[tuple[str, int]], tag: str) -> int:
        """Close what a block's start tag ends; the number of links closed."""
        cut = 0
        for k in range(len(stack) - 1, 0, -1):
            open_ = stack[k][0]
            if open_ == "p" or open_ in CLOSES.get(tag, ()):
                cut = k
            elif open_ in STOPS.get(tag, ()) or tag not in CLOSES and open_ in BLOCKS or open_ in ("table", "td", "th") and tag not in CLOSES:
                break
        if not cut:
            return 0
        links = sum(t == "a" for t, _ in stack[cut:])
        del stack[cut:]
        return links

    def _node(self, parent: int, tag: str, attributes: str, code: bool) -> int:
        hint, main = HARD if tag in CHROME_TAGS else 0, tag in ("article", "main")
        if "=" in attributes or "hidden" in attributes:
            found = {(m[1] or m[5]).lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(attributes)}
            named = f"{found.get('class', '')} {found.get('id', '')}"
            role = found.get("role", "").lower()
            main = main or role == "main"
            comment = tag in BLOCKS and tag not in ("html", "body", "main") and not code and (
                COMMENT_WORDS.search(named) or found.get("itemprop") == "comment" or found.get("itemtype", "").endswith("/Comment"))
            main = main and not comment     # comments may be articles of their own
            if role in CHROME_ROLES or "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in found.get("style", "").replace(" ", ""):
                hint = HARD
            elif hint == 0 and comment:
                hint = COMMENT
            elif hint == 0 and tag not in ("html", "body") and not main and named.strip() and not (code and tag not in BLOCKS):
                may = tag in BLOCKS and CHROME_WORDS.search(named)
                hint = AD if AD_WORDS.search(named) else MAY if may else 1 if MAIN_WORDS.search(named) else 0
        if tag == "header":
            above = parent
            while above > 0 and not self.main[above]:
                above = self.parent[above]
            hint = hint if above > 0 else HARD     # an article's own header holds its heading
        if main and hint == 0:
            hint = 1
        if tag not in BLOCKS and hint >= 0:
            return parent
        return self._add(parent, tag, hint, main)

    def _add(self, parent: int, tag: str, hint: int, main: bool) -> int:
        self.tag.append(tag)
        self.parent.append(parent)
        self.hint.append(hint)
        self.main.append(main)
        self.length.append(0)
        self.linked.append(0)
        return len(self.tag) - 1

    def _text(self, stack: list[tuple[str, int]], text: str, block: int, links: int) -> None:
        node = stack[-1][1]
        if self.tag[node] in ("#page", "html", "body"):     # loose text is a block of its own
            if self.loose != (node, block):
                if not text.strip():
                    return
                self._add(node, "#text", 0, False)
                self.loose = (node, block)
                self.at = len(self.tag) - 1
            node = self.at
        self.texts.append((node, text, block))
        n = len(text) - text.count(" ")
        self.length[node] += n
        if links:
            self.linked[node] += n

    def features(self, i: int, has_main: bool) -> tuple[tuple[str, ...], tuple[str, ...]]:
        """Marks (hint and place) and soft features (tag, length, links) of an element."""
        n = self.length[i]
        size = "short" if n < 40 else "middle" if n < 150 else "long"
        share = self.linked[i] / n if n else 0
        place = "" if not has_main else "in" if self.inside[i] else "out"
        tag = self.tag[i] if self.tag[i] in BLOCKS else "p" if self.tag[i] == "#text" else "inline"
        hint = f"hint:{self.hint[i]}" + (place if self.hint[i] == MAY else "")
        if place == "in" and not self.main[i]:
            place = ""      # its parent is inside, so this says nothing new
        return ((hint, f"place:{place}"), () if not n else      # an element without text of its own has no form
                (f"tag:{tag}", f"size:{size}", f"links:{0 if share < 0.1 else 1 if share < 0.6 else 2}"))


def labels(page: Page) -> list[int]:
    """The states of a page that labels itself."""
    n = len(page.tag)
    state = [CHROME] * n
    for i in range(1, n):
        above = state[page.parent[i]]
        marked = page.hint[i] in MARKS or above == CHROME and page.parent[i] and page.hint[page.parent[i]] in MARKS
        if page.inside[i] and not marked and (page.main[i] or above == CONTENT):
            state[i] = CONTENT
    for i in range(n - 1, 0, -1):       # what holds content from outside
        if state[i] != CHROME and state[page.parent[i]] == CHROME:
            state[page.parent[i]] = OUTSIDE
    return state


def counted(sources: Iterator[str]) -> Counter:
    """(kind, name, state) counts of self-labelled pages: features by state, edges by states."""
    out: Counter = Counter()
    for source in sources:
        page = Page(source)
        if not any(page.main):
            continue
        state = labels(page)
        for i in range(1, len(page.tag)):
            marks, soft = page.features(i, True)
            for name in marks + soft:
                out["feature", name, state[i]] += 1
            out["state", "", state[i]] += 1
            out["edge", str(state[page.parent[i]]), state[i]] += 1
    return out


# Prior counts, as if seen in training: marked parts are chrome, chrome has only chrome within,
# content leaves to chrome only where something is marked.
PRIOR = {("hint:-1", CHROME): 1e3, ("hint:-1", CONTENT): 1e-12, ("hint:-1", OUTSIDE): 1e-3,
         ("hint:-2", CHROME): 1e3, ("hint:-2", CONTENT): 1e-3, ("hint:-2", OUTSIDE): 1e-3,
         ("hint:-4", CHROME): 1e3, ("hint:-4", CONTENT): 1e-3, ("hint:-4", OUTSIDE): 1e-3,
         ("hint:-5", CHROME): 1e3, ("hint:-5", CONTENT): 1e-12, ("hint:-5", OUTSIDE): 1e-3,
         ("hint:-3", CHROME): 1e3, ("hint:-3", CONTENT): 1e-1, ("hint:-3", OUTSIDE): 1e-1,
         ("hint:-3out", CHROME): 1e3, ("hint:-3out", CONTENT): 1e-1, ("hint:-3out", OUTSIDE): 1e-1,
         ("hint:-3in", CHROME): 3.0, ("hint:-3in", CONTENT): 1.0, ("hint:-3in", OUTSIDE): 1e-1,
         ("hint:1", CONTENT): 200.0, ("hint:1", OUTSIDE): 0.1, ("hint:1", CHROME): 0.1,
         ("place:out", CONTENT): 1e-12, ("place:in", CHROME): 10.0}
EDGE_PRIOR = {(OUTSIDE, OUTSIDE): 20.0, (OUTSIDE, CONTENT): 20.0, (OUTSIDE, CHROME): 40.0, (CONTENT, CONTENT): 1e4,
              (CONTENT, CHROME): 10.0, (CONTENT, OUTSIDE): 1e-9, (CHROME, CHROME): 1e6, (CHROME, OUTSIDE): 1e-9, (CHROME, CONTENT): 1e-9}


class Model:
    """Potentials: log likelihoods of features by state, and edge chances."""

    def __init__(self, counts: dict[tuple[str, str, int], int]):
        total = [counts.get(("state", "", s), 0) + 100.0 for s in range(3)]
        names = {n for k, n, _ in counts if k == "feature"} | {n for n, _ in PRIOR} | {"hint:0", "place:", "place:in", "place:out"}
        self.log = {n: [math.log((counts.get(("feature", n, s), 0) + PRIOR.get((n, s), 1.0)) / total[s]) for s in range(3)] for n in names}
        self.log["place:"] = [0.0, 0.0, 0.0]
        self.edge = []
        for a in range(3):
            row = [counts.get(("edge", str(a), b), 0) * (b >= a or a == OUTSIDE) + EDGE_PRIOR[a, b] for b in range(3)]
            if a == CONTENT:
                row[CHROME] = EDGE_PRIOR[a, CHROME] + 1e-3 * row[CHROME]    # seen only at marked parts
            self.edge.append([x / sum(row) for x in row])

    def marginals(self, page: Page) -> list[float]:
        """P(CONTENT) of every element, by messages up the tree and down again."""
        n = len(page.tag)
        has_main = any(page.main)
        own: list[list[float]] = [[1.0, 1e-9, 1e-9]]
        for i in range(1, n):
            marks, soft = page.features(i, has_main)
            log = [sum(self.log.get(m, ZERO)[s] for m in marks) + TEMPER * sum(self.log.get(f, ZERO)[s] for f in soft) for s in range(3)]
            top = max(log)
            own.append([math.exp(max(x - top, -60.0)) for x in log])
        edges = [MARKED if h in MARKS else self.edge for h in page.hint]
        up: list[list[float]] = [ZERO] * n
        belief = [list(x) for x in own]
        for i in range(n - 1, 0, -1):       # children come after their parents
            b, edge = belief[i], edges[i]
            up[i] = message = [edge[s][0] * b[0] + edge[s][1] * b[1] + edge[s][2] * b[2] for s in range(3)]
            p = belief[page.parent[i]]
            p[0], p[1], p[2] = p[0] * message[0], p[1] * message[1], p[2] * message[2]
            top = max(p) or 1.0
            p[0], p[1], p[2] = p[0] / top + 1e-280, p[1] / top + 1e-280, p[2] / top + 1e-280
        out = [0.0] * n
        for i in range(n):
            b = belief[i]
            if i:
                p, message, edge = belief[page.parent[i]], up[i], edges[i]
                rest = [p[s] / max(message[s], 1e-300) for s in range(3)]     # the parent without this child
                b[:] = [b[t] * (rest[0] * edge[0][t] + rest[1] * edge[1][t] + rest[2] * edge[2][t]) for t in range(3)]
            total = sum(b) or 1.0
            b[:] = [x / total + 1e-280 for x in b]
            out[i] = b[CONTENT]
        return out

    def text(self, source: str | None) -> str:
        """The main text of a page."""
        if not source:
            return ""
        page = Page(source)
        content = self.marginals(page)
        blocks: list[str] = []
        number, held = None, []
        for node, raw, block in page.texts:
            if block != number:
                blocks.append("".join(held))
                number, held = block, []
            if content[node] >= 0.5:
                held.append(raw)
        blocks.append("".join(held))
        said = (SPACE.sub(" ", references.unescape(b)).strip() for b in blocks if b)
        return "\n".join(b for b in said if b)


ZERO = [0.0, 0.0, 0.0]
#: The edge to a marked part is the same from any parent: an article may hold many of them.
MARKED = [[1e-6, 1e-6, 1.0]] * 3


def learn(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", fit_pages: int = FIT_PAGES) -> Model:
    """The model from a bounded sample of the self-labelled pages. The counts are as many as
    there are features and states, whatever the size of the table."""
    ship(pages.sparkSession)
    labelled = pages.select(F.col(id_col).alias("id"), F.col(html_col).alias("html")).where(
        F.col("html").rlike(r"(?i)<(?:article|main)[\s>]|role=[\"']?main"))
    src = labelled.where(hash_share(fit_pages, labelled.count(), "id")).select("html")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = counted(h for b in batches for h in b.column(0).to_pylist())
        yield pa.RecordBatch.from_pylist([{"kind": k, "name": n, "state": s, "n": c} for (k, n, s), c in total.items()],
                                         schema=pa.schema([("kind", pa.string()), ("name", pa.string()), ("state", pa.int64()), ("n", pa.int64())]))

    rows = src.mapInArrow(run, "kind string, name string, state long, n long").groupBy("kind", "name", "state").agg(F.sum("n").alias("n")).collect()
    return Model({(r.kind, r.name, r.state): r.n for r in rows})


def main_text(pages: DataFrame, model: Model, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per page: id, url, text and n_chars (code points). No shuffle."""
    ship(pages.sparkSession)
    src = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    kinds = [src.schema[c].dataType.simpleString() for c in ("id", "url")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [model.text(h) for h in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                                              pa.array([len(t) for t in texts], pa.int64())], names=["id", "url", "text", "n_chars"])

    return (src.mapInArrow(run, f"id {kinds[0]}, url {kinds[1]}, text string, n_chars long")
            .withColumnRenamed("id", id_col).withColumnRenamed("url", url_col))
