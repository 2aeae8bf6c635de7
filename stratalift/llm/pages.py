"""Main text of web pages by a tree-structured graphical model.

Every block element and every run of text in it is a node that is content or
not. A node has a potential from its own features, and each parent and child
share one that depends on whether they agree. Messages that pass once from the
leaves to the root and once back give each node its exact marginal; text whose
marginal favours content is kept. Both kinds of potentials are estimated from
pages that label themselves by landmark elements.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalift.llm.frames import column, text_column, without

# Element names of HTML.
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt "
    "ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
VOID = set("area base col embed hr img input link meta param source track wbr".split())
RAW = set("script style noscript template iframe svg textarea title select".split())
# Of these the text goes on to the end of the page where no end tag stands.
ENDLESS = set("script style textarea title".split())
# An element of these closes an open one of the named ones that it cannot stand in.
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
}
KEEPS_OPEN = set("ul ol dl table div section article main body blockquote".split())
LANDMARKS = {"article", "main"}
MARGINS = set("nav header footer aside form menu dialog head address".split())
# Parts of class and id names, as patterns of whole parts.
CONTENT_PART = re.compile(
    r"(article|main|content|post|entry|story|stories|hentry|prose|text|body|entries)s?|articlebody", re.I
)
MARGIN_PART = re.compile(
    r"nav(s|bar|igation)?|menus?|header|masthead|footer|side(bar|nav)?s?|aside|widgets?|"
    r"ads?|advert(s|isements?|ising)?|banners?|sponsor(s|ed)?|promo(s|tions?|ted)?|cookies?|consent|"
    r"notices?|alerts?|popup|modal|newsletter|subscribe|subscriptions?|signup|login|forms?|search|"
    r"comment(s|ary|list)?|respond|reply|replies|discuss(ions?)?|shar(e|ing)|social|related|"
    r"recommend(ed|ations?)?|breadcrumbs?|pagination|pager|tags|toolbar|skip|legal|copyright|disqus",
    re.I,
)
# Parts that say nothing of themselves: with a margin word they name a margin.
PLAIN_PART = re.compile(
    r"site|page|top|bottom|left|right|box|bar|lists?|blocks?|container|wrap(per)?|inner|outer|section|"
    r"areas?|items?|global|primary|secondary|main|group|row|col(umn)?|buttons?|links?|icons?|media|"
    r"panel|title|to|link|\w*\d\w*",
    re.I,
)
# Names that begin or end so tell a state or a subject of the page, not what the element is.
STATE_FIRST = set("has no not with without is type format status category tag single postid hide show js".split())
STATE_LAST = set("on off open closed enabled disabled active visible".split())
PART = re.compile(r"[-_:.]+|(?<=[a-z])(?=[A-Z])")
NAMES = re.compile(r"\b(?:class|id|role|itemprop)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+)))?")
NOT_SHOWN = re.compile(r"(?:^|;)\s*display\s*:\s*none\b", re.I)
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s>/]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+|[^>]*)(?:>|\Z)",
    re.S,
)
WHITE = re.compile(r"\s+")
ROOT = "#root"
FRAME = {ROOT, "html", "head", "body"}
NEARLY_ALL = 0.8
# Bounds of log odds, and the least probability that parent and child differ.
FEATURE_LIMIT, HINT_LIMIT, MARGIN_ODDS, EDGE_FLOOR = 1.0, 8.0, 60.0, 0.001
# What holds before any page has taught something, and as much as so many nodes of either label.
PRIOR_NODES = 20
PRIOR_ODDS = {
    "text links 0": 0.3, "text links 2": -1.0, "text end True": 0.5, "text end False": -0.2,
    **{f"text words {n}": o for n, o in enumerate((-0.4, -0.3, -0.2, 0.0, 0.3, 0.6, 0.8, 1.0))},
}
# The share of children that are as their parent is.
PRIOR_AGREE = {"outer": 0.6, "element": 1 - EDGE_FLOOR, "text": 1 - EDGE_FLOOR}
MAY_LABEL = rf"(?i)<(?:{'|'.join(sorted(LANDMARKS))})"


@dataclass
class Tree:
    """Nodes in page order, so that a parent stands before its children."""

    parent: list[int] = field(default_factory=list)
    name: list[str] = field(default_factory=list)  # "" for text
    hint: list[int] = field(default_factory=list)  # 1 content, -1 margin, 0 neither
    text: list[str] = field(default_factory=list)
    linked: list[float] = field(default_factory=list)  # share of the text that is in links
    marks: list[tuple[str, ...]] = field(default_factory=list)

    def add(
        self, parent: int, name: str, hint: int = 0, text: str = "", linked: float = 0, marks: tuple[str, ...] = ()
    ) -> int:
        self.marks.append(marks)
        self.parent.append(parent)
        self.name.append(name)
        self.hint.append(hint)
        self.text.append(text)
        self.linked.append(linked)
        return len(self.parent) - 1


def parse(page: str | None) -> Tree:
    """The tree of block elements and text. Anything is a page: what is left open ends with it."""
    tree = Tree()
    page = page or ""
    open_ = [(tree.add(-1, ROOT), ROOT)]
    pieces: list[str] = []
    in_link = False
    link_chars = 0
    unended: set[str] = set()  # raw elements that no end tag follows

    def flush() -> None:
        nonlocal link_chars
        text = WHITE.sub(" ", "".join(pieces)).strip()
        if text:
            tree.add(open_[-1][0], "", 0, text, min(1.0, link_chars / len(text)))
        pieces.clear()
        link_chars = 0

    def say(raw: str) -> None:
        nonlocal link_chars
        if raw:
            text = html.unescape(raw)
            pieces.append(text)
            if in_link:
                link_chars += len(text.strip())

    at = 0
    while at < len(page):
        found = TOKEN.search(page, at)
        if found is None:
            break
        say(page[at : found.start()])
        at = found.end()
        closing, name, rest = found.group(1), found.group(2), found.group(3)
        if name is None:
            continue
        name = name.lower()
        end = None
        if name in RAW and not closing and not rest.endswith("/") and name not in unended:
            end = re.compile(rf"</{re.escape(name)}(?![\w-])[^>]*(?:>|\Z)", re.I).search(page, at)
            if end is None:
                unended.add(name)
        if name in RAW and not closing and (end or rest.endswith("/") or name in ENDLESS):
            if not rest.endswith("/"):
                at = end.end() if end else len(page)
        elif name == "br":
            pieces.append("\n")
        elif name in INLINE:
            if name == "a":
                in_link = not closing
        elif name in VOID:
            if name == "hr":
                flush()
        elif closing:
            flush()
            if any(n == name for _, n in open_[1:]):
                while open_.pop()[1] != name:
                    pass
                in_link = False
        else:
            flush()
            closes = CLOSES.get(name, {"p"})
            if name not in CLOSES or any(n == "p" for _, n in open_):
                closes = closes | {"p"}
            while len(open_) > 1 and open_[-1][1] in closes:
                open_.pop()
            if name in CLOSES:
                back = [k for k, (_, n) in enumerate(open_) if n in CLOSES[name]]
                if back and not any(n in KEEPS_OPEN for _, n in open_[back[-1] :]):
                    del open_[back[-1] :]
            marks = marks_of(name, rest)
            node = tree.add(open_[-1][0], name, hint_of(marks), marks=marks)
            if not rest.endswith("/"):
                open_.append((node, name))
    say(page[at:])
    flush()
    _settle(tree)
    return tree


def _settle(tree: Tree) -> None:
    """Marks that their place contradicts.

    What holds nearly all text of a page and something marked as content is no margin, and a
    landmark inside a margin is part of it, as a reader's comment is an article by name.
    """
    whole = text_sizes(tree)
    holds = [False] * len(whole)
    for node in reversed(range(1, len(whole))):
        if holds[node] or tree.hint[node] > 0:
            holds[tree.parent[node]] = True
    inside = [False] * len(whole)
    for node in range(1, len(whole)):
        if tree.hint[node] < 0 and holds[node] and whole[node] > NEARLY_ALL * whole[0]:
            tree.hint[node], tree.marks[node] = 0, ()
        inside[node] = inside[tree.parent[node]] or tree.hint[node] < 0
        if inside[node] and tree.hint[node] > 0:
            tree.hint[node], tree.marks[node] = 0, ()


def marks_of(name: str, attributes: str) -> tuple[str, ...]:
    """What an element's name, class, id and role say of it: ``-word`` for a margin, ``+word``
    for content, ``~`` where they contradict each other.

    Names of classes count as a whole, and a landmark is no margin by its class.
    """
    marks = {f"-<{name}>"} if name in MARGINS else {f"+<{name}>"} if name in LANDMARKS else set()
    if attributes:
        if is_hidden(attributes):
            return ("-<hidden>",)
        said = {m for names in NAMES.findall(attributes) for m in map(mark_of, names.strip("\"'").split()) if m}
        if name in LANDMARKS or name in ("html", "body"):
            said = set()
        if len({m[0] for m in said}) > 1:
            said = {"~"}
        marks |= said
    return tuple(sorted(marks))


def mark_of(token: str) -> str | None:
    """The mark that one name of a class is, if any."""
    parts = [p for p in PART.split(token) if p]
    if not parts or parts[0].lower() in STATE_FIRST or parts[-1].lower() in STATE_LAST:
        return None
    if MARGIN_PART.fullmatch("".join(parts)) or MARGIN_PART.fullmatch(parts[-1]):
        return "-" + parts[-1].lower()
    margins = [p for p in parts if MARGIN_PART.fullmatch(p)]
    known = (MARGIN_PART, CONTENT_PART, PLAIN_PART)
    if margins and all(any(k.fullmatch(p) for k in known) for p in parts):
        return "-" + margins[0].lower()
    if not margins and CONTENT_PART.fullmatch(parts[-1]):
        return "+" + parts[-1].lower()
    return None


def hint_of(marks: tuple[str, ...]) -> int:
    """-1 for a margin, 1 for content, 0 where nothing is said."""
    signs = {m[0] for m in marks}
    return -1 if "-" in signs else int("+" in signs)


def is_hidden(attributes: str) -> bool:
    """By the attributes ``hidden``, ``aria-hidden`` and ``style``, not by words in others."""
    for name, *values in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), "".join(values).strip()
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            return True
        if name == "style" and NOT_SHOWN.search(value):
            return True
    return False


def features(tree: Tree, node: int, with_hints: bool = True) -> list[str]:
    if tree.name[node]:
        plain = tree.name[node] if with_hints or not marks_of(tree.name[node], "") else "div"
        if with_hints and tree.marks[node]:
            return [f"tag {plain}", *(f"mark {m}" for m in tree.marks[node])]
        return [f"tag {plain}", f"hint {tree.hint[node] if with_hints else 0}"]
    text, up = tree.text[node], tree.parent[node]
    words = min(7, text.count(" ").bit_length())
    links = 0 if not tree.linked[node] else 1 if tree.linked[node] < 0.5 else 2
    return [f"words {words}", f"links {links}", f"end {text[-1] in '.!?:'}", f"in {tree.name[up]}"]


def text_sizes(tree: Tree, counted: list[int] | None = None) -> list[int]:
    """The characters of text in every node, or of that for which ``counted`` is 1."""
    held = [0] * len(tree.parent)
    for node in reversed(range(len(held))):
        if not tree.name[node] and (counted is None or counted[node]):
            held[node] = len(tree.text[node])
        if (up := tree.parent[node]) >= 0:
            held[up] += held[node]
    return held


def landmark_labels(tree: Tree) -> list[int] | None:
    """1 for text inside a landmark and no margin below it, and for elements of mostly such
    text; None for pages without a landmark with text.

    A margin that holds more than half of its landmark's text is taken for a
    misleading name and counts as content.
    """
    whole = text_sizes(tree)
    inside, mark = [0] * len(tree.parent), [-1] * len(tree.parent)
    for node, up in enumerate(tree.parent):
        above = inside[up] if up >= 0 else 0
        mark[node] = mark[up] if up >= 0 else -1
        if tree.name[node] in LANDMARKS:
            inside[node] = int(above or tree.hint[node] > 0)
            mark[node] = node
        elif tree.hint[node] < 0 and not (above and 2 * whole[node] > whole[mark[node]]):
            inside[node] = 0
        else:
            inside[node] = above
    held = text_sizes(tree, inside)
    if not held or not held[0]:
        return None
    return [int(2 * h > w) if w else i for h, w, i in zip(held, whole, inside, strict=True)]


def count_page(page: str | None) -> Counter:
    """How often features go with a label, and labels of children with those of parents.

    The page counts twice, once as it is and once without its hints, so that the
    model also learns to do without them.
    """
    tree = parse(page)
    labels = landmark_labels(tree)
    found: Counter = Counter()
    if labels is None:
        return found
    for node, label in enumerate(labels):
        kind = "element" if tree.name[node] else "text"
        for with_hints in (True, False):
            for name in features(tree, node, with_hints):
                found[f"{kind} {name}", label] += 1
            found[kind, label] += 1
        if (up := tree.parent[node]) >= 0:
            found[f"edge {edge_kind(tree, node)} {labels[up]}", label] += 2
    return found


def edge_kind(tree: Tree, node: int) -> str:
    """Parts of a page differ from it as a whole more often than what is in them from them."""
    if tree.name[tree.parent[node]] in FRAME:
        return "outer"
    return "element" if tree.name[node] else "text"


@dataclass(frozen=True)
class PageModel:
    """Potentials as logarithms: of a feature its odds for content, of an edge by both labels."""

    odds: dict[str, float]
    edges: dict[str, tuple[tuple[float, float], tuple[float, float]]]

    def unary(self, tree: Tree, node: int) -> float:
        kind = "element" if tree.name[node] else "text"
        total = 0.0
        for name in features(tree, node):
            known = self.odds.get(f"{kind} {name}")
            total += mark_odds(name) if known is None else known
        return total

    def marginals(self, tree: Tree) -> list[float]:
        """The log odds of content of every node, by sum-product."""
        nodes = len(tree.parent)
        below = [self.unary(tree, node) for node in range(nodes)]
        up_message = [0.0] * nodes
        edge = [self.edges[edge_kind(tree, node)] for node in range(nodes)]
        for node in range(nodes - 1, 0, -1):
            (p00, p01), (p10, p11) = edge[node]
            own = below[node]
            up_message[node] = _log_add(p10, p11 + own) - _log_add(p00, p01 + own)
            below[tree.parent[node]] += up_message[node]
        belief = below[:1] + [0.0] * (nodes - 1)
        for node in range(1, nodes):
            (p00, p01), (p10, p11) = edge[node]
            rest = belief[tree.parent[node]] - up_message[node]
            belief[node] = below[node] + _log_add(p01, p11 + rest) - _log_add(p00, p10 + rest)
        return belief

    def main_text(self, page: str | None) -> str:
        tree = parse(page)
        belief = self.marginals(tree)
        kept = (t for t, name, b in zip(tree.text, tree.name, belief, strict=True) if not name and b > 0)
        return " ".join(kept)


def _log_add(a: float, b: float) -> float:
    high, low = (a, b) if a > b else (b, a)
    return high + math.log1p(math.exp(low - high))


def mark_odds(feature: str, right: float = 1.0) -> float:
    """The log odds of a mark that agrees with the labels in a share ``right`` of its elements.

    A margin inside the content is known by its mark alone, however many texts it holds, so
    one that is always right outvotes them; one that is wrong as often as right says nothing.
    """
    sign = feature[5:6] if feature.startswith("mark ") else ""
    most = {"+": HINT_LIMIT, "-": -MARGIN_ODDS, "~": -FEATURE_LIMIT}.get(sign, 0.0)
    return min(HINT_LIMIT, most * (2 * right - 1))


def model_from(counts: dict[tuple[str, int], int], smooth: float = 1.0) -> PageModel:
    """The potentials by the counts, and by the prior ones where the counts say little."""

    def share(name: str, label: int, of: str) -> float:
        return (counts.get((name, label), 0) + smooth) / (counts.get((of, label), 0) + 4 * smooth)

    odds, edges = {}, {}
    for name in {n for n, _ in counts} | PRIOR_ODDS.keys():
        kind, _, rest = name.partition(" ")
        if kind not in ("element", "text") or not rest:
            continue
        if rest.startswith("mark "):
            # as if so many elements had borne it and been what it says
            yes, no = (counts.get((name, label), 0) for label in (1, 0))
            right = (PRIOR_NODES + (yes if rest[5] == "+" else no)) / (PRIOR_NODES + yes + no)
            odds[name] = mark_odds(rest, right)
            continue
        taught = min(counts.get((kind, label), 0) for label in (0, 1))
        found = math.log(share(name, 1, kind)) - math.log(share(name, 0, kind))
        prior = PRIOR_ODDS.get(name, 0.0) * PRIOR_NODES
        # The labelled pages of a site are alike, so their counts are surer than other pages allow:
        # no feature may outvote what a whole branch says, only marks are that strong.
        found = (found * taught + prior) / (taught + PRIOR_NODES)
        odds[name] = max(-FEATURE_LIMIT, min(FEATURE_LIMIT, found))
    for kind, agree in PRIOR_AGREE.items():
        rows = []
        for above in (0, 1):
            n = [
                counts.get((f"edge {kind} {above}", label), 0)
                + 2 * smooth * (agree if label == above else 1 - agree)
                for label in (0, 1)
            ]
            share_one = max(EDGE_FLOOR, min(1 - EDGE_FLOOR, n[1] / sum(n)))
            rows.append((math.log(1 - share_one), math.log(share_one)))
        edges[kind] = tuple(rows)
    return PageModel(odds, edges)


def teaches(page: str | None) -> bool:
    return landmark_labels(parse(page)) is not None


def fit_pages(df: DataFrame, page_id: str, page: str, bound: int = 2000) -> PageModel:
    """The model from the pages of at most ``bound`` ids, those with the lowest hashes among
    all that have a page with a landmark with text.

    Other pages and NULL ids teach nothing; where none is left, hints and prior
    odds of texts decide.
    """
    rows = df.select(column(page_id).alias("__id"), column(page).cast("string").alias("__page"))
    rows = rows.where(F.col("__id").isNotNull() & F.col("__page").rlike(MAY_LABEL))

    def lowest(of: DataFrame, most: int) -> DataFrame:
        """Collected, as they are few and used several times."""
        ids = of.select("__id").distinct().orderBy(F.xxhash64("__id"), "__id").limit(most)
        return df.sparkSession.createDataFrame(ids.collect(), ids.schema)

    def of_ids(ids: DataFrame) -> DataFrame:
        few = F.broadcast(ids.withColumnRenamed("__id", "__of"))
        return rows.join(few, F.col("__id") == F.col("__of")).drop("__of")

    def labelled(some: DataFrame) -> DataFrame:
        """Not a filter, which would be moved before the join with the drawn ids."""

        def keep(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in frames:
                yield frame[[teaches(body) for body in frame["__page"]]][["__id"]]

        return some.mapInPandas(keep, some.select("__id").schema)

    # nearly all that have the tags are labelled; only where they are not, all are tried
    drawn = lowest(rows, 2 * bound)
    chosen = lowest(labelled(of_ids(drawn)), bound)
    if chosen.count() < bound and drawn.count() == 2 * bound:
        chosen = lowest(labelled(rows), bound)
    sample = of_ids(chosen)

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            total: Counter = Counter()
            for body in frame["__page"]:
                total.update(count_page(body if isinstance(body, str) else None))
            yield pd.DataFrame(
                {
                    "name": [n for n, _ in total],
                    "label": [label for _, label in total],
                    "n": list(total.values()),
                }
            )

    counted = sample.select("__page").mapInPandas(count, "name string, label int, n long")
    summed = counted.groupBy("name", "label").agg(F.sum("n").alias("n"))
    return model_from({(r["name"], r["label"]): r["n"] for r in summed.collect()})


def extract_text(df: DataFrame, page: str, model: PageModel) -> DataFrame:
    """The rows with ``text``, the main text of their whole page, and ``n_chars``.

    A NULL or empty page, and one without main text, has the empty text. Text whose marginal
    favours neither label is left out. Pages are read whole, however long, and each on its own, so
    repeated rows have the same text. Columns of these names are replaced.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)

    def batch(bodies: list[str | None]) -> list[str]:
        return [shared.value.main_text(b) for b in bodies]

    main: Column = text_column(column(page), "string", batch)
    given = without(df, "text", "n_chars")
    return given.withColumn("text", main).withColumn("n_chars", F.char_length("text").cast("long"))
