"""Main text of web pages from flat blocks and a decision tree.

A page becomes a flat list of text blocks: what stands between two block-level tags. Each block is
described by its words and link density, those of the blocks before and after it, and what its
enclosing elements say of themselves: main text (article, main), or something else (navigation,
header, footer, sidebar, notice, advert, form, comments). An article or main tag decides for itself
unless it is hidden, or an article inside an article is a comment or the like; captions are main text. A decision tree, fitted to the small table
of labelled blocks below, tells main text from the rest. Blocks of main text are joined in page order.

Scripts, styles, comments and other content that is not shown give no blocks. Character references
are decoded; white space inside a block becomes one space. Markup may be broken: tags that are never
closed or cut off, references without their semicolon, a < that begins no tag. Only elements of raw text (RAW) that are
never closed run to the end of the page; other hidden ones end where their parent ends, and one that
closes itself, as in <svg/>, is empty.

Cases: a null or empty html, and one without main text, gives an empty text. Pages are read whole and
texts are not shortened. Repeated pages are extracted like any. An empty table gives no rows. Other
columns are not read.
"""

from __future__ import annotations

import html as references
import re
from collections.abc import Collection, Iterator

import pandas as pd
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stallbook.llm.tables import table

# Elements and words of HTML.
RAW = "script style textarea title iframe noscript".split()
HIDDEN = [*RAW, *"template select option svg object canvas audio video math datalist".split()]
INLINE = (
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small span strike "
    "strong sub sup time tt u var wbr"
).split()
VOID = "area base br col embed hr img input link meta param source track wbr".split()
PARAGRAPH_ENDS = "p div section article main aside nav header footer h1 h2 h3 h4 h5 h6 ul ol dl table blockquote pre figure hr form".split()
#: Elements whose end tag may be left out, and the tags that end them as the next in a row.
SIBLINGS = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "td": ("td", "th"), "th": ("td", "th"), "tr": ("td", "th", "tr"),
}
MAIN = "article main".split()
ASIDE = "nav header footer aside form menu dialog button fieldset label".split()
MAIN_WORDS = set("article articlebody main content post entry story".split())
ASIDE_WORDS = set(
    "ad ads advert advertisement adverts banner breadcrumb breadcrumbs byline comment comments consent contentinfo cookie cookies "
    "copyright dialog disqus footer form header login masthead menu modal nav navbar navigation newsletter notice notification "
    "pagination pager popup promo promoted promotion recommended related replies reply respondents search share sharing sidebar "
    "side sidenav signup social sponsor sponsored subscribe subscription tags toc toolbar topbar widget alert warning complementary "
    "hidden skip".split()
)

#: Words that begin a class which says how an element looks or what it lacks, not what it is.
MODIFIERS = set("has no not with without is hide category tag layout supports".split())

FEATURES = [
    "words", "links", "words_before", "links_before", "words_after", "links_after", "inside", "outside", "aside", "heading",
]

#: Labelled blocks of a few pages, in page order: words, linked words, where (m main element, a aside,
#: x both, so an aside in a main element, - neither), h for a heading, and whether it is main text.
LABELLED = """
12 12 a - 0 | 9 0 a - 0 | 8 0 m h 1 | 40 0 m - 1 | 85 4 m - 1 | 3 0 m - 1 | 22 0 m - 1 | 15 3 a - 0
6 6 a - 0 | 5 0 m h 1 | 1 0 m - 1 | 2 0 m - 1 | 30 12 x - 0 | 60 2 m - 1 | 9 9 x - 0 | 70 0 x - 0 | 11 2 a - 0
4 4 - - 0 | 5 5 - - 0 | 7 0 - h 1 | 55 2 - - 1 | 9 0 - - 1 | 90 5 - - 1 | 40 0 - - 1 | 3 3 - - 0 | 6 6 - - 0 | 8 1 - - 0
2 2 - - 0 | 3 3 - - 0 | 120 6 - - 1 | 30 1 - - 1 | 4 4 - - 0 | 5 0 - - 0 | 6 5 - - 0
20 0 a - 0 | 90 0 a - 0 | 9 0 m h 1 | 300 10 m - 1 | 45 0 m - 1 | 80 3 a - 0 | 60 0 a - 0 | 10 0 a - 0
8 8 a - 0 | 1 0 m - 1 | 50 0 - - 0 | 14 0 - - 0 | 9 9 - - 0
35 0 - - 0 | 12 0 m h 1 | 18 18 m - 0 | 27 1 m - 1 | 6 6 m - 0 | 500 0 m - 1 | 33 2 - - 0
60 0 - - 1 | 70 1 - - 1 | 65 0 - - 1 | 25 0 a - 0 | 80 0 a - 0 | 12 11 - - 0
5 0 a h 0 | 45 0 a - 0 | 7 0 a h 0 | 2 0 a - 0 | 11 0 m - 1 | 13 6 m - 1 | 4 0 x h 0 | 38 0 x - 0 | 5 0 x - 0
10 0 - h 1 | 35 0 - - 1 | 2 0 - - 1 | 48 0 - - 1 | 10 10 - - 0 | 3 0 - h 0 | 7 7 - - 0 | 6 6 - - 0
4 0 m h 1 | 2 0 m - 1 | 1 0 x - 0 | 2 0 m - 1
1 0 m - 1 | 90 0 a - 0 | 3 1 m - 1 | 30 14 m - 1 | 1 0 a - 0
3 3 a - 0 | 2 0 m - 1 | 14 0 x - 0 | 200 0 m - 1 | 1 0 m - 1
12 12 a - 0 | 6 0 m h 1 | 5 0 m - 1 | 4 0 m - 1
6 6 a - 0 | 7 0 m h 1 | 70 3 m - 1 | 9 0 m - 1 | 64 2 m - 1 | 14 6 m - 1 | 33 0 m - 1 | 4 4 a - 0
30 0 - - 1
150 3 - - 1
8 0 - - 0
2 0 m - 1
"""

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<(?P<hidden>{'|'.join(RAW)})(?=[\s/>])(?:\"[^\"]*\"|'[^']*'|[^'\">])*>.*?(?:</(?P=hidden)(?=[\s/>])[^>]*(?:>|\Z)|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-z][^\s/>]*)(?P<attributes>(?:\"[^\"]*\"|'[^']*'|[^'\"<>])*|[^>]*?)(?:>|\Z|(?=<))"
    r"|<[!?/][^>]*(?:>|\Z)"
    r"|(?P<text>[^<]+|<)",
    re.IGNORECASE | re.DOTALL,
)
#: A tag that closes itself; the slash of a value without quotes is the value's.
_CLOSED = re.compile(r"(?<!=)(?:^|[\s\"']|(?:^|\s)[^\s=\"']+)/\s*\Z")
_ATTRIBUTE = re.compile(r"([a-z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)


def says_aside(names: list[list[str]]) -> bool:
    """Whether one of the names, each the words of a class, id or role, is that of an aside.

    Beside a name that says main text only whole names and their first words count, as in
    `content layout-sidebar`; else any word does, as in `site-footer`, unless a modifier begins the name.
    """
    if any(len(name) == 1 and name[0] in MAIN_WORDS for name in names):
        return any(name[0] in ASIDE_WORDS for name in names)
    return any(name[0] not in MODIFIERS and not ASIDE_WORDS.isdisjoint(name) for name in names)


def role(tag: str, attributes: str, nested: bool = False) -> str:
    """What an element says it holds: m main text, a something else, nothing. nested: it is in an article."""
    if tag in ASIDE:
        return "a"
    names: list[list[str]] = []
    if attributes:
        for name, *values in _ATTRIBUTE.findall(attributes):
            value = "".join(values).lower()
            if name.lower() in ("class", "id", "role"):
                names += [found for x in value.split() if (found := re.findall(r"[a-z]+", x))]
            elif name.lower() == "aria-hidden" and value == "true" or name.lower() == "style" and "display:none" in value.replace(" ", ""):
                return "a"
        if re.search(r"(?<![\w-])hidden(?![\w=-])", attributes):
            return "a"
    if tag in MAIN:
        aside = nested and tag == "article" and any(len(name) == 1 and name[0] in ASIDE_WORDS for name in names)
        return "a" if aside else "m"
    if tag not in ("body", "html") and says_aside(names):
        return "a"
    return "m" if tag not in INLINE and any(not MAIN_WORDS.isdisjoint(name) for name in names) else ""


class Open:
    """The open elements, with what is asked of them kept up to date, so that no token walks through all."""

    def __init__(self):
        self.elements: list[tuple[str, str, str]] = []  # tag, kind, and the place that its text has
        self.hidden: list[int] = []  # where elements of kind h are
        self.where: dict[str, list[int]] = {}  # where elements of each tag are

    def push(self, tag: str, kind: str) -> None:
        place = self.place
        # The header of an article is its headline; any other aside in it is one.
        if kind == "m" and not place:
            place = "m"
        elif kind == "a" and not (tag == "header" and place == "m"):
            place = "x" if place in ("m", "x") else "a"
        if kind == "h":
            self.hidden.append(len(self.elements))
        self.where.setdefault(tag, []).append(len(self.elements))
        self.elements.append((tag, kind, place))

    def close(self, at: int) -> None:
        """Close the element at a place and all in it."""
        while len(self.elements) > at:
            tag, kind, _ = self.elements.pop()
            self.where[tag].pop()
            if kind == "h":
                self.hidden.pop()

    def close_last(self, tags: Collection[str]) -> None:
        """Close the innermost elements as long as they are of these tags."""
        while self.elements and self.elements[-1][0] in tags:
            self.close(len(self.elements) - 1)

    def last(self, tag: str) -> int | None:
        return self.where[tag][-1] if self.where.get(tag) else None

    @property
    def place(self) -> str:
        return self.elements[-1][2] if self.elements else ""


def blocks(html: str | None) -> list[tuple[str, int, int, str, bool]]:
    """Text, words, linked words, place (as in LABELLED) and whether it is a heading, of each block.

    The time is in proportion to the page, also where elements are never closed.
    """
    found: list[tuple[str, int, int, str, bool]] = []
    stack = Open()
    parts: list[str] = []
    linked, anchor, heading = 0, 0, False

    def flush() -> None:
        nonlocal linked, heading
        text = " ".join("".join(parts).split())
        if text:
            words = len(text.split())
            found.append((text, words, min(words, linked), stack.place or "-", heading))
        parts.clear()
        linked = 0

    for token in _TOKEN.finditer(html or ""):
        if token["text"] is not None:
            if stack.hidden:
                continue
            text = references.unescape(token["text"])
            parts.append(text)
            if anchor:
                linked += len(text.split())
            continue
        tag = (token["tag"] or "").lower()
        if not tag:
            continue
        if not token["end"] and tag in PARAGRAPH_ENDS:
            # A film or drawing surface that is never closed ends with its paragraph.
            opened = stack.hidden[0] if stack.hidden else 0
            if opened and stack.elements[opened - 1][0] == "p" and stack.elements[opened][0] in ("video", "audio", "canvas"):
                stack.close(opened)
        hidden = bool(stack.hidden)
        if tag in HIDDEN and not token["end"]:
            if not _CLOSED.search(token["attributes"] or ""):
                stack.push(tag, "h")
            continue
        if hidden and not token["end"]:
            if tag not in VOID and not _CLOSED.search(token["attributes"] or ""):
                stack.push(tag, "")
            continue
        at = stack.last(tag)
        if hidden:
            # What is hidden ends by its own tag, which parts no text, or by its parent's.
            if at is None:
                continue
            if stack.hidden[0] <= at:
                stack.close(at)
                continue
        if tag == "br":
            parts.append(" ")
        if tag not in INLINE:
            flush()
        if token["end"]:
            if tag == "a":
                anchor = 0
            if at is not None:
                stack.close(at)
            heading = False
            continue
        if tag not in INLINE:
            heading = len(tag) == 2 and tag[0] == "h" and tag[1].isdigit()
            stack.close_last(("p",))  # a paragraph ends where the next block begins
            stack.close_last(SIBLINGS.get(tag, ()))
        if tag == "a":
            anchor = 1
        if tag in VOID:
            continue
        kind = role(tag, token["attributes"] or "", stack.last("article") is not None)
        if tag in MAIN and kind == "m":
            stack.close_last(("nav", "header", "p"))  # never closed
        if tag not in INLINE or kind:
            stack.push(tag, kind)
    flush()
    return found


def described(found: list[tuple[str, int, int, str, bool]]) -> list[list[float]]:
    """The features of each block, with those of its neighbours."""
    main = any(place == "m" for *_, place, _ in found)
    own = [(float(min(words, 200)), linked / words) for _, words, linked, _, _ in found]
    around = [(0.0, 0.0), *own, (0.0, 0.0)]
    return [
        [*around[k + 1], *around[k], *around[k + 2], float(place == "m"), float(main and place != "m"), float(place in "ax"), float(heading)]
        for k, (_, _, _, place, heading) in enumerate(found)
    ]


def labelled() -> list[tuple[list[float], float]]:
    """The rows of LABELLED as features and label."""
    rows = []
    for page in LABELLED.strip().splitlines():
        fields = [block.split() for block in page.split("|")]
        features = described([("", int(w), int(links), place, h == "h") for w, links, place, h, _ in fields])
        rows += [(x, float(f[4])) for x, f in zip(features, fields, strict=True)]
    return rows


def decision(spark: SparkSession):
    """A function from features to whether they are main text, as the fitted tree's comparisons."""
    rows = spark.createDataFrame(labelled(), "features array<double>, label double")
    learner = DecisionTreeClassifier(maxDepth=8, minInstancesPerNode=1, maxBins=64, seed=1)
    model = learner.fit(rows.select(array_to_vector("features").alias("features"), "label"))

    def branch(node, features: Column) -> Column:
        if node.subtreeDepth() == 0:
            return F.lit(node.prediction() == 1.0)
        split = node.split()
        left, right = branch(node.leftChild(), features), branch(node.rightChild(), features)
        return F.when(features[split.featureIndex()] <= split.threshold(), left).otherwise(right)

    root = model._call_java("rootNode")
    return lambda features: branch(root, features)


def main_texts(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page, with the number of its blocks and of those kept."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for low in range(0, len(batch), 64):
                part = batch.iloc[low : low + 64]
                found = [blocks(x) for x in part["html"]]
                yield pd.DataFrame(
                    {
                        "page_id": part["page_id"],
                        "url": part["url"],
                        "blocks": [
                            [{"text": b[0], "features": x} for b, x in zip(page, described(page), strict=True)] for page in found
                        ],
                    }
                )

    read = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html")
    flat = read.mapInPandas(cut, "page_id long, url string, blocks array<struct<text:string,features:array<double>>>")
    is_main = decision(pages.sparkSession)
    kept = F.filter("blocks", lambda b: is_main(b["features"]))
    return flat.select("page_id", "url", F.size("blocks").alias("n_blocks"), kept.alias("kept")).select(
        "page_id",
        "url",
        F.array_join("kept.text", " ").alias("text"),
        F.length(F.array_join("kept.text", " ")).cast("long").alias("n_chars"),
        "n_blocks",
        F.size("kept").alias("n_kept"),
    )


def op2_main_text(spark: SparkSession, folder: str) -> DataFrame:
    """The main text of every page."""
    return main_texts(table(spark, folder, "pages"))
