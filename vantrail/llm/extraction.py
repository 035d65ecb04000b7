"""Main text of web pages by a maximum-scoring subsequence.

A page is a sequence of tags and words. Words score above zero and tags below; words in links and in
parts that are named as something else (menus, adverts, forms, comments, ...) score below zero too.
How much comes from labelled pages: an ``article`` element labels its inside as content and the rest of its
page as other, and a token's weight is the log-odds of the two, held to its sign. One linear
scan finds the stretch of the page with the greatest sum. Its blocks, without the named parts inside, are the text.
Named parts inside an ``article`` score nothing, so they do not cut off what follows them.
A class, id or role can name a wrapper of the whole page too. When the named parts hold more words than the page outside of them,
and no ``article`` or ``main`` is outside, an ``article`` or ``main`` in them opens content again; without one, first the names with other
words in them (``layout sidebar-right``) and then all names are set aside.

All pages with an ``article`` are labelled pages; counts per token kind, at most a few hundred, go to the driver.
Without any, the default weights stand.

Defined cases: a null or empty page has the empty text; comments, scripts and styles may be unclosed at the end of
a page; a part that is never closed ends with the page or with the element around it; ``br`` is white space
inside its block; columns beyond page_id, url and html are not read. Time is linear in the page.
"""

from __future__ import annotations

import html as html_names
import math
import re
from collections import Counter
from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from vantrail.llm.words import slices

#: Elements whose inside is never main text.
PARTS = frozenset("nav header footer aside form menu dialog head title button select option label input textarea".split())
#: Elements whose inside is not even markup.
RAW = frozenset("script style noscript template iframe svg math object canvas audio video".split())
BLOCKS = frozenset(
    "address article blockquote body caption center dd details div dl dt fieldset figcaption figure h1 h2 h3 h4 h5 h6 hr html li main ol p pre "
    "section summary table tbody td tfoot th thead tr ul".split()
)
INLINE = frozenset("a abbr b bdi bdo big br cite code data del dfn em font i img ins kbd mark meta link q ruby s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Words of class, id or role that name a part as something else.
NAMES = frozenset(
    "ad ads advert adverts advertisement banner sponsor sponsored promo promotion cookie cookies consent notice notices alert popup modal newsletter subscribe "
    "nav navbar navigation menu breadcrumb breadcrumbs sidebar side rail widget related recommended share sharing social comment comments "
    "disqus replies respond reply footer header masthead toolbar pagination pager login signup search complementary contentinfo".split()
)
NOT = frozenset("has no not with without".split())
#: Elements that hold a page's content: their end closes what is still open inside.
AROUND = ("article", "main", "body")

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<![^>]*(?:>|\Z)|<\?[^>]*(?:>|\Z)|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)|<(?=[/A-Za-z])[^>]*(?:>|\Z)|[^<]+|<", re.S)
_ATTRIBUTE = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_PIECES = re.compile(r"[a-z]+")

DEFAULT = {"word": 1.0, "link word": -0.5, "part word": -1.0, "part tag": -0.2, "tag": -0.2}


def named_as_other(attributes: str, whole: bool = False) -> bool:
    """Whether a word of class, id or role names a part, or all of it does; ``no-sidebar`` and the like say what the element is not."""
    for a, b, c in _ATTRIBUTE.findall(attributes):
        for word in (a or b or c).lower().split():
            pieces = _PIECES.findall(word)
            if pieces and NOT.isdisjoint(pieces) and (NAMES.issuperset(pieces) if whole else not NAMES.isdisjoint(pieces)):
                return True
    return False


#: How names are read: all of them; with an article or main inside opening content again; whole names only; none.
STRICT, REOPENED, WHOLE, UNNAMED = range(4)


def parse(page: str) -> list[tuple[str, str, bool]]:
    """The tokens under the first reading of names that leaves an article, a main or most words outside of named parts."""
    for names in (STRICT, REOPENED, WHOLE, UNNAMED):
        tally: Counter[str] = Counter()
        parsed = list(tokens(page, names, tally))
        if tally["contents"] or tally["named"] <= tally["open"]:
            break
    return parsed


def tokens(page: str, names: int = STRICT, tally: Counter[str] | None = None) -> Iterator[tuple[str, str, bool]]:
    """(kind, value, inside article) in page order: kind is ``word``, ``link word``, ``part word``, or a tag's name.

    The value of words is their raw text; of tags it is ``block`` or empty.
    """
    closed: list[tuple[str, int]] = []  # the open parts: name, and how many of the same name are open inside
    inner: Counter[str] = Counter()  # content elements open inside a part
    tally = Counter() if tally is None else tally
    articles = links = 0
    at, end = 0, len(page)
    while at < end:
        m = _TOKEN.match(page, at)
        at = m.end()
        name = m[2]
        if name is None:
            if page[m.start()] != "<" or at == m.start() + 1:
                tally["open" if not closed else "part" if closed[0][0] in PARTS else "named"] += len(m[0].split())
                yield ("part word" if closed else "link word" if links else "word"), m[0], articles > 0
            continue
        name, ends = name.lower(), m[1] == "/"
        if name in RAW:
            if not ends and not m[3].endswith("/"):
                close = re.compile(rf"</{re.escape(name)}\b[^>]*(?:>|\Z)", re.I).search(page, at)
                at = close.end() if close else end
            continue
        if name in ("article", "main") and not ends:
            if closed and names == REOPENED and not articles and PARTS.isdisjoint(n for n, _ in closed):
                closed.clear()
                inner.clear()
            tally["contents"] += not closed
        yield ("part tag" if closed else f"/{name}" if ends else name), "block" if name in BLOCKS or name in PARTS else "", articles > 0
        if name == "article" and not closed:
            articles = max(0, articles + (-1 if ends else 1))
        if name == "a":
            links = 0 if ends else 1
        if name in VOID:
            continue
        if closed and name == closed[-1][0]:
            depth = closed[-1][1] + (-1 if ends else 1)
            closed[-1] = (name, depth)
            if not depth:
                closed.pop()
        elif closed and name in AROUND and (not ends or inner[name]):
            inner[name] += -1 if ends else 1
        elif ends:
            if name in AROUND:
                closed.clear()  # the element around has ended
            elif name in [n for n, _ in closed]:
                while closed.pop()[0] != name:
                    pass
        elif name in PARTS or (names != UNNAMED and name not in ("body", "html", "main") and (name != "article" or articles > 1) and m[3] and named_as_other(m[3], names == WHOLE)):
            closed.append((name, 1))
        if not closed:
            inner.clear()


def kind_of(token: str) -> str:
    """The key of a token's weight; tags that are not in the lists share one."""
    if " " in token or token == "word":
        return token
    name = token.lstrip("/")
    return f"<{token}>" if name in BLOCKS or name in INLINE or name in PARTS else "<other>"


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    inside, outside = Counter(), Counter()
    for batch in batches:
        for part in slices(batch, "html"):
            for page in part.column("html").to_pylist():
                if page and "<article" in page.lower():
                    for token, value, content in parse(page):
                        if token == "part tag":
                            continue
                        kind = kind_of(token)
                        (inside if content else outside)[kind] += len(value.split()) if kind[0] != "<" else 1
    kinds = sorted(inside.keys() | outside.keys())
    yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.string()), pa.array([inside[k] for k in kinds], pa.int64()), pa.array([outside[k] for k in kinds], pa.int64())], names=["kind", "inside", "outside"])


def weights(pages: DataFrame) -> dict[str, float]:
    """Log-odds of content by token kind: words 0.2 to 2, all else -2 to -0.05."""
    counts = pages.select("html").where(F.col("html").isNotNull()).mapInArrow(_count, "kind string, inside long, outside long")
    rows = counts.groupBy("kind").agg(F.sum("inside").alias("inside"), F.sum("outside").alias("outside")).collect()
    total = sum(r["inside"] for r in rows) + 1, sum(r["outside"] for r in rows) + 1
    out = dict(DEFAULT)
    for r in rows:
        odds = math.log((r["inside"] + 1) / total[0]) - math.log((r["outside"] + 1) / total[1])
        out[r["kind"]] = min(2.0, max(0.2, odds)) if r["kind"] == "word" else min(-0.05, max(-2.0, odds / 4 if r["kind"][0] == "<" else odds))
    return out


def main_text(page: str, weight: Mapping[str, float]) -> str:
    """The blocks of the stretch with the greatest sum of weights, joined by line breaks."""
    parsed = parse(page)
    best, best_range, total, start = 0.0, (0, 0), 0.0, 0
    for i, (token, value, content) in enumerate(parsed):
        if content and token in ("part word", "part tag"):
            continue
        if token == "word" or " " in token:
            total += weight[token] * len(value.split())
        else:
            total += weight.get(kind_of(token), weight["tag"])
        if total <= 0:
            total, start = 0.0, i + 1
        elif total > best:
            best, best_range = total, (start, i + 1)
    blocks, current = [], []
    for token, value, _ in parsed[best_range[0] : best_range[1]]:
        if token in ("word", "link word"):
            current.append(value)
        elif token == "br":
            current.append(" ")
        elif value == "block":
            blocks.append("".join(current))
            current = []
    blocks.append("".join(current))
    clean = (" ".join(html_names.unescape(b).split()) for b in blocks)
    return "\n".join(b for b in clean if b)


def _extract(weight: Mapping[str, float]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "html"):
                texts = [main_text(p, weight) if p else "" for p in part.column("html").to_pylist()]
                columns = [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "text", "n_chars"])

    return run


def extract(pages: DataFrame, weight: Mapping[str, float] | None = None) -> DataFrame:
    """page_id, url, text, n_chars per row of ``pages``."""
    weight = weights(pages) if weight is None else {**DEFAULT, **weight}
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    return rows.mapInArrow(_extract(weight), "page_id long, url string, text string, n_chars long")


def op1_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html"))
