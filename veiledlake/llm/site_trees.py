"""Main text of web pages by a style tree for each site."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from html import unescape

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from veiledlake.llm.common import broadcast_if_small, fresh, settled, ship

# A branch stays if its importance and what its names say add up to this.
KEEP = 0.3
# What names add to the importance inside of a main part, and take from it outside, where the page has one.
PRIOR = 0.2
# How much the spread of styles counts against the content of a node with so many styles.
GAMMA = 0.9
# Counts that a task holds before it passes them on.
HELD = 200_000

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong "
    "sub sup time tt u var br wbr img".split()
)
# Nothing in these is text of a page.
SILENT = frozenset(
    "head title script style noscript template svg math iframe object select button textarea canvas audio video "
    "option datalist map".split()
)
MAIN = frozenset(["article", "main"])
ASIDE = frozenset("nav header footer aside form menu dialog fieldset".split())
ASIDE_NAMES = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|adv|advert|adverts|advertisement|banner|sponsor|sponsored|promo|nav|navbar|navigation|menu|"
    r"breadcrumb|breadcrumbs|header|masthead|footer|sidebar|aside|widget|related|recommended|share|social|cookie|"
    r"cookies|consent|notice|notices|alert|popup|modal|newsletter|subscribe|signup|login|search|comment|comments|"
    r"replies|disqus|pagination|pager|toolbar|skip)(?:$|[\s_-])",
    re.IGNORECASE,
)
# Start tags that end an open element of the same family.
ENDS = {
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "tr": {"tr", "td", "th"},
    "td": {"td", "th"},
    "th": {"td", "th"},
    "option": {"option"},
}
WALLS = frozenset("article main section div body ul ol dl table nav aside header footer form blockquote".split())


# A comment, a declaration, or a tag with its attributes; a quote that never ends is a sign like others.
MARKUP = re.compile(
    r"""<(?:!--(?:-?>|.*?(?:--!?>|\Z))|[!?][^>]*+(?:>|\Z)|(/?)([A-Za-z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+|[^>]*+)(?:>|\Z))""",
    re.DOTALL,
)
NAMES = re.compile(r"""(?<![^\s"'/])(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
RAW = {t: re.compile(rf"</{t}(?=[\s/>])", re.IGNORECASE) for t in ("script", "style", "title", "textarea", "iframe", "noscript")}


class Tree:
    """Blocks of text in page order, each with the branch it stands on; and the styles of elements.

    A branch is a list of (path, prior): a path hashes the names from the root down, the prior is what names say:
    1 for the main part, 0 for others, -1 for what never is main text.
    """

    def __init__(self) -> None:
        self.open: list[list] = [["#", 0, 0, []]]  # name, path, prior, names of children
        self.blocks: list[tuple[list[tuple[int, int]], str]] = []
        self.styles: list[tuple[int, int]] = []
        self._text: list[str] = []
        self._silent = 0

    def feed(self, html: str) -> None:
        at = 0
        while mark := MARKUP.search(html, at):
            if mark.start() > at:
                self.data(html[at : mark.start()])
            at = mark.end()
            if mark[2]:
                tag = mark[2].lower()
                if mark[1]:
                    self.end_tag(tag)
                else:
                    self.start_tag(tag, mark[3])
                    if tag in RAW:
                        stop = RAW[tag].search(html, at)
                        at = stop.start() if stop else len(html)
        self.data(html[at:])
        self._flush()
        while len(self.open) > 1:
            self._pop()

    def start_tag(self, tag: str, attributes: str) -> None:
        if tag in VOID:
            if tag == "br":
                self._text.append(" ")
            elif tag == "hr":
                self._flush()
            return
        if tag == "body":
            while len(self.open) > 1 and self.open[-1][0] in ("head", "title"):
                self._pop()
        if tag not in INLINE:
            self._flush()
            self._close_for(tag)
        if tag in INLINE:
            self.open.append([tag, 0, 0, []])
            return
        names = ""
        if attributes:
            names = unescape(" ".join(a or b or c for a, b, c in NAMES.findall(attributes)))
        parent = next(e for e in reversed(self.open) if e[0] not in INLINE)
        path, prior = _node(parent[1], tag, names)
        if not (parent[3] and parent[3][-1] == tag):
            parent[3].append(tag)
        self.open.append([tag, path, prior, []])
        self._silent += tag in SILENT

    def end_tag(self, tag: str) -> None:
        for i in range(len(self.open) - 1, 0, -1):
            name = self.open[i][0]
            if name == tag:
                if tag not in INLINE:
                    self._flush()
                while len(self.open) > i:
                    self._pop()
                return
            if name in WALLS and (tag not in WALLS or tag in INLINE):
                return

    def data(self, text: str) -> None:
        if not self._silent:
            self._text.append(unescape(text) if "&" in text else text)

    def _close_for(self, tag: str) -> None:
        """Elements that a start tag ends: a paragraph by any block, and a cell or item by the next."""
        ends = ENDS.get(tag, set())
        for i in range(len(self.open) - 1, 0, -1):
            name = self.open[i][0]
            if name == "p" or name in ends:
                while len(self.open) > i:
                    self._pop()
                if name == "p" and ends:
                    continue
                return
            if name in WALLS or name in ("td", "th", "li") and name not in ends:
                return

    def _pop(self) -> None:
        name, path, _, children = self.open.pop()
        self._silent -= name in SILENT
        if children and name not in INLINE:
            self.styles.append((path, _hash(" ".join(children))))

    def _flush(self) -> None:
        text = " ".join("".join(self._text).split())
        self._text = []
        if text:
            branch = [(e[1], e[2]) for e in self.open[1:] if e[0] not in INLINE and e[0] not in ("html", "body")]
            self.blocks.append((branch, text))


@lru_cache(1 << 14)
def _node(parent: int, tag: str, names: str) -> tuple[int, int]:
    """Path and prior of an element; numbers in names do not count."""
    prior = -1 if tag in ASIDE or ASIDE_NAMES.search(names) else int(tag in MAIN)
    return _hash(f"{parent}>{tag}.{re.sub(r'[0-9]+', '', names)}"), prior


def _hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "replace")) - (1 << 63)


def parse(html: str | None) -> Tree:
    tree = Tree()
    tree.feed(html or "")
    return tree


def main_text(tree: Tree, low: dict[int, float], other: float = 1.0) -> str:
    """The blocks that stay: no part of their branch may fall below KEEP.

    A path that is not in `low` has importance `other`. On pages with a main part, names add to the importance inside
    it and take from it outside; importance can outweigh both. Where nothing would stay, names alone decide: a site may
    be copies of one page.
    """
    has_main = any(p == 1 for branch, _ in tree.blocks for _, p in branch if all(q >= 0 for _, q in branch))
    kept = []
    for branch, text in tree.blocks:
        inside = any(p == 1 for _, p in branch)
        side = PRIOR if inside else -PRIOR if has_main else 0.0
        worth = [low.get(path, other) + (side if p >= 0 else p) for path, p in branch]
        if min(worth, default=other + side) >= KEEP:
            kept.append(text)
    return "\n".join(kept) if kept or not low else main_text(tree, {}, KEEP)


def style_tree(pages: DataFrame, *, url: str = "url", html: str = "html") -> DataFrame:
    """The less important branches of each site: one row per host with a map from path to importance below 1.

    Pages of a host are merged into one tree: equal paths are one node. Of a node that m pages have, the content's
    importance is 1 less the mean entropy of its texts, where a text on k pages has entropy log(k) / log(m); the
    presentation's is the entropy of its styles (orders of children), to the base m. They are weighed by the number of
    styles. A node of one page has importance 1. Only nodes that could fall below KEEP (beside names) are listed.

    Counts are added up in the tasks first, so a host with very many pages is no hot key: its rows are spread by node
    and text.
    """
    ship(pages.sparkSession)
    counts = (
        pages.select(host_of(url).alias("host"), F.col(html).cast("string").alias("html"))
        .mapInArrow(_count, "host string, path long, kind int, feature long, n long")
        .groupBy("host", "path", "kind", "feature")
        .agg(F.sum("n").alias("n"))
    )
    nodes = counts.groupBy("host", "path").agg(
        F.max(F.when(F.col("kind") == 0, F.col("n"))).alias("m"),
        F.sum(F.when(F.col("kind") == 1, F.log("n"))).alias("shared"),
        F.count(F.when(F.col("kind") == 1, 1)).alias("texts"),
        F.count(F.when(F.col("kind") == 2, 1)).alias("styles"),
        F.sum(F.when(F.col("kind") == 2, F.col("n"))).alias("styled"),
        F.sum(F.when(F.col("kind") == 2, F.col("n") * F.log("n"))).alias("spread"),
    )
    log_m = F.log(F.col("m").cast("double"))
    content = F.greatest(1 - F.col("shared") / F.col("texts") / log_m, F.lit(0.0))
    styled = F.col("styled").cast("double")
    looks = F.least((F.log(styled) - F.col("spread") / styled) / log_m, F.lit(1.0))
    share = F.pow(F.lit(GAMMA), F.col("styles"))
    both = F.when(F.col("styles") > 0, (1 - share) * looks + share * content).otherwise(content)
    low = nodes.where("m > 1 and texts > 0").select("host", "path", both.alias("importance"))
    return low.where(F.col("importance") < KEEP + PRIOR)


def extract(pages: DataFrame, *, url: str = "url", html: str = "html", out: str = "text") -> DataFrame:
    """All rows and columns with the main text of each page; a column named like `out` is replaced.

    Blocks are joined by one line end; white space inside a block is one space; character references are decoded. A
    null or empty page has the empty text. Pages whose url is null or has no host are one site.
    """
    ship(pages.sparkSession)
    low = settled(style_tree(pages, url=url, html=html))
    table = low.groupBy("host").agg(F.map_from_entries(F.collect_list(F.struct("path", "importance"))).alias("low"))
    host, nodes = fresh(pages, "host", "low")
    table = table.toDF(host, nodes)
    small = broadcast_if_small(low) is not low
    joined = pages.join(F.broadcast(table) if small else table, host_of(url) == F.col(host), "left")
    return joined.withColumn(out, _extract(F.col(html).cast("string"), F.col(nodes))).drop(nodes, host)


def host_of(url: str) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(F.col(url), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))


@F.pandas_udf(StringType())
def _extract(htmls: pd.Series, lows: pd.Series) -> pd.Series:
    return pd.Series([main_text(parse(h), _as_dict(x)) for h, x in zip(htmls, lows, strict=True)], dtype=object)


def _as_dict(low) -> dict[int, float]:
    return {} if low is None else low if isinstance(low, dict) else dict(low)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pages of each node (kind 0), of each text below a node (1) and of each style of a node (2)."""
    held: Counter = Counter()
    for batch in batches:
        for host, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            tree = parse(html)
            found = {(path, 2, style) for path, style in tree.styles}
            for branch, text in tree.blocks:
                feature = _hash(text)
                for path, _ in branch:
                    found.add((path, 0, 0))
                    found.add((path, 1, feature))
            held.update((host, *f) for f in found)
            if len(held) >= HELD:
                yield _rows(held)
                held = Counter()
    if held:
        yield _rows(held)


def _rows(held: Counter) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int64())
    columns = zip(*((*k, n) for k, n in held.items()), strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["host", "path", "kind", "feature", "n"]
    )
