"""Line dedup by site-relative frequency."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veiledlake.llm.common import broadcast_if_small, fresh, settled

RATIO = 0.1
# A line on one page only repeats nothing, whatever its share of a small host.
MIN_PAGES = 2


def site_lines(
    docs: DataFrame, *, text: str = "text", host: str = "source", ratio: float = RATIO, min_pages: int = MIN_PAGES
) -> DataFrame:
    """The lines that count as boilerplate: one row per host with `_marks`, the digests of its lines.

    A line counts once per page. It is boilerplate if it stands on at least `min_pages` pages of the host and on more
    than `ratio` of them. A host holds at most (mean number of lines) / ratio such lines, so the arrays stay short
    however many pages there are. Blank lines never count. A null host is a host of its own.
    """
    pages = docs.select(F.col(host).alias("_host"), F.array_distinct(_marks(F.col(text))).alias("_marks"))
    counts = (
        pages.select("_host", F.explode_outer("_marks").alias("_mark"))
        .groupBy("_host", "_mark")
        .agg(F.count("*").alias("_pages"))
        .where(F.col("_mark").isNotNull() & (F.col("_pages") >= min_pages))
    )
    totals = docs.groupBy(F.col(host).alias("_host")).agg(F.count("*").alias("_total"))
    return (
        counts.alias("c")
        .join(totals.alias("t"), F.col("c._host").eqNullSafe(F.col("t._host")))
        .where(F.col("_pages") > ratio * F.col("_total"))
        .groupBy("c._host")
        .agg(F.collect_list("_mark").alias("_marks"))
    )


def drop_site_lines(
    docs: DataFrame,
    *,
    text: str = "text",
    host: str = "source",
    ratio: float = RATIO,
    min_pages: int = MIN_PAGES,
) -> DataFrame:
    """All rows and columns with the boilerplate lines of their host cut from the text, and `n_lines`, `n_dropped`.

    A page that would lose every line it has keeps them all: what fills a whole page is its content (copies of pages
    are no matter of this operator). A null text stays null with 0 lines; the empty text has one line, a blank one.
    Lines end with \\n; other white space belongs to the line. Columns named `n_lines` or `n_dropped` are replaced.
    """
    found = settled(site_lines(docs, text=text, host=host, ratio=ratio, min_pages=min_pages))
    sized = found.select("_host", F.explode("_marks").alias("_mark"))
    site, marks, parts, left = fresh(docs, "site", "marks", "lines", "kept")
    hosts = found.select(F.col("_host").alias(site), F.col("_marks").alias(marks))
    if sized.isEmpty():
        joined = docs.withColumn(marks, F.lit(None).cast("array<binary>"))
    else:
        small = broadcast_if_small(sized)
        hosts = F.broadcast(hosts) if small is not sized else hosts
        joined = docs.join(hosts, F.col(host).eqNullSafe(F.col(site)), "left").drop(site)
    parted = joined.withColumn(parts, F.split(F.col(text), "\n", -1))
    kept = F.when(
        F.col(marks).isNotNull(),
        F.filter(parts, lambda line: (F.trim(line) == "") | ~F.array_contains(F.col(marks), _mark(line))),
    ).otherwise(F.col(parts))
    marked = parted.withColumn(left, kept)
    only_blank = ~F.exists(left, lambda line: F.trim(line) != "")
    final = F.when(only_blank, F.col(parts)).otherwise(F.col(left))
    n_lines = F.coalesce(F.size(parts), F.lit(0))
    return marked.withColumns(
        {
            text: F.array_join(final, "\n"),
            "n_lines": F.when(F.col(parts).isNull(), 0).otherwise(n_lines).cast("long"),
            "n_dropped": F.when(F.col(parts).isNull(), 0).otherwise(n_lines - F.size(final)).cast("long"),
        }
    ).drop(marks, parts, left)


def _marks(text: Column) -> Column:
    lines = F.split(text, "\n", -1)
    return F.transform(F.filter(lines, lambda line: F.trim(line) != ""), _mark)


def _mark(line: Column) -> Column:
    return F.unhex(F.md5(line))
