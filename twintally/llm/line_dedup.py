r"""Line de-duplication by site-relative frequency (DataFrame functions only).

A line is boilerplate on a host when the share of the host's pages that hold it
exceeds ``ratio`` and at least ``min_pages`` pages do. Those lines are removed
from every page of that host; elsewhere they stay.

Lines are the ``\n``-split pieces of a text, compared after trimming blanks;
blank lines are never counted nor removed. A page that repeats a line counts
once for it, and rows of a host with equal texts are one page: a document copied on
many pages is not boilerplate, it stays for the near-duplicate stage. Defined
cases: NULL text stays NULL and counts as the empty page; a NULL host is a host of
its own; with ``copies_once`` off every row is a page of its own (and a widely copied
document is emptied); a page all of whose lines go keeps its row with an empty text; an
empty table gives no rows; extra columns pass through, whatever their names.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twintally.llm.common import spare_prefix, staged

#: a line on more than this share of its host's pages is boilerplate
RATIO = 0.1
#: and on at least this many pages (a host of a few pages proves nothing)
MIN_PAGES = 3
#: further (ratio, pages) for distinct texts: a line that ten different texts share needs a far smaller share, and a small
#: source stays under the rule above; of 2, 1 and 0.5 %, only at 2 % no page of check_h lost all its lines
COMMON_RULES = ((0.02, 10),)
#: largest boilerplate table (rows) that is broadcast, as one list a host; beyond it lines meet it in a join on (host, line)
BROADCAST_LINES = 50_000
#: longest list of a host that lines are looked up in
HOST_LINES = 2_000
P = "__line_"


def lines(text: Column) -> Column:
    return F.split(text, "\n")


def _key(line: Column) -> Column:
    trimmed = F.btrim(line, F.lit(" \t\r"))
    return F.when(trimmed != "", F.struct(F.xxhash64(trimmed).alias("a"), F.xxhash64(F.lit(1), trimmed).alias("b")))


def line_keys(text: Column) -> Column:
    """128-bit keys of the lines of a text, in order; NULL for blank lines."""
    return F.transform(lines(text), _key)


def boilerplate_lines(docs: DataFrame, host: Column, ratio: float = RATIO, min_pages: int = MIN_PAGES,
                      copies_once: bool = True, more_rules: tuple[tuple[float, int], ...] = ()) -> DataFrame:
    """(host, key, pages, host_pages) of the lines above the ratio, or above that of one of ``more_rules``.

    One pass over the texts: a page gives the keys of its distinct lines and
    one NULL key that counts the page itself, so page totals and line counts
    come from the same partial aggregate; a hot host is spread by its lines.
    Keys travel instead of lines: two 64-bit hashes of the trimmed line.
    ``copies_once`` first reduces the pages of a host to its distinct texts
    (by two hashes of the text; copies meet map-side, their keys travel once).
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    keys = F.array_compact(F.array_distinct(line_keys(text)))
    page = docs.select(host.alias("host"), F.xxhash64(text).alias("a"), F.xxhash64(F.lit(1), text).alias("b"), keys.alias("keys"))
    if copies_once:
        page = page.dropDuplicates(["host", "a", "b"])
    page = page.select("host", F.explode(F.concat("keys", F.array(F.lit(None)))).alias("key"))
    counts = page.groupBy("host", "key").agg(F.count("*").alias("pages"))
    rules = ((ratio, min_pages), *more_rules)
    least = min(n for _, n in rules)
    counts = staged(counts.where((F.col("pages") >= least) | F.col("key").isNull()), "line-counts")
    totals = counts.where(F.col("key").isNull()).select(F.col("host").alias("h"), F.col("pages").alias("host_pages"))
    above = [(F.col("pages") >= n) & (F.col("pages") > F.lit(r) * F.col("host_pages")) for r, n in rules]
    return (counts.where(F.col("key").isNotNull() & (F.col("pages") >= least))
            .join(totals, F.col("host").eqNullSafe(F.col("h")))
            .where(reduce(or_, above))
            .select("host", "key", "pages", "host_pages"))


def drop_boilerplate(docs: DataFrame, host: Column | None = None, ratio: float = RATIO, min_pages: int = MIN_PAGES,
                     broadcast_lines: int = BROADCAST_LINES, report: bool = False, copies_once: bool = True,
                     more_rules: tuple[tuple[float, int], ...] = ()) -> DataFrame:
    """``docs`` with boilerplate lines removed from ``text`` (other columns unchanged).

    While the boilerplate table is within ``broadcast_lines`` rows and no host has
    more than ``HOST_LINES`` (both counted first), texts are read twice and never shuffled. Beyond
    that the lines of a text meet the table by (host, line), and only the numbers of the
    lines to drop travel back to their row. ``report`` adds n_lines and n_dropped.
    """
    p = spare_prefix(docs.columns, P)
    host = F.col("source") if host is None else host
    bad = staged(boilerplate_lines(docs, host, ratio, min_pages, copies_once, more_rules), "line-boilerplate")
    sizes = bad.groupBy("host").agg(F.count("*").alias("n")).agg(F.sum("n"), F.max("n")).first()
    every = lines(F.col("text"))
    if (sizes[0] or 0) <= broadcast_lines and (sizes[1] or 0) <= HOST_LINES:
        per_host = bad.groupBy(F.col("host").alias(p + "host")).agg(F.collect_set("key").alias(p + "bad"))
        joined = docs.withColumn(p + "key", host).join(
            F.broadcast(per_host), F.col(p + "key").eqNullSafe(F.col(p + "host")), "left")
        gone = lambda x, i: F.coalesce(F.array_contains(F.col(p + "bad"), _key(x)), F.lit(False))
        none = F.col(p + "bad").isNull()
    else:
        rows = staged(docs.withColumn(p + "row", F.monotonically_increasing_id()).withColumn(p + "key", host), "line-rows")
        each = rows.select(F.col(p + "row"), F.col(p + "key").alias("h"), F.posexplode(line_keys(F.col("text"))).alias("i", "k"))
        hits = each.where("k is not null").join(bad.select("host", F.col("key").alias("bk")),
                                                F.col("h").eqNullSafe(F.col("host")) & (F.col("k") == F.col("bk")), "left_semi")
        drop = hits.groupBy(p + "row").agg(F.collect_set("i").alias(p + "bad"))            # line numbers of one text
        joined = rows.join(drop.withColumnRenamed(p + "row", p + "at"), F.col(p + "row") == F.col(p + "at"), "left")
        gone = lambda x, i: F.array_contains(F.col(p + "bad"), i)
        none = F.col(p + "bad").isNull()
    kept = F.when(none, every).otherwise(F.filter(every, lambda x, i: ~gone(x, i)))
    out = {c: F.col(f"`{c}`") for c in docs.columns}
    out["text"] = F.array_join(F.col(p + "kept"), "\n")
    cols = [c.alias(n) for n, c in out.items()]
    if report:
        cols += [F.coalesce(F.size(every), F.lit(0)).cast("long").alias("n_lines"),
                 F.coalesce(F.size(every) - F.size(p + "kept"), F.lit(0)).cast("long").alias("n_dropped")]
    return joined.withColumn(p + "kept", kept).select(*cols)
