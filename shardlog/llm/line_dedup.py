"""Removal of repeated lines, by windows of three, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shardlog.llm.common import ROW, col, pinned
from shardlog.session import store

LINES = 3


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _windows(lines: Column, size: int) -> Column:
    """The 128-bit hash of every ``size`` consecutive lines; null where all are blank."""
    places = F.sequence(F.lit(1), F.size(lines) - (size - 1))

    def of(i: Column) -> Column:
        window = F.array_join(F.slice(lines, i, F.lit(size)), "\n")
        return F.when(F.trim(F.translate(window, "\n\t\r", "")) != "", F.unhex(F.md5(window)))

    return F.when(F.size(lines) >= size, F.transform(places, of))


def _kept(lines: Column, starts: Column, size: int) -> Column:
    """The lines outside the windows at the sorted ``starts``: those before the first,
    between the end of one and the start of the next, and after the last."""
    n = F.size(starts)
    gaps = F.transform(
        F.sequence(F.lit(0), n),
        lambda k: F.struct(
            F.when(k == 0, F.lit(0)).otherwise(F.get(starts, k - 1) + size).alias("begin"),
            F.when(k == n, F.size(lines)).otherwise(F.get(starts, k)).alias("end"),
        ),
    )
    return F.flatten(F.transform(F.filter(gaps, lambda g: g["end"] > g["begin"]), lambda g: F.slice(lines, g["begin"] + 1, g["end"] - g["begin"])))


def dedup_lines(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", size: int = LINES, carry: bool = False) -> DataFrame:
    """Per row of ``docs``: id, n_lines, n_removed and ``text`` without repeated lines,
    with the other columns of the input row in ``_row`` if ``carry``.

    Lines end at line feeds and count exactly as they are. ``size`` consecutive lines
    are a window, unless all are blank. Of equal windows anywhere, that of the smallest
    (id, text hash, line) stays, null ids first; every line that any other covers is
    removed. Rows equal in id and text are one document: they get the same result. A
    row of fewer lines has no window and stays as it is; a null text stays null with
    no lines, an empty text is one empty line.

    Lines are joined to their windows' first places by the window's hash, so a window
    in very many documents is counted before it is shuffled, and its rows are dealt
    to several tasks by adaptive execution. Each text is shuffled once.
    """
    rest = F.struct(F.lit(0).alias("_"), *[col(c) for c in docs.columns if c != text_col]).alias(ROW)
    rows = docs.select(
        col(id_col).alias("id"), F.xxhash64(col(text_col)).alias("digest"), pinned(_lines(col(text_col))).alias("lines"), *([rest] if carry else [])
    )
    windows = (
        rows.select("id", "digest", pinned(_windows(F.col("lines"), size)).alias("windows"))
        .select("id", "digest", F.posexplode("windows").alias("line", "window"))
        .where("window is not null")
        .select("window", "id", "digest", "line")
    )
    where = F.struct("id", "digest", "line")
    # Written down, so that the join below has shuffles of its own: they can be split.
    repeated = store(windows.groupBy("window").agg(F.min(where).alias("first"), F.max(where).alias("last")).where("not (first <=> last)"), "windows")
    later = windows.join(repeated.select("window", "first"), "window").where(~where.eqNullSafe(F.col("first")))
    starts = later.groupBy(F.col("id").alias("gone_id"), F.col("digest").alias("gone_digest")).agg(F.sort_array(F.collect_set("line")).alias("starts"))
    joined = rows.join(starts, F.col("id").eqNullSafe(F.col("gone_id")) & (F.col("digest") == F.col("gone_digest")), "left")
    joined = joined.withColumn("starts", pinned(F.coalesce("starts", F.array().cast("array<int>"))))
    out = joined.select(
        "id", F.when(F.col("lines").isNull(), 0).otherwise(F.size("lines")).alias("n"), "lines", pinned(_kept(F.col("lines"), F.col("starts"), size)).alias("kept"), *([ROW] if carry else [])
    )
    return out.select(
        "id",
        F.col("n").cast("long").alias("n_lines"),
        F.when(F.col("lines").isNull(), 0).otherwise(F.col("n") - F.size("kept")).cast("long").alias("n_removed"),
        F.when(F.col("lines").isNotNull(), F.array_join("kept", "\n")).alias("text"),
        *([ROW] if carry else []),
    )


def without_repeats(docs: DataFrame, *, text_col: str = "text", **options) -> DataFrame:
    """``docs`` with repeated lines removed from its text, and without the rows of
    which nothing is left. A column ``n_chars`` is counted anew."""
    out = dedup_lines(docs, text_col=text_col, carry=True, **options)
    out = out.where((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_lines")))
    new = {text_col: F.col("text"), "n_chars": F.char_length("text").cast("long")}
    return out.select(*[new[c].alias(c) if c in new else F.col(ROW)[c].alias(c) for c in docs.columns])
