"""Document fingerprints by one-permutation MinHash, in DataFrame functions only.

Every shingle is hashed once. The hash names one of BINS bins, and its other bits
compete for the least value there. A bin that got nothing takes the value of another
one: each bin has an order of its own in which it asks the others (optimal
densification), and takes the first that has a value. The orders are the multiples
``start + t * step`` modulo BINS, a prime, so each bin is asked once, and any two of them
come in either order for as many steps. Of each value only the LOW_BITS lowest are kept,
16 bins in a long. By chance 1 in 2^LOW_BITS of unequal bins agree; ``likeness`` takes
that out again.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shardlog.llm.common import narrow, pinned
from shardlog.llm.licenses import SHINGLE, shingle_hashes, words_of

BINS = 251
LOW_BITS = 8
_PER_LONG = 64 // LOW_BITS
_LONGS = -(-BINS // _PER_LONG)
# A bin number stands above the value it competes with; the bit below it says "empty".
_VALUE_BITS = 53
_EMPTY = 1 << _VALUE_BITS
# How many other bins are asked one by one before the first that answers is searched for.
PROBES = 24
# Documents that one window sorts, while there are fewer than MOST_CHUNKS windows.
CHUNK_ROWS = 256
MOST_CHUNKS = 8192


def _spread(i: int, salt: int) -> int:
    """A fixed 64-bit mix of two small numbers (the finaliser of splitmix64)."""
    x = (i * 0x9E3779B97F4A7C15 + salt * 0xD1B54A32D192ED03 + 0x632BE59BD9B4E019) % 2**64
    x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 % 2**64
    x = (x ^ x >> 27) * 0x94D049BB133111EB % 2**64
    return x ^ x >> 31


STARTS = [_spread(i, 1) % BINS for i in range(BINS)]
STEPS = [1 + _spread(i, 2) % (BINS - 1) for i in range(BINS)]


def asked(i: int, t: int) -> int:
    """The bin that the empty bin ``i`` asks at its step ``t``."""
    return (STARTS[i] + t * STEPS[i]) % BINS


def _constant(values: list[int], kind: str = "bigint") -> Column:
    return F.from_json(F.lit(json.dumps(values)), f"array<{kind}>")


def shingles_of(words: Column) -> Column:
    """The hashes of all five words in a row; of all words if there are fewer."""
    short = F.when(F.size(words) > 0, F.array(F.xxhash64(words))).otherwise(F.array().cast("array<bigint>"))
    return F.when(F.size(words) >= SHINGLE, shingle_hashes(words)).otherwise(short)


def _sorted_bins(shingles: Column) -> Column:
    """(bin, value) of all shingles and an empty mark for every bin, in order."""
    placed = F.transform(
        shingles,
        lambda h: F.shiftleft(F.pmod(h, F.lit(BINS)), _VALUE_BITS + 1).bitwiseOR(F.shiftrightunsigned(h, 64 - _VALUE_BITS)),
    )
    return F.sort_array(F.concat(placed, _constant([b << _VALUE_BITS + 1 | _EMPTY for b in range(BINS)])))


def _least(ordered: Column) -> Column:
    """The least value of each bin, null where it is empty."""
    bin_of = lambda x: F.shiftright(x, _VALUE_BITS + 1)
    first = F.filter(ordered, lambda x, i: (i == 0) | (bin_of(F.get(ordered, i - 1)) != bin_of(x)))
    return F.transform(first, lambda x: F.when(x.bitwiseAND(_EMPTY) == 0, x.bitwiseAND(_EMPTY - 1)))


def _densified(least: Column, filled: Column) -> Column:
    """The values with empty bins filled; all null if there are none."""
    tables = [_constant([asked(i, t) for i in range(BINS)], "int") for t in range(PROBES)]
    # The inverse of a step tells when a bin is asked.
    starts, back = _constant(STARTS, "int"), _constant([pow(s, -1, BINS) for s in STEPS], "int")

    def value(own: Column, i: Column) -> Column:
        answers = [F.get(least, F.get(table, i)) for table in tables]
        when = lambda j: F.pmod((j - F.get(starts, i)) * F.get(back, i), F.lit(BINS))
        first = F.array_min(F.transform(filled, lambda j: when(j) * BINS + j)) % BINS
        return F.coalesce(own, *answers, F.get(least, first))

    return F.transform(least, value)


def _packed(values: Column) -> Column:
    low = (1 << LOW_BITS) - 1
    return F.transform(
        F.sequence(F.lit(0), F.lit(_LONGS - 1)),
        lambda k: F.aggregate(
            F.slice(values, k * _PER_LONG + 1, F.lit(_PER_LONG)),
            F.lit(0).cast("long"),
            lambda packed, v: F.shiftleft(packed, LOW_BITS).bitwiseOR(v.bitwiseAND(low)),
        ),
    )


def add_fingerprint(df: DataFrame, text: Column, out: str) -> DataFrame:
    """``df`` with the fingerprint of ``text`` as array<bigint>; that of a text without
    a word, or null, is an empty array. Equal texts have equal fingerprints."""
    kept = list(df.columns)
    df = df.select(*kept, pinned(words_of(text)).alias("_words"))
    df = df.select(*kept, pinned(shingles_of(F.col("_words"))).alias("_shingles"))
    df = df.select(*kept, F.size("_shingles").alias("_size"), pinned(_sorted_bins(F.col("_shingles"))).alias("_ordered"))
    df = df.select(*kept, "_size", pinned(_least(F.col("_ordered"))).alias("_least"))
    held = F.filter(F.sequence(F.lit(0), F.lit(BINS - 1)), lambda j: F.get("_least", j).isNotNull())
    df = df.select(*kept, "_size", "_least", pinned(held).alias("_filled"))
    df = df.select(*kept, "_size", pinned(_densified(F.col("_least"), F.col("_filled"))).alias("_values"))
    packed = F.when(F.col("_size") > 0, _packed(F.col("_values"))).otherwise(F.array().cast("array<bigint>"))
    return df.select(*kept, pinned(packed).alias(out))


def likeness(a: Column, b: Column) -> Column:
    """Estimated share of shingles that two fingerprints have in common, 0 to 1. Two
    empty ones are alike, an empty and another are not."""
    # Of each bin's bits in x ^ y, the lowest is set in the end if any is.
    lowest = int(("0" * (LOW_BITS // 4 - 1) + "1") * _PER_LONG, 16)
    differ = F.zip_with(a, b, lambda x, y: x.bitwiseXOR(y))
    differ = F.transform(differ, lambda d: d.bitwiseOR(F.shiftrightunsigned(d, 4)))
    differ = F.transform(differ, lambda d: d.bitwiseOR(F.shiftrightunsigned(d, 2)))
    differ = F.transform(differ, lambda d: d.bitwiseOR(F.shiftrightunsigned(d, 1)))
    agree = 1 - F.aggregate(differ, F.lit(0), lambda n, d: n + F.bit_count(d.bitwiseAND(F.lit(lowest)))) / BINS
    chance = 1 / (1 << LOW_BITS)
    none = (F.size(a) == 0).cast("int") + (F.size(b) == 0).cast("int")
    return F.when(none == 2, 1.0).when(none == 1, 0.0).otherwise(F.greatest(F.lit(0.0), (agree - chance) / (1 - chance)))


def hex_of(fingerprint: Column) -> Column:
    """The packed bins as hexadecimal digits, two a bin (and none for no word)."""
    return F.array_join(F.transform(fingerprint, lambda x: F.lower(F.lpad(F.hex(x), 16, "0"))), "")


def _chunk_of(id_: Column, least: list[int]) -> Column:
    """How many of the sorted ``least`` ids are not above this one: a binary search."""
    bounds = _constant(least)
    steps = _constant([1 << b for b in range(len(least).bit_length() - 1, -1, -1)])
    reaches = lambda at, s: (at + s <= len(least)) & (F.get(bounds, (at + s - 1).cast("int")) <= id_)
    return F.aggregate(steps, F.lit(0).cast("long"), lambda at, s: F.when(reaches(at, s), at + s).otherwise(at))


def with_next(rows: DataFrame, chunk_rows: int = CHUNK_ROWS, most_chunks: int = MOST_CHUNKS) -> DataFrame:
    """Each row with the ``text`` and ``fingerprint`` of the next one, as next_text and
    next_fingerprint.

    ``rows`` has id, never null, text and fingerprint. The next row is that of the
    greatest id below its own; after the last comes the first. Rows of one id follow
    each other by their text; a row that repeats id and text is the same document and
    is returned once.

    Ids are cut into at most ``most_chunks`` ranges with about as many rows, so that no
    task sorts them all. The first row of each range also goes to the range above, whose
    last row it follows. Texts are shuffled once.
    """
    ids = rows.groupBy("id").agg(F.count("*").alias("n"))
    n = rows.count()
    if not n:
        return without_next(rows)
    # Bounded: a row per range.
    ranges = (
        ids.repartitionByRange(min(most_chunks, math.ceil(n / chunk_rows)), "id")
        .groupBy(F.spark_partition_id().alias("part"))
        .agg(F.min("id").alias("least"), F.max("id").alias("greatest"), F.max("n").alias("n"))
        .orderBy("least")
        .collect()
    )
    if any(r["n"] > 1 for r in ranges):
        rows = rows.dropDuplicates(["id", "text"])
    above = [(r["greatest"], (k + 1) % len(ranges) + 1) for k, r in enumerate(ranges)]
    heads = rows.sparkSession.createDataFrame(above, "id bigint, above bigint")
    placed = rows.withColumn("chunk", _chunk_of(F.col("id"), [r["least"] for r in ranges])).join(F.broadcast(heads), "id", "left")
    own = F.struct("chunk", F.lit(False).alias("guest"))
    guest = F.struct(F.col("above").alias("chunk"), F.lit(True).alias("guest"))
    dealt = placed.select("id", "text", "fingerprint", F.inline(F.when(F.col("above").isNull(), F.array(own)).otherwise(F.array(own, guest))))
    order = W.partitionBy("chunk").orderBy("guest", F.col("id").desc(), "text")
    follows = dealt.select(
        "id", "text", "fingerprint", "guest", F.lead("text").over(order).alias("next_text"), F.lead("fingerprint").over(order).alias("next_fingerprint")
    )
    return follows.where(~F.col("guest")).drop("guest")


def without_next(rows: DataFrame) -> DataFrame:
    return rows.select("id", "text", "fingerprint", F.lit(None).cast("string").alias("next_text"), F.array().cast("array<bigint>").alias("next_fingerprint"))


def edited_text() -> Column:
    """The last half of the code points replaced by the first as many of the next text."""
    half = F.floor(F.col("n_chars") / 2).cast("int")
    return F.concat(F.substr("text", F.lit(1), F.col("n_chars").cast("int") - half), F.substr(F.coalesce("next_text", F.lit("")), F.lit(1), half))


def compare_edited(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_chars, edited, fingerprint, edited_fingerprint, near_edited, near_next) of
    each row: how like is a document to itself with its last half taken from the next
    one, and to the next one?

    A null text is empty. Repeated rows are as in ``with_next``. A row without an id
    stands outside of the order: its half goes, nothing comes, and its next document
    counts as empty. Other columns are left out; a text is worked on whole.
    """
    rows = narrow(docs, id=id_col, text=text_col).select(F.col("id").cast("long").alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    # Parted first: a filter does not go below the fingerprint, which is pinned.
    known, unknown = (add_fingerprint(rows.where(f"id is {which}"), F.col("text"), "fingerprint") for which in ("not null", "null"))
    pairs = with_next(known).unionByName(without_next(unknown)).withColumn("n_chars", F.char_length("text").cast("long"))
    pairs = pairs.select("id", "n_chars", "fingerprint", "next_fingerprint", pinned(edited_text()).alias("edited"))
    pairs = add_fingerprint(pairs, F.col("edited"), "edited_fingerprint")
    return pairs.select(
        "id",
        "n_chars",
        "edited",
        "fingerprint",
        "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
    )
