"""Phrase collocations by Toivonen's mining: a sample proposes, full passes count.

Phrases that are frequent in a sample of runs of words, at a lowered threshold, are
proposed. A full pass counts every phrase whose two longest parts, the words but the
last and the words but the first, are both proposed: these are the proposed phrases and
their negative border. A counted phrase that is frequent but was not proposed is a
failure of the border: longer phrases with it were not counted. Then the failures are
proposed too, and a further pass counts what that adds, until there is no failure. As
every part of a frequent phrase is frequent, all frequent phrases are counted then. What
a further pass reaches is little, so it is proposed at once, at every length.

Proposed phrases are counted under their words, those of the border, of which there are
many, under a 64-bit hash: they only have to be shown to be rare. A hash that is not
is a failure, and the next pass counts its phrase, or phrases, under their words.

Proposed phrases travel to the executors as a Bloom filter of fixed size. What it lets
through by chance is counted as well, which costs time and changes no result; what an
earlier filter let through was counted then, as bits are only ever added.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shardlog.llm.common import col, map_blocks, small_batches, table, texts_of
from shardlog.llm.polyhash import mixed
from shardlog.llm.registry import query
from shardlog.llm.sql import PHRASES
from shardlog.session import store

LONGEST = 5
LEAST = 100
TOP = 2000
# One run of so many words in so many is sampled; a phrase is proposed from LOWERED of the
# occurrences that LEAST in the corpus lead to expect in the sample.
RUN, SAMPLE = 40, 8
LOWERED = 0.4
# Largest size of the filter: 2^27 bits are 16 MB, whatever the corpus. It has
# SPACIOUS bits for each proposed phrase while there are fewer.
FILTER_BITS = 27
SPACIOUS = 24
_PLACES = 4
BLOCK_BYTES = 1 << 19
# A language's rows are ranked in so many parts first.
_PARTS = 64

# Two keys keep the rows of a task's sums small: the language and phrase, with the
# language's length in front, or for the border the hash alone.
_COUNTED = "name string, h long, n long"
# Lower case for A-Z; a full stop, which no word holds, for every mark that ends a piece.
_FOLD = bytes(0x2E if b in b".,;:!?\x0a\x0b\x0c\x0d" else 0x20 if b == 9 else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _extended(prefix: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The hashes of phrases from those of all words but the last, and of the last."""
    x = (prefix ^ (prefix >> np.uint64(29))) * _MIX + word
    return (x ^ (x >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)


def _held(bits: np.ndarray | None, hashes: np.ndarray) -> np.ndarray:
    """Which hashes a filter lets through; all if there is none."""
    if bits is None:
        return np.ones(len(hashes), dtype=bool)
    mask = np.uint64(len(bits) * 64 - 1)
    step, out = (hashes >> np.uint64(32)) | np.uint64(1), np.ones(len(hashes), dtype=bool)
    for j in range(_PLACES):
        place = ((hashes & mask) + np.uint64(j) * step) & mask
        out &= (bits[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) == 1
    return out


def count_language(texts: list[bytes], lang: str, longest: int, bits: np.ndarray | None, before: np.ndarray | None):
    """(k, phrases, hashes, counts, border hashes, border counts) for each k: of the
    phrases of k words whose parts are in the filter ``bits`` those that are in it
    themselves, and the others; and at k = 0 the number of words. What the filter
    ``before`` had counted is left out, and what it had not reached counts as in the
    filter. All words count as having their parts in a filter.
    """
    words = b".".join(texts).translate(_FOLD).replace(b".", b" . ").split()
    names = dict.fromkeys(words)
    names.pop(b".", None)
    vocabulary = list(names)
    names = dict(zip(vocabulary, range(len(vocabulary))))
    names[b"."] = -1
    code = np.fromiter(map(names.__getitem__, words), dtype=np.int64, count=len(words))
    seed = xxhash.xxh64_intdigest(lang.encode())
    hashes = np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in vocabulary), dtype=np.uint64, count=len(vocabulary))
    own, starts = hashes, np.flatnonzero(code >= 0)
    if before is None:
        yield 0, [""], np.zeros(1, np.uint64), np.array([len(starts)]), hashes[:0], starts[:0]
    # The phrase of k words that starts at each place, if it is in the filter: its number
    number, place, counts = code, np.zeros(0, np.int64), np.bincount(code[starts], minlength=len(own))
    reached = np.full(len(own), before is not None)
    for k in range(1, longest + 1):
        if k > 1:
            at = np.flatnonzero((number[:-1] >= 0) & (number[1:] >= 0))
            at = at[at + k <= len(code)]
            if not len(at):
                return
            last = code[at + k - 1]
            keys, first, inverse, counts = np.unique(number[at] * len(own) + last, return_index=True, return_inverse=True, return_counts=True)
            place = at[first]
            reached = in_old[number[place]] & in_old[number[place + 1]]
            hashes = _extended(hashes[number[place]], own[last[first]])
            number = np.full(len(code), -1, dtype=np.int64)
            number[at] = inverse
        fits = _held(bits, hashes) if before is None else _held(bits, hashes) | ~reached
        in_old = reached & _held(before, hashes) if before is not None else reached
        # Without a filter, in the sample, all is kept and hashes are enough.
        new, rare = np.flatnonzero(fits & ~in_old & (bits is not None)), np.flatnonzero(~reached & (~fits | (bits is None)))
        if k > 1:
            phrases = [b" ".join(words[p : p + k]).decode() for p in place[new].tolist()]
        else:
            phrases = [vocabulary[i].decode() for i in new.tolist()]
        yield k, phrases, hashes[new], counts[new], hashes[rare], counts[rare]
        number = np.where((number >= 0) & fits[number], number, -1) if len(fits) else number


def _count_block(block: pa.RecordBatch, longest: int, bits, before) -> pa.RecordBatch:
    by_lang: dict[str, list[bytes]] = {}
    for text, lang in zip(texts_of(block), block.column("lang").to_pylist()):
        by_lang.setdefault(lang, []).append(text)
    parts = [_NOTHING]
    for lang, texts in by_lang.items():
        front = f"{len(lang)}:{lang}"
        for _, phrases, _, counts, rare_hashes, rare_counts in count_language(texts, lang, longest, bits, before):
            names = pa.array([front + p for p in phrases], pa.string())
            parts.append(_rows(names, pa.nulls(len(phrases), pa.int64()), counts))
            parts.append(_rows(pa.nulls(len(rare_hashes), pa.string()), pa.array(rare_hashes.view(np.int64), pa.int64()), rare_counts))
    return pa.concat_batches(parts)


def _sampled(text: bytes, key: int, sample: int) -> bytes:
    """Some of the runs of RUN words of a text, by its key and their places. Of a long
    piece that says something a hundred times, and of a group of copies, a part is sampled."""
    words = text.translate(_FOLD).replace(b".", b" . ").split()
    chance = mixed(np.arange(-(-len(words) // RUN), dtype=np.uint64) + np.uint64(key % (1 << 62)))
    return b".".join([b" ".join(words[RUN * i : RUN * i + RUN]) for i in np.flatnonzero(chance % np.uint64(sample) == 0).tolist()])


def _sample_block(block: pa.RecordBatch, sample: int) -> pa.RecordBatch:
    texts = [_sampled(t, key, sample) for t, key in zip(texts_of(block), block.column("key").to_pylist())]
    return pa.RecordBatch.from_pydict({"text": pa.array(texts, pa.binary()).cast(pa.string()), "lang": block.column("lang")})


def _rows(name: pa.Array, h: pa.Array, counts: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"name": name, "h": h, "n": pa.array(counts, pa.int64())})


_NOTHING = _rows(pa.nulls(0, pa.string()), pa.nulls(0, pa.int64()), np.zeros(0, np.int64))


def _named(counted: DataFrame) -> DataFrame:
    """(lang, k, phrase, n) of the rows that have a name; k is 0 for a language's words."""
    size = F.substring_index("name", ":", 1)
    rows = counted.where("name is not null").select("name", "n", size.cast("int").alias("size"), (F.char_length(size) + 2).alias("at"))
    rows = rows.select(F.substr("name", F.col("at"), F.col("size")).alias("lang"), F.substr("name", F.col("at") + F.col("size")).alias("phrase"), "n")
    return rows.select("lang", F.when(F.col("phrase") == "", 0).otherwise(F.size(F.split("phrase", " "))).alias("k"), "phrase", "n")


def count_phrases(docs: DataFrame, longest: int, bits: Broadcast | None = None, before: Broadcast | None = None, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Occurrences of the phrases that ``count_language`` counts, over all documents."""
    counted = map_blocks(docs, "text", block_bytes, _COUNTED, lambda b: _count_block(b, longest, bits and bits.value, before and before.value))
    return counted.groupBy("name", "h").agg(F.sum("n").alias("n"))


def filter_of(phrases: DataFrame, bits: int = FILTER_BITS) -> np.ndarray:
    """A Bloom filter of the column ``h``. At most 2^(bits - 6) rows reach the driver."""
    out, mask = np.zeros(1 << (bits - 6), dtype=np.uint64), (1 << bits) - 1
    step = F.shiftrightunsigned("h", 32).bitwiseOR(F.lit(1).cast("long"))
    places = F.array(*[(F.col("h").bitwiseAND(F.lit(mask).cast("long")) + F.lit(j) * step).bitwiseAND(F.lit(mask).cast("long")) for j in range(_PLACES)])
    slots = phrases.select(F.explode(places).alias("p")).groupBy(F.shiftright("p", 6).alias("slot")).agg(F.bit_or(F.expr("shiftleft(1L, cast(p & 63 as int))")).alias("word"))
    found = slots.toArrow()
    out[found.column("slot").to_numpy()] = found.column("word").to_numpy().view(np.uint64)
    return out


def frequent_phrases(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", least: int = LEAST, longest: int = LONGEST, sample: int = SAMPLE,
    lowered: float = LOWERED, filter_bits: int = FILTER_BITS, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """(lang, k, phrase, n) of every phrase of up to ``longest`` words that occurs at least
    ``least`` times in its language, and at k = 0 each language's number of words.

    Exact whatever the sample and the filter; they decide how much is counted that turns
    out rare, and how many passes it takes. A null text is empty, a null language is
    ``und``; each row counts, repeated ones too. Words are cut at blanks and tabs, pieces
    at ``.,;:!?`` and line breaks, A-Z is lower-cased.
    """
    rows = docs.select(F.xxhash64(col(id_col)).alias("key"), col(text_col).cast("string").alias("text"), F.coalesce(col(lang_col).cast("string"), F.lit("und")).alias("lang"))
    sampled = map_blocks(rows, "text", block_bytes, "text string, lang string", lambda b: _sample_block(b, sample))
    rows = rows.select("text", "lang")
    enough = max(2, int(lowered * least / sample))
    spark = docs.sparkSession
    with small_batches(spark, block_bytes):
        proposed = store(count_phrases(sampled, longest, block_bytes=block_bytes).where(F.col("h").isNotNull() & (F.col("n") >= enough)).select("h"), "proposed")
    filter_bits = min(filter_bits, max(16, (SPACIOUS * proposed.count()).bit_length()))
    send = spark.sparkContext.broadcast
    # A language's number of words has a name that ends with the language.
    total = F.substring_index("name", ":", 1).cast("int") + F.char_length(F.substring_index("name", ":", 1)) + 1 == F.char_length("name")
    bits, before, found = send(filter_of(proposed, filter_bits)), None, None
    while True:
        with small_batches(spark, block_bytes):
            counted = store(count_phrases(rows, longest, bits, before, block_bytes).where((F.col("n") >= least) | total), "phrases")
        found = _named(counted) if found is None else found.unionByName(_named(counted))
        missed = counted.where("h is not null")
        if before is not None:
            before.destroy()
        if missed.isEmpty():
            bits.destroy()
            return found
        before, bits = bits, send(bits.value | filter_of(missed, filter_bits))


def _between(words: Column, begin: Column, n: Column) -> Column:
    return F.array_join(F.slice(words, begin, n), " ")


def collocations(found: DataFrame, top: int = TOP) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` phrases.

    A phrase of two words or more is cut in two where floor(1000 * a * n / (l * r)) is
    least, ties to the first cut; a, l and r are the occurrences of the phrase and of its
    parts, n the words of the language. Phrases inside a longer one that occurs as often
    are left out. Ranked by score and a, falling, then by phrase.
    """
    phrases = found.where("k > 0").select("lang", "phrase", "n")
    words = F.split("phrase", " ")
    candidates = found.where("k > 1").select("lang", "phrase", "k", F.col("n").alias("a"))
    inner = F.transform(F.sequence(F.lit(2), F.col("k") - 1), lambda m: F.transform(F.sequence(F.lit(1), F.col("k") - m + 1), lambda b: _between(words, b, m)))
    covering = (
        candidates.where("k > 2")
        .select("lang", "a", F.explode(F.array_distinct(F.flatten(inner))).alias("phrase"))
        .groupBy("lang", "phrase")
        .agg(F.max("a").alias("longer"))
    )
    kept = candidates.join(covering, ["lang", "phrase"], "left").where("longer is null or 100 * longer < 100 * a").drop("longer")
    cuts = kept.select("lang", "phrase", "k", "a", words.alias("w"), F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
    cuts = cuts.select(
        "lang", "phrase", "a", "cut",
        _between(F.col("w"), F.lit(1), F.col("cut")).alias("left"),
        _between(F.col("w"), F.col("cut") + 1, F.col("k") - F.col("cut")).alias("right"),
    )
    cuts = cuts.join(phrases.select("lang", F.col("phrase").alias("left"), F.col("n").alias("l")), ["lang", "left"])
    cuts = cuts.join(phrases.select("lang", F.col("phrase").alias("right"), F.col("n").alias("r")), ["lang", "right"])
    # A row per language
    cuts = cuts.join(found.where("k = 0").select("lang", "n"), "lang")
    # 38 digits hold 1000 * a * n below 10^17 words of a language.
    score = F.expr("(cast(1000 * cast(a as decimal(19,0)) as decimal(22,0)) * cast(n as decimal(16,0))) div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))")
    scored = cuts.withColumn("score", score).groupBy("lang", "phrase").agg(F.min(F.struct("score", "cut", "l", "r", "a", "n")).alias("c"))
    scored = scored.select("lang", "phrase", "c.a", "c.l", "c.r", "c.n", "c.score")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(_PARTS))
    few = scored.withColumn("part", part).withColumn("rank", F.row_number().over(W.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= top).drop("part")
    ranked = few.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


@query("op12_phrase_collocations", PHRASES)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which phrases of each language hold together most?"""
    return collocations(frequent_phrases(table(spark, sf_dir, "documents")))
