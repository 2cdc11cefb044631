"""Spelling variants by a trie of letter-group counts.

Letters fall into GROUPS groups. A word is the vector of how many letters it has of each
group, and the trie branches at each level on the next count. One inserted letter makes
one count larger by one, one deleted letter makes one smaller, one replaced letter does both or
neither. So the words within one edit lie where a search that starts with a surplus and
a deficit of one each ends without having overdrawn either. What it finds in the leaves
is verified letter by letter.

The top levels of the trie are a Spark shuffle: a cell holds the words that agree in the
first counts, and each word is also looked for in the cells that one step of surplus and
one of deficit lead to. Of large cells the words, and of much visited ones the searches, are dealt in
chunks. Below, a depth-first search inside a task carries all searches of a chunk at once.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shardlog.llm.common import narrow, ranges, shifted_sums, table
from shardlog.llm.registry import query
from shardlog.llm.sql import SPELLING
from shardlog.session import store

SHORTEST = 7
LEAST = 2
EVERY = 31
TIMES = 10
GROUPS = 12
# Words and searches of a group that one task holds.
CHUNK = 1 << 15
# Words of a cell to aim for; the top has a level more for every FAN times as many words.
CELL, FAN = 1 << 13, 5
# A node is a leaf when this many pairs of words and searches are left.
_LEAF = 1 << 12
_PAIRS = 1 << 16
_WIDE = 64
_STEP_BITS = 12

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# The group of a letter is its code modulo GROUPS. Levels begin with the groups of e, t
# and h, a, and so on, as common letters part words best.
_LEVELS = [5, 8, 1, 9, 3, 2, 7, 6, 0, 4, 10, 11]
_LEVEL_OF = np.array([_LEVELS.index(b % GROUPS) for b in range(256)])


def words_with_slips(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", every: int = EVERY, shortest: int = SHORTEST, least: int = LEAST) -> DataFrame:
    """(word, n): the distinct words of at least ``shortest`` letters that occur ``least``
    times or more, over all documents, after each ``every``-th run lost a letter.

    A run is a maximal one of A-Z, a-z and U+00C0 to U+00FF, with A-Z lower-cased. If
    ``every`` divides h, the CRC-32 of ``<id>:<run>``, the letter at h % length is left
    out. A null text has no runs; a null id is written as nothing.
    """
    rows = narrow(docs, id=id_col, text=text_col)
    runs = F.regexp_extract_all(F.translate("text", _UPPER, _LOWER), F.lit(f"[a-zÀ-ÿ]{{{shortest},}}"), F.lit(0))
    runs = rows.select(F.coalesce(F.col("id").cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run"))
    h = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    runs = runs.select("run", h.alias("h"), F.char_length("run").alias("length"))
    lost = (F.col("h") % F.col("length")).cast("int")
    slipped = F.concat(F.substr("run", F.lit(1), lost), F.substr("run", lost + 2, F.col("length")))
    words = runs.select(F.when(F.col("h") % every == 0, slipped).otherwise(F.col("run")).alias("word"))
    return words.where(F.char_length("word") >= shortest).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least)


class Words:
    """An Arrow column of words as letters end to end, a byte for each."""

    def __init__(self, column: pa.Array):
        flat = np.frombuffer(b"".join(column.cast(pa.binary()).to_pylist()), dtype=np.uint8)
        owner = np.repeat(np.arange(len(column)), np.asarray(pc.binary_length(column), dtype=np.int64))
        # U+00C0 to U+00FF are a byte C3 and the letter's code without bit 6.
        letter = flat != 0xC3
        self.flat, self.owner = flat[letter], owner[letter]
        self.flat = np.where(self.flat < 0x80, self.flat, self.flat | 0x40)
        self.sizes = np.bincount(self.owner, minlength=len(column))
        self.starts = shifted_sums(self.sizes)[:-1]

    def ends(self) -> tuple[np.ndarray, np.ndarray]:
        """The first three letters of each word in a number, and the last three."""
        letters = np.append(self.flat, np.zeros(3, np.uint8)).astype(np.int64)
        last = np.maximum(self.starts + self.sizes - 3, 0)
        return tuple(letters[at] << 16 | letters[at + 1] << 8 | letters[at + 2] for at in (self.starts, last))

    def vectors(self) -> np.ndarray:
        """A row per word, a column per level: letters of the level's group. Counts end
        at 127: words of more search too widely, and are verified."""
        counts = np.bincount(self.owner * GROUPS + _LEVEL_OF[self.flat], minlength=len(self.sizes) * GROUPS)
        return np.minimum(counts, 127).astype(np.int8).reshape(-1, GROUPS)

    def word(self, k: int) -> bytes:
        return self.flat[self.starts[k] : self.starts[k] + self.sizes[k]].tobytes()

    def padded(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The letters of some words as rows, from the left and from the right."""
        sizes = np.where(self.sizes[which] <= _WIDE, self.sizes[which], 0)
        flat = self.flat[ranges(self.starts[which], sizes)]
        owner, place = np.repeat(np.arange(len(which)), sizes), ranges(np.zeros(len(which), np.int64), sizes)
        wide = int(sizes.max(initial=0)) + 1
        left, right = (np.zeros((len(which), wide), np.uint8) for _ in range(2))
        left[owner, place] = flat
        right[owner, np.repeat(sizes, sizes) - 1 - place] = flat
        return left, right


def steps(depth: int) -> list[int]:
    """From a cell to itself and to those that one surplus and one deficit lead to, of two
    opposite steps the one upwards: either cell finds the pairs of both."""
    unit = [1 << _STEP_BITS * k for k in range(depth)]
    return [0, *unit, *(b - a for a, b in itertools.combinations(unit, 2))]


def _cells(words: DataFrame, depth: int) -> DataFrame:
    """Words with the number of their cell. Counts above 127 share a cell."""
    weights = np.array([1 << _STEP_BITS * k for k in range(depth)], dtype=np.int64)

    def add(batches):
        for batch in batches:
            vectors = Words(batch.column("word")).vectors()[:, :depth].astype(np.int64)
            yield batch.append_column("cell", pa.array(vectors @ weights, pa.int64()))

    return words.mapInArrow(add, "word string, n long, cell long")


def candidates(items: np.ndarray, searches: np.ndarray):
    """Pairs (search, item) whose vectors differ by a surplus and a deficit of one at
    most, in blocks. ``items`` are sorted by their vectors."""
    none = np.zeros(len(searches), np.int8)
    stack = [(0, 0, len(items), np.arange(len(searches)), none, none)]
    while stack:
        level, low, high, q, surplus, deficit = stack.pop()
        if level == GROUPS or (high - low) * len(q) <= _LEAF:
            size = max(1, _PAIRS // (high - low))
            for a in range(0, len(q), size):
                part, more, fewer = q[a : a + size], surplus[a : a + size, None], deficit[a : a + size, None]
                for rest in range(level, GROUPS):
                    differ = items[None, low:high, rest] - searches[part, rest, None]
                    more = more + np.maximum(differ, 0)
                    fewer = fewer + np.maximum(-differ, 0)
                    # Sums would not fit a byte if large differences were added up.
                    np.minimum(more, 2, out=more)
                    np.minimum(fewer, 2, out=fewer)
                i, j = np.nonzero(np.broadcast_to((more <= 1) & (fewer <= 1), (len(part), high - low)))
                yield part[i], low + j
            continue
        counts = items[low:high, level]
        starts = low + np.append(0, np.flatnonzero(counts[1:] != counts[:-1]) + 1)
        own = searches[q, level]
        for begin, end in zip(starts.tolist(), [*starts[1:].tolist(), high]):
            differ = items[begin, level] - own
            more, fewer = surplus + np.maximum(differ, 0), deficit + np.maximum(-differ, 0)
            alive = (more <= 1) & (fewer <= 1) & (differ <= 1) & (differ >= -1)
            if alive.any():
                stack.append((level + 1, begin, end, q[alive], more[alive], fewer[alive]))


def one_edit(a: bytes, b: bytes) -> bool:
    """Do two words differ by exactly one letter inserted, deleted or replaced?"""
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    least, same = min(len(a), len(b)), 0
    while same < least and a[same] == b[same]:
        same += 1
    return a[same + 1 :] == b[same + 1 :] if len(a) == len(b) else a[same + (len(a) > len(b)) :] == b[same + (len(b) > len(a)) :]


def verified(words: Words, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Which pairs are one edit apart: all letters but one agree, from either end."""
    short, long = np.minimum(words.sizes[i], words.sizes[j]), np.maximum(words.sizes[i], words.sizes[j])
    which, place = np.unique(np.concatenate([i, j]), return_inverse=True)
    common = []
    for letters in words.padded(which):
        unequal = letters[place[: len(i)]] != letters[place[len(i) :]]
        common.append(np.minimum(np.where(unequal.any(axis=1), unequal.argmax(axis=1), short), short))
    out = np.where(long == short, common[0] + common[1] == short - 1, (long == short + 1) & (common[0] + common[1] >= short))
    for k in np.flatnonzero(long > _WIDE).tolist():
        out[k] = one_edit(words.word(i[k]), words.word(j[k]))
    return out


def _search(group: pa.Table) -> pa.Table:
    """For each word of a chunk its near words there, and the most frequent of them.

    A search from the own cell finds each of two words from the other; one from another
    cell finds both ends of a pair."""
    group = group.combine_chunks()
    column = group.column("word").chunk(0) if group.num_rows else pa.array([], pa.string())
    step, n = np.asarray(group.column("step")), np.asarray(group.column("n"))
    words = Words(column)
    vectors = words.vectors()
    place, of = np.flatnonzero(step < 0), np.flatnonzero(step >= 0)
    place = place[np.lexsort(vectors[place].T[::-1])]
    blocks = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    head, tail = words.ends()
    for i, j in candidates(vectors[place], vectors[of]) if len(place) else ():
        i, j = of[i], place[j]
        # One edit leaves either end of six letters alone, or both.
        likely = (head[i] == head[j]) | (tail[i] == tail[j]) | (words.sizes[i] < 6) | (words.sizes[j] < 6)
        i, j = i[likely], j[likely]
        near = verified(words, i, j)
        blocks.append((i[near], j[near]))
    i, j = (np.concatenate([b[side] for b in blocks]) for side in (0, 1))
    back = step[i] > 0
    i, j = np.concatenate([i, j[back]]), np.concatenate([j, i[back]])
    # Of a word's near ones the most frequent first, of equally frequent ones the smallest.
    met = np.unique(j)
    named = dict(zip(met.tolist(), column.take(pa.array(met)).to_pylist()))
    rank = np.zeros(len(words.sizes), dtype=np.int64)
    rank[sorted(named, key=lambda k: (-n[k], named[k]))] = np.arange(len(met))
    order = np.lexsort((rank[j], i))
    i, j = i[order], j[order]
    first = np.flatnonzero(np.append(True, i[1:] != i[:-1])) if len(i) else np.zeros(0, np.int64)
    return pa.table({
        "word": column.take(pa.array(i[first])),
        "n_near": pa.array(np.diff(np.append(first, len(i))), pa.int64()),
        "near": column.take(pa.array(j[first])),
        "near_n": pa.array(n[j[first]], pa.int64()),
    })


def _share(chunks: str) -> Column:
    return F.pmod(F.xxhash64("word"), F.col(chunks)).cast("int")


def near_words(words: DataFrame, depth: int | None = None, chunk: int = CHUNK) -> DataFrame:
    """(word, n_near, near, near_n) of each word that has others one edit away: how many,
    and the most frequent, ties to the smallest in code-point order.

    ``words`` has word, distinct and of U+0000 to U+00FF, and n. ``depth`` levels of the
    trie are dealt out; by default as many as leave about CELL words in a cell.
    """
    if depth is None:
        size, depth = words.count(), 2
        while depth < 5 and size > CELL * FAN**depth:
            depth += 1
    placed = store(_cells(words, depth), "cells")
    away = F.posexplode(F.array(*[F.col("cell") + F.lit(s) for s in steps(depth)])).alias("step", "cell")
    around = placed.select("word", "n", away)
    held = placed.groupBy("cell").agg(F.ceil(F.count("*") / chunk).cast("int").alias("item_chunks"))
    # Searches only go where there are words. Both sides are dealt: each chunk of a cell's words meets each chunk of its searches.
    around = around.join(held, "cell")
    sought = around.groupBy("cell").agg(F.ceil(F.count("*") / chunk).cast("int").alias("search_chunks"))
    cells = store(held.join(sought, "cell"), "cell-chunks")
    every = lambda chunks: F.explode(F.sequence(F.lit(0), F.col(chunks) - 1))
    searches = around.drop("item_chunks").join(cells, "cell").select("cell", every("item_chunks").alias("a"), _share("search_chunks").alias("b"), "word", "n", "step")
    items = placed.join(cells, "cell").select("cell", _share("item_chunks").alias("a"), every("search_chunks").alias("b"), "word", "n", F.lit(-1).alias("step"))
    found = searches.unionByName(items).groupBy("cell", "a", "b").applyInArrow(_search, "word string, n_near long, near string, near_n long")
    best = F.min(F.struct((-F.col("near_n")).alias("minus"), "near"))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best")).select("word", "n_near", F.col("best.near").alias("near"), (-F.col("best.minus")).alias("near_n"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): the last word that the forms lead to, by pointers that double.

    A form is ``times`` as frequent as its word, so there are no circles, and a chain of
    the frequencies of 64 bits is followed in five rounds at most.
    """
    reached = store(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = reached.select(F.col("word").alias("root"), F.col("root").alias("next"))
        followed = store(reached.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if followed.where("moved").isEmpty():
            return followed.select("word", "root")
        reached = followed.select("word", "root")


def variants(words: DataFrame, times: int = TIMES, depth: int | None = None, chunk: int = CHUNK) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of each of ``words`` (word, n).

    The form of a word is the most frequent word one edit away, ties to the smallest in
    code-point order, if that is at least ``times`` as frequent; else null. The root is
    where the forms lead, the word itself if it has none.
    """
    near = near_words(words, depth, chunk)
    enough = F.col("near_n") >= times * F.col("n")
    formed = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(enough, F.col("near")).alias("form"), F.when(enough, F.col("near_n")).alias("form_n")
    )
    formed = store(formed, "forms")
    found = roots(formed.where("form is not null"))
    return formed.join(found, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


@query("op13_spelling_variants", SPELLING)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which words are slips of more frequent ones?"""
    return variants(store(words_with_slips(table(spark, sf_dir, "documents")), "words"))
