"""Benchmark decontamination by suffix arrays of the training text.

Documents are cut into shards of bounded bytes. A task builds the suffix array of
each shard, over words, and binary-searches every benchmark suffix in it; the
longest verbatim matches and their places come out, and a document's words inside
any of them count as hit. Documents never meet: nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shardlog.llm.common import extended, map_blocks, narrow, ranges, shifted_sums, texts_of, widen
from shardlog.session import store

WINDOW = 13
SHARD_BYTES = 4 << 20
# Benchmark text that travels with a job. A larger benchmark takes several jobs.
BLOCK_BYTES = 8 << 20

# Lower case for A-Z; every ASCII byte that is neither digit nor letter becomes a blank.
# All bytes of a non-ASCII character are above 0x7F and stay.
_WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_WORD_BYTES).split()


class TestSuffixes:
    """The suffixes of a block of benchmark items, as numbers of their words.

    Word numbers start at 1; 0 stands for every word no item has, and for the end
    of an item or document. A suffix is searched if a whole window fits in it.
    """

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int):
        self.number: dict[bytes, int] = {}
        flat, starts, sizes, owner, self.ids = [0], [], [], [], []
        for item_id, words in items:
            if not words:
                continue
            size = min(window, len(words))
            first = len(flat)
            flat.extend(self.number.setdefault(w, len(self.number) + 1) for w in words)
            flat.append(0)
            fits = len(words) - size + 1
            starts.extend(range(first, first + fits))
            sizes.extend([size] * fits)
            owner.extend([len(self.ids)] * fits)
            self.ids.append(item_id)
        self.flat = np.array(flat, dtype=np.int32)
        self.starts = np.array(starts, dtype=np.int64)
        self.sizes = np.array(sizes, dtype=np.int64)
        self.owner = np.array(owner, dtype=np.int64)
        # The words a training suffix must at least have after a given first word.
        self.needs = np.full(len(self.number) + 1, np.iinfo(np.int32).max, dtype=np.int64)
        if starts:
            np.minimum.at(self.needs, self.flat[self.starts], self.sizes)
        zeros = np.flatnonzero(self.flat == 0)
        self.depth = int(np.diff(zeros).max(initial=1))

    def numbers(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.number.get, words, repeat(0)), dtype=np.int32, count=len(words))


class SuffixArray:
    """The suffixes of a shard in order, as far as a benchmark suffix can reach.

    Left out are only suffixes that no test window can start, because a word that
    no item has comes too early; they could not be found by any search.
    """

    def __init__(self, words: np.ndarray, tests: TestSuffixes):
        self.words = words
        zeros = np.flatnonzero(words == 0)
        to_end = zeros[np.searchsorted(zeros, np.arange(len(words)))] - np.arange(len(words))
        kept = (words != 0) & (to_end >= tests.needs[words])
        # Whole runs of known words that hold a kept suffix, with the 0 that ends them.
        run = np.searchsorted(zeros, np.flatnonzero(kept))
        runs = np.unique(run)
        begin = np.where(runs > 0, zeros[runs - 1] + 1, 0)
        self.place = ranges(begin, zeros[runs] - begin + 1)
        self.content = words[self.place]
        rank = self.content.astype(np.int64)
        step = 1
        # Prefix doubling: after each round the rank orders twice as many words.
        while step < tests.depth and len(rank):
            after = np.zeros_like(rank)
            after[:-step] = rank[step:]
            key = rank * (int(rank.max()) + 1) + after
            distinct, rank = np.unique(key, return_inverse=True)
            step *= 2
            if len(distinct) == len(rank):
                break
        order = np.argsort(rank, kind="stable")
        self.order = order[kept[self.place[order]]]
        self.content = np.append(self.content, np.zeros(tests.depth + 1, dtype=np.int32))

    def narrowed(self, low: np.ndarray, high: np.ndarray, depth: int, word: np.ndarray, right: bool) -> np.ndarray:
        """Binary search for ``word`` at ``depth`` inside intervals that agree before it."""
        low, high = low.copy(), high.copy()
        while (open_ := low < high).any():
            mid = (low + high) >> 1
            seen = self.content[self.order[np.where(open_, mid, 0)] + depth]
            below = (seen <= word) if right else (seen < word)
            low = np.where(open_ & below, mid + 1, low)
            high = np.where(open_ & ~below, mid, high)
        return low

    def search(self, tests: TestSuffixes) -> tuple[np.ndarray, np.ndarray]:
        """(test suffix, place) of every occurrence of the suffix's window."""
        low = np.zeros(len(tests.starts), dtype=np.int64)
        high = np.full(len(tests.starts), len(self.order), dtype=np.int64)
        live = np.flatnonzero(low < high)
        for depth in range(int(tests.sizes.max(initial=0))):
            at = live[tests.sizes[live] > depth]
            if not len(at):
                break
            word = tests.flat[tests.starts[at] + depth]
            first = self.narrowed(low[at], high[at], depth, word, right=False)
            high[at] = self.narrowed(first, high[at], depth, word, right=True)
            low[at] = first
            live = live[low[live] < high[live]]
        counts = (high - low)[live]
        return np.repeat(live, counts), self.order[ranges(low[live], counts)]

    def matches(self, tests: TestSuffixes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(test suffix, place, words) of the longest matches at each place.

        An occurrence that the words before it also belong to is part of the match
        that starts there, so it isn't reported again.
        """
        suffix, at = self.search(tests)
        start = tests.starts[suffix]
        before = np.where(at > 0, self.content[at - 1], 0)
        longest = (before == 0) | (before != tests.flat[start - 1])
        suffix, at, start = suffix[longest], at[longest], start[longest]
        length = tests.sizes[suffix].copy()
        open_ = np.arange(len(suffix))
        while len(open_):
            nxt = self.content[at[open_] + length[open_]]
            open_ = open_[(nxt != 0) & (nxt == tests.flat[start[open_] + length[open_]])]
            length[open_] += 1
        return suffix, self.place[at], length


MATCH = "item_id string, item_word long, doc_word long, n_words long"
RESULT = f"n_words long, n_hit long, n_items long, item_ids array<string>, matches array<struct<{MATCH}>>"
_MATCH_TYPE = pa.struct([("item_id", pa.string()), ("item_word", pa.int64()), ("doc_word", pa.int64()), ("n_words", pa.int64())])


def _covered(spans: list[tuple[int, int]]) -> int:
    """Words inside the union of (first word, words) spans."""
    total, end = 0, 0
    for first, size in sorted(spans):
        total += max(0, first + size - max(first, end))
        end = max(end, first + size)
    return total


def _search_shard(block: pa.RecordBatch, tests: TestSuffixes, earlier: bool) -> pa.RecordBatch:
    texts = texts_of(block)
    split = [words_of(t) for t in texts]
    sizes = np.array([len(w) for w in split], dtype=np.int64)
    flat = np.zeros(int(sizes.sum()) + len(split), dtype=np.int32)
    begins = shifted_sums(sizes + 1)[:-1]
    for begin, words in zip(begins, split):
        flat[begin : begin + len(words)] = tests.numbers(words)
    found: list[list[dict]] = [[] for _ in texts]
    if earlier:
        found = [list(m or []) for m in block.column("matches").to_pylist()]
    suffix, place, length = SuffixArray(flat, tests).matches(tests)
    doc = np.searchsorted(begins, place, side="right") - 1
    first_of_item = np.searchsorted(tests.owner, np.arange(len(tests.ids)))
    item_word = tests.starts[suffix] - tests.starts[first_of_item[tests.owner[suffix]]]
    for d, s, p, n, w in zip(doc.tolist(), suffix.tolist(), (place - begins[doc]).tolist(), length.tolist(), item_word.tolist()):
        found[d].append({"item_id": tests.ids[tests.owner[s]], "item_word": w, "doc_word": p, "n_words": n})
    items = [sorted({m["item_id"] for m in ms if m["item_id"] is not None}) for ms in found]
    own = {"n_words", "n_hit", "n_items", "item_ids", "matches"}
    out = {name: block.column(name) for name in block.schema.names if name not in own}
    out["n_words"] = pa.array(sizes)
    out["n_hit"] = pa.array([_covered([(m["doc_word"], m["n_words"]) for m in ms]) for ms in found], pa.int64())
    out["n_items"] = pa.array([len(i) for i in items], pa.int64())
    out["item_ids"] = pa.array(items, pa.list_(pa.string()))
    out["matches"] = pa.array(found, pa.list_(_MATCH_TYPE))
    return pa.RecordBatch.from_pydict(out)


def item_blocks(benchmark: DataFrame, item_col: str, text_col: str, limit: int) -> Iterator[list[tuple[str | None, list[bytes]]]]:
    """The benchmark in blocks of at most ``limit`` bytes (or one item), one at a time."""
    rows = narrow(benchmark, item=item_col, text=text_col).select(F.col("item").cast("string"), "text").toLocalIterator()
    block, size = [], 0
    for item, text in rows:
        data = (text or "").encode()
        if block and size + len(data) > limit:
            yield block
            block, size = [], 0
        block.append((item, words_of(data)))
        size += len(data)
    yield block


def find_matches(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    carry: bool = False,
    block_bytes: int = BLOCK_BYTES,
    shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """Per row of ``docs``: id, n_words, n_hit, n_items, item_ids (sorted), and the
    longest verbatim matches with their places in item and document.

    Words are runs of digits, letters and non-ASCII characters after lower-casing
    A-Z. A match is ``window`` words or more, or a whole shorter item. A null or
    wordless text has no words and no matches; such an item matches nothing. Equal
    documents are judged one by one. Items with the same id count as one; an item
    without an id marks words but isn't listed. Without benchmark rows nothing is
    hit. ``carry`` keeps the input row in ``_row``.

    A benchmark of more than ``block_bytes`` is searched block by block, with the
    matches so far written down in the shared folder in between.
    """
    out = narrow(docs, carry, id=id_col, text=text_col)
    schema = extended(out, RESULT)
    # One block is known to be the last only after asking for the next.
    blocks, earlier = item_blocks(benchmark, item_col, item_text_col, block_bytes), False
    items = next(blocks)
    while items is not None:
        following = next(blocks, None)
        shared = docs.sparkSession.sparkContext.broadcast(TestSuffixes(items, window))
        out = map_blocks(out, "text", shard_bytes, schema, lambda b, shared=shared, earlier=earlier: _search_shard(b, shared.value, earlier))
        if following is not None:
            out = store(out, "matches")
        items, earlier = following, True
    return out.drop("text")


def contaminated(n_hit="n_hit", n_words="n_words"):
    """One word in twenty or more is hit."""
    return (F.col(n_hit) > 0) & (20 * F.col(n_hit) >= F.col(n_words))


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that aren't contaminated, with their columns as they were."""
    return widen(find_matches(docs, benchmark, carry=True, **options).where(~contaminated()))


def item_digest(items: Column) -> Column:
    return F.sha2(F.array_join(items, ","), 256)


