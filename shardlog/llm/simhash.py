"""SimHash near-duplicates by a self-join of binary tries.

Fingerprints are the rows' only content here, so equal ones are one node from the
start. Two fingerprints within k bits differ in at most k // 2 bits of one of their
halves: the join runs once over a trie that reads the upper half first and once over
one that reads the lower half first. Node pairs go down together, add up differing
bits, and end when the budget of the first half, or of the whole, is spent.

The top of a trie is a Spark shuffle: a node pair at ``depth`` is a group. What lies
below is walked level by level inside the group's task.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shardlog.llm.common import extended, map_blocks, narrow, texts_of, widen
from shardlog.llm.components import connected
from shardlog.session import store

SHINGLE = 3
MAX_BITS = 3
SEED = 42
BITS = 64
BLOCK_BYTES = 2 << 20
# Fingerprints of a node pair that one task walks; more are dealt in chunks.
GROUP = 1 << 14
# Shingle hashes whose bits are spread out at a time.
_SPREAD = 1 << 16

# Lower case for A-Z; split() of bytes then cuts at the six ASCII blanks and no others.
_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


def fingerprint_hashes(text: bytes, shingle: int) -> list[int]:
    """XXH64 of each word shingle; of the whole sequence if it is shorter."""
    words = text.translate(_LOWER).split()
    if not words:
        return []
    joined = b" ".join(words)
    if len(words) <= shingle:
        return [xxhash.xxh64_intdigest(joined, SEED)]
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = [0, *(ends[: len(words) - shingle] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    return [digest(joined[a:b], SEED) for a, b in zip(starts, ends[shingle - 1 :].tolist())]


def majority_bits(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """For each run of ``counts`` hashes the bits set in over half of them."""
    totals = np.zeros((len(counts), BITS), dtype=np.int64)
    owner = np.repeat(np.arange(len(counts)), counts)
    for begin in range(0, len(hashes), _SPREAD):
        part = hashes[begin : begin + _SPREAD]
        bits = np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        own = owner[begin : begin + _SPREAD]
        first = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
        totals[own[first]] += np.add.reduceat(bits, first, axis=0, dtype=np.int32)
    majority = (2 * totals > counts[:, None]).astype(np.uint8)
    return np.packbits(majority, axis=1, bitorder="little").view("<u8").reshape(-1)


def _fingerprint_block(block: pa.RecordBatch, shingle: int) -> pa.RecordBatch:
    each = [fingerprint_hashes(t, shingle) for t in texts_of(block)]
    counts = np.array([len(h) for h in each], dtype=np.int64)
    hashes = np.fromiter((h for hs in each for h in hs), dtype=np.uint64, count=int(counts.sum()))
    out = {name: block.column(name) for name in block.schema.names if name != "text"}
    out["fp"] = pa.array(majority_bits(hashes, counts).view(np.int64))
    return pa.RecordBatch.from_pydict(out)


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, carry: bool = False) -> DataFrame:
    """(id, fp) per row, with the input row in ``_row`` if ``carry``; fp is the
    64 bits as a long. Null, empty and blank texts have fingerprint zero."""
    rows = narrow(docs, carry, id=id_col, text=text_col)
    return map_blocks(rows, "text", BLOCK_BYTES, extended(rows, "fp long", without=("text",)), lambda b: _fingerprint_block(b, shingle))


def hex_of(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def trie_pairs(left: np.ndarray, right: np.ndarray | None, first_budget: int, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """Places (i, j) of all pairs of sorted distinct fingerprints within the budgets.

    Without ``right`` the pairs of ``left`` with itself, each once. A trie node is an
    interval of the sorted fingerprints. A frontier of node pairs goes down one bit
    at a time. Pairs of single fingerprints leave it early and are counted whole.
    """
    own = right is None
    other = left if own else right
    empty = np.zeros(0, dtype=np.int64)
    if not len(left) or not len(other):
        return empty, empty
    # a pair of nodes: [a0, a1) of left, [b0, b1) of other, bits that differ so far
    a0, a1 = np.array([0]), np.array([len(left)])
    b0, b1 = np.array([0]), np.array([len(other)])
    spent = np.zeros(1, dtype=np.int64)
    found_i, found_j = [], []
    for bit in range(BITS - 1, -1, -1):
        half = bit >= BITS // 2
        single = (a1 - a0 == 1) & (b1 - b0 == 1)
        if single.any():
            i, j = a0[single], b0[single]
            differ = left[i] ^ other[j]
            near = (np.bitwise_count(differ) <= budget) & (np.bitwise_count(differ >> np.uint64(BITS // 2)) <= first_budget)
            if own:
                near &= i < j
            found_i.append(i[near])
            found_j.append(j[near])
            a0, a1, b0, b1, spent = (x[~single] for x in (a0, a1, b0, b1, spent))
        if not len(a0):
            break
        a_mid, b_mid = _split(left, a0, a1, bit), _split(other, b0, b1, bit)
        children = []
        for x0, x1, y0, y1, cost in (
            (a0, a_mid, b0, b_mid, 0),
            (a_mid, a1, b_mid, b1, 0),
            (a0, a_mid, b_mid, b1, 1),
            (a_mid, a1, b0, b_mid, 1),
        ):
            total = spent + cost
            alive = (x0 < x1) & (y0 < y1) & (total <= (first_budget if half else budget))
            if own and cost:
                # Of two mirrored node pairs only the one with the smaller node left.
                alive &= x0 < y0
            children.append([v[alive] for v in (x0, x1, y0, y1, total)])
        a0, a1, b0, b1, spent = (np.concatenate(v) for v in zip(*children))
    if len(a0):
        # All bits are read: what is left are single, equal-or-near fingerprints.
        keep = (a0 < b0) if own else np.ones(len(a0), dtype=bool)
        found_i.append(a0[keep])
        found_j.append(b0[keep])
    return (np.concatenate(found_i), np.concatenate(found_j)) if found_i else (empty, empty)


def _split(keys: np.ndarray, low: np.ndarray, high: np.ndarray, bit: int) -> np.ndarray:
    """In sorted keys that agree above ``bit``: the first of [low, high) that has it set."""
    low, high = low.copy(), high.copy()
    mask = np.uint64(1) << np.uint64(bit)
    while (open_ := low < high).any():
        mid = (low + high) >> 1
        is_set = (keys[np.where(open_, mid, 0)] & mask) != 0
        low = np.where(open_ & ~is_set, mid + 1, low)
        high = np.where(open_ & is_set, mid, high)
    return low


def spanning(i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    """Places of links that keep all components of n nodes: fewer than n of them."""
    root = list(range(n))
    kept = []
    for k, (a, b) in enumerate(zip(i.tolist(), j.tolist())):
        while root[a] != a:
            root[a] = a = root[root[a]]
        while root[b] != b:
            root[b] = b = root[root[b]]
        if a != b:
            root[max(a, b)] = min(a, b)
            kept.append(k)
    return np.array(kept, dtype=np.int64)


def _turned(fp: Column, lower_first: bool) -> Column:
    return F.shiftrightunsigned(fp, 32).bitwiseOR(F.shiftleft(fp, 32)) if lower_first else fp


def _turn_back(keys: np.ndarray) -> np.ndarray:
    return (keys >> np.uint64(32)) | (keys << np.uint64(32))


def near_links(distinct: DataFrame, *, max_bits: int = MAX_BITS, depth: int, group: int = GROUP) -> DataFrame:
    """(src, dst) links between distinct fingerprints (column fp) that keep the
    components of "within ``max_bits`` bits". Each task returns a forest of the links
    that it found, so a dense group of n fingerprints gives fewer than n rows."""
    first_budget = max_bits // 2
    flips = [0]
    for _ in range(first_budget):
        flips = sorted({f ^ (1 << b) for f in flips for b in range(depth)} | {*flips})
    both = None
    for lower_first in (False, True):
        key = _turned(F.col("fp"), lower_first)
        prefix = F.shiftrightunsigned(key, BITS - depth)
        dealt = distinct.select(key.alias("key"), prefix.alias("own")).select(
            "key", "own", F.explode(F.array(*[F.lit(f).cast("long") for f in flips])).alias("flip")
        )
        other = F.col("own").bitwiseXOR(F.col("flip"))
        dealt = dealt.select(
            "key",
            F.least("own", other).alias("a"),
            F.greatest("own", other).alias("b"),
            (F.col("own") > other).alias("second"),
            F.lit(lower_first).alias("lower_first"),
        )
        both = dealt if both is None else both.unionAll(dealt)
    pair = ["lower_first", "a", "b"]
    # A node pair with more fingerprints than a task should walk is dealt in chunks,
    # and its chunk pairs are groups: none is left out.
    large = both.groupBy(*pair).count().where(F.col("count") > group).withColumn("chunks", F.ceil(F.col("count") / group).cast("int"))
    chunks = F.coalesce("chunks", F.lit(1))
    mine = F.pmod(F.xxhash64("key"), chunks).cast("int")
    dealt = (
        both.join(large.drop("count"), pair, "left")
        .select(*pair, "key", "second", mine.alias("chunk"), F.explode(F.sequence(F.lit(0), chunks - 1)).alias("with"))
        .select(*pair, "key", "second", "chunk", F.least("chunk", "with").alias("c"), F.greatest("chunk", "with").alias("d"))
    )

    def walk(rows: pd.DataFrame) -> pd.DataFrame:
        lower = bool(rows["lower_first"].iloc[0])
        same, whole = rows["a"].iloc[0] == rows["b"].iloc[0], rows["c"].iloc[0] == rows["d"].iloc[0]
        keys, second = rows["key"].to_numpy().view(np.uint64), rows["second"].to_numpy()
        low = (rows["chunk"] == rows["c"]).to_numpy()
        if same:
            sides = [(keys, None)] if whole else [(keys[low], keys[~low])]
        elif whole:
            sides = [(keys[~second], keys[second])]
        else:
            sides = [(keys[~second & low], keys[second & ~low]), (keys[~second & ~low], keys[second & low])]
        src, dst = [], []
        for left, right in sides:
            left = np.sort(left)
            right = None if right is None else np.sort(right)
            i, j = trie_pairs(left, right, first_budget, max_bits)
            src.append(left[i])
            dst.append((left if right is None else right)[j])
        src, dst = np.concatenate(src), np.concatenate(dst)
        nodes, at = np.unique(np.concatenate([src, dst]), return_inverse=True)
        kept = spanning(at[: len(src)], at[len(src) :], len(nodes))
        src, dst = src[kept], dst[kept]
        if lower:
            src, dst = _turn_back(src), _turn_back(dst)
        return pd.DataFrame({"src": src.view(np.int64), "dst": dst.view(np.int64)})

    return dealt.groupBy(*pair, "c", "d").applyInPandas(walk, "src long, dst long")


def trie_depth(n: int, group: int) -> int:
    """Bits of the tries' top: about ``group`` / 8 fingerprints under a node."""
    return int(min(BITS // 2 - 1, max(4, np.ceil(np.log2(max(1, 8 * n / group))))))


def near_groups(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    max_bits: int = MAX_BITS,
    group: int = GROUP,
    carry: bool = False,
) -> DataFrame:
    """(id, fp, component_id, keeper) per row, with the input row in ``_row`` if
    ``carry``: component_id is the smallest id that near fingerprints lead to, keeper
    is true for one row of each component, of that id.

    Null, empty and blank texts have fingerprint zero and group with each other. Rows
    with a null id take part in links and come after all others in naming: only a
    component of nothing else has a null component_id. Repeated rows stay, in one
    component, and one of them at most is the keeper.
    """
    found = fingerprints(docs, id_col=id_col, text_col=text_col, shingle=shingle, carry=carry)
    # Written down, so that the row number stays what it is.
    marked = store(found.withColumn("rid", F.monotonically_increasing_id()), "fingerprints")
    first = F.struct(F.col("id").isNull().alias("unnamed"), "id", "rid")
    # One node for each distinct fingerprint: copies, however many, are no pairs.
    nodes = store(marked.groupBy("fp").agg(F.min(first).alias("least")), "nodes")
    links = near_links(nodes.select("fp"), max_bits=max_bits, depth=trie_depth(nodes.count(), group), group=group)
    members = connected(links)
    named = nodes.join(members, nodes["fp"] == members["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    least = named.groupBy("root").agg(F.min("least").alias("first"))
    labels = named.join(least, "root").select("fp", "first")
    return (
        marked.join(labels, "fp")
        .withColumn("component_id", F.col("first.id"))
        .withColumn("keeper", F.col("rid") == F.col("first.rid"))
        .drop("first", "rid")
    )


def one_of_each(docs: DataFrame, **options) -> DataFrame:
    """One row of each group of near rows, with its columns as they were: that of the
    smallest id (see ``near_groups``)."""
    return widen(near_groups(docs, carry=True, **options).where("keeper"))
