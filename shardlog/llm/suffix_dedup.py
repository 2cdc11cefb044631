"""Exact removal of repeated byte strings by sorted suffixes.

A string of ``length`` bytes has an anchor: the gram of least hash in it, the leftmost
of equals. Equal strings have the same anchor at the same offset, so a string can only
repeat where its anchor's gram repeats, and only the suffixes at repeated anchors are
sorted: by mergesort, comparing two suffixes by a binary search over prefix hashes for
their common extension, to the right of the anchor and to the left. Neighbours'
extensions are verified byte by byte. Which strings around the anchors are equal then
follows from the two orders.

Equal texts are one text with a count before any of this, and the equal surroundings of
anchors in a group are sorted once. A gram with more different surroundings than a task
should sort is split by longer contexts, in the end by whole strings, until no group is
larger. Long runs of one period, which would make an anchor of every period, are
recognised in the text and keep two anchors.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from functools import cmp_to_key

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shardlog.llm.common import map_blocks, narrow, shifted_sums, texts_of
from shardlog.llm.polyhash import PrefixHashes
from shardlog.session import scratch_path, store

LENGTH = 400
GRAM = 64
BLOCK_BYTES = 4 << 20
# Suffixes at one anchor gram that a task sorts. More are split by longer contexts.
GROUP = 1 << 11
# Grams of a period of up to one byte in so many are anchors only where there are no others.
PERIODS = 8
# Segments worked on at a time, if the groups are small.
CHUNK = 1 << 11


def periodic_grams(text: np.ndarray, gram: int, most: int) -> np.ndarray:
    """Which grams of a text repeat themselves after at most ``most`` bytes."""
    out = np.zeros(len(text) - gram + 1, dtype=bool)
    for d in range(1, most + 1):
        same, need = text[d:] == text[:-d], gram - d
        # So long a run holds eight bytes at a place that eight divides: a cheap look first.
        if need >= 15 and not (same[: len(same) // 8 * 8].view(np.uint64) == 0x0101010101010101).any():
            continue
        breaks = np.concatenate([[-1], np.flatnonzero(~same), [len(same)]])
        for i in np.flatnonzero(np.diff(breaks) > need).tolist():
            out[breaks[i] + 1 : breaks[i + 1] - need + 1] = True
    return out


def _thinned(text: np.ndarray, places: np.ndarray, whole: int, length: int, gram: int) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Which of a gram's places to keep as anchors, and spans of repeated strings.

    Places at one distance may be a run of that period. The strings of its second
    anchor come again at every later one whose strings lie within the run, so these
    need no anchor, and all of them are repeated. The first ``whole`` places are the
    anchors of all starts since the place before.
    """
    keep, spans = np.ones(len(places), dtype=bool), []
    apart = np.diff(places)
    edges = np.concatenate([[0], np.flatnonzero(apart[1:] != apart[:-1]) + 1, [len(apart)]]).tolist()
    for i, j in zip(edges, edges[1:]):
        d, begin, end = int(apart[i]), int(places[i]), int(places[j]) + gram
        t = min(int(np.searchsorted(places, end - length, side="right")), whole) - 1
        if t >= i + 2 and np.array_equal(text[begin : end - d], text[begin + d : end]):
            keep[i + 2 : t + 1] = False
            spans.append((begin + 1, int(places[t]) + length))
    return keep, spans


def anchors_of(text: np.ndarray, length: int, gram: int) -> tuple[tuple[np.ndarray, ...], list[tuple[int, int]]]:
    """(gram hash, place, first and last start of the strings whose anchor it is), and
    (start, stop) of spans of strings that the text itself repeats, without an anchor."""
    if len(text) < length:
        return (np.zeros(0, dtype=np.uint64), *[np.zeros(0, dtype=np.int64)] * 3), []
    hashes = PrefixHashes(text).grams(gram) >> np.uint64(1)
    hashes[periodic_grams(text, gram, gram // PERIODS)] |= np.uint64(1 << 63)
    width = length - gram + 1
    n = len(hashes)
    # Minimum of each window: of a suffix of one block and a prefix of the next.
    padded = np.append(hashes, np.full(-n % width, np.iinfo(np.uint64).max, dtype=np.uint64)).reshape(-1, width)
    forward = np.minimum.accumulate(padded, axis=1).ravel()
    backward = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(backward[: n - width + 1], forward[width - 1 : n])
    # The leftmost place of a window's minimum: the first place of that hash at or
    # after the window's start. Only places that are some window's minimum matter.
    change = np.flatnonzero(np.append(True, least[1:] != least[:-1]))
    stops = np.append(change[1:], len(least))
    out_hash, out_place, out_first, out_last, spans = [], [], [], [], []
    for first, stop in zip(change.tolist(), stops.tolist()):
        value = least[first]
        places = first + np.flatnonzero(hashes[first : stop - 1 + width] == value)
        firsts = np.append(first, places[:-1] + 1)
        own = firsts < stop
        if len(places) > 3:
            kept, more = _thinned(text, places, int((places < stop).sum()), length, gram)
            spans += more
            own &= kept
        out_place += places[own].tolist()
        out_first += firsts[own].tolist()
        out_last += np.minimum(places[own], stop - 1).tolist()
        out_hash += [value] * int(own.sum())
    return (np.array(out_hash, dtype=np.uint64), *(np.array(x, dtype=np.int64) for x in (out_place, out_first, out_last))), spans


def _anchor_block(block: pa.RecordBatch, length: int, gram: int) -> pa.RecordBatch:
    """Anchors; spans come as rows without a gram."""
    each = [anchors_of(np.frombuffer(t, dtype=np.uint8), length, gram) for t in texts_of(block)]
    counts = [len(anchors[0]) for anchors, _ in each]
    grams, places, firsts, lasts = (np.concatenate(x) for x in zip(*(anchors for anchors, _ in each)))
    spans = [(i, *span) for i, (_, own) in enumerate(each) for span in own]
    owner = np.concatenate([np.repeat(np.arange(len(each)), counts), np.array([i for i, _, _ in spans], dtype=np.int64)])
    return pa.RecordBatch.from_pydict(
        {
            "digest": block.column("digest").take(pa.array(owner)),
            "gram": pa.array(grams.view(np.int64).tolist() + [None] * len(spans), pa.int64()),
            "place": pa.array(places.tolist() + [0] * len(spans), pa.int32()),
            "first": pa.array(firsts.tolist() + [x for _, x, _ in spans], pa.int32()),
            "last": pa.array(lasts.tolist() + [x for _, _, x in spans], pa.int32()),
        }
    )


def digest_of(text: Column) -> Column:
    """128 bits of the text's SHA-256."""
    return F.unhex(F.substring(F.sha2(text, 256), 1, 32))


class Sorter:
    """Orders suffixes of ``data`` at given places, one group after the other."""

    def __init__(self, data: np.ndarray, reach: np.ndarray, rightward: bool):
        self.raw, self.reach, self.rightward = data.tobytes(), reach.tolist(), rightward
        hashes = PrefixHashes(data)
        self.sums, self.unshift = memoryview(hashes.sums), memoryview(hashes.unshift)

    def slice(self, at: int, size: int) -> tuple[int, int]:
        return (at, at + size) if self.rightward else (at - size, at)

    def common(self, x: int, y: int, most: int) -> int:
        """Bytes that the suffixes at x and y share, by binary search over hashes."""
        sums, unshift, mask = self.sums, self.unshift, (1 << 64) - 1
        low, high = 0, most
        while low < high:
            mid = (low + high + 1) >> 1
            a, b = self.slice(x, mid)
            c, d = self.slice(y, mid)
            if ((sums[b] - sums[a]) * unshift[a] - (sums[d] - sums[c]) * unshift[c]) & mask:
                high = mid - 1
            else:
                low = mid
        return low

    def after(self, at: int, size: int) -> int:
        return self.raw[at + size] if self.rightward else self.raw[at - size - 1]

    def verified(self, x: int, y: int, size: int) -> bool:
        a, b = self.slice(x, size)
        c, d = self.slice(y, size)
        return self.raw[a:b] == self.raw[c:d]

    def order(self, members: list[int], places: list[int]) -> tuple[list[int], list[int]]:
        """Members by their suffixes, and what each shares with the one before it."""
        reach = self.reach

        def compare(i: int, j: int) -> int:
            most = min(reach[i], reach[j])
            size = self.common(places[i], places[j], most)
            if size == most:
                return reach[i] - reach[j]
            return self.after(places[i], size) - self.after(places[j], size)

        ordered = sorted(members, key=cmp_to_key(compare))
        shared = [0]
        for i, j in zip(ordered, ordered[1:]):
            size = self.common(places[i], places[j], min(reach[i], reach[j]))
            if not self.verified(places[i], places[j], size):
                return self.plain_order(members, places)
            shared.append(size)
        return ordered, shared

    def plain_order(self, members: list[int], places: list[int]) -> tuple[list[int], list[int]]:
        """The same from the bytes alone, for the case that hashes have collided."""
        own = {}
        for i in members:
            a, b = self.slice(places[i], self.reach[i])
            own[i] = self.raw[a:b] if self.rightward else self.raw[a:b][::-1]
        ordered = sorted(members, key=own.__getitem__)
        shared = [0]
        for i, j in zip(ordered, ordered[1:]):
            x, y = np.frombuffer(own[i], np.uint8), np.frombuffer(own[j], np.uint8)
            n = min(len(x), len(y))
            differ = np.flatnonzero(x[:n] != y[:n])
            shared.append(int(differ[0]) if len(differ) else n)
        return ordered, shared


def repeated_starts(segments: list[bytes], anchor: np.ndarray, first: np.ndarray, last: np.ndarray, groups: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(segment, offset) of the strings that occur more than once in their group.

    A segment holds all strings that have its anchor; ``anchor`` is the anchor's place
    in it, a string at offset o starts o bytes before the anchor, and the offsets go
    from ``first`` to ``last``. ``groups`` is not decreasing. Two strings at one
    offset are equal if o bytes to the left and the rest to the right are: if they
    are in one class of either order, cut where neighbours share less.
    """
    sizes = np.array([len(s) for s in segments], dtype=np.int64)
    base = shifted_sums(sizes)[:-1]
    data = np.frombuffer(b"".join(segments), dtype=np.uint8)
    places = (base + anchor).tolist()
    bounds = np.append(np.flatnonzero(np.append(True, groups[1:] != groups[:-1])), len(groups)).tolist()
    orders = []
    for rightward in (False, True):
        sorter = Sorter(data, sizes - anchor if rightward else anchor, rightward)
        order, shared = [], []
        for begin, end in zip(bounds, bounds[1:]):
            o, s = sorter.order(list(range(begin, end)), places)
            s[0] = -1  # no class crosses groups
            order += o
            shared += s
        orders.append((np.array(order), np.array(shared)))
    hits, offsets = [], []
    for offset in range(int(first.min()), int(last.max()) + 1):
        named = []
        for (order, shared), need in zip(orders, (offset, length - offset)):
            class_of = np.empty(len(order), dtype=np.int64)
            class_of[order] = np.cumsum(shared < need)
            named.append(class_of)
        here = np.flatnonzero((first <= offset) & (offset <= last))
        if len(here) < 2:
            continue
        key = named[0][here] * (len(groups) + 1) + named[1][here]
        _, inverse, counts = np.unique(key, return_inverse=True, return_counts=True)
        hit = here[counts[inverse] > 1]
        hits.append(hit)
        offsets.append(np.full(len(hit), offset))
    if not hits:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    return np.concatenate(hits), np.concatenate(offsets)


def _merged(owner: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unions of the intervals of each owner."""
    order = np.lexsort((starts, owner))
    owner, starts, ends = owner[order], starts[order], ends[order]
    # Owners are set apart by more than any place, so one running maximum serves all.
    apart = int(ends.max(initial=0)) + 2
    far = np.maximum.accumulate(ends + owner * apart)
    new = np.append(True, (starts + owner * apart)[1:] > far[:-1])[: len(owner)]
    at = np.flatnonzero(new)
    stop = far[np.append(at[1:], len(owner)) - 1] if len(owner) else far
    return owner[at], starts[at], stop - owner[at] * apart


SPANS = "digest binary, start int, stop int"


def _sort_groups(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Spans of repeated strings, from segments that come sorted by gram."""
    held: list[dict] = []

    def work(rows: list[dict]) -> pa.RecordBatch:
        gram, place, first, last = (np.array([r[c] for r in rows], dtype=np.int64) for c in ("gram", "place", "first", "last"))
        # Equal segments of a group are sorted once; all their strings are repeated.
        numbers: dict[tuple, int] = {}
        kind = np.array([numbers.setdefault((r["gram"], r["place"] - r["first"], r["segment"]), len(numbers)) for r in rows])
        lead, copies = np.unique(kind, return_index=True, return_counts=True)[1:]
        partners = np.unique(gram[lead], return_inverse=True, return_counts=True)
        lead = lead[partners[2][partners[1]] > 1]
        twice = np.flatnonzero(copies[kind] > 1)
        owner, starts, stops = [twice], [first[twice]], [last[twice] + length]
        if len(lead):
            ahead = place[lead] - first[lead]
            hit, offset = repeated_starts([rows[i]["segment"] for i in lead.tolist()], ahead, place[lead] - last[lead], ahead, gram[lead], length)
            hit, offset = hit[copies[kind[lead[hit]]] == 1], offset[copies[kind[lead[hit]]] == 1]
            begin = place[lead[hit]] - offset
            spans = _merged(lead[hit], begin, begin + length)
            for out, own in zip((owner, starts, stops), spans):
                out.append(own)
        return pa.RecordBatch.from_pydict(
            {
                "digest": pa.array([rows[i]["digest"] for i in np.concatenate(owner).tolist()], pa.binary()),
                "start": pa.array(np.concatenate(starts).astype(np.int32)),
                "stop": pa.array(np.concatenate(stops).astype(np.int32)),
            }
        )

    for batch in batches:
        for small in (batch.slice(i, CHUNK) for i in range(0, batch.num_rows, CHUNK)):
            held += small.to_pylist()
            if len(held) >= CHUNK:
                # All but the last group, which may go on.
                cut = next((i for i in range(len(held) - 1, 0, -1) if held[i]["gram"] != held[i - 1]["gram"]), 0)
                if cut:
                    yield work(held[:cut])
                    held = held[cut:]
    if held:
        yield work(held)


def _segment_block(block: pa.RecordBatch, length: int) -> pa.RecordBatch:
    out: dict[str, list] = {c: [] for c in ("gram", "digest", "place", "first", "last", "frequent", "segment")}
    for digest, text, anchors in zip(block.column("digest").to_pylist(), texts_of(block), block.column("anchors").to_pylist()):
        for a in anchors:
            for c in ("gram", "place", "first", "last", "frequent"):
                out[c].append(a[c])
            out["digest"].append(digest)
            out["segment"].append(text[a["first"] : a["last"] + length])
    types = {"gram": pa.int64(), "frequent": pa.bool_(), "digest": pa.binary(), "segment": pa.binary()}
    return pa.RecordBatch.from_pydict({c: pa.array(v, types.get(c, pa.int32())) for c, v in out.items()})


def _split_block(block: pa.RecordBatch, width: int, length: int) -> pa.RecordBatch:
    """The segments cut by their strings' offsets before the anchor, ``width`` offsets to
    a part, under a gram that is also a hash of what all strings of such a part contain."""
    out: dict[str, list] = {c: [] for c in ("gram", "digest", "place", "first", "last", "segment")}
    for r in block.to_pylist():
        text, place, least = r["segment"], r["place"], r["place"] - r["last"]
        for part in range(least // width, place // width + 1):
            low, high = part * width, part * width + width - 1
            first, last = place - min(high, place), place - max(low, least)
            context = xxhash.xxh3_64_intdigest(text[place - low : place - high + length], seed=(r["gram"] + part) % (1 << 64))
            for c, v in zip(out, (context - (1 << 63), r["digest"], place, first, last, text[first : last + length])):
                out[c].append(v)
    types = {"gram": pa.int64(), "digest": pa.binary(), "segment": pa.binary()}
    return pa.RecordBatch.from_pydict({c: pa.array(v, types.get(c, pa.int32())) for c, v in out.items()})


def distinct_texts(docs: DataFrame, text_col: str) -> DataFrame:
    """(digest, text, copies), written bucketed by digest: joins on it move no text."""
    rows = narrow(docs, text=text_col).select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    spark = docs.sparkSession
    merged = rows.groupBy(digest_of(F.col("text")).alias("digest")).agg(F.first("text").alias("text"), F.count("*").alias("copies"))
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"texts_{uuid.uuid4().hex}"
    path = scratch_path(spark, "texts")
    merged.write.bucketBy(buckets, "digest").option("path", path).format("parquet").saveAsTable(name)
    written = spark.table(name)
    # Only the catalog knows buckets when a table is opened; it need not know it further.
    # The files are in the shared folder and stay.
    spark.sql(f"DROP TABLE {name}")
    return written


def _sorted_spans(segments: DataFrame, length: int) -> DataFrame:
    """(digest, start, stop) from segments that a task can sort gram by gram."""
    # Dealt by an expression. Spark drops a repartition by a column that a join has dealt
    # by already, and adaptive execution may then split the join's partitions, and grams.
    dealt = segments.select("gram", "digest", "place", "first", "last", "segment").repartition(F.xxhash64("gram")).sortWithinPartitions("gram")
    return dealt.mapInArrow(lambda batches: _sort_groups(batches, length), SPANS)


def frequent_spans(segments: DataFrame, length: int, group: int, widths: tuple[int, ...]) -> DataFrame:
    """(digest, start, stop) of repeated strings in segments of frequent grams.

    Equal segments are brought together (by 128 bits of SHA-256, with their anchor's
    place), and grams that still have more than ``group`` of them are split by a longer
    context: what all strings share whose offsets before the anchor lie in one range of
    ``widths[0]`` offsets. Equal strings at one offset stay together. The last width is
    one: a gram is a string then, and its segments are equal.
    """
    ahead = F.col("place") - F.col("first")
    key = digest_of(F.concat(ahead.cast("string").cast("binary"), F.lit(":").cast("binary"), F.col("segment")))
    keyed = segments.withColumn("key", key)
    kinds = keyed.groupBy("gram", "key").agg(
        F.first("segment").alias("segment"), F.first(ahead).alias("place"), F.first(F.col("last") - F.col("first")).alias("last"), F.count("*").alias("copies")
    )
    kinds = store(kinds.select("gram", F.col("key").alias("digest"), "place", F.lit(0).alias("first"), "last", "segment", "copies"), "kinds")
    sizes = store(kinds.groupBy("gram").count().where("count > 1").select("gram", (F.col("count") > group).alias("frequent")), "kinds-of-grams")
    found = kinds.where("copies > 1").select("digest", "first", (F.col("last") + length).alias("stop"))
    found = found.unionAll(_sorted_spans(kinds.join(sizes.where("not frequent"), "gram"), length))
    if widths and not sizes.where("frequent").isEmpty():
        many = kinds.join(sizes.where("frequent"), "gram").select("gram", "digest", "place", "last", "segment")
        schema = "gram long, digest binary, place int, first int, last int, segment binary"
        parts = store(map_blocks(many, "segment", BLOCK_BYTES // 8, schema, lambda b: _split_block(b, widths[0], length)), "parts")
        found = found.unionAll(frequent_spans(parts, length, group, widths[1:]))
    spans = found.toDF("key", "start", "stop").groupBy("key").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    back = keyed.select("key", "digest", "first").join(spans, "key").select("digest", "first", F.explode("spans").alias("s"))
    return back.select("digest", (F.col("first") + F.col("s.start")).alias("start"), (F.col("first") + F.col("s.stop")).alias("stop"))


def repeated_spans(texts: DataFrame, *, length: int = LENGTH, gram: int = GRAM, group: int = GROUP) -> DataFrame:
    """(digest, start, stop) byte spans of ``texts`` that ``length``-byte strings
    occurring more than once among the distinct texts cover; spans may overlap."""
    anchors = store(
        map_blocks(
            texts.where(F.octet_length("text") >= length).select("digest", "text"),
            "text", BLOCK_BYTES, "digest binary, gram long, place int, first int, last int",
            lambda b: _anchor_block(b, length, gram),
        ),
        "anchors",
    )
    # Written down, so that the join has a shuffle of its own, whose large partitions
    # adaptive execution can split; that of the counting must keep a gram together.
    repeated = store(anchors.where("gram is not null").groupBy("gram").count().where("count > 1").select("gram", (F.col("count") > group).alias("frequent")), "grams")
    mine = anchors.join(repeated, "gram").groupBy("digest").agg(F.collect_list(F.struct("gram", "place", "first", "last", "frequent")).alias("anchors"))
    segments = store(
        map_blocks(
            texts.select("digest", "text").join(mine, "digest"),
            "text", BLOCK_BYTES, "gram long, digest binary, place int, first int, last int, frequent boolean, segment binary",
            lambda b: _segment_block(b, length),
        ),
        "segments",
    )
    runs = anchors.where("gram is null").select("digest", F.col("first").alias("start"), F.col("last").alias("stop"))
    spans = runs.unionAll(_sorted_spans(segments.where("not frequent"), length))
    if repeated.where("frequent").isEmpty():
        return spans
    widths = (max(1, length // 6), max(1, length // 48), 1)
    return spans.unionAll(frequent_spans(segments.where("frequent").drop("frequent"), length, group, widths))


def _cut_block(block: pa.RecordBatch) -> pa.RecordBatch:
    removed, runs, digests, kept_texts = [], [], [], []
    for text, spans in zip(texts_of(block), block.column("spans").to_pylist()):
        spans = sorted((s["start"], s["stop"]) for s in spans or [])
        kept, at, n = [], 0, 0
        for start, stop in spans:
            if start > at or not n:
                kept.append(text[at:start])
                n += 1
            at = max(at, stop)
        kept.append(text[at:])
        data = b"".join(kept)
        removed.append(len(text) - len(data))
        runs.append(n)
        digests.append(hashlib.sha256(data).hexdigest())
        kept_texts.append(data)
    out = {
        "digest": block.column("digest"),
        "n_bytes": pa.array([len(t) for t in texts_of(block)], pa.int64()),
        "n_removed": pa.array(removed, pa.int64()),
        "n_spans": pa.array(runs, pa.int64()),
        "kept_sha256": pa.array(digests, pa.string()),
        "kept": pa.array(kept_texts, pa.binary()),
    }
    return pa.RecordBatch.from_pydict(out)


def remove_repeats(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM, group: int = GROUP, keep_text: bool = False
) -> DataFrame:
    """Per row of ``docs``: id, n_bytes, n_removed, n_spans (maximal removed runs),
    kept_sha256 and, with ``keep_text``, ``kept``: the bytes that are left.

    A byte goes if a ``length``-byte string that covers it also starts anywhere else,
    in the same row or another. A null text is empty; an empty or shorter text loses
    nothing. Repeated rows are copies of each other: they lose all bytes if they are
    long enough. What is left may not be whole UTF-8 characters, so it is binary.
    """
    texts = distinct_texts(docs, text_col)
    spans = repeated_spans(texts, length=length, gram=gram, group=group)
    once = spans.groupBy("digest").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    size = F.octet_length("text")
    whole = F.array(F.struct(F.lit(0).alias("start"), size.alias("stop")))
    due = F.when(F.col("copies") == 1, F.col("spans")).when(size >= length, whole)
    result = map_blocks(
        texts.join(once, "digest", "left").select("digest", "text", due.alias("spans")),
        "text", BLOCK_BYTES, "digest binary, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary", _cut_block,
    )
    if not keep_text:
        result = result.drop("kept")
    rows = narrow(docs, id=id_col, text=text_col)
    return rows.select("id", digest_of(F.coalesce("text", F.lit(""))).alias("digest")).join(result, "digest").drop("digest")
