"""SentencePiece encoding with sampled segmentations, and decoding.

Gumbel top-k without replacement by A-star search. A node of the search is a set of
segmentations that agree up to a unit and differ there from the ones already taken;
its value is the greatest perturbed log-probability in the set, drawn as a Gumbel
truncated at the value of the set it was cut from. Taking the best node, drawing the
segmentation that has its value and cutting the set at every later unit emits distinct
segmentations in descending order of perturbed log-probability. The next value after
the last is the threshold that inclusion scores need.

The drawn numbers depend on the row's key, the sample, the unit and the step alone.
"""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shardlog.llm.common import extended, map_blocks, narrow, ranges, shifted_sums
from shardlog.llm.piece_lattice import BLANK, Lattices, Units, Vocabulary
from shardlog.llm.polyhash import mixed

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
K = 2
# Scores are taken times this: the model's are merge ranks, 1 to 32,000.
ALPHA = 5e-4
SEED = 11
BLOCK_BYTES = 1 << 20
# Units after a cut that get search nodes of their own; the rest shares one, which is
# opened when it is taken.
NODES = 16


def uniform(key: np.ndarray, *counters) -> np.ndarray:
    """Numbers in (0, 1) from a key and counters."""
    h = key.astype(np.uint64)
    for i, c in enumerate(counters, start=1):
        h = _stirred(h, i, c)
    return _fraction(h)


def _stirred(h: np.ndarray, i: int, counter) -> np.ndarray:
    return mixed(h ^ mixed(np.atleast_1d(counter).astype(np.uint64) + np.uint64(i << 56)))


def _fraction(h: np.ndarray) -> np.ndarray:
    return ((h >> np.uint64(11)).astype(np.float64) + 0.5) / float(1 << 53)


def _log1mexp(x: np.ndarray) -> np.ndarray:
    """log(1 - exp(x)) for x <= 0; minus infinity at 0."""
    with np.errstate(divide="ignore"):
        return np.where(x > -0.7, np.log(-np.expm1(x)), np.log1p(-np.exp(x)))


def _truncated(log_mass: np.ndarray, bound: np.ndarray, u: np.ndarray) -> np.ndarray:
    """A Gumbel at ``log_mass`` that is at most ``bound``."""
    noise = -np.log(-np.log(u))
    return np.where(np.isneginf(log_mass), -np.inf, -np.logaddexp(-bound, -(np.where(np.isneginf(log_mass), 0.0, log_mass) + noise)))


class Sample:
    """One segmentation of every text of a block (or of those that have one left)."""

    def __init__(self, edges, count, log_p, value, first, excluded):
        self.edges, self.count, self.log_p = edges, count, log_p  # all units in order
        self.value, self.first = value, first  # by text: perturbed value, unit it was cut at
        self.excluded = excluded  # by text: the paths taken at that unit
        self.begin = shifted_sums(count)
        self.nodes: np.ndarray | None = None  # by text and column: values of the open nodes beside it
        self.opened: dict[int, list[int]] = {}  # by text: units taken out of the last column


class Search:
    """The samples of a block of texts, all texts at once."""

    def __init__(self, texts: list[str], keys: np.ndarray, vocabulary: Vocabulary, nodes: int = NODES):
        units = Units(texts, vocabulary)
        sizes = units.per_text
        self.unit = units.number
        self.lattices = Lattices(units.codes, units.sizes, vocabulary)
        self.begin = shifted_sums(sizes)
        self.sizes, self.keys, self.width = sizes, keys, nodes
        self.text_of = np.repeat(np.arange(len(texts)), sizes)
        self.place = np.arange(len(self.unit)) - self.begin[self.text_of]
        self.samples: list[Sample] = []

    def _draw(self, units: np.ndarray, number: int):
        # Key and sample are stirred once a text, the unit's place once a unit.
        h = _stirred(_stirred(self.keys.astype(np.uint64), 1, number)[self.text_of[units]], 2, self.place[units] + 1)
        return lambda which, step: _fraction(_stirred(h[which], 3, step))

    def _open(self, s: Sample, number: int) -> None:
        """The nodes beside a sample: one column for each of the units from its cut on,
        and one for all that are later."""
        n, width = len(self.sizes), self.width
        column = self.begin[:-1, None] + s.first[:, None] + np.arange(width)
        inside = column < self.begin[1:, None]
        own = np.where(inside, s.log_p[np.minimum(column, max(len(s.log_p) - 1, 0))] if len(s.log_p) else 0.0, 0.0)
        sums = shifted_floats(s.log_p)
        before = sums[self.begin[:-1] + np.minimum(s.first, self.sizes)] - sums[self.begin[:-1]]
        prefix = before[:, None] + np.cumsum(own, axis=1) - own
        mass = prefix + _log1mexp(own)
        # At the cut, everything taken there is gone from the set, not only this path.
        for t in np.flatnonzero(inside[:, 0]).tolist():
            if len(s.excluded[t]) > 1:
                gone = sum(np.exp(self.lattices.log_p[list(p)].sum()) for p in s.excluded[t])
                mass[t, 0] = prefix[t, 0] + (np.log(1 - gone) if gone < 1 - 1e-12 else -np.inf)
        mass[~inside] = -np.inf
        later = np.minimum(s.first + width, self.sizes)
        tail = sums[self.begin[1:]] - sums[self.begin[:-1] + later]
        tail_mass = before + own.sum(axis=1) + _log1mexp(np.minimum(tail, 0))
        tail_mass[later >= self.sizes] = -np.inf
        mass = np.column_stack([mass, tail_mass])
        u = uniform(np.repeat(self.keys, width + 1), number, np.tile(np.arange(width + 1), n), np.full(n * (width + 1), 1 << 40)).reshape(n, width + 1)
        s.nodes = _truncated(mass, np.where(np.isneginf(s.value), 0.0, s.value)[:, None], u)
        s.nodes[np.isneginf(s.value)] = -np.inf

    def path(self, s: Sample, unit: int) -> tuple[int, ...]:
        return tuple(s.edges[s.begin[unit] : s.begin[unit + 1]].tolist())

    def first_sample(self) -> None:
        everything = np.arange(len(self.unit))
        edges, count, log_p = self.lattices.walk(self.unit, self._draw(everything, 0))
        value = -np.log(-np.log(uniform(self.keys, 0, 0, 1 << 41)))
        s = Sample(edges, count, log_p, value, np.zeros(len(self.sizes), dtype=np.int64), [[] for _ in self.sizes])
        self._open(s, 0)
        self.samples.append(s)

    def best(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """By text: the greatest value of an open node, its sample and its column."""
        tops = np.stack([s.nodes.max(axis=1) for s in self.samples])
        which = tops.argmax(axis=0)
        texts = np.arange(len(self.sizes))
        column = np.stack([s.nodes.argmax(axis=1) for s in self.samples])[which, texts]
        return tops[which, texts], which, column

    def next_sample(self) -> None:
        """Takes every text's best node and draws the segmentation that has its value."""
        number = len(self.samples)
        value, parent, column = self.best()
        cut = np.zeros(len(self.sizes), dtype=np.int64)
        excluded: list[list] = [[] for _ in self.sizes]
        chosen: dict[int, tuple[int, ...]] = {}
        for t in np.flatnonzero(~np.isneginf(value)).tolist():
            s, c = self.samples[parent[t]], int(column[t])
            at = int(s.first[t]) + c
            rng = random.Random(int(self.keys[t]) * 1_000_003 + number)
            s.nodes[t, c] = -np.inf
            if c == self.width:
                at = self._open_tail(s, t, float(value[t]), rng)
            unit = int(self.begin[t]) + at
            taken = [self.path(s, unit)]
            if c == 0:
                taken += [p for p in s.excluded[t] if p not in taken]
            path = self.lattices.walk_beside(int(self.unit[unit]), taken, rng.random)
            if path is None:
                value[t] = -np.inf
                continue
            cut[t], chosen[unit], excluded[t] = at, path, [path, *taken]
        # Before the cut the parent's path, at the cut the chosen one, a fresh walk after.
        live = ~np.isneginf(value)[self.text_of]
        fresh = np.flatnonzero(live & (self.place > cut[self.text_of]))
        count, log_p = np.zeros(len(self.unit), dtype=np.int64), np.zeros(len(self.unit))
        new_edges, new_count, new_log_p = self.lattices.walk(self.unit[fresh], self._draw(fresh, number))
        count[fresh], log_p[fresh] = new_count, new_log_p
        old = []
        for i, s in enumerate(self.samples):
            same = np.flatnonzero(live & (parent[self.text_of] == i) & (self.place < cut[self.text_of]))
            count[same], log_p[same] = s.count[same], s.log_p[same]
            old.append((s, same))
        for unit, path in chosen.items():
            count[unit], log_p[unit] = len(path), min(0.0, self.lattices.log_p[list(path)].sum())
        begin = shifted_sums(count)
        edges = np.zeros(int(begin[-1]), dtype=np.int64)
        edges[ranges(begin[fresh], new_count)] = new_edges
        for s, same in old:
            edges[ranges(begin[same], count[same])] = s.edges[ranges(s.begin[same], count[same])]
        for unit, path in chosen.items():
            edges[begin[unit] : begin[unit] + len(path)] = path
        s = Sample(edges, count, log_p, value, cut, excluded)
        self._open(s, number)
        self.samples.append(s)

    def _tail(self, s: Sample, t: int) -> tuple[float, np.ndarray]:
        """Log-probability up to the shared last node, and for each unit behind it the
        mass, from there on, of the segmentations that differ at that unit first; none
        where that set has been taken out already."""
        low = int(s.first[t]) + self.width
        own = s.log_p[self.begin[t] + low : self.begin[t + 1]]
        mass = np.exp(np.cumsum(own) - own + _log1mexp(own))
        mass[s.opened.get(t, [])] = 0
        return float(s.log_p[self.begin[t] : self.begin[t] + low].sum()), mass

    def _open_tail(self, s: Sample, t: int, bound: float, rng: random.Random) -> int:
        """The unit at which the best segmentation of the shared node differs first; the
        others of the node stay one."""
        before, mass = self._tail(s, t)
        unit = min(int(np.searchsorted(np.cumsum(mass), rng.random() * mass.sum(), side="right")), len(mass) - 1)
        s.opened.setdefault(t, []).append(unit)
        mass[unit] = 0
        if mass.sum() > 0:
            s.nodes[t, self.width] = _truncated(np.array([before + np.log(mass.sum())]), np.array([bound]), np.array([rng.random()]))[0]
        return int(s.first[t]) + self.width + unit


def shifted_floats(values: np.ndarray) -> np.ndarray:
    out = np.zeros(len(values) + 1)
    np.cumsum(values, out=out[1:])
    return out


def encode_block(texts: list[str], keys: np.ndarray, k: int, vocabulary: Vocabulary, nodes: int = NODES) -> list[dict]:
    """Up to ``k`` segmentations of each text, as columns over (text, rank) rows."""
    search = Search(texts, keys, vocabulary, nodes)
    search.first_sample()
    for _ in range(1, k):
        search.next_sample()
    threshold = search.best()[0]
    lattices, out = search.lattices, []
    for s in search.samples:
        per_unit = shifted_sums(lattices.n_ids[s.edges])[s.begin]
        ids = lattices.ids[ranges(lattices.id_at[s.edges], lattices.n_ids[s.edges])]
        log_p = shifted_floats(s.log_p)
        total = log_p[search.begin[1:]] - log_p[search.begin[:-1]]
        with np.errstate(over="ignore", divide="ignore", invalid="ignore"):
            odds = total - threshold
            included = np.where(np.isneginf(threshold), 0.0, np.where(odds < -18, odds, np.log(-np.expm1(-np.exp(odds)))))
        out.append(
            {"alive": ~np.isneginf(s.value), "ids": ids, "cuts": per_unit[search.begin], "log_prob": total, "perturbed": s.value, "log_inclusion": included}
        )
    return out


def decode(ids: list[int], vocabulary: Vocabulary) -> str:
    """The text of a segmentation; bytes that are no UTF-8 are replaced."""
    text = b"".join(map(vocabulary.bytes_of.__getitem__, ids)).decode(errors="replace").replace(BLANK, " ")
    return text[1:] if text.startswith(" ") else text


def decoded_alike(ids: np.ndarray, cuts: np.ndarray, texts: list[str], vocabulary: Vocabulary) -> np.ndarray:
    """For each text whether its ids decode to it. The bytes of all pieces are laid end
    to end and compared with those that the texts should have; only where they differ
    is a text decoded by itself."""
    sizes = vocabulary.sizes_of[ids]
    flat = vocabulary.flat_bytes[ranges(vocabulary.starts_of[ids], sizes)].tobytes()
    ends = shifted_sums(sizes)[cuts].tolist()
    wanted = [(BLANK + t.replace(" ", BLANK)).encode() if t else b"" for t in texts]
    out = np.array([flat[a:b] == w for a, b, w in zip(ends, ends[1:], wanted)], dtype=bool)
    for t in np.flatnonzero(~out).tolist():
        out[t] = decode(ids[cuts[t] : cuts[t + 1]].tolist(), vocabulary) == texts[t].replace(BLANK, " ")
    return out


RESULT = "rank int, n_pieces long, log_prob double, perturbed double, log_inclusion double, ids_sha256 string, round_trip boolean, ids array<int>"


def _sample_block(block: pa.RecordBatch, k: int, vocabulary: Vocabulary, with_ids: bool) -> pa.RecordBatch:
    texts = [t or "" for t in block.column("text").to_pylist()]
    keys = mixed(np.asarray(block.column("key")).view(np.uint64) + np.uint64(SEED))
    columns: dict[str, list] = {c: [] for c in ("of", "rank", "n_pieces", "log_prob", "perturbed", "log_inclusion", "ids_sha256", "round_trip", "ids")}
    for rank, s in enumerate(encode_block(texts, keys, k, vocabulary), start=1):
        at = np.flatnonzero(s["alive"])
        columns["of"].append(at)
        columns["rank"].append(np.full(len(at), rank))
        columns["n_pieces"].append(np.diff(s["cuts"])[at])
        for c in ("log_prob", "perturbed", "log_inclusion"):
            columns[c].append(s[c][at])
        ids = s["ids"].astype("<i4")
        view, cuts = memoryview(ids.tobytes()), s["cuts"].tolist()
        columns["ids_sha256"] += [hashlib.sha256(view[4 * cuts[t] : 4 * cuts[t + 1]]).hexdigest() for t in at.tolist()]
        same = decoded_alike(ids, s["cuts"], texts, vocabulary)
        columns["round_trip"].append(same[at])
        # Texts without a segmentation of this rank have no pieces, so none are in between.
        columns["ids"].append(pa.ListArray.from_arrays(pa.array(np.append(s["cuts"][at], len(ids)), pa.int32()), pa.array(ids)))
    of = np.concatenate(columns["of"])
    # Rows of a text next to each other, in order of rank.
    order = np.argsort(of, kind="stable")
    out = {c: block.column(c).take(pa.array(of[order])) for c in block.schema.names if c not in ("text", "key")}
    for c in ("rank", "n_pieces", "log_prob", "perturbed", "log_inclusion"):
        values = np.concatenate(columns[c])[order]
        out[c] = pa.array(values.astype(np.int32) if c == "rank" else values)
    out["ids_sha256"] = pa.array(columns["ids_sha256"], pa.string()).take(pa.array(order))
    out["round_trip"] = pa.array(np.concatenate(columns["round_trip"])[order])
    if with_ids:
        out["ids"] = pa.concat_arrays(columns["ids"]).take(pa.array(order))
    return pa.RecordBatch.from_pydict(out)


def segmentations(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", model_path: str = MODEL, k: int = K, alpha: float = ALPHA, with_ids: bool = False
) -> DataFrame:
    """Up to ``k`` distinct sampled segmentations per row of ``docs``, by rank: id, rank
    (from 1), n_pieces, log_prob (exact, under the lattice), perturbed (the Gumbel-
    perturbed log_prob, descending), log_inclusion (log-probability that a text's first
    ``k`` hold the segmentation, given the next perturbed value), ids_sha256 (of the ids
    as little-endian int32), round_trip (whether decoding gives the text back) and, with
    ``with_ids``, ids.

    A text that has fewer segmentations has fewer rows. A null or empty text has one,
    of no pieces. Rows are sampled by the hash of their id: equal ids and texts get
    equal samples, a null id is a key like any other. U+2581 in a text is decoded as a
    blank, which it stands for in pieces; round_trip allows for that.
    """
    vocabulary = docs.sparkSession.sparkContext.broadcast(Vocabulary(model_path, alpha))
    rows = narrow(docs, id=id_col, text=text_col).select("id", F.col("text").cast("string").alias("text"), F.xxhash64("id").alias("key"))
    result = RESULT if with_ids else RESULT.removesuffix(", ids array<int>")
    schema = extended(rows, result, without=("text", "key"))
    return map_blocks(rows, "text", BLOCK_BYTES, schema, lambda b: _sample_block(b, k, vocabulary.value, with_ids))
