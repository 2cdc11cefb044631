"""Lattices of SentencePiece segmentations, many units at a time.

A unit is a stretch of text that no piece reaches out of, because no piece holds the
two characters at its border next to each other: the lattice of a text is the chain of
its units' lattices. Distinct units are analysed once per block. A path
through a unit is drawn from its exact distribution, in which a segmentation's
probability is proportional to exp(sum of its pieces' scores).
"""

from __future__ import annotations

import numpy as np

from shardlog.llm.common import ranges, shifted_sums
from shardlog.llm.polyhash import PrefixHashes, mixed

BLANK = "▁"
# Added to the least score for a character that no piece holds.
UNKNOWN = -10.0
NEAR, LATIN = 1 << 16, 0x250  # characters of the basic plane, and of its Latin start


class Vocabulary:
    """The pieces of a SentencePiece model, as arrays that travel with a job."""

    def __init__(self, model_path: str, alpha: float):
        from sentencepiece import SentencePieceProcessor

        sp = SentencePieceProcessor(model_file=model_path)
        probe = " a  b\tc\nＡ "
        if sp.normalize(probe) != BLANK + probe.replace(" ", BLANK):
            raise ValueError("only models that leave texts as they are, but for a blank in front, are supported")
        names = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
        normal = [i for i in range(len(names)) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        self.ids = np.array(normal, dtype=np.int32)
        self.scores = np.array([sp.get_score(i) for i in normal]) * alpha
        self.unknown_score = float(self.scores.min()) + UNKNOWN
        self.unknown_id = sp.unk_id()
        self.byte_ids = np.full(256, -1, dtype=np.int32)
        for i in range(len(names)):
            if sp.is_byte(i):
                self.byte_ids[int(names[i][3:-1], 16)] = i
        self.bytes_of = [n.encode() for n in names]
        for value, i in enumerate(self.byte_ids.tolist()):
            if i >= 0:
                self.bytes_of[i] = bytes([value])
        # The same end to end, for many ids at a time.
        self.sizes_of = np.array([len(b) for b in self.bytes_of], dtype=np.int64)
        self.starts_of = shifted_sums(self.sizes_of)[:-1]
        self.flat_bytes = np.frombuffer(b"".join(self.bytes_of), dtype=np.uint8)
        self.longest = max(len(names[i]) for i in normal)
        codes = [code_points(names[i]) for i in normal]
        begins = shifted_sums(np.array([len(c) for c in codes]))
        flat = np.concatenate(codes)
        self.worth = mixed(np.arange(1, NEAR + 1, dtype=np.uint64))
        self._index(self.hashes(flat).slices(begins[:-1], begins[1:]))
        # Neighbours inside some piece: a bitmap of frequent characters, a list of others.
        inside = np.ones(len(flat) - 1, dtype=bool)
        inside[begins[1:-1] - 1] = False
        a, b = flat[:-1][inside].astype(np.int64), flat[1:][inside].astype(np.int64)
        near = (a < LATIN) & (b < LATIN)
        self.latin_pair = np.zeros((LATIN, LATIN), dtype=bool)
        self.latin_pair[a[near], b[near]] = True
        self.pairs = np.unique((a << 32 | b)[~near])

    def _index(self, keys: np.ndarray) -> None:
        """Open addressing: a slot holds a piece or -1."""
        self.bits = max(4, int(len(keys) * 8).bit_length())
        self.slot_key = np.zeros(1 << self.bits, dtype=np.uint64)
        self.slot_piece = np.full(1 << self.bits, -1, dtype=np.int32)
        for piece, (key, slot) in enumerate(zip(keys.tolist(), self._slot(keys).tolist())):
            while self.slot_piece[slot] >= 0:
                slot = (slot + 1) & ((1 << self.bits) - 1)
            self.slot_key[slot], self.slot_piece[slot] = key, piece

    def hashes(self, codes: np.ndarray) -> PrefixHashes:
        """Of code points; those of the basic plane are looked up in a table."""
        return PrefixHashes(codes, values=lambda c: self.worth[c] if c.max(initial=0) < NEAR else mixed(c.astype(np.uint64) + np.uint64(1)))

    def joined(self, codes: np.ndarray) -> np.ndarray:
        """For each character whether some piece may hold it and the one after it."""
        a, b = codes[:-1].astype(np.int64), codes[1:].astype(np.int64)
        near = (a < LATIN) & (b < LATIN)
        out = self.latin_pair[np.where(near, a, 0), np.where(near, b, 0)] & near
        far = np.flatnonzero(~near)
        if len(far) and len(self.pairs):
            pair = a[far] << 32 | b[far]
            at = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
            out[far] = self.pairs[at] == pair
        return out

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (mixed(keys) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The piece of each hash, or -1."""
        slot = self._slot(keys)
        out = np.where(self.slot_key[slot] == keys, self.slot_piece[slot], -1)
        open_ = np.flatnonzero((out < 0) & (self.slot_piece[slot] >= 0))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & ((1 << self.bits) - 1)
            at = slot[open_]
            same = (self.slot_key[at] == keys[open_]) & (self.slot_piece[at] >= 0)
            out[open_[same]] = self.slot_piece[at[same]]
            open_ = open_[~same & (self.slot_piece[at] >= 0)]
        return out


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)


class Units:
    """The units of texts: where each begins, and the distinct ones among them."""

    def __init__(self, texts: list[str], vocabulary: Vocabulary):
        # As the model reads a text: with a blank in front, unless it is empty.
        sizes = np.array([len(t) + 1 if t else 0 for t in texts], dtype=np.int64)
        ends = np.cumsum(sizes)
        codes = code_points("".join(" " + t for t in texts if t))
        codes = np.where(codes == 0x20, np.uint32(ord(BLANK)), codes)
        border = np.append(np.append(True, ~vocabulary.joined(codes)), True) if len(codes) else np.zeros(1, dtype=bool)
        border[ends] = True
        border[0] = True
        at = np.flatnonzero(border)
        begin, end = at[:-1], at[1:]
        self.per_text = np.diff(np.append(0, np.searchsorted(at, ends)))
        keys = mixed(vocabulary.hashes(codes).slices(begin, end))
        _, first, self.number = np.unique(keys, return_index=True, return_inverse=True)
        size = end - begin
        same = np.array_equal(size, size[first][self.number]) and np.array_equal(codes, codes[ranges(begin[first][self.number], size)])
        if not same:  # hashes have collided: every unit for itself
            first, self.number = np.arange(len(begin)), np.arange(len(begin))
        self.codes, self.sizes = codes[ranges(begin[first], size[first])], size[first]


class Lattices:
    """Edges of the lattices of distinct units, by the place where they begin.

    ``first[p]`` to ``first[p + 1]`` are the edges at code point p; an edge has a
    length, ids (several for a character spelled in bytes) and a probability given
    that a path has come to its place.
    """

    def __init__(self, codes: np.ndarray, sizes: np.ndarray, vocabulary: Vocabulary):
        v = vocabulary
        self.begin = shifted_sums(sizes)
        n = len(codes)
        left = np.repeat(self.begin[1:], sizes) - np.arange(n)
        hashes = v.hashes(codes)
        places, lengths, pieces = [], [], []
        at = np.arange(n)
        for length in range(1, v.longest + 1):
            at = at[left[at] >= length]
            if not len(at):
                break
            piece = v.find(hashes.slices(at, at + length))
            known = piece >= 0
            places.append(at[known])
            lengths.append(np.full(int(known.sum()), length))
            pieces.append(piece[known])
            if length == 1:
                lost = at[~known]
                places.append(lost)
                lengths.append(np.ones(len(lost), dtype=np.int64))
                pieces.append(np.full(len(lost), -1, dtype=np.int32))
        place, self.length, piece = (np.concatenate(x) if x else np.zeros(0, dtype=np.int64) for x in (places, lengths, pieces))
        order = np.argsort(place, kind="stable")
        place, self.length, piece = place[order], self.length[order], piece[order]
        self.first = np.searchsorted(place, np.arange(n + 1))
        score = np.where(piece >= 0, v.scores[piece], v.unknown_score)
        # Log-mass of all paths from a place to its unit's end, from the ends on.
        beta = np.zeros(n + 1)
        inside = np.append(left, 0)
        by_distance = np.argsort(left, kind="stable")
        cuts = np.searchsorted(left[by_distance], np.arange(1, int(left.max(initial=0)) + 2))
        for d in range(len(cuts) - 1):
            here = by_distance[cuts[d] : cuts[d + 1]]
            count = self.first[here + 1] - self.first[here]
            edges = ranges(self.first[here], count)
            after = np.repeat(here, count) + self.length[edges]
            # Past the end of the unit nothing is left; beta of the next unit isn't meant.
            value = score[edges] + np.where(self.length[edges] == np.repeat(inside[here], count), 0.0, beta[after])
            starts = shifted_sums(count)[:-1]
            top = np.maximum.reduceat(value, starts)
            beta[here] = top + np.log(np.add.reduceat(np.exp(value - np.repeat(top, count)), starts))
        after = place + self.length
        rest = np.where(self.length == left[place], 0.0, beta[after])
        self.log_p = score + rest - beta[place]
        self.p = np.exp(self.log_p)
        sums = np.concatenate([[0.0], np.cumsum(self.p)])
        # Cumulated within a place; the last edge of a place takes what rounding leaves.
        self.upto = sums[1:] - sums[self.first[place]]
        last = self.first[1:][self.first[1:] > self.first[:-1]] - 1
        self.upto[last] = 2.0
        self._spell(place, piece, codes, v)

    def _spell(self, place: np.ndarray, piece: np.ndarray, codes: np.ndarray, v: Vocabulary) -> None:
        lost = np.flatnonzero(piece < 0)
        spelled = {}
        for c in np.unique(codes[place[lost]]).tolist():
            ids = v.byte_ids[list(chr(c).encode())].tolist()
            spelled[c] = ids if min(ids) >= 0 else [v.unknown_id]
        self.n_ids = np.ones(len(piece), dtype=np.int64)
        self.n_ids[lost] = [len(spelled[c]) for c in codes[place[lost]].tolist()]
        self.id_at = shifted_sums(self.n_ids)[:-1]
        self.ids = np.zeros(int(self.n_ids.sum()), dtype=np.int32)
        known = piece >= 0
        self.ids[self.id_at[known]] = v.ids[piece[known]]
        if len(lost):
            self.ids[ranges(self.id_at[lost], self.n_ids[lost])] = np.concatenate([spelled[c] for c in codes[place[lost]].tolist()])

    def walk(self, units: np.ndarray, draw) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """A path for each of ``units``: (edges of all paths in order, edges of each,
        log-probability of each). ``draw(which, step)`` gives numbers in [0, 1)."""
        place, end = self.begin[units].copy(), self.begin[units + 1]
        active = np.flatnonzero(place < end)
        count, log_p = np.zeros(len(units), dtype=np.int64), np.zeros(len(units))
        steps = []
        while len(active):
            u = draw(active, len(steps))
            edge = self.first[place[active]]
            open_ = np.flatnonzero(self.upto[edge] <= u)
            while len(open_):
                edge[open_] += 1
                open_ = open_[self.upto[edge[open_]] <= u[open_]]
            steps.append((active, edge))
            count[active] += 1
            log_p[active] += self.log_p[edge]
            place[active] += self.length[edge]
            active = active[place[active] < end[active]]
        begin = shifted_sums(count)
        edges = np.zeros(int(begin[-1]), dtype=np.int64)
        for step, (which, edge) in enumerate(steps):
            edges[begin[which] + step] = edge
        return edges, count, np.minimum(log_p, 0.0)

    def walk_beside(self, unit: int, excluded: list[tuple[int, ...]], draw) -> tuple[int, ...] | None:
        """A path of ``unit`` that is none of ``excluded``, from what is left of the
        distribution; None if rounding leaves nothing. ``draw()`` as above."""
        place, end, path = int(self.begin[unit]), int(self.begin[unit + 1]), []
        while place < end:
            a, b = int(self.first[place]), int(self.first[place + 1])
            weights = self.p[a:b].copy()
            for other in excluded:
                weights[other[len(path)] - a] -= np.exp(self.log_p[list(other[len(path) :])].sum())
            sums = np.cumsum(np.maximum(weights, 0))
            if sums[-1] <= 0:
                return None
            edge = a + min(int(np.searchsorted(sums, draw() * sums[-1], side="right")), b - a - 1)
            excluded = [o for o in excluded if o[len(path)] == edge]
            path.append(edge)
            place += int(self.length[edge])
        return tuple(path) if not excluded else None
