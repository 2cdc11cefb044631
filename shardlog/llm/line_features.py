"""Numbers about every line of many texts at once."""

from __future__ import annotations

import numpy as np

from shardlog.llm.common import shifted_sums
from shardlog.llm.polyhash import PrefixHashes

_BYTES = np.arange(256)
_DIGIT = (_BYTES >= 0x30) & (_BYTES <= 0x39)
_UPPER = (_BYTES >= 0x41) & (_BYTES <= 0x5A)
_LETTER = _UPPER | ((_BYTES >= 0x61) & (_BYTES <= 0x7A)) | (_BYTES >= 0x80)
_BLANK = np.isin(_BYTES, [0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D])
_STOP = np.isin(_BYTES, list(b".!?,;:"))
_SIGN = ~(_DIGIT | _LETTER | _BLANK | _STOP)

NAMES = (
    "length", "letters", "digits", "upper", "stops", "signs", "words", "word_length", "short_words", "repeats", "adjacent", "loose_signs", "ends_sentence", "blank"
)


def split_lines(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(all bytes, ends of the lines, lines of each text): every line ends in a line
    feed, also a text's last; an empty text is one empty line."""
    data = np.frombuffer(b"".join(t + b"\n" for t in texts), dtype=np.uint8)
    ends = np.flatnonzero(data == 0x0A)
    stops = np.cumsum(np.array([len(t) + 1 for t in texts], dtype=np.int64)) - 1
    return data, ends, np.diff(np.append(-1, np.searchsorted(ends, stops)))


def line_features(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A row of NAMES for each line; shares lie between 0 and 1."""
    n = len(ends)
    starts = np.append(0, ends[:-1] + 1)
    size = ends - starts

    def count(kind: np.ndarray) -> np.ndarray:
        sums = shifted_sums(kind[data])
        return (sums[ends] - sums[starts]).astype(np.float64)

    blank = _BLANK[data]
    before = np.append(True, blank[:-1])
    begin = np.flatnonzero(~blank & before)
    stop = np.flatnonzero(blank & ~before)
    line = np.searchsorted(ends, begin)
    words = np.bincount(line, minlength=n).astype(np.float64)
    hashes = PrefixHashes(data).slices(begin, stop)
    # Words that the same line had before: all but one of each (line, word).
    order = np.lexsort((hashes, line))
    same = np.zeros(len(line), dtype=bool)
    same[1:] = (hashes[order][1:] == hashes[order][:-1]) & (line[order][1:] == line[order][:-1])
    repeats = np.bincount(line[order][same], minlength=n)
    next_to = np.zeros(len(line), dtype=bool)
    next_to[1:] = (hashes[1:] == hashes[:-1]) & (line[1:] == line[:-1])
    word_size = stop - begin
    has_sign = np.add.reduceat(_SIGN[data].astype(np.int64), begin) > 0 if len(begin) else np.zeros(0, bool)
    last = np.where(size > 0, data[np.maximum(ends - 1, 0)], 0x20)
    per_byte, per_word = np.maximum(size, 1), np.maximum(words, 1)
    out = np.empty((n, len(NAMES)))
    out[:, 0] = np.log1p(size) / 8
    for i, kind in enumerate((_LETTER, _DIGIT, _UPPER, _STOP, _SIGN), start=1):
        out[:, i] = count(kind) / per_byte
    out[:, 6] = np.log1p(words) / 6
    out[:, 7] = np.minimum(np.bincount(line, weights=word_size, minlength=n) / per_word / 16, 2)
    out[:, 8] = np.bincount(line[word_size <= 3], minlength=n) / per_word
    out[:, 9] = repeats / per_word
    out[:, 10] = np.bincount(line[next_to], minlength=n) / per_word
    out[:, 11] = np.bincount(line[has_sign], minlength=n) / per_word
    out[:, 12] = np.isin(last, list(b".!?"))
    out[:, 13] = words == 0
    return out


def with_neighbours(features: np.ndarray, lines: np.ndarray) -> np.ndarray:
    """Each line's own features, those of the line before and after it (zeros beyond
    the text), and whether there is one: the observations of the chain."""
    n, width = features.shape
    first = np.zeros(n, dtype=bool)
    begins = shifted_sums(lines)[:-1]
    first[begins] = True
    final = np.append(first[1:], True)
    out = np.zeros((n, 3 * width + 3))
    out[:, :width] = features
    out[1:, width : 2 * width] = features[:-1]
    out[first, width : 2 * width] = 0
    out[:-1, 2 * width : 3 * width] = features[1:]
    out[final, 2 * width : 3 * width] = 0
    out[:, -3], out[:, -2], out[:, -1] = first, final, 1
    return out
