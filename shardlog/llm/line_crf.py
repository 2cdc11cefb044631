"""Document quality from a linear-chain conditional random field over lines.

Every line is good or bad. Its features and its neighbours' give it a score for each
label, and adjacent labels have a score of their own. Forward and backward sums give
each line's marginal probability of being good; a document's quality is their mean,
weighted by the lines' lengths.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shardlog.llm.common import byte_blocks, extended, map_blocks, narrow, shifted_sums, texts_of, widen
from shardlog.llm.line_features import NAMES, line_features, split_lines, with_neighbours
from shardlog.session import store

BLOCK_BYTES = 2 << 20
# Labelled documents of each label that a model is fitted on: those whose ids hash lowest.
SAMPLE = 1500
STEPS = 120
RIDGE = 1e-3


@dataclass
class Model:
    """``weights``: (observations, 2), for the labels bad and good; ``moves``: (2, 2)."""

    weights: np.ndarray
    moves: np.ndarray


def marginals(emit: np.ndarray, moves: np.ndarray, lines: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of chains laid end to end: log forward and backward sums, and log Z by chain.

    All chains take a step at once, the longest first in order, so that the chains
    still running are a prefix.
    """
    order = np.argsort(-lines, kind="stable")
    begins = shifted_sums(lines)[:-1][order]
    sizes = lines[order]
    alpha, beta = emit.copy(), np.zeros_like(emit)
    running = np.searchsorted(-sizes, -np.arange(1, int(sizes.max(initial=0)) + 1), side="right")
    for t in range(1, len(running)):
        at = begins[: running[t]] + t
        prev = alpha[at - 1]
        alpha[at] += np.logaddexp(prev[:, :1] + moves[0], prev[:, 1:] + moves[1])
    for t in range(len(running) - 2, -1, -1):
        at = begins[: running[t + 1]] + t
        after = emit[at + 1] + beta[at + 1]
        beta[at] = np.logaddexp(moves[:, 0] + after[:, :1], moves[:, 1] + after[:, 1:])
    z = np.zeros(len(lines))
    ends = begins + sizes - 1
    z[order] = np.logaddexp(alpha[ends, 0], alpha[ends, 1])
    return alpha, beta, z


def slopes(observed: np.ndarray, lines: np.ndarray, y: np.ndarray, weight: np.ndarray, weights: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """How the conditional log likelihood of whole documents grows with each of
    ``weights`` and ``moves``: every line of a document has the document's label ``y``,
    and all lines of a document together have its ``weight``."""
    chain = np.repeat(np.arange(len(lines)), lines)
    label, by_line = y[chain], (weight / np.maximum(lines, 1))[chain]
    here = np.flatnonzero(chain[1:] == chain[:-1])
    emit = observed @ weights
    alpha, beta, z = marginals(emit, moves, lines)
    off = -np.exp(alpha + beta - z[chain][:, None])
    off[np.arange(len(off)), label] += 1
    grad_w = observed.T @ (off * by_line[:, None])
    pair = alpha[here][:, :, None] + moves[None] + (emit[here + 1] + beta[here + 1])[:, None, :] - z[chain[here]][:, None, None]
    grad_m = -(np.exp(pair) * by_line[here][:, None, None]).sum(0)
    for each in (0, 1):
        grad_m[each, each] += by_line[here][label[here] == each].sum()
    return np.concatenate([grad_w.ravel(), grad_m.ravel()])


def fit(width: int, slope: Callable[[Model], np.ndarray], steps: int = STEPS, ridge: float = RIDGE) -> Model:
    """Weights of the greatest conditional likelihood, by Adam steps on the whole
    sample: ``slope`` gives the slopes of a model, per unit of the sample's weight."""
    parameters = np.zeros(2 * width + 4)
    first, second = np.zeros_like(parameters), np.zeros_like(parameters)
    model = Model(parameters[: 2 * width].reshape(width, 2), parameters[2 * width :].reshape(2, 2))
    for step in range(1, steps + 1):
        grad = slope(model) - ridge * parameters
        first = 0.9 * first + 0.1 * grad
        second = 0.99 * second + 0.01 * grad**2
        parameters += 0.2 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return model


def quality(texts: list[bytes], model: Model) -> tuple[np.ndarray, np.ndarray]:
    """For each text the length-weighted mean of its lines' marginals of being good,
    and how many of its lines are labelled bad."""
    data, ends, lines = split_lines(texts)
    emit = with_neighbours(line_features(data, ends), lines) @ model.weights
    alpha, beta, z = marginals(emit, model.moves, lines)
    chain = np.repeat(np.arange(len(lines)), lines)
    good = np.exp(alpha[:, 1] + beta[:, 1] - z[chain])
    size = ends - np.append(0, ends[:-1] + 1) + 1
    mean = np.bincount(chain, weights=good * size, minlength=len(lines)) / np.bincount(chain, weights=size, minlength=len(lines))
    return np.clip(mean, 0, 1), np.bincount(chain[good < 0.5], minlength=len(lines))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = SAMPLE) -> Model | None:
    """A model of at most ``sample`` labelled documents of each label, that aren't
    held out. Rows without an id, text or label 0 or 1 are no examples; an id with
    contradicting labels isn't one either. All lines of a document count. None if a
    label has no example."""
    marked = narrow(labels, id=id_col, label=label_col).where("id is not null and label in (0, 1)").where(~held_out(F.col("id")))
    each = marked.groupBy("id").agg(F.min("label").alias("label"), F.max("label").alias("most")).where("label = most")
    rank = F.xxhash64("id", F.lit(8))
    picked = None
    for label in (0, 1):
        # A bounded sample: ids of a few thousand labelled rows, by hash.
        some = each.where(F.col("label") == label).select("id", F.col("label").cast("int").alias("label")).orderBy(rank, "id").limit(sample)
        picked = some if picked is None else picked.unionAll(some)
    texts = narrow(docs, id=id_col, text=text_col).where("text is not null")
    rows = texts.join(F.broadcast(picked), "id")
    examples = map_blocks(rows, "text", BLOCK_BYTES, extended(rows, "features binary", without=("text",)), _example_block)
    # Repeated ids give one example. The lines stay with the executors: every step reads them again.
    kept = store(examples.groupBy("id").agg(F.min(F.struct("features", "label")).alias("x")).select("x.*"), "examples")
    share = {r.label: r["count"] for r in kept.groupBy("label").count().collect()}
    if len(share) < 2:
        return None
    # Both labels weigh the same, however rare one is.
    weight = np.array([0.5 / share[0], 0.5 / share[1]])

    def slope(model: Model) -> np.ndarray:
        # A row of sums per task, added up without regard to the order they come in.
        sums = kept.mapInArrow(lambda batches: _slope_sums(batches, model, weight), "sums array<double>").collect()
        return np.array([math.fsum(x) for x in zip(*(r.sums for r in sums))])

    return fit(3 * len(NAMES) + 3, slope)


def _example_block(block: pa.RecordBatch) -> pa.RecordBatch:
    """The features of all lines of each text."""
    data, ends, lines = split_lines(texts_of(block))
    features = line_features(data, ends).astype(np.float32)
    begins = shifted_sums(lines)
    out = {name: block.column(name) for name in block.schema.names if name != "text"}
    out["features"] = pa.array([features[b:e].tobytes() for b, e in zip(begins[:-1].tolist(), begins[1:].tolist())], pa.binary())
    return pa.RecordBatch.from_pydict(out)


def _slope_sums(batches: Iterator[pa.RecordBatch], model: Model, weight: np.ndarray) -> Iterator[pa.RecordBatch]:
    """One row with the slopes of all documents of a task; ``weight`` is by label."""
    total = None
    for block in byte_blocks(batches, "features", BLOCK_BYTES):
        each = [np.frombuffer(f, dtype=np.float32).reshape(-1, len(NAMES)) for f in block.column("features").to_pylist()]
        lines = np.array([len(e) for e in each], dtype=np.int64)
        y = np.asarray(block.column("label"), dtype=np.int64)
        found = slopes(with_neighbours(np.concatenate(each).astype(np.float64), lines), lines, y, weight[y], model.weights, model.moves)
        total = found if total is None else total + found
    if total is not None:
        yield pa.RecordBatch.from_pydict({"sums": pa.array([total.tolist()], pa.list_(pa.float64()))})


def _score_block(block: pa.RecordBatch, model: Model | None) -> pa.RecordBatch:
    texts = texts_of(block)
    scores, bad = quality(texts, model) if model else (np.full(len(texts), 0.5), np.zeros(len(texts), dtype=np.int64))
    out = {name: block.column(name) for name in block.schema.names if name != "text"}
    out["score"], out["bad_lines"] = pa.array(scores), pa.array(bad)
    return pa.RecordBatch.from_pydict(out)


def score(docs: DataFrame, model: Model | None, *, id_col: str = "doc_id", text_col: str = "text", carry: bool = False) -> DataFrame:
    """(id, score, bad_lines) per row of ``docs``, with the input row in ``_row`` if ``carry``.

    The score sees the text alone. Null and empty texts are one empty line and have
    its score. Equal texts have equal scores. Without a model all scores are 0.5.
    """
    rows = narrow(docs, carry, id=id_col, text=text_col)
    return map_blocks(rows, "text", BLOCK_BYTES, extended(rows, "score double, bad_lines long", without=("text",)), lambda b: _score_block(b, model))


def keep_good(docs: DataFrame, model: Model | None, **options) -> DataFrame:
    """The rows of ``docs`` that score 0.5 or more, with their columns as they were."""
    return widen(score(docs, model, carry=True, **options).where("score >= 0.5"))
