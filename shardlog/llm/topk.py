"""Exact top-k inner products by elimination over a pivot table.

Every vector's distances to a set of pivots are computed once and written with it.
The triangle inequality bounds a query's distance to a vector from below by the
greatest difference of their pivot distances, hence their inner product from above.
Candidates are evaluated in the order of that bound, and a query is done when the
next bound is below its k-th score so far. Ties are kept, so the result is exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shardlog.llm.common import col
from shardlog.session import store

K = 5
PIVOTS = 24
SCALE = 256
# Values (not queries) of one block of queries that travels with a job.
QUERY_VALUES = 1 << 20
# Vectors that a task weighs against the queries at a time.
ROWS = 2048
# Queries whose bounds for those a task holds at a time.
QUERIES = 512
# Candidates evaluated between two looks at the next bound.
STRIDE = 64

INDEX = "id long, size int, vector array<long>, copies long, norm long, pivots array<double>"
# Products of vectors whose squared lengths stay below it are exact in doubles.
EXACT = 1 << 53


def whole_numbers(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of each component, null if one is null or not finite."""
    numbers = F.transform(vector, lambda x: x.cast("double"))
    bad = F.exists(numbers, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(vector.isNotNull() & ~F.coalesce(bad, F.lit(False)), F.transform(numbers, lambda x: F.floor(x * scale).cast("long")))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """A list column whose lists all have ``width`` entries."""
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), width)


def _by_width(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Blocks of at most ROWS vectors of one width."""
    for batch in batches:
        widths = np.asarray(batch.column("size"))
        for width in np.unique(widths).tolist():
            same = batch.filter(pa.array(widths == width))
            for i in range(0, same.num_rows, ROWS):
                yield width, same.slice(i, ROWS)


def _far_apart(vectors: np.ndarray, n: int) -> np.ndarray:
    """Up to ``n`` of the vectors, each as far as can be from those before it."""
    chosen, nearest = [0], np.full(len(vectors), np.inf)
    while len(chosen) < min(n, len(vectors)):
        nearest = np.minimum(nearest, np.linalg.norm(vectors - vectors[chosen[-1]], axis=1))
        if nearest.max() == 0:
            break
        chosen.append(int(nearest.argmax()))
    return vectors[chosen]


def choose_pivots(vectors: DataFrame, pivots: int = PIVOTS, sample: int = 2000) -> dict[int, np.ndarray]:
    """Pivots for each width of vector, from a bounded sample. Any pivots give exact
    results; the choice only decides how many candidates are passed over."""
    out = {}
    rows = vectors.orderBy(F.xxhash64("id", "vector"), "id").limit(sample).select("vector").collect()
    for width in sorted({len(r.vector) for r in rows}):
        own = np.array([r.vector for r in rows if len(r.vector) == width], dtype=np.float64).reshape(-1, width)
        out[width] = _far_apart(own, pivots)
    return out


def build_index(vectors: DataFrame, pivots: dict[int, np.ndarray]) -> DataFrame:
    """Vectors with norm and pivot distances, written to the shared folder."""

    def run(batches):
        for width, block in _by_width(batches):
            own = _matrix(block.column("vector"), width).astype(np.float64)
            points = pivots.get(width, np.zeros((1, width)))
            square = (own**2).sum(1)
            if (square >= EXACT).any():
                raise ValueError(f"the squared length of a vector of whole numbers is {square.max():.3g}: products are exact below 2^53")
            far = np.sqrt(np.maximum(square[:, None] + (points**2).sum(1)[None] - 2 * own @ points.T, 0))
            yield pa.RecordBatch.from_pydict(
                {
                    "id": block.column("id"),
                    "size": block.column("size"),
                    "vector": block.column("vector"),
                    "copies": block.column("copies"),
                    "norm": pa.array(square.astype(np.int64)),
                    "pivots": pa.array(list(far), pa.list_(pa.float64())),
                }
            )

    return store(vectors.mapInArrow(run, INDEX), "pivot-table")


class Best:
    """The k best (score, id) of each query so far, with the number of equal rows that
    each stands for: greater scores, then smaller ids."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.score = np.full((queries, k), -(1 << 62))
        self.id = np.full((queries, k), np.iinfo(np.int64).max)
        self.copies = np.zeros((queries, k), dtype=np.int64)

    def add(self, q: int, scores: np.ndarray, ids: np.ndarray, copies: np.ndarray) -> None:
        s, i, c = np.append(self.score[q], scores), np.append(self.id[q], ids), np.append(self.copies[q], copies)
        order = np.lexsort((i, -s))[: self.k]
        self.score[q], self.id[q], self.copies[q] = s[order], i[order], c[order]


def _search_block(queries: dict, width: int, block: pa.RecordBatch, best: Best) -> None:
    ids, own, far, norms = queries["id"], queries["vector"], queries["pivots"], queries["norm"]
    rows = _matrix(block.column("vector"), width).astype(np.float64)
    row_ids, row_norms, row_copies = (np.asarray(block.column(c)) for c in ("id", "norm", "copies"))
    row_far = _matrix(block.column("pivots"), far.shape[1])
    for some in range(0, len(ids), QUERIES):
        part_far = far[some : some + QUERIES]
        apart = np.zeros((len(part_far), len(rows)))
        for p in range(far.shape[1]):
            np.maximum(apart, np.abs(part_far[:, p, None] - row_far[None, :, p]), out=apart)
        # Distances carry rounding errors; a bound a little too high is still a bound.
        least = np.maximum(apart * (1 - 1e-9) - 1e-6, 0)
        bounds = (norms[some : some + QUERIES, None] + row_norms[None] - least**2) / 2 + 1e-6
        for q, bound in enumerate(bounds, start=some):
            able = np.flatnonzero((bound >= best.score[q, -1]) & (row_ids != ids[q]))
            able = able[np.argsort(-bound[able], kind="stable")]
            for i in range(0, len(able), STRIDE):
                part = able[i : i + STRIDE]
                if bound[part[0]] < best.score[q, -1]:
                    break
                best.add(q, np.rint(rows[part] @ own[q]).astype(np.int64), row_ids[part], row_copies[part])


def _search(index: DataFrame, queries: dict[int, dict], k: int) -> DataFrame:
    """The k best of each task for each query, from a block of queries by width."""
    shared = index.sparkSession.sparkContext.broadcast(queries)

    def run(batches):
        own = shared.value
        best = {width: Best(len(q["id"]), k) for width, q in own.items()}
        for width, block in _by_width(batches):
            if width in own:
                _search_block(own[width], width, block, best[width])
        for width, found in best.items():
            q, rank = np.nonzero(found.id != np.iinfo(np.int64).max)
            yield pa.RecordBatch.from_pydict(
                {
                    "query_no": pa.array(own[width]["no"][q]),
                    "query_id": pa.array(own[width]["id"][q]),
                    "vec_id": pa.array(found.id[q, rank]),
                    "score": pa.array(found.score[q, rank]),
                    "copies": pa.array(found.copies[q, rank]),
                }
            )

    return index.mapInArrow(run, "query_no long, query_id long, vec_id long, score long, copies long")


def _query_blocks(queries: DataFrame, values: int) -> Iterator[dict[int, dict]]:
    """The queries in blocks of bounded size, brought to the driver one by one."""
    held, size, no = [], 0, 0

    def packed():
        out = {}
        for width in {len(r.vector) for _, r in held}:
            own = [(n, r) for n, r in held if len(r.vector) == width]
            out[width] = {
                "no": np.array([n for n, _ in own]),
                "id": np.array([r.id for _, r in own]),
                "vector": np.array([r.vector for _, r in own], dtype=np.float64).reshape(len(own), width),
                "norm": np.array([r.norm for _, r in own]),
                "pivots": np.array([r.pivots for _, r in own]),
            }
        return out

    for row in queries.toLocalIterator():
        held.append((no, row))
        no += 1
        size += len(row.vector) + len(row.pivots)
        if size >= values:
            yield packed()
            held, size = [], 0
    if held:
        yield packed()


def top_k(
    vectors: DataFrame, is_query: Column, *, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K, pivots: int = PIVOTS, scale: int = SCALE, query_values: int = QUERY_VALUES
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` greatest integer inner products of
    each query row with all other rows, ties to the smaller id.

    ``is_query`` picks the queries by the columns of ``vectors``. Rows without an id,
    and vectors that are null or hold a null, NaN or infinity, take no part. Products
    are of vectors of one width. Rows equal in id and vector are one query, but as
    candidates each of them takes a place; rows of the query's own id are no candidates
    for it. A query without candidates has no rows. A vector whose squared length, in
    whole numbers, is 2^53 or more is refused, as its products would not be exact.

    A block of queries at a time meets all rows of the index: every task keeps its k
    best for each query, and these few are ranked at the end.
    """
    rows = (
        vectors.select(
            col(id_col).cast("long").alias("id"),
            whole_numbers(col(vector_col), scale).alias("vector"),
            F.coalesce(is_query, F.lit(False)).alias("query"),
        )
        .where("id is not null and vector is not null")
        .groupBy("id", "vector")
        .agg(F.max("query").alias("query"), F.count("*").alias("copies"))
    )
    rows = store(rows.select("id", F.size("vector").alias("size"), "vector", "query", "copies"), "vectors")
    points = choose_pivots(rows, pivots)
    index = build_index(rows.select("id", "size", "vector", "copies"), points)
    asked = index.join(rows.where("query").select("id", "vector"), ["id", "vector"])
    found = None
    for block in _query_blocks(asked, query_values):
        part = _search(index, block, k)
        # Each pass is written down, so that a long line of blocks is no long plan.
        part = store(part, "candidates")
        found = part if found is None else found.unionAll(part)
    if found is None:
        found = vectors.sparkSession.createDataFrame([], "query_no long, query_id long, vec_id long, score long, copies long")
    order = W.partitionBy("query_no").orderBy(F.desc("score"), "vec_id")
    # Of equal rows no more than k can have a place.
    each = found.withColumn("copy", F.explode(F.sequence(F.lit(1), F.least("copies", F.lit(k)).cast("int"))))
    ranked = each.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
