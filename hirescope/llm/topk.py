"""Exact top-k search by inner product: columnar branch-and-bound.

Vectors are stored vertically, a run of dimensions after the other. For a
block of queries against a block of vectors the inner products are
accumulated run by run; after each run the remaining mass (the product of the
norms of what is left) bounds every final score from both sides. Vectors whose
upper bound is below the k-th best lower bound, or the k-th best score so far,
of every query in the block are compacted away before the next run.

Queries meet vectors on a grid: vectors are dealt to ``g`` columns, queries to
``h`` rows, and each cell is one group of bounded size. No shuffle by a vector's
value takes place, so equal vectors cannot pile up anywhere.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_batches, ship, stored

ship(__name__)

BLOCK = 2048  # vectors
RUN = 16  # dimensions
COLUMN_BYTES = 32 << 20  # of vectors in a cell
ROW_BYTES = 4 << 20  # of queries in a cell


def integer_vectors(rows: DataFrame, scale: int = 64) -> DataFrame:
    """vec_id and vec (array of double): floor(scale * x) of every component.
    Vectors that are null or hold a null or non-finite component, and rows
    without a vec_id, are left out."""
    finite = "vec_id is not null and embedding is not null and forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))"
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("double"))
    return rows.where(finite).select(F.col("vec_id").cast("long").alias("vec_id"), whole.alias("vec"))


def suffix_norms(x: np.ndarray, run: int) -> np.ndarray:
    """Norms of what is left of each column of ``x`` after each run."""
    squares = np.array([(x[at:at + run] ** 2).sum(axis=0) for at in range(0, len(x), run)])
    left = np.cumsum(squares[::-1], axis=0)[::-1]
    return np.sqrt(np.vstack([left[1:], np.zeros((1, x.shape[1]))]))


def bounded_scores(q: np.ndarray, x: np.ndarray, k: int, floor: np.ndarray, run: int = RUN) -> tuple[np.ndarray, np.ndarray]:
    """Columns of ``x`` (dims, n) that may be among a query's ``k`` best, and
    their scores against the queries ``q`` (dims, m). ``floor``: scores that a
    query has ``k`` times already."""
    alive = np.arange(x.shape[1])
    part = np.zeros((q.shape[1], x.shape[1]))
    if not len(x):
        return alive, part
    qn, xn = suffix_norms(q, run), suffix_norms(x, run)
    for b, at in enumerate(range(0, len(x), run)):
        part += q[at:at + run].T @ x[at:at + run]
        if at + run >= len(x):
            break
        rest = qn[b][:, None] * xn[b][alive][None, :]
        least = floor
        if len(alive) > k:
            low = part - rest
            least = np.maximum(least, np.partition(low, len(alive) - k, axis=1)[:, len(alive) - k])
        keep = ((part + rest) * (1 + 1e-12) + 1e-6 >= least[:, None]).any(axis=0)
        if not keep.all():
            alive, part, x = alive[keep], part[:, keep], x[:, keep]
    return alive, part


class Best:
    """The k best (score, vec_id) of each query so far."""

    def __init__(self, ids: np.ndarray, k: int):
        self.ids, self.k = ids, k
        self.score = np.full((len(ids), 0), -np.inf)
        self.vec = np.zeros((len(ids), 0), dtype=np.int64)

    def floor(self) -> np.ndarray:
        return self.score[:, -1] if self.score.shape[1] == self.k else np.full(len(self.ids), -np.inf)

    def add(self, scores: np.ndarray, vecs: np.ndarray) -> None:
        own = vecs[None, :] == self.ids[:, None]
        scores = np.where(own, -np.inf, scores)
        if scores.shape[1] > 4 * self.k:
            # thin: what is below the k-th best cannot stay (ties may)
            least = np.partition(scores, scores.shape[1] - self.k, axis=1)[:, scores.shape[1] - self.k]
            cols = (scores >= np.maximum(least, self.floor())[:, None]).any(axis=0)
            scores, vecs = scores[:, cols], vecs[cols]
        score = np.hstack([self.score, scores])
        vec = np.hstack([self.vec, np.broadcast_to(vecs, scores.shape)])
        order = np.lexsort((vec, -score), axis=1)[:, :self.k]
        self.score, self.vec = np.take_along_axis(score, order, 1), np.take_along_axis(vec, order, 1)


def _packed(vectors: DataFrame, name: str) -> DataFrame:
    """Blocks of vectors of one length: ids and a vertical matrix. Rows are
    packed where they are read, without a shuffle."""

    def pack(batches):
        held: dict[int, list] = {}
        for pdf in batches:
            for i, v in zip(pdf["vec_id"], pdf["vec"]):
                block = held.setdefault(len(v), [])
                block.append((i, v))
                if len(block) == BLOCK:
                    yield _block(len(v), held.pop(len(v)))
        for dims, block in held.items():
            yield _block(dims, block)

    return stored(vectors.mapInPandas(pack, "dims int, n int, tag long, ids binary, data binary"), name)


def _block(dims: int, block: list) -> pd.DataFrame:
    ids = np.array([i for i, _ in block], dtype=np.int64)
    data = np.array([v for _, v in block], dtype=np.float64).reshape(len(block), dims).T
    return pd.DataFrame([(dims, len(block), int(ids[0]) * 1_000_003 + len(block) & 0x7FFFFFFF, ids.tobytes(), np.ascontiguousarray(data).tobytes())],
                        columns=["dims", "n", "tag", "ids", "data"])


def _open(row) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(row.ids, dtype=np.int64), np.frombuffer(row.data, dtype=np.float64).reshape(row.dims, row.n)


def _cell(k: int):
    def search(queries: pd.DataFrame, vectors: pd.DataFrame) -> pd.DataFrame:
        out = []
        blocks = [_open(v) for v in vectors.itertuples()]
        for row in queries.itertuples():
            qids, q = _open(row)
            for at in range(0, len(qids), 256):
                best = Best(qids[at:at + 256], k)
                some = q[:, at:at + 256]
                for ids, x in blocks:
                    # one more than k: the query's own row may be among them
                    alive, scores = bounded_scores(some, x, k + 1, best.floor())
                    best.add(scores, ids[alive])
                real = np.isfinite(best.score)
                out.append(pd.DataFrame({"query_id": np.repeat(best.ids, real.sum(axis=1)), "vec_id": best.vec[real], "score": best.score[real].astype(np.int64)}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")

    return search


def exact_top_k(rows: DataFrame, every: int = 20, k: int = 20) -> DataFrame:
    """query_id, rank, vec_id, score: for each vec_id that is divisible by
    ``every`` the ``k`` rows of other ids with the highest integer inner product,
    ties to the smaller vec_id.

    Vectors are compared with those of their own length. A query id has one
    list: if rows repeat it, the products with all of its vectors are ranked
    together. Other rows that repeat a vec_id are listed as often as they occur. Scores are exact up to 2^53. Empty input, or a query
    without others, gives no rows.
    """
    spark = rows.sparkSession
    arrow_batches(spark, rows=4096)
    vectors = integer_vectors(rows)
    blocks = _packed(vectors, "vec-blocks")
    queries = _packed(vectors.where(f"vec_id % {every} = 0"), "query-blocks")
    size, n = blocks.agg(F.sum(F.length("data")), F.count("*")).first()
    q_size, q_n = queries.agg(F.sum(F.length("data")), F.count("*")).first()
    slots = spark.sparkContext.defaultParallelism
    g = max(1, math.ceil((size or 0) / COLUMN_BYTES), min(n, 2 * slots))
    h = max(1, math.ceil((q_size or 0) / ROW_BYTES))
    tag = F.pmod(F.xxhash64("tag", "ids"), F.lit(1 << 30))
    left = queries.withColumn("h", tag % h).withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(g - 1)).cast("array<long>"))).drop("tag")
    right = blocks.withColumn("g", tag % g).withColumn("h", F.explode(F.sequence(F.lit(0), F.lit(h - 1)).cast("array<long>"))).drop("tag")
    found = left.groupBy("dims", "g", "h").cogroup(right.groupBy("dims", "g", "h")).applyInPandas(
        _cell(k), "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
