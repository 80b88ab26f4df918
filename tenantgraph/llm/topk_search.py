"""Exact top-k search by integer inner product with pivot-table elimination.

Each vector carries a row of the pivot table: its distances to `n_pivots` pivots. For a query q and a candidate x every pivot p
gives |d(q, p) - d(x, p)| <= d(q, x); the largest of these lower bounds the distance, and with |q - x|^2 = |q|^2 + |x|^2 - 2 q.x
bounds the score from above. Candidates are evaluated in the order of that bound, in growing chunks, until the k-th best score
so far is above the bound of all that are left; equal scores are still evaluated, so ties are exact.

Candidates lie by their nearest pivot, in cells of about `cell_rows`; a larger neighbourhood is cut into several. They are
shuffled once, for that. Queries come to them in blocks of about `block_rows`, each handed to all tasks: a block is bounded, and
the sample that it is first compared with as well. That sample's k-th best score is a threshold that the true k-th best
reaches, so a task passes over a whole cell whose least and largest distances to a pivot bound all its scores below the
threshold, hands on only what reaches it, and raises it as it goes from cell to cell. Pivots and sample are the vectors whose
ids hash lowest, `sample_rows` of them; they steer the order of evaluation and what is passed over, never the result.

Scores are exact integers whatever the components: products in doubles where a bound shows that they stay below 2**53, else in
64-bit integers, else in Python's.

Defined results: vectors that are null or hold a null or non-finite component take no part, nor do rows without an id. A row is
its id: rows that share one aren't candidates of each other, repeated candidates each count, repeated queries are one query
(with the smallest of their vectors). Vectors of different lengths are compared over the components both have. No query or no
candidate gives no rows. A score outside 64 bits ranks by its exact value and is returned as the nearest 64-bit number. Other
columns, whatever their names, are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tenantgraph.llm.shared import named, stash

SCALE = 1024
_EXACT, _FINITE = 2.0**53, 1.7e308
_LEAST, _MOST = -(2**63), 2**63 - 1


def matrix(vectors: pa.Array, width: int) -> np.ndarray:
    """Vectors as rows, filled up with zeros."""
    sizes = pa.compute.list_value_length(vectors).to_numpy(zero_copy_only=False)
    values = vectors.flatten().to_numpy(zero_copy_only=False).astype(float, copy=False)
    if (sizes == width).all():
        return values.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width))
    out[np.arange(width) < sizes[:, None]] = values
    return out


def integers(x: np.ndarray) -> np.ndarray:
    """floor(1024 x): doubles where all of them hold it exactly as a small integer, else Python's integers."""
    with np.errstate(over="ignore"):
        out = np.floor(x * SCALE)
    if not out.size or np.abs(out).max() < _EXACT:
        return out
    return np.array([int(a) if math.isfinite(a) else int(b) * SCALE for a, b in zip(out.ravel().tolist(), x.ravel().tolist(), strict=True)], object).reshape(x.shape)


def products(v: np.ndarray, q: np.ndarray, most: float) -> np.ndarray:
    """Exact inner products of the rows of v with q, as 64-bit integers or, where those may not do, as Python's. most: what none exceeds."""
    if v.dtype != object and q.dtype != object:
        if most < _EXACT:
            return (v @ q).astype(np.int64)
        if most < 2.0**62:
            return v.astype(np.int64) @ q.astype(np.int64)
    whole = [x if x.dtype == object else np.vectorize(int, otypes=[object])(x) if x.size else x.astype(object) for x in (v, q)]
    return whole[0] @ whole[1]


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to the smaller id."""
    if scores.dtype == object:
        return np.array(sorted(range(len(scores)), key=lambda i: (-scores[i], ids[i]))[:k], np.int64)
    high = np.arange(len(scores))
    if len(scores) > 8 * k:
        high = np.flatnonzero(scores >= np.partition(scores, -k)[-k])
    return high[np.lexsort((ids[high], ~scores[high]))[:k]]


class Side:
    """Vectors with what bounds need: distances to the pivots, squared length."""

    def __init__(self, x: np.ndarray, ids: np.ndarray, pivots: np.ndarray, distances: np.ndarray | None = None):
        self.v, self.ids = integers(x), ids
        with np.errstate(over="ignore", invalid="ignore"):
            rough = self.v if self.v.dtype != object else np.floor(x * SCALE)
            self.most = np.abs(rough).max(axis=1, initial=0)
            self.norm = (rough * rough).sum(axis=1)
            self.d = table(rough, pivots) if distances is None else distances


def table(v: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore", invalid="ignore"):
        return np.stack([np.sqrt(((v - p) ** 2).sum(axis=1)) for p in pivots], axis=1) if len(pivots) else np.zeros((len(v), 0))


def spread(x: np.ndarray, n: int) -> np.ndarray:
    """n rows of x (fewer, if it has no more that differ), each the farthest from those before."""
    if not len(x):
        return x
    at, far = [0], np.full(len(x), np.inf)
    with np.errstate(over="ignore", invalid="ignore"):
        while len(at) < n:
            far = np.minimum(far, ((x - x[at[-1]]) ** 2).sum(axis=1))
            if not (i := int(np.nan_to_num(far, nan=0.0).argmax())) or far[i] <= 0:
                break
            at.append(i)
    return x[at]


def sound(apart: np.ndarray) -> np.ndarray:
    """Lower bounds of distances, without those whose squares don't fit a double."""
    return np.where((apart > 0) & (apart < 1e150), apart, 0.0)


class Block:
    """A block of queries, their thresholds, and how many candidates were evaluated."""

    def __init__(self, queries: Side, k: int, most: float):
        self.q, self.k, self.most = queries, k, most  # most: the largest squared length of a pivot
        self.least: list = [None] * len(queries.ids)  # a score that the k-th best reaches
        self.evaluated = 0

    def bounds(self, i: np.ndarray | int, norm: np.ndarray, apart: np.ndarray) -> np.ndarray:
        """Upper bounds of scores, from squared lengths and lower bounds of distances. Distances are rounded, scores aren't."""
        with np.errstate(over="ignore", invalid="ignore"):
            own = self.q.norm[i]
            slack = 1e-9 * (own + norm + self.most) + 1
            by_pivots = (own + norm - apart * apart) / 2 + slack
            by_lengths = np.sqrt(own) * np.sqrt(norm) * (1 + 1e-9) + 1
            return np.nan_to_num(np.fmin(by_pivots, by_lengths), nan=np.inf, posinf=np.inf, neginf=-np.inf)

    def search(self, cell: Side) -> list[tuple[int, np.ndarray, np.ndarray]]:
        """(query's place, ids, scores) of the k best of the cell among those that reach the threshold, which is raised."""
        if not len(cell.ids):
            return []
        low, high, norm = cell.d.min(axis=0), cell.d.max(axis=0), cell.norm.max()
        with np.errstate(invalid="ignore"):
            apart = sound(np.maximum(low - self.q.d, self.q.d - high)).max(axis=1, initial=0)
        ceiling = self.bounds(np.arange(len(self.q.ids)), norm, apart)
        alive = np.flatnonzero([t is None or c >= t for c, t in zip(ceiling.tolist(), self.least, strict=True)])
        by_pivot = np.ascontiguousarray(cell.d.T)
        found = []
        for at in range(0, len(alive), 32):
            some = alive[at : at + 32]
            apart, gap = np.zeros((len(some), len(cell.ids))), np.empty((len(some), len(cell.ids)))
            with np.errstate(invalid="ignore"):
                for p, d in enumerate(by_pivot):
                    np.subtract(d, self.q.d[some, p][:, None], out=gap)
                    np.fmax(apart, np.abs(gap, out=gap), out=apart)
            apart = sound(apart)
            bound = self.bounds(some[:, None], cell.norm, apart)
            bound[cell.ids == self.q.ids[some][:, None]] = -np.inf
            found += [(i, *x) for i, b in zip(some.tolist(), bound, strict=True) if len((x := self.in_order(i, cell, b))[0])]
        return found

    def in_order(self, i: int, cell: Side, bound: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the i-th query's k best of a cell: bands of falling bounds, until none left reaches the threshold."""
        left = np.flatnonzero(bound > -np.inf)
        ids, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        step, most = max(4 * self.k, 64), float(self.q.most[i] * cell.most.max() * cell.v.shape[1])
        while True:
            if self.least[i] is not None:
                left = left[bound[left] >= max(min(self.least[i], _FINITE), -_FINITE)]
            if not len(left):
                break
            high = np.argpartition(-bound[left], step) if len(left) > step else np.arange(len(left))
            part, left = left[high[:step]], left[high[step:]]
            few = 4 * len(part) < len(cell.ids)  # to gather many rows takes longer than to multiply all
            own = products(cell.v[part], self.q.v[i], most) if few else products(cell.v, self.q.v[i], most)[part]
            scores, ids = np.concatenate([scores, own]), np.concatenate([ids, cell.ids[part]])
            top = best(scores, ids, self.k)
            ids, scores = ids[top], scores[top]
            if len(ids) == self.k and (self.least[i] is None or scores[-1] > self.least[i]):
                self.least[i] = int(scores[-1])
            step *= 16
            self.evaluated += len(part)
        reach = slice(None) if self.least[i] is None else np.array([s >= self.least[i] for s in scores.tolist()], bool)
        return ids[reach], scores[reach]


def ordered_key(score: int) -> str | None:
    """For scores at or beyond the ends of 64 bits: text that sorts as they do."""
    return f"{score + (1 << 2400):0610x}" if score <= _LEAST or score >= _MOST else None


def exact_topk(
    vectors: DataFrame, *, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 10, n_pivots: int = 32, sample_rows: int = 1024, cell_rows: int = 4096, block_rows: int = 8192
) -> DataFrame:
    """(query_id, rank, id, score): each query's k best rows other than itself."""
    v = F.transform(named(vector_col), lambda x: x.cast("double"))
    whole = v.isNotNull() & F.forall(v, lambda x: F.coalesce(F.abs(x) <= 1.7976931348623157e308, F.lit(False))) & named(id_col).isNotNull()
    rows = vectors.where(whole).select(named(id_col).cast("long").alias("id"), v.alias("v"), F.coalesce(is_query, F.lit(False)).alias("q"))
    rows = stash(rows.withColumn("n", F.monotonically_increasing_id()), "topk-rows")
    spark = rows.sparkSession
    width, n_queries = rows.agg(F.max(F.size("v")), F.count_if("q")).first()
    result = f"query_id long, rank int, `{id_col.replace('`', '``')}` long, score long"
    if not n_queries:
        return spark.createDataFrame([], result)
    width = max(1, width)
    held = rows.orderBy(F.xxhash64("id"), "id", "v").limit(sample_rows).select("id", "v").toArrow()
    sample, sample_ids = matrix(held["v"].combine_chunks(), width), held["id"].to_numpy()
    with np.errstate(over="ignore"):
        pivots = spread(np.nan_to_num(np.floor(sample * SCALE)), n_pivots)
        most = float((pivots * pivots).sum(axis=1).max(initial=0))

    def pivoted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            side = Side(matrix(batch.column(1), width), batch.column(0).to_numpy(), pivots)
            cell = np.nan_to_num(side.d, nan=np.inf).argmin(axis=1) if len(side.ids) else np.zeros(0, np.int64)
            d = pa.FixedSizeListArray.from_arrays(pa.array(side.d.ravel()), len(pivots)).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*batch.columns, d, pa.array(cell, pa.int32())], ["id", "v", "n", "d", "cell"])

    candidates = stash(rows.select("id", "v", "n").mapInArrow(pivoted, "id long, v array<double>, n long, d array<double>, cell int"), "topk-pivoted")
    parts = {r["cell"]: -(-r["count"] // cell_rows) for r in candidates.groupBy("cell").count().collect()}  # a row for each pivot at most
    cut = F.create_map(*[F.lit(x) for c, n in parts.items() for x in (c, n)])
    dealt = candidates.withColumn("part", F.pmod(F.xxhash64("n"), cut[F.col("cell")]))
    dealt = stash(dealt.repartition("cell", "part").sortWithinPartitions("cell", "part").select("cell", "part", "id", "v", "d"), "topk-cells")

    def compare(block: Block):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                cell, part = (batch.column(i).to_numpy() for i in (0, 1))
                ends = np.flatnonzero(np.r_[True, (cell[1:] != cell[:-1]) | (part[1:] != part[:-1]), True])
                for a, b in zip(ends[:-1], ends[1:], strict=True):
                    own = batch.slice(a, b - a)
                    side = Side(matrix(own.column(3), width), own.column(2).to_numpy(), pivots, matrix(own.column(4), len(pivots)))
                    if found := block.search(side):
                        scores = [int(s) for _, _, x in found for s in x]
                        columns = [np.repeat(block.q.ids[[i for i, _, _ in found]], [len(x) for _, x, _ in found]), np.concatenate([x for _, x, _ in found]), [min(max(s, _LEAST), _MOST) for s in scores]]
                        yield pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in columns], pa.array([ordered_key(s) for s in scores], pa.string())], ["query_id", "id", "score", "key"])

        return run

    queries = rows.where("q").groupBy("id").agg(F.min("v").alias("v"))
    blocks = -(-n_queries // block_rows)
    queries = stash(queries.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks))), "topk-queries")
    found = None
    for b in range(blocks):
        asked = queries.where(F.col("block") == b).select("id", "v").orderBy("id").toArrow()  # about block_rows
        if not len(asked):
            continue
        block = Block(Side(matrix(asked["v"].combine_chunks(), width), asked["id"].to_numpy(), pivots), k, most)
        block.search(Side(sample, sample_ids, pivots))  # for the thresholds
        own = dealt.mapInArrow(compare(block), "query_id long, id long, score long, key string")
        own = stash(own, "topk-found") if blocks > 1 else own
        found = own if found is None else found.unionByName(own)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), F.desc("key"), "id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", F.col("id").alias(id_col), "score")
