"""Exact top-k inner products by an impact-ordered index, read score at a time.

Vectors become integers, floor(scale * x). They are dealt into blocks of about
``BLOCK`` rows by a hash of their id. For each dimension, a block's index lists
the rows by falling impact, the size of the value, cut into segments of equal
quantised impact. The queries of a block read the segments together, in rounds
from the highest impact down; a round ends once three quarters of the squares
that were left are read. What a row has not been read for is at most the
query's norm times the norm of the row's unread values (Cauchy and Schwarz), so
its sum plus that bounds its score. The exact scores of rows with large sums
give a score that k rows reach, as do the k-th scores of blocks searched
before; rows whose bound is below it are out by proof. As soon as few possible
members are left, a query stops, those are scored exactly, and ties go to the
smaller id. The k best of each block meet in one last ranking.

Queries travel in blocks as well, and each pair of blocks is a row of a join on
both block numbers: a task holds one pair at a time, at any number of vectors.
Sums are whole numbers in floating point, in a precision that holds all of them
exactly; where none does, a block's rows are all scored as integers.

Vectors that are null or hold null or non-finite components, and rows without
vec_id, take no part. Shorter vectors count as filled up with zeros. Of rows
that share a vec_id the largest vector counts, so repeated rows count once; a
query is never its own result. Fewer than k others give fewer rows. Empty
tables give empty results. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eta_spark.llm.common import stored

K, SCALE, QUERY_EVERY = 20, 64, 20
BLOCK, QUERY_BLOCK, LEVELS = 32768, 2048, 64
#: Queries of a block that are searched at a time, and rows that give one row for the sure score.
TOGETHER, BUNCH = 128, 64
#: A task keeps the sure scores of that many blocks of queries, to start the next block with.
REMEMBERED = 256


def quantised(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id and the integer vector of rows that take part."""
    x = F.col("embedding")
    finite = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))
    rows = vectors.where(F.col("vec_id").isNotNull() & x.isNotNull() & F.forall(x, finite))
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.transform(x, lambda v: F.floor(v.cast("double") * scale)).alias("v"))


def _exact_type(rows: np.ndarray, queries: np.ndarray) -> type | None:
    """The smallest type that holds every sum of products exactly."""
    most = float(np.abs(rows.astype(float)).max(initial=0)) * float(np.abs(queries.astype(float)).max(initial=0)) * rows.shape[1]
    return np.float32 if most < 2**24 else np.float64 if most < 2**53 else None


def _first(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    if len(scores) > k:
        some = scores >= np.partition(scores, len(scores) - k)[len(scores) - k]
        ids, scores = ids[some], scores[some]
    first = np.lexsort((ids, -scores))[:k]
    return ids[first], scores[first].astype(np.int64)


class Index:
    """The impact-ordered postings of a block: per dimension the rows by falling impact, and where each round ends."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        self.ids, self.rows = ids, rows
        self.at = {int(i): place for place, i in enumerate(ids)}
        n, width = rows.shape
        size = np.abs(rows.astype(np.float64))
        step = max(1.0, np.ceil((size.max(initial=0) + 1) / LEVELS))
        below = (LEVELS - 1 - size // step).astype(np.int8)  # 0 for the highest impact
        self.order = np.argsort(below.T, axis=1, kind="stable").astype(np.int32)
        self.values = np.take_along_axis(np.ascontiguousarray(rows.T), self.order, axis=1)
        ends = np.array([np.bincount(b, minlength=LEVELS).cumsum() for b in below.T]).reshape(width, LEVELS)
        squares = size**2
        left = squares.sum() - np.bincount(below.ravel(), squares.ravel(), minlength=LEVELS).cumsum()
        self.rounds: list[tuple[np.ndarray, np.ndarray]] = []  # ends by dimension, norms of what rows have unread
        goal = float(squares.sum())
        while True:
            goal /= 4
            level = int(np.argmax(left <= goal)) if goal > 1 else LEVELS - 1
            self.rounds.append((ends[:, level], np.sqrt(np.where(below > level, squares, 0).sum(axis=1)) * (1 + 1e-5)))
            goal = min(goal, float(left[level]))
            if level == LEVELS - 1:
                break

    def top(self, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best rows, the query's own id left out."""
        return self.best(query[None, :], np.array([own]), k, np.array([-np.inf]))[0]

    def best(self, queries: np.ndarray, own: np.ndarray, k: int, bars: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each query ids and scores of the k best rows but its own; rows below its bar may be left out."""
        n, width = self.rows.shape
        q = np.zeros((len(queries), width), dtype=queries.dtype)
        q[:, : min(width, queries.shape[1])] = queries[:, :width]
        kind = _exact_type(self.rows, q)
        if kind is None or n <= 4 * k:
            return [self._all(one.astype(np.int64), mine, k) for one, mine in zip(q, own, strict=True)]
        q, rows = q.astype(kind), self.rows.astype(kind)
        norms = np.sqrt((q.astype(np.float64) ** 2).sum(axis=1)) * (1 + 1e-5)
        found: list = [None] * len(q)
        left = np.arange(len(q))
        sums = np.zeros((len(q), n), dtype=kind)
        mine = np.array([self.at.get(int(i), -1) for i in own])
        done = np.zeros(width, dtype=np.int64)
        for last, (ends, unread) in ((r is self.rounds[-1], r) for r in self.rounds):
            part = np.zeros((n, width), dtype=kind)
            for d, (a, b) in enumerate(zip(done, ends, strict=True)):
                if a != b:
                    part[self.order[d, a:b], d] = self.values[d, a:b]
            done = ends
            sums += q[left] @ part.T
            held = np.flatnonzero(mine[left] >= 0)
            sums[held, mine[left[held]]] = -np.inf
            sure = np.maximum(bars[left], self._sure(rows, q[left], sums, k))
            least = (sure - 2 - 1e-6 * np.abs(sure)).astype(kind)
            possible = sums + norms[left, None].astype(kind) * unread.astype(kind) >= least[:, None]
            if len(held):
                possible[held, mine[left[held]]] = False
            stops = last | (np.count_nonzero(possible, axis=1) <= max(4 * k, n // 32))
            for i in np.flatnonzero(stops):
                members = np.flatnonzero(possible[i])
                found[left[i]] = _first(self.ids[members], rows[members] @ q[left[i]], k)
            if stops.all():
                break
            left, sums = left[~stops], sums[~stops]
        return found

    @staticmethod
    def _sure(rows: np.ndarray, q: np.ndarray, sums: np.ndarray, k: int) -> np.ndarray:
        """A score that k rows reach: of each bunch of rows the one of largest sum, and of these the k best."""
        m, n = sums.shape
        apart = n // max(1, min(BUNCH, n // (4 * k)))  # a bunch holds rows that far apart, so neighbours that are alike all count
        bunches = sums[:, : n // apart * apart].reshape(m, -1, apart)
        highest = bunches.max(axis=1)
        chosen = np.argpartition(highest, apart - k, axis=1)[:, -k:]
        places = np.take_along_axis(bunches, chosen[:, None, :], axis=2).argmax(axis=1) * apart + chosen
        scores = np.einsum("mkd,md->mk", rows[places], q).astype(np.float64)
        scores[np.isneginf(np.take_along_axis(sums, places, axis=1))] = -np.inf
        return scores.min(axis=1)

    def _all(self, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        others = self.ids != own
        return _first(self.ids[others], (self.rows.astype(np.int64) @ query)[others], k)


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks))


def _packed(rows: DataFrame, blocks: int, name: str) -> DataFrame:
    """One row for each block: its ids and its matrix, in 16 or 64 bits a number."""

    def pack(block: pa.Table) -> pa.Table:
        vectors = block["v"].combine_chunks()
        lengths = vectors.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        width = int(lengths.max())
        matrix = np.zeros((len(lengths), width), dtype=np.int64)
        matrix[np.arange(width) < lengths[:, None]] = vectors.flatten().to_numpy(zero_copy_only=False)
        if np.abs(matrix.astype(float)).max(initial=0) < 2**15:
            matrix = matrix.astype(np.int16)
        ids = block["vec_id"].to_numpy().astype(np.int64)
        row = [block[name][0].as_py(), ids.tobytes(), width, matrix.tobytes()]
        return pa.table([pa.array([value], kind) for value, kind in zip(row, (pa.int64(), pa.binary(), pa.int32(), pa.binary()), strict=True)], [name, "ids", "width", "data"])

    keyed = rows.withColumn(name, _block(F.col("vec_id"), blocks))
    return stored(keyed.groupBy(name).applyInArrow(pack, f"{name} long, ids binary, width int, data binary"), name)


def _unpacked(ids: bytes, width: int, data: bytes) -> tuple[np.ndarray, np.ndarray]:
    numbers = np.frombuffer(ids, dtype=np.int64)
    kind = np.int16 if len(data) == 2 * len(numbers) * width else np.int64
    return numbers, np.frombuffer(data, dtype=kind).reshape(len(numbers), width)


def _each(blocks: int) -> Column:
    return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))


def _search(k: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, index = None, None
        bars: dict[int, np.ndarray] = {}
        for frame in frames:
            for row in frame.itertuples():
                if at != row.block:
                    at, index = row.block, Index(*_unpacked(row.ids, row.width, row.data))
                ids, queries = _unpacked(row.query_ids, row.query_width, row.query_data)
                if len(bars) > REMEMBERED:
                    bars.clear()
                bar = bars.setdefault(row.query_block, np.full(len(ids), -np.inf))
                for start in range(0, len(ids), TOGETHER):
                    part = slice(start, start + TOGETHER)
                    found = index.best(queries[part], ids[part], k, bar[part])
                    reached = [f[1][-1] if len(f[1]) == k else -np.inf for f in found]
                    bar[part] = np.maximum(bar[part], reached)
                    yield pd.DataFrame(
                        {
                            "query_id": np.repeat(ids[part], [len(f[0]) for f in found]),
                            "vec_id": np.concatenate([f[0] for f in found]),
                            "score": np.concatenate([f[1] for f in found]),
                        }
                    )

    return run


def top_k(vectors: DataFrame, k: int = K, scale: int = SCALE, query_every: int = QUERY_EVERY) -> DataFrame:
    """query_id, rank, vec_id, score; queries are the rows whose vec_id is divisible by ``query_every``."""
    rows = stored(quantised(vectors, scale).groupBy("vec_id").agg(F.max("v").alias("v")), "vectors")
    asked = F.col("vec_id") % query_every == 0
    n, n_queries = rows.agg(F.count("*"), F.count_if(asked)).first()
    blocks, query_blocks = max(1, -(-n // BLOCK)), max(1, -(-n_queries // QUERY_BLOCK))
    index = _packed(rows, blocks, "block")
    queries = _packed(rows.where(asked), query_blocks, "query_block")
    queries = queries.select("query_block", *(F.col(c).alias(f"query_{c}") for c in ("ids", "width", "data")))
    pairs = index.withColumn("query_block", _each(query_blocks)).join(queries.withColumn("block", _each(blocks)), ["block", "query_block"])
    best = pairs.mapInPandas(_search(k), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


SQL = f"""
WITH rows AS (SELECT vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM rows q JOIN rows c ON q.vec_id <> c.vec_id WHERE q.vec_id % {QUERY_EVERY} = 0)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score FROM scores
QUALIFY rank <= {K}
"""
