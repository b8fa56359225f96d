"""Exact top-k search by inner product with a pivot table.

Distances of every vector to a few pivots are computed once and stored.  For a
query, the largest difference of two distances to one pivot bounds the distance
to a vector from below, and with the norms the inner product from above.  Each
task takes its vectors in the order of that bound and stops where the bound falls
below the k-th best score known; first scores come from the pivots' sample.

Queries are sent in blocks of at most ``QUERY_BLOCK``; a block meets all vectors
where they lie, and k rows per query and task travel to the final ranking.

Defined results: vectors that are null or hold a null or non-finite component
take no part; empty vectors score 0 with each other; vectors meet only those of
their own length; the query's own row is no candidate, another row with its id
is; equal scores rank by id, null ids last; a null id is no query; fewer than k
candidates give fewer rows; an empty table gives none; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from yieldmill.session import materialise

PIVOTS = 16
SAMPLE = 512  # rows the pivots and first scores are taken from
QUERY_BLOCK = 2048
STEP = 128  # candidates scored at once, doubled from step to step
CELLS = 1 << 18  # of a bound matrix, 2 MB
NO_ID = np.iinfo(np.int64).max  # stands for a null id and so sorts last


def scaled(vector: Column) -> Column:
    """Components as whole numbers floor(256 * x); null if the vector takes no part."""
    x = lambda v: v.cast("double")
    good = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(x(v)) & (F.abs(x(v)) < F.lit(float("inf"))))
    return F.when(good, F.transform(vector, lambda v: F.floor(F.lit(256.0) * x(v)).cast("long")))


def distances(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    if not len(vectors) or not len(pivots):
        return np.zeros((len(vectors), len(pivots)))
    a, b = vectors.astype(np.float64), pivots.astype(np.float64)
    return np.sqrt(np.stack([((a - p) ** 2).sum(1) for p in b], 1))


def spread_out(sample: np.ndarray, count: int) -> np.ndarray:
    """Pivots: each the sample's vector farthest from those before."""
    if not len(sample):
        return sample
    chosen, nearest = [0], distances(sample, sample[:1])[:, 0]
    while len(chosen) < min(count, len(sample)) and nearest.max() > 0:
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, distances(sample, sample[chosen[-1:]])[:, 0])
    return sample[chosen]


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to smaller ids."""
    able = np.arange(len(scores))
    if len(scores) > k > 0:
        able = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
    return able[np.lexsort((ids[able], -scores[able]))[:k]]


class Vectors:
    """Rows of the stored table, all of one length."""

    def __init__(self, table: pa.Table | pa.RecordBatch, size: int):
        columns = {name: table.column(name) for name in ("row", "id", "vector", "away")}
        self.row = columns["row"].to_numpy(zero_copy_only=False) if isinstance(table, pa.RecordBatch) else columns["row"].to_numpy()
        self.id = np.array([NO_ID if v is None else v for v in columns["id"].to_pylist()], np.int64)
        pile = lambda name, kind: np.frombuffer(b"".join(columns[name].to_pylist()), kind).reshape(len(self.row), -1)
        self.vector = pile("vector", "<i8") if size else np.zeros((len(self.row), 0), np.int64)
        # One pivot's distances lie together.
        self.away = np.asfortranarray(pile("away", "<f8")) if len(columns["away"]) and len(columns["away"][0].as_py()) else np.zeros((len(self.row), 0))
        self.most = float(np.abs(self.vector.astype(np.float64)).max(initial=0))
        self.norm = (self.vector.astype(np.float64) ** 2).sum(1)
        # Whole numbers below 2^24 are exact in the shorter form, which moves half the bytes.
        short = self.most**2 * size < 2**24
        self.plain = self.vector.astype(np.float32 if short else np.float64)

    def scores(self, places: np.ndarray, other: Vectors, i: int) -> np.ndarray:
        """Exact products of rows with row ``i`` of ``other``; in floating point where that is exact."""
        most = self.most * other.most * self.plain.shape[1]
        short = self.plain.dtype == other.plain.dtype == np.float32 and most < 2**24
        if short or most < 2**52 and self.plain.dtype == other.plain.dtype == np.float64:
            return (self.plain[places] @ other.plain[i]).astype(np.int64)
        return self.vector[places] @ other.vector[i]


def search(queries: Vectors, floor: np.ndarray, rows: Vectors, k: int) -> Iterator[tuple]:
    """For each query: its row, and rows, ids and scores of its best candidates here."""
    shared = min(queries.away.shape[1], rows.away.shape[1])
    per_block = max(1, CELLS // max(len(rows.row), 1))
    for low in range(0, len(queries.row), per_block):
        part = slice(low, low + per_block)
        gap = np.zeros((len(queries.row[part]), len(rows.row)))
        apart = np.empty_like(gap)
        for p in range(shared):
            np.subtract(queries.away[part, p, None], rows.away[None, :, p], out=apart)
            np.maximum(gap, np.abs(apart, out=apart), out=gap)
        norms = queries.norm[part, None] + rows.norm[None, :]
        if shared:
            # A little is added for rounding, so that no bound falls below a true score.
            bound = (norms - gap**2) / 2 + 1e-9 * norms + 1
        else:
            bound = np.full(gap.shape, np.inf)
        for i in range(len(bound)):
            q = low + i
            order = np.flatnonzero((bound[i] >= floor[q]) & (rows.row != queries.row[q]))
            order = order[np.argsort(-bound[i, order])]
            scores, taken, limit, at, step = np.zeros(0, np.int64), np.zeros(0, np.int64), floor[q], 0, STEP
            # Ties at the limit may still win by a smaller id, so only a lower bound stops.
            while at < len(order) and bound[i, order[at]] >= limit:
                some = np.sort(order[at : at + step])  # near in memory
                new = rows.scores(some, queries, q)
                scores, taken = np.append(scores, new), np.append(taken, some)
                keep = best(scores, rows.id[taken], k)
                scores, taken = scores[keep], taken[keep]
                if len(scores) == k:
                    limit = max(limit, float(scores[-1]))
                at, step = at + step, step * 2
            yield queries.row[q], rows.row[taken], rows.id[taken], scores


def exact_top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 5,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    pivots: int = PIVOTS,
    query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """query_id, rank, vec_id, score of the ``k`` best rows of every query row."""
    spark = vectors.sparkSession
    usable = vectors.select(
        F.col(vec_id).cast("long").alias("id"),
        scaled(F.col(vector)).alias("vector"),
        (is_query & F.col(vec_id).isNotNull()).alias("asks"),
    ).where("vector IS NOT NULL")
    picked = usable.orderBy(F.xxhash64("vector"), "id").limit(SAMPLE).select("vector").toArrow()
    by_size: dict[int, list] = {}
    for values in picked.column("vector").to_pylist():
        by_size.setdefault(len(values), []).append(values)
    tables = {size: spread_out(np.array(v, np.int64).reshape(len(v), size), pivots) for size, v in by_size.items()}

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed, away = [], []
            for values in batch.column(2):
                own = values.values.to_numpy(zero_copy_only=False).astype(np.int64)[None, :]
                packed.append(own.astype("<i8").tobytes())
                away.append(distances(own, tables.get(own.shape[1], own[:0])).astype("<f8").tobytes())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array([len(v) for v in batch.column(2)], pa.int32()), batch.column(3),
                 pa.array(packed, pa.binary()), pa.array(away, pa.binary())],
                names=["row", "id", "size", "asks", "vector", "away"],
            )

    stored = materialise(
        usable.select(F.monotonically_increasing_id().alias("row"), "id", "vector", "asks").mapInArrow(
            store, "row long, id long, size int, asks boolean, vector binary, away binary"
        ),
        "pivot-table",
    )
    asking = stored.where("asks")
    counts = asking.groupBy("size").count().collect()  # one row per vector length
    found = None
    for size, count in sorted(tuple(row) for row in counts):
        rows = stored.where(F.col("size") == size).select("row", "id", "vector", "away")
        blocks = -(-count // query_block)
        seeds = rows.orderBy(F.xxhash64("vector"), "id").limit(SAMPLE).toArrow()
        for block in range(blocks):
            mine = asking.where(
                (F.col("size") == size) & (F.pmod(F.xxhash64("row"), F.lit(blocks)) == block)
            ).select("row", "id", "vector", "away").toArrow()
            new = one_block(rows, mine, seeds, size, k)
            if blocks > 1:
                new = materialise(new, "top-k-block")
            found = new if found is None else found.unionByName(new)
    if found is None:
        found = spark.createDataFrame([], "query_row long, query_id long, id long, score long")
    # Rows of equal score and id are alike, so any order of them gives the same result.
    order = Window.partitionBy("query_row").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", F.col("id").alias(vec_id), "score")
    )


def one_block(rows: DataFrame, mine: pa.Table, seeds: pa.Table, size: int, k: int) -> DataFrame:
    """The best rows of each task for a block of queries."""
    queries = Vectors(mine, size)
    floor = np.full(len(queries.row), -np.inf)
    first = Vectors(seeds, size)
    for i, (_, _, _, scores) in enumerate(search(queries, floor, first, k)):
        if len(scores) == k:
            floor[i] = scores[-1]
    sent = rows.sparkSession.sparkContext.broadcast((mine, floor))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, limit = sent.value
        asked, limit = Vectors(table, size), limit.copy()
        held: dict[int, tuple] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            for q, (_, _, ids, scores) in enumerate(search(asked, limit, Vectors(batch, size), k)):
                if q in held:
                    ids, scores = np.append(held[q][0], ids), np.append(held[q][1], scores)
                keep = best(scores, ids, k)
                held[q] = ids[keep], scores[keep]
                if len(keep) == k:
                    limit[q] = max(limit[q], scores[keep[-1]])
        held = {q: v for q, v in held.items() if len(v[0])}
        if not held:
            return
        n = [len(ids) for ids, _ in held.values()]
        at = np.repeat(list(held), n)
        ids = np.concatenate([ids for ids, _ in held.values()])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(asked.row[at]),
                pa.array(asked.id[at]),
                pa.array(ids, mask=ids == NO_ID),
                pa.array(np.concatenate([scores for _, scores in held.values()])),
            ],
            names=["query_row", "query_id", "id", "score"],
        )

    return rows.mapInArrow(scan, "query_row long, query_id long, id long, score long")
