"""Nearest neighbours through an inverted multi-index.

Two codebooks are fitted by k-means on the halves of a bounded sample of vectors
(``SAMPLE_ROWS``, those with the smallest hashes); every vector is indexed under
its pair of nearest centroids, a cell.  A query walks the pairs in order of
summed squared distance with a heap until the cells it opened hold ``probe``
candidates, and these are reranked by exact distance in double precision.

``probe`` is measured, not guessed: for ``SAMPLE_QUERIES`` queries the true
neighbours are found by brute force over all entries, and ``probe`` is what
``RECALL`` of them need.  Clustered vectors need a few cells; unstructured
ones (independent random directions) need a large share of all, and the search
then costs a share of queries times rows.

Nothing is capped: an opened cell is compared as a whole.  Of vectors equal in
every component only the ``k + 1`` smallest ids are entries: the others can
never be among the ``k`` nearest, since ties go to the smaller id (one more
covers the query itself).  Cells with many entries or many queries are cut into
pieces of about ``PIECE_ROWS``, each pair of pieces a group of its own.

Defined results: vectors that are null, empty, of another length than the most
common one, all zero, or hold null or non-finite components take no part,
neither as query nor as candidate; null ids take no part; equal rows count
once; an id with several vectors is searched for and found with each of them,
and listed once, at its smallest distance; fewer candidates than ``k`` give
them all; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

K = 10
SAMPLE_ROWS = 16_384
CELL_ROWS = 256
MAX_CENTROIDS = 1_024
ITERATIONS = 8
SAMPLE_QUERIES = 64
RECALL = 0.96
PIECE_ROWS = 2_048


def usable(table: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """``id, vec`` (array<double>) of the vectors that take part."""
    v = F.col(vector).cast("array<double>")
    bad = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    t = (table.select(F.col(vec_id).cast("long").alias("id"), v.alias("vec"))
         .filter(F.col("id").isNotNull() & F.col("vec").isNotNull() & (F.size("vec") > 0))
         .filter(~bad & F.exists("vec", lambda x: x != 0.0)))
    return t


def _kmeans(x: np.ndarray, k: int, iterations: int) -> np.ndarray:
    """Lloyd's iterations from evenly spaced rows in the order of the first principal axis."""
    mean = x.mean(0)
    axis = np.linalg.svd(x[: 4 * x.shape[1] + 64] - mean, full_matrices=False)[2][0]
    order = np.argsort((x - mean) @ axis, kind="stable")
    c = x[order[np.linspace(0, len(x) - 1, min(k, len(x))).astype(int)]].copy()
    c = np.unique(c, axis=0)
    for _ in range(iterations):
        near = _nearest(x, c)
        for j in range(len(c)):
            own = x[near == j]
            if len(own):
                c[j] = own.mean(0)
    return c


def _nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.argmin((c * c).sum(1) - 2.0 * (x @ c.T), axis=1)


def fit(vectors: DataFrame, centroids: int, sample_rows: int = SAMPLE_ROWS,
        iterations: int = ITERATIONS) -> tuple[np.ndarray, np.ndarray]:
    """Codebooks of the two halves, from at most ``sample_rows`` vectors."""
    rows = vectors.orderBy(F.xxhash64("id", "vec"), "id").limit(sample_rows).select("vec").collect()
    x = np.array([r["vec"] for r in rows], dtype=np.float64)
    half = x.shape[1] // 2
    return _kmeans(x[:, :half], centroids, iterations), _kmeans(x[:, half:], centroids, iterations)


def _assign(vectors: DataFrame, books: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """``id, vec, cell``; a cell is ``i * len(book 2) + j``."""
    half, width = books[0].shape[1], len(books[1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x = b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
                cell = _nearest(x[:, :half], books[0]) * width + _nearest(x[:, half:], books[1])
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell.astype(np.int32))], ["id", "vec", "cell"])

    return vectors.mapInArrow(run, "id long, vec array<double>, cell int")


def pairs_by_distance(d1: np.ndarray, d2: np.ndarray) -> Iterator[tuple[int, int]]:
    """Centroid pairs by ``d1[i] + d2[j]``, smallest first (the multi-sequence walk)."""
    o1, o2 = np.argsort(d1, kind="stable"), np.argsort(d2, kind="stable")
    heap, seen = [(d1[o1[0]] + d2[o2[0]], 0, 0)], {(0, 0)}
    while heap:
        _, i, j = heapq.heappop(heap)
        yield int(o1[i]), int(o2[j])
        for a, b in ((i + 1, j), (i, j + 1)):
            if a < len(o1) and b < len(o2) and (a, b) not in seen:
                seen.add((a, b))
                heapq.heappush(heap, (d1[o1[a]] + d2[o2[b]], a, b))


def _visits(queries: DataFrame, books: tuple[np.ndarray, np.ndarray], sizes: dict[int, int], probe: int) -> DataFrame:
    """``cell, query_id, vec``: the cells every query opens."""
    half, width = books[0].shape[1], len(books[1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x = b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
            cells, rows = [], []
            for r, q in enumerate(x):
                d1, d2 = ((books[0] - q[:half]) ** 2).sum(1), ((books[1] - q[half:]) ** 2).sum(1)
                got = 0
                for i, j in pairs_by_distance(d1, d2):
                    n = sizes.get(i * width + j, 0)
                    if n:
                        cells.append(i * width + j)
                        rows.append(r)
                        got += n
                        if got >= probe:
                            break
            take = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(cells, pa.int32()), b.column(0).take(take), b.column(1).take(take)],
                                             ["cell", "query_id", "vec"])

    return queries.mapInArrow(run, "cell int, query_id long, vec array<double>")


def _near(ids: np.ndarray, d: np.ndarray, k: int) -> np.ndarray:
    """Positions of the ``k`` smallest finite distances, ties to the smaller id."""
    if len(d) > k:
        near = np.flatnonzero(d <= np.partition(d, k - 1)[k - 1])  # with all ties of the k-th
    else:
        near = np.arange(len(d))
    near = near[np.isfinite(d[near])]
    return near[np.lexsort((ids[near], d[near]))[:k]]


def _matrix(vectors: pa.ChunkedArray | pa.Array, n: int) -> np.ndarray:
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    return vectors.flatten().to_numpy(zero_copy_only=False).reshape(n, -1)


def _merged(rows: DataFrame, k: int) -> DataFrame:
    """The ``k`` nearest of each query's partial lists, as ``query_id, near``."""
    once = rows.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    return once.groupBy("query_id").agg(
        F.slice(F.sort_array(F.collect_list(F.struct("score", "vec_id"))), 1, k).alias("near"))


def calibrate(entries: DataFrame, queries: DataFrame, books: tuple[np.ndarray, np.ndarray], sizes: dict[int, int],
              k: int, recall: float = RECALL, sample_queries: int = SAMPLE_QUERIES) -> int:
    """Candidates a query must open for ``recall`` on sampled queries, by brute force over all entries.

    ``sample_queries`` bounds what is collected and broadcast; every entry is compared.
    """
    rows = queries.orderBy(F.xxhash64("id", "vec"), "id").limit(sample_queries).collect()
    q_ids, qs = [r["id"] for r in rows], np.array([r["vec"] for r in rows])
    half, width = books[0].shape[1], len(books[1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            ids, x, cell = b.column(0).to_numpy(), _matrix(b.column(1), b.num_rows), b.column(2).to_numpy()
            out: list[tuple[int, int, float, int]] = []
            for at, (q_id, q) in enumerate(zip(q_ids, qs)):
                d = np.sqrt(((x - q) ** 2).sum(1))
                d[ids == q_id] = np.inf
                near = _near(ids, d, k)
                out += zip([at] * len(near), ids[near].tolist(), d[near].tolist(), cell[near].tolist())
            yield pa.RecordBatch.from_pylist([dict(zip(("at", "id", "score", "cell"), r)) for r in out],
                                             schema=pa.schema([("at", pa.int32()), ("id", pa.int64()),
                                                               ("score", pa.float64()), ("cell", pa.int32())]))

    found = (entries.mapInArrow(run, "at int, id long, score double, cell int").groupBy("at")
             .agg(F.slice(F.sort_array(F.collect_list(F.struct("score", "id", "cell"))), 1, k).alias("near")).collect())
    opened: list[int] = []
    for r in found:
        q = qs[r["at"]]
        d1, d2 = ((books[0] - q[:half]) ** 2).sum(1), ((books[1] - q[half:]) ** 2).sum(1)
        wanted, got = Counter(n["cell"] for n in r["near"]), 0
        for i, j in pairs_by_distance(d1, d2):
            got += sizes.get(i * width + j, 0)
            opened += [got] * wanted.pop(i * width + j, 0)
            if not wanted:
                break
    opened.sort()
    return opened[min(len(opened) - 1, int(np.ceil(recall * len(opened))))] if opened else 1


def search(table: DataFrame, is_query: Callable[[Column], Column], vec_id: str = "vec_id", vector: str = "embedding",
           k: int = K, cell_rows: int = CELL_ROWS, probe: int | None = None) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found for every row with ``is_query(id)``."""
    spark = table.sparkSession
    vectors = usable(table, vec_id, vector)
    width = vectors.groupBy(F.size("vec").alias("w")).count().orderBy(F.desc("count"), "w").first()
    if width is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    vectors = vectors.filter(F.size("vec") == width["w"])
    if width["w"] < 2:
        vectors = vectors.withColumn("vec", F.array_append("vec", F.lit(0.0)))  # both halves need a component
    vectors = vectors.distinct()
    queries = vectors.filter(is_query(F.col("id")))
    # the limit is applied before the shuffle too (window group limit), so a hot vector stays small
    entries = (vectors.withColumn("nth", F.row_number().over(Window.partitionBy("vec").orderBy("id")))
               .filter(F.col("nth") <= k + 1).drop("nth"))
    books = fit(vectors, int(np.clip(np.ceil(np.sqrt(width["count"] / cell_rows)), 4, MAX_CENTROIDS)))
    indexed = cut(_assign(entries, books))
    sizes = {r["cell"]: r["count"] for r in indexed.groupBy("cell").count().collect()}  # MAX_CENTROIDS ** 2 rows at most
    probe = probe or calibrate(indexed, queries, books, sizes, k)
    visits = cut(_visits(queries, books, sizes, probe))
    asked = {r["cell"]: r["count"] for r in visits.groupBy("cell").count().collect()}

    def pieces(counts: dict[int, int]) -> Column:
        """How many pieces of about ``PIECE_ROWS`` rows a cell is cut into; one for all but hot cells."""
        hot = {c: -(-n // PIECE_ROWS) for c, n in counts.items() if n > PIECE_ROWS}
        if not hot:
            return F.lit(1)
        return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for p in hot.items() for x in p]), F.col("cell")), F.lit(1))

    def spread(df: DataFrame, mine: str, mine_of: Column, other: str, other_of: Column) -> DataFrame:
        return (df.withColumn(mine, F.pmod(F.xxhash64(*[c for c in df.columns if c != "cell"]), mine_of).cast("int"))
                .withColumn(other, F.explode(F.sequence(F.lit(0), other_of - 1))))

    left = spread(indexed, "block", pieces(sizes), "part", pieces(asked))
    right = spread(visits, "part", pieces(asked), "block", pieces(sizes))

    def rerank(e: pa.Table, q: pa.Table) -> pa.Table:
        out_q, out_v, out_s = [], [], []
        if e.num_rows and q.num_rows:
            ids, x = e.column("id").to_numpy(), _matrix(e.column("vec"), e.num_rows)
            for q_id, v in zip(q.column("query_id").to_pylist(), _matrix(q.column("vec"), q.num_rows)):
                d = np.sqrt(((x - v) ** 2).sum(1))
                d[ids == q_id] = np.inf
                near = _near(ids, d, k)
                out_q += [q_id] * len(near)
                out_v += ids[near].tolist()
                out_s += d[near].tolist()
        return pa.table({"query_id": pa.array(out_q, pa.int64()), "vec_id": pa.array(out_v, pa.int64()),
                         "score": pa.array(out_s, pa.float64())})

    keys = ["cell", "block", "part"]
    found = (left.groupBy(*keys).cogroup(right.groupBy(*keys))
             .applyInArrow(rerank, "query_id long, vec_id long, score double"))
    return (_merged(found, k).select("query_id", F.posexplode("near").alias("rank", "n"))
            .select("query_id", (F.col("rank") + 1).cast("int").alias("rank"), F.col("n.vec_id").alias("vec_id"),
                    F.col("n.score").alias("score")))
