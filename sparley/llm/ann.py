"""Nearest neighbours by inner product: anisotropic product quantisation, four-bit table
scans and exact reranking.

Codebooks of 16 words for each pair of dimensions are fitted on a bounded sample under the
score-aware loss: a vector's residual counts `weight` times along the vector, where it
shifts inner products with the queries that matter, and once across it. Every vector is
coded, so the index has a byte for two codes. A query makes a table of its inner products
with all code words; a block of codes is scanned by adding up table entries (two codes a
look-up), the best of a block are scored exactly from the original vectors, and each
query's best are merged. A row's quantisation error bounds its score; where that leaves a
row that isn't scored a chance to be among the best, all rows of the block are scored, so
the results are those of an exhaustive search.

Queries are written in blocks to the shared folder. A task holds a bounded run of coded
rows and reads one block of queries after the other against it, so neither side is
shuffled or broadcast and each query leaves a task with k rows for each run. Ties go to
the smaller id throughout; equal vectors have equal codes and equal scores.

Defined results: vectors that are null, zero, or hold a null or a number that isn't
finite take no part as queries or candidates, nor do rows with a null id; vectors of
several lengths are an index for each, as an inner product takes equal lengths, and a
query meets those of its own; repeated rows are candidates each, and a query id that repeats asks once,
with the smallest of its vectors; with fewer candidates than k, all
come back; an empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh_dir, open_fs, write_bytes

NEAREST = 20
#: The sample that codebooks are fitted on; candidates of a block that are scored exactly at first.
SAMPLE, RERANK = 8192, 256
#: Rows that a task holds at once, and queries of a block.
RUN, QUERY_BLOCK = 1 << 16, 4096
#: The inner product (as a share of the norms) above which scores matter; sets the weight.
THRESHOLD = 0.2
WORDS, WIDTH, ROUNDS = 16, 2, 8

TABLES_AT_ONCE = 64
#: Rows of a matrix product.
PRODUCT_ROWS = 8192
FOUND = "query_id long, vec_id long, score double"


def takes_part(vector: Column) -> Column:
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(fine & F.exists(vector, lambda x: x != 0), F.lit(False))


def parallel_weight(dimensions: int, threshold: float = THRESHOLD) -> float:
    """How much more the residual along a vector counts than that across it."""
    return max(1.0, (dimensions - 1) * threshold**2 / (1 - threshold**2))


class Quantiser:
    """Codebooks [parts, WORDS, WIDTH], for vectors padded to a multiple of 2 WIDTH."""

    def __init__(self, dimensions: int, books: np.ndarray, weight: float):
        self.dimensions, self.books, self.weight = dimensions, books, weight

    @staticmethod
    def padded(x: np.ndarray) -> np.ndarray:
        extra = -x.shape[1] % (2 * WIDTH)
        return np.pad(x, ((0, 0), (0, extra))).reshape(len(x), -1, WIDTH)

    @classmethod
    def fit(cls, x: np.ndarray, threshold: float = THRESHOLD, rounds: int = ROUNDS, seed: int = 5) -> Quantiser:
        weight = parallel_weight(x.shape[1], threshold)
        p = cls.padded(x)
        random = np.random.Generator(np.random.PCG64(seed))
        start = random.choice(len(p), WORDS, replace=len(p) < WORDS)
        out = cls(x.shape[1], np.ascontiguousarray(p[start].transpose(1, 0, 2)), weight)
        unit = cls.padded(x / np.linalg.norm(x, axis=1, keepdims=True))
        codes = out._nearest(p)
        for _ in range(rounds):
            out._update(p, unit, codes)
            codes = out._descend(p, unit, codes, 1)
        return out

    def _nearest(self, p: np.ndarray) -> np.ndarray:
        codes = np.empty(p.shape[:2], np.uint8)
        for s in range(p.shape[1]):
            codes[:, s] = ((p[:, s, None] - self.books[s]) ** 2).sum(axis=2).argmin(axis=1)
        return codes

    def _decoded(self, codes: np.ndarray) -> np.ndarray:
        return self.books[np.arange(codes.shape[1]), codes]

    def _descend(self, p: np.ndarray, unit: np.ndarray, codes: np.ndarray, sweeps: int) -> np.ndarray:
        """Improves one code at a time under the anisotropic loss, given the others."""
        codes = codes.copy()
        along = ((p - self._decoded(codes)) * unit).sum(axis=(1, 2))
        for _ in range(sweeps):
            for s in range(p.shape[1]):
                residual = p[:, s, None] - self.books[s]
                part = (residual * unit[:, s, None]).sum(axis=2)
                at = np.arange(len(p))
                others = along - part[at, codes[:, s]]
                loss = (residual**2).sum(axis=2) + (self.weight - 1) * (others[:, None] + part) ** 2
                codes[:, s] = loss.argmin(axis=1)
                along = others + part[at, codes[:, s]]
        return codes

    def _update(self, p: np.ndarray, unit: np.ndarray, codes: np.ndarray) -> None:
        """Each word's least-squares value under the loss, given the codes."""
        along = ((p - self._decoded(codes)) * unit).sum(axis=(1, 2))
        for s in range(p.shape[1]):
            u, c = unit[:, s], codes[:, s]
            # The residual along the vector, but for this word's part in it.
            rest = along + (self.books[s][c] * u).sum(axis=1)
            count = np.bincount(c, minlength=WORDS)
            left = np.zeros((WORDS, WIDTH, WIDTH))
            right = np.zeros((WORDS, WIDTH))
            for i in range(WIDTH):
                right[:, i] = np.bincount(c, p[:, s, i] + (self.weight - 1) * rest * u[:, i], WORDS)
                for j in range(WIDTH):
                    left[:, i, j] = (self.weight - 1) * np.bincount(c, u[:, i] * u[:, j], WORDS) + (count if i == j else 0)
            used = count > 0
            fresh = self.books[s].copy()
            fresh[used] = np.linalg.solve(left[used] + 1e-9 * np.eye(WIDTH), right[used][:, :, None])[:, :, 0]
            along -= ((fresh - self.books[s])[c] * u).sum(axis=1)
            self.books[s] = fresh

    def encode(self, x: np.ndarray) -> np.ndarray:
        """Two four-bit codes a byte."""
        p = self.padded(x.astype(np.float64))
        norm = np.sqrt((p**2).sum(axis=(1, 2), keepdims=True))
        codes = self._descend(p, p / np.where(norm > 0, norm, 1), self._nearest(p), 2)
        return codes[:, 0::2] | codes[:, 1::2] << 4

    def radius(self, x: np.ndarray, packed: np.ndarray) -> np.ndarray:
        """By how much, for a query of norm 1, a sum of table entries can differ from the exact score."""
        p = self.padded(x.astype(np.float64))
        decoded = self._decoded(np.stack([packed & 15, packed >> 4], axis=2).reshape(len(x), -1))
        norm = lambda a: np.sqrt((a**2).sum(axis=(1, 2)))
        # The entries are rounded and added up in single precision, the exact scores in double precision.
        return norm(p - decoded) * (1 + 1e-9) + (packed.shape[1] + 2) * 2.0**-22 * norm(decoded) + _rounding(x.shape[1]) * norm(p)

    def tables(self, q: np.ndarray) -> np.ndarray:
        """[queries, bytes of a code, 256]: the inner product with what each byte stands for."""
        one = np.einsum("qsw,skw->qsk", self.padded(q.astype(np.float64)), self.books)
        return (one[:, 1::2, :, None] + one[:, 0::2, None, :]).reshape(len(q), -1, WORDS * WORDS).astype(np.float32)


def _rounding(dimensions: int) -> float:
    """The error of an inner product in double precision, in any order, as a share of the norms."""
    return (dimensions + 4) * 2.0**-52


def exact(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products in double precision, term after term."""
    out = np.zeros(len(rows))
    for j in range(rows.shape[1]):
        out += rows[:, j] * query[j]
    return out


def _exhaustive(ids: np.ndarray, vectors: np.ndarray, query_ids: list[int], queries: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Each query's best of all rows. A matrix product leaves the rows that rounding could put among them."""
    product, longest = np.empty((len(queries), len(ids))), 0.0
    for a in range(0, len(ids), PRODUCT_ROWS):
        rows = vectors[a : a + PRODUCT_ROWS].astype(np.float64)
        product[:, a : a + len(rows)] = queries @ rows.T
        longest = max(longest, np.sqrt((rows**2).sum(axis=1)).max())
    for own, query, rough in zip(query_ids, queries, product, strict=True):
        others = ids != own
        rough, most = rough[others], min(k, np.count_nonzero(others))
        border = np.partition(rough, len(rough) - most)[len(rough) - most] if most else 0.0
        at = np.flatnonzero(others)[~(rough < border - 4 * _rounding(len(query)) * longest * np.linalg.norm(query))]
        scores = exact(vectors[at].astype(np.float64), query)
        order = np.lexsort((ids[at], -scores))[:k]
        yield own, ids[at][order], scores[order]


def search_run(quantiser: Quantiser, ids: np.ndarray, codes: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int, rerank: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Each query's best rows of a run, whose ids ascend: query id, row ids and scores."""
    columns = np.ascontiguousarray(codes.T)
    most = min(rerank + 1, len(ids))
    radius = quantiser.radius(vectors, codes)
    for at in range(0, len(queries), TABLES_AT_ONCE):
        part = queries[at : at + TABLES_AT_ONCE].astype(np.float64)
        own_ids, open_ = query_ids[at : at + TABLES_AT_ONCE].tolist(), []
        for i, (table, own, query) in enumerate(zip(quantiser.tables(part), own_ids, part, strict=True)):
            rough = table[0][columns[0]]
            for entry, column in zip(table[1:], columns[1:], strict=True):
                rough += entry[column]
            border = np.partition(rough, len(ids) - most)[len(ids) - most]
            best = np.flatnonzero(rough >= border)[: 2 * most]
            scored = ids == own
            best = best[~scored[best]]
            scored[best] = True
            scores = exact(vectors[best].astype(np.float64), query)
            order = np.lexsort((ids[best], -scores))[:k]
            # What a row that isn't scored can have at most; equal scores count, as its id may be smaller.
            bound = rough.astype(np.float64) + np.linalg.norm(query) * radius
            bound[scored] = -np.inf
            if scored.all() or len(order) == k and bound.max() < scores[order[-1]]:
                yield own, ids[best][order], scores[order]
            else:
                open_.append(i)
        if open_:
            yield from _exhaustive(ids, vectors, [own_ids[i] for i in open_], part[open_], k)


def _arrays(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    ids = batch.column("vec_id").to_numpy(zero_copy_only=False).astype(np.int64)
    return ids, np.array(batch.column("vector").flatten().to_numpy(zero_copy_only=False)).reshape(len(ids), -1)


def _runs(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids and vectors of up to `most` rows at once, by id."""
    held: list[tuple] = []

    def run() -> tuple[np.ndarray, np.ndarray]:
        ids, x = (np.concatenate(c) for c in zip(*held, strict=True))
        held.clear()
        order = np.argsort(ids, kind="stable")
        return ids[order], x[order]

    for batch in batches:
        for a in range(0, batch.num_rows, most):
            held.append(_arrays(batch.slice(a, most)))
            if sum(len(x[0]) for x in held) >= most:
                yield run()
    if held:
        yield run()


def _query_writer(folder: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, x in _runs(batches, QUERY_BLOCK):
            path = f"{folder}/{uuid.uuid4().hex}.queries"  # a task that runs again leaves the first one's file unread
            write_bytes(path, np.array([len(ids), x.itemsize], np.int64).tobytes(), ids.tobytes(), x.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array([path])], ["path"])

    return write


def read_queries(path: str) -> tuple[np.ndarray, np.ndarray]:
    files, local = open_fs(path)
    with files.open_input_file(local) as file:
        data = file.read()
    n, item = np.frombuffer(data[:16], np.int64).tolist()
    return np.frombuffer(data[16 : 16 + 8 * n], np.int64), np.frombuffer(data[16 + 8 * n :], np.float32 if item == 4 else np.float64).reshape(n, -1)


def _searcher(quantiser: Quantiser, paths: list[str], k: int, rerank: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, x in _runs(batches, RUN):
            codes = quantiser.encode(x)
            for path in paths:
                own, found, scores = zip(*search_run(quantiser, ids, codes, x, *read_queries(path), k, rerank), strict=True)
                queries = np.repeat(own, [len(f) for f in found])
                yield pa.RecordBatch.from_arrays([pa.array(queries, pa.int64()), pa.array(np.concatenate(found), pa.int64()), pa.array(np.concatenate(scores), pa.float64())], ["query_id", "vec_id", "score"])

    return search


def search(vectors: DataFrame, queries: Column, k: int = NEAREST, rerank: int = RERANK, sample: int = SAMPLE, threshold: float = THRESHOLD) -> DataFrame:
    """query_id, rank, vec_id and score: the k nearest to each row of vectors (vec_id,
    embedding) that `queries` is true for, but for the query's own id."""
    spark = vectors.sparkSession
    valid = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("vector"), queries.alias("asks")).filter(F.col("vec_id").isNotNull() & takes_part(F.col("vector")))
    valid = valid.withColumn("length", F.size("vector"))
    # A query id asks once, with the smallest of its vectors.
    asked = valid.filter(F.coalesce("asks", F.lit(False))).groupBy("vec_id").agg(F.min("vector").alias("vector")).withColumn("length", F.size("vector"))
    found = None
    for d in sorted(row["length"] for row in valid.select("length").distinct().collect()):
        own = valid.filter(F.col("length") == d)
        # The sample: a digest's order, so it doesn't depend on the files. At most `sample` rows go to the driver.
        taken = own.select("vec_id", "vector", F.xxhash64("vec_id").alias("h")).orderBy("h", "vec_id", "vector").limit(sample).collect()
        quantiser = Quantiser.fit(np.array([row["vector"] for row in taken], np.float64), threshold)
        folder = fresh_dir(spark, "ann")
        paths = sorted(row["path"] for row in asked.filter(F.col("length") == d).select("vec_id", "vector").mapInArrow(_query_writer(folder), "path string").collect())
        part = own.select("vec_id", "vector").mapInArrow(_searcher(quantiser, paths, k, rerank), FOUND)
        found = part if found is None else found.unionByName(part)
    if found is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
