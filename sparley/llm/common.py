"""Tables, shared storage and vectorised text primitives of the llm operators."""

from __future__ import annotations

import contextlib
import ctypes
import sys
import types
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space that separates words: space and U+0009 to U+000D.
WHITE = " \t\n\x0b\f\r"
#: A run of white space and a word, for Java's and RE2's regular expressions.
WHITE_RUN = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or, where the
    session sets none (tests on one machine), a folder of this user's."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the cluster shares")
    return "file:///tmp/checkpoints/sparley"


def own_dir(spark: SparkSession) -> str:
    """This application's part of the shared folder."""
    return f"{shared_dir(spark)}/sparley-{spark.sparkContext.applicationId}"


def fresh_dir(spark: SparkSession, what: str) -> str:
    return f"{own_dir(spark)}/{what}-{uuid.uuid4().hex}"


def release(spark: SparkSession) -> None:
    """Deletes all intermediate tables of this application. Results that still read them
    have to be written before."""
    delete(spark, own_dir(spark))


def materialise(df: DataFrame, what: str) -> DataFrame:
    """Cuts lineage: writes df as a table in the shared folder and reads it back."""
    path = fresh_dir(df.sparkSession, what)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Deletes tables that `materialise` wrote and nothing reads any more."""
    for df in tables:
        spark = df.sparkSession
        own = own_dir(spark).rpartition("/")[2]
        for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
            if f"/{own}/" in folder:
                delete(spark, folder)


def delete(spark: SparkSession, path: str) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


#: A row's address: a digest of the path of the file that it is in, and its place there.
FILE, ROW = "__sparley_file", "__sparley_row"


def addressed(docs: DataFrame) -> DataFrame:
    """docs with the columns FILE and ROW.

    A row keeps its address however often it is read, so what one pass finds out about it
    reaches another through `write_sides`, without a shuffle of the rows. What isn't a plain
    scan of Parquet files is written as a table first.
    """
    def scan(node) -> bool:
        inner = node.children()
        return node.nodeName() in ("Project", "Filter", "SubqueryAlias", "View") and scan(inner.apply(0)) or node.nodeName() == "LogicalRelation"

    plan = docs._jdf.queryExecution().analyzed()
    for df in (docs, None):
        df = df or materialise(docs, "rows")
        if df is docs and not (plan.deterministic() and scan(plan)):
            continue
        with contextlib.suppress(AnalysisException):  # files without row numbers
            at = df.metadataColumn("_metadata")
            return df.select("*", F.xxhash64(at["file_path"]).alias(FILE), at["row_index"].alias(ROW))
    raise TypeError("rows of a Parquet table have addresses")


#: Rows of a file that one side file speaks of.
SIDE_ROWS = 1 << 20


def write_sides(rows: DataFrame, folder: str, value: str | None = None) -> None:
    """Writes, for each run of SIDE_ROWS rows of a file, which of them `rows` (FILE, ROW and a
    long) has, and their values. A task that runs again writes the same bytes."""

    def save(key: tuple, table: pa.Table) -> pa.Table:
        at = table.column(ROW).to_numpy()
        order = np.argsort(at, kind="stable")
        values = table.column("value").to_numpy()
        write_bytes(f"{folder}/{key[0].as_py()}-{key[1].as_py()}", at[order].astype(np.int64).tobytes(), values[order].astype(np.int64).tobytes())
        return pa.table({"n": pa.array([len(at)], pa.int64())})

    chosen = rows.select(FILE, ROW, (F.col(value) if value else F.lit(0)).cast("long").alias("value"))
    chosen.groupBy(FILE, F.shiftright(ROW, 20).alias("part")).applyInArrow(save, "n long").agg(F.sum("n")).collect()


class Sides:
    """What `write_sides` wrote, by address; holds the last few runs."""

    def __init__(self, folder: str):
        self.folder, self.held = folder, {}

    def _of(self, key: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
        from pyarrow import fs

        if key not in self.held:
            files, path = open_fs(f"{self.folder}/{key[0]}-{key[1]}")
            data = b""
            if files.get_file_info(path).type != fs.FileType.NotFound:
                with files.open_input_file(path) as file:
                    data = file.read()
            while len(self.held) >= 4:
                self.held.pop(next(iter(self.held)))
            n = len(data) // 16
            self.held[key] = np.frombuffer(data, np.int64, n), np.frombuffer(data, np.int64, n, 8 * n)
        return self.held[key]

    def find(self, file: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether rows were written, and their values."""
        found, values = np.zeros(len(row), bool), np.zeros(len(row), np.int64)
        part = row >> 20
        edges = np.flatnonzero((file[1:] != file[:-1]) | (part[1:] != part[:-1])) + 1
        for a, b in zip([0, *edges], [*edges, len(row)], strict=True):
            if b > a:
                rows, kept = self._of((int(file[a]), int(part[a])))
                at = np.minimum(np.searchsorted(rows, row[a:b]), max(len(rows) - 1, 0))
                if len(rows):
                    found[a:b] = rows[at] == row[a:b]
                    values[a:b] = np.where(found[a:b], kept[at], 0)
        return found, values


def worker_cache(name: str) -> dict:
    """A dict that lives as long as the Python worker, across tasks."""
    holder = sys.modules.setdefault("_sparley_worker", types.ModuleType("_sparley_worker"))
    return holder.__dict__.setdefault(name, {})


def open_fs(uri: str):
    """pyarrow's file system for a URI or path, and the path within it."""
    from pyarrow import fs

    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    if "://" not in uri:
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri)


def write_bytes(uri: str, *parts) -> None:
    """Writes under another name first, so a reader never sees half a file."""
    files, path = open_fs(uri)
    files.create_dir(path.rsplit("/", 1)[0], recursive=True)
    with files.open_output_stream(f"{path}.part") as out:
        for part in parts:
            out.write(part)
    files.move(f"{path}.part", path)


def buffers(column) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and its n + 1 offsets; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data else np.zeros(0, np.uint8)
    if not len(offsets):
        return data[:0], np.zeros(1, np.int64)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """The batches' rows, in pieces of about `most` bytes of one string column."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        begin, total = 0, 0
        for i, size in enumerate(sizes):
            if i > begin and total + size > most:
                yield batch.slice(begin, i - begin)
                begin, total = i, 0
            total += int(size)
        if begin < len(sizes):
            yield batch.slice(begin)
    tidy()


def tidy() -> None:
    """Gives memory that a finished task has freed back to the system: workers stay, idle,
    beside the JVM of later stages."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError):  # only in glibc
        ctypes.CDLL(None).malloc_trim(0)


_IS_WHITE = np.zeros(256, bool)
_IS_WHITE[[0x20, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE = np.random.Generator(np.random.PCG64(7)).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(h: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    cache = worker_cache("powers")
    if len(cache.get("up", ())) < n:
        for key, base in (("up", _BASE), ("down", _BASE_INVERSE)):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            cache[key] = np.cumprod(steps, dtype=np.uint64)
    return cache["up"], cache["down"]


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin, end and row of every word; words don't run over a row's end."""
    if not len(data):
        return (np.zeros(0, np.int64),) * 3
    solid = ~_IS_WHITE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.empty(len(data), bool)
    before[0], before[1:] = True, ~solid[:-1]
    begins = np.flatnonzero(solid & (before | edge[:-1]))
    after = np.empty(len(data), bool)
    after[-1], after[:-1] = True, ~solid[1:]
    ends = np.flatnonzero(solid & (after | edge[1:])) + 1
    return begins, ends, np.searchsorted(offsets, begins, "right") - 1


def hash_spans(data: np.ndarray, begins: np.ndarray, ends: np.ndarray, most: int = 1 << 20) -> np.ndarray:
    """A 64-bit hash of each span of bytes. Spans are sorted and don't overlap.

    A polynomial hash from prefix sums modulo 2^64, mixed at the end: a few passes over
    the bytes, whatever the number of spans.
    """
    out = np.empty(len(begins), np.uint64)
    k = 0
    while k < len(begins):
        first = begins[k]
        stop = max(k + 1, int(np.searchsorted(ends, first + most, "right")))
        last = ends[stop - 1]
        up, down = _powers(int(max(most, last - first) + 1))
        sums = np.empty(last - first + 1, np.uint64)
        sums[0] = 0
        np.cumsum(_BYTE[data[first:last]] * up[: last - first], out=sums[1:])
        b, e = begins[k:stop] - first, ends[k:stop] - first
        out[k:stop] = mix((sums[e] - sums[b]) * down[b] + (e - b).astype(np.uint64))
        k = stop
    return out


def hashed_words(column, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all words of a string column, and n + 1 offsets of the rows in them."""
    data, offsets = buffers(column)
    if lower:
        data = _LOWER[data]
    begins, ends, rows = word_spans(data, offsets)
    counts = np.bincount(rows, minlength=len(offsets) - 1) if len(rows) else np.zeros(len(offsets) - 1, np.int64)
    return hash_spans(data, begins, ends), np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
