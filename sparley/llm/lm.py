"""Language-model scores from an Elias-Fano trie of n-grams.

Level 1 holds the vocabulary as 64-bit word hashes with their counts; a word's id is its
rank. Level 2 holds, for each context word, the ids of its successors; level 3 holds, for
each pair of words, its successors as places among the successors of the second word, so
these numbers are small. Each level is a monotone sequence in Elias-Fano code, with
monotone pointers from a context to its successors and 16-bit logarithms of smoothed
probabilities and back-off weights beside it. Levels are cut into shards by ranges of the
first word; executors build shards from sorted runs of counts and later map them into
memory. Nothing is collected but a row for each shard.

Probabilities: add-half unigrams; above them interpolated absolute discounting, so that
probabilities sum to one. Pairs and triples are all kept.

Defined results: a null or wordless text is its end token alone; a null doc_id trains;
repeated rows count each time and score alike; without training rows every token has
probability one; an empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fresh_dir, hashed_words, open_fs, slices, worker_cache, write_bytes

DISCOUNT = 0.75
#: The count from which a triple is kept: all are.
LEAST_TRIPLES = 1
#: Steps of a quantised logarithm to base 10.
STEPS = 2048
#: The end token's hash, which counts as a word, and the mark before the first word, which doesn't.
END = np.uint64(0x0123456789ABCDEF)
#: Entries of a task's counts beyond which they are sent on.
SPILL = 4 << 20
#: Bytes of text that are looked up at once; larger pieces repeat fewer look-ups.
PIECE = 6 << 20
#: Files that a worker keeps open, and bytes it holds of those that can't be mapped.
HELD_FILES, HELD_BYTES = 4096, 256 << 20

_U = np.uint64
_BYTE_SELECT = np.array([([b for b in range(8) if x >> b & 1] + [0] * 8)[k] for x in range(256) for k in range(8)], np.int64)
_EACH, _TOPS = _U(0x0101010101010101), _U(0x8080808080808080)


def _select(words: np.ndarray, sums: np.ndarray, k: np.ndarray, flip: bool) -> np.ndarray:
    """Places of the k-th ones (zeros, if flip) of a bit vector; sums: those before each word."""
    word = np.searchsorted(sums, k, "right") - 1
    rest = (k - sums[word]).astype(_U)
    x = words[word]
    if flip:
        x = ~x
    # Ones up to and with each byte, in the bytes of one number; then the byte that holds the wanted one.
    s = x - ((x >> _U(1)) & _U(0x5555555555555555))
    s = (s & _U(0x3333333333333333)) + ((s >> _U(2)) & _U(0x3333333333333333))
    s = ((s + (s >> _U(4))) & _U(0x0F0F0F0F0F0F0F0F)) * _EACH
    bits = ((((rest * _EACH | _TOPS) - s & _TOPS) >> _U(7)) * _EACH >> _U(56)) << _U(3)
    rest -= (s << _U(8)) >> bits & _U(255)
    return word * 64 + bits.astype(np.int64) + _BYTE_SELECT[((x >> bits & _U(255)) << _U(3) | rest).astype(np.int64)]


class EliasFano:
    """A monotone sequence of numbers below 2^64, read by place or searched by value."""

    def __init__(self, n: int, bits: int, low: np.ndarray, high: np.ndarray, ones: np.ndarray, zeros: np.ndarray):
        self.n, self.bits, self.low, self.high, self.ones, self.zeros = n, bits, low, high, ones, zeros

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = values.astype(_U)
        n = len(values)
        top = int(values[-1]) + 1 if n else 1
        bits = max(0, (top // max(n, 1)).bit_length() - 1)
        part = values & _U((1 << bits) - 1)
        place = np.arange(n, dtype=np.int64) * bits
        word, offset = place >> 6, (place & 63).astype(_U)
        low = np.zeros((n * bits >> 6) + 2, _U)
        if n and bits:
            first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            low[word[first]] = np.add.reduceat(part << offset, first)
            over = np.flatnonzero(offset + _U(bits) > 64)
            low[word[over] + 1] += part[over] >> (_U(64) - offset[over])
        place = (values >> _U(bits)).astype(np.int64) + np.arange(n)
        length = (int(place[-1]) if n else 0) + 2
        flags = np.zeros(-(-length // 64) * 64, np.uint8)
        flags[place] = 1
        high = np.packbits(flags, bitorder="little").view(_U)
        ones = np.concatenate([[0], np.cumsum(np.bitwise_count(high), dtype=np.int64)])
        kind = np.int32 if len(ones) < 1 << 25 else np.int64
        return cls(n, bits, low, high, ones.astype(kind), (np.arange(len(ones)) * 64 - ones).astype(kind))

    def arrays(self, name: str) -> dict[str, np.ndarray]:
        return {f"{name}.size": np.array([self.n, self.bits]), f"{name}.low": self.low, f"{name}.high": self.high, f"{name}.ones": self.ones, f"{name}.zeros": self.zeros}

    @classmethod
    def load(cls, arrays: dict[str, np.ndarray], name: str) -> EliasFano:
        n, bits = arrays[f"{name}.size"].tolist()
        return cls(n, bits, *(arrays[f"{name}.{x}"] for x in ("low", "high", "ones", "zeros")))

    def _part(self, i: np.ndarray) -> np.ndarray:
        if not self.bits:
            return np.zeros(len(i), _U)
        place = i * self.bits
        word, offset = place >> 6, (place & 63).astype(_U)
        upper = np.where(offset > 0, self.low[word + 1] << (_U(64) - np.maximum(offset, _U(1))), _U(0))
        return (self.low[word] >> offset | upper) & _U((1 << self.bits) - 1)

    def access(self, i: np.ndarray) -> np.ndarray:
        return ((_select(self.high, self.ones, i, False) - i).astype(_U) << _U(self.bits)) | self._part(i)

    def find(self, values: np.ndarray) -> np.ndarray:
        """The places of values, or -1: successor search."""
        out = np.full(len(values), -1, np.int64)
        if not self.n:
            return out
        high = (values >> _U(self.bits)).astype(np.int64)
        live = np.flatnonzero((values >> _U(self.bits)) < _U(self.zeros[-1]))  # as many zeros there are
        high, wanted = high[live], values[live] & _U((1 << self.bits) - 1)
        ends = _select(self.high, self.zeros, high, True) - high
        begins = np.zeros(len(high), np.int64)
        inner = high > 0
        begins[inner] = _select(self.high, self.zeros, high[inner] - 1, True) - (high[inner] - 1)
        ends = np.minimum(ends, self.n)
        stop = ends.copy()
        busy = np.flatnonzero(begins < ends)
        while len(busy):
            middle = (begins[busy] + ends[busy]) >> 1
            less = self._part(middle) < wanted[busy]
            begins[busy] = np.where(less, middle + 1, begins[busy])
            ends[busy] = np.where(less, ends[busy], middle)
            busy = busy[begins[busy] < ends[busy]]
        some = np.flatnonzero(begins < stop)
        hit = some[self._part(begins[some]) == wanted[some]]
        out[live[hit]] = begins[hit]
        return out


def save(uri: str, arrays: dict[str, np.ndarray]) -> None:
    """One file: a header, then the arrays at multiples of 64 bytes."""
    spots, at = {}, 0
    for name, a in arrays.items():
        spots[name] = [a.dtype.str, at, len(a)]
        at += -(-a.nbytes // 64) * 64
    header = json.dumps(spots).encode()
    header += b" " * (-(len(header) + 8) % 64)
    write_bytes(uri, len(header).to_bytes(8, "little"), header, *(x for a in arrays.values() for x in (a.tobytes(), b"\0" * (-a.nbytes % 64))))


def _entry(uri: str) -> tuple[dict[str, np.ndarray], dict[str, EliasFano], int]:
    """A file's arrays, the sequences made of them, and the bytes that they hold: none where
    the file system is a mounted one and the file is mapped into memory. A worker forgets the
    files it has had longest beyond HELD_FILES and HELD_BYTES."""
    kept = worker_cache("lm-files")
    if uri not in kept:
        files, path = open_fs(uri)
        if files.type_name == "local":
            data, held = np.asarray(np.memmap(path, np.uint8, "r")), 0
        else:
            with files.open_input_file(path) as file:
                data = np.frombuffer(file.read(), np.uint8)
            held = len(data)
        size = int.from_bytes(data[:8].tobytes(), "little")
        spots = json.loads(data[8 : 8 + size].tobytes())
        arrays = {n: data[8 + size + at : 8 + size + at + np.dtype(d).itemsize * k].view(d) for n, (d, at, k) in spots.items()}
        while kept and (len(kept) >= HELD_FILES or held + sum(x[2] for x in kept.values()) > HELD_BYTES):
            kept.pop(next(iter(kept)))
        kept[uri] = arrays, {}, held
    return kept[uri]


def mapped(uri: str) -> dict[str, np.ndarray]:
    return _entry(uri)[0]


def _part_of(uri: str, name: str) -> EliasFano:
    arrays, sequences, _ = _entry(uri)
    if name not in sequences:
        sequences[name] = EliasFano.load(arrays, name)
    return sequences[name]


def log_of(q: np.ndarray) -> np.ndarray:
    return q.astype(np.float64) / -STEPS


def quantised(p: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore"):
        return np.minimum(np.round(-np.log10(p) * STEPS), 65535).astype(np.uint16)


class Trie:
    """The shards of the levels built so far. Ids: 0 to V - 1 are words, V marks a text's
    start, -1 is unknown. A pair's place counts through all shards."""

    def __init__(self, shards: int):
        self.shards = shards
        self.levels: list[list[str]] = []
        self.words = np.zeros(shards + 1, np.int64)  # words before each shard
        self.pairs = np.zeros(shards + 1, np.int64)
        self.total = 0
        self.deals = list(range(shards))  # the key by which each shard's counts are shuffled

    @property
    def size(self) -> int:
        return int(self.words[-1])

    def shard_of_hash(self, h: np.ndarray) -> np.ndarray:
        return ((h >> _U(32)) * _U(self.shards) >> _U(32)).astype(np.int64)

    def base_of_shard(self, k: np.ndarray | int) -> np.ndarray:
        return (-(-(np.asarray(k, np.int64) << 32) // self.shards)).astype(_U) << _U(32)

    def shard_of(self, ids: np.ndarray) -> np.ndarray:
        """The start mark goes with the last shard."""
        return np.minimum(np.searchsorted(self.words, ids, "right") - 1, self.shards - 1)

    def _by_shard(self, shard: np.ndarray, there: Callable[[int, np.ndarray], None]) -> None:
        order = np.argsort(shard.astype(np.uint16) if self.shards <= 1 << 16 else shard, kind="stable")
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(shard[order])) + 1, [len(order)]])
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if b > a:
                there(int(shard[order[a]]), order[a:b])

    def word_ids(self, hashes: np.ndarray) -> np.ndarray:
        known, back = np.unique(hashes, return_inverse=True)
        out = np.full(len(known), -1, np.int64)

        def look(k: int, at: np.ndarray) -> None:
            if self.levels[0][k]:
                found = _part_of(self.levels[0][k], "words").find(known[at] - self.base_of_shard(k))
                out[at] = np.where(found >= 0, found + self.words[k], -1)

        self._by_shard(self.shard_of_hash(known), look)
        return out[back]

    def word_counts(self, ids: np.ndarray) -> np.ndarray:
        """0 for unknown ones."""
        out = np.zeros(len(ids), np.int64)

        def look(k: int, at: np.ndarray) -> None:
            out[live[at]] = mapped(self.levels[0][k])["counts"][ids[live[at]] - self.words[k]]

        live = np.flatnonzero(ids >= 0)
        self._by_shard(self.shard_of(ids[live]), look)
        return out

    def unigram(self, counts: np.ndarray) -> np.ndarray:
        return (counts + 0.5) / (self.total + 0.5 * (self.size + 1))

    def pair_places(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """The places of pairs in level 2, or -1."""
        out = np.full(len(first), -1, np.int64)
        live = np.flatnonzero((first >= 0) & (second >= 0))
        a, b = first[live], second[live]

        def look(k: int, at: np.ndarray) -> None:
            if self.levels[1][k]:
                found = _part_of(self.levels[1][k], "keys").find((a[at] - self.words[k]).astype(_U) << _U(32) | b[at].astype(_U))
                out[live[at]] = np.where(found >= 0, found + self.pairs[k], -1)

        self._by_shard(self.shard_of(a), look)
        return out

    def of_pairs(self, name: str, places: np.ndarray, level: int = 1) -> np.ndarray:
        """A column of level 2 (or one of level 3 that has an entry for each pair)."""
        out = np.zeros(len(places), np.int64)

        def look(k: int, at: np.ndarray) -> None:
            if self.levels[level][k]:
                out[at] = mapped(self.levels[level][k])[name][places[at] - self.pairs[k]]

        self._by_shard(np.searchsorted(self.pairs, places, "right") - 1, look)
        return out

    def of_contexts(self, name: str, ids: np.ndarray) -> np.ndarray:
        """Of words as contexts: `backoff`, or `pointers`, the place of the first successor."""
        out = np.zeros(len(ids), np.int64)

        def look(k: int, at: np.ndarray) -> None:
            if self.levels[1][k]:
                own = ids[at] - self.words[k]
                out[at] = _part_of(self.levels[1][k], name).access(own).astype(np.int64) + self.pairs[k] if name == "pointers" else mapped(self.levels[1][k])[name][own]

        self._by_shard(self.shard_of(ids), look)
        return out

    def triple_places(self, pair: np.ndarray, relative: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether triples are in level 3, and their quantised probabilities."""
        found, prob = np.zeros(len(pair), bool), np.zeros(len(pair), np.int64)

        def look(k: int, at: np.ndarray) -> None:
            if self.levels[2][k]:
                place = _part_of(self.levels[2][k], "keys").find((pair[at] - self.pairs[k]).astype(_U) << _U(32) | relative[at].astype(_U))
                hit = place >= 0
                found[at[hit]] = True
                prob[at[hit]] = mapped(self.levels[2][k])["probs"][place[hit]]

        self._by_shard(np.searchsorted(self.pairs, pair, "right") - 1, look)
        return found, prob


def tokens(column) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all tokens of a text column, an end after each row, and n + 1 offsets."""
    hashes, offsets = hashed_words(column)
    n = len(offsets) - 1
    ends = offsets + np.arange(n + 1)
    out = np.full(ends[-1], END, _U)
    out[np.arange(len(hashes)) + np.repeat(np.arange(n), np.diff(offsets))] = hashes
    return out, ends


def _before(ids: np.ndarray, offsets: np.ndarray, start: int) -> np.ndarray:
    """The id before each token; `start` before a row's first."""
    out = np.empty(len(ids), np.int64)
    out[1:] = ids[:-1]
    out[offsets[:-1]] = start
    return out


RUN = "shard int, deal int, n long, keys binary, counts binary"
SHARD = "shard int, path string, n long, total long"


def pack_run(keys: np.ndarray, counts: np.ndarray) -> tuple[bytes, bytes]:
    """Sorted keys as differences; bytes of equal weight together, which compress well."""
    planes = lambda a: np.ascontiguousarray(a.view(np.uint8).reshape(len(a), -1).T).tobytes()
    return planes(np.diff(keys, prepend=_U(0))), planes(counts.astype(np.int64))


def unpack_run(n: int, keys: bytes, counts: bytes) -> tuple[np.ndarray, np.ndarray]:
    back = lambda b, d: np.ascontiguousarray(np.frombuffer(b, np.uint8).reshape(8, n).T).view(d).ravel()
    return np.cumsum(back(keys, _U), dtype=_U), back(counts, np.int64)


def merge(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def even_keys(spark: SparkSession, n: int) -> list[int]:
    """A key for each of n shards, such that hashing deals each to a partition of its own of n."""
    tried = spark.range(64 * n).select(F.col("id").cast("int").alias("key")).groupBy(F.pmod(F.hash("key"), F.lit(n)).alias("at")).agg(F.min("key").alias("key"))
    found = {row["at"]: row["key"] for row in tried.collect()}
    return [found.get(k, -1 - k) for k in range(n)]


def _counter(grams: Callable[[pa.Array], Iterator[tuple[np.ndarray, np.ndarray]]], deals: list[int]):
    """Counts what `grams` gives (shards and keys of a column's n-grams); a shard's counts
    leave a task as one sorted run, or a few if there are very many."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        size = 0

        def send() -> Iterator[pa.RecordBatch]:
            for shard, runs in held.items():
                keys, counts = merge(*map(np.concatenate, zip(*runs, strict=True)))
                packed = pack_run(keys, counts)
                yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([deals[shard]], pa.int32()), pa.array([len(keys)], pa.int64()), pa.array([packed[0]], pa.binary()), pa.array([packed[1]], pa.binary())], ["shard", "deal", "n", "keys", "counts"])
            held.clear()

        for batch in slices(batches, "text", PIECE):
            shard, keys = grams(batch.column("text"))
            order = np.lexsort((keys, shard))
            shard, keys = shard[order], keys[order]
            first = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]) | (shard[1:] != shard[:-1])])) if len(keys) else np.zeros(0, np.int64)
            counts = np.diff(np.append(first, len(keys)))
            shard, keys = shard[first], keys[first]
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(shard)) + 1, [len(shard)]])
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if b > a:
                    held.setdefault(int(shard[a]), []).append((keys[a:b], counts[a:b]))
            size += len(keys)
            if size > SPILL:
                yield from send()
                size = 0
        yield from send()

    return count


def _level(docs: DataFrame, trie: Trie, folder: str, grams, build) -> list:
    """Counts n-grams of docs and builds a level's shards; a row for each."""

    def shard(key: tuple, runs: pa.Table) -> pa.Table:
        k = runs.column("shard")[0].as_py()
        parts = [unpack_run(*row) for row in zip(*(runs.column(c).to_pylist() for c in ("n", "keys", "counts")), strict=True)]
        keys, counts = merge(*map(np.concatenate, zip(*parts, strict=True)))
        arrays, n, total = build(k, keys, counts)
        path = fresh_name(folder, k)
        save(path, arrays)
        return pa.table({"shard": pa.array([k], pa.int32()), "path": pa.array([path]), "n": pa.array([n], pa.int64()), "total": pa.array([total], pa.int64())})

    def fresh_name(folder: str, k: int) -> str:
        import uuid

        return f"{folder}/{k}-{uuid.uuid4().hex}.trie"  # a task that runs again leaves the first one's file unread

    runs = docs.select("text").mapInArrow(_counter(grams, trie.deals), RUN)
    rows = runs.groupBy("deal").applyInArrow(shard, SHARD).collect()
    paths = [""] * trie.shards
    for row in rows:
        paths[row["shard"]] = row["path"]
    trie.levels.append(paths)
    return rows


def _offsets(rows: list, shards: int) -> np.ndarray:
    sizes = np.zeros(shards, np.int64)
    for row in rows:
        sizes[row["shard"]] = row["n"]
    return np.concatenate([[0], np.cumsum(sizes)])


def train(docs: DataFrame, folder: str, shards: int | None = None, discount: float = DISCOUNT) -> Trie:
    """Builds the trie of docs' texts under `folder`. Shards: as many as shuffle partitions,
    so they stay of a size as both grow with the input."""
    trie = Trie(shards or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    trie.deals = even_keys(docs.sparkSession, trie.shards)

    def words(column) -> tuple[np.ndarray, np.ndarray]:
        hashes, _ = tokens(column)
        return trie.shard_of_hash(hashes), hashes

    def build_words(k: int, keys: np.ndarray, counts: np.ndarray):
        return EliasFano.of(keys - trie.base_of_shard(k)).arrays("words") | {"counts": counts}, len(keys), int(counts.sum())

    rows = _level(docs, trie, f"{folder}/1", words, build_words)
    trie.words, trie.total = _offsets(rows, trie.shards), sum(r["total"] for r in rows)
    if trie.size >= (1 << 32) - 1:
        raise OverflowError("word ids have 32 bits")

    def pairs(column) -> tuple[np.ndarray, np.ndarray]:
        hashes, offsets = tokens(column)
        ids = trie.word_ids(hashes)
        first = _before(ids, offsets, trie.size)
        shard = trie.shard_of(first)
        return shard, (first - trie.words[shard]).astype(_U) << _U(32) | ids.astype(_U)

    def build_pairs(k: int, keys: np.ndarray, counts: np.ndarray):
        n = int(trie.words[k + 1] - trie.words[k]) + (k == trie.shards - 1)
        context = (keys >> _U(32)).astype(np.int64)
        successors = np.bincount(context, minlength=n)
        seen = np.bincount(context, counts, minlength=n)
        rest = np.where(seen > 0, discount * successors / np.maximum(seen, 1), 1.0)
        lower = trie.unigram(trie.word_counts((keys & _U(0xFFFFFFFF)).astype(np.int64)))
        prob = (counts - discount) / seen[context] + rest[context] * lower
        pointers = np.concatenate([[0], np.cumsum(successors)])
        arrays = EliasFano.of(keys).arrays("keys") | EliasFano.of(pointers).arrays("pointers")
        return arrays | {"counts": counts.astype(np.uint32 if counts.max() < 1 << 32 else np.int64), "probs": quantised(prob), "backoff": quantised(rest)}, len(keys), int(counts.sum())

    trie.pairs = _offsets(_level(docs, trie, f"{folder}/2", pairs, build_pairs), trie.shards)

    def triples(column) -> tuple[np.ndarray, np.ndarray]:
        hashes, offsets = tokens(column)
        ids = trie.word_ids(hashes)
        first = _before(ids, offsets, trie.size)
        # Pairs as they stand; a triple is a pair and the one before it, within a row.
        key, back = np.unique(first * (trie.size + 1) + ids, return_inverse=True)
        place = trie.pair_places(key // (trie.size + 1), key % (trie.size + 1))
        pointer = trie.of_contexts("pointers", key // (trie.size + 1))
        inner = np.ones(len(ids), bool)
        inner[offsets[:-1]] = False
        at = np.flatnonzero(inner)
        before, own = place[back[at - 1]], back[at]
        shard = np.searchsorted(trie.pairs, before, "right") - 1
        return shard, (before - trie.pairs[shard]).astype(_U) << _U(32) | (place[own] - pointer[own]).astype(_U)

    def build_triples(k: int, keys: np.ndarray, counts: np.ndarray):
        context = (keys >> _U(32)).astype(np.int64)
        own, n = _part_of(trie.levels[1][k], "keys"), int(trie.pairs[k + 1] - trie.pairs[k])
        seen = mapped(trie.levels[1][k])["counts"][context].astype(np.int64)
        distinct, back = np.unique(context, return_inverse=True)
        second = (own.access(distinct) & _U(0xFFFFFFFF)).astype(np.int64)[back]
        lower = trie.of_pairs("probs", trie.of_contexts("pointers", second) + (keys & _U(0xFFFFFFFF)).astype(np.int64))
        share = (counts - discount) / seen
        rest = np.ones(n)
        np.subtract.at(rest, context, share)
        prob = share + rest[context] * 10 ** log_of(lower)
        backoff = quantised(np.maximum(rest, 1e-12))
        backoff[distinct] = np.maximum(backoff[distinct], 1)  # so 0 says that a pair has no triples
        return EliasFano.of(keys).arrays("keys") | {"probs": quantised(prob), "backoff": backoff}, len(keys), int(counts.sum())

    _level(docs, trie, f"{folder}/3", triples, build_triples)
    return trie


def score_tokens(trie: Trie, ids: np.ndarray, offsets: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """log10 of the model's probability of each token."""
    base = np.log10(trie.unigram(counts))
    if not trie.size:
        return base
    first = _before(ids, offsets, trie.size)
    key, back = np.unique((first + 1) * (trie.size + 2) + ids + 1, return_inverse=True)
    a, b = key // (trie.size + 2) - 1, key % (trie.size + 2) - 1
    place = trie.pair_places(a, b)
    hit = np.flatnonzero(place >= 0)
    log = np.zeros(len(key))
    log[hit] = log_of(trie.of_pairs("probs", place[hit]))
    known = np.flatnonzero((place < 0) & (a >= 0))
    log[known] = log_of(trie.of_contexts("backoff", a[known]))
    relative = np.zeros(len(key), np.int64)
    relative[hit] = place[hit] - trie.of_contexts("pointers", a[hit])
    out = log[back] + np.where(place[back] >= 0, 0.0, base)
    # Triples: the pair before a token is the context.
    rest = np.zeros(len(key))
    rest[hit] = log_of(trie.of_pairs("backoff", place[hit], 2))
    inner = np.ones(len(ids), bool)
    inner[offsets[:-1]] = False
    at = np.flatnonzero(inner)
    out[at] += rest[back[at - 1]]
    at = at[(rest[back[at - 1]] < 0) & (place[back[at]] >= 0)]
    found, prob = trie.triple_places(place[back[at - 1]], relative[back[at]])
    out[at[found]] = log_of(prob[found])
    return out


SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _scorer(trie: Trie):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", PIECE):
            hashes, offsets = tokens(batch.column("text"))
            ids = trie.word_ids(hashes)
            counts = trie.word_counts(ids)
            sums = lambda x: np.add.reduceat(x, offsets[:-1])  # noqa: E731, B023  every row has an end token
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), batch.column("held_out"), pa.array(np.diff(offsets)), pa.array(sums((counts > 0).astype(np.int64))), pa.array(np.full(n, trie.total, np.int64)), pa.array(sums(np.log10(trie.unigram(counts)))), pa.array(sums(score_tokens(trie, ids, offsets, counts)))],
                ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
            )

    return score


def held_out(doc_id: Column | str, folds: int = 5, fold: int = 1) -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds == fold, F.lit(False))


def score(docs: DataFrame, folder: str | None = None) -> DataFrame:
    """The SCORES of doc_id and text, by a model of the rows that aren't held out."""
    spark: SparkSession = docs.sparkSession
    marked = docs.select(F.col("doc_id").cast("long"), "text", held_out("doc_id").alias("held_out"))
    trie = train(marked.filter("NOT held_out"), folder or fresh_dir(spark, "lm"))
    return marked.mapInArrow(_scorer(trie), SCORES)
