"""Quality classification by co-training of two views.

One classifier sees a document's text (hashed words, pairs of neighbouring bytes, which
tell letter case and symbols, and how much it repeats itself), the other its metadata
(source, language, length). Both rest on naive Bayes. In each round either labels those of
all documents that it is sure of, and the other learns from these too: executors score
every document and send back sums over the pseudo-labelled ones by class, of a fixed size
whatever the input's. Calibration on held-out labels turns each view's score into a
probability, and a last calibrated step combines the views. The fitted weights then score
all documents.

Labels are used of at most LABELLED documents, the first by a digest of their id; their
features, one row an id, are all that goes to the driver besides the sums. Pseudo-labels
count as much as the labels of their class, or less while there are fewer of them.

Defined results: a null or empty text leaves the text view neutral; null metadata is a
value of its own, and values not met in fitting are neutral; a doc_id with several labels
has the smallest, one with several rows is learnt from the first of them by features; null
labels are ignored; without labels of both classes every document is kept with probability
one; repeated rows are scored alike; an empty table gives an empty result. Columns of the
input pass through; those named as the results are replaced.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import buffers, hashed_words, slices

LABELLED = 4000
ROUNDS, SURE = 4, 0.98
THRESHOLD = 0.5
WORD_BUCKETS = 1 << 15
BYTE_PAIRS = 1 << 16
META_BUCKETS = 1 << 14
#: Sums are whole numbers of this part of a document, so they don't depend on the order of adding.
UNIT = 1 << 24
#: Numbers of a sum that travel together, and groups of tasks whose sums are added up first.
CHUNK, DEALS = 1024, 512
#: Documents are drawn to neutral as if they had this many more neutral words.
SHRINK = 10
CALIBRATION = 3  # one in so many labelled documents is held out
RESULTS = ("p_text", "p_meta", "p_quality", "kept")
META = ("source", "lang", "n_chars")


def text_features(column) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word buckets and byte pairs of all rows, and n + 1 offsets of each."""
    hashes, word_offsets = hashed_words(column)
    data, offsets = buffers(column)
    if len(data) < 2:
        return (hashes % np.uint64(WORD_BUCKETS)).astype(np.int64), word_offsets, np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    pairs = data[:-1].astype(np.int64) << 8 | data[1:]
    # The pair that starts on a row's last byte would run over its end.
    keep = np.ones(len(pairs), bool)
    last = offsets[1:][np.diff(offsets) > 0] - 1
    keep[last[last < len(pairs)]] = False
    return (hashes % np.uint64(WORD_BUCKETS)).astype(np.int64), word_offsets, pairs[keep], np.concatenate([[0], np.cumsum(np.maximum(np.diff(offsets) - 1, 0))])


def row_means(values: np.ndarray, offsets: np.ndarray, shrink: float = 0.0) -> np.ndarray:
    """The mean of each row's values, drawn to 0 by `shrink` values of 0."""
    sums = np.zeros(len(offsets) - 1)
    some = np.flatnonzero(np.diff(offsets))
    if len(some):
        sums[some] = np.add.reduceat(values, offsets[some])
    return sums / np.maximum(np.diff(offsets) + shrink, 1)


def repetition(words: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Shares of each row's words that equal the word before, or one of the three before."""
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    near = np.zeros(len(words), bool)
    out = []
    for back in (1, 2, 3):
        near[back:] |= (words[back:] == words[:-back]) & (row[back:] == row[:-back])
        if back != 2:
            out.append(row_means(near.astype(float), offsets, SHRINK))
    return np.column_stack(out)


def metadata(batch: pa.RecordBatch) -> np.ndarray:
    """[rows, len(META)]: buckets of source, language and the logarithm of n_chars; a missing
    column is null."""
    out = np.empty((batch.num_rows, len(META)), np.int64)
    for k, name in enumerate(META):
        if name not in batch.schema.names:
            values = ["null"] * batch.num_rows
        elif name == "n_chars":
            values = ["null" if x is None or x < 0 else str(int(2 * np.log2(x + 1))) for x in batch.column(name).to_pylist()]
        else:
            values = ["null" if x is None else f"={x}" for x in batch.column(name).to_pylist()]
        met = {v: zlib.crc32(f"{name}{v}".encode()) % META_BUCKETS for v in set(values)}
        out[:, k] = [k * META_BUCKETS + met[v] for v in values]
    return out


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05, steps: int = 30) -> np.ndarray:
    """Coefficients, the constant first, by Newton's method on columns of equal spread."""
    spread = np.maximum(x.std(axis=0), 1e-9)
    x = np.column_stack([np.ones(len(x)), x / spread])
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + ridge * w
        w = w - np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), gradient)
    w[1:] /= spread
    return w


def logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


def probability(w: np.ndarray, x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(w[0] + x @ w[1:], -30, 30)))


def _ratios(good: np.ndarray, bad: np.ndarray, add: float) -> np.ndarray:
    share = lambda c: (c + add) / (c.sum() + add * len(c))
    return np.log(share(good)) - np.log(share(bad))


@dataclass
class Model:
    words: np.ndarray = field(default_factory=lambda: np.zeros(WORD_BUCKETS))
    pairs: np.ndarray = field(default_factory=lambda: np.zeros(BYTE_PAIRS))
    meta: np.ndarray = field(default_factory=lambda: np.zeros(len(META) * META_BUCKETS))
    text_scale: np.ndarray = field(default_factory=lambda: np.zeros(5))
    meta_scale: np.ndarray = field(default_factory=lambda: np.zeros(2))
    both: np.ndarray = field(default_factory=lambda: np.zeros(3))
    fitted: bool = False

    def views(self, batch: pa.RecordBatch, features: tuple) -> tuple[np.ndarray, np.ndarray]:
        """p_text and p_meta of each row."""
        words, word_offsets, pairs, pair_offsets = features
        if not self.fitted:
            return (np.ones(batch.num_rows),) * 2
        x = np.column_stack([row_means(self.words[words], word_offsets, SHRINK), row_means(self.pairs[pairs], pair_offsets, 5 * SHRINK), repetition(words, word_offsets)])
        return probability(self.text_scale, x), probability(self.meta_scale, self.meta[metadata(batch)].sum(axis=1).reshape(-1, 1))

    def score(self, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """p_text, p_meta and p_quality of each row."""
        text, meta = self.views(batch, text_features(batch.column("text")))
        return text, meta, probability(self.both, np.column_stack([logit(text), logit(meta)])) if self.fitted else text


@dataclass
class Sample:
    """Features of labelled documents: sparse counts as shares of a document, and metadata."""

    rows: list[tuple]  # word buckets, shares, pair codes, shares, metadata buckets, label, what shrinking leaves of either, repetition

    def text_counts(self, chosen: np.ndarray, part: int, size: int) -> np.ndarray:
        at = [self.rows[i][2 * part] for i in chosen]
        share = [self.rows[i][2 * part + 1] for i in chosen]
        return np.bincount(np.concatenate(at), np.concatenate(share), size) if at else np.zeros(size)

    def meta_counts(self, chosen: np.ndarray) -> np.ndarray:
        at = [self.rows[i][4] for i in chosen]
        return np.bincount(np.concatenate(at), minlength=len(META) * META_BUCKETS).astype(float) if at else np.zeros(len(META) * META_BUCKETS)

    def means(self, model: Model) -> tuple[np.ndarray, np.ndarray]:
        x = np.array([[model.words[r[0]] @ r[1] * r[6], model.pairs[r[2]] @ r[3] * r[7], *r[8]] for r in self.rows]).reshape(-1, 4)
        return x, np.array([[model.meta[r[4]].sum()] for r in self.rows]).reshape(-1, 1)


#: Where the parts of a class's sum are: words, byte pairs, metadata, documents told by metadata and by text.
WORDS_AT, PAIRS_AT, META_AT = 0, WORD_BUCKETS, WORD_BUCKETS + BYTE_PAIRS
TOLD_AT = META_AT + len(META) * META_BUCKETS
SUM_SIZE = TOLD_AT + 2


def fit(sample: Sample, tell: Callable[[Model], np.ndarray], rounds: int = ROUNDS) -> Model:
    """tell: the sums [2, SUM_SIZE], bad and good, over what the model's views are sure of."""
    label = np.array([r[5] for r in sample.rows], int)
    known = np.arange(len(label))
    held = known[::CALIBRATION]
    learnt = np.setdiff1d(known, held)
    model = Model()
    if min(len(set(label[held].tolist())), len(set(label[learnt].tolist()))) < 2:
        return model
    model.fitted = True
    classes = [learnt[label[learnt] == c] for c in (0, 1)]
    own = np.zeros((2, SUM_SIZE))
    for c, chosen in enumerate(classes):
        own[c, WORDS_AT:PAIRS_AT] = sample.text_counts(chosen, 0, WORD_BUCKETS)
        own[c, PAIRS_AT:META_AT] = sample.text_counts(chosen, 1, BYTE_PAIRS)
        own[c, META_AT:TOLD_AT] = sample.meta_counts(chosen)
    told = np.zeros((2, SUM_SIZE), np.int64)
    for turn in range(rounds + 1):
        sums = own.copy()
        for c, chosen in enumerate(classes):
            # As much as the labels of the class at most.
            for at, part in ((TOLD_AT, slice(WORDS_AT, META_AT)), (TOLD_AT + 1, slice(META_AT, TOLD_AT))):
                if told[c, at]:
                    sums[c, part] += told[c, part] / UNIT * min(1.0, len(chosen) / (told[c, at] / UNIT))
        bad, good = sums
        model.words = _ratios(100 * good[WORDS_AT:PAIRS_AT], 100 * bad[WORDS_AT:PAIRS_AT], 1.0)
        model.pairs = _ratios(100 * good[PAIRS_AT:META_AT], 100 * bad[PAIRS_AT:META_AT], 0.05)
        model.meta = np.concatenate([_met_ratios(*(v[META_AT + k * META_BUCKETS :][:META_BUCKETS] for v in (good, bad))) for k in range(len(META))])
        x, m = sample.means(model)
        model.text_scale = logistic(x[held], label[held])
        model.meta_scale = logistic(m[held], label[held])
        if turn == rounds:
            break
        before, told = told, tell(model)
        if turn and np.array_equal(before, told):
            break
    text, meta = probability(model.text_scale, x), probability(model.meta_scale, m)
    model.both = logistic(np.column_stack([logit(text[held]), logit(meta[held])]), label[held])
    return model


def _met_ratios(good: np.ndarray, bad: np.ndarray) -> np.ndarray:
    """Ratios of the values that were met; 0 of others."""
    out, met = np.zeros(len(good)), (good > 0) | (bad > 0)
    out[met] = _ratios(good[met], bad[met], 1.0)
    return out


def _row_of(offsets: np.ndarray) -> np.ndarray:
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))


def _teller(model: Model, sure: float, skip: np.ndarray):
    """Sums over the documents that a view is sure of, but for those of the ids `skip`: what
    the text view is sure of tells metadata, and the other way round."""

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, SUM_SIZE), np.int64)
        for batch in slices(batches, "text"):
            words, word_offsets, pairs, pair_offsets = features = text_features(batch.column("text"))
            text, meta = model.views(batch, features)
            own = metadata(batch)
            ids = batch.column("doc_id").fill_null(0).to_numpy()
            open_ = ~(np.isin(ids, skip) & ~batch.column("doc_id").is_null().to_numpy(zero_copy_only=False))
            for c in (0, 1):
                by_text, by_meta = ((p >= sure if c else p <= 1 - sure) & open_ for p in (text, meta))
                for values, offsets, at in ((words, word_offsets, WORDS_AT), (pairs, pair_offsets, PAIRS_AT)):
                    row = _row_of(offsets)
                    mine = by_meta[row]
                    share = np.round(UNIT / np.maximum(np.diff(offsets), 1))[row[mine]]
                    size = (WORD_BUCKETS, BYTE_PAIRS)[at == PAIRS_AT]
                    sums[c, at : at + size] += np.bincount(values[mine], share, size).astype(np.int64)
                sums[c, META_AT:TOLD_AT] += UNIT * np.bincount(own[by_text].ravel(), minlength=TOLD_AT - META_AT)
                sums[c, TOLD_AT:] += UNIT * np.array([by_meta.sum(), by_text.sum()])
        deal = TaskContext.get().partitionId() % DEALS
        for c in (0, 1):
            for k in range(0, SUM_SIZE, CHUNK):
                if sums[c, k : k + CHUNK].any():
                    yield pa.RecordBatch.from_arrays([pa.array([c * SUM_SIZE + k], pa.int32()), pa.array([deal], pa.int32()), pa.array([sums[c, k : k + CHUNK].tobytes()])], ["at", "deal", "sums"])

    return tell


def _added(key: tuple, parts: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(x.as_py(), np.int64) for x in parts.column("sums"))
    return pa.table({"at": pa.array([key[0].as_py()], pa.int32()), "deal": pa.array([0], pa.int32()), "sums": pa.array([total.tobytes()])})


def told_by(docs: DataFrame, model: Model, sure: float, skip: np.ndarray) -> np.ndarray:
    """The sums [2, SUM_SIZE] over all documents. Tasks' sums are added up in two steps, so no
    task takes those of all others."""
    kind = "at int, deal int, sums binary"
    sums = docs.mapInArrow(_teller(model, sure, skip), kind).groupBy("at", "deal").applyInArrow(_added, kind).groupBy("at").applyInArrow(_added, kind)
    out = np.zeros(2 * SUM_SIZE, np.int64)
    for row in sums.collect():
        part = np.frombuffer(row["sums"], np.int64)
        out[row["at"] : row["at"] + len(part)] = part
    return out.reshape(2, -1)


_FEATURES = "doc_id long, words binary, word_shares binary, pairs binary, pair_shares binary, meta binary, label int, shrunk array<double>, repetition array<double>"


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def sparse(values: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, pa.Array]:
        cells, shares = [], []
        for a, b in zip(offsets[:-1], offsets[1:], strict=True):
            v, n = np.unique(values[a:b], return_counts=True)
            cells.append(v.astype(np.int32).tobytes())
            shares.append((n / max(b - a, 1)).astype(np.float32).tobytes())
        return pa.array(cells, pa.binary()), pa.array(shares, pa.binary())

    for batch in slices(batches, "text"):
        words, word_offsets, pairs, pair_offsets = text_features(batch.column("text"))
        shrunk = np.column_stack([n / (n + k) for n, k in ((np.diff(word_offsets), SHRINK), (np.diff(pair_offsets), 5 * SHRINK))])
        lists = lambda x: pa.array(x.tolist(), pa.list_(pa.float64()))
        meta = pa.array([x.tobytes() for x in metadata(batch)], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *sparse(words, word_offsets), *sparse(pairs, pair_offsets), meta, batch.column("label"), lists(shrunk), lists(repetition(words, word_offsets))], ["doc_id", "words", "word_shares", "pairs", "pair_shares", "meta", "label", "shrunk", "repetition"])


def train(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED, rounds: int = ROUNDS, sure: float = SURE) -> Model:
    """A model of docs (doc_id, text and metadata) and labels (doc_id, quality 0 or 1)."""
    order = F.xxhash64("doc_id")
    marks = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.min((F.col("quality") > 0).cast("int")).alias("label"))
    names = [c for c in META if c in docs.columns]
    seen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *names)
    known = F.broadcast(marks.join(seen.select("doc_id"), "doc_id", "left_semi").orderBy(order, "doc_id").limit(labelled))  # so many rows at most
    features = seen.join(known, "doc_id").mapInArrow(_features, _FEATURES)
    one = features.groupBy("doc_id").agg(F.min(F.struct(*features.columns[1:])).alias("x")).select("doc_id", "x.*")
    rows, kinds = {}, (np.int32, np.float32, np.int32, np.float32, np.int64)
    for row in one.collect():
        rows[row["doc_id"]] = (*(np.frombuffer(row[k + 1], t) for k, t in enumerate(kinds)), row["label"], *row["shrunk"], row["repetition"])
    skip = np.array(sorted(rows), np.int64)
    sample = Sample([rows[k] for k in sorted(rows, key=lambda i: (i * 0x9E3779B97F4A7C15 & (1 << 64) - 1, i))])
    return fit(sample, lambda model: told_by(seen, model, sure, skip), rounds)


def _scorer(model: Model, threshold: float):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            text, meta, both = model.score(batch)
            for name, values in zip(RESULTS, (text, meta, both, both >= threshold), strict=True):
                batch = batch.append_column(name, pa.array(values))
            yield batch

    return score


def judge(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **options: float) -> DataFrame:
    """docs with p_text, p_meta, p_quality and kept (p_quality >= threshold)."""
    docs = docs.drop(*RESULTS)
    model = train(docs, labels, **options)
    schema = T.StructType([*docs.schema.fields, *(T.StructField(n, T.DoubleType()) for n in RESULTS[:3]), T.StructField(RESULTS[3], T.BooleanType())])
    return docs.mapInArrow(_scorer(model, threshold), schema)


def _keeper(model: Model, threshold: float):
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            yield batch.filter(pa.array(model.score(batch)[2] >= threshold))

    return keep


def keep(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **options: float) -> DataFrame:
    """The documents that the classifier keeps; the same columns as docs, whatever their names."""
    return docs.mapInArrow(_keeper(train(docs, labels, **options), threshold), docs.schema)
