"""SentencePiece encoding and decoding by suffix-array matching.

The distinct units (words with their leading space) of a batch that the worker hasn't met
are concatenated and indexed by a suffix array. Each piece is looked up by binary search,
which gives the range of its occurrences; the occurrences are edges of a lattice over the
text. Edges are sorted by the position where they end, and relaxed in that order.

The model's pieces come from merges by priority, not from a unigram lattice, so a shortest
path wouldn't give its encoding. What the relaxation keeps at a position is the last piece
of the encoding up to there. An edge extends it if merging the two pieces' characters ends
in just those two pieces; exactly one edge does so at each position, which makes the path
the model's own encoding. Whether two pieces stand side by side is found by undoing their
merges in reverse order, for all edges of a step at once.

Defined results: a null or empty text has no pieces; characters without a piece are
written as the pieces of their UTF-8 bytes, and so is U+2581, which stands for a space
within the model, so that decoding gives every text back exactly; runs of spaces of any
length are merged as the model merges them; repeated rows are encoded alike; an empty
table gives an empty result.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import slices, worker_cache

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
#: Ends a unit in the indexed text; larger than any character.
GAP = 0x110000
INDEX_CHARS = 1 << 20
CACHED_UNITS = 1_200_000


@dataclass
class Pieces:
    """Tables of a merge model. Piece ids that are not text (controls, bytes, runs of
    spaces) take no part in matching."""

    text: list[str]  # as written by decoding: a space for U+2581
    ids: np.ndarray  # of the matched pieces, sorted by text
    chars: np.ndarray  # their code points, padded with -1
    lengths: np.ndarray
    priority: np.ndarray  # by id; -1 for single characters
    left: np.ndarray  # by id: the two pieces whose merge makes it
    right: np.ndarray
    pairs: np.ndarray  # sorted keys a * n + b of pairs that merge, and the priority of what they make
    pair_priority: np.ndarray
    byte0: int
    dummy: bool
    run_score: dict[str, float]
    word: str  # pattern of the units

    @property
    def unknown(self) -> int:
        return len(self.text)


def simulate(symbols: list[str], score: Callable[[str], float | None]) -> tuple[list[str], tuple[str, str] | None]:
    """Merges neighbours while any two make a piece, highest score first, then leftmost.
    Returns the pieces and the last merge."""
    n = len(symbols)
    after, before, live = list(range(1, n + 1)), list(range(-1, n - 1)), list(symbols)
    heap: list[tuple] = []

    def offer(i: int) -> None:
        if i >= 0 and after[i] < n and (s := score(live[i] + live[after[i]])) is not None:
            heapq.heappush(heap, (-s, i, live[i], live[after[i]]))

    for i in range(n):
        offer(i)
    last = None
    while heap:
        _, i, a, b = heapq.heappop(heap)
        if live[i] != a or after[i] >= n or live[after[i]] != b:
            continue
        last, j = (a, b), after[i]
        live[i], live[j], after[i] = a + b, "", after[j]
        if after[j] < n:
            before[after[j]] = i
        offer(before[i])
        offer(i)
    return [x for x in live if x], last


def load(path: str = MODEL) -> Pieces:
    """Reads a merge model with byte pieces; runs on the driver."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    n = model.get_piece_size()
    names = [model.id_to_piece(i) for i in range(n)]
    plain = [i for i in range(n) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    if model.piece_to_id("<0x00>") == model.unk_id() or any(SPACE in names[i].lstrip(SPACE) for i in plain):
        raise ValueError("a merge model with byte pieces, and spaces only at the start of a piece, is needed")
    text = [x.replace(SPACE, " ") for x in names]
    id_of = {text[i]: i for i in plain}
    run_score = {text[i]: model.get_score(i) for i in plain if not text[i].strip(" ") and len(text[i]) > 1}
    score = {text[i]: model.get_score(i) for i in plain if len(text[i]) > 1 and not text[i].startswith("  ")}
    order = {t: k for k, t in enumerate(sorted(score, key=lambda t: (-score[t], id_of[t])))}
    priority, left, right = (np.full(n + 1, -1, np.int64) for _ in range(3))
    matched = [i for i in plain if len(text[i]) == 1 and text[i] != SPACE]
    for t in score:
        pieces, last = simulate(list(t), score.get)
        if pieces == [t] and all(len(x) > 1 or x in id_of for x in last):
            i = id_of[t]
            matched.append(i)
            priority[i], left[i], right[i] = order[t], id_of[last[0]], id_of[last[1]]
    pairs = {}
    for t in score:
        for k in range(1, len(t)):
            a, b = id_of.get(t[:k]), id_of.get(t[k:])
            if a is not None and b is not None:
                pairs[a * (n + 1) + b] = order[t]
    matched.sort(key=lambda i: text[i])
    width = max(len(text[i]) for i in matched)
    chars = np.full((len(matched), width), -1, np.int64)
    for row, i in enumerate(matched):
        chars[row, : len(text[i])] = [ord(c) for c in text[i]]
    keys = np.array(sorted(pairs), np.int64)
    apart = "\n" if not any("\n" in text[i] for i in plain if len(text[i]) > 1) else ""
    word = f"{apart}+| *[^ {apart}]+| +" if apart else " *[^ ]+| +"
    dummy = model.encode_as_pieces("a")[0].startswith(SPACE)
    return Pieces(text, np.array(matched, np.int64), chars, np.array([len(text[i]) for i in matched]), priority, left, right, keys, np.array([pairs[k] for k in keys.tolist()], np.int64), model.piece_to_id("<0x00>"), dummy, run_score, word)


def suffix_array(codes: np.ndarray, width: int) -> np.ndarray:
    """The positions of codes in the order of their next `width` codes, by prefix doubling."""
    _, rank = np.unique(codes, return_inverse=True)
    rank = rank.astype(np.int64) + 1
    done = 1
    order = np.argsort(rank)
    while done < width:
        key = rank * (int(rank.max()) + 1)
        key[:-done] += rank[done:]
        order = np.argsort(key)
        ordered = key[order]
        step = np.empty(len(key), np.int64)
        step[0] = 1
        step[1:] = ordered[1:] != ordered[:-1]
        rank = np.empty(len(key), np.int64)
        rank[order] = np.cumsum(step)
        done *= 2
        if rank.max() == len(rank):
            break
    return order


def find_pieces(codes: np.ndarray, order: np.ndarray, pieces: Pieces) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row of the piece, and first and last index in the suffix array, of pieces that occur."""
    present = np.zeros(GAP + 2, bool)
    present[codes] = True
    present[-1] = True  # the padding
    rows = np.flatnonzero(present[pieces.chars].all(axis=1))
    chars, lengths = pieces.chars[rows], pieces.lengths[rows]
    width = chars.shape[1]
    padded = np.concatenate([codes, np.full(width, GAP, codes.dtype)])
    inside = np.arange(width) < lengths[:, None]
    bounds = []
    for upper in (False, True):
        low, high = np.zeros(len(rows), np.int64), np.full(len(rows), len(order))
        while (busy := np.flatnonzero(low < high)).size:
            middle = (low[busy] + high[busy]) // 2
            there = padded[order[middle][:, None] + np.arange(width)]
            apart = (there != chars[busy]) & inside[busy]
            k = apart.argmax(axis=1)
            at = np.arange(len(busy))
            less = apart[at, k] & (there[at, k] < chars[busy][at, k])
            same = ~apart[at, k]
            up = less | same if upper else less
            low[busy] = np.where(up, middle + 1, low[busy])
            high[busy] = np.where(up, high[busy], middle)
        bounds.append(low)
    found = bounds[0] < bounds[1]
    return rows[found], bounds[0][found], bounds[1][found]


def side_by_side(a: np.ndarray, b: np.ndarray, pieces: Pieces) -> np.ndarray:
    """Whether merging the characters of piece a and then piece b ends in a and b."""
    out = np.ones(len(a), bool)
    at, limit = np.arange(len(a)), np.full(len(a), np.iinfo(np.int64).max)
    while len(at):
        key = a * (len(pieces.text) + 1) + b
        k = np.minimum(np.searchsorted(pieces.pairs, key), len(pieces.pairs) - 1)
        merges = (pieces.pairs[k] == key) & (pieces.pair_priority[k] < limit)
        out[at[merges]] = False
        pa_, pb_ = pieces.priority[a], pieces.priority[b]
        go = ~merges & ((pa_ >= 0) | (pb_ >= 0))
        at, a, b, pa_, pb_ = at[go], a[go], b[go], pa_[go], pb_[go]
        undo_left = pa_ > pb_  # of equal merges the right one came last
        limit = np.where(undo_left, pa_, pb_ + 1)
        a, b = np.where(undo_left, pieces.right[a], a), np.where(undo_left, b, pieces.left[b])
    return out


def match_units(units: list[str], pieces: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """The piece ids of all units, and n + 1 offsets; `unknown` stands for characters without a piece."""
    lengths = np.array([len(u) for u in units], np.int64)
    chars = np.frombuffer("".join(units).encode("utf-32-le"), np.uint32).astype(np.int64)
    n = len(units)
    begins = np.concatenate([[0], np.cumsum(lengths + 1)])
    codes = np.full(begins[-1], GAP, np.int64)
    unit = np.repeat(np.arange(n), lengths)
    codes[np.arange(len(chars)) + unit] = chars
    order = suffix_array(codes, pieces.chars.shape[1])
    rows, low, high = find_pieces(codes, order, pieces)
    counts = high - low
    first = np.concatenate([[0], np.cumsum(counts)])
    which = np.repeat(np.arange(len(rows), dtype=np.int32), counts)
    begin = order.astype(np.int32)[np.arange(first[-1]) + (low - first[:-1])[which]]
    piece, length = pieces.ids[rows].astype(np.int32)[which], pieces.lengths[rows].astype(np.int32)[which]
    del which, order
    known = codes == GAP
    known[begin[length == 1]] = True
    lone = np.flatnonzero(~known).astype(np.int32)
    begin = np.concatenate([begin, lone])
    piece = np.concatenate([piece, np.full(len(lone), pieces.unknown, np.int32)])
    end = begin + np.concatenate([length, np.ones(len(lone), np.int32)])
    # Steps: edges by the place of their end within its unit, all units at once.
    of = np.zeros(len(codes) + 1, np.int64)
    of[begins[1:-1]] = 1
    start = begins.astype(np.int32)[np.cumsum(of)]
    step = end - start[begin]
    by = np.argsort(step)
    begin, piece, end, step = begin[by], piece[by], end[by], step[by]
    last = np.full(len(codes) + 1, -1, np.int64)  # the last piece of the encoding up to here
    prior = np.full(len(codes) + 1, -1, np.int64)  # and where it begins
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(step)) + 1, [len(step)]]) if len(step) else np.zeros(1, np.int64)
    for x, y in zip(cuts[:-1], cuts[1:], strict=True):
        b, p, e = begin[x:y].astype(np.int64), piece[x:y].astype(np.int64), end[x:y]
        here = last[b]
        opens = b == start[b]
        fits = opens.copy()
        if not opens.all():
            inner = np.flatnonzero(~opens)
            key, back = np.unique(here[inner] * (len(pieces.text) + 1) + p[inner], return_inverse=True)
            fits[inner] = side_by_side(key // (len(pieces.text) + 1), key % (len(pieces.text) + 1), pieces)[back]
        last[e[fits]], prior[e[fits]] = p[fits], b[fits]
    # Walk back from every unit's end at once.
    at, alive = begins[:-1] + lengths, np.arange(n)
    ids, units_of = [], []
    while len(alive):
        ids.append(last[at])
        units_of.append(alive)
        at = prior[at]
        go = at > begins[alive]
        at, alive = at[go], alive[go]
    ids, units_of = np.concatenate(ids)[::-1], np.concatenate(units_of)[::-1]
    by = np.argsort(units_of, kind="stable")
    return ids[by], np.concatenate([[0], np.cumsum(np.bincount(units_of, minlength=n))])


class Encoder:
    """Encodes texts; remembers units it has met."""

    def __init__(self, pieces: Pieces):
        self.pieces, self.known, self.runs = pieces, {}, {}
        self.word = re.compile(pieces.word)
        self.flat, self.offsets = np.zeros(0, np.int32), np.zeros(1, np.int64)
        self.space = next((i for i, t in enumerate(pieces.text) if t == " " and pieces.priority[i] < 0), -1)
        self.id_of_run = {t: i for i, t in enumerate(pieces.text) if t and not t.strip(" ")}

    def run(self, n: int) -> list[int]:
        if n not in self.runs:
            self.runs[n] = [self.id_of_run[x] for x in simulate([" "] * n, self.pieces.run_score.get)[0]]
        return self.runs[n]

    def _learn(self, units: list[str]) -> None:
        if len(self.known) + len(units) > CACHED_UNITS:
            self.known, self.flat, self.offsets = {}, np.zeros(0, np.int32), np.zeros(1, np.int64)
        flat, counts, begin = [self.flat], [], 0
        while begin < len(units):
            size, stop = 0, begin
            while stop < len(units) and (stop == begin or size + len(units[stop]) < INDEX_CHARS):
                size += len(units[stop])
                stop += 1
            part = units[begin:stop]
            spaces = [len(u) - len(u.lstrip(" ")) for u in part]
            cores = [u[max(0, s - 1) :] if s < len(u) else "" for u, s in zip(part, spaces, strict=True)]
            ids, offsets = match_units(cores, self.pieces)
            odd = np.zeros(len(part), bool)  # units that need more than their matched pieces
            odd[[k for k, x in enumerate(spaces) if x > 1 or x == len(part[k])]] = True
            odd[np.searchsorted(offsets, np.flatnonzero(ids == self.pieces.unknown), "right") - 1] = True
            lengths, done = np.diff(offsets), 0
            for k in np.flatnonzero(odd).tolist():
                own = self._odd(part[k], spaces[k], ids[offsets[k] : offsets[k + 1]])
                flat += [ids[done : offsets[k]].astype(np.int32), own.astype(np.int32)]
                lengths[k], done = len(own), offsets[k + 1]
            flat.append(ids[done:].astype(np.int32))
            counts.append(lengths)
            begin = stop
        self.flat = np.concatenate(flat)
        self.offsets = np.concatenate([self.offsets, self.offsets[-1] + np.cumsum(np.concatenate(counts))])
        for u in units:
            self.known[u] = len(self.known)

    def _odd(self, unit: str, spaces: int, ids: np.ndarray) -> np.ndarray:
        """The pieces of a unit from those of its core, which has one leading space at most."""
        if spaces == len(unit):
            ids = np.array(self.run(spaces))
        elif spaces > 1:
            joins = ids[0] == self.space
            ids = np.concatenate([self.run(spaces if joins else spaces - 1), ids[1:] if joins else ids])
        return self._spell(unit, ids) if (ids == self.pieces.unknown).any() else ids

    def _spell(self, unit: str, ids: np.ndarray) -> np.ndarray:
        """ids with the characters that no piece has as the pieces of their bytes."""
        out, at = [], 0
        for i in ids.tolist():
            if i == self.pieces.unknown:
                out += [self.pieces.byte0 + x for x in unit[at].encode()]
                at += 1
            else:
                out.append(i)
                at += len(self.pieces.text[i])
        return np.array(out)

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The piece ids of all texts, and n + 1 offsets."""
        find, lead = self.word.findall, " " if self.pieces.dummy else ""
        units, counts = [], []
        for text in texts:
            found = find(lead + text) if text else []
            units += found
            counts.append(len(found))
        new = set(units).difference(self.known)
        if new:
            if len(self.known) + len(new) > CACHED_UNITS:
                new = set(units)
            self._learn(sorted(new))
        codes = np.fromiter(map(self.known.__getitem__, units), np.int64, len(units))
        begin, size = self.offsets[codes], self.offsets[codes + 1] - self.offsets[codes]
        ends = np.concatenate([[0], np.cumsum(size)])
        ids = self.flat[np.arange(ends[-1]) - np.repeat(ends[:-1] - begin, size)]
        return ids, ends[np.concatenate([[0], np.cumsum(np.array(counts, np.int64))])]


class Decoder:
    def __init__(self, pieces: Pieces):
        self.table = [t.encode() for t in pieces.text]
        for k in range(256):
            self.table[pieces.byte0 + k] = bytes([k])
        self.dummy = pieces.dummy

    def decode(self, ids: list[int]) -> str:
        out = b"".join(map(self.table.__getitem__, ids)).decode("utf-8", "replace")
        return out.removeprefix(" ") if self.dummy else out


def _encoder(pieces: Pieces, key: str):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = worker_cache("sentencepiece")
        if key not in kept:
            kept[key] = Encoder(pieces), Decoder(pieces)
        encoder, decoder = kept[key]
        for batch in slices(batches, "text"):
            texts = batch.column("text").to_pylist()
            ids, offsets = encoder.encode(texts)
            flat, cuts = ids.tolist(), offsets.tolist()
            same = [decoder.decode(flat[a:b]) == (t or "") for t, a, b in zip(texts, cuts[:-1], cuts[1:], strict=True)]
            carried = [n for n in batch.schema.names if n not in ("doc_id", "text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), *map(batch.column, carried), pa.array(np.diff(offsets)), pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids)), pa.array(same, pa.bool_())],
                ["doc_id", *carried, "n_pieces", "piece_ids", "round_trip"],
            )

    return encode


def _decoder(pieces: Pieces):
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(pieces)
        for batch in batches:
            texts = [None if x is None else decoder.decode(x) for x in batch.column("piece_ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(texts, pa.string())], ["doc_id", "text"])

    return decode


def encode(docs: DataFrame, model: str = MODEL, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, the columns to carry along, n_pieces, piece_ids and round_trip (whether
    decoding gives the text back) of doc_id and text."""
    pieces = load(model)
    kept = docs.select(F.col("doc_id").cast("long"), *carry, "text")
    made = [T.StructField("n_pieces", T.LongType()), T.StructField("piece_ids", T.ArrayType(T.IntegerType())), T.StructField("round_trip", T.BooleanType())]
    return kept.mapInArrow(_encoder(pieces, model), T.StructType([*kept.drop("text").schema.fields, *made]))


def decode(encoded: DataFrame, model: str = MODEL) -> DataFrame:
    """doc_id and text of doc_id and piece_ids."""
    return encoded.select("doc_id", "piece_ids").mapInArrow(_decoder(load(model)), "doc_id long, text string")
