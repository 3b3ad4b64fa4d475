"""Near-duplicate groups by an inverted join over MinHash signature coordinates.

1. Each document's set of shingles gives COORDINATES minima; documents with equal sets
   are one class from here on.
2. Each class is posted under its coordinate-value pairs. A pair of classes links only
   if it agrees in at least MATCHES coordinates, so values that a single class has are
   skipped, and then classes with fewer than MATCHES others left.
3. Of what a class has left, all but MATCHES - 1 pairs are its prefix, rarest first: two
   classes that agree in MATCHES coordinates share a pair of their prefixes.
4. Candidates are pairs from the prefix lists. Only groups are asked for, so a list is
   merged around its leader first: collisions are counted over whole signatures, and the
   pair is confirmed on the full sets. Where a list's classes are all in one group by then,
   nothing is left to find.
5. In lists that still hold several groups all pairs between groups are candidates. Their
   collisions are counted and their sets compared, but for those that can't link: sets that
   do share one of the rarest shingles of each, at places that the sizes bound, so the
   classes of these lists meet under such shingles instead of each with each.

Signatures and sets are read from texts where these are: a row's address (its file and its
place there) says what a later pass wants of it, so no text is shuffled, and of sets only
those that a pair is confirmed with.

At a similarity of 0.75 a pair agrees in fewer than 30 of 64 coordinates with a chance
below 1e-6, and less above it.

Defined results: a null or wordless text has an empty set, is linked with nothing and
its own component; a text of fewer words than a shingle is one shingle; repeated rows
each come back; a null doc_id can be in a class but never names a component of others;
an empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import FILE, ROW, WORD, Sides, addressed, discard, fresh_dir, hashed_words, materialise, mix, slices, tidy, write_sides

SHINGLE = 5
COORDINATES = 64
MATCHES = 30
LINK_PERCENT = 75

_FACTORS = np.random.Generator(np.random.PCG64(11)).integers(1, 1 << 63, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADDENDS = np.random.Generator(np.random.PCG64(13)).integers(0, 1 << 63, COORDINATES, dtype=np.uint64)
SIGNATURE = f"doc_id long, tie long, {FILE} long, {ROW} long, n_shingles long, fp binary, sig array<long>"
SETS = "cid long, shingles array<long>"


def shingle_sets(column, words: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of each row as sorted 64-bit hashes, and n + 1 offsets."""
    hashes, offsets = hashed_words(column)
    counts = np.diff(offsets)
    wide = np.maximum(counts - words + 1, (counts > 0).astype(np.int64))
    begins = np.concatenate([[0], np.cumsum(wide)])
    # A window over the whole run of words; those that would run over a row's end are left out.
    padded = np.concatenate([hashes, np.zeros(words, np.uint64)])
    width = np.minimum(counts, words)
    row = np.repeat(np.arange(len(counts)), wide)
    at = np.arange(begins[-1]) - begins[row] + offsets[row]
    value = np.full(len(at), 0x51ED270B9, np.uint64)
    for k in range(words):
        inside = k < width[row]
        value = np.where(inside, mix(value * np.uint64(0x9E3779B97F4A7C15) + padded[np.minimum(at + k, len(padded) - 1)]), value)
    # Sorted within each row, equal ones once.
    order = np.lexsort((value, row))
    value, row = value[order], row[order]
    first = np.ones(len(value), bool)
    first[1:] = (value[1:] != value[:-1]) | (row[1:] != row[:-1])
    value, row = value[first], row[first]
    return value, np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(counts)))]).astype(np.int64)


def _list_of(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values.view(np.int64)))


def _prints(values: np.ndarray, offsets: np.ndarray) -> list[bytes | None]:
    """128 bits of a set; null for the empty one."""
    data = values.tobytes()
    return [hashlib.blake2b(data[8 * a : 8 * b], digest_size=16).digest() if b > a else None for a, b in zip(offsets[:-1], offsets[1:], strict=True)]


def _signer(words: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            values, offsets = shingle_sets(batch.column("text"), words)
            sizes = np.diff(offsets)
            some = np.flatnonzero(sizes)
            minima = np.empty((len(some), COORDINATES), np.uint64)
            for k in range(COORDINATES if len(some) else 0):
                v = values * _FACTORS[k] + _ADDENDS[k]
                v ^= v >> np.uint64(29)
                minima[:, k] = np.minimum.reduceat(v, offsets[some])
            # The coordinate goes into the top six bits, so a pair is one number.
            minima = (minima >> np.uint64(6)) | (np.arange(COORDINATES, dtype=np.uint64) << np.uint64(58))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc_id", "tie", FILE, ROW)), pa.array(sizes.astype(np.int64)), pa.array(_prints(values, offsets), pa.binary()), _list_of(minima.ravel(), np.concatenate([[0], np.cumsum((sizes > 0) * COORDINATES)]))],
                ["doc_id", "tie", FILE, ROW, "n_shingles", "fp", "sig"],
            )

    return sign


def _setter(words: int, folder: str):
    sides = Sides(folder)

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            found, cid = sides.find(*(whole.column(c).to_numpy(zero_copy_only=False) for c in (FILE, ROW)))
            wanted = whole.filter(pa.array(found)).append_column("cid", pa.array(cid[found]))
            for batch in slices([wanted], "text"):
                values, offsets = shingle_sets(batch.column("text"), words)
                yield pa.RecordBatch.from_arrays([batch.column("cid"), _list_of(values, offsets)], ["cid", "shingles"])

    return sets


def sets_of(docs: DataFrame, classes: DataFrame, words: int) -> DataFrame:
    """cid, shingles and size of classes (cid and their rows' addresses), read from the rows'
    texts in another pass; no text is shuffled."""
    folder = fresh_dir(docs.sparkSession, "neardup-wanted")
    write_sides(classes, folder, "cid")
    return docs.select(FILE, ROW, "text").mapInArrow(_setter(words, folder), SETS).withColumn("size", F.size("shingles"))


def components(edges: DataFrame) -> DataFrame:
    """v and l, the smallest vertex reachable, for the vertices of edges a, b (longs).

    Smallest labels spread over edges and jump along labels until none changes.
    """
    both = materialise(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "cc-edges")
    labels = materialise(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("l")).withColumnRenamed("a", "v"), "cc-labels")
    while True:
        near = both.join(labels.withColumnsRenamed({"v": "b", "l": "m"}), "b").groupBy("a").agg(F.min("m").alias("m"))
        spread = labels.join(near, labels.v == near.a).select("v", "l", F.least("l", "m").alias("m"))
        jump = labels.select(F.col("v").alias("m"), F.col("l").alias("j"))
        moved = materialise(spread.join(jump, "m", "left").select("v", "l", F.least("m", F.coalesce("j", "m")).alias("n")), "cc-labels")
        labels = moved.select("v", F.col("n").alias("l"))
        if moved.filter("l <> n").isEmpty():
            return labels


def _same_coordinates(a: str, b: str) -> Column:
    return F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda x: x))


def merged(labels: DataFrame, edges: DataFrame) -> DataFrame:
    """labels (cid, l) after edges (a, b): only labels that an edge joins change."""
    if edges.isEmpty():
        return labels
    of = lambda c, name: labels.select(F.col("cid").alias(c), F.col("l").alias(name))
    found = components(edges.join(of("a", "la"), "a").join(of("b", "lb"), "b").filter("la <> lb").select(F.col("la").alias("a"), F.col("lb").alias("b")))
    return labels.join(found.withColumnRenamed("l", "to"), F.col("l") == F.col("v"), "left").select("cid", F.coalesce("to", "l").alias("l"))


def link_classes(docs: DataFrame, classes: DataFrame, words: int = SHINGLE, percent: int = LINK_PERCENT, matches: int = MATCHES) -> DataFrame:
    """cid and l, the group, of the classes that share enough coordinates with others; those
    that don't are groups of their own."""
    posted = classes.select("cid", F.explode("sig").alias("pair"))
    common = posted.groupBy("pair").agg(F.count("*").alias("n")).filter("n > 1")
    left = posted.join(common, "pair").groupBy("cid").agg(F.sort_array(F.collect_list(F.struct("n", "pair"))).alias("pairs"), F.sum("n").alias("central")).filter(F.size("pairs") >= matches)
    prefix = F.slice("pairs", F.lit(1), F.size("pairs") - (matches - 1))
    lists = materialise(left.select("cid", "central", F.explode(F.transform(prefix, lambda x: x.pair)).alias("pair")), "neardup-lists")
    candidates = materialise(classes.join(lists.select("cid").distinct(), "cid", "left_semi").select("cid", FILE, ROW, "sig"), "neardup-candidates")
    at, signed = candidates.select("cid", FILE, ROW), candidates.select("cid", "sig")

    def agreeing(pairs: DataFrame) -> DataFrame:
        """The pairs a, b whose whole signatures collide often enough."""
        of = lambda c, name: signed.select(F.col("cid").alias(c), F.col("sig").alias(name))
        return materialise(pairs.join(of("a", "sa"), "a").join(of("b", "sb"), "b").filter(_same_coordinates("sa", "sb") >= matches).select("a", "b"), "neardup-pairs")

    def linked(pairs: DataFrame, a_sets: DataFrame, b_sets: DataFrame) -> DataFrame:
        """The pairs whose sets are as alike as asked."""
        of = lambda sets, c, name: sets.select(F.col("cid").alias(c), F.col("shingles").alias(name))
        full = pairs.join(of(a_sets, "a", "xa"), "a").join(of(b_sets, "b", "xb"), "b")
        both = F.size(F.array_intersect("xa", "xb"))
        return materialise(full.filter(100 * both >= percent * (F.size("xa") + F.size("xb") - both)).select("a", "b"), "neardup-links")

    def wanted(pairs: DataFrame, *sides: str) -> DataFrame:
        ids = pairs.select(F.col(sides[0]).alias("cid"))
        for c in sides[1:]:
            ids = ids.unionByName(pairs.select(F.col(c).alias("cid")))
        return sets_of(docs, at.join(ids.distinct(), "cid", "left_semi"), words)

    # Around leaders: the class whose values are the most common ones leads a list. Each class
    # meets the leader that most of its lists have, then, if still apart, its other leaders.
    leaders = lists.groupBy("pair").agg(F.max(F.struct("central", "cid")).alias("x")).select("pair", F.col("x.cid").alias("b"))
    met = materialise(lists.join(leaders, "pair").filter("cid <> b").groupBy(F.col("cid").alias("a"), "b").agg(F.count("*").alias("n")), "neardup-met")
    first = agreeing(met.groupBy("a").agg(F.max(F.struct("n", "b")).alias("x")).select("a", F.col("x.b").alias("b")))
    edges = linked(first, wanted(first, "a"), wanted(first, "b"))
    labels = materialise(merged(at.select("cid", F.col("cid").alias("l")), edges), "neardup-labels")
    of = lambda c, name: labels.select(F.col("cid").alias(c), F.col("l").alias(name))
    apart = agreeing(met.join(of("a", "la"), "a").join(of("b", "lb"), "b").filter("la <> lb").select("a", "b"))
    discard(met, first, edges)
    if not apart.isEmpty():
        edges = linked(apart, wanted(apart, "a"), wanted(apart, "b"))
        labels = materialise(merged(labels, edges), "neardup-labels")
    # Lists that still hold several groups: all links between these.
    mixed = lists.join(labels, "cid").groupBy("pair").agg(F.min("l").alias("low"), F.max("l").alias("high")).filter("low <> high").select("pair")
    open_ = materialise(lists.join(mixed, "pair", "left_semi").select("cid").distinct(), "neardup-open")
    if not open_.isEmpty():
        sets = materialise(sets_of(docs, at.join(open_, "cid", "left_semi"), words), "neardup-sets")
        pairs = agreeing(_meeting(sets.join(labels, "cid"), percent))
        labels = materialise(merged(labels, linked(pairs, sets, sets)), "neardup-labels")
        discard(sets, pairs)
    discard(lists, candidates, open_)
    return labels


def _meeting(sets: DataFrame, percent: int) -> DataFrame:
    """Pairs a, b among sets (cid, shingles, size, l) of different groups l that can link.

    Two sets that link share one of the rarest shingles of each: of size s, one of the
    first s - ceil(s * percent / 100) + 1. Where in that order the shared one stands bounds
    what the two have in common. In a shingle's list only those outside its largest group
    look for partners, so a group of copies isn't paired with itself.
    """
    each = sets.select("cid", "l", "size", F.explode("shingles").alias("x"))
    counts = each.groupBy("x").agg(F.count("*").alias("n"))
    ranked = each.join(counts, "x").withColumn("at", F.row_number().over(Window.partitionBy("cid").orderBy("n", "x")))
    prefix = ranked.filter((F.col("n") > 1) & (F.col("at") <= F.floor(F.col("size") * (100 - percent) / 100) + 1)).select("x", "cid", "l", "size", "at")
    prefix = materialise(prefix, "neardup-prefix")
    by_group = prefix.groupBy("x", "l").agg(F.count("*").alias("n"))
    large = by_group.groupBy("x").agg(F.max(F.struct("n", "l")).alias("g"), F.count("*").alias("groups")).filter("groups > 1").select("x", F.col("g.l").alias("most"))
    # As a table, so that the join's sides are plain exchanges, which can be split where a shingle is hot.
    large = materialise(large, "neardup-large")
    here = materialise(prefix.join(large, "x"), "neardup-here")
    discard(prefix, large)
    seekers = here.filter("l <> most").select("x", F.col("cid").alias("a"), F.col("l").alias("la"), F.col("size").alias("sa"), F.col("at").alias("ia"))
    found = here.select("x", F.col("cid").alias("b"), F.col("l").alias("lb"), F.col("size").alias("sb"), F.col("at").alias("ib"))
    possible = f"la <> lb AND {100 + percent} * (1 + least(sa - ia, sb - ib)) >= {percent} * (sa + sb)"
    pairs = seekers.join(found, "x").filter(possible)
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _labelled(rows: DataFrame, words: int, percent: int, matches: int) -> DataFrame:
    """doc_id, n_shingles, fp, tie, address, label and component (the label's smallest id) of
    each of `rows`, which have addresses."""
    docs = rows.select(F.col("doc_id").cast("long").alias("doc_id"), "text", FILE, ROW)
    signed = materialise(docs.withColumn("tie", F.xxhash64("text")).mapInArrow(_signer(words), SIGNATURE), "neardup-signatures")
    found = materialise(signed.drop("sig"), "neardup-rows")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", FILE, ROW, "sig")).alias("x")
    classes = signed.filter("fp IS NOT NULL").groupBy("fp").agg(first).select("fp", F.col("x.doc_id").alias("rep"), F.col(f"x.{FILE}").alias(FILE), F.col(f"x.{ROW}").alias(ROW), F.col("x.sig").alias("sig"), F.monotonically_increasing_id().alias("cid"))
    classes = materialise(classes, "neardup-classes")
    discard(signed)
    links = link_classes(docs, classes, words, percent, matches).withColumnRenamed("cid", "v")
    named = materialise(classes.select("cid", "fp", "rep").join(links, F.col("cid") == links.v, "left").select("fp", "rep", F.coalesce("l", "cid").alias("l")), "neardup-named")
    discard(classes, links)
    lowest = named.groupBy("l").agg(F.min("rep").alias("component"))
    by_set = named.join(lowest, "l").select(F.col("fp").alias("of"), F.col("l").alias("label"), "component")
    return found.join(by_set, found.fp == by_set.of, "left").drop("of")


def group(docs: DataFrame, words: int = SHINGLE, percent: int = LINK_PERCENT, matches: int = MATCHES) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for each row of docs (doc_id, text)."""
    component = F.coalesce("component", "doc_id")
    return _labelled(addressed(docs.select("doc_id", "text")), words, percent, matches).select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def _keeper(folder: str, names: list[str]):
    sides = Sides(folder)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, _ = sides.find(*(batch.column(c).to_numpy(zero_copy_only=False) for c in (FILE, ROW)))
            stays = found | ~batch.column("__dup_words").to_numpy(zero_copy_only=False)
            yield batch.select(names).filter(pa.array(stays))
        tidy()

    return keep


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of docs for each component, one of its smallest doc_id (of several such rows
    one of the smallest set's digest, then of the smallest text's digest); rows with an empty
    set all stay. The same columns as docs. Which rows stay is told by their addresses."""
    rows = addressed(docs)
    found = _labelled(rows, SHINGLE, LINK_PERCENT, MATCHES)
    # A component without any id has rows of null alone.
    chosen = found.filter("fp IS NOT NULL AND doc_id <=> component").groupBy("label").agg(F.min(F.struct("fp", "tie", FILE, ROW)).alias("x")).select("x.*")
    folder = fresh_dir(docs.sparkSession, "neardup-kept")
    write_sides(chosen, folder)
    discard(found)
    return rows.withColumn("__dup_words", F.coalesce(F.col("text").rlike(WORD), F.lit(False))).mapInArrow(_keeper(folder, docs.columns), docs.schema)
