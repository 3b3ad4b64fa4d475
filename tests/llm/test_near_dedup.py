import random
import re

from conftest import rows_of

from sparley.llm import near_dedup

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows):
    """Components by comparing all pairs."""
    sets = []
    for _, text in rows:
        w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
        sets.append({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    low = {}
    for k, (i, _) in enumerate(rows):
        low[find(k)] = min(low.get(find(k), i), i)
    return sorted((low[find(k)], i, i == low[find(k)], len(sets[k])) for k, (i, _) in enumerate(rows))


def edited(base, n, chance):
    words = base.split()
    for _ in range(n):
        words[chance.randrange(len(words))] = f"new{chance.randrange(10**6)}"
    return " ".join(words)


def test_matches_brute_force(spark):
    chance = random.Random(5)
    word = lambda: f"w{chance.randrange(400)}"
    bases = [" ".join(word() for _ in range(chance.choice([3, 5, 6, 9, 40, 120, 150]))) for _ in range(60)]
    shared = " ".join(word() for _ in range(60))
    rows = list(enumerate(bases))
    for base in bases[:25]:
        rows += [(len(rows) + k, edited(base, chance.randrange(0, 8), chance)) for k in range(4)]
    hot = " ".join(f"h{k}" for k in range(140))
    rows += [(len(rows) + k, edited(hot, chance.randrange(0, 12), chance)) for k in range(80)]
    rows += [(len(rows) + k, shared + " " + " ".join(word() for _ in range(40))) for k in range(30)]
    rows += [(len(rows), rows[3][1].upper()), (len(rows) + 1, "  ".join(rows[3][1].split())), (len(rows) + 2, ""), (len(rows) + 3, " \n"), (len(rows) + 4, "One two"), (len(rows) + 5, "one TWO")]
    got = near_dedup.group(spark.createDataFrame(rows, "doc_id long, text string"))
    assert rows_of(got.select("component_id", "doc_id", "kept", "n_shingles")) == sorted(brute(rows), key=repr)


def test_edge_cases(spark):
    long = "a b c d e f g"
    rows = [(5, long, 1), (5, long, 2), (2, long, 3), (None, long, 4), (9, None, 5), (7, "x " * 20_000, 6), (8, "x", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, sig int")
    got = {(r["doc_id"], r["component_id"], r["kept"], r["n_shingles"]) for r in near_dedup.group(docs).collect()}
    assert got == {(5, 2, False, 3), (2, 2, True, 3), (None, 2, False, 3), (9, 9, True, 0), (7, 7, True, 1), (8, 8, True, 1)}
    assert near_dedup.group(docs.limit(0)).count() == 0


def test_keep_one_keeps_one_of_each_group(spark):
    rows = [(5, "a b c d e f", 1), (5, "a b c d e f", 2), (2, "a b c d e f", 3), (9, None, 5), (9, None, 5), (8, "x", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept int")
    assert rows_of(near_dedup.keep_one(docs)) == sorted([(2, 3, "a b c d e f"), (9, 5, None), (9, 5, None), (8, 7, "x")], key=repr)


def test_keep_one_keeps_clean_rows_of_null_and_shared_ids(spark):
    clean = [(None, "a b c d e f"), (None, "g h i j k l"), (None, "..."), (None, ""), (7, "m n o p q r"), (7, "s t u v w x"), (7, None), (7, "")]
    docs = spark.createDataFrame([*clean, (None, "g h i j k l"), (7, "m n o p q r"), (8, "s t u v w x")], "doc_id long, text string")
    assert rows_of(near_dedup.keep_one(docs)) == sorted(clean, key=repr)
