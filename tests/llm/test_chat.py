import hashlib

from sparley.llm import chat


def digests(spark, rows, tmp_path, **options):
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, path string")
    return {r["conv_id"]: r.asDict() for r in chat.read_digests(chat.format_conversations(turns, f"file://{tmp_path}/packs", **options)).collect()}


def expected(rows):
    by = {}
    for conv, turn, role, text, _ in rows:
        by.setdefault(conv, []).append((turn is not None, turn, role or "", text or ""))
    out = {}
    for conv, turns in by.items():
        turns.sort(key=lambda t: (t[0], t[1] or 0, t[2], t[3]))
        said = "".join(f"{r}\n{t}\n" for *_, r, t in turns)
        loss = "".join(t for *_, r, t in turns if r == "assistant")
        out[conv] = (len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), sum(len(chat.segment(r, t)[0]) for *_, r, t in turns))
    return out


ROWS = [
    (1, 0, "system", "shared", "x"), (1, 1, "user", "a <|turn|> \\ <|end|>\n", "x"), (1, 2, "assistant", "</s>[INST] ok [/INST]", "x"),
    (2, 0, "system", "shared", "x"), (2, 1, "user", "b", "x"), (2, 2, "assistant", "", "x"), (2, 3, "assistant", None, "x"),
    (3, 0, "system", "shared", "x"), (3, 1, "user", "b", "x"),
    (4, 0, None, "é🎉\\\\<\\s>", "x"), (5, 0, "assistant", "one", "x"), (5, 0, "assistant", "one", "x"), (5, None, "user", "first", "x"),
    (None, 0, "user", "no id", "x"), (6, 0, "assistant", "long " * 9000, "x"),
]


def check(got, rows):
    names = ("n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")
    assert {k: tuple(v[n] for n in names) for k, v in got.items()} == expected(rows)


def test_read_back(spark, tmp_path):
    check(digests(spark, ROWS, tmp_path), ROWS)


def test_small_packs_and_chunks(spark, tmp_path):
    rows = ROWS + [(100, k, "assistant" if k % 2 else "user", f"turn {k}", "x") for k in range(57)] + [(k, 0, "user", "the same start", "x") for k in range(200, 260)]
    check(digests(spark, rows, tmp_path, pack_chars=300, pack_conversations=7, chunk_turns=10, chunk_chars=4000), rows)


def test_empty_table(spark, tmp_path):
    assert digests(spark, [], tmp_path) == {}


def test_escaping_is_reversible():
    for text in ("", "\\", "\\\\", "<s", "<s>", "<<SYS>>", "<</SYS>><s></s>", "[INST][/INST]", "a\\<s>", "<|<|turn|>", "\\n\n"):
        assert chat.unescape(chat.escape(text)) == text
        assert not any(c in chat.escape(text) for c in chat.CONTROLS)


def test_tree_shares_turns_once_and_bounds_attention(spark, tmp_path):
    turns = spark.createDataFrame(ROWS[:9], "conv_id long, turn long, role string, text string, path string").coalesce(1)
    packs = chat.format_conversations(turns, f"file://{tmp_path}/packs").collect()
    texts = "".join(p["text"] for p in packs)
    assert texts.count("shared") == len({id(p) for p in packs if "shared" in p["text"]})
    for p in packs:
        start, end, parent = p["node_start"], p["node_subtree_end"], p["node_parent"]
        for k in range(len(start)):
            ancestors, a = set(), k
            while a >= 0:
                ancestors.add(a)
                a = parent[a]
            assert {j for j in range(len(start)) if start[j] <= start[k] < end[j]} == ancestors
            assert p["node_position"][k] == sum(p["node_length"][j] for j in ancestors - {k})


def tree(packs):
    """Number of nodes, and each conversation's turns from its packs and those that `ancestry` names."""
    rows = packs.collect()
    ends = {bytes(r["prefix"]): r for r in chat.ancestry(packs).collect()}
    by = {(p["first_conv"], p["first_chunk"]): p for p in rows}
    out = {}

    def spans(p, node):
        """Text and position of a node and its ancestors, in its pack and in earlier ones."""
        path = []
        while node >= 0:
            start, n = p["node_start"][node], p["node_length"][node]
            path.append((p["node_position"][node], p["text"][start : start + n]))
            node = p["node_parent"][node]
        path.reverse()
        if p["prefix"]:
            before = ends[bytes(p["prefix"])]
            parent = by[before["first_conv"], before["first_chunk"]]
            assert bytes(before["before"]) == bytes(parent["prefix"])
            path = spans(parent, before["leaf"]) + path
        return path

    for p in rows:
        for conv, leaf, after in zip(p["conv_ids"], p["conv_leaves"], p["conv_after"], strict=True):
            if after is None:
                path = spans(p, leaf)
                assert [at for at, _ in path] == [sum(len(t) for _, t in path[:k]) for k in range(len(path))]
                out[conv] = "".join(t for _, t in path)
    return sum(len(p["node_start"]) for p in rows), out


def formatted(rows):
    by = {}
    for conv, turn, role, text, _ in rows:
        by.setdefault(conv, []).append((turn, role, text))
    return {c: "".join(chat.segment(r, t)[0] for _, r, t in sorted(x)) for c, x in by.items()}


def distinct_prefixes(rows):
    by = {}
    for conv, turn, role, text, _ in rows:
        by.setdefault(conv, []).append((turn, role, text))
    return len({tuple((r, t) for _, r, t in sorted(x)[: k + 1]) for x in by.values() for k in range(len(x))})


def test_long_conversations_share_their_turns_once(spark, tmp_path):
    rows = [(c, k, "assistant" if k % 2 else "user", f"turn {k}", "x") for c in range(3) for k in range(1500)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, path string").coalesce(1)
    packs = chat.format_conversations(turns, f"file://{tmp_path}/packs")
    n, texts = tree(packs)
    assert n == 1500 and texts == formatted(rows)
    assert packs.filter("length(prefix) = 0").count() == 1


def test_nodes_are_the_distinct_prefixes(spark, tmp_path):
    import random

    chance = random.Random(3)
    rows = []
    for c in range(300):  # a third shares its first turns, of very different depth
        depth = chance.choice([0, 1, 5, 90, 300]) if c % 3 else 300
        own = chance.randrange(1, 6)
        rows += [(c, k, "user", f"shared {k}", "x") for k in range(depth)] + [(c, depth + k, "assistant", f"own {c % 40} {k}", "x") for k in range(own)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, path string").coalesce(1)
    spark.conf.set("spark.sql.shuffle.partitions", "1")  # a partition's first pack repeats what is shared
    try:
        n, texts = tree(chat.format_conversations(turns, f"file://{tmp_path}/packs", chunk_turns=64))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert n == distinct_prefixes(rows) and texts == formatted(rows)


def test_a_long_shared_prompt_is_repeated_seldom(spark, tmp_path):
    prompt = "rule " * 10_000
    rows = [x for c in range(400) for x in ((c, 0, "system", prompt, "x"), (c, 1, "user", f"question {c} " * 30, "x"))]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, path string").coalesce(1)
    packs = chat.format_conversations(turns, f"file://{tmp_path}/packs", pack_chars=1000).collect()
    assert sum(p["text"].count(prompt) for p in packs) <= 4 + 400 * 500 // (chat.PACK_REPEATS * len(prompt)) + 1
