"""Chat formatting as prefix trees.

Conversations are sorted by their path of turns, so those that share initial turns are
neighbours. A pack is a run of that order, written depth first: each shared turn once,
with the position its text starts at and the end of its subtree. A character (or token)
at i may attend to one at j <= i where i lies before the end of j's subtree: j's turn
is then an ancestor of i's, or the same.

A conversation longer than CHUNK_TURNS turns or CHUNK_CHARS characters goes on in further
chunks. Chunks that follow the same turns are sorted together and merged like
conversations; their pack's `prefix` names the turns before it, positions run on, and
`ancestry` finds the pack and the node that a prefix ends at, whose ancestors all of the
pack's nodes attend to as well.

A pack is written by one task, so it is bounded: by PACK_CONVERSATIONS, and by the
characters that it adds to what its conversations share, PACK_CHARS of them or
PACK_REPEATS times as many as are shared. Turns that more conversations share than a pack
holds are repeated once a pack: of the text at most 1 in PACK_REPEATS + 1 parts, or one
path in PACK_CONVERSATIONS conversations.

A conversation is read in its order by one task, which holds one chunk of it.

Defined results: null texts and roles are empty; a null conv_id is one conversation;
turns tie by role, then text, null first; repeated rows are turns of their own; an empty
table gives no packs. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>\n"
#: Strings that are escaped within roles and texts: the template's own, and those of common templates.
CONTROLS = ("<|turn|>", "<|text|>", "<|end|>", "<|im_start|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
LOSS_ROLE = "assistant"
PACK_CHARS, PACK_REPEATS = 1 << 18, 8
PACK_CONVERSATIONS = 4096
CHUNK_TURNS, CHUNK_CHARS = 128, 1 << 20

_ESCAPED = re.compile(r"\\|" + "|".join(f"{re.escape(c[0])}(?={re.escape(c[1:])})" for c in CONTROLS))
_UNESCAPED = re.compile(r"\\(\\?)")
_SEGMENT = re.compile(re.escape(TURN) + r"(.*?)" + re.escape(TEXT) + r"(.*?)" + re.escape(END), re.DOTALL)

UNIT = "conv_id long, chunk int, prefix binary, after binary, path binary, start long, roles array<string>, texts array<string>"
NODES = {"node_start": pa.int32(), "node_length": pa.int32(), "node_subtree_end": pa.int32(), "node_parent": pa.int32(), "node_position": pa.int64(), "node_loss_start": pa.int32(), "node_loss_end": pa.int32()}
CONVS = {"conv_ids": pa.int64(), "conv_chunks": pa.int32(), "conv_leaves": pa.int32(), "conv_after": pa.binary()}
_SQL = {pa.int32(): "int", pa.int64(): "long", pa.binary(): "binary"}
PACK = "text string, prefix binary, solo boolean, chunks boolean, first_conv long, first_chunk int, " + ", ".join(f"{k} array<{_SQL[t]}>" for k, t in (NODES | CONVS).items())


def escape(text: str) -> str:
    """A backslash goes after the first character of a control string; backslashes are doubled."""
    return _ESCAPED.sub(lambda m: m[0] + "\\", text)


def unescape(text: str) -> str:
    return _UNESCAPED.sub(r"\1", text)


def segment(role: str, text: str) -> tuple[str, int, int]:
    """A formatted turn, and where the text that the model learns begins and ends in it."""
    head, body = f"{TURN}{escape(role)}{TEXT}", escape(text)
    learnt = len(body) if role == LOSS_ROLE else 0
    return f"{head}{body}{END}", len(head), len(head) + learnt


def _units(chunk_turns: int, chunk_chars: int):
    def units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.string())]
        names = ["conv_id", "chunk", "prefix", "after", "path", "start", "roles", "texts"]
        out: list[tuple] = []
        size, open_, conv = 0, False, None

        def begin() -> None:
            nonlocal chunk, start, chars, prefix, path, roles, texts, said
            chunk, start, chars, prefix, path, roles, texts, said = 0, 0, 0, b"", [], [], [], hashlib.blake2b(digest_size=16)

        def flush(last: bool) -> None:
            nonlocal chunk, start, chars, prefix, path, roles, texts, size
            after = said.digest()
            out.append((conv, chunk, prefix, None if last else after, b"".join(path), start, roles, texts))
            size += chars
            start, chunk, chars, prefix, path, roles, texts = start + chars, chunk + 1, 0, after, [], [], []

        def batch_of() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names)

        chunk, start, chars, prefix, path, roles, texts, said = 0, 0, 0, b"", [], [], [], None
        begin()
        for batch in batches:
            for c, role, text in zip(*(batch.column(k).to_pylist() for k in ("conv_id", "role", "text")), strict=True):
                if open_ and c != conv:
                    flush(True)
                    begin()
                elif open_ and (len(roles) >= chunk_turns or chars >= chunk_chars):
                    flush(False)
                conv, open_ = c, True
                roles.append(role or "")
                texts.append(text or "")
                turn = f"{len(roles[-1])}:{len(texts[-1])}:{roles[-1]}{texts[-1]}".encode()
                said.update(turn)
                path.append(hashlib.blake2b(turn, digest_size=8).digest())
                chars += len(segment(roles[-1], texts[-1])[0])
                if size >= 4 << 20 or len(out) >= 10_000:
                    yield batch_of()
                    out, size = [], 0
        if open_:
            flush(True)
        if out:
            yield batch_of()

    return units


def _packer(pack_chars: int, pack_conversations: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["text", "prefix", "solo", "chunks", "first_conv", "first_chunk", *NODES, *CONVS]
        kinds = [pa.string(), pa.binary(), pa.bool_(), pa.bool_(), pa.int64(), pa.int32(), *map(pa.list_, (NODES | CONVS).values())]
        text: list[str] = []
        nodes: list[list] = []
        convs: list[tuple] = []
        stack: list[tuple[str, str, int]] = []  # role, text and node of each open turn
        size, prefix = 0, b""

        def pop(to: int) -> None:
            while len(stack) > to:
                nodes[stack.pop()[2]][2] = size

        def close() -> pa.RecordBatch:
            nonlocal text, nodes, convs, size
            pop(0)
            whole = [c[1] == 0 and c[3] is None for c in convs]
            row = ["".join(text), prefix, any(whole), not all(whole), convs[0][0], convs[0][1], *([x[k] for x in nodes] for k in range(len(NODES))), *([x[k] for x in convs] for k in range(len(CONVS)))]
            text, nodes, convs, size = [], [], [], 0
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, kinds, strict=True)], names)

        for batch in batches:
            for row in batch.to_pylist():
                turns = list(zip(row["roles"], row["texts"], strict=True))
                same = 0
                while same < min(len(turns), len(stack)) and stack[same][:2] == turns[same]:
                    same += 1
                shared = sum(nodes[n][1] for *_, n in stack[:same])
                if convs and (prefix != row["prefix"] or len(convs) >= pack_conversations or size - shared >= max(pack_chars, PACK_REPEATS * shared)):
                    yield close()
                    same = 0
                prefix = row["prefix"]
                pop(same)
                for role, said in turns[same:]:
                    formatted, begin, end = segment(role, said)
                    parent = stack[-1][2] if stack else -1
                    position = nodes[parent][4] + nodes[parent][1] if stack else row["start"]
                    stack.append((role, said, len(nodes)))
                    nodes.append([size, len(formatted), -1, parent, position, size + begin, size + end])
                    text.append(formatted)
                    size += len(formatted)
                convs.append((row["conv_id"], row["chunk"], stack[-1][2], row["after"]))
        if convs:
            yield close()

    return pack


def format_conversations(turns: DataFrame, folder: str, pack_chars: int = PACK_CHARS, pack_conversations: int = PACK_CONVERSATIONS, chunk_turns: int = CHUNK_TURNS, chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """Writes packs of conv_id, turn, role and text as a table at `folder`, and returns it.

    The node_ arrays have an entry for each turn of a pack's tree, depth first: its start
    and length in `text`, the end of its subtree (with its start the attention interval
    over its descendants), its parent's index or -1, the position id of its first
    character, and the span under the loss mask. The conv_ arrays have, for each
    conversation or chunk, the node of its last turn and, where it goes on, the prefix of
    the packs that it goes on in.
    """
    keys = ["conv_id", "turn", "role", "text"]
    units = turns.select(*keys).repartition("conv_id").sortWithinPartitions(*keys).mapInArrow(_units(chunk_turns, chunk_chars), UNIT)
    by = ["prefix", "path", "conv_id", "chunk"]
    packs = units.repartitionByRange(*by).sortWithinPartitions(*by).mapInArrow(_packer(pack_chars, pack_conversations), PACK)
    packs.write.parquet(folder)
    return turns.sparkSession.read.schema(PACK).parquet(folder)


def ancestry(packs: DataFrame) -> DataFrame:
    """prefix, first_conv, first_chunk, leaf, before: for each prefix a pack (by its first
    conversation and chunk) and the node in it that the prefix ends at, whose ancestors and
    itself every node of the prefix's packs attends to, and that pack's own prefix, where
    the earlier turns are."""
    ends = packs.filter("chunks").select("first_conv", "first_chunk", F.col("prefix").alias("before"), F.explode(F.arrays_zip(F.col("conv_after").alias("prefix"), F.col("conv_leaves").alias("leaf"))).alias("x"))
    first = F.min(F.struct("first_conv", "first_chunk", "x.leaf", "before")).alias("y")
    return ends.filter("x.prefix IS NOT NULL").groupBy(F.col("x.prefix").alias("prefix")).agg(first).select("prefix", "y.*")


CHUNK = "conv_id long, chunk int, n_turns long, turns binary, loss_chars long, loss binary, formatted_chars long"
DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
_DIGEST = [("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())]
_CHUNK = [("conv_id", pa.int64()), ("chunk", pa.int32()), ("n_turns", pa.int64()), ("turns", pa.binary()), ("loss_chars", pa.int64()), ("loss", pa.binary()), ("formatted_chars", pa.int64())]


def decode_pack(row: dict) -> Iterator[tuple[int, int, bool, list[tuple[str, str]], list[str], int]]:
    """conv_id, chunk, whether it ends, turns, texts under the loss mask and formatted characters of a pack's conversations."""
    text, parsed = row["text"], []
    for start, length, begin, end in zip(row["node_start"], row["node_length"], row["node_loss_start"], row["node_loss_end"], strict=True):
        role, said = _SEGMENT.fullmatch(text, start, start + length).groups()
        parsed.append(((unescape(role), unescape(said)), unescape(text[begin:end]) if role == LOSS_ROLE else None, length))
    for conv, chunk, node, after in zip(row["conv_ids"], row["conv_chunks"], row["conv_leaves"], row["conv_after"], strict=True):
        path = []
        while node >= 0:
            path.append(parsed[node])
            node = row["node_parent"][node]
        path.reverse()
        yield conv, chunk, after is None, [x[0] for x in path], [x[1] for x in path if x[1] is not None], sum(x[2] for x in path)


def _decoder(digest: bool):
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                out = []
                for conv, chunk, ends, turns, losses, chars in decode_pack(row):
                    if digest != (ends and chunk == 0):
                        continue
                    said, loss = "".join(f"{r}\n{t}\n" for r, t in turns).encode(), "".join(losses)
                    if digest:
                        out.append((conv, len(turns), hashlib.sha256(said).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), chars))
                    else:
                        out.append((conv, chunk, len(turns), said, len(loss), loss.encode(), chars))
                kinds = _DIGEST if digest else _CHUNK
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*out, strict=True), kinds, strict=True)], [n for n, _ in kinds])

    return decode


def _joiner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests conversations from their chunks, which come in order; holds a chunk at a time."""
    out: list[tuple] = []
    open_, conv, sums = False, None, None

    def done() -> tuple:
        n, said, chars, loss, formatted = sums
        return (conv, n, said.hexdigest(), chars, loss.hexdigest(), formatted)

    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            if not open_ or row["conv_id"] != conv:
                if open_:
                    out.append(done())
                open_, conv, sums = True, row["conv_id"], [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            sums[0] += row["n_turns"]
            sums[1].update(row["turns"])
            sums[2] += row["loss_chars"]
            sums[3].update(row["loss"])
            sums[4] += row["formatted_chars"]
    if open_:
        out.append(done())
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*out, strict=True), _DIGEST, strict=True)], [n for n, _ in _DIGEST])


def read_digests(packs: DataFrame) -> DataFrame:
    """The DIGEST columns of each conversation, read back from packs."""
    chunks = packs.filter("chunks").mapInArrow(_decoder(False), CHUNK).repartition("conv_id").sortWithinPartitions("conv_id", "chunk")
    return packs.filter("solo").mapInArrow(_decoder(True), DIGEST).unionByName(chunks.mapInArrow(_joiner, DIGEST))
