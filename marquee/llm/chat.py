"""Chat formatting into prefix trees: turns shared by the starts of conversations are emitted once.

A turn becomes ``<|im_start|>role\\ntext<|im_end|>\\n``, the two marks as tokens of their own, the rest by a
byte-level vocabulary.  ``<|`` in a text or role gets a backslash between its characters (one more
where there are some), so no text holds a mark; reading back takes it away again.

Conversations are sorted by the digests of the starts where they part from others, which brings equal starts together.  A turn
is a node of the tree of its first turn; a tree's tokens stand depth-first in one stream.  Each node
has its place in the stream, the position of its first token in its conversations, and the stretches
of the stream before it that it may attend to, which are its ancestors.  Trees of any size are laid
out by sums in two steps; a first turn that a third of all conversations share is counted on the map
side and dealt to several tasks where conversations look it up.

A conversation's turns meet in one task, sorted, and an iterator carries digests, places and what was read
from turn to turn, so no row or batch holds a conversation.  Turns go by ``turn`` (missing
last), then role and text; repeated rows are repeated turns.  A null text or role is empty, a null
conversation id is one conversation, an empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import join_groups, join_salted, running_sum, stage_rows
from marquee.operators.ranking import number_rows

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: how the vocabulary's texts are cut into words.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"
START, END = "<|im_start|>", "<|im_end|>"
LEARNED = "assistant"
BUCKET_ROWS = 20_000
_READ = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
                   ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])
_ATTENDS = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
TURN = re.compile(re.escape(START) + r"(.*?)\n(.*?)" + re.escape(END) + r"\n", re.S)


def escape(text: str) -> str:
    return re.sub(r"<(\\*)\|", r"<\1\\|", text)


def unescape(text: str) -> str:
    return re.sub(r"<(\\*)\\\|", r"<\1|", text)


def escape_role(role: str) -> str:
    """A role has no line break in the output: backslashes are doubled, line breaks written out."""
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def read_ranks(path: str = VOCABULARY) -> dict[bytes, int]:
    """Read a vocabulary of ranked byte strings; the file is read on the driver."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Tokens:
    """Turns to tokens and back; the marks follow the vocabulary's last rank."""

    def __init__(self, ranks: dict[bytes, int]):
        import tiktoken

        top = max(ranks.values()) + 1
        self.start, self.end = top, top + 1
        self.coder = tiktoken.Encoding("chat", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={START: top, END: top + 1})

    def plain(self, text: str) -> list[int]:
        return self.coder.encode_ordinary(text)

    def turn(self, role: str, text: str) -> tuple[list[int], int, int]:
        """The turn's tokens and the stretch of them that is learned."""
        head = [self.start, *self.plain(escape_role(role)), *self.plain("\n")]
        body = self.plain(escape(text))
        learned = len(body) if role == LEARNED else 0
        return [*head, *body, self.end, *self.plain("\n")], len(head), len(head) + learned

    def text(self, tokens: list[int]) -> str:
        return self.coder.decode_bytes(tokens).decode()


def _starts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest of every start of every conversation, one row per turn; a conversation's turns come in order."""
    last, depth, before, tree = None, 0, b"", b""
    for batch in batches:
        rows = []
        for conv, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv", "role", "text"))):
            if conv != last:
                last, depth, before, tree = conv, 0, b"", b""
            role, parent = role.encode(), before or None
            before = hashlib.blake2b(before + len(role).to_bytes(8, "big") + role + text.encode(), digest_size=16).digest()
            tree = tree or before
            rows.append((depth, before, parent, tree))
            depth += 1
        kinds = (pa.int32(), pa.binary(), pa.binary(), pa.binary())
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in ("conv", "conv_id", "role", "text")), *(pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds))],
            names=["conv", "conv_id", "role", "text", "depth", "node", "parent", "tree"])


def conversations(rows: DataFrame) -> DataFrame:
    """One row per turn with the digest of the conversation up to it; staged.

    ``conv`` (the id as text, empty if missing), ``conv_id, role, text, depth, node`` (digest), ``parent`` (that of the
    turn before), ``tree`` (that of the first turn).
    """
    turns = rows.select(
        F.coalesce(F.col("conv_id").cast("bigint").cast("string"), F.lit("")).alias("conv"), F.col("conv_id").cast("bigint").alias("conv_id"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), "turn")
    return stage_rows(turns.repartition("conv").sortWithinPartitions("conv", F.asc_nulls_last("turn"), "role", "text")
                      .drop("turn").mapInArrow(_starts, "conv string, conv_id bigint, role string, text string, depth int, node binary, "
                                                        "parent binary, tree binary"), "chat-turns")


def tokenized(turns: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """One row per distinct start of conversations, its last turn tokenized; staged.

    ``node, parent, tree, depth, convs`` that share it, ``tokens``, ``loss_from, loss_to`` (tokens to learn), ``n_tokens``
    """
    ranks = read_ranks(vocabulary)
    names = ["node", "parent", "tree", "depth", "convs"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Tokens(ranks)
        for batch in batches:
            done = [tokens.turn(r, t) for r, t in zip(batch.column("role").to_pylist(), batch.column("text").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names),
                 pa.array([d[0] for d in done], pa.list_(pa.int32())), pa.array([d[1] for d in done], pa.int64()),
                 pa.array([d[2] for d in done], pa.int64()), pa.array([len(d[0]) for d in done], pa.int64())],
                names=[*names, "tokens", "loss_from", "loss_to", "n_tokens"])

    # A digest has one turn, one depth, one parent and one tree, so any row of it will do.
    nodes = turns.groupBy("node").agg(
        F.first("parent").alias("parent"), F.first("tree").alias("tree"), F.first("depth").alias("depth"),
        F.count(F.lit(1)).alias("convs"), F.first(F.struct("role", "text")).alias("turn"))
    return stage_rows(nodes.select(*names, F.col("turn.role").alias("role"), F.col("turn.text").alias("text")).mapInArrow(
        run, "node binary, parent binary, tree binary, depth int, convs bigint, tokens array<int>, loss_from bigint, loss_to bigint, "
             "n_tokens bigint"), "chat-nodes")


def numbered(turns: DataFrame, nodes: DataFrame) -> DataFrame:
    """``no, conv_id, depth, node``: turns of conversations numbered so that equal starts stand together; staged.

    Conversations are sorted by their heads, the nodes that fewer conversations share than the one before: up to the
    first different head two conversations are the same, and there are no more heads than conversations that part.
    """
    counts = nodes.select("node", "parent", "convs")
    above = counts.select(F.col("node").alias("parent"), F.col("convs").alias("above"))
    later = join_groups(counts.filter("parent is not null"), above, "parent", "above").filter("above > convs")
    heads = stage_rows(counts.filter("parent is null").select("node", "convs").unionByName(later.select("node", "convs")), "chat-heads")
    led = (join_groups(turns.select("conv", "depth", "node"), heads, "node", "convs").groupBy("conv")
           .agg(F.transform(F.array_sort(F.collect_list(F.struct("depth", "node"))), lambda h: h["node"]).alias("heads")))
    sizes = turns.groupBy("conv").agg(F.first("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_turns"))
    order = stage_rows(number_rows(led.join(sizes, "conv"), [F.col("heads"), F.col("conv")], "no").drop("heads"), "conversation-order")
    return stage_rows(join_groups(turns.select("conv", "depth", "node"), order, "conv", "n_turns")
                      .select("no", "conv_id", "depth", "node"), "chat-order")


def tree_nodes(order: DataFrame, nodes: DataFrame) -> DataFrame:
    """The nodes' places: ``node, tree, depth, convs, n_tokens, first_no`` and ``start`` in the tree's stream; staged.

    The order of ``first_no`` and ``depth`` is depth-first.
    """
    firsts = order.groupBy("node").agg(F.min("no").alias("first_no"))
    bucketed = nodes.select("node", "tree", "depth", "convs", "n_tokens").join(firsts, "node").withColumn(
        "bucket", F.floor(F.col("first_no") / BUCKET_ROWS))
    bucketed = stage_rows(bucketed, "chat-firsts")
    return stage_rows(running_sum(bucketed, ["tree"], "bucket", [F.col("first_no"), F.col("depth")], "n_tokens", "start")
                      .drop("bucket"), "chat-places")


def steps(order: DataFrame, places: DataFrame) -> DataFrame:
    """One row per turn of a conversation, where it stands in its tree's stream; staged.

    ``no, conv_id, depth, node, tree, start, stop, convs`` and ``own``: whether the conversation is its node's first.
    """
    placed = join_groups(order, places.select("node", "tree", "first_no", "start", "n_tokens", "convs"), "node", "convs")
    return stage_rows(placed.select(
        "no", "conv_id", "depth", "node", "tree", "start", (F.col("start") + F.col("n_tokens")).alias("stop"), "convs",
        (F.col("no") == F.col("first_no")).alias("own")), "chat-steps")


def paths(placed: DataFrame) -> DataFrame:
    """``no, conv_id, spans``: where a conversation's turns stand in its tree's stream, in order, as one row; the query does not need it."""
    spans = F.array_sort(F.collect_list(F.struct("depth", "start", "stop")))
    return placed.groupBy("no").agg(F.first("conv_id").alias("conv_id"), spans.alias("spans"))


def walked(seen: list[tuple[int, int]], start: int, stop: int) -> None:
    """Add a turn to the stretches of the stream that a conversation has taken; touching ones become one."""
    if seen and seen[-1][1] == start:
        start = seen.pop()[0]
    seen.append((start, stop))


def _layout(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Position and attended stretches of every node, from the turns of its first conversation in order."""
    names = ["node", "tree", "start", "depth", "convs"]
    last, position, seen = None, 0, []
    for batch in batches:
        kept, positions, attends = [], [], []
        columns = (batch.column(c).to_pylist() for c in ("no", "start", "stop", "own"))
        for i, (no, start, stop, own) in enumerate(zip(*columns)):
            if no != last:
                last, position, seen = no, 0, []
            if own:
                kept.append(i)
                positions.append(position)
                attends.append([{"start": a, "stop": b} for a, b in seen])
            walked(seen, start, stop)
            position += stop - start
        rows = batch.take(pa.array(kept, pa.int64()))
        yield pa.RecordBatch.from_arrays([*(rows.column(c) for c in names), pa.array(positions, pa.int64()), pa.array(attends, _ATTENDS)],
                                         names=[*names, "position", "attends"])


def streams(nodes: DataFrame, placed: DataFrame) -> DataFrame:
    """The trees' streams, one row per node, to be read in the order of ``tree, start``; staged.

    ``tree, start, depth, convs, tokens, loss_from, loss_to, position`` (of the first token; the others count on) and
    ``attends``, the stretches of the stream that its tokens see besides their own node's up to themselves, none
    touching another.
    """
    laid = (placed.select("no", "depth", "node", "tree", "start", "stop", "convs", "own").repartition("no")
            .sortWithinPartitions("no", "depth").mapInArrow(
                _layout, "node binary, tree binary, start bigint, depth int, convs bigint, position bigint, "
                         "attends array<struct<start:bigint,stop:bigint>>"))
    return stage_rows(laid.join(nodes.select("node", "tokens", "loss_from", "loss_to"), "node").select(
        "tree", "start", "depth", "convs", "tokens", "loss_from", "loss_to", "position", "attends"), "chat-streams")


def read_back(placed: DataFrame, laid: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """Every conversation from the streams at its turns' places: counts and digests of what the tokens decode to.

    ``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars``.  A turn whose place, position or
    attended stretches in the stream are not those of the conversation's turns before it is an error.
    """
    ranks = read_ranks(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Tokens(ranks)
        last, conv, whole, learned, counts, position, seen = None, None, None, None, [0, 0, 0], 0, []

        def result() -> dict:
            return dict(zip(_READ.names, (conv, counts[0], whole.hexdigest(), counts[1], learned.hexdigest(), counts[2])))

        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if row["no"] != last:
                    if last is not None:
                        out.append(result())
                    last, conv, whole, learned, counts, position, seen = (
                        row["no"], row["conv_id"], hashlib.sha256(), hashlib.sha256(), [0, 0, 0], 0, [])
                start, stop = row["place"]["start"], row["stop"]
                attends = [(a["start"], a["stop"]) for a in row["attends"]]
                if row["position"] != position or attends != seen or stop - start != len(row["tokens"]) or row["depth"] != counts[0]:
                    raise ValueError(f"conversation {conv}: turn {row['depth']} is not where its stream has it")
                walked(seen, start, stop)
                position += stop - start
                text = tokens.text(row["tokens"])
                for role, body in TURN.findall(text):
                    whole.update(f"{unescape_role(role)}\n{unescape(body)}\n".encode())
                    counts[0] += 1
                part = unescape(tokens.text(row["tokens"][row["loss_from"]:row["loss_to"]]))
                learned.update(part.encode())
                counts[1] += len(part)
                counts[2] += len(text)
            yield pa.RecordBatch.from_pylist(out, _READ)
        if last is not None:
            yield pa.RecordBatch.from_pylist([result()], _READ)

    place = F.struct("tree", "start").alias("place")
    joined = join_salted(placed.select("no", "conv_id", "depth", place, "stop"), laid.select(
        place, "convs", "tokens", "loss_from", "loss_to", "position", "attends"), "place", "convs")
    return (joined.select("no", "conv_id", "depth", "place", "stop", "tokens", "loss_from", "loss_to", "position", "attends")
            .repartition("no").sortWithinPartitions("no", "depth").mapInArrow(
                run, "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"))


def format_conversations(rows: DataFrame, vocabulary: str = VOCABULARY) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Streams of the trees, each conversation's spans in them, and what reading the streams back gives."""
    turns = conversations(rows)
    nodes = tokenized(turns, vocabulary)
    order = numbered(turns, nodes)
    placed = steps(order, tree_nodes(order, nodes))
    laid = streams(nodes, placed)
    return laid, paths(placed), read_back(placed, laid, vocabulary)
