"""Repair of conversation structure by an automaton that all conversations share from the end.

A conversation is a row of turns with roles system, user, assistant; it is sound when the initials of its
roles read ``(s?(ua)+)?``.  Every turn becomes one symbol of its role and its first fault (blank, duplicate,
truncated), a conversation the signature of its turns.  What repairing costs from a turn on depends on the
rest of the signature and on the grammar state alone, so equal ends are one node: signatures are sorted by
their reversed text, where equal ends stand together, and for every node the cost to go and the best edits
of each of the four grammar states are computed once and kept on a stack until the last signature that
ends in it has passed.  (A node that a border of two partitions cuts is computed in both.)

Signatures come in segments of bounded length, so no conversation is held in one row until its audit, one
character a turn, is put together.  For a segment with others behind it the nodes first give the least
costs between any two states; walking these from a conversation's last segment back gives what each segment
finds behind it, and distinct pairs of segment and costs behind are edited once.

Edits: Keep 0, Rerole 3, Delete 4, Insert an empty turn 3; a truncated turn that stays adds 3; blank and
duplicate turns must go.  Of equally cheap audits the least in ASCII order is taken.

A null in any column reads as one space; rows with a missing id are one conversation.  Turns come in the
order of ``turn`` (missing first), role and text, a repeated row after the one it repeats.  Empty tables give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marquee.llm.common import stage_rows

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
NAMES = {"s": "system", "u": "user", "a": "assistant"}
# Grammar states: nothing yet, after system, after user, after assistant.
STATES = range(4)
LEGAL = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
WANTED = ("u", "u", "a", "u")
# Cost to go of each state after the last turn.
END = (0, 2 * INSERT, INSERT, 0)
FAR = 1 << 40
# Turns of a segment.
SEGMENT = 512
BLANK = " \t\n\x0b\x0c\r"


def damage(rows: DataFrame) -> DataFrame:
    """Damaged copy of ``conv_id, turn, role, text``: drops, empties, strips stops, repeats or reroles turns by hash."""
    key = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    hit = F.crc32(key.cast("binary")) % 20
    text = F.coalesce(F.col("text").cast("string"), F.lit(" "))
    return (rows.select("conv_id", "turn", F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"), text.alias("text"), hit.alias("hit"))
            .filter("hit <> 0")
            .select("conv_id", "turn", F.when(F.col("hit") == 4, "user").otherwise(F.col("role")).alias("role"),
                    F.when(F.col("hit") == 1, "").when(F.col("hit") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
                    F.explode(F.when(F.col("hit") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")).drop("copy"))


def turns(rows: DataFrame) -> DataFrame:
    """One row per turn: ``conv`` (the id as text, empty if missing), ``turn, role, text``, ``nth`` and ``fault``; staged.

    A turn is a duplicate if its role and text were seen earlier in the conversation; ``nth`` counts these, so that of equal
    rows the duplicate comes after the one it repeats.
    """
    body = F.rtrim("text", F.lit(BLANK))
    seen = Window.partitionBy("conv", "role", "digest").orderBy(F.asc_nulls_first("turn"))
    named = rows.select(
        F.coalesce(F.col("conv_id").cast("bigint").cast("string"), F.lit("")).alias("conv"), F.col("turn").cast("bigint").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"))
    return stage_rows(named.withColumn("digest", F.sha2(F.col("text"), 256)).withColumn("nth", F.row_number().over(seen)).select(
        "conv", "turn", "role", "text", "nth",
        F.when(body == "", "blank").when(F.col("nth") > 1, "duplicate")
        .when(~F.substring(body, -1, 1).isin(".", "!", "?"), "truncated").otherwise("").alias("fault")), "repair-turns")


def symbol(role: str, fault: str) -> str:
    """``s u a x`` by the role's initial, capital if truncated; ``-`` for a turn that must go."""
    if fault in ("blank", "duplicate"):
        return "-"
    letter = role[:1] if role[:1] in NAMES else "x"
    return letter.upper() if fault == "truncated" else letter


_SEGMENTS = "conv string, seg bigint, sig string, last boolean, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint"


def _sign(length: int):
    """Arrow function over turns in order to segments of signatures; the last of a conversation has its counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in _SEGMENTS.split(", ")]
        kinds = [pa.string(), pa.int64(), pa.string(), pa.bool_()] + [pa.int64()] * 5
        conv, out = None, []

        def flush(last: bool) -> None:
            gaps = high - low + 1 - distinct if distinct else 0
            out.append((conv, seg, "".join(held), last, *((gaps, *counts.values(), illegal) if last else (None,) * 5)))

        for batch in batches:
            for c, turn, role, fault in zip(*(batch.column(i).to_pylist() for i in ("conv", "turn", "role", "fault"))):
                if c != conv:
                    if conv is not None:
                        flush(True)
                    conv, seg, held, before, low, high, distinct, illegal = c, 0, [], None, None, None, 0, 0
                    counts = {"blank": 0, "duplicate": 0, "truncated": 0}
                if len(held) == length:
                    flush(False)
                    seg, held = seg + 1, []
                held.append(symbol(role, fault))
                if fault:
                    counts[fault] += 1
                if turn is not None and turn != high:
                    low, high, distinct = turn if low is None else low, turn, distinct + 1
                if before is not None and before + role[:1] not in ("su", "ua", "au"):
                    illegal += 1
                before = role[:1]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names=names)
            out = []
        if conv is not None:
            flush(True)
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names=names)

    return run


def node(mark: str, behind: tuple) -> tuple:
    """Cost to go, first edit and state after it for each grammar state of a node, given the costs behind it.

    An Insert stays at the node; its state after it is the one to go on from there.
    """
    letter, extra, stays = mark.lower(), TRUNCATED if mark.isupper() else 0, mark != "-"
    options = []
    for q in STATES:
        at = [(DELETE + behind[q], "D", q)]
        if stays and letter in LEGAL[q]:
            at.append((KEEP + extra + behind[LEGAL[q][letter]], "K", LEGAL[q][letter]))
        if stays:
            at.append((REROLE + extra + behind[LEGAL[q][WANTED[q]]], "R", LEGAL[q][WANTED[q]]))
        options.append(at)
    cost = [min(at)[0] for at in options]
    for _ in STATES:
        cost = [min(cost[q], INSERT + cost[LEGAL[q][WANTED[q]]]) for q in STATES]
    for q in STATES:
        then = LEGAL[q][WANTED[q]]
        options[q].append((INSERT + cost[then], "I", then))
    # The smallest option is the cheapest one with the least letter.
    best = [min(at) for at in options]
    return tuple(b[0] for b in best), tuple(b[1] for b in best), tuple(b[2] for b in best)


def _edits(nodes: list[tuple]) -> tuple[list[str], list[int]]:
    """The audit from each state on through the nodes, first turn last in ``nodes``, and the state it ends in."""
    audits, ends = [], []
    for q in STATES:
        out = []
        for _, edits, then in reversed(nodes):
            while edits[q] == "I":
                out.append("I")
                q = then[q]
            out.append(edits[q])
            q = then[q]
        audits.append("".join(out))
        ends.append(q)
    return audits, ends


def _shared(finish, kind: pa.DataType):
    """Arrow function over ``behind, sig`` sorted by ``behind`` and the reversed ``sig``.

    The stack holds one node for each turn of the last signature from its end; what the next one shares stays.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, base, stack = "", None, []
        for batch in batches:
            rows = []
            for behind, sig in zip(batch.column("behind").to_pylist(), batch.column("sig").to_pylist()):
                path, behind = sig[::-1], tuple(behind)
                same = 0
                if behind == base:
                    while same < min(len(path), len(before)) and path[same] == before[same]:
                        same += 1
                del stack[same:]
                for mark in path[same:]:
                    stack.append(node(mark, stack[-1][0] if stack else behind))
                before, base = path, behind
                rows.append(finish(stack))
            yield pa.RecordBatch.from_arrays(
                [batch.column("behind"), batch.column("sig"), pa.array([r[0] for r in rows], pa.list_(kind)),
                 pa.array([r[1] for r in rows], pa.list_(pa.int64()))], names=["behind", "sig", "first", "second"])

    return run


def _costs(nodes: list[tuple]) -> tuple[list[int], list[int]]:
    """The cost to go of each state before the nodes' first turn."""
    return list(nodes[-1][0]), []


def _by_ends(pairs: DataFrame, finish, kind: pa.DataType) -> DataFrame:
    """Distinct ``behind, sig`` with the two arrays, ``first`` and ``second``, that ``finish`` gets from the nodes."""
    back = F.reverse("sig")
    name = "string" if kind == pa.string() else "bigint"
    return (pairs.select("behind", "sig").distinct().repartitionByRange("behind", back).sortWithinPartitions("behind", back)
            .mapInArrow(_shared(finish, kind), f"behind array<bigint>, sig string, first array<{name}>, second array<bigint>"))


def _back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From segments in reversed order, with the costs between their states, to what stands behind each of them."""
    conv, behind = None, END
    for batch in batches:
        out = []
        for c, between in zip(batch.column("conv").to_pylist(), batch.column("between").to_pylist()):
            if c != conv:
                conv, behind = c, END
            out.append([x - min(behind) for x in behind])
            if between:
                behind = tuple(min(between[4 * e + q] + behind[e] for e in STATES) for q in STATES)
        yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in ("conv", "seg", "sig")), pa.array(out, pa.list_(pa.int64()))],
                                         names=["conv", "seg", "sig", "behind"])


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From segments in order, with the edits of every state, to each conversation's whole audit."""
    conv, state, held = None, 0, []

    def whole() -> tuple[str, str]:
        # What the last state still wants.
        end = state
        while END[end]:
            held.append("I")
            end = LEGAL[end][WANTED[end]]
        return conv, "".join(held)

    def found(rows: list[tuple[str, str]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.string()) for i in range(2)], names=["conv", "audit"])

    for batch in batches:
        out = []
        for c, audits, ends in zip(*(batch.column(i).to_pylist() for i in ("conv", "first", "second"))):
            if c != conv:
                if conv is not None:
                    out.append(whole())
                conv, state, held = c, 0, []
            held.append(audits[state])
            state = ends[state]
        yield found(out)
    if conv is not None:
        yield found([whole()])


def audits(segments: DataFrame) -> DataFrame:
    """``conv, audit`` from the staged segments of signatures."""
    end = F.array(*[F.lit(c).cast("bigint") for c in END])
    open_ = segments.filter(~F.col("last"))
    if open_.head(1):
        # Costs between states: one run of the nodes for each state that a segment may end in.
        states = F.sequence(F.lit(0), F.lit(3))
        only = F.transform(states, lambda e: F.transform(states, lambda q: F.when(q == e, 0).otherwise(FAR).cast("bigint")))
        runs = _by_ends(open_.select("sig").distinct().select("sig", F.explode(only).alias("behind")), _costs, pa.int64())
        inner = runs.groupBy("sig").agg(F.array_sort(F.collect_list(F.struct(F.array_position("behind", 0).alias("e"), "first"))).alias("r"))
        inner = inner.select("sig", F.lit(False).alias("last"), F.flatten(F.transform("r", lambda x: x["first"])).alias("between"))
        # A last segment ends in END, whatever the state, which stands for the first column.
        tails = _by_ends(segments.filter("last and seg > 0").select("sig", end.alias("behind")), _costs, pa.int64())
        tails = tails.select("sig", F.lit(True).alias("last"), F.concat(
            "first", F.array_repeat(F.lit(FAR).cast("bigint"), 12)).alias("between"))
        placed = (segments.filter("not last or seg > 0").join(inner.unionByName(tails), ["sig", "last"]).select("conv", "seg", "sig", "between")
                  .repartition("conv").sortWithinPartitions("conv", F.desc("seg"))
                  .mapInArrow(_back, "conv string, seg bigint, sig string, behind array<bigint>"))
        alone = segments.filter("last and seg = 0").select("conv", "seg", "sig", end.alias("behind"))
        placed = stage_rows(placed.unionByName(alone), "repair-places")
    else:
        placed = segments.select("conv", "seg", "sig", end.alias("behind"))
    edits = stage_rows(_by_ends(placed, _edits, pa.string()), "repair-edits")
    return (placed.join(edits, ["behind", "sig"]).select("conv", "seg", "first", "second").repartition("conv")
            .sortWithinPartitions("conv", "seg").mapInArrow(_chain, "conv string, audit string"))


_TURNS = "conv string, edit string, role string, text string, cost bigint"


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From each conversation's audit and its turns behind it to the edited turns, in order."""
    conv, audit, at, state = None, "", 0, 0

    def inserted() -> Iterator[tuple]:
        nonlocal at, state
        while audit[at:at + 1] == "I":
            role = WANTED[state]
            at, state = at + 1, LEGAL[state][role]
            yield conv, "I", NAMES[role], "", INSERT

    for batch in batches:
        out = []
        for c, kind, role, text, fault in zip(*(batch.column(i).to_pylist() for i in ("conv", "kind", "role", "text", "fault"))):
            if kind == 0:
                out += inserted()
                conv, audit, at, state = c, text, 0, 0
                continue
            out += inserted()
            edit, extra = audit[at], TRUNCATED if fault == "truncated" else 0
            at += 1
            if edit == "D":
                out.append((conv, "D", None, None, DELETE))
                continue
            letter = WANTED[state] if edit == "R" else role[:1]
            state = LEGAL[state][letter]
            out.append((conv, edit, NAMES[letter] if edit == "R" else role, text, (REROLE if edit == "R" else KEEP) + extra))
        yield _batch(out)
    yield _batch(list(inserted()))


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string()] * 4 + [pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)],
                                      names=["conv", "edit", "role", "text", "cost"])


def repair(rows: DataFrame, segment: int = SEGMENT) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(counts, audits, turns)`` of conversations with ``conv_id, turn, role, text``.

    counts: ``conv, gaps, blank, duplicate, truncated, illegal``; audits: ``conv, audit``; turns: the repaired
    conversations' turns, in order inside a partition that has the whole conversation: ``conv, edit, role, text,
    cost``, a deleted turn without role and text.
    """
    given = turns(rows)
    order = ["conv", F.asc_nulls_first("turn"), "role", "text", "nth"]
    segments = stage_rows(given.repartition("conv").sortWithinPartitions(*order).select("conv", "turn", "role", "fault")
                          .mapInArrow(_sign(segment), _SEGMENTS), "repair-segments")
    counts = segments.filter("last").select("conv", "gaps", "blank", "duplicate", "truncated", "illegal")
    found = stage_rows(audits(segments), "repair-audits")
    empty = F.lit(None)
    both = given.select("conv", F.lit(1).alias("kind"), "turn", "role", "text", "nth", "fault").unionByName(found.select(
        "conv", F.lit(0).alias("kind"), empty.cast("bigint").alias("turn"), empty.cast("string").alias("role"), F.col("audit").alias("text"),
        empty.cast("int").alias("nth"), empty.cast("string").alias("fault")))
    mended = (both.repartition("conv").sortWithinPartitions("conv", "kind", *order[1:]).select("conv", "kind", "role", "text", "fault")
              .mapInArrow(_apply, _TURNS))
    return counts, found, mended


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cost and digest of each conversation's repaired turns."""
    conv, cost, whole, first = None, 0, None, True
    for batch in batches:
        out = []
        for c, role, text, paid in zip(*(batch.column(i).to_pylist() for i in ("conv", "role", "text", "cost"))):
            if c != conv:
                if conv is not None:
                    out.append((conv, cost, whole.hexdigest()))
                conv, cost, whole, first = c, 0, hashlib.sha256(), True
            cost += paid
            if role is not None:
                whole.update(f"{'' if first else chr(10)}{role}:{text}".encode())
                first = False
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate((pa.string(), pa.int64(), pa.string()))],
                                         names=["conv", "cost", "repaired_sha256"])
    if conv is not None:
        yield pa.RecordBatch.from_arrays([pa.array([conv]), pa.array([cost], pa.int64()), pa.array([whole.hexdigest()])],
                                         names=["conv", "cost", "repaired_sha256"])


def summary(rows: DataFrame, damaged: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """One row per conversation of ``rows`` with what repairing ``damaged`` found, did and gave."""
    counts, found, mended = repair(damaged, segment)
    digests = mended.mapInArrow(_digest, "conv string, cost bigint, repaired_sha256 string")
    every = rows.select(F.col("conv_id").cast("bigint").alias("conv_id")).distinct().withColumn(
        "conv", F.coalesce(F.col("conv_id").cast("string"), F.lit("")))
    zero = [F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return (every.join(counts, "conv", "left").join(found, "conv", "left").join(digests, "conv", "left").select(
        "conv_id", *zero, F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256")))
