"""SentencePiece encoding by sampling from the piece lattice, and lossless decoding.

A segmentation is drawn with probability proportional to the product of its pieces' weights to the
power ``alpha``: forward sums over the lattice, then pieces drawn backward from the end.  The draws
are hashes of the row's key, the place in the row and the step, so a key gives the same pieces in any
batch, partition or run.

No piece holds a space behind another character, nor any character that is in no piece at all;
the lattice falls apart there, and equal parts of many rows share one lattice.  Forward sums run over
the distinct parts of a batch, draws over all parts at once.

Characters in no piece become byte pieces, and so does a literal U+2581, which would otherwise come
back as a space: decoding gives the text back as it was.  A null text is empty, an empty one has no
pieces.  A null key counts as one key of its own; rows that repeat get equal pieces.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.llm.common import id_and_text, slices

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
ALPHA = 0.3
SEED = 1
# Weight of a piece of a model that only ranks its pieces: 1 / (rank + RANK_OFFSET).
RANK_OFFSET = 100.0
# Bytes of text and parts of it worked on at once; any text is cut into such slices between parts.
BATCH_BYTES = 2 << 20
BATCH_PARTS = 1 << 17

_MARK = "▁".encode()
# Stands for a literal U+2581 inside a task; no UTF-8 text has this byte.
_LITERAL = 0xFF
_FALLBACK_WEIGHT = -30.0
# More than the bytes of any piece.
_LONGEST = 256


@dataclass(frozen=True)
class Pieces:
    """What encoding and decoding need of a model: pieces as bytes with spaces, their log weights, byte pieces."""

    text: list[bytes]
    ids: list[int]
    weight: list[float]
    byte_ids: list[int]
    size: int


def read_model(path: str = MODEL) -> Pieces:
    """Read a SentencePiece model with byte pieces; the file is read on the driver only."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    size = model.get_piece_size()
    special = [model.is_control(i) or model.is_unknown(i) or model.is_unused(i) or model.is_byte(i) for i in range(size)]
    ids = [i for i in range(size) if not special[i]]
    scores = [model.get_score(i) for i in ids]
    # Scores of a ranking model are whole negative numbers, those of a unigram model log probabilities.
    ranked = all(s == int(s) for s in scores)
    weight = [-float(np.log(RANK_OFFSET - s)) if ranked else float(s) for s in scores]
    return Pieces([model.id_to_piece(i).replace("▁", " ").encode() for i in ids], ids, weight,
                  [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)], size)


class Lattice:
    """The pieces as a byte trie, and the steps of sampling over many parts at once."""

    def __init__(self, pieces: Pieces, alpha: float, seed: int):
        self.alpha, self.seed = alpha, np.uint64(seed)
        children: list[dict[int, int]] = [{}]
        ends: dict[int, int] = {}
        for k, text in enumerate(pieces.text):
            node = 0
            for byte in text:
                following = children[node].get(byte)
                if following is None:
                    following = children[node][byte] = len(children)
                    children.append({})
                node = following
            ends[node] = k
        # Nodes with children come first, so that only those have a row of the table.
        order = sorted(range(len(children)), key=lambda i: not children[i])
        place = {old: new for new, old in enumerate(order)}
        self.inner = sum(1 for c in children if c)
        self.step = np.zeros((self.inner, 256), np.int32)
        for old in order[:self.inner]:
            for byte, following in children[old].items():
                self.step[place[old], byte] = place[following]
        self.piece = np.full(len(children), -1, np.int64)
        for old, k in ends.items():
            self.piece[place[old]] = k
        self.ids = np.array(pieces.ids, np.int32)
        self.weight = np.array(pieces.weight) * alpha
        self.byte_ids = np.array(pieces.byte_ids, np.int32)
        used = set(b"".join(pieces.text))
        # Bytes that are a character of their own and in no piece: the lattice has one way through them.
        self.alone = np.array([b not in used and (b < 0x80 or b == _LITERAL) for b in range(256)])
        self.width = np.ones(256, np.int64)
        self.width[0xC0:0xE0], self.width[0xE0:0xF0], self.width[0xF0:0xF8] = 2, 3, 4
        self.starts_char = np.array([not 0x80 <= b < 0xC0 for b in range(256)])

    def encode(self, keys: np.ndarray, texts: pa.Array) -> pa.Array:
        """Piece ids of every text."""
        raw = pc.replace_substring(pc.fill_null(texts, "").cast(pa.large_binary()), _MARK, bytes([_LITERAL]))
        empty = pc.equal(pc.binary_length(raw), 0)
        # Every text but an empty one gets a space in front, as the pieces of a first word have one.
        lead = pc.if_else(empty, pa.scalar(b"", pa.large_binary()), pa.scalar(b" ", pa.large_binary()))
        raw = pc.binary_join_element_wise(lead, raw, pa.scalar(b"", pa.large_binary()))
        at = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset:raw.offset + len(raw) + 1]
        data = np.frombuffer(raw.buffers()[2] or b"", np.uint8)[at[0]:at[-1]]
        at = at - at[0]
        if not len(data):
            return pa.array([[]] * len(raw), pa.list_(pa.int32()))
        space, alone = data == 0x20, self.alone[data]
        cut = space | alone
        cut[1:] &= ~space[:-1] | alone[1:]
        cut[1:] |= alone[:-1]
        cut[at[:-1][at[:-1] < len(data)]] = True
        starts = np.flatnonzero(cut)
        owner = np.searchsorted(at, starts, side="right") - 1
        place = np.arange(len(starts)) - np.searchsorted(starts, at[owner])
        starts = np.append(starts, len(data))
        with np.errstate(over="ignore"):
            salt = _mix(keys.view(np.uint64)[owner] ^ _mix(np.full(1, self.seed))) + place.astype(np.uint64) * _GOLD
        tokens, counts = [], []
        for a in range(0, len(owner), BATCH_PARTS):
            b = min(a + BATCH_PARTS, len(owner))
            ids, per_part = self._sample(data[starts[a]:starts[b]], starts[a:b + 1] - starts[a], salt[a:b])
            tokens.append(ids)
            counts.append(per_part)
        per_text = np.bincount(owner, np.concatenate(counts), len(raw)).astype(np.int64)
        offsets = np.concatenate(([0], np.cumsum(per_text))).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(tokens)))

    def _edges(self, data: np.ndarray, starts: np.ndarray):
        """All pieces of all parts as (first byte, byte after the last, piece), -1 for a character's bytes."""
        end_of = np.repeat(starts[1:], np.diff(starts))
        first = np.flatnonzero(self.starts_char[data])
        at, state = first, np.zeros(len(first), np.int64)
        source, target, piece = [], [], []
        width = self.width[data]
        covered = np.zeros(len(data), bool)
        depth = 0
        while len(at):
            state = self.step[state, data[at + depth]]
            depth += 1
            alive = state > 0
            at, state = at[alive], state[alive]
            found = self.piece[state]
            whole = found >= 0
            source.append(at[whole])
            target.append(at[whole] + depth)
            piece.append(found[whole])
            single = at[whole]
            covered[single[width[single] == depth]] = True
            more = (state < self.inner) & (at + depth < end_of[at])
            at, state = at[more], state[more]
        bare = first[~covered[first]]
        return (np.concatenate([*source, bare]), np.concatenate([*target, bare + width[bare]]),
                np.concatenate([*piece, np.full(len(bare), -1)]))

    def _sample(self, data: np.ndarray, starts: np.ndarray, salt: np.ndarray):
        """Piece ids of consecutive parts, and their number per part."""
        parts = pa.Array.from_buffers(pa.large_binary(), len(salt), [None, pa.py_buffer(starts.astype(np.int64)),
                                                                     pa.py_buffer(np.ascontiguousarray(data))])
        coded = parts.dictionary_encode()
        which = coded.indices.to_numpy().astype(np.int64)
        own = coded.dictionary
        begin = np.frombuffer(own.buffers()[1], np.int64)[own.offset:own.offset + len(own) + 1]
        text = np.frombuffer(own.buffers()[2], np.uint8)[begin[0]:begin[-1]]
        begin = begin - begin[0]
        source, target, piece = self._edges(text, begin)
        # A part of n bytes has n + 1 places.
        part = np.searchsorted(begin, source, side="right") - 1
        reach = target - begin[part]
        source, target = source + part, target + part
        weight = np.where(piece >= 0, self.weight[piece], _FALLBACK_WEIGHT * self.alpha)
        places = len(text) + len(own)
        total = np.full(places, -np.inf)
        zero = begin[:-1] + np.arange(len(own))
        total[zero] = 0.0
        # By place, longest piece first, which mostly is the likeliest; then by distance from the part's start.
        order = np.argsort(target * _LONGEST + (_LONGEST - 1) - np.minimum(target - source, _LONGEST - 1))
        source, target, piece, weight, reach = source[order], target[order], piece[order], weight[order], reach[order]
        levels = np.argsort(reach.astype(np.uint16 if reach.max() < 1 << 16 else np.int64), kind="stable")
        many = np.bincount(reach)
        at = 0
        for n in many[many > 0].tolist():
            level = levels[at:at + n]
            at += n
            to = target[level]
            heads = np.flatnonzero(np.append(True, to[1:] != to[:-1]))
            total[to[heads]] = np.logaddexp.reduceat(total[source[level]] + weight[level], heads)
        share = np.exp(total[source] + weight - total[target])
        last = np.append(target[1:] != target[:-1], True)
        first = np.zeros(places, np.int32)
        first[target[np.append(True, last[:-1])]] = np.flatnonzero(np.append(True, last[:-1]))
        summed = np.concatenate(([0.0], np.cumsum(share)))
        cumulated = (summed[1:] - summed[first[target]]).astype(np.float32)
        cumulated[last] = 2.0
        length, ids = self._tokens(text, source - part[order], piece)
        source = source.astype(np.int32)
        # Backward draws of all parts together, one piece each per round.
        live, at, stop = np.arange(len(which)), (begin[1:] + np.arange(len(own)))[which], zero[which]
        drawn, step = [], 0
        while len(live):
            with np.errstate(over="ignore"):
                u = ((_mix(salt[live] + np.uint64(step + 1) * _STEP) >> np.uint64(11)) * 2.0 ** -53).astype(np.float32)
            edge = first[at]
            late = np.flatnonzero(u > cumulated[edge])
            while len(late):
                edge[late] += 1
                late = late[u[late] > cumulated[edge[late]]]
            drawn.append((live, edge))
            at = source[edge]
            more = at != stop[live]
            live, at = live[more], at[more]
            step += 1
        per_part = np.zeros(len(which), np.int64)
        for who, edge in drawn:
            per_part[who] += length[edge]
        end = np.cumsum(per_part)
        out = np.empty(end[-1] if len(end) else 0, np.int32)
        for who, edge in drawn:
            end[who] -= length[edge]
            for k in range(int(length[edge].max())):
                has = length[edge] > k
                out[end[who[has]] + k] = ids[k][edge[has]]
        return out, per_part

    def _tokens(self, text: np.ndarray, at: np.ndarray, piece: np.ndarray):
        """Number of ids of every piece and the ids, as columns: one, or one per byte of a bare character."""
        bare = piece < 0
        literal = text[at] == _LITERAL
        length = np.where(bare, np.where(literal, len(_MARK), self.width[text[at]]), 1)
        columns = []
        for k in range(int(length.max()) if len(length) else 0):
            byte = np.where(literal, _MARK[k] if k < len(_MARK) else 0, text[np.minimum(at + k, len(text) - 1)])
            columns.append(np.where(bare, self.byte_ids[byte], self.ids[piece] if k == 0 else 0).astype(np.int32))
        return length, columns


_GOLD = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD1B54A32D192ED03)


def _mix(x: np.ndarray) -> np.ndarray:
    """Well-mixed 64 bits of a 64-bit counter."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def encode(keys: pa.Array, texts: pa.Array, lattice: Lattice) -> Iterator[tuple[int, int, pa.Array]]:
    """Piece ids of the texts, slice by slice of rows."""
    keys = pc.fill_null(keys, -1).to_numpy(zero_copy_only=False).astype(np.int64)
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    for a, b in slices(sizes, BATCH_BYTES):
        yield a, b, lattice.encode(keys[a:b], texts.slice(a, b - a))


def piece_table(pieces: Pieces) -> list[bytes]:
    """What each id stands for; ids that stand for no text are empty."""
    table = [b""] * pieces.size
    for i, text in zip(pieces.ids, pieces.text):
        table[i] = text
    for byte, i in enumerate(pieces.byte_ids):
        table[i] = bytes([byte])
    return table


def decode(rows: pa.Array, table: list[bytes]) -> pa.Array:
    """The texts of rows of piece ids; a null row is an empty text."""
    ids = rows.flatten().to_numpy()
    ends = np.cumsum(pc.fill_null(pc.list_value_length(rows), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    texts, start = [], 0
    for end in ends.tolist():
        texts.append(b"".join([table[i] for i in ids[start:end].tolist()])[1:])
        start = end
    return pa.array(texts, pa.binary()).cast(pa.string())


def encoded(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str = MODEL, alpha: float = ALPHA,
            seed: int = SEED) -> DataFrame:
    """``doc_id, ids, decoded, lossless``: sampled pieces of every document, the text they decode to, and
    whether that is the document's."""
    pieces = read_model(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice, table = Lattice(pieces, alpha, seed), piece_table(pieces)
        for batch in batches:
            for a, b, ids in encode(batch.column(0), batch.column(1), lattice):
                part = batch.slice(a, b - a)
                back = decode(ids, table)
                yield pa.RecordBatch.from_arrays([part.column(0), ids, back, pc.equal(back, part.column(1))],
                                                 names=["doc_id", "ids", "decoded", "lossless"])

    return id_and_text(docs, id_col, text_col).mapInArrow(
        run, "doc_id bigint, ids array<int>, decoded string, lossless boolean")


def decoded(rows: DataFrame, ids_col: str = "ids", model: str = MODEL) -> Column:
    """The text of a column of piece ids, for rows that were encoded before."""
    table = piece_table(read_model(model))

    @F.arrow_udf(T.StringType())
    def udf(ids: pa.Array) -> pa.Array:
        return decode(ids, table)

    return udf(rows[ids_col])


def summary(rows: DataFrame) -> DataFrame:
    """``doc_id, ids``, their number, the digest of the decoded text, and whether it is the text."""
    return rows.select("doc_id", "ids", F.size("ids").cast("bigint").alias("n_pieces"),
                       F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"), "lossless")
