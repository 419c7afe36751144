"""Token ids of documents as packed binary matrices, by best-fit decreasing.

Every task encodes its documents, cuts those longer than a window into full windows and a rest (nothing is lost), and
packs blocks of a bounded number of tokens: longest piece first, each into the fullest window that has room, found in a
segment tree over free capacities. A written row holds some windows: their ids as one matrix, the cumulative lengths of
their segments, a bitmap of the tokens at which positions start again from 0, and where each segment comes from. Rows go
through Spark's own writer, so a task that is tried again leaves no second copy.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hostvane.llm.shared import small_batches, stored, texts
from hostvane.llm.tokens import encoder, piece_ids

#: The same vocabulary as the tokenizer file's, as ranks, which encode new pieces faster; END_ID is free in it.
RANKS_FILE = "byte_bpe_50k.tiktoken"
WINDOW, END_ID, PAD_ID = 2048, 50256, 0
#: Tokens that a task holds before it packs them, and windows of a written row.
BLOCK_TOKENS, ROW_WINDOWS = 4_000_000, 128

SCHEMA = (
    "first_sequence long, windows int, window int, id_bytes int, ids binary, cu_seqlens binary, resets binary, "
    "doc_ids array<long>, starts array<long>"
)
PIECES = "doc_id long, start long, length long, sequence_id long, offset long, ids_crc32 long"


class CapacityTree:
    """Segment tree over free capacities 0..most: a node is set when some window below it has that room."""

    def __init__(self, most: int):
        self.leaves = 1 << most.bit_length()
        self.some = bytearray(2 * self.leaves)

    def mark(self, capacity: int, there: bool) -> None:
        at = capacity + self.leaves
        self.some[at] = there
        while at > 1:
            at >>= 1
            self.some[at] = self.some[2 * at] | self.some[2 * at + 1]

    def smallest_from(self, capacity: int) -> int | None:
        """The smallest marked capacity that is not below `capacity`."""
        at = capacity + self.leaves
        while not self.some[at]:
            while at & 1:  # a right child: what lies to its right is beyond its parent
                at >>= 1
            if at <= 1:
                return None
            at += 1
        while at < self.leaves:
            at = 2 * at + (not self.some[2 * at])
        return at - self.leaves


def best_fit_decreasing(lengths: list[int], window: int) -> list[list[int]]:
    """Windows as lists of piece numbers; lengths are 1..window. Equal lengths keep their order."""
    tree, rooms, out = CapacityTree(window), {}, []
    for piece in sorted(range(len(lengths)), key=lambda k: -lengths[k]):
        free = tree.smallest_from(lengths[piece])
        if free is None:
            at, free = len(out), window
            out.append([])
        else:
            at = rooms[free].pop()
            if not rooms[free]:
                tree.mark(free, False)
        out[at].append(piece)
        free -= lengths[piece]
        if free:
            if not rooms.setdefault(free, []):
                tree.mark(free, True)
            rooms[free].append(at)
    return out


def pack_tokens(docs: DataFrame, window: int = WINDOW, name: str = RANKS_FILE, end_id: int = END_ID, pad_id: int = PAD_ID, block_tokens: int = BLOCK_TOKENS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows of SCHEMA. ids: little-endian, 16 bits where the vocabulary allows it, else 32, `windows` x `window`.

    cu_seqlens: 32-bit, from 0, over all segments of the row, with a segment of padding behind a window that is not
    full. resets: a bit per token. doc_ids and starts (in the document) per segment; padding has neither, start -1.
    A document is its ids and `end_id`; null text is empty. Null and repeated ids and repeated rows are documents of
    their own; other columns are ignored. An empty table gives no rows.
    """
    kind = "<u2" if max(encoder(name).vocabulary - 1, end_id, pad_id) < 1 << 16 else "<u4"

    def written(pieces: list[tuple], sequence: int) -> Iterator[tuple]:
        packed = best_fit_decreasing([len(ids) for *_, ids in pieces], window)
        for first in range(0, len(packed), ROW_WINDOWS):
            part = packed[first : first + ROW_WINDOWS]
            ids = np.full((len(part), window), pad_id, dtype=kind)
            lengths, keys, starts = [], [], []
            for k, members in enumerate(part):
                end = 0
                for piece in members:
                    key, start, own = pieces[piece]
                    ids[k, end : end + len(own)] = own
                    lengths.append(len(own))
                    keys.append(key)
                    starts.append(start)
                    end += len(own)
                if end < window:
                    lengths.append(window - end)
                    keys.append(None)
                    starts.append(-1)
            edges = np.cumsum([0, *lengths])
            resets = np.zeros(len(part) * window, dtype=bool)
            resets[edges[:-1]] = True
            yield sequence + first, len(part), window, ids.itemsize, ids.tobytes(), edges.astype("<i4").tobytes(), np.packbits(resets).tobytes(), keys, starts

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, sequence = piece_ids(name), TaskContext.get().partitionId() << 32
        pieces: list[tuple] = []
        held = 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal pieces, held, sequence
            for row in written(pieces, sequence):
                sequence += row[1]
                yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], names)
            pieces, held = [], 0

        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64())]
        names = [part.split()[0] for part in SCHEMA.split(", ")]
        for batch in small_batches(batches, 64):
            for key, ids in zip(batch.column("doc_id").to_pylist(), known.of(texts(batch)), strict=True):
                ids = np.append(np.frombuffer(ids, "<u4"), end_id).astype(kind)
                pieces += [(key, start, ids[start : start + window]) for start in range(0, len(ids), window)]
                held += len(ids)
            if held >= block_tokens:
                yield from flush()
        yield from flush()

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(pack, SCHEMA)


def packed_pieces(packed: DataFrame) -> DataFrame:
    """Every piece, read from the matrices: doc_id, start, length, sequence_id, offset, ids_crc32 (of 32-bit ids)."""
    names = [part.split()[0] for part in PIECES.split(", ")]

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 1):
            (row,) = batch.to_pylist()
            ids = np.frombuffer(row["ids"], f"<u{row['id_bytes']}").astype("<u4")
            edges = np.frombuffer(row["cu_seqlens"], "<i4").tolist()
            out = []
            for key, start, a, b in zip(row["doc_ids"], row["starts"], edges, edges[1:], strict=False):
                if start >= 0:
                    place, offset = divmod(a, row["window"])
                    out.append((key, start, b - a, row["first_sequence"] + place, offset, zlib.crc32(ids[a:b])))
            columns = zip(*out, strict=True) if out else [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    return packed.mapInArrow(unpack, PIECES)


def write_packed(docs: DataFrame, path: str | None = None, **options) -> DataFrame:
    """Pack and write as a table at `path`, or in the shared folder; returns the table."""
    packed = pack_tokens(docs, **options)
    if path is None:
        return stored(packed, "packed")
    packed.write.parquet(path)
    return docs.sparkSession.read.schema(packed.schema).parquet(path)
