"""Online packing of documents into training windows by the sum-of-squares rule.

Documents longer than a window give full windows, cut off their front; what remains, and every shorter document, is an
item. Items are placed one after another, each where it makes the sum over fill levels of (partially filled windows at
that level) squared smallest: the level array N holds those numbers, and putting an item of size s into a window at level
h moves one window from N[h] to N[h+s]. Items are dealt evenly to shards of bounded size, packed independently; when a
shard's items are used up, windows still open are put together where they fit. Only lengths are shuffled, never ids.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hostvane.llm.shared import small_batches, stored, texts
from hostvane.llm.tokens import DEFAULT_FILE, encoder

WINDOW = 2048
END_ID = 1
#: Items of a shard, on average. A shard is one task's work; its open windows at the end are the only padding.
SHARD_ITEMS = 50_000
#: A shard's windows are numbered from shard * SHARD_WINDOWS.
SHARD_WINDOWS = 1 << 32

#: Files that hold the same vocabulary with the same ids as ranks, which encode a whole text faster.
RANKS = {"byte_bpe_50k.json": "byte_bpe_50k.tiktoken"}

_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


class LevelPacker:
    """Places items of 1..window tokens; tracks open windows per fill level."""

    def __init__(self, window: int):
        self.window, self.used = window, 0
        self.count = np.zeros(window + 1, dtype=np.int64)  # N: open windows per level; index 0 and window stay 0
        self.open: list[list[int]] = [[] for _ in range(window + 1)]

    def place(self, size: int) -> tuple[int, int]:
        """(window, offset) of an item. Equal changes of the sum: the fuller window."""
        top = self.window - size
        if top == 0:
            return self._new(size), 0
        n = self.count
        change = 2 * (n[size + 1 : self.window + 1] - n[1 : top + 1]) + 2  # from level h = 1..top to h + size
        change[-1] = 1 - 2 * n[top]  # a window that becomes full leaves the sum
        change[n[1 : top + 1] == 0] = np.iinfo(np.int64).max
        level = top - int(np.argmin(change[::-1]))
        if change[level - 1] > 2 * n[size] + 1:
            return self._new(size), 0
        n[level] -= 1
        at = self.open[level].pop()
        self._at(at, level + size)
        return at, level

    def _new(self, size: int) -> int:
        self.used += 1
        self._at(self.used - 1, size)
        return self.used - 1

    def _at(self, window: int, level: int) -> None:
        if level < self.window:
            self.count[level] += 1
            self.open[level].append(window)

    def close(self) -> dict[int, tuple[int, int]]:
        """Put windows still open together, fullest first, each on the fullest that has room: {window: (into, shift)}."""
        moved: dict[int, tuple[int, int]] = {}
        gaps: list[list[int]] = [[] for _ in range(self.window + 1)]
        largest = 0
        for level in range(self.window - 1, 0, -1):
            for at in self.open[level]:
                room = next((g for g in range(level, largest + 1) if gaps[g]), None)
                into = at if room is None else gaps[room].pop()
                free = self.window - level if room is None else room - level
                if room is not None:
                    moved[at] = (into, self.window - room)
                gaps[free].append(into)
                largest = max(largest, free)
        return moved


def place_all(sizes: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Window and offset of every item, in the order given."""
    packer = LevelPacker(window)
    placed = np.array([packer.place(size) for size in sizes.tolist()], dtype=np.int64).reshape(-1, 2)
    at, offset = placed[:, 0], placed[:, 1]
    moved = packer.close()
    if moved:
        into, shift = np.arange(packer.used), np.zeros(packer.used, dtype=np.int64)
        for window_from, (window_to, by) in moved.items():
            into[window_from], shift[window_from] = window_to, by
        at, offset = into[at], offset + shift[at]
    return at, offset


def text_ids(values: list[str], name: str = DEFAULT_FILE) -> list[np.ndarray]:
    """Ids of whole texts. Texts that hold a special token's string go to the tokenizer itself, others to its ranks."""
    own, ranks = encoder(name), RANKS.get(name)
    if ranks is None:
        return [np.array(ids, dtype="<u4") for ids in own.whole(values)]
    whole = {k for k, value in enumerate(values) if own.needs_whole(value)}
    made = iter(own.whole([values[k] for k in sorted(whole)]))
    plain = encoder(ranks).ordinary
    return [np.array(next(made), dtype="<u4") if k in whole else plain(value) for k, value in enumerate(values)]


def token_pieces(docs: DataFrame, window: int = WINDOW, name: str = DEFAULT_FILE, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every document's ids, closed with END_ID and cut into pieces of at most `window`: place, length and checksum.

    Pieces of a document cover it without gap or overlap. Null text is empty: one piece, the closing id alone.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = np.array([END_ID], dtype="<u4")
        for batch in small_batches(batches):
            out = []
            for key, ids in zip(batch.column("doc_id").to_pylist(), text_ids(texts(batch), name), strict=True):
                ids = memoryview(np.concatenate([ids, end]).tobytes())
                total = len(ids) // 4
                for start in range(0, total, window):
                    part = ids[4 * start : 4 * (start + window)]
                    out.append((key, start, len(part) // 4, zlib.crc32(part), total))
            columns = zip(*out, strict=True) if out else [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], _PIECES.replace(" long", "").split(", "))

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(cut, _PIECES)


def place_pieces(pieces: DataFrame, window: int = WINDOW, shard_items: int = SHARD_ITEMS) -> DataFrame:
    """Add sequence_id and offset to rows that have a `length` of 1..window.

    Rows are numbered as they are written to the shared folder, and dealt to shards by that number, so neither a hot
    document nor repeated rows can fill a shard.
    """
    numbered = stored(pieces.withColumn("piece_no", F.monotonically_increasing_id()), "pieces")
    shards = max(1, round(numbered.count() / shard_items))
    schema = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in pieces.schema)}, sequence_id long, offset long"

    def pack(key, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("piece_no", ignore_index=True)
        at, offset = place_all(rows["length"].to_numpy(), window)
        out = rows.drop(columns=["piece_no", "shard"])
        return out.assign(sequence_id=at + int(key[0]) * SHARD_WINDOWS, offset=offset)

    dealt = numbered.withColumn("shard", F.pmod(F.xxhash64("piece_no"), F.lit(shards)))
    return dealt.repartition(shards, "shard").groupBy("shard").applyInPandas(pack, schema)


def pack_documents(docs: DataFrame, window: int = WINDOW, name: str = DEFAULT_FILE, doc_id: str = "doc_id", text: str = "text", shard_items: int = SHARD_ITEMS) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Offsets of a sequence run from 0 without gaps; every id of every document is in exactly one piece. Null and repeated
    ids and repeated rows are documents of their own; null text is the closing id alone; other columns are ignored.
    An empty table gives no rows.
    """
    return place_pieces(token_pieces(docs, window, name, doc_id, text), window, shard_items)
