"""Token sequences of two tokenizers over the same bytes: groups between common ends, and links between overlapping tokens.

Each sequence is a sorted list of the byte offsets at which its tokens end. Common ends come from a galloping intersection:
the shorter list drives, and each of its ends is looked for in the longer list by doubling steps from the last place and a
binary search within the last step. Lists are cut into runs, so that the runs of all texts of a batch gallop side by side.
The indices of two neighbouring common ends cut a group out of either sequence, and the difference of two ranks in the other
list (of a token's start and of its end) is how many tokens there it overlaps.
"""

from __future__ import annotations

import base64
import functools
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hostvane.llm.shared import small_batches, stored, texts
from hostvane.llm.tokens import tokenizer_path

#: The ranks are the vocabulary of byte_bpe_50k.json, with the same ids.
FIRST, SECOND = "byte_bpe_50k.tiktoken", "piece_bpe_32k.model"
#: Ends of a shorter list that gallop one after the other, and characters that a task aligns at a time (or one text).
RUN, PORTION = 64, 1_000_000
#: Pairs whose figures every worker holds (20 bytes each); links of the others are shuffled.
FREQUENT = 262_144

#: Bits of an id in a link's code.
_SHIFT = 20
_MASK = (1 << _SHIFT) - 1


def common_ends(ends: list[np.ndarray], starts: list[np.ndarray], sizes: list[np.ndarray], run: int = RUN) -> np.ndarray:
    """Places of the ends that two lists share, for many pairs of lists at once: both places, one column a common end.

    Lists lie one after the other in `ends`. The first of a pair drives and should be the shorter one; its last end is also
    the last end of the other. A run's first place in the other list comes from a binary search, later ones by galloping.
    """
    runs = -(-sizes[0] // run)
    number = np.arange(int(runs.sum())) - np.repeat(np.cumsum(runs) - runs, runs)
    first = np.repeat(starts[0], runs) + number * run
    left = np.minimum(np.repeat(starts[0] + sizes[0], runs) - first, run)
    last = np.repeat(starts[1] + sizes[1], runs) - 1
    order = np.argsort(-left, kind="stable")
    first, left, last = first[order], left[order], last[order]
    base = np.repeat(starts[1], runs)[order]
    place = base + _ranks(ends[1], base, last, ends[0][first])
    found = []
    for k in range(int(left.max(initial=0))):
        active = int(np.searchsorted(-left, -k, side="left"))
        wanted = ends[0][first[:active] + k]
        behind = np.flatnonzero(ends[1][place[:active]] < wanted)
        low, high, step = place[behind], last[behind].copy(), 1
        moving = np.arange(len(behind))
        while len(moving):  # doubling steps
            ahead = np.minimum(low[moving] + step, last[behind[moving]])
            short = ends[1][ahead] < wanted[behind[moving]]
            high[moving[~short]] = ahead[~short]
            low[moving[short]] = ahead[short]
            moving, step = moving[short], 2 * step
        place[behind] = _bisect(ends[1], low, high, wanted[behind])
        same = np.flatnonzero(ends[1][place[:active]] == wanted)
        found.append(np.stack([first[same] + k, place[same]]))
    return np.concatenate(found, 1) if found else np.zeros((2, 0), dtype=np.int64)


def _bisect(ends: np.ndarray, low: np.ndarray, high: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The first places with at least the wanted ends, each above its `low` and up to its `high`."""
    while (wide := np.flatnonzero(high - low > 1)).size:
        middle = (low[wide] + high[wide]) // 2
        short = ends[middle] < wanted[wide]
        low[wide] = np.where(short, middle, low[wide])
        high[wide] = np.where(short, high[wide], middle)
    return high


def _ranks(ends: np.ndarray, base: np.ndarray, last: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """How many ends of each one's own list are smaller than the wanted one."""
    return _bisect(ends, base - 1, last.copy(), wanted) - base


class Pair:
    """A byte-level BPE as ranks and a piece tokenizer that puts a space before the text, and the bytes of their tokens.

    Special tokens are in neither: their strings are ordinary text.
    """

    def __init__(self, first: str, second: str):
        import public_tokenizers
        import sentencepiece
        import tiktoken

        with open(tokenizer_path(first), "rb") as file:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
        encoding = tiktoken.Encoding(first, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.encode_first = encoding.encode_ordinary
        self.first_bytes = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.first_bytes[rank] = token
        self.second = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(second))
        pieces = [self.second.id_to_piece(i) for i in range(self.second.get_piece_size())]
        self.second_bytes = [
            bytes([int(piece[3:5], 16)]) if self.second.is_byte(i) else piece.replace("▁", " ").encode()
            for i, piece in enumerate(pieces)
        ]
        self.bytes = self.first_bytes, self.second_bytes
        self.lengths = [np.fromiter(map(len, table), np.int64, len(table)) for table in self.bytes]
        if max(map(len, self.bytes)) > _MASK:
            raise ValueError("vocabularies of over a million tokens are not supported")
        self.names = [f"{i}{mark}" for i in range(max(map(len, self.bytes))) for mark in ",|;"]
        self.name_lengths = np.fromiter(map(len, self.names), np.int64, len(self.names))

    def encode(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        return [self.encode_first(" " + text) for text in texts], self.second.encode(texts, num_threads=1)


@functools.cache
def pair(first: str, second: str) -> Pair:
    """The worker's own, kept from task to task."""
    return Pair(first, second)


@dataclass
class Aligned:
    """By text: numbers of tokens of both sides and of groups, groups as text; and codes of all links with their text's place."""

    sizes: list[np.ndarray]
    n_groups: np.ndarray
    groups: list[str]
    places: np.ndarray
    links: np.ndarray


def align(pair: Pair, texts: list[str]) -> Aligned:
    """Texts that are empty, or whose tokens' bytes are not those of a space and the text on both sides, have no tokens."""
    sides = pair.encode(texts)
    for n, text in enumerate(texts):
        wanted = b" " + text.encode()
        if not text or any(b"".join(map(table.__getitem__, ids[n])) != wanted for table, ids in zip(pair.bytes, sides, strict=True)):
            sides[0][n] = sides[1][n] = []
    sizes = [np.fromiter(map(len, ids), np.int64, len(ids)) for ids in sides]
    starts = [np.concatenate([[0], np.cumsum(n)]) for n in sizes]
    ids = [np.fromiter(chain.from_iterable(own), np.int64, int(at[-1])) for own, at in zip(sides, starts, strict=True)]
    ends = [np.cumsum(length[i]) for length, i in zip(pair.lengths, ids, strict=True)]  # along the bytes of all texts
    found = []
    for order in ([0, 1], [1, 0]):
        drives = (sizes[0] <= sizes[1]) == (order[0] == 0)
        common = common_ends([ends[x] for x in order], [starts[x][:-1][drives] for x in order], [sizes[x][drives] for x in order])
        found.append(common[order])
    a, b = np.sort(np.concatenate(found, 1), 1)  # places of common ends: both rise together

    # a group's tokens of the first side come before those of the second, each side in its own order
    items = np.empty(len(ids[0]) + len(ids[1]), dtype=np.int64)
    group = [_before(common, len(own)) for common, own in zip((a, b), ids, strict=True)]
    shift = np.concatenate([[0], b + 1])[group[0]], np.concatenate([a + 1, [0]])[group[1]]
    for side, (common, mark) in enumerate(((a, 1), (b, 2))):
        marks = np.zeros(len(ids[side]), dtype=np.int64)
        marks[common] = mark
        items[np.arange(len(ids[side])) + shift[side]] = ids[side] * 3 + marks
    shown = "".join(map(pair.names.__getitem__, items.tolist()))
    cuts = np.concatenate([[0], np.cumsum(pair.name_lengths[items])])[starts[0] + starts[1]].tolist()

    # a token overlaps the other side's from the first that ends behind its start to the first that ends at or behind its end
    rank = _before(ends[1] - 1, int(ends[1][-1]) + 1 if len(ends[1]) else 1)  # of every byte: ends up to it
    low = rank[ends[0] - pair.lengths[0][ids[0]]]
    n = rank[ends[0] - 1] - low + 1
    at = np.cumsum(n)
    other = np.repeat(low - at + n, n) + np.arange(at[-1] if len(at) else 0)
    links = (np.repeat(ids[0], n) << _SHIFT) + ids[1][other]
    places = np.repeat(np.repeat(np.arange(len(texts)), sizes[0]), n)
    return Aligned(sizes, np.diff(np.searchsorted(a, starts[0])), [shown[x:y][:-1] for x, y in zip(cuts, cuts[1:])], places, links)


def _before(values: np.ndarray, size: int) -> np.ndarray:
    """For every number from 0 up to `size`: how many of the sorted, distinct values are smaller."""
    held = np.zeros(size + 1, dtype=np.int64)
    held[values + 1] = 1
    return np.cumsum(held)[:size]


def _portions(values: list[str], most: int = PORTION) -> Iterator[tuple[int, int]]:
    start = held = 0
    for n, value in enumerate(values):
        if held and held + len(value) > most:
            yield start, n
            start, held = n, 0
        held += len(value)
    yield start, len(values)


_COUNTS = ["n_a", "n_b", "n_groups"]
_LINKS = pa.struct([("a_id", pa.int32()), ("b_id", pa.int32()), ("n", pa.int32())])


def aligned_texts(docs: DataFrame, first: str = FIRST, second: str = SECOND, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, `groups` as text, and its distinct linked pairs with their numbers."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizers = pair(first, second)
        for batch in small_batches(batches):
            values = texts(batch)
            for start, end in _portions(values):
                found = align(tokenizers, values[start:end])
                pairs, n = np.unique((found.places << 2 * _SHIFT) + found.links, return_counts=True)
                offsets = np.searchsorted(pairs, np.arange(end - start + 1) << 2 * _SHIFT)
                columns = [pa.array(x.astype(np.int32)) for x in ((pairs >> _SHIFT) & _MASK, pairs & _MASK, n)]
                listed = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.StructArray.from_arrays(columns, fields=list(_LINKS)))
                counts = [pa.array(x) for x in (*found.sizes, found.n_groups)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id")[start:end], *counts, pa.array(found.groups, pa.string()), listed], ["doc_id", *_COUNTS, "groups", "links"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    fields = ", ".join(f"{name} long" for name in _COUNTS)
    return rows.mapInArrow(read, f"doc_id long, {fields}, groups string, links array<struct<a_id: int, b_id: int, n: int>>")


def pair_counts(links: DataFrame) -> DataFrame:
    """From one row per document and pair: a_id, b_id, documents, best (whether no other pair of its a_id is in more)."""
    counted = stored(links.groupBy("a_id", "b_id").agg(F.count("*").alias("documents")), "alignment-pairs")
    most = counted.groupBy("a_id").agg(F.max("documents").alias("most"))
    return counted.join(most, "a_id").select("a_id", "b_id", "documents", (F.col("documents") == F.col("most")).alias("best"))


def alignments(docs: DataFrame, first: str = FIRST, second: str = SECOND, derive: dict[str, Column] | None = None, doc_id: str = "doc_id", text: str = "text", frequent: int = FREQUENT) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and `groups`.

    `groups` is the text `a1,a2|b1;a3|b2,b3` of ids between common ends; `derive` names columns to be computed from it
    instead, before results are written. A link is a pair of token occurrences whose byte ranges overlap; `count_sum` adds
    up, over links, in how many documents the pair of ids is linked, and `n_best` counts links whose pair is in as many
    documents as any of its first id's.

    Texts that are null, empty, or whose tokens' bytes of either tokenizer differ from a space and the text have no
    tokens: zeros, '' for groups. Whole texts of any length that fits into a task. Null and
    repeated ids, repeated rows: a row and a document each. Other columns are ignored. An empty table gives an empty result.

    The most frequent pairs, `frequent` of them at most, go to every worker; links of other pairs are joined by a shuffle.
    """
    derive = derive or {"groups": F.col("groups")}
    found = aligned_texts(docs, first, second, doc_id, text)
    found = found.select("doc_id", *_COUNTS, *[column.alias(name) for name, column in derive.items()], "links")
    rows = stored(found.withColumn("row", F.monotonically_increasing_id()), "alignment-rows")
    links = rows.select("row", F.inline("links"))
    pairs = stored(pair_counts(links), "alignment-counts")
    top = stored(pairs.orderBy(F.desc("documents"), "a_id", "b_id").limit(frequent), "alignment-frequent")

    def summed(counted: DataFrame) -> DataFrame:
        best = F.sum(F.when(F.col("best"), F.col("n")).otherwise(0))
        return counted.groupBy("row").agg(F.sum("n").alias("n_links"), best.alias("n_best"), F.sum(F.col("n") * F.col("documents")).alias("count_sum"))

    keys = ["a_id", "b_id"]
    sums = summed(links.join(F.broadcast(top), keys))
    if pairs.count() > frequent:
        sums = sums.unionByName(summed(links.join(F.broadcast(top.select(*keys)), keys, "left_anti").join(pairs, keys)))
        sums = sums.groupBy("row").agg(*[F.sum(name).alias(name) for name in ("n_links", "n_best", "count_sum")])
    joined = rows.drop("links").join(sums, "row", "left")
    return joined.select("doc_id", *_COUNTS, *[F.coalesce(name, F.lit(0)).alias(name) for name in ("n_links", "n_best", "count_sum")], *derive)
