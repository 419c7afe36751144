"""Documents that hold benchmark items, exactly or with edits, by random walks that turn edits into changed outputs.

Texts are words joined by single spaces. A random walk over characters embeds the edit distance of two texts into the Hamming
distance of what the walks put out; keys sample some of the steps, for several samplings of several independent walks.
An item is walked from all its places, a document from every `stride`-th one. Keys that agree at about one shift, gathered
over a window of the item's size, place the item; the exact edit distance there, in characters, decides. Walks that stay
on a character or go on to the next one would meet every edit; these go on by one or two, so that changed characters can be
passed over. Short items have shorter walks, and those of very few characters are found by an automaton.

The benchmark is written to the shared folder in blocks of bounded size, which tasks load one at a time.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.dataset
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hostvane.llm.licenses import words as plain_words
from hostvane.llm.shared import small_batches, stored, texts
from hostvane.session import work_dir

#: An item is found where a stretch of a document is within this edit distance, as a share of the item's characters.
MOST_EDITS = 0.2
#: Items of fewer words and fewer bytes are found where a document holds them exactly, as whole words.
LEAST_WORDS, LEAST_BYTES = 10, 40
#: Scripts that are written without spaces, in which a word may end anywhere.
GAPLESS = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3000-\u30ff\u3400-\u9fff\uf900-\ufaff\uff00-\uffef\U00020000-\U0003ffff]")


@dataclass(frozen=True)
class Windows:
    """How items of at least so many characters are walked."""

    chars: int
    steps: int  # of a walk
    sampled: int  # steps that a key is made of
    walks: int
    tables: int  # samplings of each walk
    stride: int  # of places in documents


KINDS = LONG, SHORT, TINY = Windows(80, 11, 9, 8, 2, 4), Windows(32, 7, 6, 6, 2, 2), Windows(0, 4, 4, 6, 1, 1)
#: Walks must agree in one part of an item, of PART characters, and in another for every MORE characters that it has.
PART, MORE = 8, 96
#: Items and characters of a block of the benchmark.
BLOCK_ITEMS, BLOCK_CHARS = 20_000, 4_000_000
CHARS_AT_ONCE = 400_000
#: Verified stretches that a worker keeps, unless they are many times longer than the item.
KEPT_STRETCHES, LONG_STRETCH = 20_000, 8

_MIX = np.uint64(0x9E3779B97F4A7C15)
_STARTS_AT_ONCE = 8_192  # their arrays stay in the processor's cache


def words(text: str) -> list[bytes]:
    return plain_words(text.lower())


class Table:
    """Keys of one sampling of a walk, at all places of the items."""

    def __init__(self, keys: np.ndarray, start: np.ndarray):
        order = np.argsort(keys, kind="stable")
        self.sorted, self.start = keys[order], start[order].astype(np.int32)
        self.shift = np.uint64(64 - min(24, max(16, (16 * len(keys)).bit_length())))
        self.bitmap = np.zeros(1 << (64 - int(self.shift)), bool)
        self.bitmap[keys >> self.shift] = True

    def hits(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index into `keys`, place among the items' characters) of equal keys."""
        maybe = np.flatnonzero(self.bitmap[keys >> self.shift])
        low, high = (np.searchsorted(self.sorted, keys[maybe], side) for side in ("left", "right"))
        n = high - low
        at = np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum())
        return np.repeat(maybe, n), self.start[at].astype(np.int64)


class Walk:
    """A random walk over characters: a step puts out the character that it stands on, and moves on by one or two places as
    a random function of the step and that character says. Texts that differ by edits are walked in step again soon, and a
    character that is passed over may differ. A key mixes the outputs of sampled steps.
    """

    def __init__(self, kind: Windows, number: int):
        rng = np.random.default_rng((20_26, kind.steps, number))
        self.bits = [np.uint64(b) for b in rng.permutation(64)[: kind.steps]]
        self.samples = self._samplings(kind, rng)
        self.factors = rng.integers(1, 1 << 63, kind.steps, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    @staticmethod
    def _samplings(kind: Windows, rng: np.random.Generator) -> list[frozenset[int]]:
        """The first step is always sampled, so no two places have the same walk by chance of where it starts."""
        found: set[frozenset[int]] = set()
        while len(found) < kind.tables:
            found.add(frozenset([0, *(1 + rng.choice(kind.steps - 1, kind.sampled - 1, replace=False)).tolist()]))
        return sorted(found, key=sorted)

    def keys(self, symbols: np.ndarray, start: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
        """A key per sampling for walks from these places, and where the walks end; beyond the text they stay on its last."""
        keys, one, end = [np.zeros(len(start), np.uint64) for _ in self.samples], np.uint64(1), start.copy()
        for first in range(0, len(start), _STARTS_AT_ONCE):
            part = slice(first, first + _STARTS_AT_ONCE)
            at, own = end[part], [k[part] for k in keys]
            read, moved = np.empty(len(at), np.uint64), np.empty(len(at), np.uint64)
            for step, (bit, factor) in enumerate(zip(self.bits, self.factors, strict=True)):
                np.take(symbols, at, out=read, mode="clip")
                np.multiply(read, factor, out=moved)
                for key, sampled in zip(own, self.samples, strict=True):
                    if step in sampled:
                        key += moved
                np.right_shift(read, bit, out=moved)
                moved &= one
                moved += one
                at += moved.view(np.int64)
            for key in own:
                key ^= key >> np.uint64(29)
                key *= _MIX
        return keys, end


def coded(text: str) -> np.ndarray:
    """64 random bits per character."""
    mixed = np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.uint64)
    mixed += np.uint64(1)
    for right in (np.uint64(31), np.uint64(29)):
        mixed *= _MIX
        mixed ^= mixed >> right
    return mixed


class Finder:
    """Items that share a kind of windows."""

    def __init__(self, kind: Windows, items: list[tuple[int, str, int]]):
        self.kind = kind
        self.numbers = np.array([k for k, _, _ in items])
        self.size = np.array([len(wording) for _, wording, _ in items])
        self.most = np.array([most for _, _, most in items])
        self.begin = np.cumsum(np.r_[0, self.size])[:-1]
        chars = coded("".join(wording for _, wording, _ in items))
        place = np.arange(len(chars))
        close = np.repeat(self.begin + self.size, self.size)
        self.walks: list[tuple[Walk, list[Table]]] = []
        for number in range(kind.walks):
            walk = Walk(kind, number)
            keys, end = walk.keys(chars, place)
            inside = end <= close + 1  # the last move is not read any more
            self.walks.append((walk, [Table(k[inside], place[inside]) for k in keys]))

    def candidates(self, chars: np.ndarray, begin: np.ndarray) -> list[tuple[int, int, int, int]]:
        """(document, item, least and greatest shift of the item) of documents that begin at these places of `chars`."""
        start = np.arange(0, len(chars), self.kind.stride)
        if not len(start):
            return []
        found = []
        for walk, tables in self.walks:
            for table, keys in zip(tables, walk.keys(chars, start)[0], strict=True):
                at, place = table.hits(keys)
                found.append((at * self.kind.stride, place))
        at, place = (np.concatenate(x) for x in zip(*found, strict=True))
        if not len(at):
            return []
        document = np.searchsorted(begin, at, side="right") - 1
        item = np.searchsorted(self.begin, place, side="right") - 1
        offset = place - self.begin[item]
        shift = at - begin[document] - offset
        order = np.lexsort((shift, item, document))
        document, item, offset, shift = (x[order] for x in (document, item, offset, shift))
        # runs of shifts without a gap wider than the edits can make
        new = (np.diff(document, prepend=-1) != 0) | (np.diff(item, prepend=-1) != 0) | (np.diff(shift, prepend=0) > self.most[item])
        run = np.cumsum(new) - 1
        first = np.flatnonzero(new)
        parts = np.unique(run << 32 | offset // PART) >> 32
        least = 1 + self.size[item[first]] // MORE
        enough = np.bincount(parts, minlength=len(first)) >= least
        last = np.r_[first[1:], len(run)] - 1
        columns = (document[first], self.numbers[item[first]], shift[first], shift[last])
        return list(zip(*(c[enough].tolist() for c in columns), strict=True))


class Index:
    """The items of a block: what finds their places, and what verification needs."""

    def __init__(self, items: Iterable[tuple[int, str]], most_edits: float = MOST_EDITS):
        self.most_edits = most_edits
        self.items: list[tuple[int, int, str]] = []  # id, words, words joined
        near: dict[Windows, list[tuple[int, str, int]]] = {kind: [] for kind in KINDS}
        self.whole: set[int] = set()  # items that count as whole words alone
        self.exact = ahocorasick.Automaton()
        for item_id, text in items:
            found = words(text or "")
            if not found:
                continue
            wording = b" ".join(found).decode()
            kind = next(kind for kind in KINDS if len(wording) >= kind.chars)
            if whole := len(found) < LEAST_WORDS and len(wording.encode()) < LEAST_BYTES:
                self.whole.add(len(self.items))
            else:
                near[kind].append((len(self.items), wording, int(most_edits * len(wording))))
            if whole or kind is not LONG:
                self.exact.add_word(wording, [*self.exact.get(wording, []), len(self.items)])
            self.items.append((item_id, len(found), wording))
        self.finders = [Finder(kind, own) for kind, own in near.items() if own]
        self.exact.make_automaton()
        self._kept = functools.lru_cache(KEPT_STRETCHES)(self._edits)

    def verified(self, item: int, stretch: str) -> tuple[int, int] | None:
        return (self._edits if len(stretch) > LONG_STRETCH * len(self.items[item][2]) else self._kept)(item, stretch)

    def _edits(self, item: int, stretch: str) -> tuple[int, int] | None:
        """The fewest edits of the item in the stretch and where that ends, or None where there are surely too many.

        k edits leave all but q * k of the item's q-grams unchanged.
        """
        wording = self.items[item][2]
        place = stretch.find(wording)
        if place >= 0:
            return 0, place + len(wording)
        for q in (4, 3):
            there = {stretch[k : k + q] for k in range(len(stretch) - q + 1)}
            kept = sum(wording[k : k + q] in there for k in range(len(wording) - q + 1))
            if kept < len(wording) - q + 1 - q * int(self.most_edits * len(wording)):
                return None
        return fewest_edits_and_end(wording, stretch)

    def matches(self, documents: list[str]) -> Iterator[tuple[int, int, int, int]]:
        """(document, item, edits, first word) of every item found in every document, with the fewest edits."""
        held: list[str] = []
        n_chars = done = 0
        for k, text in enumerate(documents):
            held.append(b" ".join(words(text)).decode())
            n_chars += len(held[-1])
            if k + 1 == len(documents) or n_chars + len(documents[k + 1]) > CHARS_AT_ONCE:
                for document, *match in self._matches_of(held):
                    yield done + document, *match
                done += len(held)
                held, n_chars = [], 0

    def _matches_of(self, found: list[str]) -> Iterator[tuple[int, int, int, int]]:
        best: dict[tuple[int, int], tuple[int, int]] = {}
        if len(self.exact):
            for document, text in enumerate(found):
                for end, items in self.exact.iter(text):
                    place = end + 1 - len(self.items[items[0]][2])
                    whole = apart(text, place) and apart(text, end + 1)
                    for item in items:
                        if whole or item not in self.whole:
                            best.setdefault((document, item), (0, place))
        chars = coded("\n".join(found))
        begin = np.cumsum([0, *(len(text) + 1 for text in found[:-1])])
        for finder in self.finders:
            for document, item, low, high in finder.candidates(chars, begin):
                wording = self.items[item][2]
                if best.get((document, item), (1, 0))[0] == 0:
                    continue
                slack = int(self.most_edits * len(wording)) + 1
                first = max(0, low - slack)
                match = self.verified(item, found[document][first : high + len(wording) + slack])
                if match is not None and match[0] <= self.most_edits * len(wording):
                    now = (match[0], max(0, first + match[1] - len(wording)))
                    best[document, item] = min(best.get((document, item), now), now)
        for (document, item), (edits, place) in sorted(best.items()):
            yield document, item, edits, found[document].count(" ", 0, place)


def apart(text: str, place: int) -> bool:
    """Whether a word may begin or end at this place."""
    around = text[max(0, place - 1) : place + 1]
    return place in (0, len(text)) or " " in around or bool(GAPLESS.search(around))


def fewest_edits(wording: str, stretch: str) -> int:
    """Smallest edit distance of `wording` to any substring of `stretch`."""
    return fewest_edits_and_end(wording, stretch)[0]


def fewest_edits_and_end(wording: str, stretch: str) -> tuple[int, int]:
    """That distance, and the end of the first such substring: bit-parallel columns of the distance table."""
    n = len(wording)
    if not n:
        return 0, 0
    masks: dict[str, int] = {}
    for k, c in enumerate(wording):
        masks[c] = masks.get(c, 0) | 1 << k
    full, top = (1 << n) - 1, 1 << (n - 1)
    plus, minus, score, best, end = full, 0, n, n, 0
    for place, c in enumerate(stretch, 1):
        equal = masks.get(c, 0)
        diagonal = (((equal & plus) + plus) ^ plus) | equal | minus
        more, less = minus | (full & ~(diagonal | plus)), plus & diagonal
        if less & top:
            score -= 1
            if score < best:
                best, end = score, place
        elif more & top:
            score += 1
        more, less = more << 1, less << 1
        plus, minus = (less | ~(diagonal | more)) & full, more & diagonal
    return best, end


def blocks(benchmark: DataFrame, item_id: str = "item_id", text: str = "text") -> list[str]:
    """The items as tables of about BLOCK_ITEMS items and BLOCK_CHARS characters at most; the folders of these tables.

    The driver learns two numbers, from which the number of blocks follows.
    """
    items = benchmark.select(F.col(item_id).cast("long").alias("item_id"), F.col(text).cast("string").alias("text"))
    items = stored(items.where(F.col("text").isNotNull()).distinct(), "items")
    n, chars = items.agg(F.count("*"), F.coalesce(F.sum(F.length("text")), F.lit(0))).first()
    number = max(-(-n // BLOCK_ITEMS), -(-chars // BLOCK_CHARS))
    if not number:
        return []
    path = work_dir(benchmark.sparkSession, "item-blocks")
    dealt = items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(number)))
    dealt.repartition(number, "block").write.partitionBy("block").parquet(path)
    return [f"{path}/block={k}" for k in range(number)]


_BUILT: list = []  # the folder of a block and its index, kept by the worker from task to task


def _index(path: str, most_edits: float) -> Index:
    if not _BUILT or _BUILT[0] != path or _BUILT[1].most_edits != most_edits:
        _BUILT.clear()
        store, folder = fs.FileSystem.from_uri(path)
        items = []
        if store.get_file_info(folder).type == fs.FileType.Directory:  # a block that no item was dealt to has no folder
            block = pa.dataset.dataset(folder, filesystem=store, format="parquet").to_table(columns=["item_id", "text"])
            items = sorted(zip(*(c.to_pylist() for c in block.columns), strict=True), key=lambda i: (i[0] is None, i[0] or 0, i[1]))
        _BUILT[:] = [path, Index(items, most_edits)]
    return _BUILT[1]


def leaks(docs: DataFrame, benchmark: DataFrame, most_edits: float = MOST_EDITS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document and item found in it: doc_id, item_id, edits, similarity, first_word.

    Texts are lower-cased words of letters of any script and digits, joined by single spaces; `edits` is the smallest
    edit distance of the item to a stretch of the document. Items of fewer than `LEAST_WORDS` words and
    `LEAST_BYTES` bytes are found as whole words without an edit. Null and empty items, and null and empty texts, match
    nothing. Repeated items count once; repeated documents give their rows again; null ids stay null. Texts of any
    length are searched whole. Other columns are ignored. Empty tables give no rows.
    """
    schema = "doc_id long, item_id long, edits long, similarity double, first_word long"
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    spark = docs.sparkSession

    def found_in(block):
        def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = _index(block, most_edits)
            for batch in small_batches(batches):
                ids, out = batch.column("doc_id").to_pylist(), []
                for document, item, edits, begin in index.matches(texts(batch)):
                    item_id, _, wording = index.items[item]
                    out.append((ids[document], item_id, edits, 1 - edits / len(wording), begin))
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.int64()]
                columns = zip(*out, strict=True) if out else [()] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["doc_id", "item_id", "edits", "similarity", "first_word"])

        return rows.mapInArrow(search, schema)

    results = [found_in(block) for block in blocks(benchmark)]
    return functools.reduce(DataFrame.unionByName, results, spark.createDataFrame([], schema)) if len(results) != 1 else results[0]


def without_leaks(docs: DataFrame, benchmark: DataFrame, most_edits: float = MOST_EDITS) -> DataFrame:
    """The documents in which no item is found, with all their columns, without any shuffle.

    What one block leaves is written before the next one is searched. Null and empty texts stay, and so do all documents
    where there are no items; repeated rows stay or go together; texts of any length are searched whole.
    """
    for number, block in enumerate(blocks(benchmark)):

        def clean(batches: Iterator[pa.RecordBatch], block=block) -> Iterator[pa.RecordBatch]:
            index = _index(block, most_edits)
            for batch in small_batches(batches):
                leaking = {document for document, *_ in index.matches(texts(batch))}
                yield batch.filter(pa.array([k not in leaking for k in range(batch.num_rows)], pa.bool_()))

        docs = (stored(docs, "unleaked") if number else docs).mapInArrow(clean, docs.schema)
    return docs
