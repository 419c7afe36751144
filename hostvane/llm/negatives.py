"""Exact hard negatives through an inverted multi-index.

A vector is cut into two halves, and each half has a codebook of its own; a pair of codewords is a cell. For a vector q, no
member of the cell (i, j) has a larger inner product with q than q1.c1[i] + |q1| r1 + q2.c2[j] + |q2| r2, with r1 and r2
the radii of the cell's halves. An anchor visits cells by a heap over both sorted lists of half bounds, largest sum first.

Members are dealt out once, in order of label and cell, to shelves of bounded size; anchors and their windows lie in blocks
of bounded size in the shared folder. Every task holds one shelf and loads one block after the other, so that what it holds
follows neither the number of members nor that of anchors, and nothing is shuffled for a pair of anchor and cell.

There are three passes for an anchor's positives and three for the negatives of their windows. The first visits the best
cells only, the second every cell of a share of the members that grows with their square root; both give scores that are
reached for certain. The last visits the cells of all other members. The second and third leave out no cell but those whose
bound stays below these scores, so that all they leave out is certified to be worse. Codebooks come from a bounded sample;
they change the speed, not the result.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.dataset
from pyarrow import fs
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hostvane.llm.shared import stored
from hostvane.llm.topk import quantised, usable
from hostvane.session import work_dir

#: Vectors that the codebooks are fitted on, rounds of fitting, members of a cell wanted on average, codewords of a half at most.
SAMPLE_ROWS, ROUNDS, CELL, MOST_WORDS = 16_384, 8, 512, 256
#: Members of a shelf, anchors of a block, components of either; members visited first, in so many cells. All at most.
CHUNK, BLOCK, COMPONENTS, PROBE, PROBE_CELLS = 131_072, 65_536, 2**23, 4_096, 64
#: Anchors and members that are multiplied at once, cells whose bounds are compared at once, anchors for numbers beyond doubles.
TILE, RUN, SLAB, FEW = 1_024, 1_024, 512, 64
#: Every so many bounds are compared first; where more of them are reached than this share, all members are multiplied.
EVERY, MANY = 16, 0.75
#: Found scores that are put in order at once, rows that are handed to Spark at once.
PENDING, ROWS_OUT = 2**17, 2**16

_LONG = 2**63 - 1
_NONE = -_LONG - 1


def codebook(points: np.ndarray, words: int, rounds: int = ROUNDS) -> np.ndarray:
    """Centers of groups of near points (Lloyd's rounds from evenly spaced points in order of their first component)."""
    points = np.unique(points.astype(np.float64), axis=0)
    if not len(points):
        return np.zeros((1, points.shape[1]))
    centers = points[np.linspace(0, len(points) - 1, min(words, len(points))).astype(int)]
    for _ in range(rounds):
        nearest = nearest_word(points, centers)
        sums = np.zeros_like(centers)
        np.add.at(sums, nearest, points)
        counts = np.bincount(nearest, minlength=len(centers))
        centers = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centers)
    return centers


def nearest_word(points: np.ndarray, centers: np.ndarray) -> np.ndarray:
    return ((centers**2).sum(1) - 2 * points @ centers.T).argmin(1)


@dataclass
class Directory:
    """The cells that have members: number, radii of both halves, members, and shelves that these fill."""

    half: int
    books: tuple[np.ndarray, np.ndarray]
    numbers: list[int]
    radii: np.ndarray
    members: list[int]
    chunks: list[int]

    def __post_init__(self):
        self.at = {number: k for k, number in enumerate(self.numbers)}
        self.widest = [np.zeros(len(book)) for book in self.books]
        for number, radii in zip(self.numbers, self.radii, strict=True):
            for side, word in enumerate(divmod(number, MOST_WORDS)):
                self.widest[side][word] = max(self.widest[side][word], radii[side])

    def visit(self, q: np.ndarray) -> Iterator[tuple[int, float, float, float]]:
        """Cells by the summed bounds of their codewords, largest first: position, the cell's own upper and lower bound,
        and a bound for this cell and all later ones."""
        parts = (q[: self.half], q[self.half :])
        scores = [book @ part for book, part in zip(self.books, parts, strict=True)]
        norms = [float(np.sqrt(part @ part)) for part in parts]
        uppers = [score + norm * wide for score, norm, wide in zip(scores, norms, self.widest, strict=True)]
        slack = 1e-9 * (1 + sum(float(np.abs(book).max(initial=0)) * float(np.abs(q).sum()) for book in self.books))
        first, second = (np.argsort(-upper, kind="stable") for upper in uppers)

        def bound(a: int, b: int) -> float:
            return float(uppers[0][first[a]] + uppers[1][second[b]])

        heap = [(-bound(0, 0), 0, 0)]
        while heap:
            rest, a, b = heapq.heappop(heap)
            if b + 1 < len(second):
                heapq.heappush(heap, (-bound(a, b + 1), a, b + 1))
            if b == 0 and a + 1 < len(first):
                heapq.heappush(heap, (-bound(a + 1, 0), a + 1, 0))
            i, j = int(first[a]), int(second[b])
            k = self.at.get(i * MOST_WORDS + j)
            if k is not None:
                middle, away = scores[0][i] + scores[1][j], norms[0] * self.radii[k, 0] + norms[1] * self.radii[k, 1]
                yield k, middle + away + slack, middle - away - slack, slack - rest


def _packed(rows: DataFrame) -> DataFrame:
    """Vectors as bytes: whole numbers of two bytes, or of eight in a vector that needs them (`wide`)."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("vector")
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype("<i8", copy=False)
            ends = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
            large = np.concatenate([[0], np.cumsum((flat < -(2**15)) | (flat >= 2**15))])
            wide = large[ends[1:]] > large[ends[:-1]]
            short, long = flat.astype("<i2").tobytes(), flat.tobytes() if wide.any() else b""
            parts = [long[8 * a : 8 * b] if w else short[2 * a : 2 * b] for a, b, w in zip(ends[:-1].tolist(), ends[1:].tolist(), wide.tolist(), strict=True)]
            columns = [pa.array(parts, pa.binary()) if c == "vector" else batch.column(c) for c in batch.schema.names]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(wide)], [*batch.schema.names, "wide"])

    fields = ", ".join(f"{f.name} {'binary' if f.name == 'vector' else f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(pack, f"{fields}, wide boolean")


def _vectors(packed: list[bytes], wide: np.ndarray, width: int) -> np.ndarray:
    """Packed vectors as rows of whole numbers; missing components at the end are 0."""
    if not wide.any() and all(len(data) == 2 * width for data in packed):
        return np.frombuffer(b"".join(packed), "<i2").reshape(-1, width)
    out = np.zeros((len(packed), width), np.int64 if wide.any() else np.int16)
    for own, data, w in zip(out, packed, wide, strict=True):
        part = np.frombuffer(data, "<i8" if w else "<i2")
        own[: len(part)] = part
    return out


def _numbers(table: pa.Table | pa.RecordBatch, column: str) -> np.ndarray:
    return table.column(column).to_numpy(zero_copy_only=False) if isinstance(table, pa.RecordBatch) else table.column(column).to_numpy()


def _points(table: pa.Table | pa.RecordBatch, width: int) -> np.ndarray:
    return _vectors(table.column("vector").to_pylist(), _numbers(table, "wide").astype(bool), width)


def _books(rows: DataFrame, width: int, size: int, sample_rows: int, cell: int) -> tuple[np.ndarray, np.ndarray]:
    """Both codebooks, from rows drawn by a hash. The number of codewords follows the number of all rows, up to MOST_WORDS.

    Only rows with small hashes are put in order, about twice as many as are drawn.
    """
    share = min(1.0, 2 * (sample_rows + 1_000) / max(1, size))
    some = rows.where(F.xxhash64("row") <= F.lit(min(_LONG, _NONE + int(share * 2**64))))
    drawn = some.orderBy(F.xxhash64("row"), "row").limit(sample_rows).select("vector", "wide").collect()
    points, half = _vectors([bytes(r.vector) for r in drawn], np.array([r.wide for r in drawn], bool), width), -(-width // 2)
    words = int(min(MOST_WORDS, max(1, np.ceil(np.sqrt(size / cell)))))
    return codebook(points[:, :half], words), codebook(points[:, half:], words)


def _placed(rows: DataFrame, books: tuple[np.ndarray, np.ndarray], width: int) -> DataFrame:
    """Rows with their cell and both distances from its codewords."""
    half = -(-width // 2)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = _points(batch, width).astype(np.float64)
            words, away = [], []
            for book, part in zip(books, (points[:, :half], points[:, half:]), strict=True):
                words.append(nearest_word(part, book))
                away.append(np.sqrt(((part - book[words[-1]]) ** 2).sum(1)) * (1 + 1e-9))
            columns = [words[0].astype(np.int64) * MOST_WORDS + words[1], *away]
            yield pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, columns)], [*batch.schema.names, "cell", "away_0", "away_1"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(place, f"{fields}, cell long, away_0 double, away_1 double")


def _dealt(placed: DataFrame, size: int, chunk: int) -> DataFrame:
    """Members in order of label and cell, a little less than a shelf in a file; small tables still go to every core.

    Files are written plainly, so that their sizes, by which Spark deals them to tasks, follow their members.
    """
    spark = placed.sparkSession
    tasks = min(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    files = max(1, -(-size * 5 // (chunk * 4)), min(tasks, -(-size // 1_024)))
    dealt = placed.repartitionByRange(files, "label", "cell", "row").select("vec_id", "label", "vector", "wide", "cell", "away_0", "away_1")
    path = work_dir(spark, "negatives-members")
    dealt.write.option("compression", "none").option("parquet.enable.dictionary", "false").parquet(path)
    return spark.read.schema(dealt.schema).parquet(path)


def _probed(asked: DataFrame, directory: Broadcast, width: int, probe: int) -> DataFrame:
    """With the best cells of every anchor: as many as hold `probe` members, of the first PROBE_CELLS that it visits."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = directory.value
        for batch in batches:
            found = []
            for q, lows, highs in zip(_points(batch, width).astype(np.float64), batch.column("lows").to_pylist(), batch.column("highs").to_pylist(), strict=True):
                low, high, seen, cells = float(min(lows)), float(max(highs)), 0, []
                for k, upper, lower, rest in islice(index.visit(q), PROBE_CELLS):
                    if rest < low or seen >= probe:
                        break
                    if upper >= low and lower <= high:
                        seen += index.members[k]
                        cells.append(index.numbers[k])
                found.append(cells)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.list_(pa.int64()))], [*batch.schema.names, "cells"])

    n = int(asked.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in asked.schema)
    return asked.repartition(n, "row").mapInArrow(ask, f"{fields}, cells array<long>")


def _blocks(asked: DataFrame, blocks: int) -> list[str]:
    """The folders of the blocks of anchors with their windows."""
    path = work_dir(asked.sparkSession, "negatives-blocks")
    asked.repartition(blocks, "block").write.partitionBy("block").parquet(path)
    return [f"{path}/block={k}" for k in range(blocks)]


class _Shelf:
    """Members in order of label and cell. A span is what a cell has of a label, up to RUN members."""

    def __init__(self, table: pa.Table, books: tuple[np.ndarray, np.ndarray], width: int):
        table = table.take(np.lexsort((_numbers(table, "cell"), _numbers(table, "label"))))
        self.ids, self.labels, cells = (_numbers(table, c) for c in ("vec_id", "label", "cell"))
        self.vectors, self.books = _points(table, width), books
        cuts = np.flatnonzero((self.labels[1:] != self.labels[:-1]) | (cells[1:] != cells[:-1])) + 1
        edges = zip([0, *cuts], [*cuts, len(cells)], strict=True)
        self.starts = np.array([at for start, end in edges for at in range(start, end, RUN)], dtype=np.int64)
        self.ends = np.append(self.starts[1:], len(cells))
        self.span_labels, self.span_cells = self.labels[self.starts], cells[self.starts]
        self.words = np.divmod(self.span_cells, MOST_WORDS)
        self.radii = [np.maximum.reduceat(_numbers(table, c), self.starts) for c in ("away_0", "away_1")]
        self.largest = np.maximum.reduceat(_largest(self.vectors), self.starts)


def _shelves(batches: Iterator[pa.RecordBatch], chunk: int) -> Iterator[pa.Table]:
    """What a task reads, in tables of `chunk` rows at most."""
    held, n = [], 0
    for batch in batches:
        for at in range(0, batch.num_rows, chunk):
            part = batch.slice(at, chunk)
            if n + part.num_rows > chunk:
                yield pa.Table.from_batches(held)
                held, n = [], 0
            held.append(part)
            n += part.num_rows
    if n:
        yield pa.Table.from_batches(held)


def _largest(vectors: np.ndarray) -> np.ndarray:
    """The largest absolute value in each vector."""
    return np.maximum(vectors.max(1).astype(np.float64), -vectors.min(1).astype(np.float64))


class _Block:
    """Anchors in order of label and cell, their windows, and the k best members of every window so far.

    Of a window, scores count that are above its low, or equal to it with a vec_id up to its last; and up to its high.
    """

    def __init__(self, table: pa.Table, width: int, places: int, k: int):
        table = table.take(np.lexsort((_numbers(table, "cell"), _numbers(table, "label")))).combine_chunks()
        self.rows, self.ids, self.labels = (_numbers(table, c) for c in ("row", "anchor_id", "label"))
        self.vectors, self.k = _points(table, width), k
        self.largest = _largest(self.vectors)
        (own, place), shape = _listed(table, "places"), (len(self.rows), places)
        self.lows, self.lasts, self.highs = np.full(shape, _LONG), np.full(shape, _LONG), np.full(shape, -_LONG)
        for values, c in ((self.lows, "lows"), (self.lasts, "lasts"), (self.highs, "highs")):
            values[own, place] = _listed(table, c)[1]
        self.low, self.high = self.lows.min(1), self.highs.max(1)
        self.scores, self.best = np.full((*shape, k), _NONE), np.full((*shape, k), _LONG)
        self.asks = _listed(table, "cells") if "cells" in table.schema.names else None

    def add(self, n: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """Members with these scores for the anchors n."""
        for place in range(self.lows.shape[1]):
            low = self.lows[n, place]
            good = np.flatnonzero((scores <= self.highs[n, place]) & ((scores > low) | (scores == low) & (ids <= self.lasts[n, place])))
            if not len(good):
                continue
            own, at = np.unique(n[good], return_inverse=True)
            at = np.concatenate([np.repeat(np.arange(len(own)), self.k), at])
            all_scores = np.concatenate([self.scores[own, place].ravel(), scores[good]])
            all_ids = np.concatenate([self.best[own, place].ravel(), ids[good]])
            order = np.lexsort((all_ids, ~all_scores, at))
            first = np.searchsorted(at[order], np.arange(len(own)))
            kept = order[(first[:, None] + np.arange(self.k)).ravel()].reshape(-1, self.k)
            self.scores[own, place], self.best[own, place] = all_scores[kept], all_ids[kept]
            full = all_scores[kept[:, -1]] != _NONE
            self.lows[own[full], place], self.lasts[own[full], place] = all_scores[kept[full, -1]], all_ids[kept[full, -1]]
            self.low[own] = self.lows[own].min(1)

    def found(self) -> Iterator[pa.RecordBatch]:
        n, place, k = np.nonzero(self.scores != _NONE)
        columns = [self.rows[n], place.astype(np.int32), self.best[n, place, k], self.scores[n, place, k]]
        for at in range(0, len(n), ROWS_OUT):
            yield pa.RecordBatch.from_arrays([pa.array(c[at : at + ROWS_OUT]) for c in columns], ["row", "place", "vec_id", "score"])


def _listed(table: pa.Table, column: str) -> tuple[np.ndarray, np.ndarray]:
    """The values of a column of lists, and the rows that have them."""
    lists = table.column(column).combine_chunks()
    lists = pa.concat_arrays(lists.chunks) if isinstance(lists, pa.ChunkedArray) else lists
    return np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy(zero_copy_only=False)), lists.flatten().to_numpy(zero_copy_only=False)


def _asked_spans(shelf: _Shelf, block: _Block, same: bool) -> Iterator[tuple[np.ndarray, int, int]]:
    """Anchors and the spans of the cells that they have listed."""
    own, cells = block.asks
    order = np.argsort(cells, kind="stable")
    own, cells = own[order], cells[order]
    for k in np.flatnonzero(np.isin(shelf.span_cells, cells)):
        start, end = np.searchsorted(cells, shelf.span_cells[k], "left"), np.searchsorted(cells, shelf.span_cells[k], "right")
        who = own[start:end]
        yield who[(block.labels[who] == shelf.span_labels[k]) == same], k, k + 1


def _reached_spans(shelf: _Shelf, block: _Block, same: bool) -> Iterator[tuple[np.ndarray, int, int]]:
    """Anchors and spans, but for those whose bound is below all windows of the anchor or that are wholly above them."""
    half = shelf.books[0].shape[1]
    for a in range(0, len(block.rows), TILE):
        q, labels = block.vectors[a : a + TILE].astype(np.float64), block.labels[a : a + TILE]
        parts = q[:, :half], q[:, half:]
        scores = [part @ book.T for part, book in zip(parts, shelf.books, strict=True)]
        norms = [np.sqrt((part**2).sum(1))[:, None] for part in parts]
        slack = 1e-9 * (1 + sum(float(np.abs(book).max(initial=0)) for book in shelf.books) * np.abs(q).sum(1))[:, None]
        low, high = block.low[a : a + TILE], block.high[a : a + TILE]  # views that rise with the block's

        def reached(spans: slice) -> np.ndarray:
            middle = scores[0][:, shelf.words[0][spans]] + scores[1][:, shelf.words[1][spans]]
            away = norms[0] * shelf.radii[0][spans] + norms[1] * shelf.radii[1][spans] + slack
            return (middle + away >= low[:, None]) & (middle - away <= high[:, None])

        for b in range(0, len(shelf.starts), SLAB):
            ok = (labels[:, None] == shelf.span_labels[b : b + SLAB]) == same
            some = ok[:, ::EVERY]
            if np.count_nonzero(some & reached(slice(b, b + SLAB, EVERY))) <= MANY * np.count_nonzero(some):  # else bounds cost more than they save
                ok &= reached(slice(b, b + SLAB))
            if not ok.any():
                continue
            for start, end in _runs(shelf, np.flatnonzero(ok.any(0)) + b, same):
                yield a + np.flatnonzero(ok[:, start - b : end - b].any(1)), start, end


def _runs(shelf: _Shelf, spans: np.ndarray, same: bool) -> Iterator[tuple[int, int]]:
    """Neighbouring spans together, up to RUN members; of one label, if anchors ask for their own."""
    start = end = -1
    for k, first, label in zip(spans.tolist(), shelf.starts[spans].tolist(), shelf.span_labels[spans].tolist(), strict=True):
        if k != end or shelf.ends[k] - since > RUN or same and label != of:
            if end > start:
                yield start, end
            start, since, of = k, first, label
        end = k + 1
    if end > start:
        yield start, end


def _hits(reach: np.ndarray, size: int) -> np.ndarray:
    """Where the first `size` values are true, by words of eight; few are."""
    reach[size : size + 8] = False
    words = np.flatnonzero(reach[: -(-size // 8) * 8].view(np.uint64) != 0)
    word, at = np.nonzero(reach[: -(-size // 8) * 8].reshape(-1, 8)[words])
    return words[word] * 8 + at


def _meet(shelf: _Shelf, block: _Block, same: bool) -> None:
    """Bring the block's best up to date with the members of the shelf."""
    pending, n_pending = [], 0
    buffer, reach = np.empty(TILE * RUN, np.float32), np.zeros(TILE * RUN + 8, bool)
    for who, first, after in (_reached_spans if block.asks is None else _asked_spans)(shelf, block, same):
        if not len(who):
            continue
        start, end = shelf.starts[first], shelf.ends[after - 1]
        largest = block.largest[who].max() * shelf.largest[first:after].max() * shelf.vectors.shape[1]
        kind = np.float32 if largest < 2**24 else np.float64 if largest < 2**53 else object  # sums of products are exact
        members = shelf.vectors[start:end].astype(kind).T
        for at in range(0, len(who), FEW if kind is object else TILE):
            own = who[at : at + (FEW if kind is object else TILE)]
            queries, shape = block.vectors[own].astype(kind), (len(own), end - start)
            out = buffer[: shape[0] * shape[1]].reshape(shape) if kind is np.float32 else None
            table = queries @ members if out is None else np.matmul(queries, members, out=out)
            reached = reach[: table.size].reshape(shape)
            np.greater_equal(table, block.low[own].astype(kind)[:, None], out=reached)
            if kind is object or np.count_nonzero(reached) > reached.size // 64:
                reached &= table <= block.high[own].astype(kind)[:, None]
            hits = _hits(reach, table.size)
            if not len(hits):
                continue
            n, m = np.divmod(hits, shape[1])
            scores, n, m = table.ravel()[hits].astype(np.int64), own[n], m + start
            good = (shelf.ids[m] != block.ids[n]) & ((shelf.labels[m] == block.labels[n]) == same) & (scores <= block.high[n])
            pending.append((n[good], scores[good], shelf.ids[m[good]]))
            n_pending += len(pending[-1][0])
            if n_pending >= PENDING:
                block.add(*map(np.concatenate, zip(*pending, strict=True)))
                pending, n_pending = [], 0
    if n_pending:
        block.add(*map(np.concatenate, zip(*pending, strict=True)))


def _answers(members: DataFrame, folders: list[str], books: tuple[np.ndarray, np.ndarray], width: int, k: int, places: int, same: bool, chunk: int) -> DataFrame:
    """Every shelf's k best members of every window: row, place (of the window), vec_id, score. `same`: of the anchor's label.

    Blocks with `cells` ask these cells alone, the others all that their bounds leave.
    """

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _shelves(batches, chunk):
            shelf = _Shelf(table, books, width)
            for folder in folders:
                store, path = fs.FileSystem.from_uri(folder)
                if store.get_file_info(path).type != fs.FileType.Directory:  # a block that no anchor was dealt to has no folder
                    continue
                asked = pa.dataset.dataset(path, filesystem=store, format="parquet").to_table()
                if same:
                    asked = asked.filter(pa.array(np.isin(_numbers(asked, "label"), shelf.span_labels)))
                if asked.num_rows:
                    block = _Block(asked, width, places, k)
                    _meet(shelf, block, same)
                    yield from block.found()

    return members.mapInArrow(answer, "row long, place int, vec_id long, score long")


def _asked(anchors: DataFrame, windows: DataFrame) -> DataFrame:
    """Anchors with their windows, in order of place."""
    names = ("place", "low", "last", "high")
    listed = windows.groupBy("row").agg(F.sort_array(F.collect_list(F.struct(*names))).alias("w"))
    return anchors.join(listed, "row").withColumns({f"{c}s": F.col(f"w.{c}") for c in names}).drop("w")


def _raised(windows: DataFrame, found: DataFrame, k: int) -> DataFrame:
    """Windows down to the last of k members that are known to lie in them, and as they were where fewer are known."""
    best = F.sort_array(F.collect_list(F.struct("score", F.bitwise_not("vec_id").alias("id"))), asc=False)
    floors = found.groupBy("row", "place").agg(F.get(best, F.lit(k - 1)).alias("kth"))
    raised = {"low": F.coalesce("kth.score", "low"), "last": F.coalesce(F.bitwise_not("kth.id"), "last")}
    return stored(windows.join(floors, ["row", "place"], "left").withColumns(raised).drop("kth"), "negatives-windows")


def hard_negatives(vectors: DataFrame, is_anchor: Column, label: str | Column = "label", positives: int = 5, negatives: int = 5, vec_id: str = "vec_id", embedding: str = "embedding", cell: int = CELL, chunk: int = CHUNK, block: int = BLOCK, probe: int = PROBE, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Per anchor and positive: the best rows of another label that score at least 80 % of the positive and no more than it.

    Components become floor(256 * x); a score is the integer inner product with the anchor; higher scores first, ties by
    smaller vec_id. An anchor's positives are its `positives` first rows of the same label with another vec_id. Returns
    anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score; pairs without a negative have no row.

    Rows with a null id, label or vector, or with null or non-finite components, take no part. Missing components at the
    end count as 0, an empty vector scores 0. Repeated rows count each: repeated anchors give their rows again, repeated
    candidates take several places. Scores are cut to the range of a long. Of longer vectors, fewer are held at once. Other
    columns are ignored; no anchors or no candidates, no rows.
    """
    spark = vectors.sparkSession
    own_label = F.col(label) if isinstance(label, str) else label
    kept = vectors.where(usable(vec_id, embedding) & own_label.isNotNull()).select(
        F.col(vec_id).cast("long").alias("vec_id"), own_label.cast("long").alias("label"), quantised(embedding).alias("vector"), F.coalesce(is_anchor, F.lit(False)).alias("asks")
    )
    rows = stored(_packed(kept.withColumn("row", F.monotonically_increasing_id())), "negatives-rows")
    components = F.coalesce(F.max(F.expr("length(vector) div if(wide, 8, 2)")), F.lit(0))
    size, asking, width = rows.agg(F.count("*"), F.count_if("asks"), components).first()
    width = max(2, width)
    chunk, block = (max(1, min(most, COMPONENTS // own)) for most, own in ((chunk, width), (block, max(width, 4 * positives * negatives))))
    blocks = max(1, -(-asking // block))

    books = _books(rows, width, size, sample_rows, cell)
    placed = stored(_placed(rows, books, width), "negatives-placed")
    cells = placed.groupBy("cell").agg(F.max("away_0").alias("r_0"), F.max("away_1").alias("r_1"), F.count("*").alias("n"), F.ceil(F.count("*") / chunk).alias("chunks"))
    found = cells.orderBy("cell").collect()  # MOST_WORDS squared at most
    directory = spark.sparkContext.broadcast(
        Directory(-(-width // 2), books, [r.cell for r in found], np.array([[r.r_0, r.r_1] for r in found]).reshape(-1, 2), [r.n for r in found], [r.chunks for r in found])
    )
    shares = max(1, int(np.ceil(np.sqrt(size / chunk))))
    share = F.pmod(F.xxhash64("row", F.lit(1)), F.lit(shares))
    first = _dealt(placed.where(share == 0), size // shares, chunk)
    rest = _dealt(placed.where(share != 0), size - size // shares, chunk) if shares > 1 else None
    every = first.unionByName(rest) if shares > 1 else first
    dealt = F.pmod(F.xxhash64("row"), F.lit(blocks)).alias("block")
    anchors = stored(placed.where("asks").select("row", dealt, F.col("vec_id").alias("anchor_id"), "label", "vector", "wide", "cell"), "negatives-anchors")

    def search(windows: DataFrame, k: int, places: int, same: bool) -> DataFrame:
        """The k best members of every window, and some more."""

        def answers(members: DataFrame, asked: DataFrame) -> DataFrame:
            return _answers(members, _blocks(asked, blocks), books, width, k, places, same, chunk)

        windows = _raised(windows, answers(every, _probed(_asked(anchors, windows), directory, width, probe)), k)
        found = stored(answers(first, _asked(anchors, windows)), "negatives-found")
        if rest is None:
            return found
        return found.unionByName(answers(rest, _asked(anchors, _raised(windows, found, k))))

    best_first = F.desc("score"), "vec_id"
    everything = anchors.select("row", F.lit(0).alias("place"), F.lit(-_LONG).alias("low"), F.lit(_LONG).alias("last"), F.lit(_LONG).alias("high"))
    ranked = search(everything, positives, 1, True).withColumn("n", F.row_number().over(Window.partitionBy("row").orderBy(*best_first)))
    pairs = stored(ranked.where(F.col("n") <= positives).select("row", "n", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "negatives-pairs")

    # a window from 80 % of the positive's score to all of it is empty for negative scores; equal positives share a window
    low = F.expr("positive_score div 5 * 4 + (positive_score % 5 * 4 + 4) div 5").alias("low")
    windows = pairs.where("positive_score >= 0").groupBy("row", "positive_score").agg((F.min("n") - 1).alias("place"))
    windows = stored(windows.select("row", "place", low, F.lit(_LONG).alias("last"), F.col("positive_score").alias("high")), "negatives-windows")
    rank = F.row_number().over(Window.partitionBy("row", "place").orderBy(*best_first))
    mined = search(windows, negatives, positives, False).withColumn("rank", rank).where(F.col("rank") <= negatives)
    named = mined.join(windows.select("row", "place", F.col("high").alias("positive_score")), ["row", "place"]).join(pairs, ["row", "positive_score"])
    named = named.join(anchors.select("row", "anchor_id"), "row")
    return named.select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
