"""Line deduplication by content-defined chunks of lines.

Lines are hashed, and a rolling hash over the last `WINDOW` line hashes decides where a chunk ends, so equal passages are
cut alike wherever they stand in a document. A line of `LONG_LINE` words or more is a chunk by itself. A chunk that has
two lines or more with words in them, or is one long line, is removed wherever it stands but at its first place in the
corpus (smallest doc_id, then position). Every text is cut once, and only hashes of chunks are shuffled to find
candidates; the documents that hold one are then asked for the text of chunks whose hash repeats, which is compared byte
by byte.

Chunks are cut alike only where the lines around them are alike. Passages do not depend on those: the shortest run of
lines from every line on, and up to every line, that holds `LONG_LINE` words. Every repeated run of as many words is
covered by repeated passages, whatever stands around it, and nothing else is. As passages overlap, their SHA-256 digests
are compared in place of their text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hostvane.llm.shared import small_batches, stored, texts, unused

#: Lines that the rolling hash covers, chunks end at one of DIVISOR places on average, and words of a long line.
WINDOW, DIVISOR, LONG_LINE = 2, 2, 50
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_FACTOR), -1, 1 << 64))


def _hashed(lines: list[str]) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(line) for line in lines), dtype=np.uint64, count=len(lines))


def _begins(hashed: np.ndarray, long: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Which lines begin a chunk, by the lines' hashes and places in their documents, which may be several."""
    k = np.arange(len(at))
    rolling = np.zeros(len(at), dtype=np.uint64)
    for back in range(WINDOW):
        inside = at >= back
        rolling[inside] = rolling[inside] * _FACTOR + hashed[k[inside] - back]
    cut = ((rolling * _FACTOR >> np.uint64(40)) % np.uint64(DIVISOR) == 0) & ~long
    head = (at == 0) | np.r_[False, long[:-1]]
    # a chunk that a hash ends has two lines or more: of neighbouring places every second counts
    first = np.maximum.accumulate(np.where(cut & (head | ~np.r_[False, cut[:-1]]), k, 0))
    ends = cut & ((k - first + head[first]) % 2 == 0)
    return head | long | np.r_[False, ends[:-1]]  # a long line also ends what stands before it


def chunk_ends(lines: list[str]) -> list[int]:
    """Ends (exclusive) of the chunks of a text's lines."""
    long = np.array([len(line.split(None, LONG_LINE)) >= LONG_LINE for line in lines])
    begins = _begins(_hashed(lines), long, np.arange(len(lines)))
    return [*np.flatnonzero(begins)[1:].tolist(), len(lines)]


def chunks(text: str) -> list[str]:
    """The text's chunks; joined by line ends they are the text."""
    lines = text.split("\n")
    out, start = [], 0
    for end in chunk_ends(lines):
        out.append("\n".join(lines[start:end]))
        start = end
    return out


def removable(chunk: str) -> bool:
    lines = [line for line in chunk.split("\n") if line.strip()]
    return len(lines) > 1 or any(len(line.split(None, LONG_LINE)) >= LONG_LINE for line in lines)


def _passages(words: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First lines and ends of all passages, by every line's number of words and its document's first line and end."""
    full = np.flatnonzero(words)
    total = np.r_[0, np.cumsum(words[full])]
    last = np.searchsorted(total, total[:-1] + LONG_LINE) - 1  # from every line on
    first = np.searchsorted(total, total[1:] - LONG_LINE, side="right") - 1  # up to every line
    k = np.arange(len(full))
    onward = np.r_[full, len(words)][last] < end[full]
    upto = (first >= 0) & (full[first] >= begin[full])
    start, stop = np.r_[k[onward], first[upto]], np.r_[last[onward], k[upto]]
    several = stop > start
    lines = np.unique(full[start[several]] * (len(words) + 1) + full[stop[several]] + 1)
    return lines // (len(words) + 1), lines % (len(words) + 1)


def passages(text: str) -> list[tuple[int, int]]:
    """(first line, end) of the shortest runs of two lines or more with `LONG_LINE` words, which begin and end with a word."""
    words = np.array([len(line.split()) for line in text.split("\n")])
    start, stop = _passages(words, np.zeros_like(words), np.full_like(words, len(words)))
    return list(zip(start.tolist(), stop.tolist(), strict=True))


def pieces(whole: list[str], with_passages: bool) -> tuple[np.ndarray, ...]:
    """(number of the text, first line, end, hash, is a passage) of the chunks and passages that may be removed."""
    split = [text.split("\n") for text in whole]
    lines = [line for own in split for line in own]
    n_lines = np.array([len(own) for own in split], dtype=np.int64)
    stop = np.cumsum(n_lines)
    doc = np.repeat(np.arange(len(whole)), n_lines)
    begin, end, k = (stop - n_lines)[doc], stop[doc], np.arange(len(lines))
    hashed, words = _hashed(lines), np.fromiter((len(line.split()) for line in lines), dtype=np.int64, count=len(lines))
    long = words >= LONG_LINE
    first = np.flatnonzero(_begins(hashed, long, k - begin))
    last = np.r_[first[1:], len(lines)]
    filled = np.r_[0, np.cumsum(words > 0)]
    may_go = (filled[last] - filled[first] > 1) | long[first]
    first, last = first[may_go], last[may_go]
    passage = np.zeros(len(first), dtype=bool)
    if with_passages:
        a, b = _passages(words, begin, end)
        first, last, passage = np.r_[first, a], np.r_[last, b], np.r_[passage, np.ones(len(a), dtype=bool)]
    # a polynomial of the line hashes, from sums over all lines before: equal for equal runs of lines
    power, inverse = (np.r_[np.uint64(1), np.multiply.accumulate(np.full(len(lines), f))] for f in (_FACTOR, _INVERSE))
    sums = np.r_[np.uint64(0), np.cumsum(hashed * power[:-1], dtype=np.uint64)]
    hashes = (sums[last] - sums[first]) * inverse[first] ^ passage * _FACTOR
    return doc[first], first - begin[first], last - begin[first], hashes.view(np.int64), passage


def without(text: str, ranges: list[tuple[int, int]]) -> tuple[str, int, int]:
    """The text without these ranges of lines, the number of chunks that lose lines, and how many characters they lose."""
    lines, gone = text.split("\n"), set()
    for a, b in ranges:
        gone.update(range(a, b))
    kept, n_chunks, n_chars, start = [], 0, 0, 0
    for end in chunk_ends(lines):
        left = [lines[k] for k in range(start, end) if k not in gone]
        if len(left) < end - start:
            n_chunks += 1
            n_chars += sum(map(len, lines[start:end])) + end - start - 1 - len("\n".join(left))
        kept += left
        start = end
    return "\n".join(kept), n_chunks, n_chars


def _keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).where("text is not null")


def text_hash(text: Column) -> Column:
    """With the doc_id, names a document: rows that repeat both are one document to this operator."""
    return F.xxhash64(text)


def _short_batches(batches: Iterator[pa.RecordBatch], limit: int = 100_000) -> Iterator[pa.RecordBatch]:
    """Cut batches whose texts have few lines in all, or are one."""
    for batch in small_batches(batches):
        start = held = 0
        for k, ends in enumerate(pc.count_substring(batch.column("text"), "\n").to_pylist()):
            if k > start and held + ends + 1 > limit:
                yield batch.slice(start, k - start)
                start, held = k, 0
            held += ends + 1
        yield batch.slice(start)


def _piece_rows(docs: DataFrame, with_passages: bool) -> DataFrame:
    """(doc_id, text_hash, position, end, hash, passage) of lines that may be removed."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _short_batches(batches):
            doc, *found = pieces(texts(batch), with_passages)
            keys = [batch.column(c).take(pa.array(doc)) for c in ("doc_id", "text_hash")]
            yield pa.RecordBatch.from_arrays([*keys, *map(pa.array, found)], names)

    names = ["doc_id", "text_hash", "position", "end", "hash", "passage"]
    schema = "doc_id long, text_hash long, position long, end long, hash long, passage boolean"
    return docs.mapInArrow(cut, schema)


def _with_text(docs: DataFrame, places: DataFrame) -> DataFrame:
    """(doc_id, text_hash, position, end, hash, n_chars, chunk) of these places: a chunk's bytes, a passage's digest."""
    piece = F.struct("position", "end", "hash", "passage")
    held = places.groupBy("doc_id", "text_hash").agg(F.collect_set(piece).alias("held"))
    held = held.select(F.col("doc_id").alias("key"), F.col("text_hash").alias("hashed"), "held")
    same = F.col("doc_id").eqNullSafe(F.col("key")) & (F.col("text_hash") == F.col("hashed"))
    names = ["doc_id", "text_hash", "position", "end", "hash", "n_chars", "chunk"]

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _short_batches(batches):
            held = batch.column("held")
            doc = np.repeat(np.arange(len(held)), pc.list_value_length(held).to_numpy())
            position, end, hashed, passage = held.flatten().flatten()
            split = [text.split("\n") for text in texts(batch)]
            n_chars, known = [], []
            for k, a, b, digest in zip(doc.tolist(), position.to_pylist(), end.to_pylist(), passage.to_pylist(), strict=True):
                chunk = "\n".join(split[k][a:b])
                n_chars.append(len(chunk))
                known.append(hashlib.sha256(chunk.encode()).digest() if digest else chunk.encode())
            keys = [batch.column(c).take(pa.array(doc)) for c in ("doc_id", "text_hash")]
            columns = [*keys, position, end, hashed, pa.array(n_chars, pa.int64()), pa.array(known, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = "doc_id long, text_hash long, position long, end long, hash long, n_chars long, chunk binary"
    return docs.join(held, same).select("doc_id", "text_hash", "text", "held").mapInArrow(fetch, schema)


def repeated_chunks(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", with_passages: bool = False) -> DataFrame:
    """(doc_id, text_hash, position, end, first_doc_id, n_chars) of all lines that go, chunk by chunk, from all documents.

    `position` is the first line. Null text has no chunks. A null doc_id comes after all others. Rows with equal doc_id
    and text are one document. With passages, those that repeat have rows too.
    """
    rows = _keyed(docs, doc_id, text).withColumn("text_hash", text_hash(F.col("text")))
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash", "position")
    places = stored(_piece_rows(rows, with_passages), "pieces-of-lines")  # every text is cut once
    repeated = places.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1").select("hash")
    found = stored(_with_text(rows, places.join(repeated, "hash", "left_semi")), "chunks")
    # written, so that both sides of the join are plain shuffles and a chunk that stands in many documents can be split
    first = stored(found.groupBy("hash", "chunk").agg(F.min(order).alias("first")), "first-chunks")
    same = found.join(first, ["hash", "chunk"]).where(order != F.col("first"))
    places = same.select("doc_id", "text_hash", "position", "end", F.col("first.doc_id").alias("first_doc_id"), "n_chars")
    return places.distinct()


def line_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", with_passages: bool = False) -> DataFrame:
    """All columns of `docs`, with the text without its repeated chunks, and removed_chunks, removed_chars (long).

    With passages, lines go too that stand in a run of `LONG_LINE` words or more found earlier, and removed_chunks counts
    the chunks that lose lines, in whole or in part. Documents in which nothing repeats are unchanged; a document all of
    whose chunks are found earlier gets the empty text. The first copy of a chunk always stays, also among chunks of one
    document; of a passage, every line stays somewhere. Null and empty texts are unchanged. Rows with equal doc_id and
    text are one document: they stay alike. Columns of `docs` that bear the names of the two new ones are replaced;
    all other names are free. An
    empty table gives no rows.
    """
    key, hashed, held = unused(docs, "_key", "_hash", "_ranges")
    gone = repeated_chunks(docs, doc_id, text, with_passages).groupBy("doc_id", "text_hash").agg(
        F.collect_list(F.struct("position", "end")).alias(held)
    )
    gone = gone.select(F.col("doc_id").alias(key), F.col("text_hash").alias(hashed), held)
    same = docs[doc_id].cast("long").eqNullSafe(F.col(key)) & (text_hash(docs[text]) == F.col(hashed))
    counts = ("removed_chunks", "removed_chars")
    joined = docs.join(gone, same, "left").withColumns({c: F.lit(0).cast("long") for c in counts}).drop(key, hashed)

    def rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            whole, out = batch.column(text).to_pylist(), []
            for value, ranges in zip(whole, batch.column(held).to_pylist(), strict=True):
                out.append(without(value, [(r["position"], r["end"]) for r in ranges]) if ranges else (value, 0, 0))
            for name, values in zip((text, *counts), zip(*out, strict=True), strict=False):
                at = batch.schema.get_field_index(name)
                batch = batch.set_column(at, batch.schema.field(at), pa.array(values, batch.schema.field(at).type))
            yield batch.drop_columns([held])

    result = joined.drop(held).schema
    return joined.mapInArrow(rebuild, result)
