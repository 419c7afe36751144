"""Exact token counts per document by a two-tier lookup, without shuffling pre-tokens.

First pass: every task counts the pieces of all its texts in a table of fixed size and reports its most frequent ones;
only those short reports are summed. The most frequent pieces of the corpus, with their lengths in tokens, are broadcast
as a compact table (`FREQUENT` entries at most, so its size has a bound). Second pass: a worker looks pieces up in that
table, then in its own memory, and gives the rest to the tokenizer. Counts are exact whatever the table holds.
"""

from __future__ import annotations

from array import array
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hostvane.llm.shared import small_batches, texts
from hostvane.llm.tokens import DEFAULT_FILE, LONGEST_KEPT, PieceLengths, encoder

#: Entries of the broadcast table, entries of one task's report, and pieces that a task counts at a time.
FREQUENT, REPORTED, COUNTED = 32_768, 4_096, 200_000


def frequent_pieces(docs: DataFrame, text: str = "text") -> DataFrame:
    """(piece, n) of the corpus's most frequent pieces, from every text."""

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()
        for batch in small_batches(batches):
            for value in texts(batch):
                seen.update(value.split(" ")[1:])
            if len(seen) > 2 * COUNTED:
                seen = Counter(dict(seen.most_common(COUNTED)))
        top = [(p, n) for p, n in seen.most_common(REPORTED) if p and not p[0].isspace() and len(p) <= LONGEST_KEPT]
        yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in top], pa.string()), pa.array([n for _, n in top], pa.int64())], ["piece", "n"])

    found = docs.select(F.col(text).alias("text")).mapInArrow(report, "piece string, n long")
    return found.groupBy("piece").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "piece").limit(FREQUENT)


_KNOWN: list = []  # a broadcast table and what the worker knows beside it, kept from task to task


def _known(name: str, table) -> PieceLengths:
    if not _KNOWN or _KNOWN[0] is not table.value:
        _KNOWN[:] = [table.value, PieceLengths(name, dict(zip(*table.value, strict=True)))]
    return _KNOWN[1]


def token_counts(docs: DataFrame, name: str = DEFAULT_FILE, limit: int = 512, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_bytes (UTF-8), n_tokens, over_limit (more tokens than `limit`).

    Whole texts, without begin, end or other added tokens; strings of special tokens inside a text are what the
    tokenizer makes of them. Null is the empty text with 0 tokens. Null and repeated ids, repeated rows: a row each.
    Other columns are ignored. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    pieces = [row.piece for row in frequent_pieces(docs, text).collect()]
    lengths = [len(ids) for ids in encoder(name).whole([" " + p for p in pieces])]
    table = spark.sparkContext.broadcast((pieces, array("I", lengths)))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _known(name, table)
        for batch in small_batches(batches):
            values = texts(batch)
            n_bytes = pc.fill_null(pc.binary_length(batch.column("text")), 0).cast(pa.int64())
            n_tokens = pa.array(known.of(values), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), n_bytes, n_tokens, pc.greater(n_tokens, limit)], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
