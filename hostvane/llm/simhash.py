"""Near-duplicate documents by 64-bit SimHash fingerprints, found through Golay-code keys.

Two fingerprints are linked at 3 or fewer differing bits. A fingerprint is cut into four segments of 16 bits: one of them
is free of errors. The other 48 bits are two halves: one of them has at most one error. Of that half, 23 bits are decoded
with the binary Golay code, in which every 23-bit word lies within distance 3 of exactly one codeword. The codewords
within distance 4 of a word (one, or six) include the nearest codeword of each word that differs in one bit. So linked
fingerprints share a key (segment number, half, segment bits, codeword index), and nothing is missed. Fingerprints with
a common key are compared; of those that hang together only a star of links leaves the task, never all pairs.
"""

from __future__ import annotations

import functools
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hostvane.llm.components import components
from hostvane.llm.shared import small_batches, stored, texts, unused

MOST_BITS = 3
SHINGLE = 3
SEED = 42
#: Words hashed at a time, and fingerprints of one key that one task compares; keys with more are split into blocks.
WORDS_AT_ONCE, KEY_LIMIT = 100_000, 20_000

# ---- fingerprints


def fingerprint(text: str) -> int:
    """Bits set in over half of the XXH64 hashes of the 3-word shingles, repeats included; 0 without a word."""
    words = text.encode().lower().split()  # A-Z only; cut at the six ASCII white-space characters
    if not words:
        return 0
    if len(words) < SHINGLE:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    total, ones = len(words) - SHINGLE + 1, np.zeros(64, dtype=np.int64)
    for start in range(0, total, WORDS_AT_ONCE):
        part = words[start : start + WORDS_AT_ONCE + SHINGLE - 1]
        shingles = map(b" ".join, zip(*(part[k:] for k in range(SHINGLE)), strict=False))
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, itertools.repeat(SEED)), dtype="<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > total, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fp, text_hash): the fingerprint as a signed long; null text counts as empty."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            found = np.array([fingerprint(value) for value in texts(batch)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found.view(np.int64)), batch.column("text_hash")], ["doc_id", "fp", "text_hash"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.withColumn("text_hash", _text_hash(F.col("text"))).mapInArrow(compute, "doc_id long, fp long, text_hash long")


def _text_hash(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


# ---- keys

_GENERATOR = 0b110001110101  # x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1


def _remainder(word: int) -> int:
    for bit in range(22, 10, -1):
        if word >> bit & 1:
            word ^= _GENERATOR << (bit - 11)
    return word


@functools.cache
def _golay() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Remainders of low and high bits; by remainder: the error of weight 3 or less, and the errors of weight 4 (or 0)."""
    low = np.array([_remainder(v) for v in range(1 << 12)], dtype=np.int64)
    high = np.array([_remainder(v << 12) for v in range(1 << 11)], dtype=np.int64)
    single = [_remainder(1 << k) for k in range(23)]
    nearest, fourth = np.zeros(1 << 11, dtype=np.int64), np.zeros((1 << 11, 5), dtype=np.int64)
    used = np.zeros(1 << 11, dtype=np.int64)
    for weight in range(1, 5):
        for bits in itertools.combinations(range(23), weight):
            at = functools.reduce(int.__xor__, (single[k] for k in bits))
            error = sum(1 << k for k in bits)
            if weight < 4:
                nearest[at] = error
            elif nearest[at].bit_count() == 3:
                fourth[at, used[at]] = error
                used[at] += 1
    return low, high, nearest, fourth


def codeword_indices(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position in `words`, index) for every codeword within distance 4 of a 23-bit word; an index has 12 bits."""
    low, high, nearest, fourth = _golay()
    at = low[words & 0xFFF] ^ high[words >> 12]
    error = nearest[at]
    far = np.flatnonzero(np.bitwise_count(error) == 3)
    others = (words[far, None] ^ fourth[at[far]]) >> 11
    position = np.concatenate([np.arange(len(words)), np.repeat(far, 5)])
    return position, np.concatenate([(words ^ error) >> 11, others.ravel()])


def golay_keys(found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position in `found`, key) of unsigned fingerprints."""
    segments = [(found >> np.uint64(16 * k) & np.uint64(0xFFFF)).astype(np.int64) for k in range(4)]
    positions, keys = [], []
    for exact in range(4):
        a, b, c = (segments[k] for k in range(4) if k != exact)
        rest = a | b << 16 | c << 32
        for half, word in enumerate((rest & 0x7FFFFF, rest >> 24 & 0x7FFFFF)):
            position, index = codeword_indices(word)
            positions.append(position)
            keys.append((2 * exact + half) << 28 | segments[exact][position] << 12 | index)
    return np.concatenate(positions), np.concatenate(keys)


def _with_keys(found: DataFrame) -> DataFrame:
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 4096):
            fp = batch.column("fp").to_numpy()
            position, key = golay_keys(fp.view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(fp[position])], ["key", "fp"])

    return found.select("fp").mapInArrow(emit, "key long, fp long")


# ---- links


def stars(members: np.ndarray) -> list[tuple[int, int]]:
    """(member, smallest member that it hangs together with) among unsigned fingerprints, by links of 3 bits or fewer."""
    left, out = np.arange(len(members)), []
    while len(left):
        group, frontier, left = [left[0]], [left[0]], left[1:]
        while frontier and len(left):
            near = np.bitwise_count(members[left] ^ members[frontier.pop()]) <= MOST_BITS
            if near.any():
                hit = left[near].tolist()
                group += hit
                frontier += hit
                left = left[~near]
        if len(group) > 1:
            signed = members[group].view(np.int64)
            out += [(int(m), int(signed.min())) for m in signed if m != signed.min()]
    return out


def _links_of_runs(batches: Iterator[pa.RecordBatch], limit: int | None) -> Iterator[pa.RecordBatch]:
    """Links within runs of equal keys; a run of over `limit` fingerprints comes back whole, as (fp, null, key)."""

    def rows(node, root, key=None) -> pa.RecordBatch:
        n = len(node)
        columns = [pa.array(node, pa.int64()), pa.nulls(n, pa.int64()) if root is None else pa.array(root, pa.int64())]
        columns.append(pa.nulls(n, pa.int64()) if key is None else pa.array(np.full(n, key)))
        return pa.RecordBatch.from_arrays(columns, ["node", "root", "key"])

    def linked(key: np.ndarray, fp: np.ndarray) -> Iterator[pa.RecordBatch]:
        start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.array([], dtype=int)
        length = np.diff(np.r_[start, len(key)])
        two = start[length == 2]
        a, b = fp[two], fp[two + 1]
        near = np.bitwise_count(a ^ b) <= MOST_BITS
        a, b = a[near].view(np.int64), b[near].view(np.int64)
        if len(a):
            yield rows(np.maximum(a, b), np.minimum(a, b))
        out = []
        for s, n in zip(start[length > 2].tolist(), length[length > 2].tolist(), strict=True):
            out += stars(fp[s : s + n])
        if out:
            yield rows(*zip(*out, strict=True))

    held: list[np.ndarray] = []  # the last run so far
    held_key, spilled = None, False
    for batch in batches:
        key, fp = batch.column("key").to_numpy(), batch.column("fp").to_numpy().view(np.uint64)
        if not len(key):
            continue
        if held_key is not None and key[0] == held_key:
            more = int(np.searchsorted(key, held_key, side="right"))
            held.append(fp[:more])
            key, fp = key[more:], fp[more:]
        if limit is not None and (spilled or sum(map(len, held)) > limit):
            spilled = True
            yield rows(np.concatenate(held).view(np.int64), None, held_key) if held else rows([], [])
            held = []
        if not len(key):
            continue
        if held:
            run = np.concatenate(held)
            yield from linked(np.full(len(run), held_key), run)
        last = int(np.searchsorted(key, key[-1]))
        yield from linked(key[:last], fp[:last])
        held, held_key, spilled = [fp[last:]], key[-1], False
    if held and not spilled:
        run = np.concatenate(held)
        if limit is not None and len(run) > limit:
            yield rows(run.view(np.int64), None, held_key)
        else:
            yield from linked(np.full(len(run), held_key), run)
    elif held:
        yield rows(np.concatenate(held).view(np.int64), None, held_key)


def links(found: DataFrame, limit: int = KEY_LIMIT) -> DataFrame:
    """(node, root): links that connect exactly the fingerprints `found` (fp, distinct) that 3-bit links connect.

    Fingerprints of a key that has over `limit` are dealt to blocks, and each pair of blocks is compared by itself.
    """
    schema = "node long, root long, key long"
    # a number given outright: the planner would merge so few bytes into few tasks, yet each becomes many keys
    dealt = found.repartition(int(found.sparkSession.conf.get("spark.sql.shuffle.partitions")), "fp")
    by_key = _with_keys(dealt).repartition("key").sortWithinPartitions("key")
    first = stored(by_key.mapInArrow(lambda batches: _links_of_runs(batches, limit), schema), "links")
    large = first.where("root is null").select("key", F.col("node").alias("fp"))
    blocks = large.groupBy("key").agg(F.ceil(F.count("*") * 2 / F.lit(limit)).alias("blocks"))
    block = F.pmod(F.xxhash64("fp"), F.col("blocks"))
    cells = large.join(blocks, "key").withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    cells = cells.select(F.xxhash64("key", F.least("block", "other"), F.greatest("block", "other")).alias("key"), "fp")
    by_cell = cells.repartition("key").sortWithinPartitions("key")
    more = by_cell.mapInArrow(lambda batches: _links_of_runs(batches, None), schema)
    return first.where("root is not null").unionByName(more).select("node", "root").distinct()


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", limit: int = KEY_LIMIT) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable).

    Null text is empty; documents without a word have fingerprint zero and are linked like any other. Repeated rows are
    documents with equal fingerprints. A null doc_id never names a component: component_id is null where all ids of
    the component are. Other columns are ignored. An empty table gives no rows.
    """
    return _with_component(stored(fingerprints(docs, doc_id, text), "fingerprints"), limit).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def _with_component(hashed: DataFrame, limit: int) -> DataFrame:
    """Add root (a fingerprint of the component) and component_id to rows with doc_id and fp."""
    distinct = hashed.groupBy("fp").agg(F.min("doc_id").alias("first"))
    roots = components(links(distinct, limit)).select(F.col("node").alias("fp"), "root")
    groups = distinct.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    lowest = groups.groupBy("root").agg(F.min("first").alias("component_id"))
    return hashed.join(groups.join(lowest, "root").select("fp", "root", "component_id"), "fp")


def without_near_duplicates(docs: DataFrame, limit: int = KEY_LIMIT) -> DataFrame:
    """The documents without near-duplicates: of every component the one with the smallest doc_id, all columns kept.

    Null text is empty. A null doc_id counts as larger than any other. Of repeated rows, and of rows that share the
    smallest doc_id of their component, one stays. An empty table gives no rows.
    """
    last = F.lit(2**63 - 1)
    hashed = stored(fingerprints(docs.withColumn("doc_id", F.coalesce("doc_id", last))), "fingerprints")
    first = _with_component(hashed, limit).where("doc_id = component_id")
    first = first.groupBy("root", "doc_id", "text_hash").agg(F.count("*").alias("n"))
    kept = first.groupBy("root").agg(F.min(F.struct("doc_id", "text_hash", "n")).alias("kept")).select("kept.*")
    # ids repeat only in odd input: just those rows are compared with each other
    kept_id, kept_hash = unused(docs, "kept_id", "kept_hash")
    same = (F.coalesce(docs["doc_id"], last) == F.col(kept_id)) & (_text_hash(docs["text"]) == F.col(kept_hash))
    kept = kept.select(F.col("doc_id").alias(kept_id), F.col("text_hash").alias(kept_hash), "n")
    once, again = kept.where("n = 1").drop("n"), kept.where("n > 1").drop("n")
    repeated = docs.join(again, same, "left_semi").dropDuplicates(["doc_id", "text"])
    return docs.join(once, same, "left_semi").unionByName(repeated)
