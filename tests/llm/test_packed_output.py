"""Packing against a plain best fit, and the written matrices against the tokenizer."""

import zlib
from collections import defaultdict

import numpy as np
import pytest

from hostvane.llm import packed_output as p
from hostvane.llm.tokens import encoder

COLUMNS = "doc_id long, text string, ids string, start string, window string"


def plain_best_fit(lengths, window):
    out, room = [], []
    for piece in sorted(range(len(lengths)), key=lambda k: -lengths[k]):
        fits = [k for k in range(len(out)) if room[k] >= lengths[piece]]
        if fits:
            k = min(fits, key=lambda k: room[k])
        else:
            k = len(out)
            out.append([])
            room.append(window)
        out[k].append(piece)
        room[k] -= lengths[piece]
    return sorted(window - sum(lengths[m] for m in members) for members in out)


@pytest.mark.parametrize("window", [1, 7, 16, 100])
def test_best_fit_decreasing(window):
    rng = np.random.default_rng(window)
    for n in (0, 1, 40, 300):
        lengths = rng.integers(1, window + 1, n).tolist()
        packed = p.best_fit_decreasing(lengths, window)
        assert sorted(k for members in packed for k in members) == list(range(n))
        assert sorted(window - sum(lengths[k] for k in members) for members in packed) == plain_best_fit(lengths, window)


def test_capacity_tree():
    rng = np.random.default_rng(1)
    tree, there = p.CapacityTree(37), set()
    for _ in range(3000):
        c = int(rng.integers(0, 38))
        there ^= {c}
        tree.mark(c, c in there)
        ask = int(rng.integers(0, 38))
        assert tree.smallest_from(ask) == min((x for x in there if x >= ask), default=None)


@pytest.mark.parametrize("block", [p.BLOCK_TOKENS, 300])
def test_round_trip(spark, block):
    texts = ["", "a", "some words here " * 3, "many words " * 500, "é ü 日本語", "x " * 63] * 6
    rows = [(k, t, "i", "s", "w") for k, t in enumerate(texts)] + [(None, None, None, None, None)] * 2
    docs = spark.createDataFrame(rows, COLUMNS).repartition(3)
    packed = p.write_packed(docs, window=64, block_tokens=block)
    got = p.packed_pieces(packed).collect()
    ids = {}
    for row in packed.collect():
        matrix = np.frombuffer(row.ids, f"<u{row.id_bytes}").reshape(row.windows, row.window)
        edges = np.frombuffer(row.cu_seqlens, "<i4")
        assert edges[0] == 0 and edges[-1] == matrix.size and len(edges) == len(row.doc_ids) + 1 == len(row.starts) + 1
        resets = np.unpackbits(np.frombuffer(row.resets, np.uint8))[: matrix.size]
        assert np.flatnonzero(resets).tolist() == edges[:-1].tolist()
        for k in range(row.windows):
            ids[row.first_sequence + k] = matrix[k]
    parts, at = defaultdict(list), defaultdict(int)
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == at[r.sequence_id]
        at[r.sequence_id] += r.length
        own = ids[r.sequence_id][r.offset : r.offset + r.length]
        assert zlib.crc32(own.astype("<u4").tobytes()) == r.ids_crc32
        parts[r.doc_id].append((r.start, own.tolist()))
    for k, text in enumerate(texts):
        whole = encoder().tokenizer.encode(text, add_special_tokens=False).ids + [p.END_ID]
        assert [i for _, own in sorted(parts[k]) for i in own] == whole
    assert parts[None] == [(0, [p.END_ID])] * 2
    assert len(ids) >= len(at)


def test_ranks_give_the_ids_of_the_tokenizer_file():
    from test_tokens import NASTY, random_texts

    texts = [t for t in NASTY + random_texts(1500, 8) if "<|endoftext|>" not in t]
    whole = encoder().whole(texts)
    assert encoder(p.RANKS_FILE).whole(texts) == whole
    assert [np.frombuffer(b, "<u4").tolist() for b in p.piece_ids(p.RANKS_FILE).of(texts)] == whole


def test_empty(spark):
    packed = p.write_packed(spark.createDataFrame([], COLUMNS))
    assert packed.collect() == [] and p.packed_pieces(packed).collect() == []
