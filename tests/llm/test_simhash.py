"""Fingerprints, Golay keys, links and components against brute force."""

import itertools
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from hostvane.llm import simhash
from hostvane.llm.components import components

COLUMNS = "doc_id long, text string, fp string, component_id string, node string"


def plain_fingerprint(text):
    words = [w for w in "".join(c if c not in " \t\n\x0b\x0c\r" else " " for c in text or "").split(" ") if w]
    words = ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w) for w in words]
    shingles = [" ".join(words[k : k + 3]) for k in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64(s.encode(), 42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(values):
    """Smallest position reachable by links of 3 bits or fewer."""
    found = list(range(len(values)))
    changed = True
    while changed:
        changed = False
        for a, b in itertools.combinations(range(len(values)), 2):
            if (values[a] ^ values[b]).bit_count() <= 3 and found[a] != found[b]:
                found[a] = found[b] = min(found[a], found[b])
                changed = True
    return found


def texts():
    rng = random.Random(3)
    base = [" ".join(rng.choice("abcdefghij") * rng.randint(1, 4) for _ in range(rng.randint(1, 400))) for _ in range(25)]
    near = []
    for text in base:
        for _ in range(rng.randint(0, 5)):
            words = text.split()
            words[rng.randrange(len(words))] = "other"
            near.append(" ".join(words))
    odd = [None, "", " \n\t", "one", "One two", "ONE two", "É é", "é É", "a b c d", "same " * 3000]
    return base + near + odd + base[:5]


def test_fingerprints_against_brute_force(monkeypatch):
    for limit in (simhash.WORDS_AT_ONCE, 7):
        monkeypatch.setattr(simhash, "WORDS_AT_ONCE", limit)
        assert all(simhash.fingerprint(t or "") == plain_fingerprint(t) for t in texts())


def test_golay_code_is_perfect():
    low, high, nearest, fourth = simhash._golay()
    assert len({int(e) for e in nearest}) == 2048
    far = np.bitwise_count(nearest) == 3
    assert far.sum() == 1771 and (fourth[far] > 0).all() and (np.bitwise_count(fourth[far]) == 4).all()
    words = np.random.default_rng(1).integers(0, 1 << 23, 500)
    position, index = simhash.codeword_indices(words)
    codewords = {k << 11 | simhash._remainder(k << 11) for k in range(4096)}
    for k in range(0, 500, 25):
        within = {c >> 11 for c in codewords if (c ^ int(words[k])).bit_count() <= 4}
        assert within == set(index[position == k].tolist())


def test_linked_fingerprints_share_a_key():
    rng = np.random.default_rng(2)
    a = rng.integers(0, 1 << 63, 3000, dtype=np.uint64) * 2 + 1
    b = a.copy()
    for k in range(len(b)):
        for bit in rng.choice(64, rng.integers(0, 4), replace=False):
            b[k] ^= np.uint64(1) << np.uint64(bit)
    (pa, ka), (pb, kb) = simhash.golay_keys(a), simhash.golay_keys(b)
    of_a, of_b = set(zip(pa.tolist(), ka.tolist())), set(zip(pb.tolist(), kb.tolist()))
    assert {k for k, _ in of_a & of_b} == set(range(3000))


@pytest.mark.parametrize("limit", [simhash.KEY_LIMIT, 4])
def test_near_duplicates_against_brute_force(spark, limit):
    values = texts()
    docs = spark.createDataFrame([(k, t, "x", "y", "z") for k, t in enumerate(values)], COLUMNS).repartition(5)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.near_duplicates(docs, limit=limit).collect()}
    prints = [plain_fingerprint(t) for t in values]
    want = plain_components(prints)
    assert got == {k: (f"{prints[k]:016x}", want[k]) for k in range(len(values))}


@pytest.mark.parametrize("limit", [simhash.KEY_LIMIT, 20])
def test_dense_and_chained_groups(spark, limit):
    rng = np.random.default_rng(4)
    center = rng.integers(0, 1 << 62, dtype=np.uint64)
    near = [center ^ sum((np.uint64(1) << np.uint64(b) for b in rng.choice(12, rng.integers(0, 5), replace=False)), np.uint64(0)) for _ in range(300)]
    chain = [np.uint64(((1 << k) - 1) ^ 0x5555_0000_0000_0000) for k in range(0, 45, 3)]
    values = np.unique(np.array(near + chain + [rng.integers(0, 1 << 62, dtype=np.uint64) for _ in range(50)], dtype=np.uint64))
    found = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "fp long").repartition(3)
    got = {r.node: r.root for r in components(simhash.links(found, limit)).collect()}
    signed = sorted(values.view(np.int64).tolist())
    want = plain_components([v & (1 << 64) - 1 for v in signed])
    assert {v: got.get(v, v) for v in signed} == {v: signed[want[k]] for k, v in enumerate(signed)}


def test_stage_keeps_one_of_each_group(spark):
    text = " ".join(f"w{k}" for k in range(300))
    rows = [(5, text, "a", "b", "c"), (4, text, "a", "b", "c"), (4, text, "a", "b", "c"), (None, text, None, None, None)]
    rows += [(9, "quite another text", None, None, None), (7, None, None, None, None), (8, "", None, None, None)]
    rows += [(None, "only here and without an id", None, None, None)]
    kept = simhash.without_near_duplicates(spark.createDataFrame(rows, COLUMNS))
    assert kept.columns == ["doc_id", "text", "fp", "component_id", "node"]
    assert sorted((r.doc_id or 99, r.text) for r in kept.collect()) == [
        (4, text), (7, None), (9, "quite another text"), (99, "only here and without an id")
    ]


def test_empty_and_null_ids(spark):
    none = spark.createDataFrame([], COLUMNS)
    assert simhash.near_duplicates(none).collect() == [] and simhash.without_near_duplicates(none).collect() == []
    nulls = spark.createDataFrame([(None, "alone here now", None, None, None)] * 2, COLUMNS)
    assert [r.component_id for r in simhash.near_duplicates(nulls).collect()] == [None, None]


def test_components(spark):
    rng = random.Random(1)
    edges = [(k, k + 1) for k in range(0, 60)] + [(100, k) for k in range(101, 140)] + [(k, rng.choice([200, 201])) for k in range(202, 230)]
    rng.shuffle(edges)
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "node long, root long")).collect()}
    assert all(got[k] == 0 for k in range(1, 61)) and all(got[k] == 100 for k in range(101, 140))
    assert components(spark.createDataFrame([], "node long, root long").where(F.lit(True))).collect() == []
