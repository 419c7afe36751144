"""Leaked benchmark items against a search of every stretch."""

import random

import numpy as np
import pytest

from hostvane.llm import decontaminate as d

COLUMNS = "doc_id long, text string, edits string, item_id string, similarity string"


def plain_edits(a, b):
    """Edit distance of a to any substring of b."""
    row = list(range(len(a) + 1))
    best = row[-1]
    for c in b:
        new = [0]
        for k, w in enumerate(a):
            new.append(min(row[k] + (w != c), row[k + 1] + 1, new[k] + 1))
        row, best = new, min(best, new[-1])
    return best


VOCABULARY = [w for w in ("the of and to in " * 8).split()] + [f"{a}{b}" for a in ("ther", "ing", "est", "öl", "um") for b in "abcdefghij"]


def prose(rng, n):
    return " ".join(rng.choice(VOCABULARY) for _ in range(n))


def edited(text, share, rng):
    """Words replaced, dropped and added."""
    out = []
    for word in text.split():
        if rng.random() >= share:
            out.append(word)
        elif rng.random() < 0.5:
            out += rng.choice([[], [word, "more"], [word[:-1] + "x"]])
        else:
            out.append(rng.choice(VOCABULARY))
    return " ".join(out)


def planted(seed=1, documents=160):
    rng = random.Random(seed)
    items = [(k, prose(rng, rng.randint(13, 70))) for k in range(15)]
    docs = []
    for k in range(documents):
        text = prose(rng, rng.randint(0, 100))
        if k % 2:
            item = rng.choice(items)[1]
            item = edited(item, [0, 0, 0.05, 0.1][k // 2 % 4], rng)
            cut = rng.randint(0, len(text.split()))
            text = " ".join([*text.split()[:cut], item.upper() if k % 3 == 0 else item.replace(" ", ",\n "), *text.split()[cut:]])
        docs.append(text)
    return items, docs


def normal(text):
    return b" ".join(d.words(text)).decode()


def test_fewest_edits_against_the_table():
    rng = random.Random(2)
    for _ in range(300):
        a = "".join(rng.choice("abé") for _ in range(rng.randint(0, 90)))
        b = "".join(rng.choice("abé") for _ in range(rng.randint(0, 120)))
        assert d.fewest_edits(a, b) == plain_edits(a, b)


@pytest.mark.parametrize("kind", d.KINDS)
def test_walk_against_its_definition(kind):
    text = prose(random.Random(4), 40)
    chars, walk = d.coded(text), d.Walk(kind, 1)
    starts = np.array([0, 7, 29, len(text) - 1])
    keys, ends = walk.keys(chars, starts)
    for k, start in enumerate(starts.tolist()):
        at, want = start, [0] * kind.tables
        for step in range(kind.steps):
            read = int(chars[min(at, len(text) - 1)])
            want = [w + read * int(walk.factors[step]) * (step in s) & 2**64 - 1 for w, s in zip(want, walk.samples)]
            at += 1 + (read >> int(walk.bits[step]) & 1)
        assert ends[k] == at
        assert [int(key[k]) for key in keys] == [(w ^ w >> 29) * int(d._MIX) & 2**64 - 1 for w in want]


def test_equal_texts_walk_alike_wherever_they_stand():
    one, other = d.coded("abc " + "the same words again and again"), d.coded("the same words again and again")
    for number in range(d.LONG.walks):
        walk = d.Walk(d.LONG, number)
        for a, b in zip(walk.keys(one, np.array([4, 9]))[0], walk.keys(other, np.array([0, 5]))[0], strict=True):
            assert a.tolist() == b.tolist()


def test_recall_and_precision():
    found = wanted = 0
    for seed in range(3):
        items, docs = planted(seed)
        index = d.Index(items)
        got = {(k, item): edits for k, item, edits, _ in index.matches(docs)}
        for k, text in enumerate(docs):
            for item, wording in items:
                fewest = d.fewest_edits(normal(wording), normal(text))
                if fewest <= d.MOST_EDITS * len(normal(wording)):
                    wanted += 1
                    found += (k, item) in got
                    assert got.get((k, item), fewest) >= fewest
                    assert fewest > 0 or got[k, item] == 0, "an exact copy is always found"
                else:
                    assert (k, item) not in got
    assert wanted > 200 and found >= 0.95 * wanted


@pytest.mark.parametrize("limit", [d.BLOCK_ITEMS, 7])
def test_leaks_rows_and_blocks(spark, monkeypatch, limit):
    monkeypatch.setattr(d, "BLOCK_ITEMS", limit)
    items, docs = planted()
    benchmark = spark.createDataFrame([*items, (3, items[3][1]), (77, None), (78, ""), (79, "too short")], "item_id long, text string")
    rows = [(k, t, "x", "y", "z") for k, t in enumerate(docs)] + [(None, items[0][1], None, None, None)] * 2 + [(500, None, None, None, None), (501, "w " * 50_000 + items[1][1], None, None, None)]
    table = spark.createDataFrame(rows, COLUMNS)
    got = d.leaks(table, benchmark).collect()
    want = {(k, i) for k, i, _, _ in d.Index(items).matches(docs)} | {(None, 0), (501, 1)}
    assert {(r.doc_id, r.item_id) for r in got} == want and len(got) == len(want) + 1
    kept = d.without_leaks(table, benchmark)
    assert kept.columns == table.columns
    assert {r.doc_id for r in kept.collect()} == {*range(len(docs)), 500} - {k for k, _ in want}
    assert d.leaks(table, benchmark.limit(0)).collect() == [] and d.leaks(table.limit(0), benchmark).collect() == []
    assert d.without_leaks(table, benchmark.limit(0)).count() == len(rows)
