"""Alignments against a comparison of all pairs of tokens."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from hostvane.llm import alignment, queries
from hostvane.llm.tokens import tokenizer_path

COLUMNS = "doc_id long, text string, groups string, rare string, row string, code string"


def first_tokenizer():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    return tokenizer


def brute_force(rows, pair):
    """Whole texts by the tokenizers' own libraries, every token against every other."""
    tokenizer = first_tokenizer()
    docs = []
    for doc_id, text in rows:
        entry = None
        if text:
            a = tokenizer.encode(" " + text, add_special_tokens=False).ids
            b = pair.second.encode(text)
            spans = []
            for ids, values in ((a, pair.first_bytes), (b, pair.second_bytes)):
                at, own = 0, []
                for i in ids:
                    own.append((i, at, at + len(values[i])))
                    at += len(values[i])
                spans.append(own)
            if all(b"".join(values[i] for i in ids) == b" " + text.encode() for ids, values in ((a, pair.first_bytes), (b, pair.second_bytes))):
                entry = spans
        docs.append((doc_id, entry))
    held, linked = Counter(), []
    for _, entry in docs:
        links = [(x[0], y[0]) for x in entry[0] for y in entry[1] if x[1] < y[2] and y[1] < x[2]] if entry else []
        linked.append(links)
        held.update(set(links))
    most = defaultdict(int)
    for (a, _), n in held.items():
        most[a] = max(most[a], n)
    out = []
    for (doc_id, entry), links in zip(docs, linked, strict=True):
        if not entry:
            out.append((doc_id, 0, 0, 0, 0, 0, 0, ""))
            continue
        common = sorted({x[2] for x in entry[0]} & {y[2] for y in entry[1]})
        cut, last = [], 0
        for end in common:
            cut.append("|".join(",".join(str(i) for i, start, stop in own if last <= start and stop <= end) for own in entry))
            last = end
        digest = hashlib.sha256(";".join(cut).encode()).hexdigest()
        best = sum(held[x] == most[x[0]] for x in links)
        out.append((doc_id, len(entry[0]), len(entry[1]), len(common), len(links), best, sum(held[x] for x in links), digest))
    return sorted(out, key=str)


TEXTS = [
    "The quick brown fox, isn't it?", "Überraschung naïve façade 日本語のテキスト", "a  b   c\n\n  d\te ", " lead", "trail \n", "\n", " ", "   ",
    "x" * 300, "<|endoftext|> <s> </s> <unk> <0x41>", "▁under", "a▁b", "é ​ ﻿   　x", "123 4567 89.10", "😀 👩‍👩‍👧 ok", "\x1c a \x1c", "a \r\nb", "end.\r c;\r",
    "ﬁ ① Ａ", "\x00 zero", "", None, "The quick brown fox, isn't it?",
]


def table(spark, rows):
    return spark.createDataFrame([(i, t, "g", "r", "w", "c") for i, t in rows], COLUMNS)


def digested(spark, rows, **more):
    from pyspark.sql import functions as F

    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    got = alignment.alignments(table(spark, rows), derive={"groups_sha256": digest}, **more)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return sorted((tuple(r) for r in got.collect()), key=str)


@pytest.mark.parametrize("frequent", [alignment.FREQUENT, 5, 0])
def test_against_brute_force(spark, frequent):
    rng = random.Random(4)
    words = ["alpha", "Beta", "naïve", "don't", "x1y2", "…", "日本", "über-", "(a)", "www.example.com", "\t", "\n", "", "  ", " ", "▂"]
    mixed = [" ".join(rng.choice(words) for _ in range(rng.randrange(1, 30))) for _ in range(60)]
    rows = [*enumerate([*TEXTS, *mixed]), (None, "The quick"), (3, "again"), (3, "again")]
    pair = alignment.Pair(alignment.FIRST, alignment.SECOND)
    assert digested(spark, rows, frequent=frequent) == brute_force(rows, pair)


def test_long_text(spark):
    rng = random.Random(9)
    letters = "".join(rng.choice("abcdefgh ,.é日\n") for _ in range(120_000))
    unbroken = "".join(rng.choice("ACGT") for _ in range(20_000))
    rows = [(1, letters), (2, "short")]
    got = {r[0]: r for r in digested(spark, [*rows, (3, unbroken)])}
    pair = alignment.Pair(alignment.FIRST, alignment.SECOND)
    (a,), (b,) = pair.encode([letters])
    assert (got[1][1], got[1][2]) == (len(a), len(b)) and got[1][4] == len(a) + len(b) - got[1][3]
    assert got[3][1] > 5_000 and got[2][1] > 0


def test_empty_table(spark):
    assert digested(spark, []) == []
    assert digested(spark, [(1, None), (2, "")]) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


def test_groups_as_text(spark):
    row = alignment.alignments(table(spark, [(1, "unbelievable things")])).first()
    pair = alignment.Pair(alignment.FIRST, alignment.SECOND)
    (a,), (b,) = pair.encode(["unbelievable things"])
    sides = [side.split("|") for side in row.groups.split(";")]
    assert [int(i) for x, _ in sides for i in x.split(",")] == a and [int(i) for _, y in sides for i in y.split(",")] == b
    assert re.fullmatch(r"(\d+(,\d+)*\|\d+(,\d+)*)(;\d+(,\d+)*\|\d+(,\d+)*)*", row.groups) and row.n_groups == len(sides)


@pytest.mark.parametrize("run", [1, 3, 64])
def test_galloping(run):
    rng = random.Random(run)
    lists = [([], [])]
    for _ in range(300):
        short, long = sorted((sorted(rng.sample(range(1, 900), rng.randrange(0, 300))) for _ in range(2)), key=len)
        lists.append(([*short, 999], [*long, 999]))
    sides = [[own[k] for own in lists] for k in (0, 1)]
    sizes = [np.array([*map(len, side)]) for side in sides]
    starts = [np.cumsum(n) - n for n in sizes]
    got = alignment.common_ends([np.concatenate(side) for side in sides], starts, sizes, run)
    want = {(i + a.index(x), j + b.index(x)) for i, j, (a, b) in zip(*[s.tolist() for s in starts], lists, strict=True) for x in set(a) & set(b)}
    assert {tuple(c) for c in got.T.tolist()} == want and got.shape[1] == len(want)


def test_portions_do_not_matter():
    values = [text or "" for text in TEXTS]
    assert list(alignment._portions(["ab", "", "abc", "x"], 3)) == [(0, 2), (2, 3), (3, 4)] and list(alignment._portions([])) == [(0, 0)]
    pair = alignment.Pair(alignment.FIRST, alignment.SECOND)
    together, alone = alignment.align(pair, values), [alignment.align(pair, [v]) for v in values]
    assert together.groups == [x.groups[0] for x in alone] and together.n_groups.tolist() == [int(x.n_groups[0]) for x in alone]
    assert [sorted(together.links[together.places == k].tolist()) for k in range(len(values))] == [sorted(x.links.tolist()) for x in alone]


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("length(text) < 1500").select("doc_id", "text").collect()][:40]
    assert digested(spark, rows) == brute_force(rows, alignment.Pair(alignment.FIRST, alignment.SECOND))
    assert queries.QUERIES["op12_alignment"](spark, "/root/testdata/sf0.001").count() == 200
