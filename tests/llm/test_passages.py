"""Repeated passages of ordinary lines against brute force over every run of lines."""

import random

import pytest

from hostvane.llm import lines


def brute_force(rows):
    """{doc_id: numbers of the lines that stand in a run of 50 words or more with an earlier copy}."""
    seen, out = set(), {}
    for key, text in rows:
        own, gone = text.split("\n"), set()
        for a in range(len(own)):
            for b in range(a + 1, len(own) + 1):
                run = "\n".join(own[a:b])
                if len(run.split()) >= lines.LONG_LINE and own[a].split() and own[b - 1].split():
                    gone |= set(range(a, b)) if run in seen else set()
                    seen.add(run)
        out[key] = gone
    return out


def corpus(seed):
    """Passages of 2 to 9 lines of under 50 words each, and 51 words or more in all, between unrelated lines."""
    rng = random.Random(seed)
    line = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    passages = [[line(-(-51 // m) + rng.randint(0, 3)) for _ in range(m)] for m in range(2, 10)]
    passages.append([line(20), "", line(1), " ", line(20), line(30)])
    docs = []
    for k in range(90):
        body = [line(rng.randint(0, 20)) for _ in range(rng.randint(0, 8))]
        at = rng.randint(0, len(body))
        body[at:at] = passages[k % len(passages)]
        if k % 5 == 0:
            body += body[at : at + 6]
        docs.append("\n".join(body))
    return list(enumerate(docs)), passages


@pytest.mark.parametrize("seed", range(3))
def test_passages_against_every_run(spark, seed):
    rows, passages = corpus(seed)
    want = brute_force(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    chunk_lines = {key: set() for key, _ in rows}
    for r in lines.repeated_chunks(docs).collect():
        chunk_lines[r.doc_id] |= set(range(r.position, r.end))
    got = {r.doc_id: r for r in lines.line_dedup(docs, with_passages=True).collect()}
    assert any(want[key] - chunk_lines[key] for key in want), "chunks alone leave some"
    for key, text in rows:
        gone = want[key] | chunk_lines[key]
        assert got[key].text == "\n".join(v for k, v in enumerate(text.split("\n")) if k not in gone)
        assert (got[key].removed_chunks > 0) == bool(gone)
        ranges = [(k, k + 1) for k in gone]
        assert (got[key].text, got[key].removed_chunks, got[key].removed_chars) == lines.without(text, ranges)
    for k, passage in enumerate(passages):
        copies = sum("\n".join(passage) in r.text for r in got.values())
        assert copies == 1, f"passage {k} is left {copies} times"


def test_no_passages_without_words():
    assert lines.passages("") == lines.passages("\n" * 5000) == lines.passages("short\n\nlines") == []
    assert lines.passages("word " * 60 + "\n\n") == []
    assert len(lines.passages("x\n" * 1000)) == 951
