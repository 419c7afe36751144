"""License scans against plain searches."""

import random

import pytest

from hostvane.llm import licenses

COLUMNS = "doc_id long, text string, labels string, n_words string, line string"


def fewest_edits(wording, line):
    """Smallest edit distance of `wording` to any substring of `line`."""
    row = list(range(len(wording) + 1))
    best = row[-1]
    for c in line:
        new = [0]
        for k, w in enumerate(wording):
            new.append(min(row[k] + (w != c), row[k + 1] + 1, new[k] + 1))
        row, best = new, min(best, new[-1])
    return best


def brute_force(text):
    found = "".join(
        chr(ord(c) + 32) if "A" <= c <= "Z" else c if ord(c) >= 128 or c.isascii() and (c.isdigit() or "a" <= c <= "z") else " "
        for c in text or ""
    ).split(" ")
    found = [w for w in found if w]
    base = []
    for label, phrase in licenses.PHRASES:
        p = phrase.split()
        base += [(k, label) for k in range(len(found)) if found[k : k + len(p)] == p]
    line = f" {' '.join(found)} " if found else ""
    edits = [(label, wording, fewest_edits(wording, line)) for label, wording, most in licenses.NOTICES if fewest_edits(wording, line) <= most]
    base_labels = sorted({label for _, label in base})
    labels = sorted({*base_labels, *(label for label, _, _ in edits)})
    score = 1.0 if base else max((1 - n / len(w) for _, w, n in edits), default=0.0)
    places = [k for k, _ in base]
    return (len(found), len(base), min(places, default=None), max(places, default=None), ",".join(base_labels), ",".join(labels), score)


def damaged(wording, edits, rng):
    out = list(wording)
    for _ in range(edits):
        k = rng.randrange(len(out))
        out[k : k + 1] = rng.choice([[], ["x"], [out[k], "q"], ["é"]])
    return "".join(out)


def cases():
    rng = random.Random(5)
    plain = [
        None, "", " ", "...", "MIT License", "mit-license MIT\nLICENSE, mit license mit license", "submit license", "mit licenses",
        "General Public License General public license", "été mit license été", "Apache License; the MIT License", "Mit\x00License",
        "released under the mit license released under the nit license", "a" * 5000, "mit license " * 3000, "MIT License",
    ]
    made = []
    for label, wording, most in licenses.NOTICES:
        for edits in range(0, most + 3):
            made.append("Some words before. " + damaged(wording, edits, rng).upper() + ", and after it")
    return plain + made


@pytest.fixture(scope="module")
def texts():
    return cases()


def test_scan_against_brute_force(texts):
    for text in texts:
        got = licenses.scanner().scan(text or "")
        assert got[:6] == brute_force(text)[:6], text
        assert got[6] == pytest.approx(brute_force(text)[6]), text


def test_spans():
    text = "Foo bar. Released under the MIT Licence. Then: Relesed under the MIT license!"
    spans = licenses.scanner().scan(text)[7]
    assert [(s["label"], s["first_word"], s["n_words"], s["edits"]) for s in spans] == [("mit", 2, 5, 1), ("mit", 8, 5, 1)]


def test_parts_cover_the_notice():
    for _, wording, edits in licenses.NOTICES:
        assert "".join(p for _, p in licenses.parts(wording, edits)) == wording
        assert len(licenses.parts(wording, edits)) == edits + 1


def test_query_rows(spark, texts):
    rows = [(k, t, "x", "y", "z") for k, t in enumerate(texts)] + [(None, "MIT License", None, None, None)] * 2
    docs = spark.createDataFrame(rows, COLUMNS)
    got = licenses.license_scan(docs).collect()
    assert len(got) == len(rows) and sum(r.doc_id is None for r in got) == 2
    for r in got:
        if r.doc_id is not None:
            want = brute_force(texts[r.doc_id])
            assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels) == want[:6]
    assert licenses.license_scan(docs.limit(0)).collect() == []


def test_comparison_sql_on_damaged_notices(texts):
    """The SQL counts edits in bytes, so letters beyond ASCII are left out here."""
    import duckdb
    import pandas as pd

    from hostvane.llm import queries

    plain = [t if t is None or t.isascii() else t.replace("é", "e").replace("É", "E") for t in texts if t is None or len(t) < 10_000]
    connection = duckdb.connect()
    connection.register("documents", pd.DataFrame({"doc_id": range(len(plain)), "text": pd.Series(plain, dtype=object)}))
    got = {row[0]: row[1:] for row in connection.execute(queries.LICENSE_SQL).fetchall()}
    for k, text in enumerate(plain):
        want = licenses.scanner().scan(text or "")
        assert got[k][:6] == want[:6] and got[k][6] == pytest.approx(want[6]), text
