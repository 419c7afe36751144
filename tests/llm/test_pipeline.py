"""The pipeline, stage by stage, against brute force on its own input, and registered queries on the smallest tables."""

import os

import pytest
from test_decontaminate import normal
from test_simhash import plain_components, plain_fingerprint
from test_tokens import check_packing, plain

import __spark_entry__ as registered
import corpus_pipeline
from hostvane.llm import decontaminate, langid, lines, queries, simhash
from tools.compare import compare, connect

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="needs the given tables")

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def rows_of(df):
    return {r.doc_id: r for r in df.collect()}


@pytest.fixture(scope="module")
def written(spark, tmp_path_factory):
    """Every stage's result, the given documents first."""
    folder = tmp_path_factory.mktemp("stages")
    docs, out = spark.read.parquet(f"{SF_DIR}/documents.parquet"), []
    out.append(docs)
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF_DIR).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        out.append(docs)
    return out


def test_columns(written):
    assert all(df.columns == written[0].columns for df in written[:-1])
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "line_dedup", "near_duplicates", "decontamination", "packing"]


def test_language(spark, written):
    docs, model = rows_of(written[0]), langid.train(written[0])
    want = {}
    for key, r in docs.items():
        language, score = model.predict(r.text or "")
        if language != "und" and score >= langid.LEAST_SCORE:
            want[key] = r
    assert rows_of(written[1]) == want and len(want) > 0.9 * len(docs)


def plain_line_dedup(docs):
    """{doc_id: text} without chunks and passages seen before, and without documents that nothing is left of."""
    seen, out = set(), {}
    for key in sorted(docs):
        own, gone, start, pieces = docs[key].split("\n"), set(), 0, []
        for chunk in lines.chunks(docs[key]):
            end = start + chunk.count("\n") + 1
            pieces += [(start, end, ("chunk", chunk))] * lines.removable(chunk)
            start = end
        pieces += [(a, b, ("passage", "\n".join(own[a:b]))) for a, b in lines.passages(docs[key])]
        for a, b, piece in sorted(pieces):
            gone |= set(range(a, b)) if piece in seen else set()
            seen.add(piece)
        text = "\n".join(line for k, line in enumerate(own) if k not in gone)
        if not gone or text.strip():
            out[key] = text
    return out


def test_line_dedup(written):
    docs = rows_of(written[1])
    kept = plain_line_dedup({k: r.text for k, r in docs.items()})
    got = rows_of(written[2])
    assert {k: r.text for k, r in got.items()} == kept
    assert all(r.n_chars == len(r.text) for r in got.values()) and any(r.text != docs[k].text for k, r in got.items())


def test_near_duplicates(written):
    docs = rows_of(written[2])
    keys = sorted(docs)
    groups = plain_components([plain_fingerprint(docs[k].text) for k in keys])
    assert rows_of(written[3]) == {keys[k]: docs[keys[k]] for k in range(len(keys)) if groups[k] == k}


def test_decontamination(spark, written):
    items = [normal(r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    docs = rows_of(written[3])
    want = {}
    for key, r in docs.items():
        text = normal(r.text)
        if not any(i in text or decontaminate.fewest_edits(i, text) <= decontaminate.MOST_EDITS * len(i) for i in items):
            want[key] = r
    assert rows_of(written[4]) == want and len(want) < len(docs)


def test_packing(written):
    check_packing(written[5].collect(), 2048, {k: plain(r.text) for k, r in rows_of(written[4]).items()})


def test_run_gives_the_last_stage(spark, written):
    got = corpus_pipeline.run(spark, SF_DIR)
    assert sorted((r.doc_id, r.start, r.ids_crc32) for r in got.collect()) == sorted((r.doc_id, r.start, r.ids_crc32) for r in written[5].collect())


def test_stages_with_odd_rows(spark):
    rows = [(None, None, None, None, None), (1, "", "en", None, 0), (2, None, "fr", "s", None), (3, "the same words " * 30, "en", "s", 5)]
    rows += [(3, "the same words " * 30, "en", "s", 5), (None, "these other words are here", "en", "s", 1), (4, "12 34", None, None, None)]
    docs = spark.createDataFrame([(*r, "kept") for r in rows], COLUMNS + ", removed_chunks string")
    for empty in (False, True):
        now = docs.limit(0) if empty else docs
        for _, stage in corpus_pipeline.STAGES[:-1]:
            now = stage(spark, now, SF_DIR)
            assert now.columns == docs.columns
            assert {r.removed_chunks for r in now.collect()} <= {"kept"}
        assert corpus_pipeline.STAGES[-1][1](spark, now, SF_DIR).count() == (0 if empty else 2)


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_registered(spark, duck, name):
    assert registered.queries()[name] is queries.QUERIES[name]
    assert compare(spark, duck, SF_DIR, name, queries.QUERIES[name], queries.ORACLES.get(name)) is None


def test_stages_keep_columns_named_like_helpers(spark):
    """Columns of any name pass through line dedup and near-duplicates."""
    long = " ".join(f"word{k}" for k in range(60))
    names = ["_key", "_hash", "_ranges", "kept_id", "kept_hash", "Kept_Id_2", "n", "root", "fp", "text_hash", "component_id"]
    rows = [(k, f"{long}\nown line {k} of text", *[f"{name}{k}" for name in names]) for k in range(4)] + [(9, None, *names)]
    docs = spark.createDataFrame(rows, f"doc_id long, text string, {', '.join(f'`{n}` string' for n in names)}")
    for function in (lambda d: lines.line_dedup(d).drop("removed_chunks", "removed_chars"), simhash.without_near_duplicates):
        got = function(docs)
        assert got.columns == docs.columns
        assert all(r[2:] == tuple(f"{name}{r.doc_id}" for name in names) for r in got.collect() if r.doc_id != 9) and got.count() > 1
