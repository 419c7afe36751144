"""Hard negatives against a comparison of every anchor with every row."""

import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from hostvane.llm import negatives

COLUMNS = "vec_id long, embedding array<float>, label int, row string, cell string, score string"


def brute_force(rows, step=100):
    kept = [(i, [math.floor(256 * float(x)) for x in v], y) for i, v, y in rows if i is not None and v is not None and y is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept = [(i, v, (y + 1) % 10 if i % 7 == 0 else y) for i, v, y in kept]
    out = []
    for q, a, label in kept:
        if q % step:
            continue
        scored = sorted((-sum(x * y for x, y in zip(a, b)), i, y) for i, b, y in kept if i != q)
        for s, i, _ in [x for x in scored if x[2] == label][:5]:
            fits = [x for x in scored if x[2] != label and 80 * -s <= 100 * -x[0] <= 100 * -s][:5]
            out += [(q, i, k + 1, n, -s, -t) for k, (t, n, _) in enumerate(fits)]
    return sorted(out)


def table(spark, rows):
    return spark.createDataFrame([(i, v, y, "r", "c", "s") for i, v, y in rows], COLUMNS)


def mined(spark, rows, **sizes):
    noisy = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    got = negatives.hard_negatives(table(spark, rows), F.col("vec_id") % 100 == 0, noisy, **sizes)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in got.collect())


def clustered(n, dim=6, labels=3, seed=1):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(5, dim))
    return [(k, [float(np.float32(x)) for x in centers[k % 5] + 0.3 * rng.normal(size=dim)], int(rng.integers(labels))) for k in range(n)]


@pytest.mark.parametrize("sizes", [{}, {"cell": 4, "chunk": 10, "block": 2, "probe": 20, "sample_rows": 50}])
def test_against_brute_force(spark, sizes):
    rows = clustered(700)
    rows += [(800, None, 1), (801, [None] * 6, 1), (802, [float("nan")] * 6, 2), (803, [float("inf")] + [0.0] * 5, 0), (None, [1.0] * 6, 1), (804, [1.0] * 6, None)]
    rows += [(900, [], 1), (901, [2.0], 1), (902, [3.0] * 9, 2), (1000, [1e6] * 6, 0), (1001, [-1e6, 1e6], 1), (5, rows[5][1], 2), (1100, [9.0], 77)]
    want = brute_force(rows)
    assert mined(spark, rows, **sizes) == want and len(want) > 50


def test_ties_copies_and_repeated_anchors(spark):
    rows = [(k, [1.0, 2.0], k % 3) for k in range(260)] + [(100, [1.0, 2.0], 100 % 3)]
    assert mined(spark, rows, cell=8, chunk=16, probe=4, block=1) == brute_force(rows)
    assert mined(spark, rows) == brute_force(rows)


def test_negative_and_zero_scores(spark):
    rows = [(0, [1.0, 0.0], 1), (1, [-1.0, 0.0], 1), (2, [0.0, 1.0], 1), (3, [0.0, 2.0], 2), (4, [-0.9, 0.0], 2), (5, [0.002, 0.0], 2)]
    want = brute_force(rows)
    assert mined(spark, rows) == want and {r[4] for r in want} == {0}


def test_few_rows(spark):
    for rows in ([], [(1, [1.0], 1)], [(100, [1.0], 1)], [(100, [1.0], 1), (2, [1.0], 1)], [(100, [1.0], 1), (2, [1.0], 2)]):
        assert mined(spark, rows) == brute_force(rows) == []


def test_bounds_hold_and_cells_come_in_order():
    rng = np.random.default_rng(3)
    points = rng.integers(-300, 300, (400, 7)).astype(float)
    books = (negatives.codebook(points[:, :4], 5), negatives.codebook(points[:, 4:], 5))
    words = [negatives.nearest_word(part, book) for part, book in zip((points[:, :4], points[:, 4:]), books, strict=True)]
    away = [np.sqrt(((part - book[w]) ** 2).sum(1)) for part, book, w in zip((points[:, :4], points[:, 4:]), books, words, strict=True)]
    codes = words[0] * negatives.MOST_WORDS + words[1]
    numbers = sorted(set(codes.tolist()))
    radii = np.array([[a[codes == c].max() for a in away] for c in numbers])
    directory = negatives.Directory(4, books, numbers, radii, [int((codes == c).sum()) for c in numbers], [1] * len(numbers))
    for _ in range(20):
        q = rng.normal(size=7) * 100
        scores, rests = points @ q, []
        visited = list(directory.visit(q))
        assert sorted(k for k, *_ in visited) == list(range(len(numbers)))
        for n, (k, upper, lower, rest) in enumerate(visited):
            own = scores[codes == numbers[k]]
            assert lower <= own.min() and own.max() <= upper
            assert all(scores[codes == numbers[later]].max() <= rest for later, *_ in visited[n:])
            rests.append(rest)
        assert rests == sorted(rests, reverse=True)


def shuffled(df):
    """Rows that the exchanges of the plan have written."""
    df.collect()
    todo, rows = [df._jdf.queryExecution().executedPlan()], 0
    while todo:
        node = todo.pop()
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif kind.endswith("QueryStageExec"):
            todo.append(node.plan())
        else:
            rows += node.metrics().apply("shuffleRecordsWritten").value() if kind == "ShuffleExchangeExec" else 0
            todo += [node.children().apply(k) for k in range(node.children().size())]
    return rows


def test_no_row_for_an_anchor_and_a_cell(spark):
    rng = np.random.default_rng(8)
    rows = [(k, rng.normal(size=24).tolist(), int(rng.integers(3))) for k in range(3_000)]
    got = negatives.hard_negatives(table(spark, rows), F.col("vec_id") % 10 == 0, cell=6)
    assert 7_000 < got.count() <= 300 * 25  # of 300 anchors, which 400 cells may matter to
    assert shuffled(got) < 60_000


def test_shelves_are_bounded():
    batches = [pa.RecordBatch.from_pydict({"vec_id": list(range(start, start + n))}) for start, n in ((0, 3), (3, 25), (28, 0), (28, 9), (37, 1))]
    shelves = list(negatives._shelves(iter(batches), 10))
    assert max(s.num_rows for s in shelves) <= 10
    assert [i for s in shelves for i in s.column("vec_id").to_pylist()] == list(range(38))


@pytest.mark.parametrize("same", [False, True])
@pytest.mark.parametrize("size", [1, 300, 10**7])
def test_blocks_keep_the_best_of_all_shelves(same, size):
    """Windows with lows and last ids, numbers that floats, doubles and neither hold, shelves of many spans."""
    rng, width, k = np.random.default_rng(size), 5, 3
    books = (rng.normal(size=(3, 3)) * size, rng.normal(size=(3, 2)) * size)

    def packed(n):
        vectors = rng.integers(-size, size + 1, (n, width))
        wide = (np.abs(vectors) >= 2**15).any(1)
        words = [negatives.nearest_word(part, book) for part, book in zip((vectors[:, :3], vectors[:, 3:]), books, strict=True)]
        away = [np.sqrt(((part - book[w]) ** 2).sum(1)) * (1 + 1e-9) for part, book, w in zip((vectors[:, :3], vectors[:, 3:]), books, words, strict=True)]
        data = [v.astype("<i8" if w else "<i2").tobytes() for v, w in zip(vectors, wide, strict=True)]
        return vectors, {"label": rng.integers(0, 4, n), "vector": data, "wide": wide, "cell": words[0] * negatives.MOST_WORDS + words[1], "away_0": away[0], "away_1": away[1]}

    members, columns = packed(400)
    ids = rng.integers(0, 300, 400)
    shelves = [negatives._Shelf(pa.table({"vec_id": ids[at], **{c: np.asarray(v, dtype=object if c == "vector" else None)[at] for c, v in columns.items()}}), books, width) for at in (slice(0, 250), slice(250, 400))]
    anchors, own = packed(40)
    scores = anchors.astype(object) @ members.astype(object).T
    highs = [[int(np.median(row)), int(row.max())] for row in scores]
    lows = [[int(row.min()) - 1, int(np.median(row))] for row in scores]
    block = negatives._Block(pa.table({"row": np.arange(40), "anchor_id": np.arange(40), **own, "places": [[0, 2]] * 40, "lows": lows, "lasts": [[negatives._LONG, 150]] * 40, "highs": highs}), width, 3, k)
    for shelf in shelves:
        negatives._meet(shelf, block, same)
    got = {(r, p): [] for r in range(40) for p in (0, 2)}
    for batch in block.found():
        for r, p, i, s in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            got[r, p].append((-s, i))
    for r in range(40):
        for p, low, high, last in zip((0, 2), lows[r], highs[r], (negatives._LONG, 150), strict=True):
            fits = [(-int(s), int(i)) for s, i, y in zip(scores[r], ids, columns["label"], strict=True) if i != r and (y == own["label"][r]) == same and s <= high and (s > low or s == low and i <= last)]
            assert got[r, p] == sorted(fits)[:k]
