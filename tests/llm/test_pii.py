"""Patterns against plain searches, and what the field adds."""

import hashlib
import random
import re

import numpy as np
import pytest

from hostvane.llm import pii, queries

COLUMNS = "doc_id long, text string, spans string, n_ip string, kind string"
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": True,
                "ip": kind != "ip" or all(int(p) <= 255 for p in m[0].split(".")),
                "card": 16 <= len(digits) <= 19 and sum(sum(map(int, str(int(d) * (1 + k % 2)))) for k, d in enumerate(digits[::-1])) % 10 == 0,
                "phone": 8 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append((list(PLAIN).index(kind), *m.span()))
    return out


CASES = [
    "mail a.b@c.de, x@y, @z.com a@b@c.org a@b.c@d.e. ü@x.de é.f@-.- a@b..c", "1.2.3.4 1.2.3.4.5.6.7.8 256.1.1.1 01.002.3.255 1.2.3 1..2.3.4 0000300.1.1.1",
    "4111 1111 1111 1111, 4111-1111-1111-1111 4111111111111112 4111  1111 1111 1111 4 1", "+1 (245) 555-1669. +49.151.2345678) +1 +12 + 3 ++44 20 7946 0958 +1234567",
    "", None, "no numbers", "٤١١١ ١ 4111111111111111٣", "a" * 50 + "@", "+" * 20, "1 " * 40, "- 5-5-5 -",
]


def test_patterns_against_plain_searches():
    rng = random.Random(3)
    for text in CASES:
        assert pii.patterns(text or "") == plain(text), text
    for _ in range(4000):
        text = "".join(rng.choice("0123456789..@@+- ()aZ_%é") for _ in range(rng.randrange(1, 60)))
        assert pii.patterns(text) == plain(text), text
    for _ in range(300):
        digits = "".join(rng.choice("0123456789") for _ in range(15))
        text = f"x {digits}{next(d for d in range(10) if pii.luhn(digits + str(d)))} +{digits[:9]}, {digits}"
        assert pii.patterns(text) == plain(text) and len(pii.patterns(text)) >= 2


def test_long_texts_take_linear_time():
    for text in ("9" * 300_000, "a" * 300_000 + "@", "1.2." * 100_000, "+1" * 100_000, "a@" * 100_000, "1-" * 100_000):
        found = pii.patterns(text)
        pii.graph(text, found)


def table(spark, rows):
    return spark.createDataFrame([(i, t, "s", "n", "k") for i, t in rows], COLUMNS)


def known_texts(n=300, seed=5):
    """Prose with marked data, and numbers that are none."""
    rng = random.Random(seed)
    words = "alpha beta gamma delta the of and und der la".split()
    out = []
    for k in range(n):
        body = [rng.choice(words) for _ in range(30)]
        number = f"+1 ({rng.randrange(200, 999)}) 555-{rng.randrange(1000, 9999)}"
        body.insert(7, [number, f"user{k}.x@mail.example.com", f"10.{k % 250}.3.4", str(rng.randrange(1900, 2030))][k % 4])
        body.insert(20, f"{rng.randrange(1, 99)}" if k % 3 else f"v{k}.2")
        out.append(" ".join(body))
    return out


@pytest.fixture(scope="module")
def field(spark):
    return pii.train(table(spark, list(enumerate(known_texts()))))


def spans(spark, field, rows):
    got = pii.personal_data(table(spark, rows), field).collect()
    return [(r.doc_id, [(s.kind, s.start, s.end, s.base) for s in r.spans]) for r in got]


def test_copies_without_a_plus_are_found(spark, field):
    text = "Call +1 (245) 555-1669 today. Or the of and 245 then 555-1669, or (245) 555-1669 again. In 2024 we had 17 and 3."
    (_, found), = spans(spark, field, [(1, text)])
    own = [text[s:e] for kind, s, e, base in found if kind == "phone" and not base]
    assert any("555-1669" in x for x in own) and not any("2024" in text[s:e] or "17" == text[s:e] for _, s, e, _ in found)
    assert [text[s:e] for _, s, e, base in found if base] == ["+1 (245) 555-1669"]


def test_account_name_of_an_address(spark, field):
    text = "Write to user77.x@mail.example.com about it; the of and la user77.x did not answer, while other9.x and r2d2 did."
    (_, found), = spans(spark, field, [(1, text)])
    assert [(text[s:e], base) for _, s, e, base in found] == [("user77.x@mail.example.com", True), ("user77.x", False)]


def test_clean_documents_stay_clean(spark, field):
    clean = ["In 2019 and 2020, 3.5 % of 1,234,567 units", "§ 12 a. 4. 17", "password=2594be4dd6d402559f token 18945874088f", "1 2 3 4 5", "Version 2.0 of 4111111111111112", "10 20 30 40", "2019 2020 2021 2022", "a1b2 3c4d 5e6f", "12:30 12-30 1/2"]
    assert [found for _, found in spans(spark, field, list(enumerate(clean)))] == [[]] * len(clean)


def test_odd_rows(spark, field):
    rows = [(1, None), (None, "a.b@c.de"), (2, ""), (2, "a.b@c.de"), (3, "ab 10.1.2.3 " * 12_000)]
    got = dict((i, s) for i, s in spans(spark, field, rows) if i != 2)
    assert got[1] == [] and got[None] == [("email", 0, 8, True)] and len(got[3]) == 12_000
    assert spans(spark, field, []) == []


def test_nothing_to_learn_from(spark):
    assert [r.spans for r in pii.personal_data(table(spark, [(1, "1 22 333"), (2, "x")])).collect()] == [[], []]
    assert pii.personal_data(table(spark, [])).collect() == []


def test_batches_do_not_matter(field):
    rng = random.Random(8)
    documents = known_texts(40, 9) + [f"+1 (245) 555-{n} or {n} or 555-{n}" for n in rng.sample(range(1000, 9999), 20)]
    graphs = [pii.graph(t, pii.patterns(t)) for t in documents]
    together = pii.beliefs(field, graphs)
    alone = np.concatenate([pii.beliefs(field, [g]) for g in graphs])
    assert np.abs(together - alone).max() < 1e-9


def test_messages_are_exact_on_a_chain(field):
    """On a tree, belief propagation gives the marginals of the joint distribution."""
    import itertools

    g = pii.Graph([(0, 1)] * 3, [4, 4, 3], [["none"], ["before="], []], [(0, 1)], [(1, 2)])
    got = pii.beliefs(field, [g])
    weight = lambda k, y: sum(field.weights[field.names[f], y] for f in g.features[k] if f in field.names)
    want = np.zeros((3, 5))
    for a, b in itertools.product(range(5), repeat=2):
        p = np.exp(weight(0, a) + weight(1, b) + field.chain[a, b] + field.skip[b, 3])
        want[0, a] += p
        want[1, b] += p
    assert np.abs(got[:2] - want[:2] / want[:2].sum(1, keepdims=True)).max() < 1e-3


def test_query(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    got = queries.QUERIES["op13_pii"](spark, "/root/testdata/sf0.001").collect()
    assert len(got) == 200
    for row in got:
        base = plain(docs[row.doc_id])
        named = [f"{pii.KINDS[k]}:{s}:{e}" for k, s, e in base]
        assert [row[f"n_{kind}"] for kind in pii.KINDS] == [sum(k == n for k, *_ in base) for n in range(4)]
        assert row.base_sha256 == hashlib.sha256(",".join(named).encode()).hexdigest()
        assert set(named) <= set(row.spans.split(",") if row.spans else [])
