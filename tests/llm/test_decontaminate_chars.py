"""Items with changed characters, short items and items of gapless scripts, against a search of every stretch."""

import random
import string

import pytest
from test_decontaminate import normal, prose

from hostvane.llm import decontaminate as d


def changed(text, share, rng, letters=string.ascii_lowercase):
    """Characters replaced, added and dropped."""
    out = list(text)
    for place in sorted(rng.sample(range(len(out)), int(share * len(out))), reverse=True):
        out[place : place + 1] = rng.choice([[], [rng.choice(letters)], [rng.choice(letters), out[place]]])
    return "".join(out)


def one_in_each_word(text, rng):
    places = [(word, rng.randrange(len(word))) for word in text.split()]
    return " ".join(word[:k] + rng.choice(string.ascii_lowercase) + word[k + 1 :] for word, k in places)


def letters(rng, n):
    return " ".join("".join(rng.choice(string.ascii_lowercase) for _ in range(rng.randint(3, 7))) for _ in range(n))


def recall(items, copies, around):
    """(found, wanted) of the copies that are within the limit; whatever is found is within it."""
    documents = [f"{around(k)} {copy} {around(k + 1)}" for k, copy in enumerate(copies)]
    got = {(k, item): edits for k, item, edits, _ in d.Index(list(enumerate(items))).matches(documents)}
    fewest = {k: d.fewest_edits(normal(items[k]), normal(text)) for k, text in enumerate(documents)}
    wanted = [k for k, n in fewest.items() if n <= d.MOST_EDITS * len(normal(items[k]))]
    for (k, item), edits in got.items():
        assert edits == d.fewest_edits(normal(items[item]), normal(documents[k])) <= d.MOST_EDITS * len(normal(items[item]))
    return sum((k, k) in got for k in wanted), len(wanted)


@pytest.mark.parametrize("share, least", [(0.05, 1), (0.1, 0.99), (0.15, 0.98), (0.195, 0.95), (None, 0.95)])
def test_recall_by_share_of_characters(share, least):
    rng = random.Random(5)
    items = [letters(rng, rng.randint(16, 60)) for _ in range(150)]
    copies = [changed(t, share, rng) if share else one_in_each_word(t, rng) for t in items]
    around = [letters(rng, 30) for _ in range(len(items) + 1)]
    found, wanted = recall(items, copies, around.__getitem__)
    assert wanted >= 120 and found >= least * wanted


def test_items_of_10_to_16_words():
    rng = random.Random(6)
    items = [letters(rng, rng.randint(10, 16)) for _ in range(200)]
    copies = []
    for text in items:
        words = text.split()
        words[rng.randrange(3, 6)] = "changed"
        words[rng.randrange(6, 10)] = "too"
        copies.append(" ".join(words))
    around = [letters(rng, 30) for _ in range(len(items) + 1)]
    found, wanted = recall(items, copies, around.__getitem__)
    assert wanted > 180 and found >= 0.98 * wanted


@pytest.mark.parametrize("low, high", [(40, 63), (64, 79), (80, 150), (300, 600)])
@pytest.mark.parametrize("share", [0.05, 0.1, 0.15, 0.195, "word", "fifth"])
def test_recall_by_length_and_kind_of_edits(low, high, share):
    rng = random.Random(f"{low} {share}")
    items = [letters(rng, 150)[: rng.randint(low + 1, high)].strip() for _ in range(60)]
    edit = {"word": lambda t: one_in_each_word(t, rng), "fifth": lambda t: "".join("q" if k % 5 == 4 else c for k, c in enumerate(t))}
    copies = [edit[share](t) if share in edit else changed(t, share, rng) for t in items]
    around = [letters(rng, 30) for _ in range(len(items) + 1)]
    found, wanted = recall(items, copies, around.__getitem__)
    assert wanted >= 50 and found >= 0.95 * wanted


def test_samplings_and_walks_differ():
    for kind in d.KINDS:
        walks = [d.Walk(kind, number) for number in range(kind.walks)]
        assert all(len(set(w.samples)) == kind.tables and all(len(s) == kind.sampled for s in w.samples) for w in walks)
        assert len({tuple(w.bits) for w in walks}) == kind.walks and all(len(set(w.bits)) == kind.steps for w in walks)


HAN = [chr(c) for c in range(0x4E00, 0x5200)]


def test_items_without_spaces():
    rng = random.Random(7)
    sentence = lambda n: "".join(rng.choice(HAN) for _ in range(n))
    items = [sentence(rng.randint(20, 120)) + "\u3002" for _ in range(60)]
    around = [sentence(40) for _ in range(61)]
    assert recall(items, items, around.__getitem__) == (60, 60)
    found, wanted = recall(items, [changed(t, 0.1, rng, HAN) for t in items], around.__getitem__)
    assert wanted == 60 and found >= 0.95 * wanted
    short = [sentence(n) for n in (2, 5, 9, 13)]
    matched = {(k, item) for k, item, *_ in d.Index(list(enumerate(short))).matches([sentence(9) + t + sentence(9) for t in short])}
    assert {(k, k) for k in range(4)} <= matched


def test_short_items_are_found_as_whole_words():
    items = [(5, "What is entropy?"), (6, "art"), (7, "Who wrote the long book about whales and the sea?"), (8, "  "), (9, None)]
    documents = ["so: what is\nentropy", "what is entropyx", "a party", "ART!", "who wrote the lonk book about whales and the sea", "", "part art"]
    index = d.Index(items)
    got = {(k, index.items[item][0], edits, first) for k, item, edits, first in index.matches(documents)}
    assert got == {(0, 5, 0, 1), (3, 6, 0, 0), (4, 7, 1, 0), (6, 6, 0, 1)}


def test_first_word():
    rng = random.Random(8)
    item, before = prose(rng, 30), prose(rng, 12)
    (match,) = d.Index([(1, item)]).matches([f"{before} {item} {before}"])
    assert match == (0, 0, 0, 12)


def test_documents_without_any_hit():
    index = d.Index([(1, prose(random.Random(9), 30))])
    assert list(index.matches(["0 1 2 3 4 5 6 7 8 9 10 11 12", "", "x"])) == [] == list(index.matches([""])) == list(index.matches([]))
