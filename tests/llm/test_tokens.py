"""Token counts and packing against the tokenizer itself."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from hostvane.llm import packing, token_counts
from hostvane.llm.tokens import PieceIds, PieceLengths, encoder

NASTY = [
    "", " ", "  ", "\n", "a", " a", "a ", "a  b", "a   b", "a\n b", "a \n b", "a \n\n  b  ", "foo\n \nbar", "x\t y", "x \ty",
    "don't we'll 's  's", "été l'œuvre à  la", "a b  c", "\x1c \x1cfoo \x1c", "a  b", "日本語 テキスト", "🙂 🙂🙂  🙂",
    "end<|endoftext|> of <|endoftext|>", "<|endoftext", "12 345  6.7,8", "word " * 50, "Words, in a row.\nNext one;\nthen ª º × ÷ a×b Łódź!?.\nÉté\nx\ny z.\n\nw don't.\nit's it's.", "y" * 500 + " " + "z" * 400, "a\r\n\r\n b",
]


def documents(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, n_tokens string, piece string, length string")


def plain(text):
    return encoder().tokenizer.encode(text, add_special_tokens=False).ids


def random_texts(n, seed):
    rng = random.Random(seed)
    alphabet = ["a", "Word", ".\nNext", "×", ",", "?!", "the", "été", " ", "  ", "\n", "\t", "'s", "'", ".", "9", "é", " ", "<|endoftext|>", "ß", "\x1c"]
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(n)]


def test_pieces_encode_like_the_text():
    texts = NASTY + random_texts(2000, 1)
    ids, lengths = PieceIds(), PieceLengths("byte_bpe_50k.json", {"the": 1})
    for start in range(0, len(texts), 300):
        part = texts[start : start + 300]
        assert [np.frombuffer(b, "<u4").tolist() for b in ids.of(part)] == [plain(t) for t in part]
        assert lengths.of(part) == [len(plain(t)) for t in part]


def test_other_kinds_of_file_are_encoded_whole():
    lengths = PieceLengths("word_bpe_49k.json", {})
    whole = encoder("word_bpe_49k.json").tokenizer
    assert not lengths.encoder.by_piece
    assert lengths.of(["Hello  World x"]) == [len(whole.encode("Hello  World x", add_special_tokens=False).ids)]


def test_token_counts(spark):
    rows = [(k, t, "x", "y", "z") for k, t in enumerate(NASTY + random_texts(100, 2))]
    rows += [(None, None, None, None, None), (None, "null id", None, None, None), (3, "repeated id", None, None, None)] * 2
    rows += [(900, "long text " * 20_000, None, None, None)]
    got = token_counts.token_counts(documents(spark, rows), limit=20).collect()
    want = sorted(((r[0] is None, r[0] or 0, len((r[1] or "").encode()), len(plain(r[1] or ""))) for r in rows))
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_bytes, r.n_tokens) for r in got) == want
    assert all(r.over_limit == (r.n_tokens > 20) for r in got)


def test_empty_tables(spark):
    none = documents(spark, [])
    assert token_counts.token_counts(none).collect() == [] and packing.pack_documents(none).collect() == []


def check_packing(rows, window, documents_by_id):
    at = defaultdict(list)
    parts = defaultdict(list)
    for r in rows:
        at[r.sequence_id].append((r.offset, r.length))
        parts[r.doc_id].append(r)
    for spans in at.values():
        end = 0
        for offset, length in sorted(spans):
            assert offset == end and length > 0
            end += length
        assert end <= window
    for key, ids in documents_by_id.items():
        whole, position = np.array(ids + [1], "<u4"), 0
        for r in sorted(parts[key], key=lambda r: r.start):
            assert r.start == position and r.doc_tokens == len(whole)
            assert r.ids_crc32 == zlib.crc32(whole[r.start : r.start + r.length].tobytes())
            position += r.length
        assert position == len(whole)
    padded = sum(window - end for spans in at.values() if (end := sum(n for _, n in spans)) & (end - 1))
    return padded / max(1, len(at) * window)


def test_packing(spark):
    texts = NASTY + random_texts(300, 3) + ["many words in it " * 4000]
    rows = [(k, t, "x", "y", "z") for k, t in enumerate(texts)] + [(None, None, None, None, None)]
    got = packing.pack_documents(documents(spark, rows), window=128, shard_items=60).collect()
    assert len({r.sequence_id // packing.SHARD_WINDOWS for r in got}) > 3
    padding = check_packing(got, 128, {None: [], **{k: plain(t) for k, t in enumerate(texts)}})
    assert padding < 0.1


def brute_force_places(sizes, window):
    """The rule itself: try every open window and a new one, take the smallest sum of squares, then the fullest."""
    levels, out = [], []
    for size in sizes:
        best = None
        for choice in [*range(len(levels)), None]:
            level = 0 if choice is None else levels[choice]
            if level + size > window:
                continue
            after = levels + [size] if choice is None else [h + size * (k == choice) for k, h in enumerate(levels)]
            squares = sum(n * n for h, n in zip(*np.unique([h for h in after if h < window], return_counts=True)))
            if best is None or (squares, -level) < best[:2]:
                best = (squares, -level, choice)
        out.append(-best[1])
        levels = levels + [size] if best[2] is None else [h + size * (k == best[2]) for k, h in enumerate(levels)]
    return out


@pytest.mark.parametrize("seed", range(5))
def test_placing_follows_the_rule(seed):
    sizes = np.random.default_rng(seed).integers(1, 17, 120)
    packer = packing.LevelPacker(16)
    assert [packer.place(int(s))[1] for s in sizes] == brute_force_places(sizes.tolist(), 16)


def test_every_item_lands_once_and_padding_is_small():
    sizes = np.random.default_rng(7).lognormal(6.5, 0.9, 20_000).astype(int) % 2048 + 1
    at, offset = packing.place_all(sizes, 2048)
    order = np.lexsort((offset, at))
    a, o, s = at[order], offset[order], sizes[order]
    first = np.r_[True, a[1:] != a[:-1]]
    assert (o[first] == 0).all() and (o[~first] == (o + s)[:-1][~first[1:]]).all()
    assert (o + s).max() <= 2048
    assert sizes.sum() / (len(np.unique(at)) * 2048) > 0.98
