"""Token ids of texts by a public tokenizer, with what a worker has already encoded kept in memory.

A byte-level BPE file cuts a text before every space that a non-space follows, so the stretches between such spaces
("pieces": one or more pre-tokens) encode alone just as they do in the text. Each worker keeps the ids of the pieces it
has met and gives only new ones to the tokenizer. Texts that hold a special token's string, and files of another kind,
go to the tokenizer whole.
"""

from __future__ import annotations

import base64
import functools
import json
import os
import re
import sys
from array import array
from itertools import chain

DEFAULT_FILE = "byte_bpe_50k.json"
#: Pieces of a generation; a worker keeps two generations. The ids do not depend on it.
KEPT_PIECES = 400_000
LONGEST_KEPT = 64

_CUT = re.compile(r" (?=\S)")


def tokenizer_path(name: str = DEFAULT_FILE) -> str:
    """Path of a public tokenizer file on the machine that asks; every executor has these files installed."""
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """A public tokenizer, and whether its file allows encoding piece by piece."""

    def __init__(self, name: str = DEFAULT_FILE):
        if name.endswith(".tiktoken"):
            self._from_ranks(name)
            return
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path(name))
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        spec = json.loads(self.tokenizer.to_str())
        cut = spec.get("pre_tokenizer") or {}
        self.by_piece = (
            spec.get("normalizer") is None
            and cut.get("type") == "ByteLevel"
            and cut.get("use_regex", True)
            and not cut.get("add_prefix_space", True)
        )
        self.vocabulary = self.tokenizer.get_vocab_size()
        self.special = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]

    def _from_ranks(self, name: str) -> None:
        """A byte-level BPE as ranks; strings of special tokens are ordinary text."""
        import public_tokenizers
        import tiktoken

        with open(tokenizer_path(name), "rb") as file:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
        encoding = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.by_piece, self.special, self.vocabulary = True, [], len(ranks)
        self.whole = lambda texts: list(map(encoding.encode_ordinary, texts))
        #: The ids of one text as an array of unsigned 32-bit numbers.
        self.ordinary = lambda text: encoding.encode_to_numpy(text, disallowed_special=())

    def whole(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def needs_whole(self, text: str) -> bool:
        return not self.by_piece or any(special in text for special in self.special)


@functools.cache
def encoder(name: str = DEFAULT_FILE) -> Encoder:
    return Encoder(name)


def _unsafe(piece: str) -> bool:
    """Whether the space before the piece belongs to a run of white space."""
    return not piece or piece[0].isspace()


class _Kept:
    """Values per piece in a worker's memory.

    When that is full, a new generation starts from the seed, and takes over from the last one what is met again.
    """

    def __init__(self, name: str, seed: dict):
        self.encoder, self.seed = encoder(name), seed
        self.known, self.last = dict(seed), {}  # by piece, without the space before it

    def value(self, ids: list[int]):
        raise NotImplementedError

    def total(self, parts):
        raise NotImplementedError

    def _learn(self, pieces: set[str]) -> dict:
        """Make new pieces known; returns the values of long ones, which are not kept."""
        again = self.last.keys() & pieces
        self.known.update((piece, self.last[piece]) for piece in again)
        new = list(pieces.difference(again))
        values = dict(zip(new, map(self.value, self.encoder.whole([" " + piece for piece in new])), strict=True))
        long = {piece: values.pop(piece) for piece in new if len(piece) > LONGEST_KEPT}
        self.known.update(values)
        return long

    def of(self, texts: list[str]) -> list:
        """One value per text."""
        if len(self.known) > len(self.seed) + KEPT_PIECES:
            self.known, self.last = dict(self.seed), self.known
        whole = [k for k, text in enumerate(texts) if self.encoder.needs_whole(text)]
        out: list = [None] * len(texts)
        for k, ids in zip(whole, self.encoder.whole([texts[k] for k in whole]), strict=True):
            out[k] = self.total([self.value(ids)])
        cut = {k: text.split(" ") for k, text in enumerate(texts) if out[k] is None}
        heads = {k: pieces.pop(0) for k, pieces in cut.items()}
        new = set(chain.from_iterable(cut.values())).difference(self.known)
        if any(map(_unsafe, new)):  # runs of white space: cut those texts only where it is safe
            for k, pieces in cut.items():
                if any(map(_unsafe, pieces)):
                    heads[k], *cut[k] = _CUT.split(texts[k])
            new = set(chain.from_iterable(cut.values())).difference(self.known)
        long = self._learn(new)
        for (k, pieces), ids in zip(cut.items(), self.encoder.whole(list(heads.values())), strict=True):
            if long and not long.keys().isdisjoint(pieces):
                parts = [long[p] if p in long else self.known[p] for p in pieces]
            else:
                parts = map(self.known.__getitem__, pieces)
            out[k] = self.total([self.value(ids), *parts])
        return out


@functools.cache
def piece_ids(name: str = DEFAULT_FILE) -> PieceIds:
    """The worker's own, kept from task to task."""
    return PieceIds(name)


class PieceIds(_Kept):
    """Ids as bytes, little-endian unsigned 32-bit."""

    def __init__(self, name: str = DEFAULT_FILE):
        super().__init__(name, {})

    def value(self, ids):
        out = array("I", ids)
        if sys.byteorder == "big":
            out.byteswap()
        return out.tobytes()

    def total(self, parts):
        return b"".join(parts)


class PieceLengths(_Kept):
    """Numbers of ids; the seed holds frequent pieces with their lengths."""

    def value(self, ids):
        return len(ids)

    def total(self, parts):
        return sum(parts)
