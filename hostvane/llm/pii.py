"""Personal data in texts: patterns, and a skip-chain conditional random field that keeps a document's labels consistent.

Nodes of the field are the tokens of a document (stretches without white space) that hold a digit or an at-sign; the words
around them are observed. A node's label is one of the kinds or none. Neighbouring nodes share a chain potential, and each
occurrence of a token shares a skip potential with the next occurrence of the same or a similar token, however far away:
the same text without case and edge punctuation, the same seven or more digits, or the local part of an address. The chain
of next occurrences links all copies with few edges. Loopy belief propagation runs a fixed number of rounds, so a
document's result does not depend on what else is in the batch.

The weights are trained in pieces: node weights by multinomial regression, and the potentials from how often both ends of
an edge have which labels. Labels to learn from are those of the patterns. When the field is applied, the patterns' finds
are given; what it decides is the rest: the number that lost its plus sign, the address's account name.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hostvane.llm.shared import small_batches, texts

KINDS = ("email", "ip", "card", "phone")
_NONE = len(KINDS)
_LABELS = len(KINDS) + 1

#: Documents, and nodes of each, that the weights are fitted on; features seen fewer times count as rare ones.
TRAIN_DOCUMENTS, TRAIN_NODES, LEAST_SEEN = 4_096, 64, 3
#: Rounds of training and their step, weight of the penalty, rounds of message passing and how much of a message is kept.
STEPS, RATE, PENALTY, ROUNDS, DAMPING = 150, 1.0, 1e-3, 10, 0.3
#: Imagined edges between equal labels and between different ones, for each kind of edge.
AGREE, DISAGREE = 40.0, 2.0
#: A span of the field's own needs this probability in all of its nodes.
THRESHOLD = 0.9
#: Digits, and characters of a local part, from which two tokens are similar.
SIMILAR_DIGITS, SIMILAR_LOCAL = 7, 5

# The patterns of the contract, in forms that take linear time: a match can only begin where a run of its first
# characters begins, and no step back into a run of digits can help.
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NODE = re.compile(r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+")
_ANY = re.compile(r"[0-9@]")
_NOT_DIGITS = re.compile(r"[^0-9]+")
_WORD = re.compile(r"[^\W\d_]+")
_IN_NUMBERS = frozenset("0123456789 ().-+")
_EDGES = "\"'`.,;:!?<>[]{}()|*"

Span = tuple[int, int, int]  # kind, start, end


def luhn(digits: str) -> bool:
    total = 0
    for k, digit in enumerate(reversed(digits)):
        n = int(digit) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            end = found.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def patterns(text: str) -> list[Span]:
    """The base spans by kind, then start."""
    if not _ANY.search(text):
        return []
    found = [(0, *span) for span in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in m[0].split(".")):
            found.append((1, *m.span()))
    for m in _CARD.finditer(text):
        digits = _NOT_DIGITS.sub("", m[0])
        if 16 <= len(digits) <= 19 and luhn(digits):
            found.append((2, *m.span()))
    for m in _PHONE.finditer(text):
        if 8 <= len(_NOT_DIGITS.sub("", m[0])) <= 15:
            found.append((3, *m.span()))
    return found


@dataclass
class Graph:
    """A document's nodes (start, end of the token without edge punctuation), given labels, features and edges."""

    spans: list[tuple[int, int]]
    labels: list[int]
    features: list[list[str]]
    chain: list[tuple[int, int]]
    skip: list[tuple[int, int]]


def _shape(token: str) -> str:
    """Runs of digits with their length (up to 20), runs of letters, other characters as they are."""
    return re.sub(r"[0-9]+", lambda m: f"9{{{min(len(m[0]), 20)}}}", re.sub(r"[^\W\d_]+", "a", token[:200]))


def _keys(token: str, local: bool) -> list[str]:
    """What makes two tokens the same or similar."""
    keys = [token.lower()]
    digits = _NOT_DIGITS.sub("", token)
    if len(digits) >= SIMILAR_DIGITS:
        keys.append("#" + digits)
    if local and "@" in token and token.index("@") >= SIMILAR_LOCAL:
        keys.append(token[: token.index("@")].lower())
    return keys


def graph(text: str, base: list[Span]) -> Graph:
    out = Graph([], [], [], [], [])
    latest: dict[str, int] = {}
    given = iter(sorted(base, key=lambda s: (s[1], s[2])))
    open_spans, coming = [], next(given, None)
    stop = 0
    for m in _NODE.finditer(text):
        start, end = m.span()
        while coming and coming[1] < end:
            open_spans.append(coming)
            coming = next(given, None)
        open_spans = [s for s in open_spans if s[2] > start]
        label = next((kind for kind, *_ in open_spans), _NONE)
        token = m[0]
        left, right = len(token) - len(token.lstrip(_EDGES)), len(token.rstrip(_EDGES))
        core = token[left:right]
        k = len(out.spans)
        before = text[max(stop, start - 40, 0) : start]
        words = _WORD.findall(before)
        near = bool(out.spans) and not before.strip() and stop > start - 40
        if near:
            out.chain.append((k - 1, k))
        features = [f"shape={_shape(core)}", f"word={words[-1].lower() if words else ''}"]
        features += [f"before={_shape(text[slice(*out.spans[-1])])}" if near else "before=", "none"]
        out.spans.append((start + left, start + right) if core else (start, end))
        out.labels.append(label)
        out.features.append(features)
        for key in _keys(core, label == 0):
            if key in latest and latest[key] != k:
                out.skip.append((latest[key], k))
            latest[key] = k
        stop = end
    for k, (near, far) in enumerate(out.chain):  # what follows a node tells as much as what precedes it
        out.features[near].append(f"after={_shape(text[slice(*out.spans[far])])}")
    return out


@dataclass
class Field:
    """Weights of features by label, and log potentials of both kinds of edges."""

    names: dict[str, int]
    weights: np.ndarray
    chain: np.ndarray
    skip: np.ndarray


def _potential(counts: np.ndarray) -> np.ndarray:
    """Log of how much more often two labels meet than if ends were independent. All kinds share what is counted between
    equal kinds, between a kind and none, and between different kinds."""
    kinds = slice(0, _NONE)
    equal = np.trace(counts[kinds, kinds])
    mixed = counts[kinds, kinds].sum() - equal
    open_ends = counts[kinds, _NONE].sum() + counts[_NONE, kinds].sum()
    joint = np.full((_LABELS, _LABELS), (mixed + DISAGREE / 4) / (len(KINDS) * (len(KINDS) - 1)))
    joint[range(_NONE), range(_NONE)] = (equal + AGREE) / len(KINDS)
    joint[kinds, _NONE] = joint[_NONE, kinds] = (open_ends + DISAGREE) / (2 * len(KINDS))
    joint[_NONE, _NONE] = counts[_NONE, _NONE] + AGREE
    joint /= joint.sum()
    ends = joint.sum(0)
    return np.log(joint / np.outer(ends, ends))


def train(docs: DataFrame, text: str = "text", documents: int = TRAIN_DOCUMENTS, nodes: int = TRAIN_NODES) -> Field:
    """Fit the field to the patterns' finds in at most `documents` texts that hold a digit or an at-sign, drawn by a hash of
    the text, and the first `nodes` nodes of each. Only their features come to the driver."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            rows = []
            for value in texts(batch):
                g = graph(value, patterns(value))
                kept = [[(a, b) for a, b in edges if b < nodes] for edges in (g.chain, g.skip)]
                pairs = [[g.labels[a] * _LABELS + g.labels[b] for a, b in edges] for edges in kept]
                rows.append((g.labels[:nodes], g.features[:nodes], *pairs))
            kinds = [pa.list_(pa.int32()), pa.list_(pa.list_(pa.string())), pa.list_(pa.int32()), pa.list_(pa.int32())]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], ["labels", "features", "chain", "skip"])

    value = F.col(text).cast("string")
    drawn = docs.select(value.alias("text")).where(value.rlike("[0-9@]")).select(F.xxhash64("text").alias("hash"), "text")
    drawn = drawn.orderBy("hash").limit(documents).select("text")
    found = drawn.repartition(8).mapInArrow(read, "labels array<int>, features array<array<string>>, chain array<int>, skip array<int>")
    sample = found.toArrow()
    labels = np.array([y for row in sample["labels"].to_pylist() for y in row], dtype=np.int64)
    features = [f for row in sample["features"].to_pylist() for f in row]
    tables = [
        np.bincount(np.array([p for row in sample[name].to_pylist() for p in row], dtype=np.int64), minlength=_LABELS**2).reshape(_LABELS, _LABELS)
        for name in ("chain", "skip")
    ]
    return fit(labels, features, *tables)


def fit(labels: np.ndarray, features: list[list[str]], chain: np.ndarray, skip: np.ndarray) -> Field:
    seen = Counter(f for own in features for f in own)
    common = {f for f, n in seen.items() if n >= LEAST_SEEN}
    names = {f: k for k, f in enumerate(sorted(common | {_rare(f) for f in seen if f not in common}))}
    weights = np.zeros((len(names) + 1, _LABELS))  # the last is that of no feature
    if names:
        places, columns = _sparse(features, names)
        target = np.eye(_LABELS)[labels]
        squares = np.full_like(weights, 1e-8)
        for _ in range(STEPS):
            off = _softmax(_scores(weights, places, columns, len(labels))) - target
            gradient = np.zeros_like(weights)
            np.add.at(gradient, columns, off[places])
            gradient = gradient / len(labels) + PENALTY * weights
            squares += gradient**2
            weights -= RATE * gradient / np.sqrt(squares)
    else:
        weights[:, _NONE] = 10.0
    return Field(names, weights, _potential(chain), _potential(skip))


def _rare(feature: str) -> str:
    return feature.partition("=")[0] + "=?"


def _sparse(features: list[list[str]], names: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """Places of nodes and their features; one that was rarely or never seen counts as a rare one of its sort."""
    known = ((n, names.get(f, names.get(_rare(f)))) for n, own in enumerate(features) for f in own)
    pairs = [(n, k) for n, k in known if k is not None]
    return tuple(np.array(pairs, dtype=np.int64).reshape(-1, 2).T)


def _scores(weights: np.ndarray, places: np.ndarray, columns: np.ndarray, n: int) -> np.ndarray:
    return np.stack([np.bincount(places, weights[columns, y], minlength=n) for y in range(_LABELS)], 1)


def _softmax(scores: np.ndarray) -> np.ndarray:
    out = np.exp(scores - scores.max(1, keepdims=True))
    return out / out.sum(1, keepdims=True)


def beliefs(field: Field, graphs: list[Graph]) -> np.ndarray:
    """Probabilities of the labels of all nodes, one row each, by loopy message passing with a fixed number of rounds."""
    offsets = np.cumsum([0, *[len(g.labels) for g in graphs]])
    n = int(offsets[-1])
    labels = np.array([y for g in graphs for y in g.labels], dtype=np.int64)
    own = _scores(field.weights, *_sparse([f for g in graphs for f in g.features], field.names), n)
    given = labels != _NONE
    own[given] = np.where(np.eye(_LABELS, dtype=bool)[labels[given]], 0.0, -60.0)
    own -= own.max(1, keepdims=True)
    pairs = [np.array([(o + a, o + b) for o, g in zip(offsets, graphs) for a, b in edges(g)], dtype=np.int64).reshape(-1, 2) for edges in (lambda g: g.chain, lambda g: g.skip)]
    sources = np.concatenate([*[p[:, 0] for p in pairs], *[p[:, 1] for p in pairs]])
    targets = np.concatenate([*[p[:, 1] for p in pairs], *[p[:, 0] for p in pairs]])
    half = len(sources) // 2
    forward = np.concatenate([np.broadcast_to(t, (len(p), _LABELS, _LABELS)) for t, p in zip((field.chain, field.skip), pairs)])
    tables = np.concatenate([forward, forward.transpose(0, 2, 1)])  # [edge, source's label, target's label]
    back = np.concatenate([np.arange(half) + half, np.arange(half)])
    messages = np.zeros((2 * half, _LABELS))
    for _ in range(ROUNDS if half else 0):
        total = own + _gathered(targets, messages, n)
        sent = (total[sources] - messages[back])[:, :, None] + tables
        top = sent.max(1)
        new = top + np.log(np.exp(sent - top[:, None, :]).sum(1))
        new -= new.max(1, keepdims=True)
        messages = DAMPING * messages + (1 - DAMPING) * new
    return _softmax(own + _gathered(targets, messages, n))


def _gathered(targets: np.ndarray, messages: np.ndarray, n: int) -> np.ndarray:
    return np.stack([np.bincount(targets, messages[:, y], minlength=n) for y in range(_LABELS)], 1)


def _holds(kind: int, text: str, linked: bool) -> bool:
    """Whether a span can be of its kind at all. Digits alone are no phone number: it needs a plus sign or a given number
    that it is like."""
    digits = _NOT_DIGITS.sub("", text)
    if kind == 0:
        return linked or "@" in text
    if kind == 1:
        parts = [p for p in _NOT_DIGITS.split(text) if p]
        return len(parts) == 4 and text.count(".") >= 3 and all(len(p) <= 3 and int(p) <= 255 for p in parts)
    if kind == 2:
        return 13 <= len(digits) <= 19 and luhn(digits) and not set(text) - _IN_NUMBERS
    return 7 <= len(digits) <= 15 and not set(text) - _IN_NUMBERS and (linked or text.startswith("+"))


def added_spans(text: str, g: Graph, probabilities: np.ndarray) -> list[tuple[int, int, int, float]]:
    """Spans of the field's own, none of which touches a given one: kind, start, end, probability."""
    chained = {b for _, b in g.chain}
    linked: dict[int, set[int]] = defaultdict(set)
    for a, b in g.skip:
        linked[a].add(g.labels[b])
        linked[b].add(g.labels[a])
    runs: list[list[int]] = []
    best, sure = probabilities.argmax(1), probabilities.max(1)
    for k in range(len(g.labels)):
        if g.labels[k] != _NONE or best[k] == _NONE or sure[k] < THRESHOLD:
            continue
        if runs and runs[-1][-1] == k - 1 and k in chained and best[k] == best[k - 1]:
            runs[-1].append(k)
        else:
            runs.append([k])
    out = []
    for run in runs:
        kind, start, end = int(best[run[0]]), g.spans[run[0]][0], g.spans[run[-1]][1]
        if start > 0 and text[start - 1] == "(" and ")" in text[start:end]:
            start -= 1
        if _holds(kind, text[start:end], any(kind in linked[k] for k in run)):
            out.append((kind, start, end, float(min(sure[k] for k in run))))
    return out


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_()), ("score", pa.float64())])


def personal_data(docs: DataFrame, field: Field | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_email, n_ip, n_card, n_phone (finds of the patterns) and `spans`, by kind as listed,
    then start: kind, start, end (code points, end exclusive), base (found by a pattern), score (1, or the field's
    probability). `field` is trained on the same documents unless given.

    Null text is the empty text: no spans. Whole texts of any length, in time linear in it but for sorting. Null and
    repeated ids, repeated rows: a row each. Other columns are ignored. An empty table gives an empty result; without any
    find of a pattern to learn from, the field adds nothing.
    """
    shared = docs.sparkSession.sparkContext.broadcast(field or train(docs, text))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            values = texts(batch)
            base = [patterns(value) for value in values]
            graphs = [graph(v, b) if _ANY.search(v) else Graph([], [], [], [], []) for v, b in zip(values, base, strict=True)]
            sure, at = beliefs(shared.value, graphs), 0
            spans = []
            for value, own, g in zip(values, base, graphs, strict=True):
                more = added_spans(value, g, sure[at : at + len(g.labels)]) if g.labels else []
                at += len(g.labels)
                everything = [(k, s, e, True, 1.0) for k, s, e in own] + [(k, s, e, False, p) for k, s, e, p in more]
                spans.append([dict(zip(_SPAN.names, (KINDS[k], *rest), strict=True)) for k, *rest in sorted(everything)])
            counts = [pa.array([sum(k == kind for k, *_ in own) for own in base], pa.int64()) for kind in range(_NONE)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *counts, pa.array(spans, pa.list_(_SPAN))], ["doc_id", *[f"n_{k}" for k in KINDS], "spans"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    counts = ", ".join(f"n_{kind} long" for kind in KINDS)
    return rows.mapInArrow(find, f"doc_id long, {counts}, spans array<struct<kind: string, start: long, end: long, base: boolean, score: double>>")
