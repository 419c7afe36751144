"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Features are hashed n-grams of 1 to 3 characters, counted over whole texts. Document frequencies come from every training
document. The weights are trained by follow-the-regularised-leader with elastic-net penalties on a sample of labelled
documents whose size has a bound (`SAMPLE_ROWS`); a part of the sample is held back, and on it one temperature is fitted
that makes the scores probabilities. Prediction runs in batches on the executors; the model's size is bounded by the
number of features and languages.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hostvane.llm.shared import small_batches, texts

FEATURES = 1 << 15
#: Labelled documents that the weights are fitted on, at most; of these, one in HELD_BACK is for the temperature.
SAMPLE_ROWS, HELD_BACK, EPOCHS = 4096, 5, 3
#: Step size and penalties of the training.
ALPHA, BETA, L1, L2 = 0.5, 1.0, 1e-3, 1e-4
UNDETERMINED = "und"
#: Documents whose language is less probable than this are rejected by `in_known_language`.
LEAST_SCORE = 0.5

CHARACTERS_AT_ONCE = 1_000_000
_LETTER = regex.compile(r"\p{L}")
_FACTORS = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA6B), np.uint32(0xC2B2AE35))


def counts(text: str) -> np.ndarray:
    """How often each feature occurs in the lower-cased text; ASCII characters that are no letter count as one space."""
    out = np.zeros(FEATURES, dtype=np.int64)
    text = f" {text.lower()} "
    for start in range(0, len(text), CHARACTERS_AT_ONCE):
        part = np.frombuffer(text[start : start + CHARACTERS_AT_ONCE + 2].encode("utf-32-le", "surrogatepass"), "<u4")
        letter = (part > 127) | ((part >= 97) & (part <= 122))
        part = np.where(letter, part, np.uint32(32))
        part = part[letter | np.r_[True, letter[:-1]]]  # runs of others are one space
        hashed = np.zeros(len(part), dtype=np.uint32)
        for n in range(1, 4):
            if len(part) < n:
                break
            hashed = (hashed[: len(part) - n + 1] ^ part[n - 1 :]) * _FACTORS[n - 1]
            hashed ^= hashed >> np.uint32(15)
            out += np.bincount(hashed % np.uint32(FEATURES), minlength=FEATURES)
    return out


def has_letter(text: str) -> bool:
    return _LETTER.search(text) is not None


def vector(found: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features and weights of unit length."""
    at = np.flatnonzero(found)
    weight = (1 + np.log(found[at])) * idf[at]
    norm = math.sqrt(float(weight @ weight))
    return at, weight / norm if norm else weight


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray  # features x languages
    temperature: float = 1.0

    def logits(self, text: str) -> np.ndarray:
        at, weight = vector(counts(text), self.idf)
        return weight @ self.weights[at]

    def predict(self, text: str) -> tuple[str, float]:
        """Language and its probability; `und` and 0 for a text without letters."""
        if not self.languages or not has_letter(text):
            return UNDETERMINED, 0.0
        p = _softmax(self.logits(text) / self.temperature)
        best = int(np.argmax(p))
        return self.languages[best], float(p[best])


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def fit_weights(rows: list[tuple[np.ndarray, np.ndarray, int]], languages: int) -> np.ndarray:
    """Follow-the-regularised-leader over (features, weights, language), row by row, EPOCHS times."""
    z, n = np.zeros((FEATURES, languages)), np.zeros((FEATURES, languages))

    def weights(z, n):
        return np.where(np.abs(z) <= L1, 0.0, (np.sign(z) * L1 - z) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    for _ in range(EPOCHS):
        for at, x, language in rows:
            now = weights(z[at], n[at])
            error = _softmax(x @ now)
            error[language] -= 1
            g = x[:, None] * error
            more = n[at] + g * g
            z[at] += g - (np.sqrt(more) - np.sqrt(n[at])) / ALPHA * now
            n[at] = more
    return weights(z, n)


def fit_temperature(logits: np.ndarray, truth: np.ndarray) -> float:
    """The temperature with the smallest log loss, by golden-section search over its logarithm."""
    if not len(truth):
        return 1.0

    def loss(t: float) -> float:
        return float(-np.log(_softmax(logits / math.exp(t))[np.arange(len(truth)), truth] + 1e-300).mean())

    low, high, ratio = math.log(0.02), math.log(50), (math.sqrt(5) - 1) / 2
    for _ in range(50):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return math.exp((low + high) / 2)


def remainder(doc_id: str | Column) -> Column:
    """crc32(doc_id as text) mod 3; a null id is the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % 3


def _document_frequencies(rows: DataFrame) -> tuple[np.ndarray, int]:
    """Of each feature, and the number of documents: a partial table per task, summed by feature."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, n = np.zeros(FEATURES, dtype=np.int64), 0
        for batch in small_batches(batches):
            for text in texts(batch):
                seen += counts(text) > 0
                n += 1
        at = np.flatnonzero(seen)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.r_[at, -1]), pa.array(np.r_[seen[at], n])], ["feature", "n"])

    out, n = np.zeros(FEATURES, dtype=np.int64), 0
    for feature, found in rows.select("text").mapInArrow(count, "feature long, n long").groupBy("feature").agg(F.sum("n")).collect():
        if feature < 0:
            n = found
        else:
            out[feature] = found
    return out, n


def _sample(rows: DataFrame, idf: np.ndarray, sizes: dict[str, int], sample_rows: int) -> list[tuple]:
    """(hash, language, features, weights) of at most `sample_rows` documents, the languages as even as they can be."""
    each = max(1, sample_rows // max(1, len(sizes)))
    share = F.create_map(*(F.lit(v) for lang, n in sizes.items() for v in (lang, min(1.0, 0.9 * each / n))))
    draw = F.pmod(F.xxhash64("doc_id", "text", F.lit(3)), F.lit(1_000_003)) / 1_000_003
    shared = rows.sparkSession.sparkContext.broadcast(idf)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            at, weight = zip(*(vector(counts(text), shared.value) for text in texts(batch)), strict=True)
            arrays = [pa.array([a.astype("<i4").tobytes() for a in at], pa.binary()), pa.array([w.astype("<f4").tobytes() for w in weight], pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column("draw"), batch.column("lang"), *arrays], ["draw", "lang", "at", "weight"])

    drawn = rows.withColumn("draw", draw).where(F.col("draw") < share[F.col("lang")]).limit(sample_rows)
    drawn = drawn.select("draw", "lang", "text").mapInArrow(features, "draw double, lang string, at binary, weight binary")
    found = sorted((r.draw, r.lang, bytes(r.at), bytes(r.weight)) for r in drawn.collect())
    return [(draw, lang, np.frombuffer(at, "<i4").astype(np.int64), np.frombuffer(weight, "<f4").astype(np.float64)) for draw, lang, at, weight in found]


def train(docs: DataFrame, sample_rows: int = SAMPLE_ROWS, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> Model:
    """Fit a model on the documents that have a language and whose crc32(doc_id) mod 3 is not 1."""
    rows = docs.where((remainder(doc_id) != 1) & F.col(lang).isNotNull()).select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"), F.col(lang).cast("string").alias("lang"))
    sizes = {r.lang: r["count"] for r in rows.groupBy("lang").count().orderBy("lang").collect()}
    frequency, n = _document_frequencies(rows)
    idf = np.log((1 + n) / (1 + frequency)) + 1
    languages = sorted(sizes)
    sample = _sample(rows, idf, sizes, sample_rows) if languages else []
    labelled = [(at, weight, languages.index(language)) for _, language, at, weight in sample]
    held = labelled[::HELD_BACK] if len(labelled) >= 10 * HELD_BACK else []
    fitted = [row for k, row in enumerate(labelled) if not held or k % HELD_BACK]
    weights = fit_weights(fitted, len(languages))
    logits = np.array([x @ weights[at] for at, x, _ in held]).reshape(len(held), len(languages))
    return Model(languages, idf, weights, fit_temperature(logits, np.array([c for *_, c in held], dtype=int)))


def predict(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, held_out (not used for training), lang_pred, score (probability of that language).

    Only the whole text is looked at. Null, empty and letterless texts give `und` with score 0, and so does every text
    where there was nothing to train on. Null and repeated ids and repeated rows give a row each; a null id is in no
    held-out set. Other columns are ignored. An empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            languages, scores = zip(*map(shared.value.predict, texts(batch)), strict=True)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(languages, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"), (remainder(doc_id) == 1).alias("held_out"))
    return rows.mapInArrow(apply, "doc_id long, held_out boolean, lang_pred string, score double")


def in_known_language(docs: DataFrame, model: Model, least_score: float = LEAST_SCORE) -> DataFrame:
    """The documents, with all their columns, without those of undetermined or improbable language; no shuffle.

    Null, empty and letterless texts go. Everything goes where there was nothing to train on.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            found = map(shared.value.predict, texts(batch))
            yield batch.filter(pa.array([lang != UNDETERMINED and score >= least_score for lang, score in found], pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
