"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mapped_texts, small_batches
from .packing import forget_tokenizers

#: What a text without letters is.
UNDETERMINED = "und"
_LETTER = re.compile(r"[^\W\d_]")


def has_letter(text: str) -> bool:
    """Whether a character is of Unicode's category L; the pattern alone also finds other numerals."""
    return any(m[0].isalpha() for m in _LETTER.finditer(text))


@dataclass(frozen=True)
class Grams:
    """Hashed counts of character n-grams of a lower-cased text, 1 to ``longest`` code points."""

    bits: int = 14
    longest: int = 3

    def counts(self, text: str) -> np.ndarray:
        codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
        out, gram = np.zeros(1 << self.bits, np.int64), np.zeros(len(codes) + 1, np.uint32)
        for n in range(1, min(self.longest, len(codes)) + 1):
            gram = (gram[: len(codes) - n + 1] * np.uint32(0x01000193)) ^ codes[n - 1 :]
            hashed = (gram * np.uint32(0x9E3779B1)) ^ ((gram * np.uint32(0x85EBCA6B)) >> np.uint32(15))
            out += np.bincount(hashed >> np.uint32(32 - self.bits), minlength=len(out))
        return out


@dataclass
class LanguageModel:
    """Languages, inverse document frequencies, weights (features x languages), bias, temperature."""

    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float
    grams: Grams

    def logits(self, counts: np.ndarray) -> np.ndarray:
        places, values = tfidf(counts, self.idf)
        return values @ self.weights[places] + self.bias


def tfidf(counts: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and values of log-scaled counts times idf, of Euclidean length 1."""
    places = np.flatnonzero(counts)
    values = np.log1p(counts[places]) * idf[places]
    norm = np.sqrt(values @ values)
    return places, values / norm if norm else values


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def ftrl(
    rows: list[tuple[np.ndarray, np.ndarray]],
    labels: np.ndarray,
    classes: int,
    features: int,
    alpha: float = 2.0,
    beta: float = 1.0,
    l1: float = 0.02,
    l2: float = 0.02,
    epochs: int = 3,
) -> tuple[np.ndarray, np.ndarray]:
    """Follow-the-regularised-leader with elastic-net penalties, a row at a time.

    A coordinate's weight is 0 while its sum z is within l1, else
    ``-(z - sign(z) l1) / ((beta + sqrt(n)) / alpha + l2)`` with n its sum of
    squared gradients. The bias is a last coordinate of value 1.
    """
    z, n = np.zeros((features + 1, classes)), np.zeros((features + 1, classes))

    def weights(at: np.ndarray | slice) -> np.ndarray:
        zi = z[at]
        return np.where(np.abs(zi) > l1, -(zi - np.sign(zi) * l1) / ((beta + np.sqrt(n[at])) / alpha + l2), 0.0)

    order = np.random.default_rng(0)
    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            at, x = np.append(rows[i][0], features), np.append(rows[i][1], 1.0)
            w = weights(at)
            p = softmax(x @ w)
            p[labels[i]] -= 1.0
            g = np.outer(x, p)
            z[at] += g - (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha * w
            n[at] += g * g
    w = weights(slice(None))
    return w[:-1], w[-1]


def best_temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature of least log loss on held-back rows."""
    grid = np.exp(np.linspace(np.log(0.05), np.log(10), 60))
    loss = [-np.log(softmax(logits / t)[np.arange(len(labels)), labels] + 1e-300).mean() for t in grid]
    return float(grid[int(np.argmin(loss))])


def fit_languages(docs: DataFrame, sample_rows: int = 5000, grams: Grams = Grams()) -> LanguageModel:
    """Fit on rows of text and lang; those that may not be learned from must be gone.

    Document frequencies count every row of ``docs`` with a text. The
    classifier learns from at most about ``sample_rows`` distinct labelled texts, as many
    of each language, however many copies a text has; a fifth of them is held back for the temperature.
    """
    small_batches(docs.sparkSession)
    features = 1 << grams.bits

    def frequencies(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        forget_tokenizers()
        seen, total = np.zeros(features, np.int64), 0
        for batch in batches:
            for text in batch["text"]:
                if isinstance(text, str):
                    seen += grams.counts(text) > 0
                    total += 1
        yield pd.DataFrame({"feature": np.append(np.arange(features), -1), "docs": np.append(seen, total)})

    table = docs.select("text").mapInPandas(frequencies, "feature int, docs long").groupBy("feature").agg(F.sum("docs").alias("docs")).toPandas()
    df = np.zeros(features + 1)
    df[table["feature"].to_numpy()] = table["docs"].to_numpy()
    idf = np.log((1 + df[-1]) / (1 + df[:-1])) + 1

    labelled = docs.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    sizes = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(sizes)
    if len(languages) < 2:
        return LanguageModel(languages, idf, np.zeros((features, len(languages))), np.zeros(len(languages)), 1.0, grams)
    each = sample_rows / len(languages)
    share = F.lit(0)
    for lang, size in sizes.items():
        share = F.when(F.col("lang") == lang, int((1 << 30) * min(1.0, each / size))).otherwise(share)
    sample = labelled.select("text", "lang").where(F.pmod(F.xxhash64("text", "lang"), F.lit(1 << 30)) < share).distinct()

    def vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [tfidf(grams.counts(t), idf) for t in batch["text"]]
            yield pd.DataFrame({
                "lang": batch["lang"],
                "places": [p.astype("<u2").tobytes() for p, _ in rows],
                "x": [v.astype("<f4").tobytes() for _, v in rows],
            })

    got = sample.mapInPandas(vectors, "lang string, places binary, x binary").toPandas()
    got = got.sort_values(["lang", "places", "x"], kind="stable").reset_index(drop=True)
    rows = [(np.frombuffer(p, "<u2").astype(np.int64), np.frombuffer(x, "<f4").astype(float)) for p, x in zip(got["places"], got["x"])]
    labels = np.searchsorted(languages, got["lang"].tolist()) if len(got) else np.zeros(0, int)
    held = np.arange(len(rows)) % 5 == 4
    w, b = ftrl([r for r, h in zip(rows, held) if not h], labels[~held], len(languages), features)
    logits = np.array([v @ w[p] + b for (p, v), h in zip(rows, held) if h]).reshape(-1, len(languages))
    temperature = best_temperature(logits, labels[held]) if len(logits) else 1.0
    return LanguageModel(languages, idf, w, b, temperature, grams)


def predictor(model: LanguageModel) -> Callable[[Sequence[str | None]], tuple[list[str], list[float]]]:
    """Languages and calibrated scores of texts, for use in a task."""
    weights = model.weights.astype(np.float32)
    languages, idf, bias, temperature, grams = model.languages, model.idf, model.bias, model.temperature, model.grams

    def predict(texts: Sequence[str | None]) -> tuple[list[str], list[float]]:
        lang, score = [], []
        for text in texts:
            if not languages or not isinstance(text, str) or not has_letter(text):
                lang.append(UNDETERMINED)
                score.append(0.0)
                continue
            places, values = tfidf(grams.counts(text), idf)
            p = softmax((values @ weights[places] + bias) / temperature)
            best = int(np.argmax(p))
            lang.append(languages[best])
            score.append(float(p[best]))
        return lang, score

    return predict


def predict_languages(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """doc_id, lang_pred and score of every whole text.

    ``docs`` needs doc_id and text; other columns are ignored. NULL texts and
    texts without a letter are ``und`` with score 0. A model of one language
    gives that with score 1, a model of none ``und``. Repeated rows get the same
    prediction; an empty table gives an empty result.
    """
    predict = predictor(model)

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            lang, score = predict(batch["text"].tolist())
            yield pd.DataFrame({"doc_id": batch["doc_id"], "lang_pred": lang, "score": score})

    return mapped_texts(docs, rows, "lang_pred string, score double")


def keep_identified(docs: DataFrame, model: LanguageModel, least_score: float = 0.3) -> DataFrame:
    """``docs`` without the rows whose language is undetermined or scored below ``least_score``."""
    predict = predictor(model)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang, score = predict(batch.column("text").to_pylist())
            yield batch.filter(pa.array([x != UNDETERMINED and s >= least_score for x, s in zip(lang, score)], pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
