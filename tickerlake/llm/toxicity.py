"""Toxicity by a weighted lexicon, matched in folded text by an Aho-Corasick automaton."""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold, mapped_texts, small

#: Look-alikes of Latin letters, folded after lower-casing: Cyrillic, Greek, others.
HOMOGLYPHS = {
    "а": "a", "в": "b", "е": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t",
    "у": "y", "х": "x", "ѕ": "s", "і": "i", "ј": "j", "ԁ": "d", "ԛ": "q", "ԝ": "w", "ӏ": "l", "ɡ": "g",
    "α": "a", "β": "b", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u",
    "χ": "x", "ı": "i", "ɑ": "a", "ⅼ": "l", "ո": "n", "ս": "u", "օ": "o",
}
#: Digits and signs that stand for letters beside a letter.
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s"}
#: Phrases in which a lexicon word is no insult.
EXCEPTIONS = (
    "trash can", "trash bag", "trash bin", "trash collection", "clown fish", "circus clown",
    "idiot proof", "idiot light", "pathetic fallacy",
)

_HOMOGLYPH_TABLE = str.maketrans(HOMOGLYPHS)
_INVISIBLE = {ord(c): None for c in "­​‌‍⁠﻿"}
_SUBSTITUTE = re.compile(r"(?<=[^\W\d_])[0134578@$]+(?=[^\W\d_])|(?<![\w@$])[0134578@$](?=[^\W\d_])")
_WORD = re.compile(r"[^\W_]+")
#: Signs that stand for letters in a word that so becomes a term; those of l and i are one class, as 'i'.
_SIGNS = str.maketrans({**SUBSTITUTES, "l": "i", "|": "i", "!": "i"})
_SIGN = re.compile(r"[0134578@$|!]")
_MIXED = re.compile(r"(?<![\w@$|!])(?=[\w@$|!]*[0134578@$|!])(?=[\w@$|!]*[^\W\d_])[\w@$|!]+")


def folded(text: str) -> str:
    """Lower case, compatibility forms and look-alikes as Latin letters, digits inside words as letters."""
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text).translate(_INVISIBLE).lower().translate(_HOMOGLYPH_TABLE)
    else:
        text = text.lower()
    return _SUBSTITUTE.sub(lambda m: "".join(SUBSTITUTES[c] for c in m[0]), text)


def skeleton(text: str) -> str:
    """A folded text with l and i as one class, as long as it was."""
    return text.replace("l", "i")


def _signed(text: str) -> Iterator[tuple[int, int]]:
    """Where a text's runs between spaces lie that have signs."""
    done = 0
    while sign := _SIGN.search(text, done):
        lo, hi = max(done, text.rfind(" ", done, sign.start()) + 1), text.find(" ", sign.end())
        done = hi if hi >= 0 else len(text)
        yield lo, done


def _readings(text: str) -> set[str]:
    """Distinct words of a folded text; those with signs also with all signs as letters."""
    signed = (m for lo, hi in _signed(text) for m in _MIXED.findall(text[lo:hi]))
    return {*_WORD.findall(text), *(w for m in signed for w in _WORD.findall(m.translate(_SIGNS)))}


@dataclass
class Lexicon:
    """Term weights, exception phrases, and the calibration of the length-normalised sum."""

    weights: dict[str, float]
    exceptions: tuple[str, ...]
    coefficients: tuple[float, ...] = (-3.0, 1.0, 1.0)

    def automaton(self):
        import ahocorasick

        machine = ahocorasick.Automaton()
        spared = {skeleton(phrase) for phrase in self.exceptions}
        for phrase in self.exceptions:
            machine.add_word(skeleton(phrase), (phrase, 0.0))
        # Of terms that differ in l and i only, the one of largest weight.
        for term, weight in sorted(self.weights.items(), key=lambda t: (t[1], t[0])):
            if skeleton(term) not in spared:
                machine.add_word(skeleton(term), (term, weight))
        if len(machine):
            machine.make_automaton()
        return machine


def matches(machine, text: str) -> list[tuple[str, float]]:
    """Whole-word lexicon terms of a folded text that lie in no exception phrase.

    l and i are one class. A word with a letter whose signs, wherever they are,
    make it a word of the lexicon as letters counts as that word.
    """
    if not len(machine):
        return []

    def reading(m: re.Match) -> str:
        # Signs at the ends may be none of the word: scum!! is scum. The longest reading counts.
        word, longest = m[0], machine.get_stats()["longest_word"]
        whole, lead, tail = word.translate(_SIGNS), len(word) - len(word.lstrip("@$|!")), len(word.rstrip("@$|!"))
        for size in range(min(len(word), longest), tail - lead - 1, -1):
            for start in range(max(0, tail - size), min(lead, len(word) - size) + 1):
                if whole[start : start + size] in machine:
                    return word[:start] + whole[start : start + size] + word[start + size :]
        return word

    parts, done, found, spared = [], 0, [], []
    for lo, hi in _signed(text):
        parts += [text[done:lo], _MIXED.sub(reading, text[lo:hi])]
        done = hi
    text = skeleton("".join([*parts, text[done:]]))
    for last, (term, weight) in machine.iter(text):
        lo, hi = last - len(term) + 1, last + 1
        if (lo and text[lo - 1].isalnum()) or (hi < len(text) and text[hi].isalnum()):
            continue
        (found if weight > 0 else spared).append((lo, hi, term, weight))
    return [(t, w) for lo, hi, t, w in found if not any(a <= lo and hi <= b for a, b, _, _ in spared)]


def _features(weight: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Per text: 1, the sum of matched weights on a log scale, and that sum per 100 words."""
    return np.stack([np.ones(len(weight)), np.log1p(weight), np.log1p(100.0 * weight / (words + 20.0))], 1)


def _sums(lexicon: Lexicon, texts: Sequence[str | None], machine) -> tuple[np.ndarray, np.ndarray, list[list[str]]]:
    weight, words, terms = [], [], []
    for text in texts:
        clean = folded(text) if isinstance(text, str) else ""
        hits = matches(machine, clean)
        # A term's repeats add less and less.
        weight.append(sum(w * (1 + math.log(n)) for (_, w), n in Counter(hits).items()))
        words.append(clean.count(" ") + clean.count("\n") + 1)
        terms.append(sorted({t for t, _ in hits}))
    return np.asarray(weight, float), np.asarray(words, float), terms


def _logistic(x: np.ndarray, y: np.ndarray, share: np.ndarray, ridge: float = 1.0, steps: int = 30) -> np.ndarray:
    """Ridge logistic regression of rows weighted by their share, by Newton's method."""
    beta, penalty = np.zeros(x.shape[1]), np.diag([1e-6] + [ridge] * (x.shape[1] - 1))
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve((x * (share * (p * (1 - p) + 1e-9))[:, None]).T @ x + penalty, x.T @ (share * (y - p)) - penalty @ beta)
        beta += step
        if np.abs(step).max() < 1e-6:
            break
    return beta


def learn_lexicon(
    docs: DataFrame,
    labels: DataFrame,
    sample_rows: int = 20_000,
    min_share: float = 0.01,
    min_docs: int = 4,
    min_weight: float = 2.0,
    max_terms: int = 20_000,
    seed_terms: dict[str, float] | None = None,
    exceptions: Sequence[str] = EXCEPTIONS,
) -> Lexicon:
    """Weights and calibration from labelled documents.

    ``labels`` has doc_id and toxic (0 or 1); its rows outside the training
    folds must be gone. Words are counted over all labelled documents. The
    calibration is learned from about ``sample_rows`` of them at most, picked in each
    class by a hash of their id and weighted by what was left out. A folded word's weight is its log
    odds ratio between toxic and other documents; words that differ in l and i
    only count as one, named by its most frequent form. Words of too few toxic
    documents, or below ``min_weight``, are no terms. ``seed_terms`` add terms
    with given weights. Without both labels the calibration stays as given.
    """
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    of_class = {r["bad"]: r["count"] for r in known.groupBy((F.col("toxic") == 1).alias("bad")).count().collect()}
    toxic, other = of_class.get(True, 0), of_class.get(False, 0)
    half = sample_rows // 2
    rates = min(1.0, max(half, sample_rows - other) / max(toxic, 1)), min(1.0, max(half, sample_rows - toxic) / max(other, 1))
    labelled = docs.select("doc_id", "text").join(
        small(known.withColumnRenamed("doc_id", "_id"), toxic + other), F.col("doc_id") == F.col("_id")).select("doc_id", "text", "toxic")
    rate = F.when(F.col("toxic") == 1, rates[0]).otherwise(rates[1])
    sample = labelled.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < rate * (1 << 20)).select("text", "toxic")

    def words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            bad, good = Counter(), Counter()
            for text, toxic in zip(batch["text"], batch["toxic"]):
                forms = {"": ""}
                for word in sorted(_readings(folded(text))) if isinstance(text, str) else []:
                    forms[skeleton(word)] = word
                (bad if toxic == 1 else good).update(forms.items())
            every = list(bad | good)
            yield pd.DataFrame({"class": [c for c, _ in every], "word": [w for _, w in every],
                                "bad": [bad[e] for e in every], "good": [good[e] for e in every]})

    # Documents of a class of words: each has one form of it.
    forms = labelled.select("text", "toxic").mapInPandas(words, "class string, word string, bad long, good long").groupBy("class", "word").agg(
        F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    counts = forms.groupBy("class").agg(
        F.max(F.struct(F.col("bad") + F.col("good"), "word")).getField("word").alias("word"), F.sum("bad").alias("bad"), F.sum("good").alias("good")
    ).drop("class").cache()
    whole = counts.where("word = ''").first()
    bad, good = (whole["bad"], whole["good"]) if whole else (0, 0)
    weight = F.log((F.col("bad") + 0.5) * (good + 1.0) / ((F.col("good") + 0.5) * (bad + 1.0)))
    least = max(min_docs, math.ceil(min_share * bad))
    terms = counts.where((F.length("word") >= 2) & (F.col("bad") >= least)).withColumn("weight", weight).where(F.col("weight") >= min_weight)
    learned = {r["word"]: r["weight"] for r in terms.orderBy(F.desc("weight"), "word").limit(max_terms).collect()} if bad and good else {}
    counts.unpersist()
    lexicon = Lexicon({**learned, **{folded(t): w for t, w in (seed_terms or {}).items()}}, tuple(folded(e) for e in exceptions))
    if not (bad and good):
        return lexicon

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        machine = lexicon.automaton()
        for batch in batches:
            w, n, _ = _sums(lexicon, batch["text"].tolist(), machine)
            yield pd.DataFrame({"w": w, "n": n, "toxic": batch["toxic"].to_numpy()})

    rows = sample.mapInPandas(sums, "w double, n double, toxic int").toPandas()
    is_toxic = (rows["toxic"] == 1).to_numpy()
    share = np.where(is_toxic, 1 / rates[0], 1 / rates[1])
    beta = _logistic(_features(rows["w"].to_numpy(), rows["n"].to_numpy()), is_toxic.astype(float), share)
    lexicon.coefficients = tuple(float(b) for b in beta)
    return lexicon


def score_toxicity(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """doc_id, score (0 to 1), predicted, matched weight and terms of every whole text.

    Matches count as whole words of the folded text, outside exception phrases;
    the weights' sum is normalised by length. NULL and empty texts have no
    match and get the score of none. Repeated rows are scored alike, other
    columns of ``docs`` are ignored, an empty table gives an empty result.
    """
    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        machine, beta = lexicon.automaton(), np.asarray(lexicon.coefficients)
        for batch in batches:
            w, n, terms = _sums(lexicon, batch["text"].tolist(), machine)
            p = 1 / (1 + np.exp(-np.clip(_features(w, n) @ beta, -30, 30)))
            yield pd.DataFrame({"doc_id": batch["doc_id"], "score": p, "predicted": (p >= 0.5).astype("int32"), "weight": w, "terms": terms})

    return mapped_texts(docs, score, "score double, predicted int, weight double, terms array<string>")


def train_rows(labels: DataFrame) -> DataFrame:
    return labels.where(fold(F.col("doc_id")) != 0)
