"""Quality by importance resampling: hashed n-gram models of target and raw text, Gumbel top-k."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import mapped_texts, small, stored
from .text import as_bytes, chunks, mixed, word_hashes

#: Bytes of text hashed at a time.
CHUNK = 1 << 19
#: Ranges of the sampling key that are counted before any row is ranked.
KEY_BINS = 4096


def features(texts: list[bytes], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashed words and pairs of neighbouring words, and which text each is of."""
    words, per_text = word_hashes(texts)
    of = np.repeat(np.arange(len(texts)), per_text)
    same = of[1:] == of[:-1]
    pairs = mixed(words[:-1] * np.uint64(3) + words[1:])[same] if len(words) else words
    shift = np.uint64(64 - bits)
    return np.concatenate([words >> shift, pairs >> shift]).astype(np.int64), np.concatenate([of, of[1:][same]])


def ngram_models(docs: DataFrame, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Log probabilities of the buckets in target text and in all text.

    ``docs`` has text and target (boolean). Counts are over all rows, added up
    in the tasks first; half a count is added to each bucket.
    """
    size = 1 << bits

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        raw, target = np.zeros(size, np.int64), np.zeros(size, np.int64)
        for batch in batches:
            texts, chosen = as_bytes(batch["text"]), batch["target"].to_numpy(bool)
            for part in chunks([len(t) for t in texts], CHUNK):
                bucket, of = features(texts[part], bits)
                raw += np.bincount(bucket, minlength=size)
                target += np.bincount(bucket[chosen[part][of]], minlength=size)
        yield pd.DataFrame({"bucket": np.arange(size), "raw": raw, "target": target})

    counts = docs.select("text", "target").mapInPandas(count, "bucket int, raw long, target long")
    table = counts.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).toPandas()
    logs = []
    for name in ("target", "raw"):
        c = np.full(size, 0.5)
        c[table["bucket"].to_numpy()] += table[name].to_numpy()
        logs.append(np.log(c / c.sum()))
    return logs[0], logs[1]


def importance(docs: DataFrame, target: np.ndarray, raw: np.ndarray, seed: str = "quality") -> DataFrame:
    """doc_id, n_features, log_weight, score, gumbel_key of every whole text.

    log_weight is the log of the text's probability under the target model over
    that under the raw one; score is 1 / (1 + exp(-that per feature)). The key adds
    standard Gumbel noise made from the id. NULL and empty texts have weight 0
    in logs and score 0.5.
    """
    ratio, bits = target - raw, int(np.log2(len(raw)))

    def weigh(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = as_bytes(batch["text"])
            total, n = np.zeros(len(texts)), np.zeros(len(texts), np.int64)
            for part in chunks([len(t) for t in texts], CHUNK):
                bucket, of = features(texts[part], bits)
                many = part.stop - part.start
                total[part], n[part] = np.bincount(of, ratio[bucket], many), np.bincount(of, minlength=many)
            score = 1 / (1 + np.exp(-np.clip(total / np.maximum(n, 1), -30, 30)))
            yield pd.DataFrame({"doc_id": batch["doc_id"], "n_features": n, "log_weight": total, "score": score})

    rows = mapped_texts(docs, weigh, "n_features long, log_weight double, score double")
    digits = F.substring(F.md5(F.concat_ws("/", F.lit(seed), F.col("doc_id").cast("string")).cast("binary")), 1, 12)
    u = (F.conv(digits, 16, 10).cast("double") + 0.5) / float(2**48)
    return rows.withColumn("gumbel_key", F.col("log_weight") - F.log(-F.log(u)))


def select_top(rows: DataFrame, k: int) -> DataFrame:
    """``rows`` with ``selected``: the k rows of largest gumbel_key, ties to smaller doc_id, then n_features.

    The keys' quantiles cut them into ranges whose counts tell which range
    the k-th row is in; only that range is ranked.
    """
    cuts = sorted(set(rows.select(
        F.percentile_approx("gumbel_key", [i / KEY_BINS for i in range(1, KEY_BINS)], 4 * KEY_BINS).alias("q")
    ).first()["q"] or []))

    bounds = np.asarray(cuts)

    @F.pandas_udf("int")
    def range_of(key: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, key.to_numpy(), "right"))

    ranged = rows.withColumn("_range", range_of("gumbel_key"))
    above, cut = 0, -1
    for r in sorted(ranged.groupBy("_range").agg(F.count("*").alias("n")).collect(), key=lambda r: -r["_range"]):
        cut = r["_range"]
        if above + r["n"] > k:
            break
        above += r["n"]
    else:
        cut = -1
    order = Window.partitionBy("_range").orderBy(F.col("gumbel_key").desc(), F.col("doc_id").asc_nulls_last(), "n_features")
    inside = ranged.where(F.col("_range") == cut).withColumn("selected", F.row_number().over(order) <= k - above)
    return ranged.where(F.col("_range") != cut).withColumn("selected", F.col("_range") > cut).unionByName(inside).drop("_range")


def resample(docs: DataFrame, targets: DataFrame, keep_share: float, bits: int = 13, seed: str = "quality") -> DataFrame:
    """Importance of every document and whether Gumbel top-k sampling selects it.

    ``docs`` needs doc_id and text, ``targets`` the doc_id of the documents to
    resemble (repeated and NULL ids count once and never). The k =
    round(keep_share * rows) documents of largest key are selected: a sample
    without replacement in proportion to the weights. Returns doc_id,
    n_features, log_weight, score, gumbel_key, selected.

    Every row counts, repeated ones too. Other columns are ignored. Without
    targets both models are taken to be equal and sampling is uniform; an
    empty table gives an empty result.
    """
    wanted = targets.select(F.col("doc_id").alias("_id")).where(F.col("_id").isNotNull()).distinct().withColumn("_is", F.lit(True))
    flags = stored(docs.select("doc_id").distinct().join(wanted, F.col("doc_id") == F.col("_id")).select("_id", "_is"), "quality-targets")
    # Ids go to the texts where they are few enough; texts are shuffled to meet them only beyond that.
    marked = docs.select("doc_id", "text").join(small(flags, flags.count()), F.col("doc_id") == F.col("_id"), "left")
    target, raw = ngram_models(marked.select("text", F.coalesce("_is", F.lit(False)).alias("target")), bits)
    if not np.ptp(target):
        target = raw
    rows = stored(importance(docs, target, raw, seed), "quality-weights")
    return select_top(rows, round(keep_share * rows.count()))
