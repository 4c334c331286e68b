"""Language-model scores: a log-bilinear model trained by noise-contrastive estimation in numpy.

The model predicts one of ``CLASSES`` outputs from the words before: a frequent
word, or a class of rare words by their endings. A rare word's probability in its
class is from corpus counts, discounted for words never seen; so token
probabilities are normalised over all words and one unseen word a class.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import NO_ID, block_bytes, known_ids, make_blocks
from .common import stored
from .text import mixed, words_and_endings

#: Classes of rare words, frequent words, context length, dimensions of the model.
ENDINGS = 128
HEADS = 384
CLASSES = ENDINGS + HEADS
CONTEXT = 5
DIMENSIONS = 16
#: Noise samples a batch, tokens a batch in training and in scoring.
NOISE = 64
BATCH = 1024
SCORED = 256
#: Tokens from which the driver makes the model that every task then goes on training.
START_TOKENS = 400_000
#: The end of a text as a token; its low bits are a class of rare words like any word's.
_END = np.uint64(0x5EED << 40)
_LOW = np.uint64(255)


def tokens(raw: bytes, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of a block's texts, each text's end included, and how many each text has.

    A hash's low 8 bits are the class of the word's ending.
    """
    hashes, per_text, ending = words_and_endings([raw[a:b] for a, b in zip(start, stop)])
    hashes = (hashes & ~_LOW) | (mixed(ending) % np.uint64(ENDINGS))
    counts = per_text + 1
    out = np.full(counts.sum(), _END, np.uint64)
    ends = np.cumsum(counts) - 1
    inner = np.ones(len(out), bool)
    inner[ends] = False
    out[inner] = hashes
    return out, counts


def folds(ids: np.ndarray, n: int = 5) -> np.ndarray:
    return np.fromiter((zlib.crc32(b"" if i == NO_ID else str(i).encode()) % n for i in ids.tolist()), np.int64, len(ids))


def _bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


# ---- counts ------------------------------------------------------------------------------------

COUNTED = "block_id long, bucket int, counts binary, hash long, count long, class int, seen long, types long, once long, twice long"


def count_tokens(blocks: DataFrame, held_out: int, buckets: int) -> DataFrame:
    """Training counts of every block's distinct tokens, and totals.

    A block sends each distinct token once with its count in training texts;
    tokens are added up in buckets of hash values, and each block gets its
    tokens' totals back. Besides, each bucket gives its most frequent tokens
    (hash, count) and, for each class, tokens seen, types, and types seen once and twice.
    """

    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import zstandard

        squeeze = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            for block, docs, data in zip(batch["block_id"], batch["docs"], batch["data"]):
                raw, start, stop, ids = block_bytes(docs, data)
                token, per_text = tokens(raw, start, stop)
                trains = np.repeat(folds(ids) != held_out, per_text)
                order = np.argsort(token, kind="stable")
                token, trains = token[order], trains[order]
                first = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
                unique, count = token[first], np.add.reduceat(trains.astype(np.int64), first)
                bucket = _bucket(unique, buckets)
                edge = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]]))
                yield pd.DataFrame([
                    (int(bucket[a]), block, unique[a:b].tobytes(), squeeze(count[a:b].astype("<u4").tobytes()))
                    for a, b in zip(edge[:-1], edge[1:])
                ], columns=["bucket", "block_id", "hashes", "counts"])

    def add(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        import zstandard

        squeeze, expand = zstandard.ZstdCompressor(level=1).compress, zstandard.ZstdDecompressor().decompress
        hashes = [np.frombuffer(h, "<u8") for h in group["hashes"]]
        counts = np.concatenate([np.frombuffer(expand(c), "<u4") for c in group["counts"]]).astype(np.int64)
        unique, place = np.unique(np.concatenate(hashes), return_inverse=True)
        total = np.zeros(len(unique), np.int64)
        np.add.at(total, place, counts)
        edge = np.cumsum([0] + [len(h) for h in hashes])
        back = [squeeze(total[place[a:b]].astype("<i8").tobytes()) for a, b in zip(edge[:-1], edge[1:])]
        rows = pd.DataFrame({"block_id": group["block_id"].to_numpy(), "bucket": key[0], "counts": back})
        head = np.argsort(-total, kind="stable")[:HEADS]
        head = head[total[head] > 0]
        heads = pd.DataFrame({"hash": unique[head].view(np.int64), "count": total[head]})
        kind = (unique & _LOW).astype(np.int64)
        sums = pd.DataFrame({"class": np.arange(ENDINGS)})
        for name, value in (("seen", total), ("types", total > 0), ("once", total == 1), ("twice", total == 2)):
            sums[name] = np.bincount(kind, value, ENDINGS).astype(np.int64)
        whole = ["block_id", "bucket", "hash", "count", "class", "seen", "types", "once", "twice"]
        # Nullable integers throughout: hashes would not survive as floats.
        parts = [t.astype({c: "Int64" for c in whole if c in t}) for t in (rows, heads, sums)]
        return pd.concat(parts, ignore_index=True)[["block_id", "bucket", "counts", *whole[2:]]]

    sent = blocks.select("block_id", "docs", "data").mapInPandas(send, "bucket int, block_id long, hashes binary, counts binary")
    return stored(sent.groupBy("bucket").applyInPandas(add, COUNTED), "lm-counts")


@dataclass
class Vocabulary:
    """Frequent tokens (sorted hashes and their outputs) and, of each class, what is not frequent."""

    heads: np.ndarray
    head_class: np.ndarray
    seen: np.ndarray
    types: np.ndarray
    discount: np.ndarray
    unigram: np.ndarray
    tokens: int
    distinct: int

    def __post_init__(self):
        # A head by its hash's top 16 bits; the few that share them with another are looked for one by one.
        self.by_top = np.zeros(1 << 16, np.int16)
        top = (self.heads >> np.uint64(48)).astype(np.int64)
        self.by_top[top] = np.arange(len(top))
        self.others = np.flatnonzero(self.by_top[top] != np.arange(len(top)))

    def classes(self, hashes: np.ndarray) -> np.ndarray:
        """The model's output for each token hash, as 16-bit integers."""
        rare = (hashes & _LOW).astype(np.int16)
        if not len(self.heads):
            return rare
        at = self.by_top[(hashes >> np.uint64(48)).astype(np.int64)]
        out = np.where(self.heads[at] == hashes, self.head_class[at], rare)
        for i in self.others:
            out[hashes == self.heads[i]] = self.head_class[i]
        return out

    def in_class(self, classes: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Log of each token's probability given its class."""
        rare = classes < ENDINGS
        kind = np.where(rare, classes, 0).astype(np.int64)
        total = np.maximum(self.seen[kind], 1)
        unseen = np.where(self.seen[kind] > 0, self.discount[kind] * self.types[kind] / total, 1.0)
        p = np.where(counts > 0, (counts - self.discount[kind]) / total, unseen)
        return np.where(rare, np.log(np.maximum(p, 1e-300)), 0.0)


def vocabulary(counted: DataFrame) -> Vocabulary:
    """The ``HEADS`` most frequent tokens (ties by hash) and the sums of each class without them."""
    heads = counted.where(F.col("hash").isNotNull()).orderBy(F.desc("count"), "hash").limit(HEADS).select("hash", "count").toPandas()
    sums = counted.where(F.col("class").isNotNull()).groupBy("class").agg(
        *[F.sum(c).alias(c) for c in ("seen", "types", "once", "twice")]).toPandas()
    table = {c: np.zeros(ENDINGS, np.int64) for c in ("seen", "types", "once", "twice")}
    for c, out in table.items():
        out[sums["class"].to_numpy(np.int64)] = sums[c].to_numpy(np.int64)
    whole, distinct = int(table["seen"].sum()), int(table["types"].sum())
    hashes, count = heads["hash"].to_numpy(np.int64).view(np.uint64), heads["count"].to_numpy(np.int64)
    kind = (hashes & _LOW).astype(np.int64)
    for c, value in (("seen", count), ("types", np.ones_like(count)), ("once", count == 1), ("twice", count == 2)):
        np.subtract.at(table[c], kind, value)
    once, twice = table["once"], table["twice"]
    discount = np.clip(once / np.maximum(once + 2 * twice, 1), 0.05, 0.95)
    unigram = np.full(CLASSES, 0.5)
    unigram[:ENDINGS] += table["seen"]
    order = np.argsort(hashes)
    head_class = (ENDINGS + np.arange(len(hashes))).astype(np.int16)
    unigram[head_class] += count
    return Vocabulary(hashes[order], head_class[order], table["seen"], table["types"], discount, unigram / unigram.sum(), whole, distinct)


# ---- model ---------------------------------------------------------------------------------------


class LogBilinear:
    """q = sum over j of position[j] * before[word j back]; score of w: q . after[w] + bias[w].

    ``before`` has one more row, for places before a text's start. All parameters
    are views of one flat array, which is what is averaged.
    """

    def __init__(self, flat: np.ndarray):
        self.flat = flat
        shapes = ((CONTEXT, DIMENSIONS), (CLASSES + 1, DIMENSIONS), (CLASSES, DIMENSIONS), (CLASSES,))
        views, at = [], 0
        for shape in shapes:
            views.append(flat[at : at + math.prod(shape)].reshape(shape))
            at += math.prod(shape)
        self.position, self.before, self.after, self.bias = views

    @staticmethod
    def size() -> int:
        return (CONTEXT + 2 * CLASSES + 1) * DIMENSIONS + CLASSES

    @classmethod
    def start(cls, unigram: np.ndarray) -> LogBilinear:
        model = cls(np.random.default_rng(10).normal(0, 0.1, cls.size()).astype(np.float32))
        model.position[:] = 1 / np.arange(1, CONTEXT + 1)[:, None]
        model.bias[:] = np.log(unigram)
        return model

    def query(self, contexts: np.ndarray) -> np.ndarray:
        return (self.before[contexts] * self.position).sum(1)

    def log_probabilities(self, contexts: np.ndarray, words: np.ndarray) -> np.ndarray:
        """Normalised log probability of each word given its context, in batches.

        Scores with biases are one matrix product. Unless they could overflow,
        their exponentials are summed as they are.
        """
        out, one = np.empty(len(words)), np.ones((SCORED, 1), np.float32)
        after = np.vstack([self.after.T, self.bias])
        longest, highest, units = np.sqrt((self.after**2).sum(1).max()), self.bias.max(), np.ones(CLASSES, np.float32)
        for lo in range(0, len(words), SCORED):
            w, q = words[lo : lo + SCORED], self.query(contexts[lo : lo + SCORED])
            scores = np.hstack([q, one[: len(w)]]) @ after
            own = scores[np.arange(len(w)), w].astype(float)
            top = 0.0
            if np.sqrt((q * q).sum(1).max()) * longest + highest > 80:
                top = scores.max(1, keepdims=True)
                scores -= top
                top = top[:, 0]
            np.exp(scores, out=scores)
            out[lo : lo + SCORED] = own - top - np.log(scores @ units)
        return out


def contexts(classes: np.ndarray, per_text: np.ndarray) -> np.ndarray:
    """Classes of the CONTEXT tokens before each token, nearest first; CLASSES before the text."""
    place = np.arange(len(classes)) - np.repeat(np.cumsum(per_text) - per_text, per_text)
    out = np.full((len(classes), CONTEXT), CLASSES, np.int16)
    for j in range(1, CONTEXT + 1):
        out[j:, j - 1] = np.where(place[j:] >= j, classes[:-j], CLASSES)
    return out


def _add_rows(out: np.ndarray, at: np.ndarray, values: np.ndarray) -> None:
    """Add each row of values to the row of ``out`` that it is for."""
    order = np.argsort(at.astype(np.int16), kind="stable")
    place = at[order]
    first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    out[place[first]] += np.add.reduceat(values[order], first, axis=0)


def train(model: LogBilinear, ctx: np.ndarray, words: np.ndarray, unigram: np.ndarray, history: np.ndarray, rate: float, seed: int) -> None:
    """One pass of noise-contrastive estimation over tokens, in place, by Adagrad steps.

    A batch takes tokens from all over the text. It draws NOISE words from the
    unigram distribution, shared by its tokens; the model learns to tell each
    token from them.
    """
    rng = np.random.default_rng(seed)
    cumulative, steps = np.cumsum(unigram), -(-len(words) // BATCH)
    expected = np.log(NOISE * unigram).astype(np.float32)
    gradient = LogBilinear(np.zeros(LogBilinear.size(), np.float32))
    for step in rng.permutation(steps):
        c, w = ctx[step::steps].astype(np.int64), words[step::steps].astype(np.int64)
        noise = np.minimum(np.searchsorted(cumulative, rng.random(NOISE)), CLASSES - 1)
        before, after = model.before[c], model.after[w]
        q = (before * model.position).sum(1)
        own = (q * after).sum(1) + model.bias[w] - expected[w]
        others = q @ model.after[noise].T + (model.bias[noise] - expected[noise])
        up = 1 / (1 + np.exp(np.clip(own, -30, 30)))
        down = -1 / (1 + np.exp(-np.clip(others, -30, 30)))
        dq = up[:, None] * after + down @ model.after[noise]
        gradient.flat[:] = 0
        _add_rows(gradient.after, np.concatenate([w, noise]), np.concatenate([up[:, None] * q, down.T @ q]))
        gradient.bias += np.bincount(w, up, CLASSES) + np.bincount(noise, down.sum(0), CLASSES)
        _add_rows(gradient.before, c.ravel(), (dq[:, None, :] * model.position).reshape(-1, DIMENSIONS))
        gradient.position[:] = (before * dq[:, None, :]).sum(0)
        gradient.flat /= len(w)
        history += gradient.flat**2
        model.flat += rate * gradient.flat / (np.sqrt(history) + 1e-6)


def _training(blocks: pd.DataFrame, vocab: Vocabulary, held_out: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Contexts and classes of each block's training tokens."""
    for docs, data in zip(blocks["docs"], blocks["data"]):
        raw, start, stop, ids = block_bytes(docs, data)
        keep = folds(ids) != held_out
        if keep.any():
            token, per_text = tokens(raw, start[keep], stop[keep])
            classes = vocab.classes(token)
            yield contexts(classes, per_text), classes


def fit(blocks: DataFrame, vocab: Vocabulary, held_out: int, rate: float = 0.1) -> LogBilinear:
    """Train on every training token.

    The driver trains a first model on START_TOKENS tokens of a few blocks. From
    it each task trains on all of its blocks, and the tasks' parameters are
    averaged by their numbers of tokens; the sums are added up by Spark.
    """
    unigram, size = vocab.unigram, LogBilinear.size()

    def some(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for ctx, words in _training(batch, vocab, held_out):
                yield pd.DataFrame({"ctx": [ctx.tobytes()], "words": [words.tobytes()]})

    per_block = 1 + vocab.tokens // max(1, blocks.count())
    first = blocks.orderBy(F.xxhash64("block_id")).limit(1 + START_TOKENS // per_block)
    model, history = LogBilinear.start(unigram), np.full(size, 1e-4, np.float32)
    got = first.select("docs", "data").mapInPandas(some, "ctx binary, words binary").toPandas()
    if not len(got):
        return model
    ctx = np.frombuffer(b"".join(got["ctx"]), np.int16).reshape(-1, CONTEXT)
    words = np.frombuffer(b"".join(got["words"]), np.int16)
    for epoch in range(2):
        train(model, ctx, words, unigram, history, rate, epoch)
    begin = model.flat.copy()

    def go_on(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, past, seen = LogBilinear(begin.copy()), history.copy(), 0
        for batch in batches:
            for ctx, words in _training(batch, vocab, held_out):
                train(own, ctx, words, unigram, past, rate, len(words))
                seen += len(words)
        if seen:
            yield pd.DataFrame({"place": np.arange(size), "total": own.flat.astype(float) * seen, "weight": float(seen)})

    sums = blocks.select("docs", "data").mapInPandas(go_on, "place int, total double, weight double")
    mean = sums.groupBy("place").agg((F.sum("total") / F.sum("weight")).alias("value")).toPandas()
    flat = begin.copy()
    flat[mean["place"].to_numpy()] = mean["value"].to_numpy()
    return LogBilinear(flat)


SCORES = "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def score_documents(docs: DataFrame, held_out: int = 1) -> DataFrame:
    """Log10 probability of every whole text under the model and under smoothed token counts.

    ``docs`` needs doc_id and text; other columns are ignored. Learns from
    documents whose fold (crc32 of the id modulo 5) is not ``held_out``. Tokens
    are words (A-Z lower-cased) and one end a text. Returns doc_id, n_tokens, n_known
    (tokens seen in training), train_tokens, base_score (sum of log10((c + 0.5) /
    (N + 0.5 (V + 1)))), score.

    NULL text is the empty text, whose one token is its end. Repeated rows
    count as often as they are there and score alike; a NULL id has fold 0. An empty
    table gives an empty result; without training text all tokens are unseen.

    Scale: texts are compressed in blocks, each distinct token of a block is
    sent once, and counts go back the same way: the corpus's counts are never
    in one place. The driver holds the frequent words and the model (70 kB).
    """
    blocks = make_blocks(docs, "lm-blocks")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(parts, (blocks.agg(F.sum("n_bytes")).first()[0] or 0) >> 25)
    counted = count_tokens(blocks, held_out, buckets)
    vocab = vocabulary(counted)
    model = fit(blocks, vocab, held_out).flat

    def score(key: tuple, block: pd.DataFrame, counted: pd.DataFrame) -> pd.DataFrame:
        import zstandard

        expand = zstandard.ZstdDecompressor().decompress
        lm, out = LogBilinear(model.copy()), []
        for docs, data in zip(block["docs"], block["data"]):
            raw, start, stop, ids = block_bytes(docs, data)
            token, per_text = tokens(raw, start, stop)
            unique, place = np.unique(token, return_inverse=True)
            counts = np.concatenate([np.frombuffer(expand(c), "<i8") for c in counted.sort_values("bucket")["counts"]])[place]
            classes = vocab.classes(token)
            logs = lm.log_probabilities(contexts(classes, per_text), classes) + vocab.in_class(classes, counts)
            base = np.log10((counts + 0.5) / (vocab.tokens + 0.5 * (vocab.distinct + 1)))
            first = np.cumsum(per_text) - per_text
            out.append(pd.DataFrame({
                "doc_id": pd.array(known_ids(docs), "Int64"), "n_tokens": per_text,
                "n_known": np.add.reduceat((counts > 0).astype(np.int64), first), "train_tokens": vocab.tokens,
                "base_score": np.add.reduceat(base, first), "score": np.add.reduceat(logs, first) / math.log(10),
            }))
        return pd.concat(out) if out else pd.DataFrame(columns=["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    counts = counted.where(F.col("block_id").isNotNull()).select("block_id", "bucket", "counts")
    return blocks.groupBy("block_id").cogroup(counts.groupBy("block_id")).applyInPandas(score, SCORES)
