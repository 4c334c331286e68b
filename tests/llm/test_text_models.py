"""Toxicity (1), language identification (4), quality (8) and language-model scores (10)."""

import collections
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickerlake.llm import lm
from tickerlake.llm.langid import Grams, LanguageModel, fit_languages, ftrl, keep_identified, predict_languages, softmax
from tickerlake.llm.lm import score_documents
from tickerlake.llm.quality import features, importance, ngram_models, resample, select_top
from tickerlake.llm.text import mixed, word_hashes
from tickerlake.llm.toxicity import Lexicon, folded, learn_lexicon, matches, score_toxicity

from .helpers import ODD, by_id, frame, prose


def test_word_hashes_tell_words_apart():
    texts = [b"The cat\tthe  CAT\x0b", b"", b" \n ", "été".encode(), b"the"]
    hashes, counts = word_hashes(texts)
    assert counts.tolist() == [4, 0, 0, 1, 1]
    assert hashes[0] == hashes[2] == hashes[5] and hashes[1] == hashes[3] != hashes[0]
    assert len(np.unique(mixed(np.arange(1000, dtype=np.uint64)))) == 1000


# ---- toxicity -----------------------------------------------------------------------------------


def test_folding():
    assert folded("1D10T") == "idiot" and folded("ïdiot") == "ïdiot"
    assert folded("іdіоt") == "idiot"  # Cyrillic letters
    assert folded("id​iot") == "idiot" and folded("ＩＤＩＯＴ") == "idiot"
    assert folded("in 1990 and $5") == "in 1990 and $5"  # numbers stay numbers
    assert folded("cl0wn w0rth1ess 50 4") == "clown worthiess 50 4"


def test_matches_whole_words_outside_exceptions():
    machine = Lexicon({"trash": 2.0, "clown": 3.0}, ("trash can",)).automaton()
    assert matches(machine, "the trash can and a clown") == [("clown", 3.0)]
    assert matches(machine, "trashy clowns") == []
    assert matches(machine, "trash, clown") == [("trash", 2.0), ("clown", 3.0)]
    assert matches(Lexicon({}, ()).automaton(), "anything") == []


def test_matches_words_spelled_with_signs():
    machine = Lexicon({"clown": 3.0, "loser": 2.0, "worthless": 2.5, "idiot": 3.5, "garbage": 1.5, "scum": 2.0}, ("clown fish",)).automaton()

    def terms(text):
        return [t for t, _ in matches(machine, folded(text))]

    spelled = "c1own 1oser w0rth1ess idio7 garbag3 worthle55 10ser $cum c|own id!ot cIown 1d10t w0rth1e$$ $(um"
    assert terms(spelled) == ["clown", "loser", "worthless", "idiot", "garbage", "worthless", "loser", "scum", "clown", "idiot",
                              "clown", "idiot", "worthless"]
    assert terms("scum! loser!! scum$ $$scum, idio7!") == ["scum", "loser", "scum", "scum", "idiot"]
    assert terms("in 1990, 10 of 57 at $5, 1,000 or 3.14 and 50% c0w 2nd clowns") == []
    assert terms("a c1own fish and a clown fi5h") == []


def _toxic(spark):
    rng, rows, labels = random.Random(1), [], []
    for i in range(400):
        words, bad = prose(rng, rng.randrange(20, 120)).split(), i % 5 == 0
        if bad:
            for insult in rng.choices(["idi0t", "MORON", "scum", "lоser"], k=3):
                words.insert(rng.randrange(len(words)), insult)
        rows.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    return rows, spark.createDataFrame(labels, "doc_id long, toxic int")


def test_toxicity_on_held_out_rows(spark):
    rows, labels = _toxic(spark)
    lexicon = learn_lexicon(frame(spark, rows, extra=True), labels.where("doc_id % 3 > 0"))
    assert {"idiot", "moron", "scum", "loser"} <= set(lexicon.weights)
    got = by_id(score_toxicity(frame(spark, rows + [(1000 + i, t) for i, t in enumerate(ODD)], extra=True), lexicon))
    assert len(got) == 400 + len(ODD)
    held = [i for i in range(400) if i % 3 == 0]
    assert np.mean([got[i].predicted == (i % 5 == 0) for i in held]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())
    assert all(got[1000 + i].predicted == 0 for i in range(len(ODD)))


def test_terms_are_learned_from_all_spellings(spark):
    insults = ["loser", "loser", "1oser", "lo5er", "l0s3r"]
    rows = [(i, f"w{i % 7} {insults[i // 4 % 5] if i % 4 == 0 else 'fine'} w{i % 5}") for i in range(80)]
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(80)], "doc_id long, toxic int")
    lexicon = learn_lexicon(frame(spark, rows), labels, min_share=0.9)  # no single spelling is in 90 % of toxic documents
    assert set(lexicon.weights) == {"loser"}


def test_rare_toxic_class_is_learned_beyond_the_sample(spark):
    rows = [(i, f"w{i % 7} {'zonk' if i % 250 == 0 else 'fine'} w{i % 5}") for i in range(3000)]
    labels = spark.createDataFrame([(i, int(i % 250 == 0)) for i in range(3000)], "doc_id long, toxic int")
    lexicon = learn_lexicon(frame(spark, rows), labels, sample_rows=100)  # 12 of 3000 are toxic
    assert set(lexicon.weights) == {"zonk"}
    got = by_id(score_toxicity(frame(spark, rows), lexicon))
    assert all(got[i].score < 0.05 for i in range(3000) if i % 250) and got[0].score > 0.5


def test_toxicity_without_labels(spark):
    none = spark.createDataFrame([(1, None)], "doc_id long, toxic int")
    lexicon = learn_lexicon(frame(spark, ["a b"]), none, seed_terms={"sc0rn": 3.0})
    assert lexicon.weights == {"scorn": 3.0}
    assert score_toxicity(frame(spark, ["pure scorn"]), lexicon).first().terms == ["scorn"]
    assert score_toxicity(frame(spark, []).limit(0), lexicon).collect() == []


# ---- language --------------------------------------------------------------------------------------


def test_ftrl_is_sparse_and_separates():
    rng = np.random.default_rng(0)
    labels = rng.integers(0, 3, 300)
    rows = [(np.array([3 * k + rng.integers(0, 3), 9 + rng.integers(0, 40)]), np.array([0.8, 0.6])) for k in labels]
    w, b = ftrl(rows, labels, 3, 60)
    picked = [int(np.argmax(v @ w[p] + b)) for p, v in rows]
    assert np.mean(np.array(picked) == labels) > 0.95
    assert (w == 0).mean() > (ftrl(rows, labels, 3, 60, l1=0.0)[0] == 0).mean()
    assert softmax(np.array([1000.0, 0.0]))[0] == 1


WORDS = {
    "en": "the of and to in that was his with for had this but".split(),
    "fr": "le la les des est une dans qui pour sur au avec".split(),
    "de": "der die und das nicht von sich mit dem ist ein auch".split(),
}


def _languages(spark, n=240):
    rng = random.Random(3)
    data = []
    for i in range(n):
        lang = rng.choice(list(WORDS))
        data.append((i, " ".join(rng.choices(WORDS[lang], k=rng.randrange(4, 60))), lang, "s", 1))
    return spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long"), data


def test_languages_on_held_out_rows(spark):
    df, data = _languages(spark)
    model = fit_languages(df.where("doc_id % 4 > 0"))
    assert model.languages == ["de", "en", "fr"] and model.temperature > 0
    got = by_id(predict_languages(df.withColumn("score", F.lit("x")), model))
    assert np.mean([got[i].lang_pred == lang for i, _, lang, *_ in data if i % 4 == 0]) > 0.95
    odd = by_id(predict_languages(frame(spark, ODD + ["12 !?"]), model))
    assert all(0 <= r.score <= 1 for r in odd.values())
    letters = [bool(t) and any(c.isalpha() for c in t) for t in [*ODD, "12 !?"]]
    assert [odd[i].lang_pred != "und" for i in range(len(letters))] == letters


def test_languages_none_one_and_filter(spark):
    df, _ = _languages(spark, 20)
    none = fit_languages(df.limit(0))
    assert none.languages == [] and predict_languages(df, none).first().lang_pred == "und"
    one = fit_languages(df.where("lang = 'en'"))
    assert {(r.lang_pred, r.score) for r in predict_languages(df, one).collect()} == {("en", 1.0)}
    sure = LanguageModel(["a"], np.ones(1 << 14), np.zeros((1 << 14, 1)), np.zeros(1), 1.0, Grams())
    docs = frame(spark, ["text", None, "12"], extra=True)
    left = keep_identified(docs, sure)
    assert left.columns == docs.columns and [r.doc_id for r in left.collect()] == [0]


# ---- quality --------------------------------------------------------------------------------------


def test_resampling_prefers_texts_like_the_target(spark):
    rng = random.Random(5)
    rows = [(i, prose(rng, 60, 200) if i % 2 else " ".join(f"junk{rng.randrange(50)}$$$" for _ in range(60))) for i in range(200)]
    docs = frame(spark, rows + [(1000, None), (1000, None), (None, "w1 w2")], extra=True)
    good = spark.createDataFrame([(i,) for i in range(1, 100, 2)] + [(1,), (None,)], "doc_id long")
    got = resample(docs, good, keep_share=0.45)
    rows_out = got.collect()
    assert len(rows_out) == 203 and sum(r.selected for r in rows_out) == round(0.45 * 203)
    picked = [r.doc_id for r in rows_out if r.selected]
    assert np.mean([i is None or i == 1000 or i % 2 == 1 for i in picked]) > 0.98
    again = resample(docs.repartition(7), good, keep_share=0.45)
    assert sorted(picked, key=str) == sorted((r.doc_id for r in again.collect() if r.selected), key=str)
    assert resample(docs.limit(0), good, 0.5).collect() == []
    even = resample(docs, good.limit(0), 0.5).collect()
    assert {r.log_weight for r in even} == {0.0}


def test_log_weights_to_the_digit(spark):
    """Target ids repeated, NULL and unknown; ids of two rows, NULL ids, NULL and empty texts."""
    rows = [(1, "a b c"), (2, "b c d"), (2, "x y"), (None, "a a"), (5, None), (6, ""), (2**60 + 1, "c d e")]
    targets = frame(spark, [(i, "") for i in (2, 2, None, 99, 2**60 + 1)]).select("doc_id")
    texts = [(t or "").encode() for _, t in rows]
    bucket, of = features(texts, 8)
    wanted = np.array([i in (2, 2**60 + 1) for i, _ in rows])
    raw = np.bincount(bucket, minlength=256) + 0.5
    target = np.bincount(bucket[wanted[of]], minlength=256) + 0.5
    ratio = np.log(target / target.sum()) - np.log(raw / raw.sum())
    weight = np.bincount(of, ratio[bucket], len(rows))
    got = resample(frame(spark, rows, extra=True).repartition(3), targets, keep_share=0.5, bits=8).collect()
    assert sorted(((r.doc_id or 0, round(r.log_weight, 9)) for r in got)) == sorted(((i or 0, round(w, 9)) for (i, _), w in zip(rows, weight)))


def test_importance_equals_counting(spark):
    docs = frame(spark, ["a b a", "c", None])
    marked = docs.withColumn("target", F.col("doc_id") == 0)
    target, raw = ngram_models(marked, 10)
    assert np.exp(target).sum() == pytest.approx(1) and np.exp(raw).sum() == pytest.approx(1)
    rows = by_id(importance(docs, target, raw))
    assert rows[0].n_features == 5 and rows[0].log_weight > 0 > rows[1].log_weight and rows[2].log_weight == 0


@pytest.mark.parametrize("k", [0, 1, 57, 300])
def test_top_k_with_ties(spark, k):
    data = [(i, 1, float(i // 7), float(i // 7)) for i in range(300)]
    rows = spark.createDataFrame(data, "doc_id long, n_features long, log_weight double, gumbel_key double")
    picked = {r.doc_id for r in select_top(rows, k).collect() if r.selected}
    assert picked == set(sorted(range(300), key=lambda i: (-(i // 7), i))[:k])


# ---- language model ---------------------------------------------------------------------------------


def _corpus():
    rng = random.Random(9)
    rows = []
    for i in range(120):
        lang = rng.choice(list(WORDS))
        rows.append((i, " ".join(rng.choices(WORDS[lang], k=rng.randrange(0, 80)) + [f"rare{rng.randrange(80)}"])))
    return rows + [(500 + i, t) for i, t in enumerate(ODD)] + [(119, rows[119][1])]


def test_base_scores_and_counts(spark, monkeypatch):
    monkeypatch.setattr("tickerlake.llm.blocks.BLOCK_BYTES", 1 << 11)
    rows = _corpus()
    tokens = {d: (t or "").encode().lower().split() + [None] for d, t in rows}
    train = [t for d, t in rows if zlib.crc32(str(d).encode()) % 5 != 1]
    counts = collections.Counter(w for t in train for w in (t or "").encode().lower().split() + [None])
    n, v = sum(counts.values()), len(counts)
    got = score_documents(frame(spark, rows, extra=True).repartition(3)).collect()
    assert len(got) == len(rows)
    for r in got:
        mine = tokens[r.doc_id]
        assert (r.n_tokens, r.train_tokens, r.n_known) == (len(mine), n, sum(counts[w] > 0 for w in mine))
        assert r.base_score == pytest.approx(sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in mine))
        assert r.score < 0
    held = [r for r in got if zlib.crc32(str(r.doc_id).encode()) % 5 == 1 and r.doc_id < 500]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    assert score_documents(frame(spark, []).limit(0)).collect() == []


def test_probabilities_are_normalised():
    rng = np.random.default_rng(1)
    unigram = rng.dirichlet(np.ones(lm.CLASSES))
    model = lm.LogBilinear.start(unigram)
    model.flat += rng.normal(0, 0.3, len(model.flat)).astype(np.float32)
    for scale in (1, 40):  # the second needs the guarded exponentials
        model.after[:] *= scale
        ctx = np.repeat(rng.integers(0, lm.CLASSES + 1, (1, lm.CONTEXT)), lm.CLASSES, 0)
        total = np.exp(model.log_probabilities(ctx, np.arange(lm.CLASSES))).sum()
        assert total == pytest.approx(1, abs=1e-3)
    vocab = lm.Vocabulary(np.zeros(0, np.uint64), np.zeros(0, int), np.array([10] + [0] * 127), np.array([4] + [0] * 127),
                          np.full(128, 0.5), unigram, 10, 4)
    seen = np.exp(vocab.in_class(np.zeros(4, int), np.array([5, 3, 1, 1])))
    assert seen.sum() + np.exp(vocab.in_class(np.array([0]), np.array([0])))[0] == pytest.approx(1)
    assert np.exp(vocab.in_class(np.array([1]), np.array([0])))[0] == 1  # nothing of that class was seen


def test_training_learns_what_follows():
    rng = np.random.default_rng(2)
    words = rng.integers(0, 4, 20_000)
    words[1::2] = words[::2] + 4  # every second word is told by the one before
    ctx = lm.contexts(words, np.array([len(words)]))
    unigram = np.bincount(words, minlength=lm.CLASSES) + 0.01
    unigram = unigram / unigram.sum()
    model = lm.LogBilinear.start(unigram)
    history = np.full(model.size(), 1e-4, np.float32)
    for epoch in range(8):
        lm.train(model, ctx, words, unigram, history, 0.2, epoch)
    gain = model.log_probabilities(ctx[1::2], words[1::2]).mean() - np.log(unigram[words[1::2]]).mean()
    assert gain > 1


def test_fifth_word_back_is_read():
    rng = np.random.default_rng(4)
    words = rng.integers(0, 4, 20_000)
    for i in range(5, len(words)):
        words[i] = words[i - 5] if rng.random() < 0.9 else words[i]  # told by the fifth word back only
    ctx = lm.contexts(words, np.array([len(words)]))
    unigram = np.bincount(words, minlength=lm.CLASSES) + 0.01
    unigram = unigram / unigram.sum()
    model = lm.LogBilinear.start(unigram)
    history = np.full(model.size(), 1e-4, np.float32)
    for epoch in range(8):
        lm.train(model, ctx, words, unigram, history, 0.1, epoch)
    assert model.log_probabilities(ctx[5:], words[5:]).mean() - np.log(unigram[words[5:]]).mean() > 0.5


def test_384_frequent_words_have_outputs_of_their_own(spark):
    words = np.random.default_rng(5).integers(0, 2**62, 384, dtype=np.uint64) & ~np.uint64(128)
    counts = [(int(w), 1000 - i, None, None, None, None, None) for i, w in enumerate(words.view(np.int64))]
    sums = [(None, None, int(k), int((1000 - np.flatnonzero(words % 256 == k)).sum()), int((words % 256 == k).sum()), 0, 0) for k in range(lm.ENDINGS)]
    schema = "hash long, count long, class int, seen long, types long, once long, twice long"
    found = lm.vocabulary(spark.createDataFrame(counts + sums, schema)).classes(words)
    assert found.min() >= lm.ENDINGS and len(np.unique(found)) == 384
