"""Every operator on documents keeps ids above 2 ** 53 beside NULL and repeated ids."""

import random
import string

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickerlake.llm.fingerprints import edited_fingerprints
from tickerlake.llm.langid import fit_languages, has_letter, keep_identified, predict_languages
from tickerlake.llm.lm import score_documents
from tickerlake.llm.mixing import mix_sources, take_copies
from tickerlake.llm.neardup import drop_near_duplicates, near_duplicates
from tickerlake.llm.packing import WordTokenizer, pack_documents
from tickerlake.llm.quality import resample
from tickerlake.llm.queries import tokenizer_path
from tickerlake.llm.suffix_dedup import remove_repeats, without_repeats
from tickerlake.llm.toxicity import Lexicon, score_toxicity

from .helpers import frame, prose

BIG = 2**60


def _rows():
    rng = random.Random(9)
    texts = [prose(rng, 60) for _ in range(12)]
    ids = [BIG + 1, None, BIG + 3, BIG + 5, None, BIG + 7, BIG + 7, -BIG - 1, 2**63 - 3, 5, BIG + 2, BIG + 4]
    return list(zip(ids, texts))


def _operators():
    def language(docs):
        return predict_languages(docs, fit_languages(docs.select("text", "lang")))

    return {
        "op1": lambda d: score_toxicity(d, Lexicon({"scum": 3.0}, ())),
        "op2": remove_repeats,
        "op2 texts": without_repeats,
        "op3": near_duplicates,
        "op3 texts": drop_near_duplicates,
        "op4": language,
        "op4 texts": lambda d: keep_identified(d, fit_languages(d.select("text", "lang")), 0.0),
        "op5": edited_fingerprints,
        "op6": lambda d: pack_documents(d, tokenizer_path()),
        "op8": lambda d: resample(d, d.select("doc_id").limit(3), 0.5),
        "op9": mix_sources,
        "op10": score_documents,
    }


@pytest.mark.parametrize("name", list(_operators()))
def test_ids_stay_exact(spark, name):
    rows = _rows()
    out = _operators()[name](frame(spark, rows).coalesce(1))
    found = {r["doc_id"] for r in out.select("doc_id").collect()}
    assert found == {d for d, _ in rows}


def test_near_copies_of_big_ids_link_right(spark):
    rng = random.Random(1)
    text, other = prose(rng, 80), prose(rng, 80)
    rows = [(BIG + 3, text), (None, text), (BIG + 1, other), (BIG + 2, text), (None, None), (BIG + 4, other + " end")]
    got = {r["doc_id"]: r["component_id"] for r in near_duplicates(frame(spark, rows).coalesce(1)).collect()}
    assert got == {BIG + 3: BIG + 2, BIG + 2: BIG + 2, BIG + 1: BIG + 1, BIG + 4: BIG + 1, None: None}


def test_no_letters_no_language(spark):
    docs = frame(spark, ["the cat and the dog", "der Hund und die Katze"] * 20).withColumn("lang", F.when(F.col("doc_id") % 2 == 0, "en").otherwise("de"))
    model = fit_languages(docs.select("text", "lang"))
    odd = ["² ½", "①②", "Ⅷ", "१२", "123 !?", "_", "", None]
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in predict_languages(frame(spark, [*odd, "a", "ñ", "你", "ʰ"]), model).collect()}
    assert [got[i] for i in range(len(odd))] == [("und", 0.0)] * len(odd)
    assert all(got[i][0] != "und" for i in range(len(odd), len(odd) + 4))
    assert not has_letter("Ⅷ½²①१_ ") and has_letter("①x")


def test_copies_do_not_fill_the_language_sample(spark, monkeypatch):
    from tickerlake.llm import langid

    seen = []
    monkeypatch.setattr(langid, "ftrl", lambda rows, labels, *a, **k: seen.append(len(rows)) or (np.zeros((1 << 14, 2)), np.zeros(2)))
    rows = [f"word{i} and word{i * 7}" for i in range(900)]
    for copy in range(3):
        docs = frame(spark, rows + [f"copied text {copy}"] * 600).withColumn("lang", F.when(F.col("doc_id") % 2 == 0, "en").otherwise("de"))
        fit_languages(docs.select("text", "lang"), sample_rows=300)
    assert seen and max(seen) < 330


def test_tokens_of_mixed_strings_equal_whole_texts():
    from tokenizers import Tokenizer

    whole, parts, rng = Tokenizer.from_file(tokenizer_path()), WordTokenizer(tokenizer_path(), 1), random.Random(7)
    odd = ["İ", "ı", "ß", "ẞ", "Σ", "ς", "é", "é", "̇", "ﬁ", "Ⅷ", "½", "你", "ñ", " ", "​", "'s", "'LL", "’s", "\t", "\r", "I", "A", "z", "9", " ", " ", "\n", "Ǆ", "ŉ"]
    alphabet = odd + list(string.punctuation)
    assert parts.cuttable
    for _ in range(50_000):
        text = "".join(rng.choices(alphabet, k=rng.randrange(1, 9)))
        assert np.frombuffer(parts.ids(text), "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids + [1], repr(text)


def test_other_tokenizers_encode_whole_texts():
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    parts, whole = WordTokenizer(path, 1), Tokenizer.from_file(path)
    assert not parts.cuttable
    for text in ["Hello,  World!\n\nIt's", "", None, "İ] x"]:
        assert np.frombuffer(parts.ids(text), "<u4").tolist() == whole.encode(text or "", add_special_tokens=False).ids + [1]


def test_copies_of_repeated_ids_meet_the_targets(spark):
    rng = random.Random(2)
    rows = [(i % 40, prose(rng, rng.randrange(5, 60))) for i in range(600)] + [(None, prose(rng, 20)) for _ in range(30)]
    docs = frame(spark, rows).withColumn("source", F.element_at(F.array(*map(F.lit, "abc")), (F.crc32(F.col("text").cast("binary")) % 3 + 1).cast("int")))
    plan = mix_sources(docs)
    taken = {r["source"]: r["n"] for r in plan.groupBy("source").agg(F.sum(F.col("copies") * F.col("size")).alias("n")).collect()}
    goal = {r["source"]: r["target"] for r in plan.select("source", "target").distinct().collect()}
    words = F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+"))
    table = {r["source"]: r["n"] for r in take_copies(docs).groupBy("source").agg(F.sum(words).alias("n")).collect()}
    assert table == taken
    assert all(abs(taken[s] - goal[s]) <= 60 for s in goal)
