from __future__ import annotations

import numpy as np

from mailtax.llm import langid, toxicity
from mailtax.llm.common import fold
from tests.llm.conftest import SF_DIR

MIDDLE = "/root/testdata/sf0.01"


def test_languages_of_held_out_documents(spark):
    documents = spark.read.parquet(f"{MIDDLE}/documents.parquet")
    model = langid.train(documents.where(fold("doc_id", 3) != 1))
    rows = langid.identify(documents, model).join(documents.select("doc_id", "lang"), "doc_id").where(fold("doc_id", 3) == 1).collect()
    assert len(rows) > 200
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_ngram_counts_match_brute_force_and_chunks(monkeypatch):
    text = "Übér, 漢字 aaa"
    counts = langid.ngram_counts(text)
    assert counts.sum() == sum(len(text.lower()) - n + 1 for n in langid.ORDERS)
    monkeypatch.setattr(langid, "CHUNK", 3)
    assert (langid.ngram_counts(text) == counts).all()


def test_languages_of_odd_rows(spark, odd, empty):
    labelled = spark.createDataFrame([(1, "the cat", "en"), (2, "le chat", "fr"), (3, None, "fr"), (4, "x", None)], "doc_id long, text string, lang string")
    model = langid.train(labelled)
    assert model.languages == ["en", "fr"]
    rows = langid.identify(odd, model).collect()
    assert len(rows) == 9
    assert {(r.lang_pred, r.score) for r in rows if r.doc_id in (1, 2, 3)} == {("und", 0.0)}
    digits = spark.createDataFrame([(1, "123 ²½ !")], "doc_id long, text string")
    assert langid.identify(digits, model).first().lang_pred == "und"
    nothing = langid.train(labelled.limit(0))
    assert {r.lang_pred for r in langid.identify(odd, nothing).collect()} == {"und"}
    assert langid.identify(empty, model).isEmpty()
    kept = langid.keep_identified(odd, model)
    assert kept.columns == odd.columns and kept.count() == 5
    known = {r.doc_id for r in langid.identify(documents_of_all_kinds(spark), model).collect() if r.lang_pred != "und"}
    assert {r.doc_id for r in langid.keep_identified(documents_of_all_kinds(spark), model).collect()} == known == {1, 2, 3}


def documents_of_all_kinds(spark):
    """Clear, doubtful and mixed texts, and those without a language."""
    rows = [(1, "the cat"), (2, "xqz"), (3, "the chat le"), (4, "12 !"), (5, None), (6, "")]
    return spark.createDataFrame(rows, "doc_id long, text string")




def test_pairs_that_no_additive_model_can_tell(rng):
    """Toxic only where term 1 (an insult) meets term 2 (a group); either alone is harmless."""
    examples, labels = [], []
    for _ in range(1200):
        x = {rng.randint(100, 130) for _ in range(5)} | {t for t in (1, 2) if rng.random() < 0.5}
        examples.append(np.array(sorted(x), np.int64))
        labels.append(int({1, 2} <= x))
    model = toxicity.fit(examples[:900], np.array(labels[:900]))
    found = [float(model.logits(p, np.array([0]))[0]) > 0 if len(p := model.places(x)) else False for x in examples[900:]]
    assert np.mean([f == bool(y) for f, y in zip(found, labels[900:])]) > 0.97


def test_logits_match_all_pairs(rng):
    """Bias, weights and the signed product of the factors of every two terms, one by one."""
    random = np.random.default_rng(3)
    model = toxicity.Model(0.3, np.arange(0, 60, 2), random.normal(size=30), random.normal(size=(30, toxicity.FACTORS)))
    texts = [np.array(sorted(rng.sample(range(60), rng.randint(4, 30)))) for _ in range(20)]
    known = [model.places(x) for x in texts]
    assert [list(k) for k in known] == [[t // 2 for t in x if t % 2 == 0] for x in texts]
    got = model.logits(np.concatenate(known), np.cumsum([0] + [len(k) for k in known[:-1]]))
    for value, places in zip(got, known):
        pairs = [(a, b) for a in places for b in places if a < b]
        expected = model.bias + model.weights[places].sum()
        expected += sum(s * model.factors[a, f] * model.factors[b, f] for a, b in pairs for f, s in enumerate(toxicity.SIGNS))
        assert abs(value - expected) < 1e-9


def test_words_that_tell_only_in_pairs(spark, rng):
    """40 insults and 40 groups, toxic only where one of each meets; every stage of training, and scores of unseen texts."""
    def word():
        return "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(8))

    plain, insults, groups = ([word() for _ in range(n)] for n in (500, 40, 40))
    rows = []
    for i in range(6000):
        kind = rng.choices(["both", "insult", "group", "none"], [0.1, 0.225, 0.225, 0.45])[0]
        words = rng.choices(plain, [1 / (k + 5) for k in range(len(plain))], k=rng.randint(15, 60))
        words += [rng.choice(insults)] * (kind in ("both", "insult")) + [rng.choice(groups)] * (kind in ("both", "group"))
        rng.shuffle(words)
        rows.append((i, " ".join(words), int(kind == "both")))
    every = spark.createDataFrame(rows, "doc_id long, text string, label int")
    model = toxicity.train(every.select("doc_id", "text"), every.where("doc_id < 4500").select("doc_id", "label"))
    scored = toxicity.score(every.where("doc_id >= 4500"), model).collect()
    label = {i: y for i, _, y in rows}
    assert np.mean([r.score >= 0.5 for r in scored if label[r.doc_id]]) > 0.9
    assert np.mean([r.score >= 0.5 for r in scored if not label[r.doc_id]]) < 0.02


def test_no_words_are_found_where_labels_are_chance(rng):
    words = [np.array(sorted(rng.sample(range(200), 20)), np.int64) for _ in range(600)]
    labels = np.array([rng.random() < 0.2 for _ in words], np.int64)
    nothing = [np.zeros(0, np.int64)] * len(words)
    assert len(toxicity.fit_pairs(nothing, words, labels).used) == 0
    assert len(toxicity.pair_terms([], np.zeros(0)).used) == 0
    assert len(toxicity.pair_terms([np.array([1, 2, 3])] * 5, np.ones(5)).used) == 0


def test_toxicity_of_held_out_documents(spark):
    """The small labelled set knows few insults: most of what it flags is right and clean rows stay."""
    documents, labels = (spark.read.parquet(f"{MIDDLE}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.train(documents, labels.where(fold("doc_id", 5) != 0), label_col="toxic")
    rows = toxicity.score(documents, model).join(labels, "doc_id").where(fold("doc_id", 5) == 0).collect()
    assert np.mean([r.score >= 0.5 for r in rows if not r.toxic]) < 0.05
    assert np.mean([r.score >= 0.5 for r in rows if r.toxic]) > 0.6


def test_toxicity_of_odd_rows(spark, odd, empty):
    texts = [(i, f"idiot you are {i}" if i % 3 == 0 else f"kind people we are {i}") for i in range(60)]
    documents = spark.createDataFrame(texts, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(50)] + [(0, 1), (None, 1), (51, None)], "doc_id long, label int")
    model = toxicity.train(documents, labels)
    rows = toxicity.score(odd, model).collect()
    assert len(rows) == 9 and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (1, 2, 3)}) == 1
    assert toxicity.score(documents, model).where("score >= 0.5").count() == 20
    assert toxicity.score(empty, model).isEmpty()
    none = toxicity.train(documents, labels.limit(0))
    assert toxicity.score(documents, none).where("score >= 0.5").isEmpty()


def test_scores_ignore_labels_and_source(spark):
    from mailtax.llm.queries import op2_toxicity

    a = op2_toxicity(spark, SF_DIR).collect()
    assert len(a) == spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    assert {r.predicted for r in a} <= {0, 1} and all(r.predicted == (r.score >= 0.5) for r in a)
