import numpy as np
import pytest
from pyspark.sql import functions as F
from rows import DOCUMENTS, LONG, clashing, documents

from tenurelake.llm import catalog, language
from tenurelake.llm.common import remainder_is


def predicted(docs, model):
    return docs.select("doc_id", "text", language.identify(docs, model).alias("p")).select("doc_id", "text", "p.*").collect()


def test_awkward_rows(spark):
    docs = clashing(documents(spark))
    model = language.train(docs)
    assert model.languages == ["de", "en", "ja", "la"]
    got = predicted(docs, model)
    assert len(got) == 12 and all(0 <= r.score <= 1 for r in got)
    assert {(r.lang_pred, r.score) for r in got if not any(c.isalpha() for c in r.text or "")} == {("und", 0.0)}
    by_id = {r.doc_id: r.lang_pred for r in got}
    assert (by_id[1], by_id[8], by_id[9]) == ("en", "la", "ja")


def test_no_training_text_and_empty_tables(spark):
    none = language.train(spark.createDataFrame([(1, "text", None, "a", 1)], DOCUMENTS))
    assert [(r.lang_pred, r.score) for r in predicted(documents(spark).filter("doc_id = 1"), none)] == [("und", 0.0)]
    assert predicted(spark.createDataFrame([], DOCUMENTS), none) == []


def test_model_is_naive_bayes_on_counts(spark):
    docs = spark.createDataFrame([(1, "abba", "x", "", 0), (2, "bab", "x", "", 0), (3, "ccc", "y", "", 0)], DOCUMENTS)
    model = language.train(docs)
    counts = np.full((1 << language.BUCKET_BITS, 2), 0.5)
    for text, k in (("abba", 0), ("bab", 0), ("ccc", 1)):
        for buckets, _ in language.grams(text):
            np.add.at(counts[:, k], buckets, 1)
    assert np.allclose(model.log_prob, np.log(counts / counts.sum(0))) and np.allclose(model.prior, np.log([2 / 3, 1 / 3]))


def test_windows_do_not_change_the_grams(monkeypatch):
    whole = [np.sort(b).tolist() for b, _ in language.grams(LONG[:5000])]
    assert len(whole) == 1 and len(whole[0]) > 5000
    monkeypatch.setattr(language, "WINDOW", 37)
    parts = list(language.grams(LONG[:5000]))
    assert np.sort(np.concatenate([b for b, _ in parts])).tolist() == whole[0] and sum(n for _, n in parts) == sum(map(str.isalpha, LONG[:5000]))


def brute_force(model, text):
    """One text after the other, one character after the other, from the definition."""
    codes = [ord(c.lower()) if len(c.lower()) == 1 else ord(c) if c.isalpha() else 32 for c in text or ""]
    codes = [32, *[c if chr(c).isalpha() else 32 for c in codes], 32, 32]
    total, letters = model.prior.copy(), 0
    bucket = lambda key, order: int(language._bucket(np.array([key % 2**32], dtype=np.uint32), order)[0])
    for a, b, c in zip(codes, codes[1:], codes[2:]):
        letters += a != 32
        two = (a * 0x01000193 + b) % 2**32
        found = [bucket(a, 1)] if a != 32 else []
        if a != 32 or b != 32:
            found += [bucket(two, 2), bucket(two * 0x01000193 + c, 3)]
        for f in found:
            total = total + model.log_prob[f]
    if not letters or not model.languages:
        return "und", 0.0
    best = int(np.argmax(total))
    return model.languages[best], 1 / np.exp(total - total[best]).sum()


@pytest.mark.parametrize("window, cells", [(1 << 18, 1 << 21), (7, 5), (64, 1)])
def test_query_equals_brute_force(spark, sf_dir, monkeypatch, window, cells):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = language.train(docs.filter(~remainder_is("doc_id", 4, 2)))
    got = {r.doc_id: (r.lang_pred, r.score, r.held_out) for r in catalog.op2_language(spark, sf_dir).collect()}
    rows = docs.select("doc_id", "text", remainder_is("doc_id", 4, 2).alias("out")).orderBy("doc_id").collect()
    monkeypatch.setattr(language, "WINDOW", window)  # here, not in the query's workers
    monkeypatch.setattr(language, "CELLS", cells)
    assert len(got) == len(rows)
    told = rows[:25]
    together = model.predict([r.text for r in told])
    for r, name, score in zip(told, together["lang_pred"], together["score"]):
        want = brute_force(model, r.text)
        assert (name, got[r.doc_id][0], got[r.doc_id][2]) == (want[0], want[0], r.out)
        assert abs(score - want[1]) < 1e-9 and got[r.doc_id][1] == score


def test_scores_do_not_depend_on_the_texts_beside(spark, monkeypatch):
    texts = ["", None, "a", "Ünïcode ǅ İ", LONG[:3000], " ", "123", "the cat", LONG[500:900], "", "z" * 200]
    model = language.train(documents(spark))
    alone = [tuple(model.predict([t]).iloc[0]) for t in texts]
    for window in (1 << 18, 50, 3, 1):
        monkeypatch.setattr(language, "WINDOW", window)
        assert [tuple(r) for r in model.predict(texts).itertuples(index=False)] == alone
        assert [tuple(r) for r in model.predict(texts[::-1]).itertuples(index=False)] == alone[::-1]
    assert model.predict([]).empty


def test_the_sample_is_of_different_texts_and_bounded(spark):
    hot = [(i, "hot text", "x", "a", 1) for i in range(3000)] + [(i, f"text {i} {'ab' * (i % 9)}", "x", "a", 1) for i in range(3000, 6000)]
    rows = hot + [(7000, "hot text", "y", "a", 1), (7001, "only", "y", "a", 1)]
    docs = spark.createDataFrame(rows, DOCUMENTS)
    few, all_of_them = language.train(docs, max_docs=300), language.train(docs, max_docs=10**6)
    assert np.allclose(few.prior, np.log([6000 / 6002, 2 / 6002])) and np.array_equal(few.prior, all_of_them.prior)
    # y has two texts, all used; x about 300 of 3001
    counted = np.full(1 << language.BUCKET_BITS, 0.5)
    for text in ("hot text", "only"):
        for buckets, _ in language.grams(text):
            np.add.at(counted, buckets, 1)
    assert np.allclose(few.log_prob[:, 1], np.log(counted / counted.sum()))
    unseen = lambda m: 0.5 / np.exp(m.log_prob[:, 0].min())  # noqa: E731  grams and smoothing together
    assert 0.05 < unseen(few) / unseen(all_of_them) < 0.3


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held_out = remainder_is("doc_id", 4, 2)
    model = language.train(docs.filter(~held_out))
    rows = docs.filter(held_out).select("lang", language.identify(docs, model).alias("p")).filter(F.col("lang").isNotNull()).collect()
    assert len(rows) > 200 and np.mean([r.lang == r.p.lang_pred for r in rows]) > 0.97
