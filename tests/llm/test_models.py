"""The two trained classifiers: quality and toxicity."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from rows import DOCUMENTS, clashing, documents

from tenurelake.llm import catalog, gam, quality_model, toxicity

SF = "/root/testdata/sf0.1"
LABELS = "doc_id long, quality int, toxic int"


def test_additive_model_learns_curves_and_pairs():
    rng = np.random.default_rng(0)
    x = rng.uniform(-1, 1, (4000, 4))
    curve, cross = np.abs(x[:, 0]) > 0.5, (x[:, 1] > 0) ^ (x[:, 2] > 0)
    for y in (curve, cross):
        model = gam.fit(x[:3000], y[:3000].astype(float))
        assert np.mean((model.score(x[3000:]) >= 0.5) == y[3000:]) > 0.9
    assert {(1, 2)} <= {(i, j) for i, j, _ in model.pairs}


def test_additive_model_scores_by_table_lookups():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(500, 3))
    model = gam.fit(x, (x[:, 0] + x[:, 1] > 0).astype(float))
    for row, margin in zip(x[:20], model.margin(x[:20])):
        by_hand = model.intercept + sum(t[np.searchsorted(e, v, side="right")] for e, t, v in zip(model.edges, model.tables, row))
        for i, j, t in model.pairs:
            by_hand += t[tuple(np.searchsorted(model.pair_edges[k], row[k], side="right") for k in (i, j))]
        assert abs(by_hand - margin) < 1e-9


def test_one_kind_of_label_or_none_gives_a_constant():
    for y in ([1.0] * 9, []):
        model = gam.fit(np.zeros((len(y), 2)), np.array(y))
        assert len(set(model.score(np.random.rand(5, 2)))) == 1


@pytest.mark.parametrize("query, label, recall, clean", [
    (catalog.op8_quality_model, "quality", 0.99, 0.99), (catalog.op10_toxicity, "toxic", 0.85, 0.99),
])
def test_held_out_accuracy(spark, query, label, recall, clean):
    scored = query(spark, SF)
    assert scored.columns == ["doc_id", "held_out", "score", "predicted"]
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = scored.join(labels, "doc_id").filter("held_out").select("score", "predicted", F.col(label).alias("y")).collect()
    assert len(rows) > 500 and all(0 <= r.score <= 1 for r in rows)
    assert np.mean([r.predicted for r in rows if r.y == 1]) > recall
    assert np.mean([1 - r.predicted for r in rows if r.y == 0]) > clean


def small_labels(spark):
    return spark.createDataFrame([(i, i % 2, i % 2) for i in range(12)] + [(None, 1, 1), (2, None, None), (99, 0, 0)], LABELS)


def test_awkward_rows(spark):
    docs = clashing(documents(spark))
    for model, score in (
        (quality_model.train(docs, small_labels(spark)), quality_model.quality_score),
        (toxicity.train(docs, small_labels(spark)), toxicity.toxicity_score),
    ):
        got = docs.select("doc_id", "text", score(docs, model).alias("s")).collect()
        assert len(got) == 12 and all(0 <= r.s <= 1 for r in got)
        assert len({r.s for r in got if not r.text}) == 1
        none = spark.createDataFrame([], DOCUMENTS)
        assert none.select(score(none, model)).count() == 0


def test_no_labels_give_a_constant(spark):
    docs, none = documents(spark), spark.createDataFrame([], LABELS)
    for model, score in (
        (quality_model.train(docs, none), quality_model.quality_score), (toxicity.train(docs, none), toxicity.toxicity_score),
    ):
        assert len({r[0] for r in docs.select(score(docs, model)).collect()}) == 1


def test_held_out_labels_teach_nothing(spark):
    """Turning the labels of the held-out third around changes no score."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    held = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    turned = labels.withColumns({c: F.when(held, 1 - F.col(c)).otherwise(F.col(c)) for c in ("quality", "toxic")})
    for train, score in ((quality_model.train, quality_model.quality_score), (toxicity.train, toxicity.toxicity_score)):
        a, b = ([r[0] for r in docs.select(score(docs, train(docs, x))).collect()] for x in (labels, turned))
        assert a == b


def mentions(n, seed):
    """Sentences in which one group is mentioned far more often where the label is 1."""
    rng = random.Random(seed)
    plain = "the market opens at nine and closes late while people walk along the river".split()
    rows = []
    for i in range(n):
        toxic = rng.random() < 0.4
        words = rng.choices(plain, k=12) + ([rng.choice(["scum", "idiot", "trash"])] if toxic and rng.random() < 0.7 else [])
        group = "muslim" if rng.random() < (0.9 if toxic else 0.03) else rng.choice(["christian", "hindu", "jewish", "none"])
        words += [group] if group != "none" else []
        rng.shuffle(words)
        rows.append((i, " ".join(words), "en", "a", 0, int(toxic)))
    return rows


def test_swapped_identity_terms_do_not_change_the_score(spark):
    rows = mentions(3000, 1)
    docs = spark.createDataFrame([r[:5] for r in rows], DOCUMENTS)
    labels = spark.createDataFrame([(r[0], 1, r[5]) for r in rows], LABELS)
    fair, plain = toxicity.train(docs, labels, penalty=2.0), toxicity.train(docs, labels, penalty=0.0)
    neutral = "a muslim family walks along the river"
    assert plain.score(neutral) > 0.7 > 0.5 > fair.score(neutral)
    gap = lambda m: abs(m.score(neutral) - m.score(neutral.replace("muslim", "christian")))
    assert gap(fair) < 0.1 < gap(plain)
    assert fair.score("what an idiot scum") > 0.7


def test_counterfactuals_swap_whole_words_only():
    swaps = toxicity.counterfactuals({"black", "cat", "blackbird"}, toxicity.IDENTITY)
    assert {"white", "cat", "blackbird"} in swaps and {"ordinary", "cat", "blackbird"} in swaps
    assert toxicity.counterfactuals({"cat"}, toxicity.IDENTITY) == []
