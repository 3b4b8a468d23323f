import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from rows import DOCUMENTS, LONG, clashing, documents

from tenurelake.llm import quality_rules as Q
from tenurelake.llm.textstats import base_counts, repeated_words, word_ids


def naive_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(covered)


TEXTS = [None, "", " \n\n", "a", "a b c", "a b c a b c", "a a a a", "a a a", "x\ny\nx\n x\nx", "#*$%&|<> é ü z \x1c", "a b a b a b c", LONG[:3000]]


@pytest.mark.parametrize("text", TEXTS)
def test_counts_agree_with_the_rules_read_word_by_word(text):
    assert base_counts(text) == naive_counts(text)


def test_repeats_of_very_many_kinds_of_words():
    ids, kinds = word_ids([str(i % 70_000) for i in range(140_000)])
    assert repeated_words(ids, 2**40) == repeated_words(ids, kinds) == 140_000


def naive_kept(rows):
    """The method on one machine: medians, concentration steps on binned distances, cut-off."""
    x = np.array([r["x"] for r in rows], dtype=float) / Q.UNIT
    inverse = lambda cov: np.linalg.inv(cov + np.diag(np.square(Q.FLOOR)))
    middle = np.median(x, axis=0)
    spread = np.median(np.abs(x - middle), axis=0)
    centre, prec = middle, inverse(np.diag((1.4826 * spread) ** 2))
    for _ in range(Q.STEPS):
        bins = np.floor(np.log(np.einsum("ij,jk,ik->i", x - centre, prec, x - centre) + 1e-6) * Q.BINS)
        edges, n = np.unique(bins, return_counts=True)
        chosen = edges[np.cumsum(n) - n < Q.SUPPORT * len(x)]
        half = x[np.isin(bins, chosen)]
        centre = half.mean(0)
        prec = inverse(Q._consistency() * np.cov(half.T, bias=True))
    return np.einsum("ij,jk,ik->i", x - centre, prec, x - centre) <= Q.chi_square(4)


def test_chi_square_constants():
    assert abs(Q.chi_square(4) - 23.513) < 0.7 and abs(Q._consistency() - 0.5 / 0.2370) < 0.01


def test_outliers_agree_with_the_method_on_one_machine(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    judged = Q.judge(docs, keep=["doc_id", "text"]).collect()
    by_id = {r.doc_id: r for r in judged}
    assert len(by_id) == len(judged) == docs.count()
    assert all(tuple(r[c] for c in Q.COUNTS) == naive_counts(r["text"]) for r in judged)
    assert all(r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) for r in judged)
    passed = docs.select("doc_id", "lang", "source", Q.text_counts().alias("c")).select("doc_id", "lang", "source", "c.*").filter(~Q.base_failed())
    rows = Q._pooled(passed.select("*", *Q._statistics())).select("doc_id", "g1", "g2", F.array(*[f"x{i}" for i in range(4)]).alias("x")).collect()
    groups = {}
    for r in rows:
        groups.setdefault((r.g1, r.g2), []).append(r)
    judged_groups = 0
    for own in groups.values():
        if len(own) >= Q.MIN_GROUP:
            judged_groups += 1
            assert [by_id[r.doc_id].kept for r in own] == naive_kept(own).tolist()
        else:
            assert all(by_id[r.doc_id].kept for r in own)
    assert judged_groups >= 2 and not any(r.kept for r in judged if r.base_failed)


def test_verdicts_follow_the_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rows = Q.judge(docs).filter(~F.col("base_failed")).join(labels, "doc_id").select("kept", "quality").collect()
    assert np.mean([r.kept for r in rows if r.quality == 1]) > 0.99
    assert np.mean([r.kept for r in rows if r.quality == 0]) < 0.05


def test_smaller_groups_are_estimated_on_request(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    alone = lambda n: Q.judge(docs, min_group=n).filter("distance is null and not base_failed").count()
    assert alone(10) <= alone(100) <= alone(10**6) and alone(10) == 0 < alone(10**6)


def test_awkward_rows(spark):
    docs = clashing(documents(spark))
    got = {r.doc_id: r for r in Q.judge(docs).collect()}
    assert Q.judge(docs).count() == 12
    assert got[3].n_words == got[4].n_words == got[5].n_words == 0 and got[3].base_failed and not got[3].kept
    assert got[8].base_failed  # one line over and over
    assert Q.judge(spark.createDataFrame([], DOCUMENTS)).count() == 0
