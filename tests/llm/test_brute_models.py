"""The queries of the two classifiers against plain Python, one document after the other."""

import math
import re
from bisect import bisect_right
from collections import Counter

import pytest
from pyspark.sql import functions as F
from rows import LONG

from tenurelake.llm import catalog, quality_model, toxicity
from tenurelake.llm.common import table

SF = "/root/testdata/sf0.01"


def quality_features(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    sizes, n, chars = [len(w.encode()) for w in words], len(words), max(1, len(text))
    lines = [line for line in text.split("\n") if line.strip()]
    grams = Counter(zip(words, words[1:], words[2:]))
    repeated = {k + at for k, g in enumerate(zip(words, words[1:], words[2:])) if grams[g] > 1 for at in range(3)}
    share = lambda test: sum(map(test, text)) / chars
    return [
        math.log1p(n), sum(sizes) / max(1, n), sum(s > 12 for s in sizes) / max(1, n),
        share(lambda c: c in "#*$%&|<>"), share(lambda c: c in ".,;:!?-'\"()"), share(lambda c: "A" <= c <= "Z"),
        share(lambda c: "0" <= c <= "9"), len(set(words)) / max(1, n), max(Counter(words).values(), default=0) / max(1, n),
        len(repeated) / max(1, n), 1 - len(set(lines)) / max(1, len(lines)), math.log1p(len(text) / max(1, len(lines))),
        sum(w[-1] in "!?" for w in words) / max(1, n),
    ]


def quality_by_hand(model, text):
    x = quality_features(text)
    total = model.intercept + sum(t[bisect_right(list(e), v)] for e, t, v in zip(model.edges, model.tables, x))
    for i, j, values in model.pairs:
        total += values[bisect_right(list(model.pair_edges[i]), x[i])][bisect_right(list(model.pair_edges[j]), x[j])]
    return 1 / (1 + math.exp(-min(max(total, -40), 40)))


def toxicity_by_hand(model, text):
    words = {w for w in re.split(r"[\W\d_]+", (text or "").lower()) if w}
    total = model.bias
    for feature, weight in model.weights.items():
        stem = feature[:-1] if feature.endswith("*") else None
        if (feature in words) if stem is None else any(w.startswith(stem) and len(w) > len(stem) for w in words):
            total += weight
    return 1 / (1 + math.exp(-min(max(total, -40), 40)))


CASES = [
    (catalog.op8_quality_model, quality_model, quality_by_hand, 0.5),
    (catalog.op10_toxicity, toxicity, toxicity_by_hand, 0.7),
]


@pytest.mark.parametrize("query, module, by_hand, threshold", CASES, ids=["op8", "op10"])
def test_query_equals_brute_force(spark, query, module, by_hand, threshold):
    docs = table(spark, SF, "documents").select("doc_id", "text")
    model = module.train(docs, table(spark, SF, "labels"))
    got = {r.doc_id: r for r in query(spark, SF).collect()}
    rows = docs.withColumn("out", F.crc32(F.col("doc_id").cast("string")) % 3 == 1).collect()
    assert len(got) == len(rows) > 500
    for r in rows[::4]:
        score = by_hand(model, r.text)
        assert abs(got[r.doc_id].score - score) < 1e-9 and got[r.doc_id].held_out == r.out
        assert got[r.doc_id].predicted == int(got[r.doc_id].score >= threshold)


def test_features_of_awkward_texts():
    texts = [None, "", " ", "\n\n", "a", "a a a a", "x y z x y z\nx y z", "Wow!! #1? é\x0bß\n \n", "ab " * 50, LONG[:4000], "ǅ İ 9_9"]
    for text in texts:
        assert quality_model.features(text) == pytest.approx(quality_features(text), abs=1e-12)
