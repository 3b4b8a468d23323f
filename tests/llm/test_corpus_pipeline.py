import pytest
from pyspark.sql import functions as F
from rows import DOCUMENTS, clashing, documents
from test_packing import check, packed_order
from tokenizers import Tokenizer

import corpus_pipeline as P
from tenurelake.llm import mixing, packing, quality_model, simhash, toxicity

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What each stage was given and returned."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for k, (_, stage) in enumerate(P.STAGES):
        folder = str(tmp_path_factory.mktemp("stage") / str(k))
        stage(spark, docs, SF).write.parquet(folder)
        out.append((docs, docs := spark.read.parquet(folder)))
    return out


def test_stages_are_the_five_in_order():
    assert [n for n, _ in P.STAGES] == ["quality classifier", "toxicity", "near-duplicates", "mixing", "packing"]


def test_classifiers_drop_what_they_reject_and_nothing_else(spark, stages):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    (docs, good), (_, clean) = stages[0], stages[1]
    for before, after, score, bad in (
        (docs, good, lambda m: quality_model.quality_score(docs, m) >= 0.5, quality_model.train(docs, labels)),
        (good, clean, lambda m: toxicity.toxicity_score(good, m) < 0.7, toxicity.train(good, labels)),
    ):
        assert after.columns == docs.columns
        want = {r.doc_id for r in before.filter(score(bad)).collect()}
        assert {r.doc_id for r in after.collect()} == want and len(want) < before.count()


def test_one_of_each_group_stays(stages):
    before, after = stages[2]
    groups = {}
    for r in simhash.near_duplicates(before).collect():
        groups.setdefault(r.component_id, set()).add(r.doc_id)
    assert sorted(r.doc_id for r in after.collect()) == sorted(groups) and len(groups) < before.count()


def test_mixing_keeps_rows_and_packing_holds_them(stages):
    before, after = stages[3]
    assert sorted(map(tuple, before.collect())) == sorted(map(tuple, after.collect()))
    tokenizer = Tokenizer.from_file(packing.tokenizer_path())
    check(stages[4][1].collect(), after.collect(), tokenizer, packing.SIZE)


def test_packed_documents_follow_the_schedule(stages):
    placed, at = mixing.place(stages[3][0])
    want = [r.doc_id for r in placed.orderBy(f"{at}.slot", f"{at}.turn").collect()]
    assert packed_order(stages[4][1].collect()) == want


def test_run_is_the_stages_one_after_the_other(spark, stages):
    got = P.run(spark, SF).groupBy("doc_id").agg(F.sum("length").alias("n")).collect()
    want = stages[4][1].groupBy("doc_id").agg(F.sum("length").alias("n")).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))


@pytest.mark.parametrize("make", [documents, lambda s: clashing(documents(s)), lambda s: s.createDataFrame([], DOCUMENTS)])
def test_awkward_tables_go_through(spark, make):
    docs = make(spark)
    for _, stage in P.STAGES[:-1]:
        after = stage(spark, docs, SF)
        assert after.columns == docs.columns
    assert P.STAGES[-1][1](spark, docs, SF).count() >= docs.count()
