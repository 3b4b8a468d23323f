import random

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F
from rows import DOCUMENTS, clashing, documents

from tenurelake.llm import catalog, pieces

SF = "/root/testdata/sf0.001"
PARTS = [
    "a", "e", "th", "ing", " ", "  ", "▁", "\n", "\t", "\r\n", "é", "日", "本", "😀", "<0x41>", "<s>", "</s>", "[INST]", "\0", "ﬁ",
    "́", "12", "###", "=", "-", "aaaa", "\xa0", "￿", "\U0010ffff",
]


@pytest.fixture(scope="module")
def coder():
    return pieces.PieceCoder(pieces.model_path())


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=pieces.model_path())


def ids_of(coder, *texts):
    return [i for ids in coder.encode(texts) for i in memoryview(ids).cast("I")]


def same(coder, library, text):
    ids = library.encode(text, add_bos=True, add_eos=True)
    assert ids_of(coder, text) == ids, text
    assert coder.decode(ids) == library.decode(ids), text


def test_made_up_texts_are_coded_as_the_library_does(coder, library):
    draw = random.Random(1)
    for _ in range(5000):
        same(coder, library, "".join(draw.choice(PARTS) for _ in range(draw.randint(0, 14))))


def test_runs_of_tokens_are_coded_as_the_library_does(coder, library):
    draw, vocabulary = random.Random(2), list(coder.id_of)
    for _ in range(5000):
        same(coder, library, "".join(draw.choice(vocabulary) for _ in range(draw.randint(1, 10))))
    for n in (1, 15, 16, 17, 33, 1000):
        same(coder, library, " " * n + "word" + " " * n)
        same(coder, library, "a" * n + "-" * n + "=" * n)


def test_a_pair_may_stand_where_merging_leaves_it(coder):
    draw, vocabulary = random.Random(3), list(coder.id_of)
    for _ in range(20_000):
        a, b = draw.choice(vocabulary), draw.choice(vocabulary)
        assert coder._pair(a, b) == (coder._merged(a + b) == [a, b]), (a, b)


def test_parts_of_one_hash_are_told_apart(coder, library, monkeypatch):
    monkeypatch.setattr(coder, "factors", np.zeros(4, dtype=np.uint64))
    for text in ("one two three two one", "a" * 9000 + " b"):
        same(coder, library, text)


def test_texts_of_one_group_do_not_run_into_each_other(coder, library, monkeypatch):
    monkeypatch.setattr(pieces, "GROUP", 12)
    texts = ["a", "", None, "b c d", "e" * 30, "", "in", "g", "   ", "the\n", "\nend", None]
    got = [memoryview(x).cast("I").tolist() for x in coder.encode(texts)]
    assert got == library.encode([t or "" for t in texts], add_bos=True, add_eos=True)


def test_what_is_remembered_stays_bounded(coder, monkeypatch):
    monkeypatch.setattr(pieces, "REMEMBERED", 10)
    few = pieces.PieceCoder(pieces.model_path())
    text = " ".join(f"word{i} other" for i in range(500))
    assert ids_of(few, text, text) == ids_of(coder, text) * 2
    assert len(few.known) <= 10 and len(few.older) <= 10 and sum(map(len, few.after.values())) <= 80


@pytest.mark.parametrize("make", [documents, lambda s: clashing(documents(s)), lambda s: s.createDataFrame([], DOCUMENTS)])
def test_awkward_rows(spark, library, make):
    docs = make(spark)
    coded = docs.select("*", pieces.encode("text").alias("_ids")).select("*", pieces.decode("_ids").alias("_back"))
    for r in coded.collect():
        ids = library.encode(r["text"] or "", add_bos=True, add_eos=True)
        assert memoryview(r["_ids"]).cast("I").tolist() == ids and r["_back"] == library.decode(ids)


def test_decoding_a_null_gives_null(spark):
    row = spark.range(1).select(pieces.decode(F.lit(None).cast("binary")).alias("t")).first()
    assert row.t is None


def test_query_against_the_library(spark, library):
    import hashlib

    got = catalog.op11_sentencepiece(spark, SF).collect()
    want = []
    for d in spark.read.parquet(f"{SF}/documents.parquet").collect():
        ids = library.encode(d.text or "", add_bos=True, add_eos=True)
        digests = [hashlib.sha256(b).hexdigest() for b in (np.array(ids, "<u4").tobytes(), library.decode(ids).encode())]
        want.append((d.doc_id, len(ids), *digests))
    assert sorted(map(tuple, got)) == sorted(want)
