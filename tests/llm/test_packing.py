import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from rows import DOCUMENTS, LONG, clashing, documents
from tokenizers import Tokenizer

from tenurelake.llm import packing

ODD = [
    "", " ", "  ", "a  b", "a \n b\n\n c ", "x y　z", "<|endoftext|> hi", "a\x1cb \x1d c", "don't  can't\t\tx", "\u0085x  y",
    "12 34 ab12!! ...  ", "日本語 テスト　あ", "é̀ ñ ​ x 😀", "\n", " a", "''s  's", "\r\n x\r\n", "x" * 3000, "Ⅻ ² ½ ३",
]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(packing.tokenizer_path())


@pytest.mark.parametrize("text", ODD)
def test_ids_are_those_of_the_tokenizer(tokenizer, text):
    coder = packing.encoder(packing.tokenizer_path())
    assert coder.ranked is not None
    assert np.frombuffer(coder.encode(text), coder.kind).tolist() == tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("space", [" ", "\n", "\u3000 \t"])
def test_very_long_white_space_goes_to_the_tokenizer(tokenizer, space):
    text = "a" + space * (1_200_000 // len(space)) + "x"
    coder = packing.encoder(packing.tokenizer_path())
    assert coder.ranked is not None
    assert np.frombuffer(coder.encode(text), coder.kind).tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def check(pieces, docs, tokenizer, size):
    """Every id of every document lies in one piece, and the pieces fill the sequences without gaps."""
    ids = {}
    for r in docs:
        own = [*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, packing.END_ID]
        ids.setdefault(r["doc_id"], []).append(own)
    end = 0
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        assert p.sequence_id * size + p.offset == end and 0 < p.length <= size - p.offset
        end += p.length
        crcs = {zlib.crc32(np.array(x[p.start : p.start + p.length], dtype="<u4").tobytes()) for x in ids[p.doc_id] if len(x) == p.doc_tokens}
        assert p.ids_crc32 in crcs
    assert end == sum(len(x) for xs in ids.values() for x in xs)
    per_doc = {}
    for p in pieces:
        per_doc.setdefault((p.doc_id, p.doc_tokens), []).append((p.start, p.length))
    for (doc, n), spans in per_doc.items():
        copies = sum(len(x) == n for x in ids[doc])
        assert sum(length for _, length in spans) == n * copies


@pytest.mark.parametrize("size", [5, 64, 2048])
def test_awkward_rows(spark, tokenizer, size):
    docs = clashing(documents(spark)).repartition(4)
    pieces = packing.pack(docs, size=size).collect()
    check(pieces, documents(spark).collect(), tokenizer, size)


def test_piece_ids_and_kept_columns(spark, tokenizer):
    docs = documents(spark)
    got = packing.pack(docs, keep=["source", "doc_id"], size=100, with_ids=True).collect()
    assert got[0].__fields__[:2] == ["source", "doc_id"]
    long = sorted((p.start, bytes(p.ids)) for p in got if p.doc_id == 8)
    assert np.frombuffer(b"".join(b for _, b in long), "<u4").tolist() == [*tokenizer.encode(LONG, add_special_tokens=False).ids, 1]
    assert all(zlib.crc32(bytes(p.ids)) == p.ids_crc32 for p in got)


def test_empty_table(spark):
    assert packing.pack(spark.createDataFrame([], DOCUMENTS)).count() == 0


def test_query_covers_all_documents(spark, sf_dir, tokenizer):
    from tenurelake.llm import catalog

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    check(catalog.op4_packing(spark, sf_dir).collect(), docs.collect(), tokenizer, 2048)


def packed_order(pieces):
    return [p.doc_id for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)) if p.start == 0]


def test_documents_follow_the_files_whatever_their_sizes(spark, tmp_path):
    """The scan deals the largest files out first, and several small ones to a task."""
    rows = [(i, f"word {i} " * (1 + 4000 * (i % 7 == 3)), "en", "a", 1) for i in range(120)]
    files = spark.createDataFrame(spark.sparkContext.parallelize(rows, 40), DOCUMENTS).sortWithinPartitions("doc_id")
    files.write.option("compression", "none").parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    assert [r.doc_id for r in docs.collect()] != list(range(120))
    assert packed_order(packing.pack(docs, size=64).collect()) == list(range(120))


def test_splits_of_one_file_follow_each_other(spark, tmp_path):
    rows = [(i, f"text {i} " * 300, "en", "a", 1) for i in range(400)]
    one = spark.createDataFrame(rows, DOCUMENTS).coalesce(1).sortWithinPartitions("doc_id")
    one.write.option("compression", "none").option("parquet.block.size", "65536").parquet(str(tmp_path / "docs"))
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100000")
    try:
        docs = spark.read.parquet(str(tmp_path / "docs"))
        assert docs.rdd.getNumPartitions() > 1
        assert packed_order(packing.pack(docs, size=64).collect()) == list(range(400))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)


def test_rows_from_no_file_follow_the_partitions(spark):
    docs = spark.range(50).selectExpr("id as doc_id", "concat('text ', id) as text").repartition(5)
    assert packed_order(packing.pack(docs, size=64).collect()) == [r.doc_id for r in docs.collect()]


def test_nothing_is_shuffled_but_totals(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumn("part", F.lit(1))
    plan = packing.pack(docs)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan
