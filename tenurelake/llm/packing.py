"""Packing: documents end to end, cut into sequences of a fixed number of tokens.

The documents of all partitions form one long run of tokens. A first pass tokenises every document
once and writes its ids with their place inside their stretch, the rows that a task reads from one
split of a file, to the shared folder; the totals of the stretches, added up in order, give each
stretch's place in the run. The second pass reads the ids
back and cuts each document wherever the run crosses a multiple of the sequence length. A piece that
does not begin or end with its document is the record of such a boundary. Nothing is shuffled; only
one total per stretch is put in order.

Only the last sequence can be short, so there is next to no padding. Documents follow each other as in
the written table: by the names of its files (shorter names first, so that numbers with more digits
come later) and the order of rows inside them, whatever tasks the scan deals its splits to. Rows that
are not read straight from files follow the partitions of the input.

Defined results: a null or empty text is only its end token; a text of any length is cut as often as
needed; repeated ids are packed row by row; an empty table gives no rows.
"""

from __future__ import annotations

import json
import os
import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window as W, functions as F, types as T

from tenurelake.llm.common import free_name
from tenurelake.operators.scale import small
from tenurelake.session import shared_dir

SIZE = 2048
END_ID = 1
TOKENIZER = "byte_bpe_50k.json"
ROWS = 256  # documents whose ids are handed on at a time

# How byte-level tokenizer files of this kind split a text, and which characters they
# write the 256 bytes as (printable ones as themselves, the others from 256 on).
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]

# The pattern backtracks over white space, and the faster library gives up on runs of about a million.
LONG_SPACE = re.compile(r"(?<!\s)\s{10000}")

PROBE = "It's 12 words,\n\n  a\tb   caf\u00e9 \u65e5\u672c \U0001f600 x!!  \u3000end "


def _byte_of() -> dict[str, int]:
    rest = [b for b in range(256) if b not in PRINTABLE]
    return {chr(b): b for b in PRINTABLE} | {chr(256 + i): b for i, b in enumerate(rest)}


class Encoder:
    """Ids of whole texts by a byte-level tokenizer file.

    If the file numbers its tokens in the order of its merges, its vocabulary serves as ranks for a
    faster library, which is asked to agree on a probe first. Texts with the string of an added token
    go to the tokenizer itself, as do texts with a run of white space that the library's pattern could
    fail on, and all texts of any other file.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task per core
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.kind = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        added = {t.content for t in self.tokenizer.get_added_tokens_decoder().values()}
        self.added = re.compile("|".join(map(re.escape, sorted(added))) or r"(?!)")
        self.ranked = None
        of, model = _byte_of(), json.loads(self.tokenizer.to_str())["model"]
        plain = {t: i for t, i in model["vocab"].items() if t not in added}
        merged = [plain.get("".join(m) if isinstance(m, list) else m.replace(" ", "")) for m in model.get("merges", ())]
        if merged and None not in merged and merged == sorted(merged) and all(c in of for t in plain for c in t):
            ranks = {bytes(of[c] for c in t): i for t, i in plain.items()}
            self.ranked = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
            if self.ranked.encode_ordinary(PROBE) != self._exact(PROBE):
                self.ranked = None

    def _exact(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def encode(self, text: str) -> bytes:
        """The ids of ``text``, little-endian, two bytes each where that is enough."""
        own = self.ranked is None or self.added.search(text) or LONG_SPACE.search(text)
        ids = self._exact(text) if own else self.ranked.encode_ordinary(text)
        return np.array(ids, dtype=self.kind).tobytes()


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per worker process and file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _alike(files: pa.Array, splits: pa.Array) -> Iterator[tuple[int, int]]:
    """First row and number of rows of pieces of a batch with one file and split, at most ``ROWS`` long."""
    n = len(files)
    other = pc.or_(pc.not_equal(files[1:], files[:-1]), pc.not_equal(splits[1:], splits[:-1])) if n > 1 else pa.array([], pa.bool_())
    edges = [0, *(np.flatnonzero(other.to_numpy(zero_copy_only=False)) + 1).tolist(), n]
    for low, high in zip(edges, edges[1:]):
        for a in range(low, high, ROWS):
            yield a, min(ROWS, high - a)


def tokenise(docs: DataFrame, text: str, keep: list[str], path: str) -> tuple[str, str, T.StructType]:
    """Writes a table of the columns ``keep`` with each document's ids; returns its folder, the
    name of its struct of ids and its schema."""
    held = free_name(docs.select(*[f"`{c}`" for c in keep]), "_run")
    run = T.StructType([
        T.StructField("file", T.StringType()), T.StructField("split", T.LongType()),
        T.StructField("part", T.IntegerType()), T.StructField("stretch", T.IntegerType()),
        T.StructField("before", T.LongType()), T.StructField("n", T.LongType()), T.StructField("ids", T.BinaryType()),
    ])
    read = F.struct(F.col(f"`{text}`").alias("text"), F.input_file_name().alias("file"), F.input_file_block_start().alias("split"))
    source = docs.select(*[f"`{c}`" for c in keep], read.alias(held))
    schema = T.StructType([*source.schema.fields[:-1], T.StructField(held, run)])

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, part = encoder(path), TaskContext.get().partitionId()
        end = np.array([END_ID], dtype=coder.kind).tobytes()
        at, stretch, before = None, -1, 0
        for batch in batches:
            texts, files, splits = batch.column(batch.num_columns - 1).flatten()
            files = pc.fill_null(files, "")
            for a, rows in _alike(files, splits):  # rows of an Arrow batch can be many long texts
                if at != (at := (files[a].as_py(), splits[a].as_py())):
                    stretch, before = stretch + 1, 0
                ids = [coder.encode(t or "") + end for t in texts.slice(a, rows).to_pylist()]
                n = np.array([len(x) // coder.kind.itemsize for x in ids], dtype=np.int64)
                starts = before + np.cumsum(n) - n
                before += int(n.sum())
                same = [pa.array(np.full(rows, x, dtype=np.int32)) for x in (part, stretch)]
                run_array = pa.StructArray.from_arrays(
                    [files.slice(a, rows), splits.slice(a, rows), *same, pa.array(starts), pa.array(n), pa.array(ids, pa.binary())],
                    run.names,
                )
                kept = [batch.column(i).slice(a, rows) for i in range(batch.num_columns - 1)]
                yield pa.RecordBatch.from_arrays([*kept, run_array], [*keep, held])

    folder = f"{shared_dir(docs.sparkSession)}/tokens-{uuid.uuid4().hex}"
    source.mapInArrow(first, schema).write.option("compression", "zstd").parquet(folder)
    return folder, held, schema


def pack(
    docs: DataFrame, text: str = "text", keep: list[str] | None = None, size: int = SIZE, path: str | None = None,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: the columns ``keep`` of its document, ``start`` (ids of the document before
    it), ``length``, ``ids_crc32``, ``doc_tokens``, ``sequence_id`` and ``offset`` in the sequence, and
    on request ``ids`` (little-endian, unsigned 32 bits).

    ``path`` is a byte-level tokenizer file that every executor can open.
    """
    keep = ["doc_id"] if keep is None else keep
    path = path or tokenizer_path()
    folder, held, schema = tokenise(docs, text, keep, path)
    stored = docs.sparkSession.read.schema(schema).parquet(folder)
    of = {c: F.col(f"{held}.{c}") for c in ("part", "stretch", "file", "split", "n", "before", "ids")}
    totals = stored.groupBy(of["part"].alias("_part"), of["stretch"].alias("_stretch")).agg(
        F.min(of["file"]).alias("file"), F.min(of["split"]).alias("split"), F.sum(of["n"]).alias("n")
    )
    # one row per split of a file, as many as the driver lists to read them
    run = W.orderBy(F.length("file"), "file", "split", "_part", "_stretch")
    offsets = totals.select("_part", "_stretch", (F.sum("n").over(run) - F.col("n")).alias("offset"))
    placed = stored.join(small(offsets), (of["part"] == F.col("_part")) & (of["stretch"] == F.col("_stretch"))).select(
        *[f"`{c}`" for c in keep], of["ids"].alias("ids"), (F.col("offset") + of["before"]).alias("at")
    )
    names = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] + ["ids"] * with_ids
    result = T.StructType([
        *schema.fields[:-1], *[T.StructField(c, T.BinaryType() if c == "ids" else T.LongType()) for c in names]
    ])

    def second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = encoder(path).kind
        for batch in batches:
            row, rows = [], []
            ids_of, places = batch.column(batch.num_columns - 2), batch.column(batch.num_columns - 1)
            for i in range(batch.num_rows):
                ids, at = np.frombuffer(ids_of[i].as_buffer(), dtype=kind).astype("<u4"), places[i].as_py()
                start = 0
                while start < len(ids):
                    offset = (at + start) % size
                    piece = ids[start : start + size - offset].tobytes()
                    length = len(piece) // 4
                    row.append(i)
                    rows.append((start, length, zlib.crc32(piece), len(ids), (at + start) // size, offset) + (piece,) * with_ids)
                    start += length
            kept = [batch.column(k).take(pa.array(row, pa.int64())) for k in range(batch.num_columns - 2)]
            made = zip(*rows) if rows else [()] * len(names)
            new = [pa.array(v, pa.binary() if c == "ids" else pa.int64()) for c, v in zip(names, made)]
            yield pa.RecordBatch.from_arrays([*kept, *new], result.names)

    return placed.mapInArrow(second, result)
