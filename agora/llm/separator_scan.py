"""Token counts of flat token files that have no index.

A file is a stream of token ids in which every document ends in the end id.  It
is stored as fixed-length blocks (``file``, ``block``, ``ids``); documents start
and end anywhere and may run over many blocks.  Counting looks for the end id in
each block by itself, vectorised; then a prefix scan over the blocks of a file
gives each block the number of documents ended before it and the tokens already
read of the one still open, and the pieces are stitched.

A file is what one task wrote, so the scan over a file's blocks has a bounded
number of rows.  Beside the ids a block lists the ``doc_id`` of the documents
that start in it; they label the counts and take no part in counting.

Nulls: a null text is an empty document, a null ``doc_id`` is kept.  Repeated rows
are documents of their own.  An empty table gives no file and no counts.  What
follows the last end id of a file counts as a document without end, ``open``.
The end id's own string inside a text is encoded as ordinary text; an end id that texts could
produce is an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from agora.llm.common import batches
from agora.llm.encoding import worker_encoder

END_ID = 50256
BLOCK_TOKENS = 1 << 16
FILES = "file int, block long, width int, ids binary, doc_ids array<bigint>"
_PIECES = "file int, block long, n_ends long, first long, tail long, inner array<bigint>"


def _blocks(path: str, end_id: int, block_tokens: int):
    def rows(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(path, literal_specials=True)
        if end_id < encoder.tokenizer.get_vocab_size() and end_id not in encoder.tokenizer.get_added_tokens_decoder():
            raise ValueError(f"id {end_id} is an ordinary token of the vocabulary and cannot end documents")
        small = max(encoder.tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16
        kind, file = (np.uint16 if small else np.uint32), TaskContext.get().partitionId()
        end = np.array([end_id], np.uint32).tobytes()
        held: list[bytes] = []
        starts: list[tuple[int, int | None]] = []  # place in the stream of documents not yet written
        size = block = 0

        def cut(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held, size, block, starts
            ids = np.frombuffer(b"".join(held), np.uint32).astype(kind)
            at, origin = 0, block * block_tokens
            upto = 0
            while len(ids) - at >= block_tokens or (last and at < len(ids)):
                piece = ids[at : at + block_tokens]
                at += len(piece)
                before = upto
                while upto < len(starts) and starts[upto][0] < origin + at:
                    upto += 1
                row = [[file], [block], [kind().itemsize], [piece.tobytes()], [[k for _, k in starts[before:upto]]]]
                kinds = [pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.list_(pa.int64())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, t) for x, t in zip(row, kinds)], names=["file", "block", "width", "ids", "doc_ids"]
                )
                block += 1
            held, size, starts = [ids[at:].astype(np.uint32).tobytes()], len(ids) - at, starts[upto:]

        for batch in batches(source):
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                for key, ids in zip(part.column(0).to_pylist(), encoder.encode(part.column(1).to_pylist())):
                    starts.append((block * block_tokens + size, key))
                    held += (ids, end)
                    size += len(ids) // 4 + 1
                if size >= 16 * block_tokens:
                    yield from cut(False)
        yield from cut(True)

    return rows


def write_files(
    docs: DataFrame, tokenizer_path: str, folder: str, end_id: int = END_ID, block_tokens: int = BLOCK_TOKENS
) -> None:
    """Encode documents, each with the end id behind it, one file per task; nothing is shuffled."""
    rows = docs.select("doc_id", "text").mapInArrow(_blocks(tokenizer_path, end_id, block_tokens), FILES)
    rows.write.option("compression", "zstd").parquet(folder)


def _scan(end_id: int):
    def rows(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(source):
            out: list[dict] = []
            for file, block, width, raw in zip(*(batch.column(x).to_pylist() for x in ("file", "block", "width", "ids"))):
                ids = np.frombuffer(raw, np.uint16 if width == 2 else np.uint32)
                ends = np.flatnonzero(ids == end_id)
                some = len(ends) > 0
                out.append(
                    {
                        "file": file,
                        "block": block,
                        "n_ends": len(ends),
                        "first": int(ends[0]) if some else 0,
                        "tail": int(len(ids) - 1 - ends[-1]) if some else len(ids),
                        "inner": np.diff(ends) - 1,
                    }
                )
            schema = pa.schema(
                [("file", pa.int32()), ("block", pa.int64()), ("n_ends", pa.int64()), ("first", pa.int64()),
                 ("tail", pa.int64()), ("inner", pa.list_(pa.int64()))]
            )
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    return rows


def count_tokens(spark: SparkSession, folder: str, end_id: int = END_ID) -> DataFrame:
    """One row per document of the files: doc_id, file, place in the file, tokens without the end id, open."""
    files = spark.read.schema(FILES).parquet(folder)
    pieces = files.select("file", "block", "width", "ids").mapInArrow(_scan(end_id), _PIECES)
    order = Window.partitionBy("file").orderBy("block")
    upto_here = order.rowsBetween(Window.unboundedPreceding, 0)
    chain = Window.partitionBy("file", "chain").orderBy("block").rowsBetween(Window.unboundedPreceding, 0)
    stitched = (
        pieces.withColumn("ended", F.sum("n_ends").over(upto_here))
        .withColumn("chain", F.sum((F.col("n_ends") > 0).cast("long")).over(upto_here))
        .withColumn("open_after", F.sum("tail").over(chain))
        .withColumn("carry", F.coalesce(F.lag("open_after").over(order), F.lit(0)))
        .withColumn("is_last", F.lead("block").over(order).isNull())
    )
    closed = F.when(
        F.col("n_ends") > 0, F.concat(F.array(F.col("carry") + F.col("first")), F.col("inner"))
    ).otherwise(F.array().cast("array<bigint>"))
    hanging = F.col("is_last") & (F.col("open_after") > 0)
    sizes = F.when(hanging, F.concat(closed, F.array("open_after"))).otherwise(closed)
    counts = stitched.select(
        "file", (F.col("ended") - F.col("n_ends")).alias("base"), "n_ends", F.posexplode(sizes).alias("pos", "n_tokens")
    ).select("file", (F.col("base") + F.col("pos")).alias("row"), "n_tokens", (F.col("pos") >= F.col("n_ends")).alias("open"))
    listed = files.select("file", "block", "doc_ids")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    names = (
        listed.withColumn("base", F.coalesce(F.sum(F.size("doc_ids")).over(before), F.lit(0)))
        .select("file", "base", F.posexplode("doc_ids").alias("pos", "doc_id"))
        .select("file", (F.col("base") + F.col("pos")).alias("row"), "doc_id")
    )
    return counts.join(names, ["file", "row"], "left").select("doc_id", "n_tokens", "file", "row", "open")
