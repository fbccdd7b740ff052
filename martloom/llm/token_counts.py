"""Token counts of flat, unindexed token files by a separator scan."""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martloom.llm.shared import mounted, shared_folder, stored
from martloom.llm.tokens import encode, new_file, pieces_of, width

END_ID = 50256  # <|endoftext|> of the byte-level vocabulary; no text encodes to it
BLOCK_IDS = 1 << 20
BLOCKS_PER_TASK = 8
BATCH_ROWS = 2000
NO_ID = -(1 << 63)  # stands for null


def write_flat_files(docs: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """Encode every whole text (null: empty) into flat files without any index: ids,
    and the end id after each document.  Special tokens' strings count as ordinary
    text, so `end_id` must be a special token of the vocabulary.  Returns the list of
    files: place (the number of its input partition, so the same input gives the same order), file, type, n_ids, and docs, a
    flat file of the doc_ids in the order in which they were written, n_docs of them.
    Each attempt of a task writes files of its own name; only the finished ones are listed.
    """
    folder = mounted(shared_folder(docs.sparkSession, "tokens"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, n_ids, n_docs = None, 0, 0
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_ROWS):
                if out is None:
                    known = pieces_of(tokenizer, plain_specials=True)
                    kind, name = width(known.tokenizer), new_file(folder, ".ids")
                    out, names = open(name, "wb"), open(name + ".docs", "wb")
                doc_ids = batch.column("doc_id").slice(at, BATCH_ROWS).cast(pa.int64()).fill_null(NO_ID)
                doc_ids.to_numpy().astype("<i8").tofile(names)
                n_docs += len(doc_ids)
                for ids in encode(known, batch.column("text").slice(at, BATCH_ROWS)):
                    out.write(ids.astype(kind, copy=False).tobytes())
                    out.write(np.array([end_id], kind).tobytes())
                    n_ids += len(ids) + 1
        if out is not None:
            out.close()
            names.close()
            yield pa.RecordBatch.from_pydict({
                "place": [TaskContext.get().partitionId()], "file": [name], "type": [kind], "n_ids": [n_ids],
                "docs": [name + ".docs"], "n_docs": [n_docs]})

    return stored(docs.select("doc_id", "text").mapInArrow(
        write, "place long, file string, type string, n_ids long, docs string, n_docs long"), "files")


def files_at(spark: SparkSession, paths: list[str], kind: str) -> DataFrame:
    """The same list for existing files, in this order."""
    rows = [(i, mounted(p), kind, os.path.getsize(mounted(p)) // np.dtype(kind).itemsize) for i, p in enumerate(paths)]
    return spark.createDataFrame(rows, "place long, file string, type string, n_ids long")


def with_doc_ids(counts: DataFrame, files: DataFrame) -> DataFrame:
    """The counts with the doc_id of each document; null where it was null.  The n-th document of
    the stream is the n-th of the lists of doc_ids, whose bases are a prefix sum over files."""
    before = Window.orderBy("place").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    lists = stored(files.select("docs", "n_docs", F.coalesce(F.sum("n_docs").over(before), F.lit(0)).alias("base")), "lists")

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for row in rows.itertuples():
                ids = np.memmap(row.docs, "<i8", "r", shape=row.n_docs)
                for at in range(0, row.n_docs, 100_000):
                    part = pd.Series(np.array(ids[at : at + 100_000]), dtype="Int64")
                    yield pd.DataFrame({"doc_no": row.base + at + np.arange(len(part)), "doc_id": part.mask(part == NO_ID)})

    named = lists.repartition(max(1, lists.count())).mapInPandas(read, "doc_no long, doc_id long")
    return counts.join(named, "doc_no", "left").select("doc_id", *counts.columns)


def count_tokens(files: DataFrame, end_id: int = END_ID, block_ids: int = BLOCK_IDS) -> DataFrame:
    """One row per document of the files, read as one stream in the order of `place`
    (else of their names): doc_no, file_no of its end, start (ids before it), n_tokens
    (without the end id), closed (false for ids after the last end id).

    Tasks search blocks of `block_ids` ids for the end id.  A block knows the documents
    that end in it, but not where its first one began: that is the last separator
    before the block, a running maximum over blocks, as the document number is a
    running sum.  Both scans run inside each file and over one row per file, so no
    task reads all blocks.  Documents may span blocks and files; empty documents count
    with 0 tokens; no files give no rows.
    """
    order = "place" if "place" in files.columns else "file"
    over_files = Window.orderBy(order)
    before = over_files.rowsBetween(Window.unboundedPreceding, -1)
    files = stored(files.filter("n_ids > 0").select(
        (F.row_number().over(over_files) - 1).cast("long").alias("file_no"), "file", "type", "n_ids",
        F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("file_start")), "ordered-files")
    blocks = files.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(
        f"(n_ids - 1) div {block_ids}"))).alias("block"))
    blocks = blocks.repartition(-(-blocks.count() // BLOCKS_PER_TASK) or 1)  # rows are small, blocks are not

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for row in rows.itertuples():
                first = row.block * block_ids
                ids = np.memmap(row.file, row.type, "r", offset=first * np.dtype(row.type).itemsize,
                                shape=min(block_ids, row.n_ids - first))
                found = np.flatnonzero(ids == end_id) + (row.file_start + first)
                yield pd.DataFrame({"file_no": [row.file_no], "block": [row.block], "ends": [found]})

    found = stored(blocks.mapInPandas(search, "file_no long, block long, ends array<long>"), "separators")
    in_file = Window.partitionBy("file_no").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    prior_files = Window.orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1)
    sums = found.select("file_no", "block", F.size("ends").alias("n"), F.element_at(
        F.when(F.size("ends") > 0, F.col("ends")), -1).alias("last"))
    bases = sums.groupBy("file_no").agg(F.sum("n").alias("n"), F.max("last").alias("last")).select(
        "file_no", F.coalesce(F.sum("n").over(prior_files), F.lit(0)).alias("file_docs"),
        F.max("last").over(prior_files).alias("file_last"))  # one row per file
    places = sums.select(
        "file_no", "block", F.coalesce(F.sum("n").over(in_file), F.lit(0)).alias("docs"),
        F.max("last").over(in_file).alias("last")).join(bases, "file_no").select(
        "file_no", "block", (F.col("docs") + F.col("file_docs")).alias("doc_base"),
        F.coalesce("last", "file_last", F.lit(-1).cast("long")).alias("last"))
    closed = found.join(places, ["file_no", "block"]).select(
        "file_no", "doc_base", "last", "ends", F.posexplode("ends").alias("i", "end")).withColumn(
        "start", F.when(F.col("i") == 0, F.col("last")).otherwise(F.expr("element_at(ends, greatest(i, 1))")) + 1
    ).select((F.col("doc_base") + F.col("i")).alias("doc_no"), "file_no", "start",
             (F.col("end") - F.col("start")).alias("n_tokens"), F.lit(True).alias("closed"))
    n_ids, n_files = files.agg(F.sum("n_ids"), F.count(F.lit(1))).first()
    n_docs, last = sums.agg(F.sum("n"), F.max("last")).first()
    last = -1 if last is None else last
    if not n_ids or last == n_ids - 1:
        return closed
    rest = [(n_docs, n_files - 1, last + 1, n_ids - last - 1, False)]  # ids after the last separator
    return closed.unionByName(files.sparkSession.createDataFrame(rest, closed.schema))
