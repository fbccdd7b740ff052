"""Flat files of token ids with 64-bit document offsets, memory-mapped.

One part per partition, in the order of the documents, each part three flat files of
little-endian numbers: `ids` (unsigned 16 or 32 bits, the smallest that holds the
vocabulary; every document ends with the end id), `offsets` (signed 64 bits: the place
of each document's first id in the whole corpus, then the place after its last) and
`docs` (signed 64 bits: doc_id; the smallest number stands for null).
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martloom.llm.shared import mounted, shared_folder, stored
from martloom.llm.tokens import encode, new_file, pieces_of, width

END_ID = 0
NO_ID = -(1 << 63)
BATCH_ROWS = 2000


def _write_ids(docs: DataFrame, folder: str, tokenizer: str, end_id: int) -> DataFrame:
    """Ids and doc ids of each partition; a row (part, file, type, n_docs, n_ids) for each.

    An attempt writes files of its own name, so a repeated task leaves the files of
    others alone; only rows of finished tasks name the files that count.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, part, name = None, None, ""
        n_docs = n_ids = 0
        ids_file = docs_file = sizes_file = None
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_ROWS):
                rows = batch.slice(at, BATCH_ROWS)
                if known is None:
                    known, part = pieces_of(tokenizer), rows.column("part")[0].as_py()
                    kind = width(known.tokenizer)
                    name = new_file(folder, "")
                    ids_file, docs_file, sizes_file = (open(name + end, "wb") for end in (".ids", ".docs", ".sizes"))
                end, found, sizes = np.array([end_id], kind), [], []
                for ids in encode(known, rows.column("text")):
                    found += [ids, end]
                    sizes.append(len(ids) + 1)
                np.concatenate(found).astype(kind, copy=False).tofile(ids_file)
                docs_file.write(rows.column("doc_id").cast(pa.int64()).fill_null(NO_ID).to_numpy().astype("<i8").tobytes())
                sizes_file.write(np.array(sizes, "<i8").tobytes())
                n_docs, n_ids = n_docs + len(sizes), n_ids + sum(sizes)
        if known is not None:
            for file in (ids_file, docs_file, sizes_file):
                file.close()
            yield pa.RecordBatch.from_pydict(
                {"part": [part], "file": [name], "type": [kind], "n_docs": [n_docs], "n_ids": [n_ids]})

    return docs.withColumn("part", F.spark_partition_id().cast("long")).select("part", "doc_id", "text").mapInArrow(
        write, "part long, file string, type string, n_docs long, n_ids long")


def _apart(parts: DataFrame) -> DataFrame:
    """A task for each part: its row is small, its files are not."""
    return parts.repartition(max(1, parts.count()))


def _write_offsets(parts: DataFrame) -> DataFrame:
    """The offsets file of each part: sizes added up from the part's base."""

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            names = []
            for row in rows.itertuples():
                name = new_file(row.file.rpartition("/")[0], ".offsets")
                sizes = np.memmap(row.file + ".sizes", "<i8", "r")
                with open(name, "wb") as out:
                    np.array([row.base], "<i8").tofile(out)
                    at = row.base
                    for k in range(0, len(sizes), 1 << 20):
                        ends = at + np.cumsum(sizes[k : k + (1 << 20)])
                        ends.astype("<i8").tofile(out)
                        at = int(ends[-1])
                names.append(name)
            yield rows.assign(offsets=names)

    schema = ", ".join(f"{n} {t}" for n, t in parts.dtypes)
    return _apart(parts).mapInPandas(write, f"{schema}, offsets string")


def write_token_files(docs: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """Encode every whole text (null: empty) and write the corpus in ascending doc_id
    order, null ids first; repeated ids are neighbours.  Returns the list of parts:
    part, file, type, n_docs, n_ids, base, offsets.

    Documents are dealt by ranges of doc_id (and of a text hash, so that a repeated id
    does not fill one task); partition bases are the prefix sum of the parts' ids.
    """
    spark = docs.sparkSession
    folder = mounted(shared_folder(spark, "corpus"))
    ordered = docs.select("doc_id", "text").withColumn("tie", F.xxhash64("text")).repartitionByRange(
        "doc_id", "tie").sortWithinPartitions("doc_id", "tie").drop("tie")
    written = stored(_write_ids(ordered, folder, tokenizer, end_id), "parts")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per part
    parts = written.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0).cast("long")))
    return stored(_write_offsets(parts), "corpus-parts")


def read_token_files(parts: DataFrame) -> DataFrame:
    """One row per document, read from the memory-mapped files: doc_id, start (ids of
    all documents before it), n_tokens (with the end id), ids_crc32 (of its ids as
    little-endian unsigned 32-bit integers)."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for row in rows.itertuples():
                ids = np.memmap(row.file + ".ids", row.type, "r")
                docs = np.memmap(row.file + ".docs", "<i8", "r")
                offsets = np.memmap(row.offsets, "<i8", "r")
                base = int(offsets[0])
                for k in range(0, len(docs), BATCH_ROWS):
                    ends = np.array(offsets[k + 1 : k + 1 + BATCH_ROWS])
                    starts = np.array(offsets[k : k + len(ends)])
                    crc = [zlib.crc32(ids[a - base : b - base].astype("<u4")) for a, b in zip(starts, ends)]
                    name = pd.Series(docs[k : k + BATCH_ROWS], dtype="Int64")
                    yield pd.DataFrame({
                        "doc_id": name.mask(name == NO_ID), "start": starts, "n_tokens": ends - starts, "ids_crc32": np.array(crc, np.int64)})

    return _apart(parts).mapInPandas(read, "doc_id long, start long, n_tokens long, ids_crc32 long")
