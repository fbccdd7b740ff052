"""Language identification by a blended-spectrum presence kernel.

Two texts are as alike as they share different character n-grams (1 to 3 code points of
the lower-cased whole text), over the root of their numbers of n-grams.  Landmarks, a bounded
sample of the labelled texts, span the Nyström features; one kernel ridge regression for
each language against the rest is solved on a bounded sample; texts are scored in batches,
as presence matrix times landmark matrix times coefficients.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.llm.shared import stored
from martloom.operators.windows import top_n

FOLDS, HELD_OUT = 4, 2
LANDMARKS = 240
FIT_DOCS = 3_000
RIDGE = 1e-4
NO_LANGUAGE = "und"
BITS = 21  # of a code point
SEGMENT = 1 << 20  # code points looked at together
BATCH_DOCS = 128


@dataclass
class Model:
    """Landmarks as rows of a presence matrix over their n-grams, and what was learned."""

    slots: np.ndarray  # n-grams in an open-addressing table, -1 where free
    columns: np.ndarray  # the column of each slot
    landmarks: np.ndarray  # n-grams x landmarks, each landmark over the root of its n-grams
    weights: np.ndarray  # landmarks + 1 x languages
    langs: list[str]


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the lower-cased texts, each followed by a zero, and where each starts."""
    lowered = [t.lower().replace("\0", " ") for t in texts]
    starts = np.cumsum([0] + [len(t) + 1 for t in lowered])
    codes = np.frombuffer("".join(t + "\0" for t in lowered).encode("utf-32-le", "replace"), "<u4").astype(np.int64)
    return codes, starts


def _grams(codes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and n-grams of a stretch of code points; none reaches over a zero."""
    there = codes != 0
    gram = codes
    for n in (1, 2, 3):
        if n > 1:
            gram = (gram[:-1] << BITS) | codes[n - 1 :]
            there = there[:-1] & (codes[n - 1 :] != 0)
        at = np.flatnonzero(there)
        yield at, gram[at]


def _different(text: str) -> np.ndarray:
    """The different n-grams of a text, sorted."""
    codes, _ = _codes([text])
    parts = [np.zeros(0, np.int64)]
    for at in range(0, len(codes), SEGMENT):
        parts = [np.unique(np.concatenate([*parts, *(g for _, g in _grams(codes[at : at + SEGMENT + 2]))]))]
    return parts[0]


def _slot(grams: np.ndarray, size: int) -> np.ndarray:
    mixed = grams.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(64 - size.bit_length() + 1)).astype(np.int64)


def _table(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Open addressing by linear steps, at most a quarter full."""
    size = 1 << max(4, (4 * len(grams)).bit_length())
    slots, columns = np.full(size, -1, np.int64), np.zeros(size, np.int32)
    for column, (gram, slot) in enumerate(zip(grams.tolist(), _slot(grams, size).tolist())):
        while slots[slot] >= 0:
            slot = (slot + 1) % size
        slots[slot], columns[slot] = gram, column
    return slots, columns


def _look_up(model: Model, grams: np.ndarray) -> np.ndarray:
    """The column of each n-gram, -1 where no landmark has it."""
    size = len(model.slots)
    out = np.full(len(grams), -1, np.int32)
    open_, slot = np.arange(len(grams)), _slot(grams, size)
    while len(open_):
        found = model.slots[slot]
        hit = found == grams[open_]
        out[open_[hit]] = model.columns[slot[hit]]
        on = ~hit & (found >= 0)
        open_, slot = open_[on], (slot[on] + 1) % size
    return out


def _kernel(model: Model, texts: list[str]) -> np.ndarray:
    """Similarity of each text to each landmark."""
    present = np.zeros((len(texts), model.landmarks.shape[0]), np.float32)
    codes, starts = _codes(texts)
    for begin in range(0, len(codes), SEGMENT):
        for at, gram in _grams(codes[begin : begin + SEGMENT + 2]):
            column = _look_up(model, gram)
            known = column >= 0
            text = np.searchsorted(starts, at[known] + begin, "right") - 1
            present[text, column[known]] = 1
    sizes = np.maximum(present.sum(axis=1, keepdims=True), 1)
    return (present @ model.landmarks) / np.sqrt(sizes)


def _with_letter(texts: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.match_substring_regex(texts, r"\p{L}"), False).to_numpy(zero_copy_only=False)


def _kernels(model: Model, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of texts with a letter and their similarities, in batches of bounded size."""
    places = np.flatnonzero(_with_letter(texts))
    lengths = pc.utf8_length(texts).to_numpy(zero_copy_only=False)
    cuts, size = [0], 0
    for i, place in enumerate(places):
        if i - cuts[-1] >= BATCH_DOCS or (size and size + lengths[place] > SEGMENT):
            cuts.append(i)
            size = 0
        size += lengths[place]
    for a, b in zip(cuts, [*cuts[1:], len(places)]):
        if b > a:
            part = places[a:b]
            yield part, _kernel(model, texts.take(pa.array(part)).to_pylist())


def held_out(doc_id: Column) -> Column:
    """Documents whose lang is not looked at; a null id is none of them."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == HELD_OUT, F.lit(False))


def _sample(docs: DataFrame, size: int) -> DataFrame:
    """At most `size` labelled texts, languages in turn: doc_id, lang, place, text.  One
    row for each doc_id, so a repeated id does not fill the sample."""
    usable = docs.filter(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")) & F.col("lang").isNotNull()
                         & F.col("text").rlike(r"\p{L}"))
    ids = usable.groupBy("doc_id").agg(F.min("lang").alias("lang")).withColumn("turn", F.xxhash64("doc_id"))
    few = top_n(ids, ["lang"], ["turn", "doc_id"], size)
    each = few.withColumn("nth", F.row_number().over(Window.partitionBy("lang").orderBy("turn", "doc_id")))
    chosen = each.orderBy("nth", F.xxhash64("lang"), "lang").limit(size).select("doc_id", "lang", "nth")
    texts = usable.join(F.broadcast(stored(chosen, "chosen")), ["doc_id", "lang"])
    one = texts.groupBy("doc_id", "lang", "nth").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    return stored(one, "labelled-sample")


def fit(docs: DataFrame, landmarks: int = LANDMARKS, fit_docs: int = FIT_DOCS, ridge: float = RIDGE) -> Model | None:
    """Learn from documents (doc_id, text, lang) that are not held out; None without any.

    Bounds: `landmarks` and `fit_docs` labelled documents, languages in turn, chosen by a
    hash of doc_id.  Their n-grams and similarities, not their texts, come to the driver.
    """
    sample = _sample(docs.select("doc_id", "text", "lang"), fit_docs)
    order = [F.col("nth"), F.xxhash64("lang"), F.col("lang")]

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text in batch.column("text"):
                yield pa.RecordBatch.from_pydict({"grams": [_different(text.as_py()).astype("<i8").tobytes()]})

    spanned = [np.frombuffer(r["grams"], "<i8") for r in sample.orderBy(*order).limit(landmarks).select("text").mapInArrow(
        grams, "grams binary").collect()]
    if not spanned:
        return None
    vocabulary = np.unique(np.concatenate(spanned))
    matrix = np.zeros((len(vocabulary), len(spanned)), np.float32)
    for k, own in enumerate(spanned):
        matrix[np.searchsorted(vocabulary, own), k] = 1 / np.sqrt(len(own))
    slots, columns = _table(vocabulary)
    model = Model(slots, columns, matrix, np.zeros((0, 0)), [])
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column("lang")
            for part, kernel in _kernels(sent.value, batch.column("text")):
                yield pa.RecordBatch.from_arrays(
                    [langs.take(pa.array(part)), pa.array([row.tobytes() for row in kernel.astype("<f4")], pa.binary())], ["lang", "kernel"])

    rows = sample.select("text", "lang").mapInArrow(similar, "lang string, kernel binary").collect()
    langs = sorted({r["lang"] for r in rows})
    kernel = np.array([np.frombuffer(r["kernel"], "<f4") for r in rows], np.float64)
    kernel = np.column_stack([kernel, np.ones(len(kernel))])  # the last column is the intercept
    target = np.where(np.array([[r["lang"] == lang for lang in langs] for r in rows]), 1.0, -1.0)
    among = np.zeros((kernel.shape[1], kernel.shape[1]))
    shared = (matrix > 0).astype(np.float64)
    sizes = np.sqrt(shared.sum(axis=0))
    among[:-1, :-1] = (shared.T @ shared) / np.outer(sizes, sizes)
    among += np.eye(len(among)) * 1e-6
    weights = np.linalg.solve(kernel.T @ kernel + ridge * len(kernel) * among, kernel.T @ target)
    return Model(slots, columns, matrix, weights.astype(np.float32), langs)


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row.

    `und` with score 0 for a null text, a text without a letter, or if nothing was
    learned; ties go to the language first in sorted order.  Repeated rows stay, other
    columns are not read, and texts of any length count whole.
    """
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    if model is None:
        return rows.select("doc_id", "held_out", F.lit(NO_LANGUAGE).alias("lang_pred"), F.lit(0.0).alias("score"))
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for batch in batches:
            texts = batch.column("text")
            langs, scores = np.full(len(texts), NO_LANGUAGE, object), np.zeros(len(texts))
            for part, kernel in _kernels(known, texts):
                values = kernel @ known.weights[:-1] + known.weights[-1]
                best = values.argmax(axis=1)
                langs[part] = np.array(known.langs, object)[best]
                scores[part] = np.clip((values[np.arange(len(best)), best] + 1) / 2, 0, 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(langs.tolist(), pa.string()), pa.array(scores)],
                ["doc_id", "held_out", "lang_pred", "score"])

    schema = T.StructType([rows.schema["doc_id"], T.StructField("held_out", T.BooleanType()),
                           T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return rows.mapInArrow(score, schema)
