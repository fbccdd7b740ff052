"""Toxicity by compression distance: zstandard dictionaries of toxic and ordinary text."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.llm.logistic import fit_logistic, margin, sigmoid
from martloom.llm.shared import stored

FOLDS = 5  # remainder 0 is held out
TOXIC_DOCS, ORDINARY_DOCS = 4_000, 10_000  # labelled documents to learn from, at most
CALIBRATION_DOCS = 4_000  # labelled documents to calibrate on, at most
TOXIC_WORDS, ORDINARY_WORDS = 5_000, 30_000  # words that go into the dictionaries, at most
TOXIC_BYTES, ORDINARY_BYTES = 4_096, 32_768
LEAST_CONTEXTS = 4
STEMS, LEAST_STEM_CONTEXTS = (4, 5, 6), 8  # first letters that count as a form of their own
LEAST_RATIO = 8.0
KNOWN_WORDS = 500_000  # gains a Python worker remembers; only speed depends on it
# Behind every window: zstandard starts no match in the last bytes of its input, and
# stores an input as it is where matches do not pay for their headers.
TAIL = b" the end of this window :"
LETTERS = re.compile(r"[^\W\d_]+")
FEATURES = 4


def fold(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % FOLDS


def words_of(text: str | None) -> list[str]:
    return LETTERS.findall((text or "").lower())


def _dictionary(samples: list[bytes], size: int) -> bytes:
    """A trained dictionary; samples too few to train on are the dictionary themselves."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:size]


def _samples(words: dict[str, int], repeats: int = 50) -> list[bytes]:
    """Samples of eight words each; a word is there as often as it was counted, in a
    fixed order.  Stems, which end with a hyphen, stand without an end."""
    bag = [(f" {w[:-1]}" if w[-1] == "-" else f" {w} ").encode() for w, n in words.items() for _ in range(min(n, repeats))]
    np.random.default_rng(0).shuffle(bag)
    return [b"".join(bag[i : i + 8]) for i in range(0, len(bag), 8)]


def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    options = zstandard.ZstdCompressionParameters(
        format=zstandard.FORMAT_ZSTD1_MAGICLESS, strategy=zstandard.STRATEGY_DFAST, window_log=17, hash_log=16,
        chain_log=16, min_match=4, write_content_size=0, write_checksum=0, write_dict_id=0)
    known = zstandard.ZstdCompressionDict(TAIL * 2 + dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    known.precompute_compress(compression_params=options)
    return zstandard.ZstdCompressor(dict_data=known, compression_params=options)


class Gains:
    """For windows of one word: bytes saved by the toxic against the ordinary dictionary."""

    def __init__(self, ordinary: bytes, toxic: bytes):
        self.compressors = _compressor(ordinary), _compressor(toxic)
        self.known: dict[str, int] = {}

    def of(self, words: list[str]) -> np.ndarray:
        if len(self.known) > KNOWN_WORDS:
            self.known.clear()
        ordinary, toxic = self.compressors
        for word in {w for w in words if w not in self.known}:
            window = b" " + word.encode() + b" " + TAIL
            self.known[word] = len(ordinary.compress(window)) - len(toxic.compress(window))
        return np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))


def features(gains: np.ndarray, threshold: float) -> list[float]:
    """Of a document: its largest gain, the second largest, and its windows over the
    threshold, as a share and as a logarithm of their number."""
    top = np.sort(gains)[-2:][::-1].tolist() + [0, 0]
    over = int((gains >= threshold).sum())
    return [max(top[0], -10), max(top[1], -10), 10 * over / (len(gains) + 10), float(np.log1p(over))]


@dataclass
class ToxicityModel:
    ordinary: bytes
    toxic: bytes
    threshold: float
    weights: np.ndarray


def _sample(labels: DataFrame, rows: int) -> DataFrame:
    """The labels whose ids have the smallest hashes: the same for the same table."""
    return labels.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)


def _labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents of a bounded list of labels, which is broadcast; of rows with one id the smallest text."""
    return docs.select("doc_id", "text").join(F.broadcast(labels), "doc_id").groupBy("doc_id").agg(
        F.min("toxic").alias("toxic"), F.min("text").alias("text"))


def fit(
    docs: DataFrame, labels: DataFrame, toxic_docs: int = TOXIC_DOCS, ordinary_docs: int = ORDINARY_DOCS,
    calibration_docs: int = CALIBRATION_DOCS,
) -> ToxicityModel:
    """Learn from labels of folds 1 to 4, at most so many documents.

    Folds 1 to 3 give the dictionaries.  Toxic documents are mostly ordinary prose, so
    the toxic dictionary is trained on the words, and stems of words, that toxic
    documents put into many contexts (previous words; copies repeat contexts and do not
    count) and ordinary ones hardly have; the ordinary dictionary on the frequent words of ordinary
    documents.  Words and counts are aggregated by Spark; a bounded list comes back.
    The window threshold is the gain that one ordinary window in 2,000 reaches, and fold 4 calibrates the scores.
    """
    own = fold(F.col("doc_id"))
    known = labels.filter("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    train = known.filter((own > 0) & (own < 4))
    chosen = stored(_sample(train.filter("toxic = 1"), toxic_docs).unionByName(
        _sample(train.filter("toxic = 0"), ordinary_docs)), "toxic-sample")

    def contexts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            out: list[tuple[str, str, int]] = []
            for text, toxic in zip(rows["text"], rows["toxic"]):
                words = words_of(text)
                out += [(w, p, toxic) for w, p in (set(zip(words, ["", *words])) if toxic else {(w, "") for w in words})]
                if len(out) > 100_000:
                    yield pd.DataFrame(out, columns=["word", "prior", "toxic"])
                    out = []
            yield pd.DataFrame(out, columns=["word", "prior", "toxic"])

    seen = _labelled(docs, chosen).mapInPandas(contexts, "word string, prior string, toxic int")
    counts = stored(seen.groupBy("word", "prior", "toxic").count().groupBy("word").agg(
        F.sum(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("contexts"),
        F.sum(F.when(F.col("toxic") == 0, F.col("count")).otherwise(0)).alias("ordinary")), "word-counts")
    n_docs = {r["toxic"]: r["count"] for r in chosen.groupBy("toxic").count().collect()}
    ratio = (F.col("contexts") / max(1, n_docs.get(1, 0))) / ((F.col("ordinary") + 0.5) / max(1, n_docs.get(0, 0)))
    stems = [F.when(F.length("word") > k, F.concat(F.substring("word", 1, k), F.lit("-"))) for k in STEMS]
    forms = counts.filter(F.length("word") >= 4).select(
        F.explode(F.array("word", *stems)).alias("word"), "contexts", "ordinary").filter("word is not null").groupBy(
        "word").agg(F.sum("contexts").alias("contexts"), F.sum("ordinary").alias("ordinary"))
    least = F.when(F.col("word").endswith("-"), LEAST_STEM_CONTEXTS).otherwise(LEAST_CONTEXTS)
    toxic = forms.filter((F.col("contexts") >= least) & (ratio >= LEAST_RATIO))
    toxic_words = {r["word"]: r["contexts"] for r in toxic.orderBy(F.desc("contexts"), "word").limit(TOXIC_WORDS).collect()}
    ordinary_words = {r["word"]: r["ordinary"] for r in counts.filter("ordinary > 0").orderBy(
        F.desc("ordinary"), "word").limit(ORDINARY_WORDS).collect() if r["word"] not in toxic_words}
    model = ToxicityModel(_dictionary(_samples(ordinary_words), ORDINARY_BYTES),
                          _dictionary(_samples(toxic_words), TOXIC_BYTES), 1.0, np.zeros(FEATURES + 1))
    gains = Gains(model.ordinary, model.toxic).of([*ordinary_words])
    weights = np.array([*ordinary_words.values()], np.float64)
    for threshold in range(1, 12):  # windows of ordinary text that gain so much
        model.threshold = threshold
        if not len(gains) or weights[gains >= threshold].sum() <= weights.sum() / 2000:
            break
    held = stored(_sample(known.filter(own == 4), calibration_docs), "toxic-calibration")
    rows = describe(_labelled(docs, held), model, ["toxic"]).select("toxic", "found").collect()
    if rows:
        x = np.array([r["found"] for r in rows], np.float64)
        model.weights = fit_logistic(x, np.array([r["toxic"] for r in rows], np.float64))
    return model


def describe(docs: DataFrame, model: ToxicityModel, keep: list[str]) -> DataFrame:
    """The columns `keep`, and the features of each whole text."""
    ordinary, toxic, threshold = model.ordinary, model.toxic, model.threshold

    @F.pandas_udf("array<double>")
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        gains = Gains(ordinary, toxic)
        for texts in batches:
            yield pd.Series([features(gains.of(words_of(t)), threshold) for t in texts], dtype=object)

    return docs.select(*[F.col(f"`{c}`") for c in keep], found(F.col("text")).alias("found"))


def score_toxicity(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.  Null and blank texts
    have no windows and the score of a text without any gain; a null doc_id is not held out."""
    weights = model.weights

    @F.pandas_udf("double")
    def score(found: pd.Series) -> pd.Series:
        return pd.Series(sigmoid(margin(np.array(found.tolist(), np.float64).reshape(-1, FEATURES), weights)))

    return describe(docs, model, ["doc_id"]).select(
        "doc_id", F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"),
        score(F.col("found")).alias("score")).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
