"""Quality classifier by co-training of a text view and a metadata view."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.logistic import fit_logistic, logit, margin, sigmoid
from martloom.llm.shared import stored
from martloom.operators.windows import top_n

LABELLED_DOCS = 8_000  # the bounded sample of labelled documents that is learned from
ROUNDS = 4
CONFIDENT = 0.97
PER_ROUND = 400  # rows that each view passes on in a round, the surest of all
THRESHOLD = 0.5
FOLDS = 5  # remainder 0 is held out
META_BINS = 64
# Kinds of bytes beside letters, digits and what lies beyond ASCII.
MARKS = (b" \t", b"\n", b".", b",", b"!?", b";:", b"'\"`", b"()[]{}", b"<>", b"|", b"-_", b"/\\", b"@#$%&*+=~^")


def _kinds() -> np.ndarray:
    kinds = np.zeros(256, np.int64)
    kinds[ord("a") : ord("z") + 1] = 1
    kinds[ord("A") : ord("Z") + 1] = 2
    kinds[ord("0") : ord("9") + 1] = 3
    kinds[128:] = 4
    for i, marks in enumerate(MARKS):
        for mark in marks:
            kinds[mark] = 5 + i
    return kinds


KINDS = _kinds()
N_KINDS = 5 + len(MARKS)
TEXT_FEATURES = N_KINDS * N_KINDS + 5
META_FEATURES = 2 * META_BINS + 24


def text_view(text: bytes | None) -> np.ndarray:
    """Shares of pairs of byte kinds (square roots), length, and repetition of words and lines."""
    text = text or b""
    out = np.zeros(TEXT_FEATURES, np.float32)
    pairs = np.zeros(N_KINDS * N_KINDS, np.int64)
    raw = np.frombuffer(text, np.uint8)
    for at in range(0, len(raw) - 1, 1 << 20):
        kinds = KINDS[raw[at : at + (1 << 20) + 1]]
        pairs += np.bincount(kinds[:-1] * N_KINDS + kinds[1:], minlength=len(pairs))
    out[: len(pairs)] = np.sqrt(pairs / max(1, pairs.sum()))
    words, lines = text.split(), text.split(b"\n")
    out[len(pairs) :] = (
        np.log1p(len(text)) / 10, len(set(words)) / max(1, len(words)), len(set(lines)) / len(lines),
        np.log1p(len(text) / max(1, len(words))) / 3, 1.0 if words else 0.0)
    return out


def meta_view(lang: str | None, source: str | None, n_chars: float | None) -> np.ndarray:
    """Hashed language and source, and the size class of n_chars (null has its own)."""
    out = np.zeros(META_FEATURES, np.float32)
    for i, value in enumerate((lang, source)):
        if value is not None:
            out[i * META_BINS + zlib.crc32(value.encode()) % META_BINS] = 1
    known = n_chars is not None and n_chars == n_chars
    out[2 * META_BINS + (min(22, int(np.log2(max(0, n_chars) + 1))) if known else 23)] = 1
    return out


@dataclass
class View:
    weights: np.ndarray
    scale: np.ndarray  # slope and intercept that turn margins into calibrated log odds

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        return np.clip(self.scale[0] * margin(x, self.weights) + self.scale[1], -12, 12)


@dataclass
class QualityModel:
    text: View
    meta: View
    prior: float

    def score(self, text: np.ndarray, meta: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Probabilities of good quality: of each view and of both, which count as
        independent given the class, so their log odds add up over the prior's."""
        a, b = self.text.log_odds(text), self.meta.log_odds(meta)
        return sigmoid(a), sigmoid(b), sigmoid(a + b - self.prior)


def _view(x: np.ndarray, y: np.ndarray, held: np.ndarray, held_y: np.ndarray) -> View:
    """Fit on x, calibrate on held-back labelled rows."""
    weights = fit_logistic(x, y, l2=0.5)
    if len(held_y) < 20 or len(set(held_y)) < 2:
        return View(weights, np.array([1.0, 0.0]))
    return View(weights, fit_logistic(margin(held, weights)[:, None], held_y, l2=0.01))


Picks = list[tuple[int, int, np.ndarray, np.ndarray]]


def confident(views: list[View], text: np.ndarray, meta: np.ndarray, counts: dict[int, int]) -> list[tuple[int, int, float, int]]:
    """(view, label, probability, row) of the rows of which a view is most sure: `counts` for
    each label at most, only those with a calibrated probability of CONFIDENT."""
    out = []
    for at, (view, x) in enumerate(zip(views, (text, meta))):
        p = sigmoid(view.log_odds(x))
        for label, sure in ((1, p), (0, 1 - p)):
            best = np.argsort(-sure, kind="stable")[: counts[label]]
            out += [(at, label, float(sure[i]), int(i)) for i in best if sure[i] >= CONFIDENT]
    return out


def co_train(text: np.ndarray, meta: np.ndarray, labels: np.ndarray, pick: Callable[[list[View], dict[int, int]], Picks],
             rounds: int = ROUNDS) -> QualityModel:
    """text, meta, labels (0, 1): the labelled rows, a quarter of which is held back to
    calibrate.  In each round both views are fitted and calibrated, and `pick` finds among
    the unlabelled rows those of which each view is most sure (as many of both classes as
    the labelled rows' share tells); each view's rows join the training set of the other."""
    every = np.arange(len(labels))
    held, train = every[::4], np.setdiff1d(every, every[::4])
    share = min(max(labels.mean(), 0.02), 0.98) if len(labels) else 0.5
    counts = {1: int(PER_ROUND * share), 0: max(1, int(PER_ROUND * (1 - share)))}
    views, learned = (text, meta), ([], [])
    for turn in range(rounds + 1):
        fitted = []
        for at, x in enumerate(views):
            extra = [row for _, *row in learned[at]]
            rows = np.concatenate([x[train], np.array([r[at] for r in extra], np.float32).reshape(-1, x.shape[1])])
            y = np.concatenate([labels[train], [label for label, *_ in learned[at]]]).astype(np.float64)
            fitted.append(_view(rows, y, x[held], labels[held].astype(np.float64)))
        if turn == rounds:
            break
        picked = pick(fitted, counts)
        if not picked:
            break
        for view, label, *row in picked:
            learned[1 - view].append((label, *row))
    return QualityModel(*fitted, float(logit(np.array([share]))[0]))


def _best_of_all(pool: DataFrame) -> Callable[[list[View], dict[int, int]], Picks]:
    """Picks over the whole table of unlabelled features: every row is scored, a task keeps
    its best ones, and the best of all come to the driver, so many in a round as co_train asks for."""
    taken: set[int] = set()

    def pick(views: list[View], counts: dict[int, int]) -> Picks:
        def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            best: dict[tuple[int, int], list] = {}
            for rows in batches:
                rows = rows[~rows["row_id"].isin(taken)]
                text, meta = _matrix(rows["text"], TEXT_FEATURES), _matrix(rows["meta"], META_FEATURES)
                ids, texts, metas = rows["row_id"].to_list(), rows["text"].to_list(), rows["meta"].to_list()
                for view, label, sure, i in confident(views, text, meta, counts):
                    best.setdefault((view, label), []).append((sure, ids[i], texts[i], metas[i]))
                for key, found in best.items():
                    best[key] = sorted(found, key=lambda f: (-f[0], f[1]))[: counts[key[1]]]
            yield pd.DataFrame([(*key, *f) for key, found in best.items() for f in found],
                               columns=["view", "label", "sure", "row_id", "text", "meta"])

        rows = top_n(pool.mapInPandas(score, "view int, label int, sure double, row_id long, text binary, meta binary"),
                     ["view", "label"], [F.col("sure").desc(), F.col("row_id")], max(counts.values())).collect()
        out: Picks = []
        seen: Counter[tuple[int, int]] = Counter()
        for r in sorted(rows, key=lambda r: (r["view"], r["label"], -r["sure"], r["row_id"])):
            seen[r["view"], r["label"]] += 1  # one that the other view took counts too: no less sure row takes its place
            if r["row_id"] not in taken and seen[r["view"], r["label"]] <= counts[r["label"]]:
                taken.add(r["row_id"])
                out.append((r["view"], r["label"], np.frombuffer(r["text"], np.float32), np.frombuffer(r["meta"], np.float32)))
        return out

    return pick


def _matrix(rows, width: int) -> np.ndarray:
    return np.array([np.frombuffer(r, np.float32) for r in rows], np.float32).reshape(-1, width)


def _column(docs: DataFrame, name: str, kind: str):
    return (F.col(f"`{name}`") if name in docs.columns else F.lit(None)).cast(kind)


def fit(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED_DOCS) -> QualityModel:
    """Learn from at most `labelled` labelled documents (folds 1 to 4, those whose ids have the
    smallest hashes, one row of each) and from all documents without a label, which
    every round looks through.  Features of equal rows count once; only those of labelled and
    of picked rows reach the driver."""
    known = labels.filter("doc_id is not null and quality is not null").groupBy("doc_id").agg(
        F.min("quality").alias("label"))
    train = known.filter(F.crc32(F.col("doc_id").cast("string")) % FOLDS > 0)
    chosen = stored(train.orderBy(F.xxhash64("doc_id"), "doc_id").limit(labelled), "quality-sample")

    def views(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for at in range(0, len(rows), 500):
                part = rows[at : at + 500]
                yield part[["doc_id", "tie"]].assign(
                    text=[text_view(t).tobytes() for t in part["bytes"]],
                    meta=[meta_view(*m).tobytes() for m in zip(part["lang"], part["source"], part["size"])])

    given = docs.filter("doc_id is not null").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("tie"), F.col("text").cast("binary").alias("bytes"),
        _column(docs, "lang", "string").alias("lang"), _column(docs, "source", "string").alias("source"),
        _column(docs, "n_chars", "double").alias("size"))
    features = stored(given.mapInPandas(views, "doc_id long, tie long, text binary, meta binary"), "features")
    # Equal rows, copies under many ids among them, count once; a hash is enough to tell rows apart.
    pool = features.join(known, "doc_id", "left_anti").withColumn("row_id", F.xxhash64("text", "meta"))
    pool = stored(pool.groupBy("row_id").agg(F.min(F.struct("text", "meta")).alias("row")).select("row_id", "row.*"), "unlabelled")
    rows = features.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(  # a bounded list
        F.min(F.struct("tie", "text", "meta", "label")).alias("row")).orderBy("doc_id").select("row.*").collect()
    return co_train(_matrix([r["text"] for r in rows], TEXT_FEATURES), _matrix([r["meta"] for r in rows], META_FEATURES),
                    np.array([r["label"] for r in rows], np.int64), _best_of_all(pool))


def score_quality(docs: DataFrame, model: QualityModel, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of docs: `row`, a struct of its columns, and `judged`, a struct of
    text_score, meta_score, score (probability of good quality) and keep (score >=
    threshold).  The whole text counts; null is the empty text, null metadata is a value
    of its own.  Rows are judged one by one, so repeated rows get the same score."""

    @F.pandas_udf("text_score double, meta_score double, score double, keep boolean")
    def judge(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, langs, sources, sizes in batches:
            out = []
            for at in range(0, len(texts), 500):
                part = slice(at, at + 500)
                text = np.array([text_view(t) for t in texts[part]])
                meta = np.array([meta_view(*m) for m in zip(langs[part], sources[part], sizes[part])])
                out.append(np.column_stack(model.score(text, meta)))
            scores = np.vstack(out) if out else np.zeros((0, 3))
            yield pd.DataFrame({"text_score": scores[:, 0], "meta_score": scores[:, 1], "score": scores[:, 2],
                                "keep": scores[:, 2] >= threshold})

    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), judge(
        F.col("text").cast("binary"), _column(docs, "lang", "string"), _column(docs, "source", "string"),
        _column(docs, "n_chars", "double")).alias("judged"))
