"""Phrase collocations by streams of counts in prefix and in suffix order.

The texts become chunks of word numbers, and each level of phrases (1 to 4 words) is
counted from the level below: a phrase can only be frequent if the phrases that it begins
and ends with are, so windows over infrequent ones are never built, and nothing else is
left out.  A chunk's counts leave it as compressed runs, sorted by phrase and dealt to
buckets; a bucket's runs are merged in that order.  The frequent phrases of all levels form one stream of counts.  Sorted by their
words from the front, a phrase stands behind all phrases that it begins with, so the last
count seen of each length is its left part; sorted from the back, its right part.  Each
phrase also tells the phrase one word shorter, at either side, that it extends it.  Both
streams are merged in one order, without a hash table of phrases.
"""

from __future__ import annotations

import itertools
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martloom.llm.shared import blank, stored
from martloom.operators.ranges import in_ranges, last_seen
from martloom.operators.windows import rank_top, top_n

LEAST = 30
MOST_WORDS = 4
BEST = 2000
SCALE = 2_000_000
CHUNK_WORDS = 2_000_000
CHUNK_LANGS = 1000
BUCKET_TEXT = 64_000_000  # bytes of text whose words one task merges
BUCKET_PAIRS = 4_000_000  # counts that one task merges
LOCAL = 1 << 29  # numbers of phrases inside a chunk
SEQUENCE = 1 << 14  # chunks of a task
BREAK = b"\xff"  # in no UTF-8 text
PIECE_ENDS = b".,;:!?\n\v\f\r"
FOLD = bytes.maketrans(PIECE_ENDS, BREAK * len(PIECE_ENDS))
# start: in a run of words the byte where their spellings begin, in a run of phrases its first number.
RUNS = "chunk long, bucket int, lang string, start int, n long, run binary, codes binary"
FOUND = "chunk long, entries binary, lang string, word string, gid long, head long, last long, f long"


def _squeezed(numbers: np.ndarray) -> bytes:
    """Numbers compressed byte by byte: all first bytes, then all second ones, and so on."""
    planes = numbers.view(np.uint8).reshape(-1, numbers.itemsize).T
    return zstandard.ZstdCompressor(3).compress(planes.tobytes())


def _spread(data: bytes, kind: type) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def _packed(*columns: np.ndarray) -> bytes:
    """Columns of the same length as compressed differences, small ones of either sign as small numbers."""
    steps = np.concatenate([np.diff(np.asarray(c, np.int64), prepend=0) for c in columns])
    return _squeezed((steps << 1) ^ (steps >> 63))


def _unpacked(data: bytes, columns: int) -> np.ndarray:
    folded = _spread(data, np.uint64)
    steps = (folded >> np.uint64(1)).astype(np.int64) ^ -(folded & np.uint64(1)).astype(np.int64)
    return np.cumsum(steps.reshape(columns, -1), axis=1)


def _table(schema: str, **columns: list) -> pa.Table:
    """Rows with the given columns, null in the others."""
    kinds = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    n = len(next(iter(columns.values())))
    fields = [f.split() for f in schema.split(", ")]
    return pa.table({name: pa.array(columns[name], kinds[kind]) if name in columns else pa.nulls(n, kinds[kind]) for name, kind in fields})


class _Chunk:
    """Word numbers of texts one after the other; a break (0) ends each piece."""

    def __init__(self):
        self.number = itertools.count(1)
        self.words: dict[str, dict[bytes, int]] = {}
        self.codes: list[np.ndarray] = []
        self.size = 0

    def add(self, lang: str, text: bytes) -> None:
        words = text.lower().translate(FOLD).replace(BREAK, b" \xff ").split()  # lower: A-Z only
        if lang not in self.words:
            self.words[lang] = defaultdict(self.number.__next__, {BREAK: 0})
        self.codes.append(np.fromiter(map(self.words[lang].__getitem__, words), np.int32, len(words)))
        self.codes.append(np.zeros(1, np.int32))
        self.size += len(words) + 1

    def rows(self, chunk: int, buckets: int) -> Iterator[pa.Table]:
        """A run of counted words for each lang and bucket, and the numbers of all words."""
        codes = np.concatenate(self.codes)
        counts = np.bincount(codes)
        for lang, words in self.words.items():
            del words[BREAK]
            dealt: dict[int, list[bytes]] = defaultdict(list)
            for word in words:
                dealt[zlib.crc32(word) % buckets].append(word)
            for bucket, part in dealt.items():
                local = np.fromiter(map(words.__getitem__, part), np.int64, len(part))
                run = _packed(local, counts[local])
                spelled = zstandard.ZstdCompressor(3).compress(b"\n".join(part))
                yield _table(RUNS, chunk=[chunk], bucket=[bucket], lang=[lang], start=[len(run)], n=[int(counts[local].sum())],
                             run=[run + spelled])
        yield _table(RUNS, chunk=[chunk], n=[len(codes)], codes=[_squeezed(codes)])


def _chunks(docs: DataFrame, chunk_words: int, bucket_text: int) -> DataFrame:
    """Runs of counted words by chunk, lang and bucket, and each chunk's codes."""
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), blank(F.col("text")).cast("binary").alias("text"))
    buckets = (texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // bucket_text + 1

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, sequence, chunk = TaskContext.get().partitionId(), 0, _Chunk()
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
                chunk.add(lang, text.as_py())
                if chunk.size >= chunk_words or len(chunk.words) >= CHUNK_LANGS:
                    if sequence + 1 >= SEQUENCE:
                        raise RuntimeError("a task of so many chunks needs more input partitions")
                    for table in chunk.rows(task * SEQUENCE + sequence, buckets):
                        yield from table.to_batches()
                    sequence, chunk = sequence + 1, _Chunk()
        if chunk.size:
            for table in chunk.rows(task * SEQUENCE + sequence, buckets):
                yield from table.to_batches()

    return stored(texts.mapInArrow(read, RUNS), "words")


def _merge_words(least: int) -> Callable[[pa.Table], pa.Table]:
    """Words of a bucket that occur `least` times: their places for each chunk, and a row for each."""

    def merge(runs: pa.Table) -> pa.Table:
        totals: dict[tuple[str, bytes], list[int]] = {}  # count, first place
        read = []
        for row in runs.select(["chunk", "lang", "start", "run"]).to_batches(max_chunksize=1):
            chunk, lang, start, run = (c[0].as_py() for c in row.columns)
            local, counts = _unpacked(run[:start], 2)
            words = zstandard.ZstdDecompressor().decompress(run[start:]).split(b"\n")
            read.append((chunk, lang, local, words))
            for place, count, word in zip((chunk * LOCAL + local).tolist(), counts.tolist(), words):
                total = totals.setdefault((lang, word), [0, place])
                total[0] += count
                total[1] = min(total[1], place)
        frequent = {k: v for k, v in totals.items() if v[0] >= least}
        chunks, entries = [], []
        for chunk, lang, local, words in read:
            hits = [(i, known[1]) for i, w in zip(local.tolist(), words) if (known := frequent.get((lang, w)))]
            if hits:
                places, gids = np.array(hits, np.int64).T
                chunks.append(chunk)
                entries.append(_packed(places, gids, gids))
        once = list(frequent.items())
        return pa.concat_tables([
            _table(FOUND, chunk=chunks, entries=entries),
            _table(FOUND, lang=[k[0] for k, _ in once], word=pa.array([k[1] for k, _ in once], pa.binary()).cast(pa.string()),
                   gid=[v[1] for _, v in once], f=[v[0] for _, v in once])])

    return merge


def _merge_pairs(least: int) -> Callable[[pa.Table], pa.Table]:
    """The same for phrases: runs sorted by (head, last), merged in that order."""

    def merge(runs: pa.Table) -> pa.Table:
        parts, places = [], []
        for row in runs.select(["chunk", "start", "run"]).to_batches(max_chunksize=1):
            chunk, start, run = (c[0].as_py() for c in row.columns)
            parts.append(_unpacked(run, 3))
            places.append(chunk * LOCAL + start + np.arange(parts[-1].shape[1]))
        (head, last, counts), place = np.concatenate(parts, axis=1), np.concatenate(places)
        order = np.lexsort((last, head))
        head, last, counts, place = head[order], last[order], counts[order], place[order]
        first = np.flatnonzero(np.concatenate([[True], (np.diff(head) != 0) | (np.diff(last) != 0)]))
        total, gid = np.add.reduceat(counts, first), np.minimum.reduceat(place, first)
        kept = total >= least
        size = np.diff(np.append(first, len(head)))
        rows = np.repeat(kept, size)
        at, known, ending = place[rows], np.repeat(gid, size)[rows], last[rows]
        order = np.argsort(at)
        at, known, ending = at[order], known[order], ending[order]
        chunks, begins = np.unique(at // LOCAL, return_index=True)
        entries = [_packed(at[a:b] % LOCAL, known[a:b], ending[a:b]) for a, b in zip(begins, [*begins[1:], len(at)])]
        once = first[kept]
        return pa.concat_tables([
            _table(FOUND, chunk=chunks, entries=entries),
            _table(FOUND, gid=gid[kept], head=head[once], last=last[once], f=total[kept])])

    return merge


def _longer(buckets: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Windows one word longer than the frequent phrases of a chunk, as runs sorted by
    (head, last): the phrase without its last word, and that word."""

    def extend(codes: pa.Table, frequent: pa.Table) -> pa.Table:
        none = _table(RUNS, chunk=[])
        if not codes.num_rows or not frequent.num_rows:
            return none
        chunk = codes.column("chunk")[0].as_py()
        seen = _spread(codes.column("codes")[0].as_py(), np.int32)
        local, gid, last = np.concatenate([_unpacked(e.as_py(), 3) for e in frequent.column("entries")], axis=1)
        index = np.full(max(seen.max(initial=0), local.max()) + 2, -1, np.int32)
        index[local] = np.arange(len(local), dtype=np.int32)
        seen = index[seen]  # -1, the last place, stays -1
        first, second = seen[:-1], seen[1:]
        whole = (first >= 0) & (second >= 0)
        pair = first[whole].astype(np.int64) * len(local) + second[whole]
        if not len(pair):
            return none
        pair, which, counts = np.unique(pair, return_inverse=True, return_counts=True)
        head, end = gid[pair // len(local)], last[pair % len(local)]
        mixed = (head.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ (end.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
        bucket = ((mixed >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
        order = np.lexsort((end, head, bucket))
        place = np.empty(len(order), np.int32)
        place[order] = np.arange(len(order), dtype=np.int32)
        head, end, counts, bucket = head[order], end[order], counts[order], bucket[order]
        dealt, begins = np.unique(bucket, return_index=True)
        cuts = list(zip(begins, [*begins[1:], len(bucket)]))
        runs = np.full(len(first), -1, np.int32)
        runs[whole] = place[which]
        kept = whole.copy()
        kept[1:] |= whole[:-1]  # one break after each run
        following = runs[kept]
        return pa.concat_tables([
            _table(RUNS, chunk=[chunk] * len(dealt), bucket=dealt.astype(np.int32), start=begins.astype(np.int32),
                   run=[_packed(head[a:b], end[a:b], counts[a:b]) for a, b in cuts]),
            _table(RUNS, chunk=[chunk], n=[len(following)], codes=[_squeezed(following)])])

    return extend


def _streams(docs: DataFrame, least: int, most_words: int, chunk_words: int, bucket_text: int,
             bucket_pairs: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """All words counted by lang; the frequent words; the frequent phrases of all lengths."""
    level = _chunks(docs, chunk_words, bucket_text)
    totals = level.filter("codes is null").groupBy("lang").agg(F.sum("n").alias("n"))
    runs = level.filter("codes is null").groupBy("bucket")
    found = stored(runs.applyInArrow(_merge_words(least), FOUND), "frequent")
    once = found.filter("entries is null")
    words = once.select(F.col("gid").alias("w1"), "word")
    none = [F.lit(-1).cast("long").alias(k) for k in _keys(most_words)]
    below = once.select("lang", F.col("gid").alias("w1"), *none[1:], F.lit(1).alias("n_words"), "f", "gid")
    phrases = below.drop("gid")
    for n in range(2, most_words + 1):
        codes = level.filter("codes is not null").select("chunk", "n", "codes")
        buckets = (codes.agg(F.sum("n")).first()[0] or 0) // bucket_pairs + 1
        entries = found.filter("entries is not null").select("chunk", "entries")
        level = stored(codes.groupBy("chunk").cogroup(entries.groupBy("chunk")).applyInArrow(_longer(buckets), RUNS), "windows")
        found = stored(level.filter("codes is null").groupBy("bucket").applyInArrow(_merge_pairs(least), FOUND), "frequent")
        heads = below.select("lang", *_keys(n - 1), F.col("gid").alias("head"))
        below = stored(found.filter("entries is null").select("gid", "head", F.col("last").alias(f"w{n}"), "f").join(heads, "head").select(
            "lang", *_keys(n), *none[n:], F.lit(n).alias("n_words"), "f", "gid"), "phrases")
        phrases = phrases.unionByName(below.drop("gid"))
    return totals, words, phrases


def _keys(most_words: int) -> list[str]:
    return [f"w{k}" for k in range(1, most_words + 1)]


def _parts(stream: DataFrame, order: list[str], name: str, longest: int) -> DataFrame:
    """With the counts of the phrases of 1 to `longest` words that a phrase begins with in this order."""
    counts = {f"{name}{k}": F.when(F.col("n_words") == k, F.col("f")) for k in range(1, longest + 1)}
    return last_seen(in_ranges(stream, order), order, counts)


def _merged(phrases: DataFrame, most_words: int) -> DataFrame:
    """Phrases of two words and more with the counts of their parts and whether a phrase
    one word longer makes up four fifths of them."""
    keys = _keys(most_words)
    longest = most_words - 1
    back = [f"b{k}" for k in range(1, most_words + 1)]
    size = F.col("n_words")
    # The words from the back, then -1 for those that are not there.
    reverse = [F.coalesce(*[F.when(size == n, F.col(f"w{n - k + 1}")) for n in range(k, most_words + 1)], F.lit(-1)).alias(b)
               for k, b in enumerate(back, 1)]
    prefix = _parts(phrases, keys, "l", longest)
    suffix = _parts(phrases.select("*", *reverse), back, "r", longest)

    def shorter(stream: DataFrame, side: str, skipped: int) -> DataFrame:
        """Phrases that a longer one extends and mostly is, one row for each at most."""
        part = F.coalesce(*[F.when(size == k + 1, F.col(f"{side}{k}")) for k in range(1, longest + 1)])
        mostly = stream.filter("n_words > 2").filter(F.col("f") * 5 >= part * 4)
        kept = [F.when(size > k, F.col(f"w{k + skipped}")).otherwise(-1).alias(f"w{k}") for k in range(1, most_words)]
        kept.append(F.lit(-1).cast("long").alias(f"w{most_words}"))
        return mostly.select(*kept, F.lit(True).alias("covered"))

    def told(stream: DataFrame, side: str) -> DataFrame:
        return stream.filter("n_words > 1").select(
            *keys, "lang", "n_words", "f", *[f"{side}{k}" for k in range(1, longest + 1)])

    streams = told(prefix, "l").unionByName(told(suffix, "r"), True).unionByName(shorter(prefix, "l", 0), True).unionByName(
        shorter(suffix, "r", 1), True)
    # Dealt and sorted by the words: rows of a phrase are neighbours, and the grouping needs no other exchange.
    return streams.repartitionByRange(*keys).sortWithinPartitions(*keys).groupBy(*keys).agg(
        *[F.max(c).alias(c) for c in ("lang", "n_words", "f", *[f"{s}{k}" for s in "lr" for k in range(1, longest + 1)])],
        F.coalesce(F.bool_or("covered"), F.lit(False)).alias("covered"))


def _worst_cut(longest: int) -> Column:
    """(score, k, l, r) of the cut with the lowest score; the arithmetic is decimal."""
    cuts = []
    for n in range(2, longest + 2):
        each = []
        for k in range(1, n):
            left, right = F.col(f"l{k}"), F.col(f"r{n - k}")
            score = F.expr(f"(cast({SCALE} as decimal(38, 0)) * cast(f as decimal(20, 0))) div cast(l{k} + r{n - k} as decimal(20, 0))")
            each.append(F.struct(score.alias("score"), F.lit(k).alias("k"), left.alias("l"), right.alias("r")))
        cuts.append(F.when(F.col("n_words") == n, F.array_min(F.array(*each))))
    return F.coalesce(*cuts)


def collocations(docs: DataFrame, least: int = LEAST, most_words: int = MOST_WORDS, best: int = BEST,
                 chunk_words: int = CHUNK_WORDS, bucket_text: int = BUCKET_TEXT,
                 bucket_pairs: int = BUCKET_PAIRS) -> DataFrame:
    """The best phrases of each lang: lang, rank, phrase, a, l, r, n, score.

    A null text is empty, a null lang is `und`; repeated rows count again, whatever their
    doc_id; other columns are not read.  Texts of any length count whole: a task holds the
    word numbers of one chunk, which ends with a text, or the counts of one bucket, whose
    number grows with the input.  Ties go by count, then by phrase.
    Without a frequent phrase there are no rows.
    """
    totals, words, phrases = _streams(docs, least, most_words, chunk_words, bucket_text, bucket_pairs)
    scored = _merged(phrases, most_words).filter("not covered").withColumn("cut", _worst_cut(most_words - 1)).select(
        "lang", *_keys(most_words), "n_words", F.col("f").alias("a"), "cut.l", "cut.r", "cut.score")
    order = [F.col("score").desc(), F.col("a").desc()]
    # All that tie with the last one stay until their words are known.
    top = stored(rank_top(scored, ["lang"], order, best), "top")
    spelled = top.select("*", F.posexplode(F.slice(F.array(*_keys(most_words)), 1, F.col("n_words"))).alias("at", "w")).join(
        words.withColumnRenamed("w1", "w"), "w")
    texts = spelled.groupBy("lang", *_keys(most_words), "a", "l", "r", "score").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda x: x["word"]), " ").alias("phrase"))
    ranked = top_n(texts, ["lang"], [*order, F.col("phrase")], best)
    w = Window.partitionBy("lang").orderBy(*order, "phrase")
    return ranked.withColumn("rank", F.row_number().over(w).cast("long")).join(totals, "lang").select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score")


ORACLE = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, list_filter(string_split_regex(unnest(string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')), '[\x20\x09]+'),
        lambda x: x <> '') AS words
    FROM documents),
totals AS (SELECT lang, CAST(sum(len(words)) AS BIGINT) AS n FROM pieces GROUP BY lang),
frequent_words AS (
    SELECT lang, w FROM (SELECT lang, unnest(words) AS w FROM pieces) GROUP BY lang, w HAVING count(*) >= 30),
grams AS (
    SELECT lang, size, words[i : i + size - 1] AS p
    FROM (SELECT lang, words, size, unnest(range(1, len(words) - size + 2)) AS i
          FROM pieces, (VALUES (1), (2), (3), (4)) AS s(size) WHERE len(words) >= size)),
f AS (SELECT lang, size, p, count(*) AS a FROM grams GROUP BY lang, size, p HAVING count(*) >= 30),
cuts AS (
    SELECT c.lang, c.p, c.a, k, l.a AS l, r.a AS r,
        CAST((CAST(2000000 AS HUGEINT) * c.a) // (l.a + r.a) AS BIGINT) AS score
    FROM (SELECT *, unnest(range(1, size)) AS k FROM f WHERE size > 1) c
    JOIN f l ON l.lang = c.lang AND l.p = c.p[1 : k]
    JOIN f r ON r.lang = c.lang AND r.p = c.p[k + 1 : c.size]),
lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1),
covered AS (
    SELECT DISTINCT lang, x.p AS p
    FROM (SELECT y.lang, y.a AS longer, y.p[i : i + m - 1] AS p
          FROM (SELECT *, unnest(range(2, size)) AS m FROM f WHERE size > 2) y, range(1, 4) AS t(i) WHERE i + m - 1 <= y.size) x
    JOIN f USING (lang, p) WHERE 100 * x.longer >= 80 * f.a)
SELECT lang, rank, phrase, a, l, r, n, score FROM (
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(p, ' ')) AS rank,
        array_to_string(p, ' ') AS phrase, a, l, r, n, score
    FROM lowest JOIN totals USING (lang) ANTI JOIN covered USING (lang, p))
WHERE rank <= 2000
"""
