"""Mixing sources to target weights by Pfair scheduling."""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from fractions import Fraction
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.llm.shared import blank, shared_folder, stored

BLOCK_CHARS = 20_000
TEMPERATURE = 0.9
LEAST_SHARE = 4e-6
MAX_SOURCES = 1_000_000  # one row each on the driver
BROADCAST_SLOTS = 500_000  # about 50 MB; above that the rows meet their slots in a shuffle
CHUNK = 100_000
MAX_EPOCHS = 10
PLACES = pa.schema([("key", pa.string()), *[(c, pa.int64()) for c in ("turn", "release", "deadline", "place")]])


def whole_shares(weights: dict[str, float], least_share: float = LEAST_SHARE) -> dict[str, int]:
    """Whole numbers in exactly the proportions of the weights.  A weight under
    `least_share` of all is refused; with 0 none is."""
    if not weights or min(weights.values()) <= 0:
        raise ValueError("every source needs a weight above zero")
    if min(weights.values()) < least_share * math.fsum(weights.values()):
        raise ValueError(f"the smallest weight is under {least_share} of all")
    exact = {s: Fraction(w) for s, w in weights.items()}
    unit = math.lcm(*{w.denominator for w in exact.values()})
    shares = {s: int(w * unit) for s, w in exact.items()}
    common = math.gcd(*shares.values())
    return {s: n // common for s, n in shares.items()}


def pfair(shares: dict[str, int], blocks: dict[str, int]) -> Iterator[tuple[str, int, int, int, int]]:
    """(source, k, release, deadline, slot) of every slot until each source has run as
    many blocks as `blocks` says.

    Block k of a source with share n of the sum P is released at floor(k P / n) and due
    at ceil((k + 1) P / n).  Each slot goes to the released block that is due first,
    for equal deadlines to the smaller name.  Every block runs in its window, so after
    any number of slots each source is less than one block from its share.
    """
    period = sum(shares.values())
    waiting = [(0, s, 0) for s in sorted(shares)]
    ready: list[tuple[int, str, int, int]] = []
    unfinished, slot = len(shares), 0
    while unfinished:
        while waiting and waiting[0][0] <= slot:
            release, source, k = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(k + 1) * period // shares[source]), source, k, release))
        due, source, k, release = heapq.heappop(ready)
        yield source, k, release, due, slot
        unfinished -= k + 1 == blocks[source]
        heapq.heappush(waiting, ((k + 1) * period // shares[source], source, k + 1))
        slot += 1


def pfair_period(shares: dict[str, int]) -> list[tuple[str, int, int, int, int]]:
    """The slots of one period, after which every source has run its share."""
    return list(pfair(shares, shares))


def _stored_places(
    spark: SparkSession, shares: dict[str, int], blocks: dict[str, int], chunk: int = CHUNK,
) -> tuple[DataFrame, dict[str, int]]:
    """The slots of the run as a table, and the blocks each source runs.  The driver
    holds `chunk` slots at a time."""
    folder, ran, slots = shared_folder(spark, "places"), {}, pfair(shares, blocks)
    while part := list(islice(slots, chunk)):
        ran.update((source, k + 1) for source, k, *_ in part)
        spark.createDataFrame(pa.table([list(c) for c in zip(*part)], schema=PLACES)).write.mode("append").parquet(folder)
    return spark.read.schema("key string, turn long, release long, deadline long, place long").parquet(folder), ran


def _with_running_units(rows: DataFrame) -> DataFrame:
    """Adds `before`: the units of the same source above each row in its partition."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, total = None, 0
        for batch in batches:
            before = []
            for source, units in zip(batch.column("key").to_pylist(), batch.column("units").to_pylist()):
                if source != at:
                    at, total = source, 0
                before.append(total)
                total += units
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(before, pa.int64())],
                                             names=[*batch.schema.names, "before"])

    return rows.mapInArrow(add, T.StructType([*rows.schema.fields, T.StructField("before", T.LongType())]))


def schedule(
    docs: DataFrame, carry: list[str], weights: dict[str, float] | None = None, temperature: float = TEMPERATURE,
    block_chars: int = BLOCK_CHARS, max_epochs: int = MAX_EPOCHS, broadcast_slots: int = BROADCAST_SLOTS,
) -> DataFrame:
    """One row per place of a document in the mix: `row`, a struct of the columns `carry`
    of docs, and `mix`, a struct of source, epoch, block, release, deadline, slot and at.
    Order by slot and at.

    The documents of a source, by doc_id, are one stream of characters (at least one
    each), cut into blocks of `block_chars`; a document belongs to the block in which it
    starts.  Blocks are scheduled by `pfair`.  The mix ends when every block of
    every source has run once: no document is left out, and smaller sources start anew
    (epoch) until then; `weights` that need more than `max_epochs` are refused.
    Without weights, a source weighs as its blocks to the power `temperature`.
    Null and empty sources are one source; null texts are empty.

    Documents are dealt by ranges of (source, doc_id, text hash), which splits a hot
    source and repeated ids.  One row per source comes to the driver, which writes the
    slots of the whole run as a table; up to `broadcast_slots` of them are broadcast,
    more are joined by source and block.
    """
    spark = docs.sparkSession
    key = blank(F.col("source"))
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"), key.alias("key"), F.col("doc_id").alias("id"),
        F.xxhash64("text").alias("tie"), F.greatest(F.lit(1), F.length(blank(F.col("text")))).cast("long").alias("units"))
    dealt = rows.repartitionByRange("key", "id", "tie").sortWithinPartitions("key", "id", "tie").select(
        "row", "key", "units", F.spark_partition_id().cast("long").alias("part"))
    rows = stored(_with_running_units(dealt), "streams")
    parts = rows.groupBy("key", "part").agg(F.sum("units").alias("units"))
    above = Window.partitionBy("key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = stored(parts.select("key", "part", "units", F.coalesce(
        F.sum("units").over(above), F.lit(0)).alias("base")), "bases")  # one row per source and partition it is in
    sizes = {r["key"]: r["units"] for r in bases.groupBy("key").agg(F.sum("units").alias("units")).limit(
        MAX_SOURCES + 1).collect()}
    if not sizes:
        return rows.select("row", F.lit(None).cast(
            "struct<source:string,epoch:long,block:long,release:long,deadline:long,slot:long,at:long>").alias("mix"))
    if len(sizes) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    blocks = {s: -(-n // block_chars) for s, n in sizes.items()}
    if weights is None:
        weights = {s: n**temperature for s, n in blocks.items()}
    elif missing := sorted(set(sizes) - set(weights)):
        raise ValueError(f"no weight for {missing[:5]}")
    shares = whole_shares({s: weights[s] for s in sizes}, 0)
    period = sum(shares.values())
    end = max(-(-b * period // shares[s]) for s, b in blocks.items())
    if max(-(-(-(-end * shares[s] // period) + 1) // b) for s, b in blocks.items()) > max_epochs + 1:
        raise ValueError(f"the weights need more than {max_epochs} epochs of a source")
    places, ran = _stored_places(spark, shares, blocks)
    if sum(ran.values()) <= broadcast_slots:
        places = F.broadcast(places)
    sources = F.broadcast(spark.createDataFrame(
        [(s, b, -(-ran[s] // b)) for s, b in blocks.items()], "key string, blocks long, epochs long"))
    turns = rows.join(bases.select("key", "part", "base"), ["key", "part"]).join(sources, "key").select(
        "row", "key", "blocks", (F.col("base") + F.col("before")).alias("at"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("epochs") - 1)).alias("epoch"),
    ).withColumn("block", F.expr(f"at div {block_chars}")).withColumn("turn", F.col("epoch") * F.col("blocks") + F.col("block"))
    return turns.join(places, ["key", "turn"]).select("row", F.struct(
        F.col("key").alias("source"), "epoch", "block", "release", "deadline", F.col("place").alias("slot"), "at",
    ).alias("mix"))


def mixed(docs: DataFrame, weights: dict[str, float] | None = None, **options) -> DataFrame:
    """The columns of docs, a row for every place in the mix."""
    return schedule(docs, docs.columns, weights, **options).select("row.*")
