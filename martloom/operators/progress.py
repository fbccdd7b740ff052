"""Load progress: one-row watermark tables and what changed since."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def newest(inputs: Mapping[str, DataFrame], load_col: str = "load_dttm") -> dt.datetime | None:
    """Largest load time over all inputs: one row per input reaches the driver."""
    parts = [df.agg(F.max(F.col(load_col).cast("timestamp_ntz")).alias("at")) for df in inputs.values()]
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p)
    return union.agg(F.max("at")).first()[0]


def advance(watermark: dt.datetime | None, seen: dt.datetime | None) -> dt.datetime | None:
    """The later of the two; an empty load leaves the watermark alone."""
    known = [w for w in (watermark, seen) if w is not None]
    return max(known) if known else None
