"""Star schema from four differently shaped sources."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.keys import hash_key
from ..operators.joins import lookup_keys
from ..operators.merge import keyed_merge
from ..operators.windows import top_n

CRAFTSMAN = ["craftsman_name", "craftsman_address", "craftsman_birthday", "craftsman_email"]
PRODUCT = ["product_name", "product_description", "product_type", "product_price"]
CUSTOMER = ["customer_name", "customer_address", "customer_birthday", "customer_email"]
ORDER = ["order_id", "order_created_date", "order_completion_date", "order_status"]
WIDE = ["craftsman_id", *CRAFTSMAN, "product_id", *PRODUCT, "customer_id", *CUSTOMER, *ORDER]


def unify_sources(sources: Sequence[DataFrame], columns: Sequence[str] | None = None) -> DataFrame:
    """UNION ALL by name to one wide schema; columns a source lacks are NULL."""
    wide = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), sources)
    return wide if columns is None else wide.select(*columns)


def join_split(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A source delivered in two tables."""
    return left.join(right, list(keys))


def dimension_rows(wide: DataFrame, id_col: str, natural_key: Sequence[str], attrs: Sequence[str], load_col: str) -> DataFrame:
    """One row per natural key, the newest load wins; the id is a hash of the key."""
    cols = [*dict.fromkeys([*natural_key, *attrs])]
    order = [F.col(load_col).desc(), *[F.col(c) for c in cols]]
    rows = top_n(wide.select(*cols, load_col).dropna(subset=list(natural_key)), natural_key, order, 1)
    return rows.select(hash_key(*[F.col(k) for k in natural_key]).alias(id_col), *cols, load_col)


def merge_dimension(target: DataFrame, wide: DataFrame, id_col: str, natural_key: Sequence[str],
                    attrs: Sequence[str], load_col: str = "load_dttm") -> DataFrame:
    """Type-1 dimension: known keys take the new attributes, new keys are inserted."""
    source = dimension_rows(wide, id_col, natural_key, attrs, load_col)
    update = [c for c in target.columns if c not in natural_key and c != id_col]
    return keyed_merge(target, source, natural_key, update, check=False)


def fact_rows(wide: DataFrame, dims: Mapping[str, tuple[DataFrame, Sequence[str]]], measures: Sequence[str]) -> DataFrame:
    """Order lines with the ids of their dimensions, found through the natural keys."""
    rows = wide
    for id_col, (dim, natural_key) in dims.items():
        rows = lookup_keys(rows.drop(id_col), dim.select(id_col, *natural_key), natural_key)
    return rows.select(*dims, *measures)


def merge_fact(target: DataFrame, rows: DataFrame, keys: Sequence[str], load_col: str = "load_dttm") -> DataFrame:
    """Fact lines by their business key; the newest load of a line wins."""
    order = [F.col(load_col).desc(), *[F.col(c) for c in rows.columns if c not in (*keys, load_col)]]
    return keyed_merge(target, top_n(rows, keys, order, 1), keys, check=False)
