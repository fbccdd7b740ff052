"""Monthly reports of a craft market: one per customer, one per craftsman.

Inputs: fact(order_id, product_id, craftsman_id, customer_id, order_created_date,
order_completion_date, order_status, load_dttm) and three dimensions.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import age_years, days_between, period, trunc_to
from ..functions.money import mean_of, money, platform_split, sum_money
from ..operators.aggregates import median_of_counts, sum_if
from ..operators.filters import changed_since
from ..operators.joins import affected
from ..operators.progress import advance, newest
from ..operators.windows import top_n
from ..session import checkpointed

STATUSES = ("created", "in progress", "delivery", "done")


def _report(fact: DataFrame, owners: DataFrame, partners: DataFrame, products: DataFrame, as_of: str,
            owner: str, partner: str, attrs: Sequence[str], with_partner: bool) -> DataFrame:
    owner_id, partner_id = f"{owner}_id", f"{partner}_id"
    ages = partners.select(partner_id, age_years(F.col(f"{partner}_birthday"), as_of).alias("_age"),
                           F.lit(True).alias("_known"))
    goods = products.select("product_id", money(F.col("product_price")).alias("_price"),
                            F.col("product_type").alias("top_product_category"))
    lines = fact.dropna(subset=[owner_id, partner_id, "product_id"]).select(
        owner_id, partner_id, "product_id", "order_id", "order_status",
        trunc_to(F.col("order_created_date"), "month").alias("_month"),
        days_between(F.col("order_created_date"), F.col("order_completion_date")).alias("_days"),
    )
    # The joined lines feed the months and both tops, so they are made once.
    lines = checkpointed(lines.join(goods, "product_id").join(ages, partner_id, "left").drop("product_id"))
    status = F.col("order_status")
    total, n = F.col("_sum"), F.col("count_order")
    kept, platform = platform_split(total)
    statuses = {f"count_order_{s.replace(' ', '_')}": status == s for s in STATUSES}
    statuses["count_order_not_done"] = status != "done"
    # Folded per day count first: everything after works on those rows.
    by_days = lines.filter("_known").groupBy(owner_id, "_month", "_days").agg(
        sum_money(F.col("_price")).alias("_sum"),
        F.count("order_id").alias("count_order"),
        F.sum("_age").alias("_ages"),
        F.count("_age").alias("_aged"),
        *[sum_if(pred, F.lit(1)).alias(name) for name, pred in statuses.items()],
    )
    monthly = (
        median_of_counts(
            by_days, [owner_id, "_month"], "_days", "count_order", "median_time_order_completed",
            F.sum("_sum").cast("decimal(24,2)").alias("_sum"),
            *[F.sum(c).alias(c) for c in ("count_order", "_ages", "_aged", *statuses)],
        )
        .withColumns({
            "report_period": period(F.col("_month")),
            f"{owner}_money": kept.cast("decimal(24,2)"),
            "platform_money": platform.cast("decimal(24,2)"),
            "avg_price_order": mean_of(total, n),
            f"avg_age_{partner}": mean_of(F.col("_ages"), F.col("_aged")),
        })
        .drop("_sum", "_ages", "_aged", "_month")
    )

    by_type = lines.groupBy(owner_id, "top_product_category").agg(F.count("order_id").alias("_n"))
    tops = top_n(by_type, [owner_id], [F.col("_n").desc(), F.col("top_product_category")], 1).drop("_n")
    if with_partner:
        name = f"top_{partner}_id"
        by_partner = lines.groupBy(owner_id, F.col(partner_id).alias(name)).agg(F.count("order_id").alias("_n"))
        best = top_n(by_partner, [owner_id], [F.col("_n").desc(), F.col(name)], 1).drop("_n")
        tops = tops.join(best, owner_id)
    return monthly.join(tops, owner_id, "left").join(owners.select(owner_id, *attrs), owner_id)


def customer_report(fact: DataFrame, customers: DataFrame, craftsmen: DataFrame, products: DataFrame,
                    as_of: str) -> DataFrame:
    """Customer and month."""
    attrs = ["customer_name", "customer_address", "customer_birthday", "customer_email"]
    return _report(fact, customers, craftsmen, products, as_of, "customer", "craftsman", attrs, True)


def craftsman_report(fact: DataFrame, customers: DataFrame, craftsmen: DataFrame, products: DataFrame,
                     as_of: str) -> DataFrame:
    """Craftsman and month."""
    attrs = ["craftsman_name", "craftsman_address", "craftsman_birthday", "craftsman_email"]
    return _report(fact, craftsmen, customers, products, as_of, "craftsman", "customer", attrs, False)


def changed_owners(fact: DataFrame, customers: DataFrame, craftsmen: DataFrame, products: DataFrame,
                   owner_id: str, watermark) -> DataFrame:
    """Owners to recompute: their own row, one of their order lines, or a product or
    partner of theirs changed after the watermark.  One pass over the lines' keys."""
    dims = {"customer_id": customers, "craftsman_id": craftsmen, "product_id": products}
    rows = fact.select(*dims, F.col("load_dttm").alias("_loaded"))
    for key, dim in dims.items():
        marks = changed_since(dim, ["load_dttm"], watermark).select(key).distinct().withColumn(f"_{key}", F.lit(True))
        rows = rows.join(marks, key, "left")
    touched = [F.coalesce(F.col(f"_{key}"), F.lit(False)) for key in dims]
    fresh = F.lit(True) if watermark is None else F.col("_loaded") > F.lit(watermark).cast("timestamp_ntz")
    return rows.filter(reduce(or_, touched, F.coalesce(fresh, F.lit(False)))).select(owner_id).distinct()


def refresh_report(mart: DataFrame, report, fact: DataFrame, customers: DataFrame, craftsmen: DataFrame,
                   products: DataFrame, owner_id: str, watermark, as_of: str) -> DataFrame:
    """Mart after an increment; equals a full rebuild.

    All months of every changed owner are recomputed from the whole history and
    replace that owner's rows, so a new, changed or vanished month is right too.
    """
    owners = checkpointed(changed_owners(fact, customers, craftsmen, products, owner_id, watermark))
    fresh = report(affected(fact, owners, [owner_id]), customers, craftsmen, products, as_of)
    return mart.join(owners, owner_id, "left_anti").select(*mart.columns).unionByName(fresh.select(*mart.columns))


def next_watermark(watermark: dt.datetime | None, fact: DataFrame, *dims: DataFrame) -> dt.datetime | None:
    """Largest load time seen in all four inputs; unchanged when nothing is newer."""
    inputs = {str(i): d for i, d in enumerate((fact, *dims))}
    return advance(watermark, newest(inputs))
