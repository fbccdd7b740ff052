"""Money columns: decimal in, decimal out, rounded half up."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values: (rating below which the tier applies, share of the total, least payout).
PAYOUT_TIERS = (
    ("4.0", "0.05", "100"),
    ("4.5", "0.07", "150"),
    ("4.9", "0.08", "175"),
)
# Share and least payout above the last tier.
PAYOUT_TOP = ("0.10", "200")
# Fee on the order total, part of the tips that is paid out.
PROCESSING_FEE = "0.25"
TIPS_SHARE = "0.95"
# Fixed value: what the platform keeps of a sale.
PLATFORM_SHARE = "0.1"


def money(col: Column, precision: int = 14, scale: int = 2) -> Column:
    return col.cast(f"decimal({precision},{scale})")


def sum_money(col: Column, scale: int = 2) -> Column:
    """Exact sum of amounts with up to 18 digits before the point, in decimals: no
    overflow below 10^28 units of the last place, and no way through a double."""
    return F.sum(col.cast(f"decimal({18 + scale},{scale})")).cast(f"decimal(28,{scale})")


def dec(text: str) -> Column:
    """Exact decimal literal."""
    whole, _, frac = text.partition(".")
    return F.lit(text).cast(f"decimal({len(whole.lstrip('-')) + len(frac)},{len(frac)})")


def mean_of(total: Column, n: Column, digits: int = 2) -> Column:
    """total / n with sixteen decimals kept before rounding; NULL for an empty group."""
    return F.round(
        F.try_divide(total.cast("decimal(24,2)"), n.cast("decimal(13,0)")), digits
    )


def price_net(price: Column, discount_pct: Column) -> Column:
    """Price after a percentage discount; no discount counts as zero."""
    return price * (1 - F.coalesce(discount_pct, F.lit(0)) / 100)


def price_gross(price: Column, discount_pct: Column) -> Column:
    """Price before a percentage discount; NULL at 100 %."""
    return F.try_divide(price, 1 - F.coalesce(discount_pct, F.lit(0)) / 100)


def signed_amount(amount: Column, status: Column, negative_status: str = "refunded") -> Column:
    """Refunds count against the total; a missing status does not."""
    return F.when(status == negative_status, -amount).otherwise(amount)


def platform_split(total: Column, share: str = PLATFORM_SHARE) -> tuple[Column, Column]:
    """(seller part, platform part) of a total."""
    kept = total * dec(share)
    return total - kept, kept


def tiered(
    rate: Column,
    total: Column,
    tiers: Sequence[tuple[str, str, str]] = PAYOUT_TIERS,
    top: tuple[str, str] = PAYOUT_TOP,
) -> Column:
    """Payout by rating tier with a floor; NULL without a rating or a total."""
    total = total.cast("decimal(24,2)")

    def pay(share: str, floor: str) -> Column:
        return F.greatest((total * dec(share)).cast("decimal(28,4)"), F.lit(floor).cast("decimal(28,4)"))

    result = F.when(rate.isNull() | total.isNull(), F.lit(None).cast("decimal(28,4)"))
    for below, share, floor in tiers:
        result = result.when(rate < dec(below), pay(share, floor))
    return result.otherwise(pay(*top))


def ratio(a: Column, b: Column) -> Column:
    """a / b as double, NULL when b is zero."""
    return F.try_divide(a.cast("double"), b.cast("double"))
