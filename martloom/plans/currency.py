"""Daily metrics of transactions in one target currency."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import on_day
from ..functions.money import sum_money
from ..operators.merge import unique_on

# Status that counts, smallest account number that is not a test.
DONE = "done"
FIRST_REAL_ACCOUNT = 1


def daily_metrics(transactions: DataFrame, currencies: DataFrame, target_currency: int, day: str | None = None) -> DataFrame:
    """Day and currency: total in the target currency, transactions, active accounts and
    transactions per account.  Days without a quote give no row; two quotes of one
    currency on one day are an error.

    Accounts are folded first; the rate is the same for a whole (day, currency), so it
    is applied to the sums and no transaction is ever joined.
    """
    rows = transactions.filter((F.col("status") == DONE) & (F.col("account_number_from") >= FIRST_REAL_ACCOUNT))
    if day is not None:
        rows = rows.filter(on_day(F.col("transaction_dt"), day))
    accounts = rows.groupBy(
        F.to_date("transaction_dt").alias("date_update"),
        F.col("currency_code").alias("currency_from"),
        "account_number_from",
    ).agg(sum_money(F.col("amount")).alias("_sum"), F.count(F.lit(1)).alias("_n"))
    daily = accounts.groupBy("date_update", "currency_from").agg(
        F.sum("_sum").cast("decimal(24,2)").alias("_sum"),
        F.sum("_n").alias("cnt_transactions"),
        F.count(F.lit(1)).alias("cnt_accounts_make_transactions"),
    )
    rates = currencies.filter(F.col("currency_code_with") == target_currency).select(
        F.to_date("date_update").alias("date_update"),
        F.col("currency_code").alias("currency_from"),
        F.col("currency_with_div").cast("decimal(10,5)").alias("_rate"),
    )
    rates = unique_on(rates, ["date_update", "currency_from"], "rate table")
    n, accounts_n = F.col("cnt_transactions"), F.col("cnt_accounts_make_transactions")
    return daily.join(rates, ["date_update", "currency_from"]).select(
        "date_update", "currency_from",
        (F.col("_sum") * F.col("_rate")).alias("amount_total"),
        "cnt_transactions",
        F.try_divide(n.cast("double"), accounts_n.cast("double")).alias("avg_transactions_per_account"),
        "cnt_accounts_make_transactions",
    )
