"""Daily account turnovers (debit / credit, native and converted).

Plan shape (single date):

    postings --filter(date, pushed to the scan)--> legs (one scan, two rows per
    posting via inline(array(struct, struct)))
      --partial agg by account (map side)--> exchange(account_rk) --> final agg
      --join accounts valid on the date (shuffle on account_rk or broadcast
        when AQE measures it small) --left join rates valid on the date--> agg

Aggregating the legs per account *before* the joins makes the joins see at
most one row per account and day, so a hot account (one holding a large share
of all postings) is collapsed map-side instead of landing in one join task.
Summation is linear, so summing per account first and multiplying by the rate
afterwards is exact in decimals; the amount's width follows the type of the
rate, and casts and sums that overflow fail the job.  Overlapping rate rows fan out exactly as in
the reference's join: the converted amount sums over every matching rate and
the native amount is counted once per matching rate.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark.functions.dates import as_date, dyadic_cover, dyadic_path, month_bounds_py, valid_on
from tallyspark.functions.money import amount_for, checked, checked_sum, to_mart
from tallyspark.schemas import AMOUNT, RATE


def posting_legs(postings: DataFrame) -> DataFrame:
    """Credit leg and debit leg of every posting from a single scan."""
    null_amount = F.lit(None).cast(AMOUNT)
    amount = lambda c: F.col(c) if postings.schema[c].dataType == AMOUNT else checked(F.col(c), AMOUNT)
    return postings.select(F.inline(F.array(
        F.struct(F.col("oper_date"), F.col("credit_account_rk").alias("account_rk"),
                 amount("credit_amount").alias("credit_amount"), null_amount.alias("debet_amount")),
        F.struct(F.col("oper_date"), F.col("debet_account_rk").alias("account_rk"),
                 null_amount.alias("credit_amount"), amount("debet_amount").alias("debet_amount")),
    )))


def _accounts_valid(accounts: DataFrame, d: dt.date, start_in_month: bool) -> DataFrame:
    acc = accounts.filter(valid_on(d, "data_actual_date", "data_actual_end_date"))
    if start_in_month:
        ms, me = month_bounds_py(d)
        acc = acc.filter(F.col("data_actual_date").between(F.lit(ms), F.lit(me)))
    return acc.select("account_rk", "currency_rk")


def _converted_sums(joined: DataFrame, group: list[str]) -> DataFrame:
    kind = joined.schema["reduced_cource"].dataType
    kind = kind if isinstance(kind, T.DecimalType) else RATE
    given = F.col("reduced_cource") if kind == joined.schema["reduced_cource"].dataType else checked(F.col("reduced_cource"), kind)
    rate = F.coalesce(given, F.lit(1).cast(kind))
    amount = amount_for(kind)
    mart = lambda c: to_mart(F.coalesce(checked_sum(c), F.lit(0)))
    return joined.groupBy(*group).agg(
        mart(F.col("cre")).alias("credit_amount"),
        mart(checked(F.col("cre"), amount) * rate).alias("credit_amount_rub"),
        mart(F.col("deb")).alias("debet_amount"),
        mart(checked(F.col("deb"), amount) * rate).alias("debet_amount_rub"),
    )


def account_turnover(postings: DataFrame, accounts: DataFrame, rates: DataFrame, on_date,
                     account_start_in_month: bool = True) -> DataFrame:
    """Turnover of every account for one date (``dm_account_turnover_f`` rows).

    ``account_start_in_month=True`` keeps the reference rule that the account
    version must begin in the month of the date.
    """
    d = as_date(on_date)
    legs = posting_legs(postings.filter(F.col("oper_date") == F.lit(d)))
    per_account = (legs.filter(F.col("account_rk").isNotNull())
                   .groupBy("account_rk")
                   .agg(checked_sum(F.col("credit_amount")).alias("cre"), checked_sum(F.col("debet_amount")).alias("deb")))
    acc = _accounts_valid(accounts, d, account_start_in_month)
    rt = rates.filter(valid_on(d, "data_actual_date", "data_actual_end_date")).select("currency_rk", "reduced_cource")
    joined = per_account.join(acc, "account_rk").join(rt, "currency_rk", "left")
    return (_converted_sums(joined, ["account_rk"])
            .select(F.lit(d).alias("on_date"), "account_rk", "credit_amount", "credit_amount_rub",
                    "debet_amount", "debet_amount_rub"))


def rate_ranges(rates: DataFrame) -> DataFrame:
    """Each rate row once for each dyadic range of days of its interval: at most 44 rows, however long it is valid."""
    cover = dyadic_cover(F.col("data_actual_date"), F.col("data_actual_end_date"))
    return rates.select("currency_rk", "reduced_cource", F.inline(cover))


def rates_on_days(days: DataFrame, rates: DataFrame) -> DataFrame:
    """(currency_rk, oper_date, reduced_cource): every rate valid on each of the distinct (currency_rk, oper_date) ``days``.

    The interval condition is an equality on (currency_rk, level, bin): a day meets a rate in one range at most.
    Only the distinct days, never the rows behind them, are spread over the levels."""
    probes = days.select("currency_rk", "oper_date", F.inline(dyadic_path(F.col("oper_date"))))
    return probes.join(rate_ranges(rates), ["currency_rk", "level", "bin"]).select("currency_rk", "oper_date", "reduced_cource")


def with_rates(rows: DataFrame, rates: DataFrame) -> DataFrame:
    """``rows`` (currency_rk, oper_date, ...) with every rate valid on their date (left join; overlaps fan out)."""
    days = rows.select("currency_rk", "oper_date").filter("currency_rk IS NOT NULL AND oper_date IS NOT NULL").distinct()
    return rows.join(rates_on_days(days, rates), ["currency_rk", "oper_date"], "left")


def account_turnover_range(postings: DataFrame, accounts: DataFrame, rates: DataFrame, first_day=None,
                           last_day=None, account_start_in_month: bool = True) -> DataFrame:
    """Turnovers for every date of an inclusive range in one job.

    Equal, day by day, to calling ``account_turnover`` for each date; the date
    becomes a column instead of a literal, the account-version test becomes a
    per-row condition on an equi-join on ``account_rk``, and the rate interval
    becomes an equi-join on dyadic ranges of days, made once for each currency
    and date.  Without bounds every posting date takes part.
    """
    if first_day is not None:
        postings = postings.filter(F.col("oper_date") >= F.lit(as_date(first_day)))
        accounts = accounts.filter(F.col("data_actual_end_date") >= F.lit(as_date(first_day)))
    if last_day is not None:
        postings = postings.filter(F.col("oper_date") <= F.lit(as_date(last_day)))
        accounts = accounts.filter(F.col("data_actual_date") <= F.lit(as_date(last_day)))
    legs = posting_legs(postings)
    per_account = (legs.filter(F.col("account_rk").isNotNull() & F.col("oper_date").isNotNull())
                   .groupBy("account_rk", "oper_date")
                   .agg(checked_sum(F.col("credit_amount")).alias("cre"), checked_sum(F.col("debet_amount")).alias("deb")))
    acc = accounts.select("account_rk", "currency_rk",
                          F.col("data_actual_date").alias("acc_start"), F.col("data_actual_end_date").alias("acc_end"))
    cond = F.col("oper_date").between(F.col("acc_start"), F.col("acc_end"))
    if account_start_in_month:
        cond = cond & F.col("acc_start").between(F.trunc("oper_date", "MM"), F.last_day("oper_date"))
    joined = per_account.join(acc, "account_rk").filter(cond).drop("acc_start", "acc_end")
    return (_converted_sums(with_rates(joined, rates), ["oper_date", "account_rk"])
            .select(F.col("oper_date").alias("on_date"), "account_rk", "credit_amount", "credit_amount_rub",
                    "debet_amount", "debet_amount_rub"))


def rate_interval_join(postings: DataFrame, accounts: DataFrame, rates: DataFrame) -> DataFrame:
    """Every posting leg with the rate valid on its own date (left join; overlaps fan out).

    The interval is an equality on dyadic ranges of days, resolved once for
    each currency and date (``rates_on_days``).
    """
    legs = posting_legs(postings).filter(F.col("account_rk").isNotNull())
    acc = accounts.select("account_rk", "currency_rk", "data_actual_date", "data_actual_end_date")
    joined = legs.join(acc, "account_rk").filter(
        F.col("oper_date").between(F.col("data_actual_date"), F.col("data_actual_end_date")))
    return with_rates(joined, rates).select(
        "oper_date", "account_rk", "currency_rk", "credit_amount", "debet_amount", "reduced_cource")
