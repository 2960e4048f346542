"""Monthly ledger report (opening balance, turnovers, closing balance per ledger account).

Join shape: accounts valid on the date -> ledger accounts (computed key: the
first five characters of the account number) -> currency -> opening balance
(left, snapshot at the end of the previous month) -> rate valid on the date
(left) -> turnovers of the whole month (left, one row per turnover day).

The three account-keyed inputs (accounts, balances, turnovers) are joined on
``account_rk`` back to back, so one hash partitioning on ``account_rk`` serves
both joins; the ledger, currency and rate dimensions are broadcast when AQE
measures them under the threshold and shuffle-joined otherwise.  The final
grouping has few keys (chapter x ledger account x type) and aggregates
map-side.

Null rules kept from the reference:
* currency code NULL: both ``IN`` and ``NOT IN`` are unknown, so rub/val
  columns are 0 while ``balance_in_total`` takes the converted branch;
* missing rate: converted balances are NULL (turnovers were already converted
  with a default rate of 1 when the turnover mart was filled);
* missing opening balance: closing balances are NULL for that account;
* account type other than A/P: closing balance 0;
* ``r_`` columns are always 0;
* ``turnover_grain='day'`` (default) joins turnover rows per day, so an
  account with N turnover days counts its opening balance N times;
  ``'month'`` sums the month first.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.functions.dates import as_date, month_bounds_py, prev_month_end_py, valid_on
from tallyspark.functions.money import checked_sum, to_mart, zero_mart
from tallyspark.schemas import REPORT_COLUMNS, REPORT_MEASURES

# Currency codes that count as roubles.
ROUBLE_CODES = ("643", "810")


def _valid(df: DataFrame, d: dt.date, start: str, end: str) -> DataFrame:
    return df.filter(valid_on(d, start, end))


def opening_rows(accounts: DataFrame, currencies: DataFrame, ledger: DataFrame, balances: DataFrame,
                 rates: DataFrame, on_date, missing_balance: str = "null") -> DataFrame:
    """Accounts in the report with opening balance and rate (before the turnover join)."""
    d = as_date(on_date)
    opening_day = prev_month_end_py(d)
    led = (_valid(ledger, d, "start_date", "end_date")
           .select("chapter", F.col("ledger_account").cast("string").alias("ledger_key")))
    acc = (_valid(accounts, d, "data_actual_date", "data_actual_end_date")
           .select("account_rk", "account_number", "char_type", "currency_rk",
                   F.substring("account_number", 1, 5).alias("ledger_account")))
    cur = (_valid(currencies, d, "data_actual_date", "data_actual_end_date")
           .select("currency_rk", F.col("currency_code").alias("cur_code")))
    bal = (balances.filter(F.col("on_date") == F.lit(opening_day))
           .select("account_rk", "balance_out"))
    rt = (_valid(rates, d, "data_actual_date", "data_actual_end_date")
          .select("currency_rk", "reduced_cource"))
    rows = (acc.join(led, F.col("ledger_account") == F.col("ledger_key")).drop("ledger_key")
            .join(cur, "currency_rk")
            .join(bal, "account_rk", "left")
            .join(rt, "currency_rk", "left"))
    if missing_balance == "zero":
        rows = rows.withColumn("balance_out", F.coalesce(F.col("balance_out"), F.lit(0).cast("decimal(15,2)")))
    rub = F.col("cur_code").isin(*ROUBLE_CODES)
    b = F.col("balance_out")
    conv = b * F.col("reduced_cource")
    return rows.select(
        "account_rk", "chapter", "ledger_account", "char_type", "cur_code", "balance_out", "reduced_cource",
        F.when(rub, b).otherwise(F.lit(0)).alias("balance_in_rub"),
        F.when(~rub, conv).otherwise(F.lit(0)).alias("balance_in_val"),
        F.when(rub, b).otherwise(conv).alias("balance_in_total"),
    )


def report_rows(accounts: DataFrame, currencies: DataFrame, ledger: DataFrame, balances: DataFrame,
                rates: DataFrame, turnover: DataFrame, on_date, turnover_grain: str = "day",
                missing_balance: str = "null") -> DataFrame:
    """One row per account and turnover day of the month, with the eleven row measures."""
    d = as_date(on_date)
    ms, me = month_bounds_py(d)
    t = (turnover.filter(F.col("on_date").between(F.lit(ms), F.lit(me)))
         .select("account_rk", F.col("on_date").alias("turn_date"), "credit_amount_rub", "debet_amount_rub"))
    if turnover_grain == "month":
        t = t.groupBy("account_rk").agg(F.lit(None).cast("date").alias("turn_date"),
                                        F.sum("credit_amount_rub").alias("credit_amount_rub"),
                                        F.sum("debet_amount_rub").alias("debet_amount_rub"))
    elif turnover_grain != "day":
        raise ValueError(f"turnover_grain must be 'day' or 'month', not {turnover_grain!r}")
    base = opening_rows(accounts, currencies, ledger, balances, rates, d, missing_balance)
    rows = base.join(t, "account_rk", "left")

    rub = F.col("cur_code").isin(*ROUBLE_CODES)
    val = ~rub
    b = F.col("balance_out")
    conv = b * F.col("reduced_cource")
    deb = F.coalesce(F.col("debet_amount_rub"), F.lit(0))
    cre = F.coalesce(F.col("credit_amount_rub"), F.lit(0))
    active = F.col("char_type") == "A"
    passive = F.col("char_type") == "P"

    def split(amount: Column, name: str) -> list[Column]:
        return [F.when(rub, amount).otherwise(F.lit(0)).alias(f"{name}_rub"),
                F.when(val, amount).otherwise(F.lit(0)).alias(f"{name}_val"),
                amount.alias(f"{name}_total")]

    return rows.select(
        F.lit(ms).alias("from_date"), F.lit(me).alias("to_date"),
        "chapter", "ledger_account", F.col("char_type").alias("characteristic"),
        "account_rk", "turn_date", "cur_code",
        "balance_in_rub", "balance_in_val", "balance_in_total",
        *split(deb, "turn_deb"),
        *split(cre, "turn_cre"),
        F.when(rub & active, b - cre + deb).when(rub & passive, b + cre - deb)
        .otherwise(F.lit(0)).alias("balance_out_rub"),
        F.when(val & active, conv - cre + deb).when(val & passive, conv + cre - deb)
        .otherwise(F.lit(0)).alias("balance_out_val"),
    )


def ledger_report(accounts: DataFrame, currencies: DataFrame, ledger: DataFrame, balances: DataFrame,
                  rates: DataFrame, turnover: DataFrame, on_date, turnover_grain: str = "day",
                  missing_balance: str = "null") -> DataFrame:
    """``dm_f101_round_f`` rows for the month of ``on_date`` (29 columns)."""
    rows = report_rows(accounts, currencies, ledger, balances, rates, turnover, on_date,
                       turnover_grain, missing_balance)
    sums = [to_mart(checked_sum(F.col(m))).alias(m) for m in REPORT_MEASURES if m != "balance_out_total"]
    sums.append(to_mart(checked_sum(F.col("balance_out_rub") + F.col("balance_out_val"))).alias("balance_out_total"))
    agg = rows.groupBy("from_date", "to_date", "chapter", "ledger_account", "characteristic").agg(*sums)
    out = []
    for c in REPORT_COLUMNS:
        out.append(zero_mart().alias(c) if c.startswith("r_") else F.col(c))
    return agg.select(*out)


def opening_balance(accounts, currencies, ledger, balances, rates, on_date) -> DataFrame:
    """Per-account opening balance of the report (rub / val / total, converted at the date's rate)."""
    rows = opening_rows(accounts, currencies, ledger, balances, rates, on_date)
    return rows.select("account_rk", "ledger_account", "balance_out", "reduced_cource",
                       *[to_mart(F.col(c)).alias(c) for c in ("balance_in_rub", "balance_in_val", "balance_in_total")])


def closing_balance(accounts, currencies, ledger, balances, rates, turnover, on_date) -> DataFrame:
    """Per-account, per-turnover-day closing balance rows of the report (before grouping)."""
    rows = report_rows(accounts, currencies, ledger, balances, rates, turnover, on_date)
    return rows.select(
        "account_rk", "turn_date", "characteristic",
        to_mart(F.col("balance_out_rub")).alias("balance_out_rub"),
        to_mart(F.col("balance_out_val")).alias("balance_out_val"),
        to_mart(F.col("balance_out_rub") + F.col("balance_out_val")).alias("balance_out_total"))
