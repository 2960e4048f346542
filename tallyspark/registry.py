"""Registered queries: name -> (spark, sf_dir) -> DataFrame, and their oracle SQL.

Every query reads the synthetic tables of ``sf_dir`` (through the derived
detail tables of ``tallyspark.sources.fixtures``) so its work grows with them.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyspark import oracle as O
from tallyspark.operators import turnover as TO
from tallyspark.sources.fixtures import REPORT_DATE, Fixtures

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


D15 = REPORT_DATE
D14 = dt.date(1998, 9, 14)
D16 = dt.date(1998, 9, 16)

# ---------------------------------------------------------------- turnover

def repr_day(d: dt.date) -> str:
    return f"DATE '{d.isoformat()}'"


def days_filter(days: list[dt.date] | None) -> str:
    """Posting-date condition: the listed days, or every posting when None."""
    if days is None:
        return "TRUE"
    return "oper_date IN (" + ", ".join(repr_day(d) for d in days) + ")"


def turnover_select(days: list[dt.date] | None) -> str:
    """Oracle turnover rows for the postings of ``days``: both legs of each posting, the
    account version valid on (and opened in the month of) the posting date, and every rate
    valid on that date (overlaps fan out)."""
    cond = days_filter(days)
    return f"""
SELECT leg.oper_date AS on_date, leg.account_rk,
       CAST(COALESCE(SUM(leg.cre), 0) AS DECIMAL(23,8)) AS credit_amount,
       CAST(COALESCE(SUM(leg.cre * COALESCE(fx.reduced_cource, 1)), 0) AS DECIMAL(23,8)) AS credit_amount_rub,
       CAST(COALESCE(SUM(leg.deb), 0) AS DECIMAL(23,8)) AS debet_amount,
       CAST(COALESCE(SUM(leg.deb * COALESCE(fx.reduced_cource, 1)), 0) AS DECIMAL(23,8)) AS debet_amount_rub
FROM (SELECT oper_date, credit_account_rk AS account_rk, credit_amount AS cre, CAST(NULL AS DECIMAL(15,2)) AS deb
      FROM ft_posting_f WHERE {cond}
      UNION ALL
      SELECT oper_date, debet_account_rk, NULL, debet_amount FROM ft_posting_f WHERE {cond}) leg
JOIN md_account_d acct
  ON acct.account_rk = leg.account_rk
 AND leg.oper_date BETWEEN acct.data_actual_date AND acct.data_actual_end_date
 AND acct.data_actual_date BETWEEN CAST(date_trunc('month', leg.oper_date) AS DATE) AND last_day(leg.oper_date)
LEFT JOIN md_exchange_rate_d fx
  ON fx.currency_rk = acct.currency_rk AND leg.oper_date BETWEEN fx.data_actual_date AND fx.data_actual_end_date
GROUP BY leg.oper_date, leg.account_rk"""


TURNOVER_VIEWS = ["ft_posting_f", "md_account_d", "md_exchange_rate_d"]


def turnover_sql(days: list[dt.date] | None) -> str:
    return O.with_views(TURNOVER_VIEWS, turnover_select(days))


@query("account_turnover", turnover_sql([D15]))
def q_account_turnover(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = Fixtures(spark, sf_dir)
    return TO.account_turnover(f.ft_posting_f, f.md_account_d, f.md_exchange_rate_d, D15)


@query("turnover_range", turnover_sql(None))
def q_turnover_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turnovers of every posting date in one job (the whole fact table)."""
    f = Fixtures(spark, sf_dir)
    return TO.account_turnover_range(f.ft_posting_f, f.md_account_d, f.md_exchange_rate_d)

# ---------------------------------------------------------------- ledger report

from tallyspark.operators import report as RP  # noqa: E402

REPORT_VIEWS = ["md_account_d", "md_currency_d", "md_ledger_account_s", "ft_balance_f", "md_exchange_rate_d",
                "ft_posting_f"]


def report_views(day_sql: str) -> dict[str, str]:
    """Oracle views for the date literal ``day_sql``: ``account_line`` has one row for each account (and turnover
    day, and rate), ``signed`` one row for each line and measure, with the amount in roubles.

    ``side`` is 'rub' or 'val' by currency code and 'none' when the code is NULL: such lines count in totals of
    opening balances and turnovers only."""
    m0 = f"CAST(date_trunc('month', {day_sql}) AS DATE)"
    m1 = f"last_day({day_sql})"
    return {
        "chart": f"""
SELECT chapter, CAST(ledger_account AS VARCHAR) AS ledger_account FROM md_ledger_account_s
WHERE start_date <= {day_sql} AND end_date >= {day_sql}""",
        "money": f"""
SELECT currency_rk, CASE WHEN currency_code IS NULL THEN 'none' WHEN currency_code IN ('643', '810') THEN 'rub' ELSE 'val' END AS side
FROM md_currency_d WHERE data_actual_date <= {day_sql} AND data_actual_end_date >= {day_sql}""",
        "price": f"""
SELECT currency_rk, reduced_cource FROM md_exchange_rate_d
WHERE data_actual_date <= {day_sql} AND data_actual_end_date >= {day_sql}""",
        "opening": f"SELECT account_rk, balance_out FROM ft_balance_f WHERE on_date = {m0} - INTERVAL 1 DAY",
        "moved": f"""
SELECT account_rk, on_date AS turn_date, debet_amount_rub, credit_amount_rub FROM dm_account_turnover_f
WHERE on_date >= {m0} AND on_date <= {m1}""",
        "account_line": f"""
SELECT {m0} AS from_date, {m1} AS to_date, chapter, ledger_account, char_type AS characteristic, account_rk, turn_date, side,
       balance_out, reduced_cource,
       CASE side WHEN 'rub' THEN balance_out ELSE balance_out * reduced_cource END AS brought,
       COALESCE(debet_amount_rub, 0) - COALESCE(credit_amount_rub, 0) AS net,
       COALESCE(debet_amount_rub, 0) AS deb, COALESCE(credit_amount_rub, 0) AS cre
FROM (SELECT *, substr(account_number, 1, 5) AS ledger_account FROM md_account_d
      WHERE data_actual_date <= {day_sql} AND data_actual_end_date >= {day_sql}) acc
JOIN chart USING (ledger_account) JOIN money USING (currency_rk)
LEFT JOIN price USING (currency_rk) LEFT JOIN opening USING (account_rk) LEFT JOIN moved USING (account_rk)""",
        "signed": """
SELECT *, 'balance_in' AS measure, brought AS amount FROM account_line
UNION ALL SELECT *, 'turn_deb', deb FROM account_line
UNION ALL SELECT *, 'turn_cre', cre FROM account_line
UNION ALL SELECT *, 'balance_out', CASE WHEN side = 'none' OR characteristic NOT IN ('A', 'P') THEN 0
                                        WHEN characteristic = 'A' THEN brought + net ELSE brought - net END FROM account_line""",
    }


def side_of(side: str, amount: str = "amount") -> str:
    """The amount where the line is of the side, else 0."""
    return amount if side == "total" else f"CASE WHEN side = '{side}' THEN {amount} ELSE 0 END"


def _report_select() -> str:
    cols = ["from_date", "to_date", "chapter", "ledger_account", "characteristic"]
    for m in ["balance_in", "turn_deb", "turn_cre", "balance_out"]:
        for side in ["rub", "val", "total"]:
            cols.append(f"CAST(SUM({side_of(side)}) FILTER (WHERE measure = '{m}') AS DECIMAL(23,8)) AS {m}_{side}")
            cols.append(f"CAST(0 AS DECIMAL(23,8)) AS r_{m}_{side}")
    return ("SELECT " + ", ".join(cols) + " FROM signed "
            "GROUP BY from_date, to_date, chapter, ledger_account, characteristic")


def turnover_mart_sql(days: list[dt.date]) -> str:
    return turnover_select(days)


def report_sql(day: dt.date, turnover_days: list[dt.date], body: str) -> str:
    return O.with_views(REPORT_VIEWS, body, {
        "dm_account_turnover_f": turnover_mart_sql(turnover_days), **report_views(repr_day(day)),
    })


def _report_inputs(spark, sf_dir, turnover_days):
    f = Fixtures(spark, sf_dir)
    postings, acc, rates = f.ft_posting_f, f.md_account_d, f.md_exchange_rate_d
    if len(turnover_days) == 1:
        turn = TO.account_turnover(postings, acc, rates, turnover_days[0])
    else:
        turn = TO.account_turnover_range(postings, acc, rates, turnover_days[0], turnover_days[-1])
    return f, turn


@query("ledger_report", report_sql(D15, [D15], _report_select()))
def q_ledger_report(spark, sf_dir):
    f, turn = _report_inputs(spark, sf_dir, [D15])
    return RP.ledger_report(f.md_account_d, f.md_currency_d, f.md_ledger_account_s, f.ft_balance_f,
                            f.md_exchange_rate_d, turn, D15)


@query("ledger_report_3d", report_sql(D15, [D14, D15, D16], _report_select()))
def q_ledger_report_3d(spark, sf_dir):
    """Report over three turnover days: each account's opening balance counted per day."""
    f, turn = _report_inputs(spark, sf_dir, [D14, D15, D16])
    return RP.ledger_report(f.md_account_d, f.md_currency_d, f.md_ledger_account_s, f.ft_balance_f,
                            f.md_exchange_rate_d, turn, D15)


@query("opening_balance", O.with_views(REPORT_VIEWS, f"""
SELECT account_rk, ledger_account, balance_out, reduced_cource,
       CAST({side_of("rub", "brought")} AS DECIMAL(23,8)) AS balance_in_rub,
       CAST({side_of("val", "brought")} AS DECIMAL(23,8)) AS balance_in_val, CAST(brought AS DECIMAL(23,8)) AS balance_in_total
FROM account_line""", {
    "dm_account_turnover_f": "SELECT * FROM (" + turnover_mart_sql([D15]) + ") x WHERE false", **report_views(repr_day(D15)),
}))
def q_opening_balance(spark, sf_dir):
    f = Fixtures(spark, sf_dir)
    return RP.opening_balance(f.md_account_d, f.md_currency_d, f.md_ledger_account_s, f.ft_balance_f,
                              f.md_exchange_rate_d, D15)


@query("closing_balance", report_sql(D15, [D14, D15, D16], f"""
SELECT account_rk, turn_date, characteristic, CAST({side_of("rub")} AS DECIMAL(23,8)) AS balance_out_rub,
       CAST({side_of("val")} AS DECIMAL(23,8)) AS balance_out_val, CAST(amount AS DECIMAL(23,8)) AS balance_out_total
FROM signed WHERE measure = 'balance_out'"""))
def q_closing_balance(spark, sf_dir):
    f, turn = _report_inputs(spark, sf_dir, [D14, D15, D16])
    return RP.closing_balance(f.md_account_d, f.md_currency_d, f.md_ledger_account_s, f.ft_balance_f,
                              f.md_exchange_rate_d, turn, D15)

# ---------------------------------------------------------------- legs, intervals, dates

from pyspark.sql import functions as F  # noqa: E402

from tallyspark.functions import dates as DT  # noqa: E402


@query("posting_legs", O.with_views(["ft_posting_f"], """
SELECT oper_date, credit_account_rk AS account_rk, credit_amount, CAST(NULL AS DECIMAL(15,2)) AS debet_amount FROM ft_posting_f
UNION ALL
SELECT oper_date, debet_account_rk, CAST(NULL AS DECIMAL(15,2)), debet_amount FROM ft_posting_f"""))
def q_posting_legs(spark, sf_dir):
    return TO.posting_legs(Fixtures(spark, sf_dir).ft_posting_f)


@query("rate_interval_join", O.with_views(["ft_posting_f", "md_account_d", "md_exchange_rate_d"], """
SELECT l.oper_date, l.account_rk, a.currency_rk, l.credit_amount, l.debet_amount, er.reduced_cource
FROM (SELECT oper_date, credit_account_rk AS account_rk, credit_amount, CAST(NULL AS DECIMAL(15,2)) AS debet_amount FROM ft_posting_f
      UNION ALL
      SELECT oper_date, debet_account_rk, CAST(NULL AS DECIMAL(15,2)), debet_amount FROM ft_posting_f) l
JOIN md_account_d a ON a.account_rk = l.account_rk AND l.oper_date BETWEEN a.data_actual_date AND a.data_actual_end_date
LEFT JOIN md_exchange_rate_d er ON er.currency_rk = a.currency_rk
     AND l.oper_date BETWEEN er.data_actual_date AND er.data_actual_end_date"""))
def q_rate_interval_join(spark, sf_dir):
    f = Fixtures(spark, sf_dir)
    return TO.rate_interval_join(f.ft_posting_f, f.md_account_d, f.md_exchange_rate_d)


@query("valid_on_date", O.with_views(["md_account_d"], """
SELECT account_rk, data_actual_date, data_actual_end_date, account_number, char_type, currency_rk
FROM md_account_d WHERE DATE '1998-09-15' BETWEEN data_actual_date AND data_actual_end_date"""))
def q_valid_on_date(spark, sf_dir):
    acc = Fixtures(spark, sf_dir).md_account_d
    return (acc.filter(DT.valid_on(D15, "data_actual_date", "data_actual_end_date"))
            .select("account_rk", "data_actual_date", "data_actual_end_date", "account_number", "char_type",
                    "currency_rk"))


@query("month_bounds", O.with_views(["ft_posting_f"], """
SELECT oper_date, CAST(date_trunc('month', oper_date) AS DATE) AS month_start, last_day(oper_date) AS month_end,
       CAST(CAST(date_trunc('month', oper_date) AS DATE) - INTERVAL 1 DAY AS DATE) AS prev_month_end
FROM (SELECT DISTINCT oper_date FROM ft_posting_f) d"""))
def q_month_bounds(spark, sf_dir):
    days = Fixtures(spark, sf_dir).ft_posting_f.select("oper_date").distinct()
    d = F.col("oper_date")
    return days.select(d, DT.month_start(d).alias("month_start"), DT.month_end(d).alias("month_end"),
                       DT.prev_month_end(d).alias("prev_month_end"))


# ---------------------------------------------------------------- posting stats

from tallyspark.operators import stats as ST  # noqa: E402

_STATS_CTE = """
SELECT oper_date, min(credit_amount) AS min_credit, min(debet_amount) AS min_debet,
       max(credit_amount) AS max_credit, max(debet_amount) AS max_debet
FROM ft_posting_f WHERE oper_date = DATE '1998-09-15' GROUP BY oper_date"""


@query("posting_stats", O.with_views(["ft_posting_f"], _STATS_CTE))
def q_posting_stats(spark, sf_dir):
    return ST.posting_stats(Fixtures(spark, sf_dir).ft_posting_f, D15)


@query("posting_report", O.with_views(["ft_posting_f"], """
SELECT oper_date, 1 AS line_no, 'On date: ' || COALESCE(CAST(oper_date AS VARCHAR), 'None') AS line FROM st
UNION ALL SELECT oper_date, 2, 'min credit >> ' || COALESCE(CAST(min_credit AS VARCHAR), 'None') FROM st
UNION ALL SELECT oper_date, 3, 'min debet >> ' || COALESCE(CAST(min_debet AS VARCHAR), 'None') FROM st
UNION ALL SELECT oper_date, 4, 'max_credit >> ' || COALESCE(CAST(max_credit AS VARCHAR), 'None') FROM st
UNION ALL SELECT oper_date, 5, 'max_debet >> ' || COALESCE(CAST(max_debet AS VARCHAR), 'None') FROM st""",
                                        {"st": _STATS_CTE}))
def q_posting_report(spark, sf_dir):
    return ST.posting_report(ST.posting_stats(Fixtures(spark, sf_dir).ft_posting_f, D15))


# ---------------------------------------------------------------- clean-up and checks

from tallyspark.operators import checks as CK  # noqa: E402
from tallyspark.operators import clean as CL  # noqa: E402
from tallyspark.schemas import KEYS, MAX_LENGTH, NOT_NULL  # noqa: E402


@query("posting_preagg", O.with_views(["ft_posting_f"], "SELECT * FROM ft_posting_f"))
def q_posting_preagg(spark, sf_dir):
    return CL.posting_preagg(Fixtures(spark, sf_dir).posting_raw)


@query("rate_dedupe", O.with_views(["md_exchange_rate_d"], "SELECT * FROM md_exchange_rate_d"))
def q_rate_dedupe(spark, sf_dir):
    return CL.rate_dedupe(Fixtures(spark, sf_dir).exchange_rate_raw)


@query("clean_ledger", O.with_views(["ledger_raw"], """
SELECT ledger_account, start_date,
       COALESCE(CAST(CAST(trunc(pair_account) AS BIGINT) AS VARCHAR), '') AS pair_account,
       COALESCE(section_name, '') AS section_name
FROM ledger_raw"""))
def q_clean_ledger(spark, sf_dir):
    return CL.clean_ledger(Fixtures(spark, sf_dir).ledger_raw)


@query("key_duplicates", O.with_views(["posting_raw"], """
SELECT oper_date, credit_account_rk, debet_account_rk, COUNT(*) AS n_rows
FROM posting_raw GROUP BY oper_date, credit_account_rk, debet_account_rk HAVING COUNT(*) > 1"""))
def q_key_duplicates(spark, sf_dir):
    return CK.key_duplicates(Fixtures(spark, sf_dir).posting_raw, KEYS["ft_posting_f"])


def _null_sql(table: str, cols: list[str]) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{table}' AS table_name, '{c}' AS column_name, COUNT(CASE WHEN {c} IS NULL THEN 1 END) AS n_null "
        f"FROM {table}" for c in cols)


_ACCOUNT_NOT_NULL = KEYS["md_account_d"] + NOT_NULL["md_account_d"]


@query("null_violations", O.with_views(["posting_raw", "md_account_d"],
                                       _null_sql("posting_raw", KEYS["ft_posting_f"]) + "\nUNION ALL\n"
                                       + _null_sql("md_account_d", _ACCOUNT_NOT_NULL)))
def q_null_violations(spark, sf_dir):
    f = Fixtures(spark, sf_dir)
    return CK.union_all([CK.null_violations(f.posting_raw, "posting_raw", KEYS["ft_posting_f"]),
                         CK.null_violations(f.md_account_d, "md_account_d", _ACCOUNT_NOT_NULL)])


def _length_sql(table: str, limits: dict[str, int]) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{table}' AS table_name, '{c}' AS column_name, {n} AS max_length, "
        f"COUNT(CASE WHEN length({c}) > {n} THEN 1 END) AS n_too_long FROM {table}" for c, n in limits.items())


@query("length_violations", O.with_views(["md_account_d", "md_currency_d"],
                                         _length_sql("md_account_d", MAX_LENGTH["md_account_d"]) + "\nUNION ALL\n"
                                         + _length_sql("md_currency_d", MAX_LENGTH["md_currency_d"])))
def q_length_violations(spark, sf_dir):
    f = Fixtures(spark, sf_dir)
    return CK.union_all([CK.length_violations(f.md_account_d, "md_account_d", MAX_LENGTH["md_account_d"]),
                         CK.length_violations(f.md_currency_d, "md_currency_d", MAX_LENGTH["md_currency_d"])])

FINDING_TABLES = {"ft_balance_f": "ft_balance_f", "ft_posting_f": "posting_raw", "md_account_d": "md_account_d", "md_currency_d": "md_currency_d",
                  "md_exchange_rate_d": "exchange_rate_raw", "md_ledger_account_s": "ledger_full"}


def _findings_sql() -> str:
    """Each rule of each table by a statement of its own."""
    out = []
    for table, view in FINDING_TABLES.items():
        keys = KEYS[table]
        whole = " AND ".join(f"{k} IS NOT NULL" for k in keys)
        out.append(f"SELECT '{table}' AS table_name, 'key' AS rule, '{','.join(keys)}' AS column_name, COUNT(*) AS n_rows "
                   f"FROM (SELECT 1 FROM {view} WHERE {whole} GROUP BY {', '.join(keys)} HAVING COUNT(*) > 1) d")
        out += [f"SELECT '{table}', 'not null', '{c}', COUNT(*) FROM {view} WHERE {c} IS NULL" for c in keys + NOT_NULL.get(table, [])]
        out += [f"SELECT '{table}', 'length', '{c}', COUNT(*) FROM {view} WHERE length({c}) > {n}" for c, n in _limits(table).items()]
    return "\nUNION ALL\n".join(out)


def _limits(table: str) -> dict[str, int]:
    """Length limits of the columns that the derived table has."""
    absent = {"md_exchange_rate_d": {"code_iso_num"}, "md_ledger_account_s": set(MAX_LENGTH["md_ledger_account_s"]) - {"chapter", "section_name"}}
    return {c: n for c, n in MAX_LENGTH.get(table, {}).items() if c not in absent.get(table, ())}


@query("constraint_findings", O.with_views(list(FINDING_TABLES.values()), _findings_sql()))
def q_constraint_findings(spark, sf_dir):
    """Keys, NOT NULL and length rules of all six detail tables, one scan a table."""
    f = Fixtures(spark, sf_dir)
    return CK.union_all([CK.constraint_findings(getattr(f, view), table, KEYS[table], NOT_NULL.get(table, []), _limits(table))
                         for table, view in FINDING_TABLES.items()])


# ---------------------------------------------------------------- upsert, period replace, counts

from tallyspark import schemas as SC  # noqa: E402
from tallyspark.operators import upsert as UP  # noqa: E402
from tallyspark.session import scratch_path  # noqa: E402
from tallyspark.sinks import files as FS  # noqa: E402


@query("keyed_upsert", O.with_views(["upsert_target", "upsert_incoming"], """
SELECT COALESCE(i.id, t.id) AS id,
       CASE WHEN i.id IS NOT NULL THEN i.segment ELSE t.segment END AS segment,
       CAST(CASE WHEN i.id IS NOT NULL THEN i.amount ELSE t.amount END AS DECIMAL(15,2)) AS amount
FROM upsert_target t FULL JOIN upsert_incoming i ON t.id = i.id"""))
def q_keyed_upsert(spark, sf_dir):
    f = Fixtures(spark, sf_dir)
    return UP.keyed_upsert(f.upsert_target, f.upsert_incoming, ["id"])


@query("replace_day", turnover_sql([D14, D15]))
def q_replace_day(spark, sf_dir):
    """Days 14 and 15 loaded, then day 15 recomputed and replaced: each day once."""
    f = Fixtures(spark, sf_dir)
    root = scratch_path(spark, "turnover")
    for d in (D14, D15, D15):
        turn = TO.account_turnover(f.ft_posting_f, f.md_account_d, f.md_exchange_rate_d, d)
        FS.replace_partition(turn, root, {"on_date": d})
    return FS.read_partitioned(spark, root, SC.DM_ACCOUNT_TURNOVER_F)


D_AUG = dt.date(1998, 8, 15)


@query("replace_month", O.with_views(REPORT_VIEWS, f"""
SELECT * FROM ({report_sql(D_AUG, [D15], _report_select())}) a
UNION ALL
SELECT * FROM ({report_sql(D15, [D15], _report_select())}) s"""))
def q_replace_month(spark, sf_dir):
    """Turnover mart filled for the 15th; August and September reports written from it, then
    September replaced: each month once."""
    f = Fixtures(spark, sf_dir)
    marts = scratch_path(spark, "marts")
    turn_root, rep_root = f"{marts}/dm_account_turnover_f", f"{marts}/dm_f101_round_f"
    FS.replace_partition(TO.account_turnover(f.ft_posting_f, f.md_account_d, f.md_exchange_rate_d, D15),
                         turn_root, {"on_date": D15})
    turn = FS.read_partitioned(spark, turn_root, SC.DM_ACCOUNT_TURNOVER_F)
    for d in (D_AUG, D15, D15):
        rep = RP.ledger_report(f.md_account_d, f.md_currency_d, f.md_ledger_account_s, f.ft_balance_f,
                               f.md_exchange_rate_d, turn, d)
        ms, me = DT.month_bounds_py(d)
        FS.replace_partition(rep, rep_root, {"from_date": ms, "to_date": me})
    return FS.read_partitioned(spark, rep_root, SC.DM_F101_ROUND_F)


@query("load_counts", O.with_views(TURNOVER_VIEWS, """
SELECT on_date, COUNT(*) AS row_count, '[END] inserted ' || CAST(COUNT(*) AS VARCHAR) || ' rows.' AS message
FROM (""" + turnover_select([D14, D15, D16]) + """) x GROUP BY on_date"""))
def q_load_counts(spark, sf_dir):
    """Rows written per day, as the end-of-load log line."""
    f = Fixtures(spark, sf_dir)
    turn = TO.account_turnover_range(f.ft_posting_f, f.md_account_d, f.md_exchange_rate_d, D14, D16)
    counts = turn.groupBy("on_date").agg(F.count(F.lit(1)).alias("row_count"))
    return counts.withColumn("message", F.concat(F.lit("[END] inserted "), F.col("row_count").cast("string"),
                                                 F.lit(" rows.")))


# ---------------------------------------------------------------- versioned import

from tallyspark.operators import history as HI  # noqa: E402

IMPORT_DATE = dt.date(1998, 10, 1)
_VERSION_MEASURES = {"amount": "decimal(23,8)"}
_VERSION_TEXT = {"amount": "raw_amount"}
_PARSED_CTE = """
SELECT id, seq, raw_amount,
       CASE WHEN raw_amount IS NULL OR trim(raw_amount) = '' THEN CAST(0 AS DECIMAL(23,8))
            ELSE TRY_CAST(raw_amount AS DECIMAL(23,8)) END AS amount
FROM version_incoming"""
_HISTORY_SQL = """
SELECT id, amount, insert_date, LEAD(seq) OVER (PARTITION BY id ORDER BY seq) IS NULL AS actuality
FROM (SELECT * FROM (SELECT *, LAG(COALESCE(amount, 0)) OVER (PARTITION BY id ORDER BY seq) AS prev FROM u) l
      WHERE is_old OR prev IS NULL OR prev <> COALESCE(amount, 0)) k
UNION ALL
SELECT id, amount, insert_date, actuality FROM version_current WHERE NOT actuality"""
_U_CTE = """
SELECT id, amount, insert_date, CAST(-1 AS BIGINT) AS seq, TRUE AS is_old FROM version_current WHERE actuality
UNION ALL
SELECT id, amount, DATE '1998-10-01', seq, FALSE FROM parsed WHERE amount IS NOT NULL"""


def _history(spark, sf_dir):
    f = Fixtures(spark, sf_dir)
    return HI.versioned_import(f.version_current, f.version_incoming, ["id"], _VERSION_MEASURES, IMPORT_DATE,
                               text_columns=_VERSION_TEXT)


@query("versioned_import", O.with_views(["version_current", "version_incoming"], _HISTORY_SQL,
                                        {"parsed": _PARSED_CTE, "u": _U_CTE}))
def q_versioned_import(spark, sf_dir):
    return _history(spark, sf_dir)


@query("current_versions", O.with_views(["version_current", "version_incoming"],
                                        "SELECT * FROM (" + _HISTORY_SQL + ") h WHERE actuality",
                                        {"parsed": _PARSED_CTE, "u": _U_CTE}))
def q_current_versions(spark, sf_dir):
    return HI.current_versions(_history(spark, sf_dir))


@query("bad_rows", O.with_views(["version_incoming"], """
SELECT id, seq, 'BAD ROW: <' || CAST(id AS VARCHAR) || '>' AS log_message,
       substr('INSERT_ERROR: dm_f101_round_f_v2 - invalid number in amount: ' || raw_amount, 1, 250) AS error_text
FROM parsed WHERE amount IS NULL""", {"parsed": _PARSED_CTE}))
def q_bad_rows(spark, sf_dir):
    f = Fixtures(spark, sf_dir)
    return HI.bad_rows(f.version_incoming, ["id"], _VERSION_MEASURES, "dm_f101_round_f_v2", _VERSION_TEXT)

# ---------------------------------------------------------------- mirror from deltas

from tallyspark.operators import mirror as MI  # noqa: E402

MIRROR_KEYS = ["user_id", "event_type"]
LOG_BEGIN = dt.datetime(2024, 2, 1, 0, 0, 0)
LOG_END = dt.datetime(2024, 2, 1, 0, 5, 0)
_PENDING_SQL = """
SELECT DISTINCT delta_id FROM mirror_delta WHERE delta_id NOT IN (SELECT ID FROM loaded_batches WHERE tab = 'events')"""


def _log_frame(f):
    return f.loaded_batches.select(F.lit(None).cast("timestamp_ntz").alias("BEGIN"),
                                   F.lit(None).cast("timestamp_ntz").alias("END"), "ID",
                                   F.col("tab").alias("TABLE"))


@query("pending_batches", O.with_views(["mirror_delta", "loaded_batches"], _PENDING_SQL))
def q_pending_batches(spark, sf_dir):
    f = Fixtures(spark, sf_dir)
    return MI.pending_batches(f.mirror_delta.select("delta_id"), _log_frame(f), "events")


@query("mirror_merge", O.with_views(["mirror_delta"], """
SELECT user_id, event_type, event_id, value
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id, event_type ORDER BY delta_id DESC) AS rn FROM mirror_delta) r
WHERE rn = 1"""))
def q_mirror_merge(spark, sf_dir):
    """Deltas stored one folder per batch; mirror built from the loaded ones, then pending ones merged."""
    f = Fixtures(spark, sf_dir)
    root = scratch_path(spark, "deltas")
    # One folder per batch, one file per folder.
    f.mirror_delta.hint("rebalance", "delta_id").write.partitionBy("delta_id").parquet(root)
    deltas = MI.read_batch_folders(spark, root, f.mirror_delta.schema)
    loaded = _log_frame(f)
    first = MI.mirror_apply(None, deltas.join(loaded.select(F.col("ID").alias("delta_id")), "delta_id", "left_semi"),
                            MIRROR_KEYS)
    pending = MI.pending_batches(deltas.select("delta_id"), loaded, "events")
    return MI.mirror_apply(first, deltas.join(pending, "delta_id", "left_semi"), MIRROR_KEYS)


@query("batch_log", O.with_views(["mirror_delta", "loaded_batches"], f"""
SELECT TIMESTAMP '{LOG_BEGIN}' AS "BEGIN", TIMESTAMP '{LOG_END}' AS "END", delta_id AS "ID", 'events' AS "TABLE"
FROM ({_PENDING_SQL}) p"""))
def q_batch_log(spark, sf_dir):
    f = Fixtures(spark, sf_dir)
    pending = MI.pending_batches(f.mirror_delta.select("delta_id"), _log_frame(f), "events")
    return MI.batch_log(pending, "events", LOG_BEGIN, LOG_END)


# ---------------------------------------------------------------- the file jobs themselves

from tallyspark.plans import jobs as JB  # noqa: E402
from tallyspark.sources import csv as CSVS  # noqa: E402


# Column that the second file of a table changes in the rows of even number, and the rows' number.
LOAD_CHANGES = {
    "ft_balance_f": ("balance_out", "balance_out + 1", "account_rk"), "ft_posting_f": ("credit_amount", "credit_amount + 1", "credit_account_rk"),
    "md_account_d": ("currency_code", "'978'", "account_rk"), "md_currency_d": ("code_iso_char", "lower(code_iso_char)", "currency_rk"),
    "md_exchange_rate_d": ("reduced_cource", "reduced_cource * 2", "currency_rk"), "md_ledger_account_s": ("section_name", "'changed'", "ledger_account"),
}
LOAD_VIEWS = {"ft_balance_f": "ft_balance_f", "ft_posting_f": "ft_posting_f", "md_account_d": "md_account_d", "md_currency_d": "md_currency_d",
              "md_exchange_rate_d": "md_exchange_rate_d", "md_ledger_account_s": "ledger_full"}


def _row_text(columns) -> str:
    return "concat_ws('|', " + ", ".join(f"coalesce(CAST({c} AS STRING), '~')" for c in columns) + ")"


def _load_sql() -> str:
    out = []
    for table, (column, value, number) in LOAD_CHANGES.items():
        names = [f.name for f in dict(CSVS.DETAIL_FILES)[table].fields]
        kind = "" if column in ("currency_code", "code_iso_char", "section_name") else dict(CSVS.DETAIL_FILES)[table][column].dataType.simpleString()
        changed = f"CASE WHEN {number} % 2 = 0 THEN {value} ELSE {column} END"
        have = {"md_ledger_account_s": ["chapter", "ledger_account", "start_date", "end_date", "pair_account", "section_name"]}.get(
            table, [n for n in names if n != "code_iso_num"])
        cols = [(f"CAST({changed} AS {kind})" if kind else changed) if n == column else n for n in have]
        # Blank text instead of NULL, and columns of the table that the file lacks.
        texts = [n for n in names if n not in have]
        blank = {"ledger_full": "COALESCE({}, '')"}.get(LOAD_VIEWS[table])
        shown = {n: (blank.format(c) if blank and n in ("chapter", "section_name") else c) for n, c in zip(have, cols)}
        if table == "md_ledger_account_s":
            shown["pair_account"] = "COALESCE(CAST(CAST(trunc(pair_account) AS BIGINT) AS VARCHAR), '')"
        shown |= {n: "NULL" for n in texts}
        row = _row_text([shown[n] for n in names]).replace("STRING", "VARCHAR")
        out.append(f"SELECT '{table}' AS table_name, {row} AS row_text FROM {LOAD_VIEWS[table]}")
    return "\nUNION ALL\n".join(out)


def _loaded(spark, sf_dir, folders=("in1", "in2")) -> str:
    """All six detail files loaded by the load job, then every second row again with a changed value, from files that have
    their columns in another order and only the keys and that column."""
    f, root = Fixtures(spark, sf_dir), scratch_path(spark, "load_job")
    for table, (column, value, number) in LOAD_CHANGES.items():
        schema = dict(CSVS.DETAIL_FILES)[table]
        kind = schema[column].dataType
        CSVS.write_detail_csv(getattr(f, LOAD_VIEWS[table]), f"{root}/in1/{table}.csv", compression="gzip")
        if "in2" not in folders:
            continue
        # From the first file: the table is derived once.
        df = CSVS.read_detail_csv(spark, f"{root}/in1/{table}.csv", schema, ledger_pair_as_float=table == "md_ledger_account_s")
        again = df.filter(f"{number} % 2 = 0").select(F.expr(value).cast(kind).alias(column), *KEYS[table][::-1])
        CSVS.write_detail_csv(again, f"{root}/in2/{table}.csv", compression="gzip")
    for folder in folders:
        # The derived postings have few rows a day: only balances are stored by date.
        results = JB.load_detail(spark, f"{root}/{folder}", f"{root}/ds", f"{root}/logs", partition_by={"ft_balance_f": ["on_date"]})
        if set(results.values()) != {"ok"}:
            raise RuntimeError(f"load failed: {results}")
    return root


@query("load_upsert_job", O.with_views(list(LOAD_VIEWS.values()), _load_sql()))
def q_load_upsert_job(spark, sf_dir):
    """Rows of all six tables after two loads, each as text."""
    tables = JB.detail_tables(spark, f"{_loaded(spark, sf_dir)}/ds")
    return CK.union_all([df.select(F.lit(t).alias("table_name"), F.expr(_row_text(df.columns)).alias("row_text")) for t, df in tables.items()])


@query("load_log", "SELECT status, verb || ' loading table ' || tab AS description FROM "
       "(VALUES ('BEGIN_LOADING', 'Start'), ('FINISH_LOADING', 'Finish')) v(status, verb), (VALUES "
       + ", ".join(f"('{t}')" for t in LOAD_VIEWS) + ") t(tab)")
def q_load_log(spark, sf_dir):
    """The audit log of a load of all six files, read back."""
    return JB.read_log(spark, f"{_loaded(spark, sf_dir, ('in1',))}/logs").select("status", "description")


@query("fill_log", O.with_views(TURNOVER_VIEWS, """
SELECT * FROM (VALUES (1, '[BEGIN] fill(i_OnDate => date ''1998-09-15'');'), (2, 'delete on_date = 1998-09-15'), (3, 'insert')) v(record_id, message)
UNION ALL SELECT 4, '[END] inserted ' || CAST(COUNT(*) AS VARCHAR) || ' rows.' FROM (""" + turnover_select([D15]) + ") x"))
def q_fill_log(spark, sf_dir):
    """The message log of the day's turnover fill, read back."""
    f, root = Fixtures(spark, sf_dir), scratch_path(spark, "fill")
    detail = {t: getattr(f, t) for t in ("ft_posting_f", "md_account_d", "md_exchange_rate_d")}
    JB.fill_turnover(spark, detail, f"{root}/dm", D15, f"{root}/logs")
    return JB.read_messages(spark, f"{root}/logs").select(F.col("record_id").cast("int").alias("record_id"), "message")


# ---- the report import: five keys, 24 measures, part files

IMPORT_DAYS = [dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)]
_REPORT_MEASURES = SC.REPORT_COLUMNS[5:]
_REPORT_TARGET = "dm.dm_f101_round_f_v2"


def _import_history_sql() -> str:
    names = ", ".join(_REPORT_MEASURES)
    state = "[" + names + "]"
    return f"""
SELECT from_date, to_date, chapter, ledger_account, characteristic, {names}, insert_date,
       LEAD(seq) OVER (PARTITION BY from_date, to_date, chapter, ledger_account, characteristic ORDER BY seq) IS NULL AS actuality
FROM (SELECT *, LAG({state}) OVER (PARTITION BY from_date, to_date, chapter, ledger_account, characteristic ORDER BY seq) AS before FROM every) l
WHERE before IS NULL OR before <> {state}"""


def _import_views() -> dict[str, str]:
    number = lambda m: f"CASE WHEN trim({m}) = '' THEN CAST(0 AS DECIMAL(23,8)) ELSE TRY_CAST({m} AS DECIMAL(23,8)) END AS {m}"
    return {
        "typed": "SELECT TRY_CAST(from_date AS DATE) AS from_date, from_date AS from_text, TRY_CAST(to_date AS DATE) AS to_date, chapter, ledger_account, "
                 "characteristic, part, " + ", ".join(number(m) for m in _REPORT_MEASURES) + f", {_REPORT_MEASURES[7]} AS bad_text FROM report_lines",
        "every": "SELECT *, part AS seq, CASE part WHEN 0 THEN TIMESTAMP '2024-01-01' ELSE TIMESTAMP '2024-01-02' END AS insert_date FROM typed "
                 f"WHERE from_date IS NOT NULL AND {_REPORT_MEASURES[7]} IS NOT NULL",
    }


def _imported(spark, sf_dir) -> str:
    """Two imports of report files: all good lines, then two part files with changed, unchanged, blank, bad and double ones."""
    lines, root = Fixtures(spark, sf_dir).report_lines, scratch_path(spark, "report_import")
    for part in (0, 1, 2):
        lines.filter(F.col("part") == part).drop("part").write.csv(f"{root}/made/{part}", header=True, sep=";")
    for folder, parts in (("first", [0]), ("second", [1, 2])):
        for part in parts:
            # Files of a folder are read in the order of their names.
            for n, (path, _) in enumerate(FS.files_of_each(spark, [f"{root}/made/{part}"])[0]):
                FS.moved_into(spark, path, f"{root}/{folder}/part-{part:05d}-{n:05d}.csv")
    for folder, day in zip(("first", "second"), IMPORT_DAYS):
        JB.import_report_versions(spark, f"{root}/{folder}", f"{root}/hist", f"{root}/logs", day)
    return root


@query("report_import_job", O.with_views(["report_lines"], _import_history_sql(), _import_views()))
def q_report_import_job(spark, sf_dir):
    """The versioned report table after two imports."""
    return JB.read_history(spark, f"{_imported(spark, sf_dir)}/hist")


@query("report_import_log", O.with_views(["report_lines"], f"""
SELECT 'BEGIN_LOADING' AS status, 'Start loading table dm_f101_round_f_v2' AS description FROM (VALUES (1), (2)) v(run)
UNION ALL
SELECT 'FINISH_LOADING', 'Finish loading table dm_f101_round_f_v2 - Inserted: ' || CAST(COUNT(*) FILTER (WHERE insert_date = run_at) AS VARCHAR)
FROM ({_import_history_sql()}) h, (VALUES (TIMESTAMP '2024-01-01'), (TIMESTAMP '2024-01-02')) v(run_at) GROUP BY run_at
UNION ALL
SELECT 'ERROR', substr(CASE WHEN from_date IS NULL THEN 'INSERT_ERROR: {_REPORT_TARGET} - invalid date in from_date: ' || from_text
                       ELSE 'INSERT_ERROR: {_REPORT_TARGET} - invalid number in {_REPORT_MEASURES[7]}: ' || bad_text END, 1, 250)
FROM typed WHERE from_date IS NULL OR {_REPORT_MEASURES[7]} IS NULL
UNION ALL
SELECT 'INFORM_MESS', 'BAD ROW: <' || concat_ws(':', from_text, CAST(to_date AS VARCHAR), chapter, ledger_account, characteristic) || '>'
FROM typed WHERE from_date IS NULL OR {_REPORT_MEASURES[7]} IS NULL""", _import_views()))
def q_report_import_log(spark, sf_dir):
    """The audit log of the two imports: rejected lines, counts of rows inserted."""
    return JB.read_log(spark, f"{_imported(spark, sf_dir)}/logs").select("status", "description")


_MIRROR_SQL = """
SELECT user_id, event_type, event_id, value
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id, event_type ORDER BY delta_id DESC) AS rn FROM mirror_delta) r
WHERE rn = 1"""


def _mirror_run(spark, sf_dir) -> tuple[str, object]:
    """CSV delta folders applied by the mirror job in two runs, the later folders with their columns in another order."""
    deltas, root = Fixtures(spark, sf_dir).mirror_delta, scratch_path(spark, "mirror_job")
    schema = deltas.drop("delta_id").schema
    # All folders from one job, then named as batches are.
    halves = [("early", deltas.filter("delta_id <= '2024-01-15'"), schema.names), ("late", deltas.filter("delta_id > '2024-01-15'"), schema.names[::-1])]
    for half, rows, columns in halves:
        rows.hint("rebalance", "delta_id").select(*columns, "delta_id").write.partitionBy("delta_id").csv(f"{root}/{half}", header=True, sep=";")
        for name in FS.folder_names(spark, f"{root}/{half}"):
            FS.moved_into(spark, f"{root}/{half}/{name}", f"{root}/deltas/{name.partition('=')[2]}/events.csv")
        JB.run_mirror(spark, f"{root}/deltas", "events", MIRROR_KEYS, f"{root}/store", f"{root}/log", f"{root}/export", schema)
    return root, deltas.schema


@query("mirror_job", O.with_views(["mirror_delta"], _MIRROR_SQL))
def q_mirror_job(spark, sf_dir):
    root, schema = _mirror_run(spark, sf_dir)
    return JB.read_mirror(spark, f"{root}/store", "events", MIRROR_KEYS, JB.store_schema(schema)).select("user_id", "event_type", "event_id", "value")


@query("mirror_export", O.with_views(["mirror_delta"], "SELECT CAST(user_id AS VARCHAR) AS user_id, event_type, CAST(event_id AS VARCHAR) AS event_id, "
                                     "CAST(value AS VARCHAR) AS value FROM (" + _MIRROR_SQL + ") m"))
def q_mirror_export(spark, sf_dir):
    """The export of the mirror job, read back as text."""
    root, schema = _mirror_run(spark, sf_dir)
    exported = FS.read_text_csv(spark, f"{root}/export", [c for c in schema.names if c != "delta_id"])
    return exported.select("user_id", "event_type", "event_id", "value")


@query("mirror_log", O.with_views(["mirror_delta"], """SELECT DISTINCT delta_id AS "ID", 'events' AS "TABLE", TRUE AS ended FROM mirror_delta"""))
def q_mirror_log(spark, sf_dir):
    """The load log of the mirror job's two runs: every batch once."""
    root, _ = _mirror_run(spark, sf_dir)
    return MI.read_load_log(spark, f"{root}/log").select("ID", "TABLE", (F.col("BEGIN") <= F.col("END")).alias("ended"))


# ---------------------------------------------------------------- categories and round trips

from tallyspark.operators import categories as CA  # noqa: E402

_COUNTS_SQL = 'SELECT Discipline, COUNT(*) AS "count" FROM athletes GROUP BY Discipline'
_JOIN_SQL = """
SELECT lower(c.Discipline) AS discipline, c."count" FROM counts c JOIN disciplines d ON lower(c.Discipline) = d.discipline"""


@query("category_counts", O.with_views(["athletes"], _COUNTS_SQL))
def q_category_counts(spark, sf_dir):
    return CA.category_counts(Fixtures(spark, sf_dir).athletes)


@query("category_join", O.with_views(["athletes", "disciplines"], _JOIN_SQL, {"counts": _COUNTS_SQL}))
def q_category_join(spark, sf_dir):
    f = Fixtures(spark, sf_dir)
    return CA.category_join(CA.category_counts(f.athletes), f.disciplines)


@query("csv_roundtrip", O.with_views(["athletes", "disciplines"], _JOIN_SQL, {"counts": _COUNTS_SQL}))
def q_csv_roundtrip(spark, sf_dir):
    """The small dimension written as one tab-separated file with a header, read back with a schema and joined."""
    f = Fixtures(spark, sf_dir)
    path = FS.export_csv(f.disciplines, scratch_path(spark, "disciplines_tsv"), sep="\t", single_file=True)
    dimension = spark.read.schema(SC.DISCIPLINES).csv(path, header=True, sep="\t")
    return CA.category_join(CA.category_counts(f.athletes), dimension)


@query("athletes_csv_counts", O.with_views(["athletes"], _COUNTS_SQL))
def q_athletes_csv_counts(spark, sf_dir):
    """Categories written as a ';' CSV with a header, read back with an inferred schema, counted."""
    path = scratch_path(spark, "athletes_csv")
    Fixtures(spark, sf_dir).athletes.write.csv(path, header=True, sep=";")
    athletes = spark.read.csv(path, header=True, inferSchema=True, sep=";")
    return CA.category_counts(athletes)


@query("parquet_roundtrip", O.with_views(["athletes", "disciplines"], _JOIN_SQL, {"counts": _COUNTS_SQL}))
def q_parquet_roundtrip(spark, sf_dir):
    f = Fixtures(spark, sf_dir)
    path = scratch_path(spark, "category_join")
    CA.category_join(CA.category_counts(f.athletes), f.disciplines).write.parquet(path)
    return spark.read.parquet(path)


@query("report_export", report_sql(D15, [D15], "SELECT " + ", ".join(
    f"CAST({c} AS VARCHAR) AS {c}" for c in SC.REPORT_COLUMNS) + " FROM (" + _report_select() + ") r"))
def q_report_export(spark, sf_dir):
    """The month report exported as ';' CSV with a header and read back as text."""
    f, turn = _report_inputs(spark, sf_dir, [D15])
    rep = RP.ledger_report(f.md_account_d, f.md_currency_d, f.md_ledger_account_s, f.ft_balance_f,
                           f.md_exchange_rate_d, turn, D15)
    path = FS.export_csv(rep, scratch_path(spark, "report_csv"))
    return FS.read_text_csv(spark, path, rep.columns)


# ---------------------------------------------------------------- audit, messages, date texts

from tallyspark.operators import audit as AU  # noqa: E402

AUDIT_AT = dt.datetime(1998, 10, 1, 12, 0, 0)


@query("audit_log", O.with_views(["audit_raw"], f"""
SELECT TIMESTAMP '{AUDIT_AT}' AS date_and_time,
       CASE status WHEN 'begin' THEN 'BEGIN_LOADING' WHEN 'error' THEN 'ERROR'
                   WHEN 'finish' THEN 'FINISH_LOADING' WHEN 'inform' THEN 'INFORM_MESS' END AS status,
       substr(description, 1, 255) AS description
FROM audit_raw WHERE status IN ('begin', 'error', 'finish', 'inform')"""))
def q_audit_log(spark, sf_dir):
    return AU.audit_log(Fixtures(spark, sf_dir).audit_raw, at=AUDIT_AT)


@query("split_messages", """
SELECT ROW_NUMBER() OVER (ORDER BY doc_id, piece_no) AS record_id, doc_id, piece_no,
       substr(text, CAST(piece_no * 4000 + 1 AS INTEGER), 4000) AS message, 1 AS message_type
FROM (SELECT doc_id, text, CAST(unnest(range(CAST(ceil(length(text) / 4000.0) AS BIGINT))) AS INTEGER) AS piece_no
      FROM documents WHERE length(text) > 0) p""")
def q_split_messages(spark, sf_dir):
    docs = Fixtures(spark, sf_dir).t.documents
    return AU.split_messages(docs, "text", ["doc_id"])


@query("validate_dates", O.with_views(["date_text"], r"""
SELECT s, regexp_matches(s, '^\d{4}-\d{2}-\d{2}$') AS shape_ok,
       CASE WHEN regexp_matches(s, '^\d{4}-\d{2}-\d{2}$') THEN TRY_CAST(s AS DATE) END AS on_date
FROM date_text"""))
def q_validate_dates(spark, sf_dir):
    texts = Fixtures(spark, sf_dir).date_text
    shape = DT.date_shape_ok("s")
    return texts.select("s", shape.alias("shape_ok"),
                        F.when(shape, DT.parse_date("s")).alias("on_date"))


# ---------------------------------------------------------------- detail file load

@query("load_detail", O.with_views(["ft_posting_f"], "SELECT * FROM ft_posting_f"))
def q_load_detail(spark, sf_dir):
    """Postings written in the detail-file layout (';', header, row number first) and read back."""
    path = CSVS.write_detail_csv(Fixtures(spark, sf_dir).ft_posting_f, scratch_path(spark, "ft_posting_f_csv"))
    return CSVS.read_detail_csv(spark, path, SC.FT_POSTING_F)
