"""Reference SQL for the correctness check (DuckDB dialect, plain ANSI where possible).

Each text is ``WITH <fixture views> <query>`` over the pre-registered base
tables.  The Spark side never runs these texts; it builds the same results
with the DataFrame API, so the two are independent implementations.
"""

from __future__ import annotations

from tallyspark.schemas import REPORT_COLUMNS

# Fixture views, in dependency order (same rules as tallyspark.sources.fixtures).
FIXTURE_SQL: dict[str, str] = {
    "md_account_src": """
SELECT CAST(CASE WHEN rk % 10 = 0 THEN DATE '1998-08-01' ELSE DATE '1998-09-01' END AS DATE) AS data_actual_date,
       CAST(CASE WHEN rk % 7 = 0 THEN DATE '1998-09-10' ELSE DATE '2050-12-31' END AS DATE) AS data_actual_end_date,
       CAST(rk AS INT) AS account_rk,
       CONCAT(CAST(30000 + rk % 30 AS VARCHAR), '840', LPAD(CAST(rk AS VARCHAR), 12, '0')) AS account_number,
       CASE WHEN rk % 17 = 0 THEN 'X' WHEN rk % 2 = 0 THEN 'A' ELSE 'P' END AS char_type,
       CAST(nk AS INT) AS currency_rk, '840' AS currency_code, CAST(bal AS DECIMAL(15,2)) AS bal
FROM (SELECT s_suppkey AS rk, s_nationkey AS nk, s_acctbal AS bal FROM supplier
      UNION ALL SELECT c_custkey + 1000000, c_nationkey, c_acctbal FROM customer) u""",
    "md_account_d": """
SELECT data_actual_date, data_actual_end_date, account_rk, account_number, char_type, currency_rk, currency_code
FROM md_account_src
UNION ALL
SELECT start_day, last_day(start_day), account_rk, account_number, char_type, currency_rk, currency_code
FROM (SELECT *, CAST(DATE '1992-01-01' + to_months(CAST((CAST(account_rk AS BIGINT) * 7 + k * 26) % 79 AS INTEGER)) AS DATE) AS start_day
      FROM md_account_src, (SELECT unnest([0, 1, 2]) AS k) earlier) v""",
    "md_currency_d": """
SELECT n_nationkey AS currency_rk, DATE '1990-01-01' AS data_actual_date, DATE '2050-12-31' AS data_actual_end_date,
       CASE n_nationkey WHEN 0 THEN '643' WHEN 1 THEN '810' WHEN 24 THEN NULL ELSE CAST(840 + n_nationkey AS VARCHAR) END AS currency_code,
       SUBSTR(n_name, 1, 3) AS code_iso_char
FROM nation""",
    "exchange_rate_raw": """
SELECT DATE '1990-01-01' AS data_actual_date, DATE '1998-09-14' AS data_actual_end_date, n_nationkey AS currency_rk,
       CAST(CAST(n_nationkey * 125 + 50 AS DECIMAL(10,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(18,6)) AS reduced_cource
FROM nation WHERE n_nationkey NOT IN (0, 23)
UNION ALL
SELECT DATE '1998-09-15', CASE WHEN n_nationkey % 4 = 1 THEN DATE '9999-12-31' ELSE DATE '2050-12-31' END, n_nationkey,
       CAST(CAST(n_nationkey * 131 + 57 AS DECIMAL(10,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(18,6))
FROM nation WHERE n_nationkey NOT IN (0, 23)
UNION ALL
SELECT DATE '1998-09-15', CASE WHEN n_nationkey % 4 = 1 THEN DATE '9999-12-31' ELSE DATE '2050-12-31' END, n_nationkey,
       CAST(CAST(n_nationkey * 131 + 57 AS DECIMAL(10,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(18,6))
FROM nation WHERE n_nationkey % 5 = 2""",
    "md_exchange_rate_d": """
SELECT DISTINCT data_actual_date, data_actual_end_date, currency_rk, reduced_cource FROM exchange_rate_raw""",
    "md_ledger_account_s": """
SELECT SUBSTR(r_name, 1, 1) AS chapter, 30000 + n_nationkey AS ledger_account, DATE '1990-01-01' AS start_date,
       CASE WHEN n_nationkey = 5 THEN DATE '1998-01-01' ELSE DATE '2050-12-31' END AS end_date
FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "posting_raw": """
SELECT CAST(l_shipdate AS DATE) AS oper_date, CAST(l_suppkey AS INT) AS credit_account_rk,
       CASE WHEN l_quantity = 50 THEN NULL ELSE CAST(o_custkey + 1000000 AS INT) END AS debet_account_rk,
       CAST(l_extendedprice AS DECIMAL(15,2)) AS credit_amount,
       CAST(l_extendedprice AS DECIMAL(15,2)) - CAST(l_quantity AS DECIMAL(15,2)) AS debet_amount
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "ft_posting_f": """
SELECT oper_date, credit_account_rk, debet_account_rk,
       CAST(COALESCE(SUM(credit_amount), 0) AS DECIMAL(15,2)) AS credit_amount,
       CAST(COALESCE(SUM(debet_amount), 0) AS DECIMAL(15,2)) AS debet_amount
FROM posting_raw
WHERE oper_date IS NOT NULL AND credit_account_rk IS NOT NULL AND debet_account_rk IS NOT NULL
GROUP BY oper_date, credit_account_rk, debet_account_rk""",
    "ft_balance_f": """
SELECT DATE '1998-08-31' AS on_date, account_rk, currency_rk, bal AS balance_out
FROM md_account_src WHERE account_rk % 13 <> 0""",
    "ledger_raw": """
SELECT 30000 + n_nationkey AS ledger_account, DATE '1990-01-01' AS start_date,
       CASE WHEN n_nationkey % 3 = 0 THEN NULL ELSE CAST(30100 + n_nationkey AS DOUBLE) END AS pair_account,
       CASE WHEN n_nationkey % 4 = 0 THEN NULL ELSE n_name END AS section_name
FROM nation""",
    "upsert_target": """
SELECT c_custkey AS id, c_mktsegment AS segment, CAST(c_acctbal AS DECIMAL(15,2)) AS amount FROM customer WHERE c_custkey % 3 <> 0""",
    "upsert_incoming": """
SELECT c_custkey AS id, LOWER(c_mktsegment) AS segment, CAST(c_acctbal AS DECIMAL(15,2)) + 1 AS amount FROM customer WHERE c_custkey % 2 = 0""",
    "version_current": """
SELECT c_custkey AS id, CAST(CASE WHEN c_custkey % 9 = 0 THEN 0 ELSE c_acctbal END AS DECIMAL(23,8)) AS amount,
       DATE '1998-09-30' AS insert_date, TRUE AS actuality
FROM customer WHERE c_custkey % 4 <> 0""",
    "version_incoming": """
SELECT c_custkey AS id, c_custkey * 2 AS seq,
       CASE WHEN c_custkey % 9 = 0 THEN '' WHEN c_custkey % 11 = 0 THEN 'bad'
            WHEN c_custkey % 5 = 2 THEN CAST(CAST(c_acctbal AS DECIMAL(23,8)) + 1 AS VARCHAR)
            ELSE CAST(CAST(c_acctbal AS DECIMAL(23,8)) AS VARCHAR) END AS raw_amount
FROM customer
UNION ALL
SELECT c_custkey, c_custkey * 2 + 1, CAST(CAST(c_acctbal AS DECIMAL(23,8)) + 7 AS VARCHAR) FROM customer WHERE c_custkey % 7 = 0""",
    "mirror_delta": """
SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS delta_id, user_id, event_type, event_id, CAST(value AS DECIMAL(15,2)) AS value
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY CAST(ts AS DATE), user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events) e
WHERE rn = 1""",
    "loaded_batches": """
SELECT DISTINCT delta_id AS ID, 'events' AS tab FROM mirror_delta WHERE delta_id <= '2024-01-10'""",
    "athletes": """
SELECT p_partkey AS row_id, p_type AS Discipline FROM part""",
    "disciplines": """
SELECT * FROM (VALUES (1,'economy','summer'),(2,'large','summer'),(3,'medium','summer'),(4,'promo','winter'),(5,'curling','winter')) AS v(row_id, discipline, season)""",
    "audit_raw": """
SELECT event_id, CASE event_type WHEN 'click' THEN 'begin' WHEN 'view' THEN 'finish' WHEN 'error' THEN 'error' WHEN 'purchase' THEN 'inform' ELSE 'other' END AS status,
       CONCAT('message ', props) AS description FROM events""",
    "date_text": """
SELECT s FROM (VALUES ('2018-01-15'),('2018-13-45'),('15.01.2018'),('2018-1-5'),('')) AS v(s)
UNION ALL
SELECT CASE WHEN o_orderkey % 7 = 0 THEN strftime(o_orderdate, '%d.%m.%Y')
            WHEN o_orderkey % 11 = 0 THEN CAST(year(o_orderdate) AS VARCHAR) || '-' || CAST(month(o_orderdate) AS VARCHAR) || '-' || CAST(day(o_orderdate) AS VARCHAR)
            WHEN o_orderkey % 13 = 0 THEN strftime(o_orderdate, '%Y') || '-13-' || strftime(o_orderdate, '%d')
            WHEN o_orderkey % 17 = 0 THEN ''
            ELSE strftime(o_orderdate, '%Y-%m-%d') END
FROM orders""",
}



def _report_lines_sql() -> str:
    names = REPORT_COLUMNS[5:]
    plain = {m: f"CAST(CAST(c_acctbal AS DECIMAL(23,8)) + {i} AS VARCHAR)" for i, m in enumerate(names)}
    keys = {"from_date": "'1998-09-01'", "to_date": "'1998-09-30'", "chapter": "CASE WHEN c_custkey % 2 = 0 THEN 'A' ELSE 'B' END",
            "ledger_account": "LPAD(CAST(c_custkey % 100000 AS VARCHAR), 5, '0')",
            "characteristic": "CASE WHEN (c_custkey // 100000) % 2 = 0 THEN 'A' ELSE 'P' END"}
    second = plain | {names[2]: f"CASE WHEN c_custkey % 9 = 0 THEN '' ELSE {plain[names[2]]} END",
                      names[7]: f"CASE WHEN c_custkey % 11 = 0 THEN 'bad' ELSE {plain[names[7]]} END",
                      names[23]: f"CASE WHEN c_custkey % 5 = 2 THEN '0.00000001' ELSE {plain[names[23]]} END"}
    parts = [(keys | plain, "c_custkey % 4 <> 0"), (keys | second | {"from_date": "CASE WHEN c_custkey % 13 = 0 THEN '1998-13-45' ELSE '1998-09-01' END"}, "TRUE"),
             (keys | plain | {names[0]: "'7'"}, "c_custkey % 7 = 0")]
    return "\nUNION ALL\n".join("SELECT " + ", ".join(f"{v} AS {c}" for c, v in cols.items()) + f", {i} AS part FROM customer WHERE {where}"
                                 for i, (cols, where) in enumerate(parts))


FIXTURE_SQL["report_lines"] = _report_lines_sql()
FIXTURE_SQL["ledger_full"] = """
SELECT a.chapter, a.ledger_account, a.start_date, a.end_date, r.pair_account, r.section_name
FROM md_ledger_account_s a LEFT JOIN ledger_raw r ON r.ledger_account = a.ledger_account"""

_DEPENDS = {
    "ledger_full": ["md_ledger_account_s", "ledger_raw"],
    "md_account_d": ["md_account_src"],
    "ft_balance_f": ["md_account_src"],
    "md_exchange_rate_d": ["exchange_rate_raw"],
    "ft_posting_f": ["posting_raw"],
    "loaded_batches": ["mirror_delta"],
}


def with_views(names: list[str], body: str, extra: dict[str, str] | None = None) -> str:
    """``WITH`` chain of the named fixture views (plus dependencies) and ``extra`` CTEs."""
    order: list[str] = []

    def add(n: str) -> None:
        for dep in _DEPENDS.get(n, []):
            add(dep)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    ctes = [f"{n} AS ({FIXTURE_SQL[n].strip()})" for n in order]
    for n, sql in (extra or {}).items():
        ctes.append(f"{n} AS ({sql.strip()})")
    return "WITH " + ",\n".join(ctes) + "\n" + body.strip()
