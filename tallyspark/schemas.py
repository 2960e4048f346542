"""Table schemas of the detail (DS), log and mart (DM) layers.

Money is DECIMAL(15,2) in the detail layer and DECIMAL(23,8) in the marts; the
unbounded exchange-rate numeric is DECIMAL(18,6).  Codes are strings so that
leading zeros survive (a type-inferring reader turns ``036`` into 36).
"""

from __future__ import annotations

from pyspark.sql import types as T

AMOUNT = T.DecimalType(15, 2)
RATE = T.DecimalType(18, 6)
MART = T.DecimalType(23, 8)

# Key columns of each detail table (primary keys of the DDL).
KEYS = {
    "ft_balance_f": ["on_date", "account_rk"],
    "ft_posting_f": ["oper_date", "credit_account_rk", "debet_account_rk"],
    "md_account_d": ["data_actual_date", "account_rk"],
    "md_currency_d": ["currency_rk", "data_actual_date"],
    "md_exchange_rate_d": ["data_actual_date", "currency_rk"],
    "md_ledger_account_s": ["ledger_account", "start_date"],
}

# NOT NULL columns besides the keys, per table.
NOT_NULL = {
    "md_account_d": ["data_actual_end_date", "account_number", "char_type", "currency_rk", "currency_code"],
}

# Varchar length limits of the DDL.
MAX_LENGTH = {
    "md_account_d": {"account_number": 20, "char_type": 1, "currency_code": 3},
    "md_currency_d": {"currency_code": 3, "code_iso_char": 3},
    "md_exchange_rate_d": {"code_iso_num": 3},
    "md_ledger_account_s": {
        "chapter": 1, "chapter_name": 16, "section_name": 22, "subsection_name": 21,
        "ledger1_account_name": 47, "ledger_account_name": 153, "characteristic": 1,
        "pair_account": 5, "min_term": 1, "min_term_measure": 1, "max_term": 1,
        "max_term_measure": 1, "ledger_acc_full_name_translit": 1, "is_revaluation": 1,
        "is_correct": 1,
    },
    "log_data": {"status": 15, "description": 255},
}


def _struct(spec: list[tuple[str, T.DataType]]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in spec])


FT_BALANCE_F = _struct([
    ("on_date", T.DateType()), ("account_rk", T.IntegerType()),
    ("currency_rk", T.IntegerType()), ("balance_out", AMOUNT),
])

FT_POSTING_F = _struct([
    ("oper_date", T.DateType()), ("credit_account_rk", T.IntegerType()),
    ("debet_account_rk", T.IntegerType()), ("credit_amount", AMOUNT), ("debet_amount", AMOUNT),
])

MD_ACCOUNT_D = _struct([
    ("data_actual_date", T.DateType()), ("data_actual_end_date", T.DateType()),
    ("account_rk", T.IntegerType()), ("account_number", T.StringType()),
    ("char_type", T.StringType()), ("currency_rk", T.IntegerType()), ("currency_code", T.StringType()),
])

MD_CURRENCY_D = _struct([
    ("currency_rk", T.IntegerType()), ("data_actual_date", T.DateType()),
    ("data_actual_end_date", T.DateType()), ("currency_code", T.StringType()),
    ("code_iso_char", T.StringType()),
])

MD_EXCHANGE_RATE_D = _struct([
    ("data_actual_date", T.DateType()), ("data_actual_end_date", T.DateType()),
    ("currency_rk", T.IntegerType()), ("reduced_cource", RATE), ("code_iso_num", T.StringType()),
])

# The 28 columns of the ledger-account reference table, in DDL order.
LEDGER_COLUMNS = [
    ("chapter", T.StringType()), ("chapter_name", T.StringType()),
    ("section_number", T.IntegerType()), ("section_name", T.StringType()),
    ("subsection_name", T.StringType()), ("ledger1_account", T.IntegerType()),
    ("ledger1_account_name", T.StringType()), ("ledger_account", T.IntegerType()),
    ("ledger_account_name", T.StringType()), ("characteristic", T.StringType()),
    ("is_resident", T.IntegerType()), ("is_reserve", T.IntegerType()),
    ("is_reserved", T.IntegerType()), ("is_loan", T.IntegerType()),
    ("is_reserved_assets", T.IntegerType()), ("is_overdue", T.IntegerType()),
    ("is_interest", T.IntegerType()), ("pair_account", T.StringType()),
    ("start_date", T.DateType()), ("end_date", T.DateType()),
    ("is_rub_only", T.IntegerType()), ("min_term", T.StringType()),
    ("min_term_measure", T.StringType()), ("max_term", T.StringType()),
    ("max_term_measure", T.StringType()), ("ledger_acc_full_name_translit", T.StringType()),
    ("is_revaluation", T.StringType()), ("is_correct", T.StringType()),
]
MD_LEDGER_ACCOUNT_S = _struct(LEDGER_COLUMNS)

DM_ACCOUNT_TURNOVER_F = _struct([
    ("on_date", T.DateType()), ("account_rk", T.IntegerType()),
    ("credit_amount", MART), ("credit_amount_rub", MART),
    ("debet_amount", MART), ("debet_amount_rub", MART),
])

# The twelve report measures in table order; each is followed by
# its ``r_`` twin in the stored table.
REPORT_MEASURES = [
    "balance_in_rub", "balance_in_val", "balance_in_total",
    "turn_deb_rub", "turn_deb_val", "turn_deb_total",
    "turn_cre_rub", "turn_cre_val", "turn_cre_total",
    "balance_out_rub", "balance_out_val", "balance_out_total",
]
REPORT_KEYS = ["from_date", "to_date", "chapter", "ledger_account", "characteristic"]
REPORT_COLUMNS = REPORT_KEYS + [c for m in REPORT_MEASURES for c in (m, "r_" + m)]

DM_F101_ROUND_F = _struct(
    [("from_date", T.DateType()), ("to_date", T.DateType()), ("chapter", T.StringType()),
     ("ledger_account", T.StringType()), ("characteristic", T.StringType())]
    + [(c, MART) for c in REPORT_COLUMNS[5:]]
)

LOAD_LOG = _struct([
    ("BEGIN", T.TimestampNTZType()), ("END", T.TimestampNTZType()), ("ID", T.StringType()), ("TABLE", T.StringType()),
])

DISCIPLINES = "row_id BIGINT, discipline STRING, season STRING"
