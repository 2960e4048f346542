from tallyspark.functions.dates import (  # noqa: F401
    as_date, date_col, date_shape_ok, month_bounds_py, month_end, month_start,
    parse_date, prev_month_end, prev_month_end_py, valid_on,
)
