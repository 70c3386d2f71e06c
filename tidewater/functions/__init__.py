from tidewater.functions.casts import (  # noqa: F401
    try_number, try_decimal, try_timestamp_ntz, try_date, ts_to_date,
    date_key, iso_day_of_week, month_name, day_name, rounded_ratio, rounded_quotient,
)
