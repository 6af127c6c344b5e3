from stratum.functions.columns import (  # noqa: F401
    content_md5,
    format_duration,
    replace_null_marker,
    safe_cast,
    safe_date,
    safe_strip,
    safe_year,
    snake_case,
    snake_case_columns,
    snake_case_name,
    truncate_text,
)
from stratum.functions.sql import SQL_FUNCTIONS, register_sql_functions  # noqa: F401
