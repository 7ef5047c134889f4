from tallycube.functions.columns import (
    base_code,
    blank_to_null,
    clean_number,
    clean_year,
    lenient_sum,
    percent_change,
    relative_change,
    release_text,
    residual_code,
    strict_sum,
)

__all__ = [
    "base_code",
    "blank_to_null",
    "clean_number",
    "clean_year",
    "lenient_sum",
    "percent_change",
    "relative_change",
    "release_text",
    "residual_code",
    "strict_sum",
]
