"""Column expressions; all built-ins, so they stay inside whole-stage codegen."""

from .dates import following_days, month_of, parse_date, parse_date_clamped
from .lists import code_count, codes
from .numbers import (
    MONEY,
    SQUARE_SUMS,
    checked_money,
    money,
    money_fault,
    parse_double,
    parse_id,
    parse_int,
    population_variance,
    square_sums,
    with_variances,
)
from .sizes import SIZE_RANK, at_least_size, size_rank
from .text import key_text, label_text, trimmed

__all__ = [
    "MONEY",
    "SIZE_RANK",
    "SQUARE_SUMS",
    "at_least_size",
    "checked_money",
    "code_count",
    "codes",
    "following_days",
    "key_text",
    "label_text",
    "money",
    "money_fault",
    "month_of",
    "parse_date",
    "parse_date_clamped",
    "parse_double",
    "parse_id",
    "parse_int",
    "population_variance",
    "size_rank",
    "square_sums",
    "trimmed",
    "with_variances",
]
