from .casting import (
    clean_text,
    lenient_date,
    load_double,
    load_int,
    rule_number,
    strict_date,
)
from .rounding import round_half_away, round_half_even

__all__ = [
    "clean_text",
    "lenient_date",
    "load_double",
    "load_int",
    "rule_number",
    "strict_date",
    "round_half_away",
    "round_half_even",
]
