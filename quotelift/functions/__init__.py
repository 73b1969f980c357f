from quotelift.functions.cleaning import (
    as_date,
    blank_to_null,
    is_blank,
    looks_numeric,
    make_date,
    normalize_key,
    parse_date,
    parse_number_ptbr,
    parse_number_us,
    status_key,
)
from quotelift.functions.hashing import fold_of, hash_fraction

__all__ = [
    "as_date",
    "blank_to_null",
    "fold_of",
    "hash_fraction",
    "is_blank",
    "looks_numeric",
    "make_date",
    "normalize_key",
    "parse_date",
    "parse_number_ptbr",
    "parse_number_us",
    "status_key",
]
