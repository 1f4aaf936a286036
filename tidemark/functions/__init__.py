"""Column functions: every one is a composition of Spark built-ins."""

from tidemark.functions.num import pct, ratio, safe_div
from tidemark.functions.text import (customer_key_of, email_domain, email_hash, email_mask,
                                     email_norm, first_word, initial, second_word_initial,
                                     sha256_hex_upper, split_field, strip_ws)
from tidemark.functions.time import (clamp_non_negative, from_epoch_seconds, from_iso8601,
                                     hours_between, iso_utc_text, months_between_whole,
                                     try_double, try_instant, try_local, ts_literal)

__all__ = [
    "pct", "ratio", "safe_div",
    "customer_key_of", "email_domain", "email_hash", "email_mask", "email_norm", "first_word",
    "initial", "second_word_initial", "sha256_hex_upper", "split_field", "strip_ws",
    "clamp_non_negative", "from_epoch_seconds", "from_iso8601", "hours_between", "iso_utc_text",
    "months_between_whole", "try_double", "try_instant", "try_local", "ts_literal",
]
