"""Text and identity column functions.

All are built-in Spark expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions._util import as_col


def strip_ws(c) -> Column:
    """Trim every kind of leading/trailing whitespace (tabs, newlines too).

    Spark's ``trim`` removes only spaces; the source semantics strip all
    whitespace (trap T4).
    """
    return F.regexp_replace(as_col(c), r"^\s+|\s+$", "")


def email_norm(c) -> Column:
    """lower(trim(email)) — the normal form every source is matched on."""
    return F.lower(strip_ws(c))


def sha256_hex_upper(c) -> Column:
    """SHA-256 of the UTF-8 text as upper-case hex."""
    return F.upper(F.sha2(as_col(c), 256))


def email_hash(c) -> Column:
    """Deterministic person key: upper-hex SHA-256 of the normalised e-mail."""
    return sha256_hex_upper(email_norm(c))


def customer_key_of(email_hash_col) -> Column:
    """Surrogate key = hash of the hex text of the e-mail hash."""
    return sha256_hex_upper(email_hash_col)


def count_occurrences(c, delim: str) -> Column:
    c = as_col(c)
    return F.floor((F.length(c) - F.length(F.replace(c, F.lit(delim), F.lit("")))) / len(delim))


def split_field(c, delim: str, n: int) -> Column:
    """``split_part`` that yields NULL when field ``n`` does not exist.

    Spark returns '' past the last field; the source semantics return NULL,
    while an existing but empty field stays ''.
    """
    c = as_col(c)
    return F.when(count_occurrences(c, delim) >= n - 1,
                  F.split_part(c, F.lit(delim), F.lit(n)))


def email_domain(norm) -> Column:
    """Domain part of an already normalised address; NULL without '@'."""
    return split_field(norm, "@", 2)


def email_mask(norm) -> Column:
    """``x***@domain``; NULL-propagating like SQL ``||``."""
    norm = as_col(norm)
    return F.concat(F.substring(norm, 1, 1), F.lit("***@"), email_domain(norm))


def initial(c) -> Column:
    return F.substring(as_col(c), 1, 1)


def first_word(c) -> Column:
    return split_field(c, " ", 1)


def second_word_initial(c) -> Column:
    return initial(split_field(c, " ", 2))
