"""Column functions for keys, stamps, paths and free-text masking.

All of them build native Catalyst expressions (regexp_replace, trim, ...),
so they run inside whole-stage codegen on the executors; none is a UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Replacement tokens and masking patterns (Java regex dialect).
# Keyed JSON values get KEY_TOKEN, masked free text gets TEXT_TOKEN; the two
# spellings differ on purpose and both must be kept.
KEY_TOKEN = "(anonymized PII)"
TEXT_TOKEN = "(Anonymized PII)"
# Email, as originally specified (kept for SQL oracles / RE2 engines):
EMAIL_PATTERN = r"([^.@\s]+)(\.[^.@\s]+)*@([^.@\s]+\.)+([^.@\s]+)"
PHONE_PATTERN = r"\d{10}|(?:\d{3}-){2}\d{4}|\(\d{3}\)\d{3}-?\d{4}"
NAME_PATTERN = r"^[A-Za-z.\s_-]+$"
# Trim of every character <= U+0020 at both ends, then CR/LF runs -> one space.
EDGE_CONTROL_PATTERN = r"^[\x00-\x20]+|[\x00-\x20]+$"
LINE_BREAK_PATTERN = r"[\r\n]+"
# Run stamp rendering (12-hour clock, as the audit and output tables carry it).
STAMP_FORMAT = "y-MM-dd hh:mm:ss"
# ---------------------------------------------------------------------------

# Same matches as EMAIL_PATTERN, written so the Java engine cannot backtrack
# exponentially on long dotted runs: the lookbehinds start a match only where
# the original leftmost match could start, and possessive quantifiers stop
# the engine from retrying shorter segment splits.
EMAIL_PATTERN_LINEAR = (
    r"(?<![^.@\s])(?<![^.@\s]\.)[^.@\s]++(?:\.[^.@\s]++)*+@[^.@\s]++(?:\.[^.@\s]++)++"
)


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def mask_email(col: Column | str) -> Column:
    """Every match needs an '@': a plain byte search skips the regex scan for
    the (usual) texts without one."""
    c = _c(col)
    return F.when(c.contains("@"), F.regexp_replace(c, EMAIL_PATTERN_LINEAR, TEXT_TOKEN)).otherwise(c)


def mask_phone(col: Column | str) -> Column:
    """Every alternative of the pattern contains three digits in a row, so a
    quick search for them skips the full pattern on most texts."""
    c = _c(col)
    return F.when(c.rlike(r"\d{3}"), F.regexp_replace(c, PHONE_PATTERN, TEXT_TOKEN)).otherwise(c)


def mask_name(col: Column | str) -> Column:
    """Replace the whole value when it consists only of ASCII letters,
    whitespace, dot, underscore and hyphen."""
    return F.regexp_replace(_c(col), NAME_PATTERN, TEXT_TOKEN)


def mask_text(col: Column | str) -> Column:
    """Email, then phone, then whole-value name masking, in that order."""
    return mask_name(mask_phone(mask_email(col)))


def flatten_lines(col: Column | str) -> Column:
    return F.regexp_replace(F.regexp_replace(_c(col), EDGE_CONTROL_PATTERN, ""),
                            LINE_BREAK_PATTERN, " ")


def source_key(id_col: Column | str, source: str) -> Column:
    """Join key of a customer id in the identity service: trim('<source>-' || id)."""
    return F.trim(F.concat(F.lit(f"{source}-"), _c(id_col)))


def source_id(id_col: Column | str, source: str) -> Column:
    return F.concat(F.lit(f"{source}-"), _c(id_col))


def normalize_email(col: Column | str) -> Column:
    return F.lower(F.trim(_c(col)))


def run_stamp(as_of: str | None = None) -> Column:
    """Run stamp of the form 'y-MM-dd hh:mm:ss' taken from a date.

    A date carries no time, so on a 12-hour clock it is always
    '<date> 12:00:00'.  ``as_of`` (yyyy-MM-dd) pins the date; without it the
    session's current date is used.
    """
    day = F.to_date(F.lit(as_of)) if as_of else F.current_date()
    return stamp_of(day)


def stamp_of(day: Column | str) -> Column:
    """'y-MM-dd hh:mm:ss' rendering of a date or timestamp column."""
    return F.date_format(_c(day), STAMP_FORMAT)


def path_part(path: Column | str, index: int) -> Column:
    """0-based element of a '/'-split path ('s3://b/p' -> ['s3:', '', 'b', 'p'])."""
    return F.get(F.split(_c(path), "/"), index)


def format_count(col: Column | str) -> Column:
    """Integer with thousands separators, for report text."""
    return F.format_number(_c(col), 0)
