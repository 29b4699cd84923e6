"""Text helpers built from Spark string functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def extract(x: Column, pattern: str) -> Column:
    """First match, or null."""
    return F.regexp_substr(x, F.lit(pattern))


def group(x: Column, pattern: str, i: int = 1) -> Column:
    """Capture group of the first match, or null when there is no match."""
    return F.when(x.rlike(pattern), F.regexp_extract(x, pattern, i))


def count(x: Column, pattern: str) -> Column:
    return F.regexp_count(x, F.lit(pattern))


def trim(x: Column) -> Column:
    return F.regexp_replace(x, r"\A\s+|\s+\z", "")


def squish(x: Column) -> Column:
    return trim(F.regexp_replace(x, r"\s+", " "))


def title(x: Column) -> Column:
    """Upper-case first letter of each word; a word also starts after a hyphen or any other non-letter."""
    words = F.split(F.lower(x), r"(?<=[^\p{L}\p{N}'])(?=[\p{L}\p{N}])")
    return F.array_join(F.transform(words, F.initcap), "")


def sentence(x: Column) -> Column:
    return F.concat(F.upper(F.substring(x, 1, 1)), F.lower(F.substr(x, F.lit(2))))


def replace_first(x: Column, pattern: str, to: str) -> Column:
    """Replace the first match only; the pattern must hold no capture group."""
    return F.regexp_replace(x, rf"\A((?s:.*?))(?:{pattern})", rf"$1{to}")


def phone(x: Column) -> Column:
    """(ddd) ddd-dddd from any spelling; a leading country digit 1 is dropped."""
    digits = F.regexp_replace(F.regexp_replace(x, r"\D", ""), r"\A1(?=\d{10}\z)", "")
    return F.regexp_replace(digits, r"\A(\d{3})(\d{3})(\d{4})\z", "($1) $2-$3")


EMAIL = r"\A[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\z"


def email_parts(x: Column) -> dict[str, Column]:
    return {
        "username": extract(x, r"\A[^@]+"),
        "domain": group(x, r"@(.+)\z"),
        "tld": extract(x, r"[^.]+\z"),
        "valid": x.rlike(EMAIL) & ~F.contains(x, F.lit("..")),
    }


def log_fields(x: Column) -> dict[str, Column]:
    """Fields of ``[time] LEVEL [service]: message`` lines."""
    return {
        "at": F.try_to_timestamp(group(x, r"\A\[([^\]]+)\]"), F.lit("yyyy-MM-dd HH:mm:ss")),
        "level": group(x, r"\] ([A-Z]+) \["),
        "service": group(x, r"[A-Z] \[([^\]]+)\]"),
        "message": group(x, r"\]: (.*)\z"),
        "user": group(x, r"user=(\d+)"),
        "ip": extract(x, r"\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}"),
        "duration": group(x, r"took ([0-9.]+) ms").try_cast("double"),
    }
