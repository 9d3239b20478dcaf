"""Counts, identifiers and statuses as Column functions. A null count is "not stated", zero is "stated zero"."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_int(value: Column) -> Column:
    """Text or number to a whole number by way of a double ("3.9" is 3); null if it is none or out of range."""
    return F.trim(value.cast("string")).try_cast("double").try_cast("int")


def lenient_int(value: Column) -> Column:
    """Whole-number text to its value, prose and null to 0."""
    return F.coalesce(F.trim(value.cast("string")).try_cast("int"), F.lit(0))


def first_int(value: Column) -> Column:
    """The first run of digits in a text ("about 12-15" is 12)."""
    return F.regexp_extract(value.cast("string"), r"\d+", 0).try_cast("int")


def count_diff(left: Column, right: Column) -> Column:
    """left - right; null if either is."""
    return left - right


def normal_id(value: Column) -> Column:
    """An identifier that may come as a float ("16470702.0"): whole digits; other text trimmed; null as ''."""
    text = F.trim(value.cast("string"))
    return F.coalesce(text.try_cast("double").try_cast("bigint").cast("string"), text, F.lit(""))


def valid_id(value: Column) -> Column:
    """One to eight digits."""
    return F.coalesce(value.rlike(r"^[0-9]{1,8}$"), F.lit(False))


def clean_text(value: Column) -> Column:
    """Trimmed; blank is null."""
    return F.nullif(F.trim(value), F.lit(""))


def ratio(part: Column, whole: Column) -> Column:
    """part / whole; null where whole is 0 or null."""
    return F.try_divide(part.cast("double"), F.nullif(whole.cast("double"), F.lit(0.0)))


# The words that stand for a status.
AFFECTED_WORDS = ("affected", "case", "symptomatic", "diseased", "patient")
UNAFFECTED_WORDS = ("unaffected", "control", "asymptomatic", "healthy", "normal", "nonaffected", "non-affected")


def affected_status(value: Column) -> Column:
    """affected, unaffected or uncertain; blank is null, any other word uncertain."""
    word = F.lower(clean_text(value))
    return F.when(word.isin(*AFFECTED_WORDS), "affected").when(word.isin(*UNAFFECTED_WORDS), "unaffected").when(word.isNotNull(), "uncertain")


def authoritative_count(status: Column, adjudicated: Column, stated: Column) -> Column:
    """The adjudicated count wherever there is a status, even if it is null; else the stated one. Never a coalesce."""
    return F.when(status.isNotNull(), adjudicated).otherwise(stated)


def closed_vocabulary(value: Column, allowed: tuple[str, ...], what: str) -> Column:
    """The value; the query fails on one that is not allowed."""
    wrong = F.raise_error(F.concat(F.lit(f"unknown {what}: "), value))
    return F.when(value.isNull() | value.isin(*allowed), value).otherwise(wrong.cast("string"))


def wilson(k: Column, n: Column, z: float = 1.96) -> tuple[Column, Column]:
    """Bounds of the score interval of k in n, within 0..1; null for n = 0."""
    k, n = k.cast("double"), F.nullif(n.cast("double"), F.lit(0.0))
    p, z2 = k / n, z * z
    middle, half = (p + z2 / (2 * n)) / (1 + z2 / n), z * F.sqrt(p * (1 - p) / n + z2 / (4 * n * n)) / (1 + z2 / n)
    return F.greatest(middle - half, F.lit(0.0)), F.when(middle.isNotNull(), F.least(middle + half, F.lit(1.0)))


def f_beta(precision: Column, recall: Column, beta: float = 2.0) -> Column:
    b2 = beta * beta
    return F.try_divide((1 + b2) * precision * recall, F.nullif(b2 * precision + recall, F.lit(0.0)))


def target_gap(matched: Column, gold: Column, target: float) -> Column:
    """How many more matches reach the target share; 0 if reached, null without gold."""
    return F.when(gold > 0, F.greatest(F.ceil(gold * target) - matched, F.lit(0)))


def stable_sample(key: Column, rate: float) -> Column:
    """True for the same share of keys in every run: the first 8 hex digits of SHA-256, modulo 10000."""
    return F.conv(F.substring(F.sha2(key.cast("string"), 256), 1, 8), 16, 10).cast("bigint") % 10000 < int(rate * 10000)


def content_key(**fields: Column) -> Column:
    """SHA-256 of the fields as JSON with sorted names; nulls are kept, so null and absent are one."""
    packed = F.to_json(F.struct(*[fields[n].alias(n) for n in sorted(fields)]), {"ignoreNullFields": "false"})
    return F.sha2(packed, 256)
