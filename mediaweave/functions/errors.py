"""Error texts sorted into classes by what they contain."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Parts of an error text, compared in lower case.
QUOTA = ("resource_exhausted", "429", "quota", "rate")
TRANSIENT = ("deadline", "timeout", "unavailable", "temporarily", "connection")
STORE_RETRYABLE = (
    "timeout",
    "timed out",
    "connection",
    "connection reset",
    "network",
    "not primary",
    "node is recovering",
    "server selection",
    "temporarily",
    "interrupted",
    "shutdown",
    "primary stepped down",
    "retry",
)
STOP = (
    "not_found",
    "not found",
    "no longer available",
    "model",
    "quota",
    "rate limit",
    "resource_exhausted",
    "permission",
    "unauthorized",
    "authentication",
    "api key",
    "deadline",
    "timeout",
    "connection",
    "network",
    "temporarily unavailable",
    "service unavailable",
    "internal",
    "503",
    "500",
    "502",
    "504",
)


def contains_any(error: Column, parts: tuple[str, ...], whole_words: bool = False) -> Column:
    found = "|".join(part.replace(" ", r"\ ") for part in parts)
    pattern = rf"\b(?:{found})\b" if whole_words else found
    return F.lower(F.coalesce(error, F.lit(""))).rlike(pattern)


def is_quota(error: Column, strict: bool = False) -> Column:
    """With ``strict``, "generate" no longer counts as "rate"."""
    return contains_any(error, QUOTA, strict)


def is_transient(error: Column) -> Column:
    return contains_any(error, TRANSIENT)


def is_quota_or_transient(error: Column, strict: bool = False) -> Column:
    return is_quota(error, strict) | is_transient(error)


def is_store_retryable(error: Column) -> Column:
    return contains_any(error, STORE_RETRYABLE)


def is_stop(error: Column) -> Column:
    return contains_any(error, STOP)


def error_class(error: Column, strict: bool = False) -> Column:
    return (
        F.when(F.trim(F.coalesce(error, F.lit(""))) == "", "none")
        .when(is_quota(error, strict), "quota")
        .when(is_transient(error), "transient")
        .when(is_store_retryable(error), "store_retryable")
        .when(is_stop(error), "stop")
        .otherwise("other")
    )
