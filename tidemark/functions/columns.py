"""Column expressions shared by the operators. All of them run inside generated code."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.fixed_values import GENDER_LABELS, SENTIMENT_PATTERN

# Enough digits for the service's ratios; sums stay exact whatever the row order.
RATIO_TYPE = "decimal(28,8)"


def number(column: str, kind: str = "bigint") -> Column:
    """Counter as a number; text that is none becomes null instead of failing the job."""
    return F.col(column).try_cast(kind)


def per_view(numerator: Column, views: Column) -> Column:
    return numerator / (views + F.lit(1.0))


def channel_tier(subscribers: Column) -> Column:
    return (
        F.when(subscribers > 1_000_000, "platinum")
        .when(subscribers > 100_000, "gold")
        .when(subscribers > 10_000, "silver")
        .otherwise("bronze")
    )


def flag(condition: Column) -> Column:
    """1 when the condition holds, 0 when it does not or is unknown."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def sentiment(text: Column, pattern: str = SENTIMENT_PATTERN) -> Column:
    return flag(text.rlike(pattern))


def gender_label(code: Column) -> Column:
    labelled = None
    for value, label in GENDER_LABELS.items():
        labelled = F.when(code == value, label) if labelled is None else labelled.when(code == value, label)
    return labelled


def share_percent(value: Column, total: Column) -> Column:
    """Percentage to two places, half up on the computed double."""
    percent = value.cast("double") / total.cast("double") * 100
    return F.floor(percent * 100 + 0.5) / 100


def row_digest(columns: Sequence[str], null_safe: bool = False) -> Column:
    """SHA-256 over the columns; nulls are skipped unless ``null_safe`` marks them."""
    parts = [F.col(c).cast("string") for c in columns]
    if null_safe:
        parts = [F.coalesce(F.concat(F.lit("v"), p), F.lit("n")) for p in parts]
    return F.sha2(F.concat_ws("||", *parts), 256)


def document_id(columns: Sequence[str]) -> Column:
    return F.concat_ws("_", *[F.col(c).cast("string") for c in columns])


def utc_date(timestamp: Column) -> Column:
    """Calendar day in UTC, whatever the session's zone is."""
    return F.date_from_unix_date(F.floor(F.unix_seconds(timestamp) / 86_400).cast("int"))


def _literal(text: str) -> str:
    return "".join(ch if ch.isalnum() or ch == " " else "\\" + ch for ch in text)


def _first_in(heads: Sequence[str], ranges: int = 3) -> str:
    """Look-ahead for one of the heads: Latin ones exactly, the others by a few ranges that cover them."""
    latin = "".join(_literal(h) for h in heads if ord(h) < 256)
    points = sorted(ord(h) for h in heads if ord(h) >= 256)
    widest = sorted(range(1, len(points)), key=lambda i: points[i - 1] - points[i])[: ranges - 1]
    edges = sorted({0, *widest, len(points)})
    spans = [(points[a], points[b - 1]) for a, b in zip(edges, edges[1:])]
    return "(?=[" + latin + "".join(f"{_literal(chr(a))}-{_literal(chr(b))}" for a, b in spans) + "])"


def any_term_pattern(terms: Sequence[str], group: int = 9) -> str:
    """Regex that finds any of the terms in one walk over the text.

    Terms are gathered by first character and these in groups, each behind a cheap
    look-ahead, so most positions of a text are passed after one or two tests.
    """
    by_head: dict[str, list[str]] = {}
    for term in sorted(set(terms)):
        by_head.setdefault(term[0], []).append(_literal(term[1:]))
    branches = {head: f"{_literal(head)}(?:{'|'.join(tails)})" for head, tails in by_head.items()}
    heads = list(branches)
    groups = [heads[i : i + group] for i in range(0, len(heads), group)]
    inner = "|".join(f"{_first_in(g)}(?:{'|'.join(branches[h] for h in g)})" for g in groups)
    return f"{_first_in(heads)}(?:{inner})"


def contains_any(text: Column, terms: Sequence[str]) -> Column:
    """Whether the text contains at least one term, case-sensitive."""
    if not terms:
        return F.lit(False)
    if "" in terms:
        return text.isNotNull()
    return text.rlike(any_term_pattern(terms))


def grams(text: Column, size: int) -> Column:
    """The distinct substrings of ``size`` characters, cut from the text one phase after the other, so in linear time."""
    phases = [F.regexp_extract_all(F.substring(text, k + 1, 2**31 - 1), F.lit(f"(?s).{{{size}}}"), F.lit(0)) for k in range(size)]
    return F.array_distinct(F.concat(*phases))
