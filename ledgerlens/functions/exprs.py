"""Scalar column expressions.

All of these compile to Catalyst expressions, so they stay inside
whole-stage code generation; there is no Python UDF anywhere in the engine.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlens.schema import DAYS_PER_MONTH, emoji_class

_EMOJI = emoji_class()


def _c(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def text_tokens(description: Column | str) -> Column:
    """Words of a description: lower-case, then every maximal ``[a-z]+`` run.

    Lower-casing, turning digits and every non-alphanumeric run into a space
    and splitting on blanks leaves exactly the ``[a-z]+`` runs, so accented,
    numeric or multi-word dictionary entries can never match.
    """
    return F.regexp_extract_all(F.lower(_c(description)), F.lit("([a-z]+)"), 1)


def code_points(description: Column | str) -> Column:
    """Every code point of the string, in order (``(?s)`` keeps newlines)."""
    col = _c(description)
    return F.regexp_extract_all(col, F.lit("(?s)(.)"), 1)


def contains_emoji(description: Column | str) -> Column:
    col = _c(description)
    return F.coalesce(col.rlike(_EMOJI), F.lit(False))


def emoji_only(description: Column | str) -> Column:
    """1 when every code point is an emoji; the empty string counts as 1."""
    col = _c(description)
    return F.when(col.rlike(f"^{_EMOJI}*\\z"), F.lit(1)).otherwise(F.lit(0))


def extract_emojis(description: Column | str) -> Column:
    """The emoji code points of the string, concatenated in order."""
    col = _c(description)
    return F.array_join(F.regexp_extract_all(col, F.lit(f"({_EMOJI})"), 1), "")


def lifetime_month(ts: Column | str, start: Column | str) -> Column:
    """Month of the user's life: ``ceil(days since first payment / 30)``.

    Month 0 is the first day only; month k >= 1 covers days 30(k-1)+1 .. 30k.
    """
    return F.ceil(F.datediff(_c(ts), _c(start)) / F.lit(DAYS_PER_MONTH)).cast("bigint")


def round_share(part: Column | str, whole: Column | str) -> Column:
    """``round(part / whole, 2)`` half-up, computed exactly on integers.

    ``floor((200 k + n) / (2 n)) / 100`` equals Spark's decimal half-up
    rounding of ``k / n`` and is free of the binary-double tie cases where
    engines disagree.
    """
    k, n = _c(part), _c(whole)
    return (F.floor((F.lit(200) * k + n) / (F.lit(2) * n)) / F.lit(100)).cast("double")
