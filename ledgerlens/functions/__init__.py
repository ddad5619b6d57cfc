"""Column expressions shared by the operators (all JVM-side built-ins)."""

from ledgerlens.functions.exprs import (
    code_points,
    contains_emoji,
    emoji_only,
    extract_emojis,
    lifetime_month,
    round_share,
    text_tokens,
)

__all__ = [
    "code_points",
    "contains_emoji",
    "emoji_only",
    "extract_emojis",
    "lifetime_month",
    "round_share",
    "text_tokens",
]
