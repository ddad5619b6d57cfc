"""Declared schemas and the fixed category / emoji vocabulary."""

from __future__ import annotations

import regex
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must equal the behaviour being reproduced).
#
# Category checking order.  A token belongs to the first category in this
# order whose dictionary column lists it; the order also breaks ties.
# The emoji dictionary has only the first seven categories.
TEXT_CATEGORIES = [
    "Event",
    "Travel",
    "Food",
    "Activity",
    "Transportation",
    "People",
    "Utility",
    "Cash",
    "Illegal_Sarcasm",
]
EMOJI_CATEGORIES = TEXT_CATEGORIES[:7]
NOT_CLASSIFIED = "Not_classified"
# Dictionary CSV header spelling of the last text category.
CSV_HEADER_ALIASES = {"Illegal/Sarcasm": "Illegal_Sarcasm"}
# Lifetime months kept in every panel: 0 (day of first payment) .. 12.
MAX_LIFETIME = 12
DAYS_PER_MONTH = 30
# End of fixed values.
# ---------------------------------------------------------------------------

# Pivot column order: alphabetical, as a sorted distinct over the data gives.
PROFILE_COLUMNS = sorted(TEXT_CATEGORIES + [NOT_CLASSIFIED])
CATEGORY_RANK = {name: i for i, name in enumerate(TEXT_CATEGORIES)}

PAYMENT_SCHEMA = T.StructType(
    [
        T.StructField("user1", T.LongType(), True),
        T.StructField("user2", T.LongType(), True),
        T.StructField("datetime", T.TimestampNTZType(), True),
        T.StructField("description", T.StringType(), True),
        T.StructField("transaction_type", T.StringType(), True),
    ]
)

DICTIONARY_SCHEMA = T.StructType(
    [
        T.StructField("src", T.StringType(), False),
        T.StructField("rk", T.IntegerType(), False),
        T.StructField("pos", T.IntegerType(), False),
        T.StructField("category", T.StringType(), False),
        T.StructField("token", T.StringType(), False),
    ]
)


def _emoji_ranges() -> list[tuple[int, int]]:
    """Code points with the Unicode property Emoji that are an emoji by themselves.

    ASCII (digits, # and *) and regional indicators have the property only as
    parts of sequences.
    """
    beyond_ascii = "".join(chr(c) for c in (*range(0x80, 0xD800), *range(0xE000, 0x20000)))
    runs = regex.finditer(r"(?V1)[\p{Emoji}--[\U0001F1E6-\U0001F1FF]]+", beyond_ascii)
    return [(ord(r[0][0]), ord(r[0][-1])) for r in runs]


# First and last code point of every run of emoji.
EMOJI_RANGES = _emoji_ranges()


def emoji_class() -> str:
    """Regex character class of emoji code points (Java and RE2 syntax)."""
    parts = "".join(f"\\x{{{lo:X}}}-\\x{{{hi:X}}}" for lo, hi in EMOJI_RANGES)
    return f"[{parts}]"
