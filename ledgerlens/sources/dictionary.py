"""Category dictionaries.

The dictionaries arrive as wide CSV files — one column per category, words
down the column, padded with nulls.  The engine works on one long table
``(src, rk, pos, category, token)``:

* ``src``  — ``text`` or ``emoji``; text entries come before emoji entries,
* ``rk``   — the category's place in the checking order,
* ``pos``  — the entry's row within its column (file order),
* ``token``— the word, or for emoji the first code point of the cell.

A dictionary is a few hundred entries, so joins against it broadcast it, but
only after its row count has been checked (``bounded``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlens.schema import (
    CATEGORY_RANK,
    CSV_HEADER_ALIASES,
    DICTIONARY_SCHEMA,
    EMOJI_CATEGORIES,
    TEXT_CATEGORIES,
)

# Largest dictionary that is broadcast; beyond it the join shuffles.
MAX_BROADCAST_ENTRIES = 200_000

# The dictionary fixture of FIXTURES.md §4 (src, rk, pos,
# category, token).  People (rk 5) is empty on purpose; 'plate' is listed
# under Travel and Food.
FIXTURE_ENTRIES = [
    ("text", 0, 0, "Event", "ring"),
    ("text", 1, 0, "Travel", "plate"),
    ("text", 2, 0, "Food", "plate"),
    ("text", 2, 1, "Food", "hot"),
    ("text", 2, 2, "Food", "cold"),
    ("text", 3, 0, "Activity", "gizmo"),
    ("text", 4, 0, "Transportation", "rod"),
    ("text", 6, 0, "Utility", "bolt"),
    ("text", 6, 1, "Utility", "gear"),
    ("text", 7, 0, "Cash", "small"),
    ("text", 8, 0, "Illegal_Sarcasm", "anvil"),
    ("emoji", 0, 0, "Event", "🎉"),
    ("emoji", 2, 0, "Food", "🍕"),
    ("emoji", 4, 0, "Transportation", "🚗"),
]


def fixture_dictionary(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(FIXTURE_ENTRIES, DICTIONARY_SCHEMA)


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """Scan one wide dictionary CSV (header row, every column a string)."""
    return spark.read.option("header", True).option("inferSchema", False).csv(path)


def dictionary_long(wide: DataFrame, src: str) -> DataFrame:
    """Unpivot a wide dictionary into the long form; nulls are dropped.

    Emoji cells keep only their first code point.  ``pos`` follows file
    order (``monotonically_increasing_id`` is increasing in file order).
    Every category must have its column, if only an empty one; other columns
    are not looked at.
    """
    allowed = TEXT_CATEGORIES if src == "text" else EMOJI_CATEGORIES
    renamed = wide
    for raw, clean in CSV_HEADER_ALIASES.items():
        if raw in renamed.columns:
            renamed = renamed.withColumnRenamed(raw, clean)
    missing = [c for c in allowed if c not in renamed.columns]
    if missing:
        raise ValueError(f"the {src} dictionary has no column for {', '.join(missing)}")
    stacked = (
        renamed.withColumn("_row", F.monotonically_increasing_id())
        .select(
            "_row",
            F.explode(
                F.array(
                    *[
                        F.struct(
                            F.lit(CATEGORY_RANK[c]).alias("rk"),
                            F.lit(c).alias("category"),
                            F.col(f"`{c}`").alias("token"),
                        )
                        for c in allowed
                    ]
                )
            ).alias("e"),
        )
        .select("_row", "e.*")
        .where(F.col("token").isNotNull())
    )
    if src == "emoji":
        stacked = stacked.withColumn("token", F.substring("token", 1, 1))
    # Window per category column: at most |dictionary| rows, bounded.
    pos = F.row_number().over(Window.partitionBy("rk").orderBy("_row")) - 1
    return stacked.select(
        F.lit(src).alias("src"),
        F.col("rk").cast("int"),
        pos.cast("int").alias("pos"),
        "category",
        "token",
    )


def read_dictionaries(spark: SparkSession, text_path: str, emoji_path: str) -> DataFrame:
    """Both CSVs as one long dictionary (text entries first)."""
    return dictionary_long(read_dictionary(spark, text_path), "text").unionByName(
        dictionary_long(read_dictionary(spark, emoji_path), "emoji")
    )


def bounded(dictionary: DataFrame, max_entries: int = MAX_BROADCAST_ENTRIES) -> DataFrame:
    """Broadcast hint only after the entry count is checked against a bound."""
    if dictionary.limit(max_entries + 1).count() <= max_entries:
        return F.broadcast(dictionary)
    return dictionary
