"""Text goldens (FIXTURES.md §5) and the dictionary CSV path."""

import os
import tempfile

import pytest
from conftest import DAY0

from ledgerlens.operators import text
from ledgerlens.schema import PAYMENT_SCHEMA
from ledgerlens.sources import dictionary_long, fixture_dictionary, read_dictionaries

CASES = [
    (None, "Not_classified"),
    ("", "Not_classified"),
    ("🍕", "Food"),
    ("Ring 🍕", "Event"),  # tie: text entry first
    ("plate cold", "Travel"),  # 'plate' twice under Travel (two hits)
    ("pizza pizza", "Not_classified"),
    ("HOT-rod 99", "Food"),  # tie: earlier rank wins
    ("ring ring ring cold hot", "Food"),  # 'ring' is one hit
]


def _payments(spark, descs):
    rows = [(i, i + 1, DAY0, d, "payment") for i, d in enumerate(descs)]
    return spark.createDataFrame(rows, PAYMENT_SCHEMA)


def test_text_cases(spark):
    p = _payments(spark, [d for d, _ in CASES])
    out = {r.user1: r.category for r in text.payments_with_category(p, fixture_dictionary(spark)).collect()}
    for i, (_, want) in enumerate(CASES):
        assert out[i] == want, CASES[i]


def test_emoji_flags_and_extraction(spark):
    p = _payments(spark, ["🍕🎉", "", "a🍕", "⚽"])
    flags = {r.user1: r.emoji_only for r in text.emoji_only_flag(p).collect()}
    assert flags == {0: 1, 1: 1, 2: 0, 3: 1}
    em = {r.user1: r.emoji for r in text.blank_to_null(p).collect()}
    assert em == {0: "🍕🎉", 1: None, 2: "🍕", 3: "⚽"}
    counts = {r.category: r.n for r in text.emoji_category_counts(p, fixture_dictionary(spark)).collect()}
    assert counts["Food"] == 2 and counts["Event"] == 1 and counts["Not_classified"] == 1
    assert counts["People"] == 0


def test_emoji_are_the_code_points_with_the_property(spark):
    """⭐ ⏰ © are emoji outside the pictograph blocks; ★ ✓ and digits are none, nor is half a flag."""
    p = _payments(spark, ["⭐", "⏰", "✔", "★", "✓", "7#*", "🇩🇪", "🏻"])
    assert [r.emoji_only for r in text.emoji_only_flag(p).orderBy("user1").collect()] == [1, 1, 1, 0, 0, 0, 0, 1]
    flags = {r.description: r.has_emoji for r in text.contains_emoji_flag(p).collect()}
    assert [flags[d] for d in ("⭐", "⏰", "★", "✓", "7#*")] == [True, True, False, False, False]
    assert [r.emoji for r in text.with_emojis(_payments(spark, ["a⭐★b⏰✓🍕"])).collect()] == ["⭐⏰🍕"]


def test_dictionary_without_a_category_column_is_an_error(spark):
    wide = spark.createDataFrame([("ring", "plate")], "Event string, Travel string")
    with pytest.raises(ValueError, match="no column for Food"):
        dictionary_long(wide, "text")


def test_dictionary_csv_long_form(spark):
    folder = tempfile.mkdtemp(prefix="ledgerlens-dict-")
    tpath = os.path.join(folder, "text.csv")
    epath = os.path.join(folder, "emoji.csv")
    with open(tpath, "w", encoding="utf-8") as f:
        f.write("Event,Travel,Food,Activity,Transportation,People,Utility,Cash,Illegal/Sarcasm\n")
        f.write("ring,plate,plate,gizmo,rod,,bolt,small,anvil\n")
        f.write(",,hot,,,,gear,,\n")
        f.write(",,cold,,,,,,\n")
    with open(epath, "w", encoding="utf-8") as f:
        f.write("Event,Travel,Food,Activity,Transportation,People,Utility\n")
        f.write("🎉x,,🍕,,🚗,,\n")
    d = read_dictionaries(spark, tpath, epath)
    got = sorted(tuple(r) for r in d.collect())
    want = sorted(tuple(r) for r in fixture_dictionary(spark).collect())
    assert got == want


def test_emoji_test_runs_per_distinct_description(spark, make_payments):
    """The descriptions are stored before the emoji test, which would otherwise be moved to every payment."""
    p = make_payments([(1, 2, d, "🍕 pizza") for d in range(5)] + [(1, 3, 1, "cold")])
    made = text.classify(p, fixture_dictionary(spark))
    assert any("/descriptions-" in f for f in made.inputFiles())
    assert len({r.description for r in made.collect()}) == made.count() <= 2
