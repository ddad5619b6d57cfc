"""Known answers on the generated tables (FIXTURES.md §4)."""

import pytest

from ledgerlens.operators import text
from ledgerlens.sources import derive_payments, fixture_dictionary

KNOWN = {
    "sf0.001": {
        "categories": {"Activity": 380, "Cash": 149, "Event": 578, "Food": 1932, "Illegal_Sarcasm": 438,
                       "Not_classified": 533, "Transportation": 376, "Travel": 566, "Utility": 1048},
        "emoji_only": 918,
        "emoji": {"🍕": 2230, "🚗": 1164, "🎉": 971, "⚽": 952},
    },
    "sf0.01": {
        "categories": {"Activity": 4564, "Cash": 2000, "Event": 8162, "Food": 13990, "Illegal_Sarcasm": 3530,
                       "Not_classified": 6564, "Transportation": 5065, "Travel": 6574, "Utility": 9551},
        "emoji_only": 8598,
        "emoji": {"🍕": 19199, "🎉": 10223, "🚗": 9876, "⚽": 9748},
    },
}


@pytest.mark.parametrize("sf", sorted(KNOWN))
def test_known_answers(spark, sf):
    p = derive_payments(spark, f"/root/testdata/{sf}")
    cats = text.payments_with_category(p, fixture_dictionary(spark)).groupBy("category").count()
    assert {r["category"]: r["count"] for r in cats.collect()} == KNOWN[sf]["categories"]
    assert text.emoji_only_count(p).first().sum_emoji_only == KNOWN[sf]["emoji_only"]
    assert {r.emoji: r.n for r in text.emoji_frequency(p).collect()} == KNOWN[sf]["emoji"]
    top = [r.emoji for r in text.top_emojis(p, 5).collect()]
    assert top == sorted(KNOWN[sf]["emoji"], key=lambda e: (-KNOWN[sf]["emoji"][e], e))
