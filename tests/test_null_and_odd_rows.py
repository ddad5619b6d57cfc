"""Payments without payer, payee, date or description."""

import datetime as dt

import pytest
from conftest import DAY0

from ledgerlens.operators import clock, features, graph, profile
from ledgerlens.schema import MAX_LIFETIME, PAYMENT_SCHEMA, PROFILE_COLUMNS
from ledgerlens.session import clear_scratch, materialize, release, scratch_dir
from ledgerlens.sources import fixture_dictionary


@pytest.fixture(scope="module")
def odd(spark):
    day = lambda n: DAY0 + dt.timedelta(days=n)
    rows = [
        (1, 2, day(0), "cold", "payment"),
        (1, None, day(40), None, "payment"),
        (None, 2, day(5), "rod", "payment"),
        (None, 3, day(70), "bolt", "charge"),
        (4, 1, None, "gear", "payment"),
        (2, 2, day(9), "hot", "payment"),
    ]
    return spark.createDataFrame(rows, PAYMENT_SCHEMA)


def test_payments_without_a_payer_share_a_clock(odd):
    rows = {(r.user1, r.user2): r for r in clock.sender_clock(odd).collect()}
    assert len(rows) == 6
    assert rows[None, 2].lifetime == 0 and rows[None, 3].lifetime == 3 and rows[None, 3].days == 65
    assert rows[4, 1].lifetime is None


def test_panels_hold_users_only(spark, odd):
    users = {r.user1 for r in features.rf_panel(odd).collect()}
    assert users == {1, 2, 4}
    assert {r.user1 for r in graph.cum_friends(odd).collect()} == {1, 2}


def test_a_user_without_dated_payments_has_null_shares(spark, odd):
    rows = profile.cumulative_profile(odd, fixture_dictionary(spark)).where("user1 = 4").collect()
    assert len(rows) == MAX_LIFETIME + 1
    assert all(r[c] is None for r in rows for c in PROFILE_COLUMNS)


def test_scratch_is_released_and_cleared(spark):
    folder = spark._jvm.org.apache.hadoop.fs.Path(scratch_dir(spark))
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    stored = materialize(spark.range(3), "kept")
    path = spark._jvm.org.apache.hadoop.fs.Path(stored.inputFiles()[0]).getParent()
    assert stored.count() == 3 and fs.exists(path)
    release(stored)
    assert not fs.exists(path) and fs.exists(folder)
    release(stored)  # a second time is no error
    another = spark.newSession()
    assert scratch_dir(another) == scratch_dir(spark)
    assert callable(clear_scratch)  # called by the bench, not here: other tests still read their tables
