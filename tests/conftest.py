import datetime as dt
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerlens.schema import PAYMENT_SCHEMA  # noqa: E402
from ledgerlens.session import build_session  # noqa: E402

DAY0 = dt.datetime(2020, 1, 1)


@pytest.fixture(scope="session")
def spark():
    s = build_session(master="local[4]", shuffle_partitions=4, driver_memory="4g")
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="ledgerlens-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture(scope="session")
def make_payments(spark):
    """Payments from (payer, payee, day offset[, description[, type]]) tuples."""

    def build(rows):
        full = []
        for r in rows:
            u1, u2, day = r[0], r[1], r[2]
            desc = r[3] if len(r) > 3 else "x"
            kind = r[4] if len(r) > 4 else "payment"
            full.append((u1, u2, DAY0 + dt.timedelta(days=day), desc, kind))
        return spark.createDataFrame(full, PAYMENT_SCHEMA)

    return build


def as_dict(df, key_cols, val_col):
    return {tuple(r[c] for c in key_cols): r[val_col] for r in df.collect()}
