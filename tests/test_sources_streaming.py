"""Panel round trip with partition pruning; streaming categorisation."""

import io
import contextlib
import tempfile

from pyspark.sql import functions as F

from ledgerlens.operators import features, text
from ledgerlens.sources import derive_payments, fixture_dictionary, read_panel, read_payments, write_panel
from ledgerlens.streaming import categorized_batches

SF = "/root/testdata/sf0.001"


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_panel_roundtrip_prunes(spark):
    panel = features.model1_input(derive_payments(spark, SF))
    path = tempfile.mkdtemp(prefix="ledgerlens-panel-") + "/panel"
    write_panel(panel, path, files_per_partition=2)
    month = read_panel(spark, path, lifetime=3)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        month.explain()
    assert "PartitionFilters: [isnotnull(lifetime" in buf.getvalue()
    want = panel.where(F.col("lifetime") == 3)
    assert _rows(month.select(*want.columns)) == _rows(want)
    # re-writing one month replaces it (dynamic overwrite), no duplicates
    write_panel(want, path)
    assert read_panel(spark, path).count() == panel.count()


def test_stream_categorizes_each_file_once(spark):
    payments = derive_payments(spark, SF)
    src = tempfile.mkdtemp(prefix="ledgerlens-stream-src-")
    sink = tempfile.mkdtemp(prefix="ledgerlens-stream-sink-")
    ckpt = tempfile.mkdtemp(prefix="ledgerlens-stream-ckpt-")
    payments.repartition(3).write.mode("overwrite").parquet(src)
    q = categorized_batches(
        spark, src, fixture_dictionary(spark), sink, checkpoint_location=ckpt,
        available_now=True, max_files_per_trigger=1,
    )
    q.awaitTermination(300)
    got = spark.read.parquet(sink).drop("batch")
    want = text.payments_with_category(read_payments(spark, src), fixture_dictionary(spark))
    assert _rows(got.select(*want.columns)) == _rows(want)
