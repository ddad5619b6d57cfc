"""Helpers shared by the operators: reading a table, mapping texts in Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

# Rows handled together inside a task; bounds the working arrays, not the data.
SLICE_ROWS = 256
_TEXT = "__llm_text"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def col(name: str) -> F.Column:
    """A column by its exact name, whatever characters it has."""
    return F.col("`" + name.replace("`", "``") + "`")


def finite_vector(name: str) -> F.Column:
    """True where a vector is not null and holds no null or non-finite component."""
    ok = F.forall(col(name).cast("array<double>"), lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    return F.coalesce(ok, F.lit(False))


def integer_components(name: str, scale: int = 256) -> F.Column:
    """floor(scale * component) of a vector, each component taken as a double."""
    return F.transform(col(name).cast("array<double>"), lambda e: F.floor(e * scale))


def map_texts(
    df: DataFrame,
    text_col: str,
    make: Callable[[], Callable[[list], tuple]],
    schema: str,
    keep: tuple[str, ...] = ("doc_id",),
    rows: int = SLICE_ROWS,
) -> DataFrame:
    """Apply a function to whole texts, a slice of rows at a time.

    ``make()`` runs once per task and returns ``f(texts) -> (take, columns)``.
    ``columns`` follow ``schema``; ``take`` is None when there is one output row
    per text, else the position of the text each output row belongs to.
    Only ``keep`` and the text leave the JVM, so clashing extra columns of the
    input never matter.  A null text reaches ``f`` as None.
    """
    src = df.select(*[col(c) for c in keep], col(text_col).cast("string").alias(_TEXT))
    added = T._parse_datatype_string(schema)
    out = T.StructType([src.schema[c] for c in keep] + list(added))
    types = [to_arrow_type(f.dataType) for f in added]
    names = [f.name for f in out]
    n_keep = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = make()
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                part = batch.slice(start, rows)
                take, cols = f(part.column(n_keep).to_pylist())
                kept = [part.column(i) for i in range(n_keep)]
                if take is not None:
                    at = pa.array(take, pa.int64())
                    kept = [c.take(at) for c in kept]
                made = [c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(cols, types)]
                yield pa.RecordBatch.from_arrays([*kept, *made], names=names)

    return src.mapInArrow(run, out)
