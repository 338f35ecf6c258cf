"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

from tallystar.session import fresh_path
from tallystar.shipping import ship_package

HELD_OUT_FOLDS = 5
SLICE = 256                # rows turned into Python values at a time


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared scratch folder and read it back.

    Cuts the lineage: a lost executor costs the tasks that read the files,
    not the work that made them.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shipped(df: DataFrame) -> DataFrame:
    """``df``, whose session's workers can import this package."""
    ship_package(df.sparkSession)
    return df


def held_out(doc_id: Column) -> Column:
    """True for the evaluation fold: crc32 of the id's text modulo 5 is 0."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % HELD_OUT_FOLDS == 0, F.lit(False))


def sample_order(*cols: Column) -> Column:
    """A reproducible pseudo-random order for bounded samples."""
    return F.xxhash64(*cols)


def bounded_sample(rows: DataFrame, n: int, *key: str) -> DataFrame:
    """At most ``n`` rows, those whose keys hash smallest: the same on every run.

    Of many rows, first those below the hash that about 2n rows fall under are
    kept (counted, and not relied on), so the final top-k reads a few times
    ``n`` rows, however many tasks there are."""
    order = sample_order(*key)
    total = rows.count()
    if total > 4 * n:
        low = rows.where(order < int(-2 ** 63 + 2 ** 64 * (2 * n / total)))
        if low.limit(n).count() == n:
            rows = low
    return rows.orderBy(order, *key).limit(n)


def _appended(df: DataFrame, dropped: str | None, texts: Callable[[pa.RecordBatch], pa.Array],
              fn: Callable[[str | None], tuple], schema: str) -> DataFrame:
    added = _parse_datatype_string(schema)
    kept = [f for f in df.schema.fields if f.name != dropped]
    arrow = to_arrow_schema(added)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                cols = zip(*[fn(t.as_py()) for t in texts(part)])
                made = [pa.array(c, type=f.type) for c, f in zip(cols, arrow)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(f.name) for f in kept] + made, names=[f.name for f in kept] + arrow.names)

    return shipped(df).mapInArrow(run, StructType(kept + list(added.fields)))


def per_text(df: DataFrame, fn: Callable[[str | None], tuple], schema: str, text: str = "text") -> DataFrame:
    """Replace the column ``text`` by the values that ``fn`` makes of it.

    Arrow batches, one Python worker per task. ``schema`` is the DDL of the
    made columns; the other columns are kept, and none may bear their names.
    """
    return _appended(df, text, lambda batch: batch.column(text), fn, schema)


def per_row(df: DataFrame, fn: Callable[[str | None], tuple], schema: str, text: str = "text") -> DataFrame:
    """As ``per_text``, but every column of ``df`` is kept inside one column
    ``row``, so the made columns meet no clashing name."""
    return _appended(df.select(as_row(df)), None, lambda batch: batch.column("row").field(text), fn, schema)


def as_row(df: DataFrame) -> Column:
    """All columns of ``df`` as one struct ``row``."""
    return F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("row")


def small_enough(ids: DataFrame, most: int = 1_000_000) -> bool:
    """True if ``ids`` has at most ``most`` rows (a bounded probe)."""
    return ids.limit(most + 1).count() <= most


def with_ids(df: DataFrame, ids: DataFrame, key: str, how: str = "left_semi") -> DataFrame:
    """Semi or anti join on ``key``: a broadcast when the ids are counted to be
    few, else a shuffled join (which AQE may split on hot keys)."""
    return df.join(F.broadcast(ids) if small_enough(ids) else ids.hint("merge"), key, how)
