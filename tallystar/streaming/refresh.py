"""K3 as an incremental job: yearly files land in a folder; each run picks up
the files not seen before and rewrites only the years they belong to.

``readStream`` over the landing folder tracks which files were processed in
its checkpoint (on the shared file system), so a restart after a failure
neither skips nor repeats a file. Each micro-batch:

1. takes the new files' paths (a file listing, bounded by
   ``maxFilesPerTrigger``),
2. re-reads *all* landed files of the years those files belong to, so a year
   whose files arrive in several batches is still written whole,
3. builds the dimension's rows (renames, one row per country and year) and
   writes with dynamic partition overwrite, replacing exactly those years.

Re-running a batch writes the same years with the same rows, so the sink is
idempotent. There is no state beyond the file log.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallystar.plans.model import reference_layout
from tallystar.plans.star_build import _path_year, dimension_of, list_inputs_deep
from tallystar.sources.sinks import write_by_year

# The columns of Spark's binary file source.
FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"


def refresh_years(spark: SparkSession, landing_dir: str, out_path: str, new_files: list[str],
                  layout_for_year: Callable[[int], str] = reference_layout,
                  renames: Mapping[str, str] | None = None, on_duplicate: str = "fail") -> None:
    """Rewrite the years of ``new_files`` from every landed file of those years,
    by the rules of ``build_dimension``."""
    years = {_path_year(f) for f in new_files}
    files = [f for f in list_inputs_deep(spark, landing_dir) if _path_year(f) in years]
    if not files:
        return
    write_by_year(dimension_of(spark, files, layout_for_year, renames, on_duplicate), out_path, refresh=True)


def start_refresh(spark: SparkSession, landing_dir: str, out_path: str, checkpoint: str,
                  layout_for_year: Callable[[int], str] = reference_layout,
                  max_files_per_trigger: int = 100, once: bool = True,
                  renames: Mapping[str, str] | None = None, on_duplicate: str = "fail") -> StreamingQuery:
    """Start the refresh stream. ``once=True`` processes what has landed and
    stops (``availableNow``), the mode for a yearly schedule."""
    # only the listing is read: the content column is pruned
    stream = (spark.readStream.format("binaryFile").schema(FILE_SCHEMA)
              .option("maxFilesPerTrigger", max_files_per_trigger)
              .load(landing_dir)
              .select(F.col("path").alias("file_path")))

    def batch(df: DataFrame, epoch_id: int) -> None:
        new_files = sorted(r["file_path"] for r in df.select("file_path").distinct().collect())
        if new_files:
            refresh_years(df.sparkSession, landing_dir, out_path, new_files, layout_for_year, renames, on_duplicate)

    writer = stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime="1 hour")
    return writer.start()
