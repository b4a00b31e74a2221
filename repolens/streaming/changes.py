"""Structured Streaming drivers for diff hunks and change impact."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from repolens.operators import changes as C
from repolens.session import checkpoint_dir

DIFF_SCHEMA = "repo string, change_id bigint, diff string"


def read_diff_stream(spark: SparkSession, source_dir: str, fmt: str = "parquet",
                     max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(DIFF_SCHEMA).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(source_dir)


def stream_hunks(diffs: DataFrame) -> DataFrame:
    """Stateless: parsing is row-local, so it runs unchanged on a stream."""
    return C.diff_hunks(diffs)


def start_change_impact(spark: SparkSession, source_dir: str, symbols_path: str, files_path: str,
                        out_path: str, name: str = "change_impact", available_now: bool = True,
                        fmt: str = "parquet", checkpoint_location: str | None = None) -> StreamingQuery:
    """Run ``change_impact`` on every micro-batch of landed diffs.

    ``symbols_path`` / ``files_path`` are the persisted tables (the symbol
    table is written once by ``extract_symbols``; it is not recomputed per
    batch).  Output goes to ``out_path/batch_id=N``, overwritten on replay,
    so a batch re-run after an executor or driver loss is idempotent.  The
    stream's checkpoint lives below the shared ``spark.checkpoint.dir``
    (``streams/<name>``) unless ``checkpoint_location`` names one; one
    checkpoint belongs to one source and sink.
    """
    keys = ["repo", "change_id"]

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        symbols = spark.read.parquet(symbols_path)
        files = spark.read.parquet(files_path).select("repo", "path")
        impact = C.change_impact(C.diff_hunks(batch), symbols, files, keys)
        (impact.withColumn("batch_id", F.lit(batch_id))
         .write.mode("overwrite").parquet(f"{out_path}/batch_id={batch_id}"))

    writer = (read_diff_stream(spark, source_dir, fmt).writeStream
              .queryName(name)
              .option("checkpointLocation", checkpoint_location or f"{checkpoint_dir(spark)}/streams/{name}")
              .foreachBatch(per_batch))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
