"""Incremental runs over arriving day files; the batch operators do the work of each micro-batch.

What has arrived is kept, by day and batch. A batch then reads again all kept rows of every output window that it touches, of
earlier batches too, and replaces these outputs as a whole. So a day that comes in two batches keeps the rows of both, a late
day renews all windows that it is in, and a batch that is repeated after a failure replaces its own rows and the same outputs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tidewright.operators.setops import removed, window_days
from tidewright.sources.writers import write_partitions

#: Rows of the windows and the output days (output_day) to the output rows of these days.
Process = Callable[[DataFrame, DataFrame], DataFrame]
BATCH = "_batch"


def arrivals(spark: SparkSession, path: str, schema: StructType, files_per_batch: int = 1000) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def affected_outputs(days: DataFrame, day: str, before: int, after: int, done: DataFrame | None = None) -> DataFrame:
    """The output days whose window holds an arrived day, less those that are done."""
    out = window_days(days.select(day).distinct(), day, before, after, "output_day").select("output_day").distinct()
    return out if done is None else removed(out, done, ["output_day"])


def window_inputs(kept: DataFrame, outputs: DataFrame, day: str, before: int, after: int) -> DataFrame:
    """The kept rows, each once, of the days in [output_day - before, output_day + after] of some output. The days, few, prune
    the partitions that are read."""
    days = outputs.select(F.explode(F.sequence(F.date_sub("output_day", before), F.date_add("output_day", after))).alias(day)).distinct()
    return kept.join(days, day, "left_semi")


def processed_batch(batch: DataFrame, number: int, process: Process, store: str, output: str, by: list[str], day: str, out_day: str, before: int = 0, after: int = 0) -> None:
    """Keep a batch and renew the outputs that it touches; output days are named out_day in what process returns, where by,
    the output's partitions, has it. Rows without a day are kept and touch nothing."""
    spark = batch.sparkSession
    write_partitions(batch.withColumn(BATCH, F.lit(number).cast("long")), store, [day, BATCH])
    kept = spark.read.schema(batch.schema.add(BATCH, "long")).parquet(store)
    outputs = affected_outputs(kept.where(F.col(BATCH) == number).where(F.col(day).isNotNull()), day, before, after)
    inputs = window_inputs(kept, outputs, day, before, after).select(*batch.columns)
    found = process(inputs, outputs)
    write_partitions(found.join(outputs, found[out_day] == outputs["output_day"], "left_semi"), output, by)


def run_incremental(
    stream: DataFrame, process: Process, store: str, output: str, by: list[str], checkpoint: str, day: str, out_day: str | None = None, before: int = 0, after: int = 0
) -> StreamingQuery:
    """Process what has arrived and replace the output partitions whose windows it touches; runs until all that is there is done.

    An output day d comes from the input days d - before to d + after. store keeps the arrived rows, by day and batch."""

    def each(batch: DataFrame, number: int) -> None:
        processed_batch(batch, number, process, store, output, by, day, out_day or day, before, after)

    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
