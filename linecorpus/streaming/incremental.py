"""Incremental enrichment: a stream of new lines, each enriched once.

The reference resumes by skipping what is done and saving every few rows; here
the stream's checkpoint holds what was read, and the sink is keyed by batch, so
a batch that runs again replaces its own output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from linecorpus.operators.manifest import pending


def lines_stream(spark: SparkSession, folder: str, schema: StructType, files_per_batch: int = 16) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def enrich(stream: DataFrame, how: Callable[[DataFrame], DataFrame], out: str, checkpoint: str, key: str = "id") -> StreamingQuery:
    """Enriches rows not yet in ``out`` and appends them under ``batch=<n>``; stops when all input is read."""

    def one(batch: DataFrame, n: int) -> None:
        spark = batch.sparkSession
        todo = batch.dropDuplicates([key])
        try:
            done = spark.read.parquet(out).where(F.col("batch") != n).select(key)
            todo = pending(todo, done, key)
        except Exception as e:  # nothing written yet
            if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
                raise
        how(todo).write.mode("overwrite").parquet(f"{out}/batch={n}")

    return stream.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def late_deduplicated(stream: DataFrame, key: str, time: str, delay: str = "1 hour") -> DataFrame:
    """First row of each key among rows at most ``delay`` late."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark([key])


def windowed_counts(stream: DataFrame, time: str, by: str, width: str = "1 day", delay: str = "1 hour", slide: str | None = None) -> DataFrame:
    """Rows per time window and class, windows closed by the watermark."""
    w = F.window(time, width, slide or width)
    return stream.withWatermark(time, delay).groupBy(w, by).agg(F.count(F.lit(1)).alias("n"))


def recognised(df: DataFrame, backend, content: str = "content", batch: int = 16) -> DataFrame:
    """``df`` with ``text`` and ``confidence`` from a recognition backend loaded once per Python worker.

    ``backend()`` returns a callable from a list of bytes to ``(text, confidence)``
    pairs; a failed item comes as ``None`` and reads ``Error``, 0.0.
    """
    import pandas as pd

    schema = StructType([*df.schema.fields]).add("text", "string").add("confidence", "double")

    def run(batches):
        model = backend()
        for pdf in batches:
            got: list = []
            for i in range(0, len(pdf), batch):
                got += model(list(pdf[content].iloc[i : i + batch]))
            yield pdf.assign(text=[g[0] if g else "Error" for g in got], confidence=pd.Series([float(g[1]) if g else 0.0 for g in got], index=pdf.index, dtype="float64"))

    return df.mapInPandas(run, schema)


def failed() -> Column:
    return F.col("text").eqNullSafe("Error")
