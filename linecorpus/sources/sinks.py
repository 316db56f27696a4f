"""Writing manifests, reports and training files.

Spark's commit protocol makes every write all-or-nothing; a backup is the
previous version's folder.
"""

from __future__ import annotations

import math
import os
import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linecorpus.sources import files


def json_records(df: DataFrame, path: str) -> None:
    """Records as JSON lines with nulls kept, NaN as null."""
    fixed = [F.nanvl(F.col(c), F.lit(None)).alias(c) if t in ("double", "float") else F.col(c) for c, t in df.dtypes]
    df.select(*fixed).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def versioned(df: DataFrame, folder: str, keep: int = 2) -> str:
    """A new version beside the old ones; the newest ``keep`` stay.  Returns its path."""
    spark = df.sparkSession
    path = f"{folder}/v{time.time_ns()}"
    df.write.parquet(path)
    for x in _versions(spark, folder)[:-keep]:
        files.remove(spark, f"{folder}/{x}")
    return path


def _versions(spark: SparkSession, folder: str) -> list[str]:
    return [x for x in files.names(spark, folder) if x.startswith("v") and x[1:].isdigit()]


def current(spark: SparkSession, folder: str) -> str | None:
    old = _versions(spark, folder)
    return f"{folder}/{old[-1]}" if old else None


def csv_report(df: DataFrame, path: str) -> None:
    """CSV with arrays joined by commas."""
    cols = [F.concat_ws(",", F.col(c).cast("array<string>")).alias(c) if t.startswith("array") else F.col(c) for c, t in df.dtypes]
    df.select(*cols).write.mode("overwrite").option("header", True).csv(path)


def by_class(df: DataFrame, path: str, column: str) -> None:
    df.write.mode("overwrite").partitionBy(column).parquet(path)


def list_file(paths: DataFrame, column: str, out: str) -> None:
    paths.select(column).write.mode("overwrite").text(out)


def box_text(text: Column, width: Column, height: Column) -> Column:
    """The box file of a one-line image."""
    return F.format_string("WordStr 0 0 %d %d 0 #%s\n\t 0 0 %d %d 0\n", width, height, text, width, height)


def triplets(df: DataFrame) -> DataFrame:
    """``(path, content)`` of the truth and box files of ``df(stem, text, width, height)``."""
    return df.select(F.explode(F.array(F.struct(F.concat("stem", F.lit(".gt.txt")).alias("path"), F.col("text").alias("content")), F.struct(F.concat("stem", F.lit(".box")).alias("path"), box_text(F.col("text"), F.col("width"), F.col("height")).alias("content")))).alias("f")).select("f.*")


def write_files(df: DataFrame, folder: str) -> DataFrame:
    """Writes ``df(path, content)`` below a folder all executors share; gives each path and size.

    Each file is written under a passing name and then renamed, so a task that
    runs twice leaves whole files.
    """

    def run(batches):
        for pdf in batches:
            sizes = []
            for p, c in zip(pdf["path"], pdf["content"]):
                out = os.path.join(folder, p)
                os.makedirs(os.path.dirname(out), exist_ok=True)
                data = (c or "").encode()
                part = f"{out}.{os.getpid()}.part"
                with open(part, "wb") as f:
                    f.write(data)
                os.replace(part, out)
                sizes.append(len(data))
            yield pdf[["path"]].assign(size=sizes)

    return df.select("path", "content").mapInPandas(run, "path string, size long")


def markdown(df: DataFrame, title: str, most: int = 1000) -> str:
    """A ranked table of a small summary as Markdown; more than ``most`` rows are an error, not cut."""
    rows = df.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"a report table has at most {most} rows")

    def cell(v) -> str:
        if v is None or isinstance(v, float) and math.isnan(v):
            return "N/A"
        return f"{v:.3f}" if isinstance(v, float) else str(v).replace("|", "\\|")

    head = f"# {title}\n\n| " + " | ".join(df.columns) + " |\n|" + " --- |" * len(df.columns) + "\n"
    return head + "".join("| " + " | ".join(map(cell, r)) + " |\n" for r in rows)


def with_script(html: Column, script: str) -> Column:
    """A script before the end of the body, once."""
    return F.when(html.contains("hocrjs"), html).otherwise(F.regexp_replace(html, "</body>", script.replace("\\", "\\\\").replace("$", "\\$") + "</body>"))
