"""Parameter grids, schedules and the choice of runs and checkpoints."""

from __future__ import annotations

from itertools import product

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linecorpus.functions.text import checkpoint_iteration, rule_is_cherokee


def grid(spark: SparkSession, **params: list) -> DataFrame:
    """All combinations in nested-loop order, numbered ``ord``.  A grid is written down by hand, so it is small."""
    rows = [(i, *map(float, c)) for i, c in enumerate(product(*params.values()))]
    return spark.createDataFrame(rows, ", ".join(["ord long", *[f"{k} double" for k in params]]))


def schedule(spark: SparkSession, epochs: int, rate: float, decay: float, every: int, kind: str, iterations: int) -> DataFrame:
    """Learning rate and cumulative iterations per epoch: kind is step, exp or const."""
    e = F.col("epoch")
    by = {"step": rate * F.pow(F.lit(decay), F.floor((e - 1) / every)), "exp": rate * F.pow(F.lit(decay), e - 1), "const": F.lit(rate)}
    if kind not in by:
        raise ValueError("kind is step, exp or const")
    return spark.range(1, epochs + 1).select(F.col("id").cast("int").alias("epoch")).select("epoch", by[kind].alias("learning_rate"), (e * iterations).alias("max_iterations"))


def nearest_checkpoint(files: DataFrame, target: int) -> DataFrame:
    """The checkpoint of the target iteration, else the nearest, the first by ``ord`` of equals."""
    f = files.withColumn("iteration", checkpoint_iteration(F.col("path"))).where(F.col("iteration").isNotNull())
    return f.agg(F.min_by(F.struct("path", "iteration"), F.struct(F.abs(F.col("iteration") - target).alias("d"), F.col("ord").alias("o"))).alias("r")).where("r is not null").select("r.*")


def newest(files: DataFrame) -> DataFrame:
    return files.agg(F.max_by("path", F.struct("modificationTime", "path")).alias("path")).where("path is not null")


def latest_iterations(files: DataFrame, top: int = 5) -> DataFrame:
    return files.withColumn("iteration", checkpoint_iteration(F.col("path"))).where(F.col("iteration").isNotNull()).orderBy(F.desc("iteration"), "path").limit(top)


def grid_accuracy(cases: DataFrame, points: DataFrame, predicted: Column, truth: Column, keys: list[str]) -> DataFrame:
    """Accuracy of every grid point over all cases.  The grid is small and goes to the cases; nothing else is multiplied."""
    j = cases.crossJoin(F.broadcast(points))
    return j.groupBy(*keys).agg(F.avg((predicted == truth).cast("double")).alias("accuracy"), F.count(F.lit(1)).alias("n"))


def best_point(accuracies: DataFrame, order: str = "ord") -> DataFrame:
    """The most accurate point, the first in loop order of equals."""
    return accuracies.agg(F.max_by(F.struct(*accuracies.columns), F.struct(F.col("accuracy"), (-F.col(order)).alias("o"))).alias("r")).select("r.*")


def rule_grid(cases: DataFrame, points: DataFrame) -> DataFrame:
    """Accuracies of the language rule at ``points(ord, t, a, b, c)``."""
    cases = cases.select("ftm_conf", "chr_conf", "eng_conf", "pct_cherokee", "true_label")
    p = rule_is_cherokee(F.col("ftm_conf"), F.col("chr_conf"), F.col("eng_conf"), F.col("pct_cherokee"), F.col("t"), F.col("a"), F.col("b"), F.col("c"))
    return grid_accuracy(cases, points, p, F.col("true_label") == "Cherokee", ["ord", "t", "a", "b", "c"])


def binarisations(spark: SparkSession) -> DataFrame:
    """The augmentation grid of thresholding methods: one global, four and twelve local ones."""
    windows = (15, 25, 35, 45)
    rows = [("otsu", None, None), *(("sauvola", w, 0.1) for w in windows), *(("wolf", w, k) for w in windows for k in (0.1, 0.2, 0.3))]
    return spark.createDataFrame(rows, "algo string, window int, k double").withColumn("name", F.when(F.col("window").isNull(), F.col("algo")).otherwise(F.format_string("%s_w%d_k%.1f", "algo", "window", "k")))


def dry_run(spark: SparkSession, experiments: DataFrame) -> DataFrame:
    """Synthetic results of ``experiments(i, id, eval_epochs)`` for testing a sweep end to end."""
    e = experiments.select("i", "id", F.explode("eval_epochs").alias("epoch"))
    return e.select(
        F.concat_ws("_epoch_", "id", "epoch").alias("id"), F.col("id").alias("parent_id"), F.col("epoch").alias("epochs"), (25.0 - 0.5 * F.col("i") - 0.1 * F.col("epoch")).alias("avg_BCER"), (55.0 - 0.8 * F.col("i") - 0.2 * F.col("epoch")).alias("avg_BWER")
    )


def filled(configs: DataFrame, defaults: dict) -> DataFrame:
    """Configurations with defaults for absent fields and without unknown ones."""
    have = set(configs.columns)
    return configs.select(*[(F.coalesce(F.col(k), F.lit(v)) if k in have else F.lit(v)).alias(k) for k, v in defaults.items()])
