"""Aggregations and ranked reports over evaluated lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from linecorpus.operators.splits import placed


def error_summary(df: DataFrame, by: list[str], rate: str = "cer") -> DataFrame:
    """Mean, exact median and count of a rate per group."""
    return df.groupBy(*by).agg(F.avg(rate).alias("mean"), F.median(rate).alias("median"), F.count(rate).alias("n"))


def split_means(df: DataFrame, by: str) -> DataFrame:
    """Macro means of both rates per split, 0 for a split without lines, and the weighted mean over all."""
    return df.groupBy(by).agg(F.coalesce(F.avg("cer"), F.lit(0.0)).alias("mean_cer"), F.coalesce(F.avg("wer"), F.lit(0.0)).alias("mean_wer"), F.count(F.lit(1)).alias("n"))


def weighted_mean(df: DataFrame, mean: str, n: str) -> DataFrame:
    return df.agg((F.sum(F.col(mean) * F.col(n)) / F.sum(n)).alias(mean), F.sum(n).alias(n))


def algorithm_summary(df: DataFrame, by: str = "algo") -> DataFrame:
    """Mean and median over the lines that are ok, with counts of ok, failed and all."""
    ok = F.col("status") == "ok"
    return df.groupBy(by).agg(
        F.avg(F.when(ok, F.col("cer"))).alias("mean"), F.median(F.when(ok, F.col("cer"))).alias("median"), F.count_if(ok).alias("ok"), F.count_if(F.col("status") == "encoding_error").alias("err"), F.count(F.lit(1)).alias("total")
    )


def macro_of(df: DataFrame, inner: str, value: str) -> DataFrame:
    """Mean of the groups' means."""
    return df.groupBy(inner).agg(F.avg(value).alias("m")).agg(F.avg("m").alias(value), F.count(F.lit(1)).alias("groups"))


def events_counted(df: DataFrame, events: str = "events") -> DataFrame:
    """``(t, p, op, n)`` over arrays of alignment events."""
    return df.select(F.explode(events).alias("e")).groupBy("e.t", "e.p", "e.op").agg(F.count(F.lit(1)).alias("n"))


def confusion_rates(counts: DataFrame) -> DataFrame:
    """Match, substitution, deletion and insertion shares of the truth's length."""
    part = lambda op: F.sum(F.when(F.col("op") == op, F.col("n")).otherwise(0))
    truth = F.sum(F.when(F.col("op") != "insertion", F.col("n")).otherwise(0))
    ops = ("match", "substitution", "deletion", "insertion")
    return counts.agg(truth.alias("truth"), *[part(op).alias(op) for op in ops], *[F.round(100.0 * part(op) / truth, 2).alias(f"{op}_pct") for op in ops])


def deletion_rates(counts: DataFrame, top: int = 15) -> DataFrame:
    """Characters most often lost: deletions over occurrences in the truth."""
    d = F.sum(F.when(F.col("op") == "deletion", F.col("n")).otherwise(0))
    c = counts.where("op <> 'insertion'").groupBy(F.col("t").alias("ch")).agg(d.alias("deleted"), F.sum("n").alias("total"))
    return c.where("deleted > 0").withColumn("rate", F.round(100.0 * F.col("deleted") / F.col("total"), 2)).orderBy(F.desc("rate"), "ch").limit(top)


def top_confusions(counts: DataFrame, op: str = "substitution", top: int = 30) -> DataFrame:
    """Most frequent events of a kind; ties in the order of the characters."""
    return counts.where(F.col("op") == op).orderBy(F.desc("n"), "t", "p").limit(top)


def confusion_cells(counts: DataFrame, alphabet: list[str]) -> DataFrame:
    """Every cell ``(truth, pred, n)`` of the matrix over ``alphabet``, 0 where nothing was counted; ``<del>`` is a prediction, ``<ins>`` a truth.

    Long, since signs that differ in case only cannot all name columns.
    """
    named = counts.select(F.when(F.col("op") == "insertion", "<ins>").otherwise(F.col("t")).alias("truth"), F.when(F.col("op") == "deletion", "<del>").otherwise(F.col("p")).alias("pred"), "n")
    # as large as the alphabet squared, whatever the data
    truths = counts.sparkSession.createDataFrame([(c,) for c in [*alphabet, "<ins>"]], "truth string")
    cells = truths.select("truth", F.explode(F.array(*map(F.lit, [*alphabet, "<del>"]))).alias("pred")).where("truth <> '<ins>' or pred <> '<del>'")
    return cells.join(named.groupBy("truth", "pred").agg(F.sum("n").alias("n")), ["truth", "pred"], "left").select("truth", "pred", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def confusion_matrix(cells: DataFrame, alphabet: list[str]) -> DataFrame:
    """Dense matrix from :func:`confusion_cells`, one row per truth; columns are named by code point (``u13a0``), ``del`` last."""
    name = {c: f"u{ord(c):04x}" for c in alphabet} | {"<del>": "del"}
    mapped = F.create_map(*[F.lit(x) for kv in name.items() for x in kv])
    return cells.withColumn("__c", F.try_element_at(mapped, F.col("pred"))).groupBy("truth").pivot("__c", [*name.values()]).agg(F.sum("n")).na.fill(0)


def character_counts(df: DataFrame, text: Column, chars: str) -> DataFrame:
    """Occurrences of the class's characters, and the first place they were seen at (by ``ord``)."""
    each = F.explode(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(f"([{chars}])")))
    return df.select("ord", each.alias("ch")).groupBy("ch").agg(F.count(F.lit(1)).alias("n"), F.min("ord").alias("first_ord"))


def rarest_fifth(counts: DataFrame) -> DataFrame:
    """The rarest fifth of the characters (at least one); of equals the one seen first. An alphabet is small, so one window ranks it."""
    w = Window.orderBy("n", "first_ord", "ch")
    total = F.count(F.lit(1)).over(Window.partitionBy(F.lit(1)))
    return counts.withColumn("rank", F.row_number().over(w)).withColumn("of", total).where(F.col("rank") <= F.greatest(F.lit(1), F.floor(F.col("of") / 5))).drop("of")


def histogram(df: DataFrame, value: str, bins: int = 25, low: float = 0.0, high: float = 100.0) -> DataFrame:
    """Rows per equal bin; the top edge belongs to the last bin."""
    b = F.least(F.lit(bins), F.greatest(F.lit(1), F.width_bucket(F.col(value), F.lit(low), F.lit(high), F.lit(bins)))).cast("int")
    return df.where(F.col(value).isNotNull()).groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def status_counts(df: DataFrame) -> DataFrame:
    known = ("unlabeled", "labeled", "not_cherokee", "nasty_crop")
    return df.agg(*[F.count_if(F.col("status") == s).alias(s) for s in known], F.count(F.lit(1)).alias("total"))


def algorithm_matrix(df: DataFrame, algos: list[str], name: str = "base_name") -> DataFrame:
    """One row per file with each algorithm's rate, null where it was not run, and the mean of those that were."""
    p = df.groupBy(name).pivot("algo", algos).agg(F.avg("cer"))
    have = F.filter(F.array(*[F.col(f"`{a}`") for a in algos]), lambda x: x.isNotNull())
    mean = F.aggregate(have, F.lit(0.0), lambda a, x: a + x) / F.size(have)
    return p.withColumn("mean", F.when(F.size(have) > 0, mean))


def filled_with(df: DataFrame, columns: list[str], value: float = 100.0) -> DataFrame:
    """For compound plots a missing run counts as the worst rate."""
    return df.na.fill(value, columns)


def ranked(df: DataFrame, metric: str, tie: str) -> DataFrame:
    """Listing from 1 by a metric, of any number of rows."""
    return placed(df.orderBy(metric, tie))


def worst(df: DataFrame, metric: str, ties: list[str], top: int) -> DataFrame:
    return df.orderBy(F.desc(metric), *ties).limit(top)


ORDERS = {
    "cer_desc": lambda: [F.desc_nulls_last("cer"), F.asc("id")],
    "cer_asc": lambda: [F.asc_nulls_last("cer"), F.asc("id")],
    "conf_asc": lambda: [F.asc_nulls_last("ftm_confidence"), F.asc("id")],
    "conf_desc": lambda: [F.desc_nulls_last("ftm_confidence"), F.asc("id")],
    "verse": lambda: [F.regexp_extract("id", r"^cnt_\d+_(\d+)_", 1), F.regexp_extract("id", r"_line_(\d+)$", 1).try_cast("int"), F.asc("id")],
}


def ordered(df: DataFrame, by: str, *ties: str) -> DataFrame:
    """One of the five orders of the line viewer; rows of one id by ``ties``."""
    return df.orderBy(*ORDERS[by](), *ties)


def best_run(df: DataFrame, metric: str, order: str, lowest: bool = True) -> DataFrame:
    """The run with the best metric, the first of equals."""
    m = F.col(metric) if lowest else -F.col(metric)
    return df.where(F.col(metric).isNotNull()).agg(F.min_by(F.struct(*df.columns), F.struct(m.alias("m"), F.col(order).alias("o"))).alias("r")).select("r.*")


def class_confusion(df: DataFrame, truth: str, predicted: str, classes: list[str]) -> DataFrame:
    return df.groupBy(truth).pivot(predicted, classes).agg(F.count(F.lit(1))).na.fill(0)


def mixture(df: DataFrame, dataset: str = "cnt") -> DataFrame:
    """Share of the main corpus in the train rows."""
    t = df.where("split = 'train'")
    other = F.count_if(F.col("dataset").eqNullSafe(dataset))
    return t.agg((F.count(F.lit(1)) - other).alias("main"), other.alias("other"), ((F.count(F.lit(1)) - other) / F.count(F.lit(1))).alias("ratio"))
