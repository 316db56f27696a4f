"""Error rates and the expressions around them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linecorpus.functions.text import normalize_truth, tokens


def capped_rate(distance: Column, length: Column, other: Column) -> Column:
    """Percent of ``length``, at most 100; an empty truth scores 0 against nothing, else 100."""
    return F.when(length == 0, F.when(other == 0, 0.0).otherwise(100.0)).otherwise(F.least(F.lit(100.0), 100.0 * distance / length))


def cer(truth: Column, read: Column, compose: bool = True) -> Column:
    """Character error rate in percent over both texts' normal forms."""
    t, r = normalize_truth(truth, compose), normalize_truth(read, compose)
    return capped_rate(F.levenshtein(t, r), F.length(t), F.length(r))


def once(value: Column, then) -> Column:
    """``then(value)`` with the value computed once, however often it is used."""
    return F.element_at(F.transform(F.array(value), then), 1)


def word_distance(a: Column, b: Column) -> Column:
    """Edit distance of two token arrays: each distinct token becomes one character of a private alphabet."""
    code = lambda w, alphabet: F.decode(F.unhex(F.lpad(F.hex(F.array_position(alphabet, w) + 0x4DFF), 4, "0")), "UTF-16BE")
    line = lambda ws, alphabet: F.array_join(F.transform(ws, lambda w: code(w, alphabet)), "")
    value = F.struct(a.alias("a"), b.alias("b"), F.array_distinct(F.concat(a, b)).alias("all"))
    return once(value, lambda x: F.levenshtein(line(x["a"], x["all"]), line(x["b"], x["all"])))


def wer(truth: Column, read: Column) -> Column:
    """Word error rate in percent of two texts in normal form (a Python function cannot run within its lambdas; see :func:`rated`)."""
    t, r = tokens(F.coalesce(truth, F.lit(""))), tokens(F.coalesce(read, F.lit("")))
    return once(F.struct(t.alias("t"), r.alias("r")), lambda x: capped_rate(word_distance(x["t"], x["r"]), F.size(x["t"]), F.size(x["r"])))


def rated(df: DataFrame, truth: str, read: str) -> DataFrame:
    """``df`` with ``cer`` and ``wer`` over the normal forms of two columns, each made once."""
    d = df.withColumn("__t", normalize_truth(F.col(truth))).withColumn("__r", normalize_truth(F.col(read)))
    c = capped_rate(F.levenshtein("__t", "__r"), F.length("__t"), F.length("__r"))
    return d.withColumn("cer", c).withColumn("wer", wer(F.col("__t"), F.col("__r"))).drop("__t", "__r")


def viewer_cer(truth: Column, read: Column) -> Column:
    """The viewer's rate: texts as they are, not capped, two decimals."""
    t, r = F.coalesce(truth, F.lit("")), F.coalesce(read, F.lit(""))
    return F.round(100.0 * F.levenshtein(t, r) / F.greatest(F.lit(1), F.length(t)), 2)


def invalid_chars(truth: Column, vocabulary: Column) -> Column:
    """Sorted distinct characters of ``truth`` outside the vocabulary (an array)."""
    return F.array_sort(F.array_except(F.filter(F.split(F.coalesce(truth, F.lit("")), ""), lambda x: x != ""), vocabulary))


def line_status(truth: Column, vocabulary: Column) -> Column:
    """``no_gt`` without a truth, ``encoding_error`` with characters the model lacks, else ``ok``."""
    return F.when(F.coalesce(truth, F.lit("")) == "", "no_gt").when(F.size(invalid_chars(truth, vocabulary)) > 0, "encoding_error").otherwise("ok")


def triage(confidence: Column, distance: Column) -> Column:
    """The first that holds: sure but wrong, unsure, right, other."""
    return F.when((confidence >= 80) & (distance > 0), "confidently_disagrees").when(confidence < 70, "low_confidence").when(distance == 0, "high_confidence_correct").otherwise("low_error_other")


def mean_confidence(confidences: Column, digits: int = 2) -> Column:
    """Rounded mean of an array without the sentinel -1, 0 without any."""
    real = F.filter(confidences, lambda x: x != -1)
    total = F.aggregate(real, F.lit(0.0), lambda a, x: a + x)
    return F.when(F.size(real) > 0, F.round(total / F.size(real), digits)).otherwise(0.0)


def presence(initial: Column, ftm: Column) -> Column:
    """Which of two readings a line has: both, initial_only, ftm_only, neither."""
    a, b = (F.coalesce(F.trim(c), F.lit("")) != "" for c in (initial, ftm))
    return F.when(a & b, "both").when(a, "initial_only").when(b, "ftm_only").otherwise("neither")
