"""Aligning a verse's known words to its noisy lines, and finding missing spaces.

A verse is a bounded group (a few dozen lines), so each runs as one.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linecorpus.functions.text import clean_word, raw_position

_KEEP = re.compile(r"[^\W_]|[Ꭰ-᏿ꭰ-ꮿ]")


def bare(word: str) -> str:
    return "".join(_KEEP.findall(word))


def distance(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        diag, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            diag, row[j] = row[j], min(diag + (x != y), row[j] + 1, row[j - 1] + 1)
    return row[-1]


class HyphenResolver:
    """Splits known words where lines break them, walking the words only forwards."""

    REACH, NEAR = 15, 6

    def __init__(self, words: list[str]):
        self.words, self.at = list(words), 0

    def _nearest(self, target: str, reach: int, enough: int = -1) -> tuple[int, int]:
        """Distance and place of the nearest of the next words; stops at one near ``enough``."""
        best, place = 10**9, -1
        for i in range(self.at, min(len(self.words), self.at + reach)):
            w = bare(self.words[i])
            if not w:
                continue
            d = distance(w, target)
            if d < best:
                best, place = d, i
            if d <= enough:
                break
        return best, place

    def _close(self, best: int, place: int, most: int) -> bool:
        return place >= 0 and best <= most and best < 0.4 * len(bare(self.words[place]))

    def line(self, line: str, following: str) -> None:
        toks = line.split()
        if not toks:
            return
        ends = [toks[-1]] + ([toks[-2]] if len(toks) > 1 and len(toks[-1]) <= 2 else [])
        broken = next((t for t in ends if "-" in t), None)
        after = following.split()
        if broken is not None and after and self._split(broken.split("-")[0], after[0]):
            return
        for t in toks:
            if b := bare(t):
                best, place = self._nearest(b, self.NEAR, enough=1)
                if self._close(best, place, 2):
                    self.at = place + 1

    def _split(self, head: str, tail: str) -> bool:
        h, t = bare(head), bare(tail)
        if not h + t:
            return False
        best, place = self._nearest(h + t, self.REACH)
        if not self._close(best, place, 3):
            return False
        word = self.words[place]
        cuts = range(1, len(word))
        k = min(cuts, key=lambda k: distance(bare(word[:k]), h) + distance(bare(word[k:]), t), default=1)
        self.words[place : place + 1] = [word[:k] + "-", word[k:]]
        self.at = place + 2
        return True


def resolve_hyphens(words: list[str], lines: list[str]) -> list[str]:
    r = HyphenResolver(words)
    for line, following in zip(lines, lines[1:]):
        r.line(line, following)
    return r.words


def grown(words: list[str], line: str, bound: Callable[[int, np.ndarray, np.ndarray], np.ndarray]):
    """Edit distances of all segments to a line: for each end, the starts still open and their distances.

    All open starts see the same next letter, so one row operation extends them
    all; ``bound(end, starts, lengths)`` says which are still worth it.
    """
    n, m = len(words), len(line)
    codes = np.array([ord(x) for x in line], np.int64)
    steps = np.arange(m + 1)
    rows = np.empty((0, m + 1), np.int64)
    starts, lengths = np.empty(0, np.int64), np.empty(0, np.int64)
    for end in range(n + 1):
        # the segment that begins and ends here is empty
        yield end, np.append(starts, end), np.append(rows[:, -1], m)
        if end == n:
            return
        for k, ch in enumerate(" " + words[end]):
            if k == 1:
                rows = np.vstack([rows, steps])
                starts, lengths = np.append(starts, end), np.append(lengths, 0)
            if not len(rows):
                continue
            best = np.empty_like(rows)
            best[:, 0] = rows[:, 0] + 1
            np.minimum(rows[:, :-1] + (codes != ord(ch)), rows[:, 1:] + 1, out=best[:, 1:])
            # runs of insertions: the least of what lies left, one more per step
            rows = np.minimum.accumulate(best - steps, axis=1) + steps
            lengths = lengths + 1
        keep = bound(end + 1, starts, lengths)
        rows, starts, lengths = rows[keep], starts[keep], lengths[keep]


def partition(words: list[str], lines: list[str]) -> list[str]:
    """The cut of ``words`` into one segment per line that makes the summed edit distances least.

    Of equal cuts the one with the shortest first segments wins; the last line
    takes what is left.  A start is given up once its segment is so much longer
    than the line that no further end can beat the best one it has.
    """
    n, k = len(words), len(lines)
    if not k:
        return []
    after = np.array([distance(" ".join(words[w:]), lines[-1]) for w in range(n + 1)], np.int64)
    cuts: list[np.ndarray] = []
    for line in reversed(lines[:-1]):
        best, cut = np.full(n + 1, 1 << 40, np.int64), np.arange(n + 1)
        least_after = np.minimum.accumulate(after[::-1])[::-1]
        m = len(line)

        def bound(end, starts, lengths, best=best, least_after=least_after, m=m):
            return np.maximum(0, lengths - m) + least_after[end] < best[starts]

        for end, starts, d in grown(words, line, bound):
            total = d + after[end]
            better = total < best[starts]
            best[starts[better]], cut[starts[better]] = total[better], end
        cuts.append(cut)
        after = best
    out, w = [], 0
    for cut in reversed(cuts):
        out.append(" ".join(words[w : cut[w]]))
        w = int(cut[w])
    return [*out, " ".join(words[w:])]


def align_words(words: list[str], lines: list[str]) -> list[str]:
    return partition(resolve_hyphens(words, lines), lines) if lines else []


ALIGNED = T.StructType([T.StructField("verse_key", T.StringType()), T.StructField("line_no", T.IntegerType()), T.StructField("line_text", T.StringType()), T.StructField("aligned", T.StringType())])


def align_verses(verses: DataFrame, lines: DataFrame) -> DataFrame:
    """``verses(verse_key, truth)`` and ``lines(verse_key, line_no, line_text)`` to one aligned segment per line."""
    l = lines.groupBy("verse_key").agg(F.array_sort(F.collect_list(F.struct("line_no", F.coalesce("line_text", F.lit("")).alias("line_text")))).alias("lines"))
    j = verses.groupBy("verse_key").agg(F.min("truth").alias("truth")).join(l, "verse_key")
    seg = T.ArrayType(T.StringType())

    @F.pandas_udf(seg)
    def run(truth: pd.Series, texts: pd.Series) -> pd.Series:
        return pd.Series([align_words((t or "").split(), list(x)) for t, x in zip(truth, texts)])

    # the work grows with the square of a verse, so verses are spread over all cores
    j = j.repartition(2 * verses.sparkSession.sparkContext.defaultParallelism, "verse_key")
    j = j.withColumn("aligned", run("truth", F.transform("lines", lambda x: x["line_text"])))
    return j.select("verse_key", F.explode(F.arrays_zip("lines", "aligned")).alias("z")).select("verse_key", F.col("z.lines.line_no").alias("line_no"), F.col("z.lines.line_text").alias("line_text"), F.col("z.aligned").alias("aligned"))


def missing_spaces(tokens_by_model: DataFrame, words: DataFrame) -> DataFrame:
    """Words of the truth that every model reads as two adjacent tokens.

    ``tokens_by_model(verse_key, model, pos, line_no, token, hyphenated)`` and
    ``words(verse_key, word)`` as they stand in the truth; tokens and words are
    compared by their letters and digits, and the split is put into the word as
    it stands.  Per part ``int(0.15 * length)`` edits
    are allowed; across a line end only if it is not hyphenated.  Per word the
    first cut that all models agree on counts; repeated candidates are given once.
    """
    from pyspark.sql.window import Window

    w = Window.partitionBy("verse_key", "model").orderBy("pos")
    pair = tokens_by_model.withColumn("next", F.lead("token").over(w)).withColumn("next_line", F.lead("line_no").over(w))
    pair = pair.where(F.col("next").isNotNull() & ((F.col("line_no") == F.col("next_line")) | ~F.col("hyphenated"))).select("verse_key", "model", "token", "next")
    models = tokens_by_model.select("verse_key", "model").distinct().groupBy("verse_key").agg(F.count(F.lit(1)).alias("models"))
    words = words.select("verse_key", F.col("word").alias("raw"), clean_word(F.col("word")).alias("word"))
    cuts = words.where(F.length("word") >= 5).distinct().select("verse_key", "raw", "word", F.explode(F.sequence(F.lit(2), F.length("word") - 2)).alias("at"))
    cuts = cuts.select("verse_key", "raw", "word", "at", F.substring("word", F.lit(1), F.col("at")).alias("a"), F.substring("word", F.col("at") + 1, F.length("word")).alias("b"))
    room = lambda c: (F.length(c) * 0.15).cast("int")
    near = (F.abs(F.length("token") - F.length("a")) <= room("a")) & (F.abs(F.length("next") - F.length("b")) <= room("b"))
    j = cuts.join(pair, "verse_key").where(near).where((F.levenshtein("token", "a") <= room("a")) & (F.levenshtein("next", "b") <= room("b")))
    agreed = j.groupBy("verse_key", "raw", "at", "a", "b").agg(F.count_distinct("model").alias("seen")).join(models, "verse_key").where(F.col("seen") == F.col("models"))
    best = agreed.groupBy("verse_key", "raw").agg(F.min(F.struct("at", "a", "b")).alias("m"))
    at = raw_position(F.col("raw"), F.col("m.at"))
    split = F.concat(F.substring("raw", F.lit(1), at), F.lit(" "), F.substring("raw", at + 1, F.length("raw")))
    return best.select("verse_key", F.col("raw").alias("original_word"), F.coalesce(split, F.concat_ws(" ", "m.a", "m.b")).alias("suggested_split"))


def apply_splits(lines: DataFrame, candidates: DataFrame, text: str, key: str = "verse_key") -> DataFrame:
    """Every white-space token equal to a candidate word replaced by its split; adds ``changed``."""
    c = candidates.groupBy(key).agg(F.map_from_entries(F.collect_set(F.struct("original_word", "suggested_split"))).alias("__m"))
    j = lines.join(c, key, "left")
    toks = F.split(F.col(text), " ")
    new = F.array_join(F.transform(toks, lambda t: F.coalesce(F.try_element_at("__m", t), t)), " ")
    put = F.when(F.col("__m").isNull(), F.col(text)).otherwise(new)
    return j.withColumn("changed", F.coalesce(put != F.col(text), F.lit(False))).withColumn(text, put).drop("__m")


def without_excluded(candidates: DataFrame, exclusions: DataFrame) -> DataFrame:
    return candidates.join(exclusions.select("verse_key", "original_word").distinct(), ["verse_key", "original_word"], "left_anti")


def flattened(verses: DataFrame) -> DataFrame:
    """One row per line crop with its place from 0; verses without crops give none."""
    return verses.select("book", "verse_key", F.posexplode("line_crops").alias("line_no", "line_crop"))


def rebuilt(lines: DataFrame, keys: list[str], order: str, fields: list[str], name: str = "lines") -> DataFrame:
    """Lines nested again under their keys, in order."""
    a = F.array_sort(F.collect_list(F.struct(order, *fields)))
    return lines.groupBy(*keys).agg(F.transform(a, lambda x: F.struct(*[x[f].alias(f) for f in fields])).alias(name))
