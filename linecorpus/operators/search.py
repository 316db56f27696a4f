"""Candidate search: lattice beams, an inverted index and phrase queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linecorpus.functions.text import WS, strip_signs


def beam(positions: Column, limit: int = 2) -> Column:
    """Best readings of one word's lattice ``array<array<struct<ch,conf>>>``.

    All options extend all kept readings; scores add up; the ``limit`` best stay
    (earlier ones first where equal).  Readings are stripped and given once.
    """
    start = F.array(F.struct(F.lit("").alias("s"), F.lit(0.0).alias("score")))

    def step(kept, options):
        every = F.flatten(F.transform(kept, lambda k: F.transform(options, lambda o: F.struct(F.concat(k["s"], o["ch"]).alias("s"), (k["score"] + o["conf"]).alias("score")))))
        # the place in the list keeps the sort stable
        placed = F.transform(every, lambda x, i: F.struct((-x["score"]).alias("neg"), i.alias("i"), x["s"].alias("s"), x["score"].alias("score")))
        return F.transform(F.slice(F.array_sort(placed), 1, limit), lambda x: F.struct(x["s"].alias("s"), x["score"].alias("score")))

    best = F.aggregate(positions, start, step)
    return F.array_distinct(F.transform(best, lambda x: F.trim(x["s"])))


def by_confidence(alternatives: Column) -> Column:
    """Alternatives ``array<struct<ch,conf>>`` by falling confidence, equal ones as they were."""
    placed = F.transform(alternatives, lambda x, i: F.struct((-x["conf"]).alias("neg"), i.alias("i"), x["ch"].alias("ch"), x["conf"].alias("conf")))
    return F.transform(F.array_sort(placed), lambda x: F.struct(x["ch"].alias("ch"), x["conf"].alias("conf")))


#: what separates tokens of the index: all but letters, digits and marks
_SPLIT = r"[^\p{L}\p{N}\p{M}]+"


def index_tokens(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), _SPLIT), lambda x: x != "")


def token_index(candidates: DataFrame, key: str = "id", text: str = "candidates") -> DataFrame:
    """``(token, id, pos)``; rows that a rebuild repeated are indexed once."""
    return candidates.where(F.col(text).isNotNull()).select(key, text).distinct().select(F.col(key), F.posexplode(index_tokens(F.col(text))).alias("pos", "token")).distinct().select("token", key, "pos")


def phrase_ids(index: DataFrame, term: str, key: str = "id") -> DataFrame:
    """Ids of rows that hold the term's tokens one after another.

    A term is cut like the texts, so quotes in it are harmless; one without
    tokens finds nothing.  Only postings of its tokens are read: one aggregation
    finds starts at which all tokens stand.
    """
    spark = index.sparkSession
    toks = [r["t"] for r in spark.range(1).select(F.explode(index_tokens(F.lit(term))).alias("t")).collect()]
    if not toks:
        return index.where(F.lit(False)).select(key).distinct()
    want = F.array(*[F.struct(F.lit(t).alias("t"), F.lit(i).alias("i")) for i, t in enumerate(toks)])
    hits = index.where(F.col("token").isin(*set(toks))).select(key, "pos", F.explode(F.filter(want, lambda x: x["t"] == F.col("token"))).alias("w"))
    starts = hits.groupBy(key, (F.col("pos") - F.col("w.i")).alias("start")).agg(F.count_distinct("w.i").alias("n")).where(F.col("n") == len(toks))
    return starts.select(key).distinct()


def search(index: DataFrame, lines: DataFrame, term: str, key: str = "id") -> DataFrame:
    return lines.join(phrase_ids(index, term, key), key)


def recall_at(words: DataFrame, ks: tuple[int, ...] = (1, 2, 5)) -> DataFrame:
    """Share of truth words among the first k candidates; ``words(truth, cands)``."""
    t = strip_signs(F.col("truth"))
    c = F.transform("cands", strip_signs)
    hit = lambda k: F.sum(F.array_contains(F.slice(c, 1, k), t).cast("int"))
    n = F.count(F.lit(1))
    return words.agg(n.alias("words"), *[hit(k).alias(f"top{k}") for k in ks], *[F.round(100.0 * hit(k) / n, 2).alias(f"pct{k}") for k in ks])


def paired(truth: Column, cands: Column) -> Column:
    """Truth words zipped with their own candidates where there are as many, else each with all of them."""
    own = F.zip_with(truth, cands, lambda t, c: F.struct(t.alias("truth"), c.alias("cands")))
    pool = F.flatten(cands)
    return F.when(F.size(truth) == F.size(cands), own).otherwise(F.transform(truth, lambda t: F.struct(t.alias("truth"), pool.alias("cands"))))


def matching(df: DataFrame, term: str, category: str | None = None) -> DataFrame:
    """The viewer's filter: a part of truth or reading, in any case, or of the verse key."""
    t = term.lower()
    hit = F.lower(F.coalesce("truth", F.lit(""))).contains(t) | F.lower(F.coalesce("ocr", F.lit(""))).contains(t) | F.coalesce(F.col("verse_key"), F.lit("")).contains(term)
    d = df.where(hit)
    return d if category is None else d.where(F.col("category") == category)


def joined_words(words: Column) -> Column:
    """Recognised words in one string without blank ones."""
    return F.array_join(F.filter(words, lambda w: F.regexp_replace(w, WS + "+", "") != ""), " ")
