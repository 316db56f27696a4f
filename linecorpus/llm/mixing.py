"""Mixing sources to target weights (problem 8).

The mix has as many tokens as all documents of the targeted sources.  It is cut
into :data:`BLOCKS` equal blocks, which Sainte-Laguë's method gives out one by
one to the source with the highest quotient (share over twice the blocks it
has, plus one); a source that its repeats cannot carry further stands back and
the blocks go to the others.  A source's quota is spread over hash shards in
the same way, and within a shard documents are taken in a seeded order: all of
them as often as the quota holds the whole source, and some once more.

Documents of a null or untargeted source, and null texts, take no part.  A
source without documents gets nothing and is reported; targets with a null
share or repeats count as 0.  Only per-source and per-shard sizes reach the
driver.
"""

from __future__ import annotations

import heapq
from fractions import Fraction

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from linecorpus.llm.tokens import size
from linecorpus.plans.lineage import cut

BLOCKS = 10_000
#: documents of one shard, and shards of all sources
SHARD, SHARDS = 20_000, 4096


def apportion(weights: dict, seats: int, caps: dict | None = None) -> dict:
    """Seats by highest quotients ``weight / (2 * has + 1)``; ties go to the lesser name."""
    has = {k: 0 for k in weights}
    heap = [(-w, k) for k, w in weights.items() if w > 0 and (caps is None or caps[k] >= 1)]
    heapq.heapify(heap)
    for _ in range(seats):
        if not heap:
            break
        _, k = heapq.heappop(heap)
        has[k] += 1
        if caps is None or has[k] + 1 <= caps[k]:
            heapq.heappush(heap, (-weights[k] / (2 * has[k] + 1), k))
    return has


def shares(documents: DataFrame, targets: DataFrame, tokenizer: str = "byt5", path: str | None = None) -> DataFrame:
    """``(source, target_pct, max_repeats, size, total)``: sizes in tokens of all documents of the targeted sources."""
    t = targets.where(F.col("source").isNotNull()).groupBy("source").agg(F.coalesce(F.max("target_pct"), F.lit(0)).cast("long").alias("target_pct"), F.coalesce(F.max("max_repeats"), F.lit(0)).cast("long").alias("max_repeats"))
    sizes = documents.where(F.col("source").isNotNull() & F.col("text").isNotNull()).groupBy("source").agg(F.sum(size(F.col("text"), tokenizer, path)).alias("size"))
    s = t.join(sizes, "source", "left").withColumn("size", F.coalesce("size", F.lit(0)).cast("long"))
    # targets are few: their sum is one window over as many rows
    return s.withColumn("total", F.sum("size").over(Window.partitionBy(F.lit(1))))


def seated(facts: dict) -> tuple[Fraction, dict, dict, dict]:
    """The size of a block, the blocks each source could carry, those it would have without that bound, and those it has.

    Sources whose targets leave a part of 100 % free leave their blocks to none.
    """
    total = next(iter(facts.values()))["total"] if facts else 0
    block = Fraction(total, BLOCKS) if total else Fraction(1)
    caps = {k: r["size"] * r["max_repeats"] / block for k, r in facts.items()}
    weights = {k: r["target_pct"] for k, r in facts.items()}
    free = {"": max(0, 100 - sum(weights.values()))} if "" not in weights else {}
    wanted = apportion(weights | free, BLOCKS if total else 0)
    return block, caps, {k: wanted[k] for k in weights}, apportion(weights, BLOCKS if total else 0, caps)


def stopped(documents: DataFrame, targets: DataFrame, tokenizer: str = "byt5", path: str | None = None) -> DataFrame:
    """``(source)``: sources that their repeats stop before they have the seats of their target."""
    facts = {r["source"]: r for r in shares(documents, targets, tokenizer, path).collect()}
    _, caps, wanted, _ = seated(facts)
    return documents.sparkSession.createDataFrame([(k,) for k in sorted(facts) if caps[k] < wanted[k]], "source string")


def mixed(documents: DataFrame, targets: DataFrame, seed: int = 42, tokenizer: str = "byt5", path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """The mix ``(doc_id, source, tokens, repeats)`` and its report per source.

    The report has target and actual share, quota and tokens given;
    ``reachable``: its repeats carry the source to all the seats of its target.
    Sizes are counted by ``tokenizer`` (:mod:`linecorpus.llm.tokens`).
    """
    spark = documents.sparkSession
    facts = {r["source"]: r for r in shares(documents, targets, tokenizer, path).collect()}
    total = next(iter(facts.values()))["total"] if facts else 0
    block, caps, wanted, seats = seated(facts)
    quota = {k: min(int(n * block), facts[k]["size"] * facts[k]["max_repeats"]) for k, n in seats.items()}

    docs = documents.where(F.col("text").isNotNull() & F.col("source").isin(*facts) if facts else F.lit(False)).select("doc_id", "source", size(F.col("text"), tokenizer, path).alias("tokens"))
    n = docs.count()
    per = max(1, min(SHARDS // max(1, len(facts)), -(-n // SHARD)))
    docs = cut(docs.withColumn("shard", F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(per)).cast("int")))
    by_shard: dict[str, dict[int, int]] = {}
    for r in docs.groupBy("source", "shard").agg(F.sum("tokens").alias("size")).collect():
        by_shard.setdefault(r["source"], {})[r["shard"]] = r["size"]
    rows = []
    for k, sizes in sorted(by_shard.items()):
        full, rest = divmod(quota[k], facts[k]["size"]) if facts[k]["size"] else (0, 0)
        got = apportion(sizes, min(BLOCKS, max(1, rest // block)) if rest else 0)
        each = rest / max(1, sum(got.values()))
        rows += [(k, s, int(full), float(got[s] * each)) for s in sorted(sizes)]
    plan = spark.createDataFrame(rows, T.StructType([T.StructField("source", T.StringType()), T.StructField("shard", T.IntegerType()), T.StructField("full", T.IntegerType()), T.StructField("more", T.DoubleType())]))
    w = Window.partitionBy("source", "shard").orderBy(F.xxhash64(F.lit(seed + 1), "doc_id"), "doc_id")
    run = F.sum("tokens").over(w.rowsBetween(Window.unboundedPreceding, 0))
    j = docs.join(F.broadcast(plan), ["source", "shard"]).withColumn("run", run)
    # a document that the quota's end falls in is taken if more than half of it lies within
    repeats = F.col("full") + (F.col("run") - F.col("tokens") / 2 < F.col("more")).cast("int")
    chosen = j.select("doc_id", "source", "tokens", repeats.cast("int").alias("repeats")).where("repeats > 0")
    report_rows = [(k, int(r["target_pct"]), int(r["max_repeats"]), int(r["size"]), int(quota[k]), bool(caps[k] >= wanted[k])) for k, r in sorted(facts.items())]
    base = spark.createDataFrame(report_rows, "source string, target_pct long, max_repeats long, size long, quota long, reachable boolean")
    given = chosen.groupBy("source").agg(F.sum(F.col("tokens") * F.col("repeats")).alias("given"), F.max("repeats").alias("most_repeats"))
    rep = base.join(given, "source", "left").withColumn("given", F.coalesce("given", F.lit(0)).cast("long")).withColumn("most_repeats", F.coalesce("most_repeats", F.lit(0)))
    rep = rep.withColumn("actual_pct", F.round(100 * F.col("given") / F.sum("given").over(Window.partitionBy(F.lit(1))), 3))
    return chosen, rep
