"""Splits that keep related records together (problem 1).

Records of one page, under whatever spelling or rescan, or of one verse are one
group.  Pages are linked by a Borůvka-style contraction: in each round every
component takes its least edge to another one, the edges taken join a forest,
and components joined by them contract.  A round at least halves the components
that have edges.  The forest can be kept as a named table
(:func:`keep_forest`); with new links it gives the same components as all the
links it stands for.

Groups are then dealt to splits by strata: bands of groups whose sizes differ
by less than a factor of two, the largest first.  A band's rows go to the splits
in proportion to what each then lacks, so what one band leaves over is carried
to the next; within a band groups stand in a seeded order and each goes to the
split that holds the middle of its place in it.

A record with neither a readable scan nor a readable id gets no group (null)
and no split; repeated rows go with their group; null link ends are ignored;
an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from linecorpus.plans.lineage import cut, ensure_checkpoint_dir

#: pages above one in so many rows, at most that many, are joined to their rows by broadcast; the other pages are small
HOT = 1000


def page_name(scan, ident):
    """Clean ``YYYY-MM-DD/seq-N.jp2`` of a scan in any spelling, else of the page in an id, else null."""

    def clean(c):
        low = F.lower(c)
        at = r"(\d{4})-?(\d{2})-?(\d{2})[/\\_]seq[-_ ]?(\d+)"
        n = F.regexp_extract(low, at, 4).try_cast("bigint").cast("string")
        return F.when(low.rlike(at), F.concat(F.regexp_extract(low, at, 1), F.lit("-"), F.regexp_extract(low, at, 2), F.lit("-"), F.regexp_extract(low, at, 3), F.lit("/seq-"), n, F.lit(".jp2")))

    return F.coalesce(clean(scan), clean(ident))


def forest_path(spark: SparkSession, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark)}/../forests/{name}"


def keep_forest(forest: DataFrame, name: str) -> None:
    """Write the spanning forest as a named table beside the checkpoints."""
    cut(forest).write.mode("overwrite").parquet(forest_path(forest.sparkSession, name))


def kept_forest(spark: SparkSession, name: str) -> DataFrame:
    """The forest kept under ``name``: ``(a, b)``."""
    return spark.read.schema("a string, b string").parquet(forest_path(spark, name))


def components(links: DataFrame, a: str, b: str, forest: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """``(vertex, root)`` of all linked vertices, root the least name of each component, and the spanning forest ``(a, b)``.

    ``forest`` stands for links of earlier runs.  Self-links, null ends and
    repeated links are ignored.
    """
    spark = links.sparkSession
    links = links.select(F.col(a).alias("a"), F.col(b).alias("b"))
    a, b = "a", "b"
    if forest is not None:
        links = links.unionByName(forest.select("a", "b"))
    e = links.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    e = e.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct()
    # every edge has its own weight, so the forest is one and least edges make no longer cycles than two
    edges = cut(e.select("a", "b", F.col("a").alias("ca"), F.col("b").alias("cb"), F.struct(F.xxhash64("a", "b").alias("h"), "a", "b").alias("w")))
    comp = cut(edges.select(F.col("a").alias("vertex")).union(edges.select(F.col("b").alias("vertex"))).distinct().withColumn("root", F.col("vertex")))
    forest = spark.createDataFrame([], T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.StringType())]))
    while not edges.isEmpty():
        both = edges.select("ca", "cb", "w").union(edges.select(F.col("cb").alias("ca"), F.col("ca").alias("cb"), "w"))
        least = both.groupBy("ca").agg(F.min(F.struct("w", "cb")).alias("m")).select(F.col("ca").alias("c"), F.col("m.cb").alias("up"), F.col("m.w").alias("w"))
        least = cut(least)
        forest = cut(forest.union(least.select("w.a", "w.b").distinct()))
        # of the two that chose each other the lesser stays a root
        back = least.select(F.col("c").alias("up"), F.col("up").alias("upup"))
        tree = cut(least.join(back, "up", "left").select("c", F.when((F.col("upup") == F.col("c")) & (F.col("c") < F.col("up")), F.col("c")).otherwise(F.col("up")).alias("up")))
        while True:  # pointer jumping: paths halve
            hop = tree.select(F.col("c").alias("up"), F.col("up").alias("top"))
            jumped = cut(tree.join(hop, "up", "left").select("c", F.coalesce("top", "up").alias("new"), "up"))
            moved = not jumped.where(F.col("new") != F.col("up")).isEmpty()
            tree = jumped.select("c", F.col("new").alias("up"))
            if not moved:
                break
        comp = cut(comp.join(tree, comp["root"] == tree["c"], "left").select("vertex", F.coalesce("up", "root").alias("root")))
        ta, tb = tree.select(F.col("c").alias("ca"), F.col("up").alias("na")), tree.select(F.col("c").alias("cb"), F.col("up").alias("nb"))
        moved_edges = edges.join(ta, "ca", "left").join(tb, "cb", "left").select("a", "b", F.coalesce("na", "ca").alias("ca"), F.coalesce("nb", "cb").alias("cb"), "w").where(F.col("ca") != F.col("cb"))
        # of parallel edges only the least can ever be taken
        m = moved_edges.groupBy(F.least("ca", "cb").alias("ca"), F.greatest("ca", "cb").alias("cb")).agg(F.min("w").alias("w"))
        edges = cut(m.select("w.a", "w.b", "ca", "cb", "w"))
    named = comp.groupBy("root").agg(F.min("vertex").alias("name"))
    return comp.join(named, "root").select("vertex", F.col("name").alias("root")), forest


def own_group(scan: str, ident: str):
    """The page or verse a record belongs to before rescans are linked."""
    verse = F.col(ident).startswith("cnt_") & F.col(ident).contains("_line_") & F.col(scan).isNull()
    return F.when(verse, F.regexp_replace(ident, r"_line_.*$", "")).otherwise(page_name(F.col(scan), F.col(ident)))


def pages(records: DataFrame, rescans: DataFrame, scan: str = "source_scan", ident: str = "id", split: str | None = "split", keep: str | None = None) -> DataFrame:
    """``(own, grp, n, train, test)`` of each page or verse: its group and its rows, in all and by recorded split.

    Rows are counted per page before the links are joined, so a page that holds
    much of the table crosses the network as one row.  With ``keep`` the forest
    is kept under that name.
    """
    s = F.col(split) if split else F.lit(None).cast("string")
    per = records.select(own_group(scan, ident).alias("own"), s.alias("s")).where(F.col("own").isNotNull())
    count = lambda x: F.coalesce(F.sum((F.col("s") == x).cast("long")), F.lit(0))
    per = per.groupBy("own").agg(F.count(F.lit(1)).alias("n"), count("train").alias("train"), count("test").alias("test"))
    comp, forest = components(rescans, "scan", "same_as")
    if keep:
        keep_forest(forest, keep)
    j = per.join(comp, per["own"] == comp["vertex"], "left")
    return j.select("own", F.coalesce("root", "own").alias("grp"), "n", "train", "test")


def group_facts(records: DataFrame, rescans: DataFrame, scan: str = "source_scan", ident: str = "id", split: str = "split") -> DataFrame:
    """``(grp, n, train, test)``: rows of each group, in all and by recorded split."""
    return pages(records, rescans, scan, ident, split).groupBy("grp").agg(*[F.sum(c).alias(c) for c in ("n", "train", "test")])


def with_pages(records: DataFrame, facts: DataFrame, scan: str = "source_scan", ident: str = "id") -> DataFrame:
    """``records`` with the columns of ``facts(own, n, ...)`` of their page, null where they have none; columns of these names give way.

    A page above one in :data:`HOT` rows is joined by broadcast (there can be no
    more than :data:`HOT`), so no hot key is shuffled.
    """
    names = [c for c in facts.columns if c not in ("own", "n")]
    f = cut(facts.select(F.col("own").alias("__own"), F.col("n").alias("__n"), *names))
    total = f.agg(F.coalesce(F.sum("__n"), F.lit(0))).first()[0]
    r = records.drop(*names).withColumn("__own", own_group(scan, ident))
    hot, rest = (f.where(c).drop("__n") for c in (F.col("__n") * HOT > total, F.col("__n") * HOT <= total))
    cold = r.join(F.broadcast(hot.select("__own")), "__own", "left_anti").join(rest, "__own", "left")
    return r.join(F.broadcast(hot), "__own").unionByName(cold).drop("__own")


def grouped(records: DataFrame, rescans: DataFrame, scan: str = "source_scan", ident: str = "id") -> DataFrame:
    """``records`` with ``grp``; a column of that name gives way to it."""
    return with_pages(records, pages(records, rescans, scan, ident, None).select("own", "n", "grp"), scan, ident)


def dealt(groups: DataFrame, shares: list[tuple[str, float]], seed: int = 42) -> DataFrame:
    """``(grp, n, split)`` for ``groups(grp, n)``.  Shares need not add up to one; groups without rows count as the smallest.

    Only sums per band and partition reach the driver.
    """
    spark = groups.sparkSession
    whole = sum(x for _, x in shares)
    shares = [(s, x / whole) for s, x in shares]
    n = F.greatest(F.col("n").cast("long"), F.lit(1))
    g = groups.select("grp", F.col("n").cast("long").alias("n"), F.floor(F.log2(n)).cast("int").alias("band"), F.xxhash64(F.lit(seed), "grp").alias("h"))
    g = g.repartitionByRange(spark.sparkContext.defaultParallelism * 2, F.desc("band"), "h", "grp")
    g = cut(g.withColumn("part", F.spark_partition_id()))
    sums = g.groupBy("band", "part").agg(F.sum("n").alias("n")).orderBy(F.desc("band"), "part").collect()
    # rows of the same band in the partitions before
    before, rows, at = [], {}, 0
    for r in sums:
        at = rows.get(r["band"], 0)
        before.append((r["band"], r["part"], at))
        rows[r["band"]] = at + r["n"]
    w = Window.partitionBy("part", "band").orderBy("h", "grp").rowsBetween(Window.unboundedPreceding, 0)
    offsets = F.broadcast(spark.createDataFrame(before, "band int, part int, before long"))
    g = cut(g.withColumn("run", F.sum("n").over(w)).join(offsets, ["band", "part"]).select("grp", "n", "band", (F.col("before") + F.col("run") - F.col("n") / 2).alias("mid")))
    given, seen, split = dict.fromkeys((s for s, _ in shares), 0), 0, F.lit(shares[0][0])
    for band in sorted(rows, reverse=True):
        seen += rows[band]
        lack = {s: max(0.0, x * seen - given[s]) for s, x in shares}
        scale, ends, upto = rows[band] / (sum(lack.values()) or 1.0), [], 0.0
        for s, _ in shares:
            if lack[s] > 0:
                upto += lack[s] * scale
                ends.append((upto, s))
        pick = F.lit(ends[-1][1] if ends else shares[0][0])
        for end, s in reversed(ends[:-1]):
            pick = F.when(F.col("mid") < end, s).otherwise(pick)
        split = F.when(F.col("band") == band, pick).otherwise(split)
        if band != min(rows):
            for r in g.where(F.col("band") == band).groupBy(pick.alias("s")).agg(F.sum("n").alias("n")).collect():
                given[r["s"]] += r["n"]
    return g.select("grp", "n", split.alias("split"))
