"""Splitting, sampling and mixing that give the same result on every run.

Random orders are ``md5(id:seed)``, the same in Spark and other engines.  Ranks
are taken within hash-bounded strata or by aggregation; see each function.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from linecorpus.functions.text import has_any, lower_script


def hash_order(key: Column, seed) -> Column:
    return F.md5(F.concat_ws(":", key.cast("string"), F.lit(str(seed))))


def numbered(df: DataFrame, order: str, name: str = "rn0", start: int = 0) -> DataFrame:
    """Rows numbered from ``start`` by ``order``, without gathering them in one task.

    Rows are range-partitioned and sorted; only each partition's count goes to
    the driver, as offsets.  Ties are numbered in the order of the whole row.
    """
    rest = [c for c in df.columns if c != order and not isinstance(df.schema[c].dataType, (type(None),))]
    ordered = df.repartitionByRange(F.col(order), *[F.col(c) for c in rest[:1]]).sortWithinPartitions(order, *rest[:1])
    return placed(ordered, name, start)


def placed(ordered: DataFrame, name: str = "rank", start: int = 1) -> DataFrame:
    """Rows that are in order over their partitions, numbered from ``start``."""
    columns = ordered.columns
    ordered = ordered.withColumn("__p", F.spark_partition_id()).withColumn("__m", F.monotonically_increasing_id())
    # the identifier's lower 33 bits count rows within a partition
    ordered = ordered.withColumn("__i", F.col("__m").bitwiseAND((1 << 33) - 1))
    from linecorpus.plans.lineage import cut

    ordered = cut(ordered)
    counts = {r["__p"]: r["n"] for r in ordered.groupBy("__p").agg(F.count(F.lit(1)).alias("n")).collect()}
    offsets, at = [], start
    for p in sorted(counts):
        offsets.append((p, at))
        at += counts[p]
    spark = ordered.sparkSession
    offs = spark.createDataFrame(offsets, "__p int, __off long")
    return ordered.join(F.broadcast(offs), "__p").select(*columns, (F.col("__off") + F.col("__i")).alias(name))


def accumulator_tests(n: int, ratio: float) -> list[int]:
    """Positions (from 0) that the running accumulator sends to test: binary floating point decides, so it is run as such."""
    out, acc = [], 0.0
    for i in range(n):
        acc += 1.0 - ratio
        if acc >= 1.0:
            out.append(i)
            acc -= 1.0
    return out


def every_nth_split(df: DataFrame, order: str, ratio: float = 0.8) -> DataFrame:
    """Accumulator split in ``order``: adds ``rn0`` and ``split``.

    At 0.8 the test rows are the sixth and every fifth after it, which holds for
    any length; another ratio's positions are folded on the driver, one number
    per test row, and joined.
    """
    r = numbered(df, order)
    if ratio == 0.8:
        return r.withColumn("split", F.when((F.col("rn0") > 0) & (F.col("rn0") % 5 == 0), "test").otherwise("train"))
    n = r.agg(F.coalesce(F.max("rn0") + 1, F.lit(0))).first()[0]
    tests = df.sparkSession.createDataFrame([(i,) for i in accumulator_tests(n, ratio)], "rn0 long").withColumn("__t", F.lit(True))
    return r.join(tests, "rn0", "left").withColumn("split", F.when(F.col("__t"), "test").otherwise("train")).drop("__t")


def split_unset(df: DataFrame, order: str, ratio: float = 0.8) -> DataFrame:
    """Accumulator split of the rows without a split; others keep theirs and do not count."""
    new = every_nth_split(df.where(F.col("split").isNull()).drop("split"), order, ratio).drop("rn0")
    return df.where(F.col("split").isNotNull()).unionByName(new.select(*df.columns))


def ranked_by_hash(df: DataFrame, key: str, seed, within: list[str], name: str = "rank") -> DataFrame:
    """Rank from 1 by ``md5(key:seed)`` within groups that are known to be bounded (a book, a page)."""
    h = hash_order(F.col(key), seed)
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*within).orderBy(h, key)))


def numbered_by_hash(df: DataFrame, key: str, seed, name: str = "rank") -> DataFrame:
    """Rank from 1 over the whole table by ``md5(key:seed)``, distributed."""
    return numbered(df.withColumn("__h", hash_order(F.col(key), seed)), "__h", name, 1).drop("__h")


def stratified_split(df: DataFrame, key: str, stratum: Column, ratio: float, seed: int = 42) -> DataFrame:
    """Within each of two strata the first ``floor(n * ratio)`` rows in hash order are train."""
    out = None
    for value in (True, False):
        part = df.where(F.coalesce(stratum, F.lit(False)) == value)
        r = numbered_by_hash(part, key, seed)
        n = part.agg(F.count(F.lit(1))).scalar()
        r = r.withColumn("split", F.when(F.col("rank") <= F.floor(n * ratio), "train").otherwise("test")).drop("rank").withColumn("stratum", F.lit(value))
        out = r if out is None else out.unionByName(r)
    return out


def guaranteed_sample(df: DataFrame, group: str, key: str, order: str, musts: list[Column], fraction: float, each: int = 3, seed: str = "salt") -> DataFrame:
    """Per group ``floor(n * fraction)`` rows; the first ``each`` rows of every must-have kind come before the hash order.

    If fewer rows are wanted than guaranteed, the guaranteed ones are cut short.
    """
    w = Window.partitionBy(group)
    d = df.withColumn("__n", F.count(F.lit(1)).over(w))
    sure = None
    place = F.lit(None).cast("int")
    for i, m in enumerate(musts):
        k = F.when(m, F.row_number().over(Window.partitionBy(group, m).orderBy(order, key)))
        d = d.withColumn(f"__m{i}", k)
        hit = F.coalesce(F.col(f"__m{i}") <= each, F.lit(False))
        place = F.coalesce(place, F.when(hit, F.lit(i)))
        sure = hit if sure is None else sure | hit
    d = d.withColumn("__place", F.when(sure, place).otherwise(len(musts)))
    by = F.row_number().over(Window.partitionBy(group).orderBy("__place", F.when(F.col("__place") < len(musts), F.col(order)), hash_order(F.col(key), seed), key))
    return d.withColumn("__r", by).where(F.col("__r") <= F.floor(F.col("__n") * fraction)).select(*df.columns)


def sample_size(main: Column, ratio: float) -> Column:
    """Second-source rows for ``main`` first-source ones at a mixture ratio; outside (0, 1) it is an error."""
    return F.when(F.lit(0 < ratio < 1), (main * (1 - ratio) / ratio).cast("int")).otherwise(F.raise_error(F.lit("the ratio must lie between 0 and 1")).cast("int"))


def rare_first_sample(df: DataFrame, key: str, text: str, rare: list[str], size: int, epoch: int) -> DataFrame:
    """``size`` rows for an epoch: those with a rare character first, each part in the epoch's hash order; at most the whole pool."""
    h = hash_order(F.col(key), epoch)
    return df.withColumn("is_rare", has_any(F.col(text), rare)).orderBy(F.desc("is_rare"), h, key).limit(size)


def epoch_rows(df: DataFrame) -> DataFrame:
    return df.where(F.col("split").isin("train", "test"))


def variations(df: DataFrame, text: str, rare: list[str], base: int = 2) -> DataFrame:
    """Rows times their variations, doubled where the text has a rare character; adds ``variation`` from 0."""
    n = F.when(has_any(F.col(text), rare), 2 * base).otherwise(base)
    return df.withColumn("variation", F.explode(F.sequence(F.lit(0), n - 1)))


def unit(key: Column, seed) -> Column:
    """A number in [0, 1) that key and seed decide."""
    return F.conv(F.substring(hash_order(key, seed), 1, 8), 16, 10).cast("double") / float(1 << 32)


def corrupted(df: DataFrame, key: str, text: str, rate: float = 0.05, seed: int = 42) -> DataFrame:
    """``text`` with the script lower-cased in about ``rate`` of the rows; adds ``corrupted``."""
    hit = unit(F.col(key), seed) < rate
    return df.withColumn("corrupted", hit).withColumn(text, F.when(hit, lower_script(F.col(text))).otherwise(F.col(text)))


def typo(df: DataFrame, key: str, text: str, rate: float = 0.05, seed: int = 7) -> DataFrame:
    """One substitution, deletion or insertion in about ``rate`` of the texts, all decided by hashes."""
    k, t = F.col(key), F.col(text)
    n = F.length(t)
    hit = (unit(k, seed) < rate) & (n > 0)
    at = F.floor(unit(k, f"{seed}at") * n).cast("int")
    letters = F.array(*[F.lit(chr(c)) for c in range(0x13A0, 0x13F6)])
    letter = F.element_at(letters, (F.floor(unit(k, f"{seed}letter") * 0x56) + 1).cast("int"))
    kind = F.floor(unit(k, f"{seed}kind") * 3)
    before, after, rest = F.substring(t, F.lit(1), at), F.substring(t, at + 2, n), F.substring(t, at + 1, n)
    made = F.when(kind == 0, F.concat(before, letter, after)).when((kind == 1) & (n > 1), F.concat(before, after)).when(kind == 1, t).otherwise(F.concat(before, letter, rest))
    return df.withColumn(text, F.when(hit, made).otherwise(t))


def chosen_of(options: list[str], key: Column, seed) -> Column:
    """One of the options, by the key's hash."""
    return F.element_at(F.array(*map(F.lit, options)), (F.floor(unit(key, seed) * len(options)) + 1).cast("int"))
