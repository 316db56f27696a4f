"""Same and near-same records across splits (problem 3).

Labels are normalised to their letters and digits.  A rolling hash of
:data:`Q` letters runs over each, and a label is cut into chunks where the hash
is lowest among its :data:`RADIUS` neighbours on both sides, so cuts depend on
content alone.  Chunk digests are joined across splits.  Shared chunk lengths
are summed into overlap fractions: per record, how much of it occurs in the
other split at all (:func:`record_overlaps`), and per pair.

Pairs come from two joins of digests.  The first finds every pair that shares
at least :data:`SHARE` of its letters in chunks: only a label's rarest chunks
that make up the rest of its letters and one more are joined, since of the
shared ones the rarest must be among them.  Edits that are spread evenly can
leave no chunk whole, so the second, exact way cuts at every place: with at
most ``d`` edits between two texts no more than ``Q * d`` of their windows
differ, so the ``Q * d + T`` rarest windows of both (all copies of the last one
too) share at least ``T``, and no pair is lost.  A label of 20 letters or more
has at least 9 windows beyond ``Q * d``, so ``T`` never asks for more than
there are.  An exact edit distance decides on all pairs found.  How rare a chunk
is comes from a histogram of fixed size over all labels; one that many labels
hold is spread over several keys.

Copies are one class, known by a digest of 128 bits: classes are joined, not
rows, and reports are made from classes with their numbers of links.  Null and
empty labels, labels of fewer than ``min_letters`` letters and rows without a
split take no part; extra columns are ignored; an empty table gives no pairs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from linecorpus.llm.forms import LOOKS_CHEROKEE, canonical
from linecorpus.llm.sketches import hashed_counts, mix
from linecorpus.plans.lineage import cut

Q = 4
#: neighbours on either side that a cut's hash is lowest of; at most Q - 1
RADIUS = 3
#: share of the letters in shared chunks from which the first join finds a pair
SHARE = 0.5
#: shared windows that a pair of the exact way must have
T = 4
MIN_LETTERS = 20
#: one edit in so many letters of the longer label
ONE_IN = 8
BITS = 18
#: a digest that so many chunks may share is spread over one more key
HOT = 50_000


#: letters that look like one Latin letter, and so like each other, count as one
_ALIKE = str.maketrans({y: c[0] for c in LOOKS_CHEROKEE.values() for y in c[1:]})


def comparable(label: str | None) -> tuple[str, int]:
    """Letters and digits in upper case, and how many letters they are."""
    if not label:
        return "", 0
    up = canonical(label).upper().translate(_ALIKE)
    kept = "".join(x for x in up if x.isalnum())
    return kept, sum(x.isalpha() for x in kept)


def allowed(n):
    """Most edits a text of ``n`` letters can have against any partner: the longest partner has 8/7 of its letters."""
    return (n * ONE_IN // (ONE_IN - 1)) // ONE_IN


def windows(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rolling hash of every window of every text, the text's number and the window's place."""
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    n = np.array([len(t) for t in texts], np.int64)
    row = np.repeat(np.arange(len(texts)), n)
    start = np.repeat(np.cumsum(n) - n, n)
    place = np.arange(len(codes)) - start
    ok = place + Q <= n[row]
    h = np.zeros(len(codes), np.uint64)
    for i in range(Q):
        h = h * np.uint64(1_000_003) + np.roll(codes, -i)
    return mix(h[ok]), row[ok], place[ok]


def _hashes(texts: list[str]) -> np.ndarray:
    return windows(texts)[0] if texts else np.zeros(0, np.uint64)


_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def content_chunks(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Digest, text's number, place and length of the content-defined chunks of all texts; those of a text cover it."""
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    n = np.array([len(t) for t in texts], np.int64)
    row = np.repeat(np.arange(len(texts)), n)
    start = np.repeat(np.cumsum(n) - n, n)
    # places without a whole window count as highest; they also part the texts
    top = np.uint64(0xFFFFFFFFFFFFFFFF)
    h = np.full(len(codes) + 2 * RADIUS, top, np.uint64)
    hw, rw, pw = windows(texts)
    at = start[np.searchsorted(row, rw)] + pw if len(rw) else rw
    h[at + RADIUS] = hw
    own = h[RADIUS : RADIUS + len(codes)]
    low = own < top
    for s in range(1, RADIUS + 1):
        low &= (own < h[RADIUS - s : RADIUS - s + len(codes)]) & (own <= h[RADIUS + s : RADIUS + s + len(codes)])
    begins = np.flatnonzero(low | (np.arange(len(codes)) == start))
    ends = np.append(begins[1:], len(codes)) if len(begins) else begins
    # a chunk's polynomial hash from running sums, all modulo 2 ** 64: the same wherever it stands
    sums = np.append(np.zeros(1, np.uint64), np.cumsum(mix(codes + np.uint64(1)) * _powers(_BASE, len(codes)), dtype=np.uint64))
    digest = mix((sums[ends] - sums[begins]) * _powers(_INVERSE, len(codes))[begins] + (ends - begins).astype(np.uint64)) if len(begins) else np.zeros(0, np.uint64)
    return digest, row[begins], begins - start[begins], ends - begins


def _chunk_hashes(texts: list[str]) -> np.ndarray:
    return content_chunks(texts)[0] if texts else np.zeros(0, np.uint64)


def _window_hashes(texts: list[str]) -> np.ndarray:
    return windows(texts)[0] if texts else np.zeros(0, np.uint64)


def normalised(df: DataFrame, min_letters: int = MIN_LETTERS, source: str | None = None) -> DataFrame:
    """``(ord, train, source, d, norm)`` of the rows that take part; ``d`` is the digest of their class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep, norms = [], []
            for label in b.column(3).to_pylist():
                norm, letters = comparable(label)
                keep.append(letters >= min_letters)
                if keep[-1]:
                    norms.append(norm)
            ok = pa.array(keep, pa.bool_())
            d = [hashlib.blake2b(x.encode("utf-8", "surrogatepass"), digest_size=16).digest() for x in norms]
            yield pa.RecordBatch.from_arrays([*(b.column(i).filter(ok) for i in range(3)), pa.array(d, pa.binary()), pa.array(norms, pa.string())], ["ord", "train", "source", "d", "norm"])

    rows = df.where(F.col("split").isin("train", "test") & (F.length("label") >= min_letters) & F.col("ord").isNotNull())
    rows = rows.select(F.col("ord").cast("long").alias("ord"), (F.col("split") == "train").alias("train"), (F.col(source).cast("string") if source else F.lit(None).cast("string")).alias("source"), "label")
    return rows.mapInArrow(run, "ord long, train boolean, source string, d binary, norm string")


def classes(rows: DataFrame) -> DataFrame:
    """``(d, tid, norm, n_test, n_train)``: one row per distinct text; ``tid`` is its least ``ord``."""
    count = lambda c: F.sum(c.cast("long"))
    return rows.groupBy("d").agg(F.first("norm").alias("norm"), F.min("ord").alias("tid"), count(~F.col("train")).alias("n_test"), count(F.col("train")).alias("n_train"))


def _digests(texts: DataFrame, counts, prefix: str, exact: bool, repeat: bool, hot: int) -> DataFrame:
    """The joined chunks of ``(tid, norm)``: digest and, packed in one number, the text's length and the chunk's place.

    ``repeat``: this side holds a copy of a hot digest for each of its keys, the other is dealt to them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = counts.value
        for b in batches:
            tids, norms = b.column(0).to_numpy(zero_copy_only=False), b.column(1).to_pylist()
            if not norms:
                continue
            n = np.array([len(t) for t in norms], np.int64)
            if exact:
                h, row, place = windows(norms)
            else:
                h, row, place, size = content_chunks(norms)
            freq = cells[(h >> np.uint64(64 - BITS)).astype(np.int64)]
            order = np.lexsort((place, h, freq, row))
            h, row, place, freq = h[order], row[order], place[order], freq[order]
            first = np.searchsorted(row, np.arange(len(norms) + 1))
            if exact:
                end = np.minimum(first[:-1] + Q * allowed(n) + T, first[1:]) - 1
            else:
                # letters before a chunk in this order; chunks are taken until they cover more than cannot be left out
                size = size[order]
                before = np.cumsum(size) - size
                before -= before[first[:-1]][row]
                taken = before <= (1 - SHARE) * n[row]
                end = first[:-1] + np.add.reduceat(taken, first[:-1]) - 1
            keep = (np.arange(len(row)) <= end[row]) | (h == h[end][row])
            h, row, place, keys = h[keep], row[keep], place[keep], freq[keep].astype(np.int64) // hot + 1
            if repeat and keys.max(initial=1) > 1:
                which = np.arange(keys.sum()) - np.repeat(np.cumsum(keys) - keys, keys)
                h, row, place = (np.repeat(x, keys) for x in (h, row, place))
            else:
                which = np.zeros(len(h), np.int64) if repeat else np.abs(tids[row] % keys)
            h = h + which.astype(np.uint64) * np.uint64(_BASE)
            yield pa.RecordBatch.from_pydict({"chunk": h.view(np.int64), "tid": tids[row], "at": (place << 24) | n[row]})

    return texts.select("tid", "norm").mapInArrow(run, "chunk long, tid long, at long").select("chunk", F.col("tid").alias(f"{prefix}_tid"), F.col("at").alias(f"{prefix}_at"))


def candidates(texts: DataFrame, exact: bool, hot: int = HOT) -> DataFrame:
    """``(a_tid, b_tid)``: classes of a test and a train row that one of the two joins brings together."""
    spark = texts.sparkSession
    counts = spark.sparkContext.broadcast(hashed_counts(texts.select("norm"), _window_hashes if exact else _chunk_hashes, BITS))
    a = _digests(texts.where("n_test > 0"), counts, "a", exact, True, hot)
    b = _digests(texts.where("n_train > 0"), counts, "b", exact, False, hot)
    place, size = (lambda c: F.shiftright(c, 24)), (lambda c: F.col(c).bitwiseAND(0xFFFFFF))
    most = F.greatest(size("a_at"), size("b_at"))
    near = (F.abs(size("a_at") - size("b_at")) * ONE_IN <= most) & (F.abs(place("a_at") - place("b_at")) * ONE_IN <= most) & (F.col("a_tid") != F.col("b_tid"))
    met = a.join(b, "chunk").where(near).groupBy("a_tid", "b_tid")
    if exact:
        return met.agg(F.count(F.lit(1)).alias("shared")).where(F.col("shared") >= T).select("a_tid", "b_tid")
    return met.agg(F.lit(1).alias("one")).select("a_tid", "b_tid")


@F.pandas_udf(DoubleType())
def shared_share(a: pd.Series, b: pd.Series) -> pd.Series:
    """The share of the longer text's letters that lie in chunks of both texts."""
    out = []
    for x, y in zip(a, b):
        h, row, _, size = content_chunks([x, y])
        have: dict[int, int] = {}
        for d in h[row == 1].tolist():
            have[d] = have.get(d, 0) + 1
        got = 0
        for d, n in zip(h[row == 0].tolist(), size[row == 0].tolist()):
            if have.get(d, 0):
                have[d] -= 1
                got += n
        out.append(got / max(1, len(x), len(y)))
    return pd.Series(out, dtype="float64")


def class_pairs(texts: DataFrame) -> DataFrame:
    """``(a, b, edits, overlap)``: digests of all same or near-same classes of a test (``a``) and a train row (``b``)."""
    pairs = candidates(texts, False).unionByName(candidates(texts, True)).distinct()
    ta, tb = (texts.where(f"{n} > 0").select(F.col("tid").alias(f"{p}_tid"), F.col("norm").alias(f"{p}_norm"), F.col("d").alias(p)) for p, n in (("a", "n_test"), ("b", "n_train")))
    named = pairs.join(ta, "a_tid").join(tb, "b_tid")
    longer = F.greatest(F.length("a_norm"), F.length("b_norm"))
    named = named.withColumn("edits", F.levenshtein("a_norm", "b_norm")).where((F.col("edits") * ONE_IN <= longer) & (F.col("a") != F.col("b")))
    close = named.select("a", "b", "edits", shared_share("a_norm", "b_norm").alias("overlap"))
    same = texts.where("n_test > 0 and n_train > 0").select(F.col("d").alias("a"), F.col("d").alias("b"), F.lit(0).alias("edits"), F.lit(1.0).alias("overlap"))
    return same.unionByName(close)


def cross_split_pairs(df: DataFrame, min_letters: int = MIN_LETTERS) -> DataFrame:
    """``(test_ord, train_ord, edits, overlap)`` of all same and near-same labels of a test and a train row.

    ``overlap`` is the share of the longer text that lies in chunks of both
    (1.0 for equal texts).  Repeated rows count each.
    """
    rows = cut(normalised(df, min_letters))
    pairs = class_pairs(cut(classes(rows)))
    t, r = (rows.where(c).select(F.col("d").alias(p), F.col("ord").alias(o)) for p, c, o in (("a", ~F.col("train"), "test_ord"), ("b", F.col("train"), "train_ord")))
    return pairs.join(t, "a").join(r, "b").select("test_ord", "train_ord", F.col("edits").cast("int").alias("edits"), "overlap")


def record_overlaps(texts: DataFrame) -> DataFrame:
    """``(tid, test_overlap, train_overlap)``: how much of each class lies in chunks that the other split has.

    ``test_overlap`` is that of its test rows, null if it has none.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            tids, norms = b.column(0).to_numpy(zero_copy_only=False), b.column(1).to_pylist()
            if norms:
                h, row, _, size = content_chunks(norms)
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(tids[row]), pa.array(size), b.column(2).take(pa.array(row)), b.column(3).take(pa.array(row))], ["chunk", "tid", "size", "test", "train"])

    c = texts.select("tid", "norm", (F.col("n_test") > 0).alias("test"), (F.col("n_train") > 0).alias("train")).mapInArrow(run, "chunk long, tid long, size long, test boolean, train boolean")
    # combined in the task before the shuffle: one row per digest, however many records hold it
    flags = c.groupBy("chunk").agg(F.max("test").alias("in_test"), F.max("train").alias("in_train")).where("in_test and in_train").select("chunk", F.lit(True).alias("both"))
    part = c.join(flags, "chunk", "left").groupBy("tid").agg(F.max("test").alias("test"), F.max("train").alias("train"), (F.sum(F.when(F.col("both"), F.col("size")).otherwise(0)) / F.sum("size")).alias("overlap"))
    return part.select("tid", F.when(F.col("test"), F.col("overlap")).alias("test_overlap"), F.when(F.col("train"), F.col("overlap")).alias("train_overlap"))


def overlap_report(df: DataFrame, source: str, min_letters: int = MIN_LETTERS) -> DataFrame:
    """Per split and source: rows that take part, rows that recur in the other split (exactly, at all), their links and mean overlap.

    A row's links are the rows of the other split that are the same or nearly;
    they are counted by classes, never written out.  ``mean_overlap`` is taken
    over all rows that take part.
    """
    rows = cut(normalised(df, min_letters, source))
    texts = cut(classes(rows))
    p = cut(class_pairs(texts).select("a", "b", "edits"))
    n = texts.select("d", "n_test", "n_train")
    # links of a test class are the train rows of its partners, and the other way round
    a = p.join(n.select(F.col("d").alias("b"), F.col("n_train").alias("links")), "b").groupBy(F.col("a").alias("d")).agg(F.sum("links").alias("links"), F.min("edits").alias("least")).withColumn("train", F.lit(False))
    b = p.join(n.select(F.col("d").alias("a"), F.col("n_test").alias("links")), "a").groupBy(F.col("b").alias("d")).agg(F.sum("links").alias("links"), F.min("edits").alias("least")).withColumn("train", F.lit(True))
    # rows are counted per class and source first, so a text with many copies is one row from here on
    per = rows.groupBy("d", "train", "source").agg(F.count(F.lit(1)).alias("n"))
    j = per.join(a.unionByName(b), ["d", "train"], "left").join(texts.select("d", "tid"), "d").join(record_overlaps(texts), "tid")
    overlap = F.when(F.col("train"), F.col("train_overlap")).otherwise(F.col("test_overlap"))
    linked = F.col("links").isNotNull()
    return j.groupBy(F.when(F.col("train"), "train").otherwise("test").alias("split"), "source").agg(
        F.sum("n").alias("rows"),
        F.coalesce(F.sum(F.when(linked, F.col("n"))), F.lit(0)).alias("linked_rows"),
        F.coalesce(F.sum(F.when(F.col("least") == 0, F.col("n"))), F.lit(0)).alias("exact_rows"),
        F.coalesce(F.sum(F.col("n") * F.col("links")), F.lit(0)).alias("links"),
        F.round(F.sum(F.col("n") * overlap) / F.sum("n"), 4).alias("mean_overlap"),
    )
