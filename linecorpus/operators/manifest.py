"""Filters, joins and keyed set operations on line manifests.

Absent, empty and ``Error`` values are three different things: equality tests
are null-safe, and an absent value never counts as an error or as a match.
Insertion order is the column ``ord``.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from linecorpus.functions.text import CHEROKEE, count_class, or_else
from linecorpus.operators.similar import PLAIN, similar_pairs
from linecorpus.plans.lineage import cut

# filters ----------------------------------------------------------------------


def is_labeled_target(lang: str = "Cherokee") -> Column:
    return F.col("status").eqNullSafe("labeled") & F.col("predicted_lang").eqNullSafe(lang)


def is_searchable(lang: str = "Cherokee") -> Column:
    return F.col("predicted_lang").eqNullSafe(lang) | (F.coalesce("label", F.lit("")) != "")


def is_candidate_case(lang: str = "Cherokee") -> Column:
    return (F.col("status").eqNullSafe("labeled") | (F.coalesce("label", F.lit("")) != "")) & F.col("predicted_lang").eqNullSafe(lang)


def is_error() -> Column:
    return F.col("ftm_ocr").eqNullSafe("Error") | F.col("predicted_lang").eqNullSafe("Error")


def is_ignored() -> Column:
    bad = ("not_cherokee", "bad_crop")
    return F.coalesce(F.col("status").isin(*bad), F.lit(False)) | F.coalesce(F.col("label").isin(*bad), F.lit(False))


def not_dataset(name: str) -> Column:
    return ~F.col("dataset").eqNullSafe(name)


def has_script_chars(text: Column, least: int = 5, chars: str = CHEROKEE) -> Column:
    return count_class(text, chars) >= least


def outcome(exists: Column, readable: Column, lang: Column, short: int = 10) -> Column:
    """Tag of the ordered crop filter: the first rule that applies."""
    return (
        F.when(F.coalesce("status", F.lit("")) != "unlabeled", "keep_labeled")
        .when(F.length(F.coalesce("initial_ocr", F.lit(""))) <= short, "skip_short_initial")
        .when(~exists, "missing_file")
        .when(~readable, "error_reading_image")
        .when(lang.isin("English", "Empty"), F.concat(F.lit("skip_"), F.lower(lang)))
        .otherwise(F.concat(F.lit("keep_matched_"), F.lower(lang)))
    )


def from_first_open(df: DataFrame, order: str, done: Column) -> DataFrame:
    """Rows from the first one not done onwards, done ones after it included."""
    first = df.where(~F.coalesce(done, F.lit(False))).agg(F.min(order)).scalar()
    return df.where(F.col(order) >= first)


def pending(df: DataFrame, done: DataFrame, key: str, force: bool = False) -> DataFrame:
    """Rows still to be enriched: those without an entry in ``done``."""
    return df if force else df.join(done.select(key).distinct(), key, "left_anti")


# keyed set operations -----------------------------------------------------------


def keyed_union(tables: list[DataFrame], key: str, keep: str = "first", order: str | None = None) -> DataFrame:
    """One row per key from several tables; the first or the last table that has it wins.

    Within a table the row with the least (for ``last``: greatest) ``order`` wins.
    Columns that a table lacks are null.
    """
    if keep not in ("first", "last"):
        raise ValueError("keep is first or last")
    out = None
    for i, t in enumerate(tables):
        t = t.withColumn("__source", F.lit(i))
        out = t if out is None else out.unionByName(t, allowMissingColumns=True)
    cols = [c for c in out.columns if c not in ("__source", key)]
    rank = F.struct("__source", F.col(order) if order else F.lit(0))
    pick = (F.min_by if keep == "first" else F.max_by)(F.struct(*cols), rank)
    return out.groupBy(key).agg(pick.alias("__row")).select(key, "__row.*")


def latest(df: DataFrame, key: str, order: str) -> DataFrame:
    """The last row of each key, partially aggregated before the shuffle."""
    return keyed_union([df], key, "last", order)


def merge_keeping(base: DataFrame, out: DataFrame, key: str, kept: str) -> DataFrame:
    """``base`` merged into ``out``: rows of ``out`` that have ``kept`` keep it and take all else from base.

    Rows of ``out`` without it are replaced by the base row; rows on one side only stay.
    """
    cols = [c for c in dict.fromkeys([*base.columns, *out.columns]) if c != key]
    b, o = base.select(key, F.struct(*base.columns).alias("b")), out.select(key, F.struct(*out.columns).alias("o"))
    j = b.join(o, key, "full_outer")
    picked = []
    for c in cols:
        bc = F.col(f"b.{c}") if c in base.columns else F.lit(None)
        oc = F.col(f"o.{c}") if c in out.columns else F.lit(None)
        if c == kept:
            picked.append(F.when(F.col("b").isNull(), oc).otherwise(F.coalesce(oc, bc)).alias(c))
        elif c in base.columns:
            picked.append(F.when(F.col("b").isNull(), oc).otherwise(bc).alias(c))
        else:
            picked.append(F.when(F.col("b").isNull() | F.col(f"o.{kept}").isNotNull(), oc).alias(c))
    return j.select(key, *picked)


def update_rows(df: DataFrame, updates: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """``df`` with the columns set that ``updates`` has a value for."""
    u = updates.select(key, *[F.col(c).alias(f"__{c}") for c in columns])
    new = [F.coalesce(f"__{c}", c).alias(c) if c in columns else F.col(c) for c in df.columns]
    return df.join(u, key, "left").select(*new)


def upsert(df: DataFrame, new: DataFrame, key: str, order: str) -> DataFrame:
    """Insert or replace by key; of repeated new rows the last by ``order`` stays, so a rebuild adds no copies."""
    return keyed_union([df, new], key, "last", order)


def without_key(df: DataFrame, column: str, value) -> DataFrame:
    return df.where(~F.col(column).eqNullSafe(value))


def routed(df: DataFrame, remainder: Column) -> DataFrame:
    """Recorded splits kept (an unknown one counts as train), others by ``remainder``."""
    s = F.col("split")
    return df.withColumn("split", F.when(s.isNull(), remainder).when(s.isin("train", "test"), s).otherwise("train"))


# joins --------------------------------------------------------------------------


def missing_crops(df: DataFrame, present: DataFrame, path: str = "image_path") -> DataFrame:
    """Rows that should have a crop and have none."""
    return df.where(~is_ignored()).join(present.select(path).distinct(), path, "left_anti")


#: texts of one side that are compared in one task of the label transfer
TRANSFER_BLOCK = 8192
#: rounds in which only lines that lost their place are looked up, before all lines of their scans are
TRANSFER_ROUNDS = 3
#: rows of a table of scans that is still sent to all tasks; a larger one is joined by shuffle
SENT = 100_000
#: the white space of ``text.WS``
SPACES = "".join(map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
PAIR = ("a_ord", "a_id", "b_ord", "b_id")


def _sent(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= SENT else df


def similar_texts(a: DataFrame, b: DataFrame, least: float) -> DataFrame:
    """``(scan, a_text, b_text, ratio)`` of all texts of one scan with a similarity above ``least``, of ``(scan, text)`` both; a text that is there twice counts once.

    A scan with more texts than a block is cut into blocks on both sides, each pair of
    which is a group of its own; small scans share groups.  No similar pair is lost.
    """
    sizes = a.groupBy("scan").agg(F.count(F.lit(1)).alias("a_n")).join(b.groupBy("scan").agg(F.count(F.lit(1)).alias("b_n")), "scan")
    large = F.greatest("a_n", "b_n") > TRANSFER_BLOCK
    blocks = lambda n: F.ceil(F.col(n) / TRANSFER_BLOCK).cast("int")
    sizes = cut(sizes.select("scan", large.alias("large"), blocks("a_n").alias("a_blocks"), blocks("b_n").alias("b_blocks"), (F.col("a_n") + F.col("b_n")).alias("n")))
    few = sizes.agg(F.sum(F.when(~F.col("large"), F.col("n"))), F.sum(F.when(F.col("large"), F.col("a_blocks") * F.col("b_blocks"))), F.count(F.lit(1))).first()
    sizes = _sent(sizes, few[2])
    shared = -(-(few[0] or 0) // TRANSFER_BLOCK) or 1
    tasks = max(2 * a.sparkSession.sparkContext.defaultParallelism, (shared + (few[1] or 0)) // 16)
    key = ["bin", "i", "j"]

    def placed(t: DataFrame, own: str, other: str) -> DataFrame:
        # each text goes to one block of its side and meets all of the other side
        mine, every = F.pmod(F.xxhash64("text"), F.col(f"{own}_blocks")).cast("int"), F.explode(F.sequence(F.lit(0), F.col(f"{other}_blocks") - 1))
        bin_ = F.when(F.col("large"), F.xxhash64("scan")).otherwise(F.pmod(F.xxhash64("scan"), F.lit(shared)))
        t = t.join(sizes, "scan").select("scan", "text", "large", bin_.alias("bin"), mine.alias("mine"), every.alias("met"))
        at = lambda c: F.when(F.col("large"), F.col(c)).otherwise(F.lit(-1))
        # under names of their own, both sides may come from one table
        return t.select(F.col("scan").alias("scan"), F.col("text").alias("text"), F.col("bin").alias("bin"), at("mine" if own == "a" else "met").alias("i"), at("met" if own == "a" else "mine").alias("j")).repartition(tasks, *key)

    def near(x: pd.DataFrame, y: pd.DataFrame) -> pd.DataFrame:
        x, y = (t[["scan", "text"]].drop_duplicates() for t in (x, y))
        got = similar_pairs(x["text"].tolist(), y["text"].tolist(), least, x["scan"].to_numpy(), y["scan"].to_numpy())
        i, j = np.array([g[0] for g in got], np.int64), np.array([g[1] for g in got], np.int64)
        return pd.DataFrame({"scan": x["scan"].to_numpy()[i], "a_text": x["text"].to_numpy()[i], "b_text": y["text"].to_numpy()[j], "ratio": np.array([g[2] for g in got], np.float64)})

    return placed(a, "a", "b").groupBy(*key).cogroup(placed(b, "b", "a").groupBy(*key)).applyInPandas(near, "scan string, a_text string, b_text string, ratio double")


def similar_lines(a: DataFrame, b: DataFrame, least: float) -> DataFrame:
    """``(scan, a_ord, a_id, b_ord, b_id, ratio)`` of all lines of one scan with a similarity above ``least``, of ``(scan, ord, id, text)`` both; ``ord`` and ``id`` together are unique."""
    texts = lambda t: t.select("scan", "text")
    lines = lambda t, name: t.select("scan", *[F.col(c).alias(f"{name}_{c}") for c in ("ord", "id", "text")])
    return similar_texts(texts(a), texts(b), least).join(lines(a, "a"), ["scan", "a_text"]).join(lines(b, "b"), ["scan", "b_text"]).select("scan", *PAIR, "ratio")


def _chosen(a: DataFrame, b: DataFrame, pairs: DataFrame, equal: bool) -> DataFrame:
    """The greedy choice of each scan over known ``pairs`` of texts and, if ``equal``, equal texts: ``(scan, ord, id, text, new_id, ratio)`` of all old lines.

    Where none was free the ratio is null; else the text is.
    """
    bins = 2 * a.sparkSession.sparkContext.defaultParallelism
    kind = a.schema["ord"].dataType.simpleString()
    lines = lambda t, name: t.select(F.lit(name).alias("side"), "scan", "ord", "id", "text")
    binned = lambda t: t.withColumn("bin", F.pmod(F.xxhash64("scan"), F.lit(bins)).cast("int")).repartition(bins, "bin")

    def choose(x: pd.DataFrame, y: pd.DataFrame) -> pd.DataFrame:
        x = x.sort_values(["ord", "id"], kind="stable")
        news, olds = x[x["side"] == "b"], x[x["side"] == "a"]
        # free new lines of a text, the first last
        free: dict[tuple[str, str], list[tuple[int, str]]] = {}
        for k, (scan, text, i) in enumerate(zip(news["scan"], news["text"], news["id"])):
            free.setdefault((scan, text), []).append((k, i))
        for q in free.values():
            q.reverse()
        likes: dict[tuple[str, str], list[tuple[float, str]]] = {}
        for scan, s, t, r in zip(y["scan"], y["a_text"], y["b_text"], y["ratio"]):
            likes.setdefault((scan, s), []).append((r, t))
        for q in likes.values():
            q.sort(reverse=True)
        ids: list[str | None] = []
        ratios: list[float | None] = []
        for scan, text in zip(olds["scan"], olds["text"]):
            at, top = (scan, text), None
            if equal and len(text) < PLAIN and free.get(at):
                t, top = text, 1.0
            elif at in likes:
                left = likes[at] = [(r, t) for r, t in likes[at] if free.get((scan, t))]
                if left:
                    top = left[0][0]
                    _, t = min((free[scan, t][-1][0], t) for r, t in left if r == top)
            ids.append(None if top is None else free[scan, t].pop()[1])
            ratios.append(top)
        ratio = pd.Series(ratios, olds.index, dtype="float64")
        return olds[["scan", "ord", "id"]].assign(text=olds["text"].where(ratio.isna(), None), new_id=pd.Series(ids, olds.index, dtype=object), ratio=ratio)

    got = binned(lines(a, "a").unionByName(lines(b, "b"))).groupBy("bin").cogroup(binned(pairs).groupBy("bin")).applyInPandas(choose, f"scan string, ord {kind}, id string, text string, new_id string, ratio double")
    return got.withColumn("ratio", F.when(~F.isnan("ratio"), F.col("ratio")))


def transfer_labels(old: DataFrame, new: DataFrame, least: float = 0.75) -> DataFrame:
    """Labels of old lines for new lines of the same scan by text similarity, one to one.

    Old lines are taken in their order; each takes the free new line with the
    highest ratio above ``least`` (the first of equals) out of the pool.  The
    result is ``(old_id, new_id, status, label, ratio)``.

    No ratio is above that of equal texts, so an old line that gets a new line of
    its own text needs no other pairs.  Those that get none are compared with all
    new texts of their scan (:func:`similar_texts`), and so are the lines that
    lose their place to one of these, until every line either has one of its own
    text or all its pairs are known: then the choice is that over all pairs.
    A scan that holds much of the table is many tasks; only its known pairs and
    their lines come together for the greedy choice.
    """
    strip = lambda c: F.btrim(c, F.lit(SPACES))
    ref = or_else(strip(F.col("label")), strip(F.col("initial_ocr")))
    o = old.where(F.col("status").isin("labeled", "not_cherokee", "nasty_crop") & F.col("source_scan").isNotNull()).withColumnRenamed("source_scan", "scan")
    a = o.select("scan", "ord", "id", ref.alias("text")).where("text is not null")
    n = strip(F.col("initial_ocr"))
    b = cut(new.where(F.col("status").eqNullSafe("unlabeled") & F.col("source_scan").isNotNull()).select(F.col("source_scan").alias("scan"), "ord", "id", n.alias("text")).where("text <> ''"))
    # lines of a text are counted by its digest; if two should have the same, the rounds below find what that hides
    digest = F.xxhash64("scan", "text").alias("d")
    count = a.select(digest, "scan", "text", F.lit(1).alias("k")).unionByName(b.select(digest, F.lit(None).cast("string").alias("scan"), F.lit(None).cast("string").alias("text"), F.lit(-1).alias("k")))
    count = count.groupBy("d").agg(F.max("scan").alias("scan"), F.max("text").alias("text"), F.sum("k").alias("k")).where("text is not null")
    # of longer equal texts the ratio may be less
    equal = least < 1
    lost = looked = cut((count.where((F.col("k") > 0) | (F.length("text") >= PLAIN)) if equal else count).select("scan", "text"))
    known = F.lit(equal) & (F.col("a_text") == F.col("b_text")) & (F.length("a_text") < PLAIN)
    pairs, done, of = None, [], lambda t: t
    for k in range(TRANSFER_ROUNDS + 2):
        more = cut(similar_texts(lost, b.select("scan", "text"), least).where(~known))
        pairs = more if pairs is None else pairs.unionByName(more)
        won = cut(_chosen(of(a), of(b), of(pairs), equal))
        lost = cut(won.where("ratio is null").select("scan", "text").distinct().join(looked, ["scan", "text"], "left_anti"))
        scans = lost.select("scan").distinct()
        if not (rows := scans.count()):
            done.append(won)
            break
        # scans are independent, so only these are looked at again
        scans = _sent(cut(scans), rows)
        done.append(won.join(scans, "scan", "left_anti"))
        of = lambda t, scans=scans: t.join(scans, "scan", "left_semi")
        if k >= TRANSFER_ROUNDS:
            lost = cut(of(a).select("scan", "text").distinct().join(looked, ["scan", "text"], "left_anti"))
        looked = looked.unionByName(lost)
    won = reduce(DataFrame.unionByName, done).where("ratio is not null").select("scan", "ord", "id", "new_id", "ratio")
    facts = o.select("scan", "ord", "id", "status", F.nullif("label", F.lit("")).alias("label"))
    return won.join(facts, ["scan", "ord", "id"]).select(F.col("id").alias("old_id"), "new_id", "status", "label", "ratio")


def with_default(df: DataFrame, lookup: DataFrame, key: str, defaults: dict) -> DataFrame:
    """Left lookup join whose misses give ``defaults``."""
    j = df.join(lookup, key, "left")
    return j.select(*df.columns, *[F.coalesce(c, F.lit(v)).alias(c) for c, v in defaults.items()])


# geometry -----------------------------------------------------------------------


def running_groups(df: DataFrame, page: str = "page_id", tolerance: float = 0.08) -> DataFrame:
    """Blocks of each page put greedily into the first column whose mean left and right edges are near.

    Input ``page, block_ord, page_width, bbox``; adds ``grp``, numbered from 0 by
    first appearance.  Depends on the order of blocks, so each page runs as one group.
    """
    schema = T.StructType([*df.schema.fields, T.StructField("grp", T.IntegerType())])

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("block_ord")
        sums: list[list[float]] = []
        got = []
        for b, width in zip(pdf["bbox"], pdf["page_width"]):
            near = width * tolerance
            for g, (left, right, n) in enumerate(sums):
                if abs(b[0] - left / n) <= near and abs(b[2] - right / n) <= near:
                    break
            else:
                g = len(sums)
                sums.append([0.0, 0.0, 0])
            sums[g][0] += b[0]
            sums[g][1] += b[2]
            sums[g][2] += 1
            got.append(g)
        return pdf.assign(grp=pd.array(got, dtype="int32"))

    return df.groupBy(page).applyInPandas(run, schema)


def column_boxes(groups: DataFrame, page: str = "page_id", least: int = 3, extent: float = 0.05) -> DataFrame:
    """Union boxes of groups with enough blocks or enough height, left to right per page."""
    corner = lambda i: F.element_at("bbox", i)
    g = groups.groupBy(page, "grp").agg(F.min(corner(1)).alias("xmin"), F.min(corner(2)).alias("ymin"), F.max(corner(3)).alias("xmax"), F.max(corner(4)).alias("ymax"), F.count(F.lit(1)).alias("blocks"), F.first("page_height").alias("page_height"))
    kept = g.where((F.col("blocks") >= least) | (F.col("ymax") - F.col("ymin") >= extent * F.col("page_height")))
    w = Window.partitionBy(page).orderBy("xmin", "grp")
    return kept.select(page, (F.row_number().over(w) - 1).alias("column_index"), "xmin", "ymin", "xmax", "ymax", "blocks")


def padded_box(box: Column, width: Column, height: Column, pad_x: int = 10, pad_y: int = 3, target: int = 30) -> Column:
    """A line's box with padding, clamped to the image, and the scale of its crop.

    Lines up to one and a half times the target height are not scaled; for
    taller ones the padding grows by the inverse of the scale.
    """
    whole = lambda i: F.element_at(box, i).cast("int")
    h = F.greatest(F.lit(1), whole(4) - whole(2))
    plain = h <= 1.5 * target
    scale = F.when(plain, 1.0).otherwise(target / h)
    px, py = (F.when(plain, F.lit(p)).otherwise((p / (target / h)).cast("int")) for p in (pad_x, pad_y))
    return F.struct(
        F.greatest(F.lit(0), whole(1) - px).alias("x1"), F.greatest(F.lit(0), whole(2) - py).alias("y1"), F.least(width, whole(3) + px).alias("x2"), F.least(height, whole(4) + py).alias("y2"), scale.alias("scale")
    )


def unscaled_height(crop_height: Column, pad_y: int = 3, target: int = 30) -> Column:
    """The line height that padding and scaling turned into a crop's height: ``(scale, height)``."""
    h = crop_height
    pads = F.filter(F.sequence(F.lit(target), F.greatest(F.lit(target), h - 1)), lambda u: u + 2 * (pad_y / (target / u)).cast("int") == h)
    near = F.lit(36.0) / h
    found = F.get(pads, F.lit(0))
    return F.when(h <= 51, F.struct(F.lit(1.0).alias("scale"), F.greatest(F.lit(1), h - 2 * pad_y).alias("height"))).when(found.isNotNull(), F.struct((target / found).alias("scale"), found.alias("height"))).otherwise(F.struct(near.alias("scale"), (30 / near).cast("int").alias("height")))
