"""Queries that write through a sink and read back through a source, in the session's checkpoint folder."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linecorpus.operators import images, manifest
from linecorpus.plans.catalog import query
from linecorpus.plans.lineage import ensure_checkpoint_dir
from linecorpus.plans.tables import table
from linecorpus.sources import files, readers, sinks


def folder(s: SparkSession, name: str) -> str:
    path = f"{ensure_checkpoint_dir(s)}/io/{name}"
    files.remove(s, path)
    return path


def mounted(path: str) -> str:
    """A folder that Python tasks write to by its path: the shared folder must be mounted."""
    return path.removeprefix("file://").removeprefix("file:")


def named(df: DataFrame, path: str) -> None:
    """One file per row of ``df(bucket, value)``, in a folder per bucket."""
    df.repartition("bucket").write.partitionBy("bucket").text(path)


@query("src02_json_list", "SELECT id, original_filename, epoch_us(uploaded_at) AS uploaded_us FROM uploads")
def _(s, d):
    u = table(s, d, "uploads").select("id", "original_filename", "uploaded_at")
    # lists of some thousand records each, one file a list
    n = u.count() // 5000 + 1
    lists = u.groupBy(F.pmod(F.xxhash64("id"), F.lit(n)).alias("bucket")).agg(F.to_json(F.collect_list(F.struct("id", "original_filename", "uploaded_at")), {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}).alias("value"))
    named(lists, path := folder(s, "src02"))
    return readers.json_list(s, path, "id string, original_filename string, uploaded_at timestamp").select("id", "original_filename", F.unix_micros("uploaded_at").alias("uploaded_us"))


@query("src03_fallback_path", "SELECT DISTINCT id FROM uploads")
def _(s, d):
    sinks.json_records(table(s, d, "uploads").select("id").distinct(), path := folder(s, "src03"))
    return s.read.schema("id string").json(readers.first_present(s, path + "-missing", path))


_IMAGE = "regexp_matches(lower(original_filename), '\\.(png|jpg|jpeg|tif|tiff|jp2)$')"


def _pictures(s, d, name):
    u = table(s, d, "uploads").where("original_filename is not null").select("id", "original_filename").distinct()
    p = u.select(F.concat_ws("/", F.substring(F.md5("id"), 1, 1), F.concat("id", F.lit("__"), "original_filename")).alias("path"), F.col("id").alias("content"))
    sinks.write_files(p, mounted(path := folder(s, name))).write.format("noop").mode("overwrite").save()
    return path


@query("src06_scans_below", f"SELECT DISTINCT id || '__' || original_filename AS name, length(id) AS bytes FROM uploads WHERE {_IMAGE}")
def _(s, d):
    return readers.scans(s, _pictures(s, d, "src06")).select(F.element_at(F.split("path", "/"), -1).alias("name"), F.col("length").alias("bytes"))


@query("src07_scans_flat", f"SELECT DISTINCT id || '__' || original_filename AS name FROM uploads WHERE {_IMAGE} AND left(md5(id), 1) = 'a'")
def _(s, d):
    path = _pictures(s, d, "src07")
    some = [n for n in files.names(s, path) if n == "a"]
    none = s.createDataFrame([], "name string")
    return none if not some else readers.scans(s, f"{path}/a", recursive=False).select(F.element_at(F.split("path", "/"), -1).alias("name"))


@query("src08_books", "SELECT 'book_' || left(verse_key, 2) AS book, count(*) AS verses FROM verses GROUP BY 1")
def _(s, d):
    v = table(s, d, "verses").select(F.substring("verse_key", 1, 2).alias("book"), "verse_key")
    b = v.groupBy("book").agg(F.to_json(F.collect_list("verse_key")).alias("content")).select(F.concat(F.lit("book_"), "book", F.lit("/segment_map.json")).alias("path"), "content")
    sinks.write_files(b, mounted(path := folder(s, "src08"))).write.format("noop").mode("overwrite").save()
    return readers.books(s, path).select("book", F.size(F.from_json("value", "array<string>")).cast("long").alias("verses"))


@query("src09_ground_truth", "SELECT ord::VARCHAR AS stem, regexp_replace(regexp_replace(label, '^\\s+', ''), '\\s+$', '') AS truth FROM manifest_w_lang WHERE label <> '' AND dataset = 'cnt'")
def _(s, d):
    m = table(s, d, "manifest_w_lang").where("label <> '' and dataset = 'cnt'").select(F.concat(F.col("ord").cast("string"), F.lit(".gt.txt")).alias("path"), F.concat(F.lit(" \n"), "label", F.lit("\n")).alias("content"))
    sinks.write_files(m, mounted(path := folder(s, "src09"))).write.format("noop").mode("overwrite").save()
    return readers.ground_truth(s, path)


@query("snk01_json_records", "SELECT ord, label, CASE WHEN ftm_confidence >= 50 THEN ftm_confidence END AS ftm_confidence FROM manifest_w_lang")
def _(s, d):
    m = table(s, d, "manifest_w_lang").select("ord", "label", F.when(F.col("ftm_confidence") < 50, float("nan")).otherwise(F.col("ftm_confidence")).alias("ftm_confidence"))
    sinks.json_records(m, path := folder(s, "snk01"))
    return s.read.schema(m.schema).json(path)


@query("snk02_newest_version", "SELECT id, label FROM line_metadata WHERE label <> ''")
def _(s, d):
    m = table(s, d, "line_metadata").select("id", "label")
    path = folder(s, "snk02")
    for part in (m.where("label is null"), m, m.where("label <> ''")):
        sinks.versioned(part, path)
    assert len(files.names(s, path)) == 2
    return s.read.parquet(sinks.current(s, path))


@query("snk04_csv_report", "SELECT ord, array_to_string(line_bbox, ',') AS line_bbox, status FROM manifest_w_lang WHERE len(line_bbox) > 0")
def _(s, d):
    sinks.csv_report(table(s, d, "manifest_w_lang").where("size(line_bbox) > 0").select("ord", "line_bbox", "status"), path := folder(s, "snk04"))
    return s.read.option("header", True).schema("ord long, line_bbox string, status string").csv(path)


@query("snk06_markdown", "SELECT '| ' || split || ' | ' || count(*) || ' | ' || CASE WHEN avg(ftm_confidence) IS NULL THEN 'N/A' ELSE printf('%.3f', avg(ftm_confidence)) END || ' |' AS line FROM manifest_w_lang WHERE split IS NOT NULL GROUP BY split")
def _(s, d):
    g = table(s, d, "manifest_w_lang").where("split is not null").groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.avg("ftm_confidence").alias("confidence"))
    lines = sinks.markdown(g, "Lines by split").splitlines()
    return s.createDataFrame([(x,) for x in lines[4:]], "line string")


@query("snk11_list_file", "SELECT image_path FROM manifest_w_lang WHERE image_path IS NOT NULL AND image_path <> ''")
def _(s, d):
    sinks.list_file(table(s, d, "manifest_w_lang").where("image_path <> ''"), "image_path", path := folder(s, "snk11"))
    return s.read.text(path).select(F.col("value").alias("image_path"))


@query("snk12_routed_by_class", "SELECT predicted_lang, count(*) AS n, sum(ord)::BIGINT AS ords FROM manifest_w_lang WHERE predicted_lang <> '' GROUP BY predicted_lang")
def _(s, d):
    sinks.by_class(table(s, d, "manifest_w_lang").where("predicted_lang <> ''").select("ord", "predicted_lang"), path := folder(s, "snk12"), "predicted_lang")
    return s.read.parquet(path).groupBy("predicted_lang").agg(F.count(F.lit(1)).alias("n"), F.sum("ord").alias("ords"))


@query("snk09_upsert_candidates", "SELECT id, coalesce(c.candidates, 'old') AS candidates FROM line_metadata FULL JOIN (SELECT DISTINCT id, candidates FROM fts_candidates) c USING (id)")
def _(s, d):
    old = table(s, d, "line_metadata").select("id", F.lit("old").alias("candidates"), F.lit(0).alias("at"))
    new = table(s, d, "fts_candidates").select("id", "candidates", F.lit(1).alias("at")).distinct()
    return manifest.upsert(old, new, "id", "at").select("id", "candidates")


# images drawn from a line's number: 6 x 8 grey values that SQL can draw too
_PIXELS = """px AS (SELECT ord, y, x, ((ord * 31 + y * y * 57 + x * 101 + x * y * 13) % 256)::INT AS v FROM manifest_w_lang, range(0, 6) a(y), range(0, 8) b(x) WHERE len(line_bbox) = 4)"""


def _drawn(n: int):
    import numpy as np

    y, x = np.mgrid[0:6, 0:8]
    return ((n * 31 + y * y * 57 + x * 101 + x * y * 13) % 256).astype(np.uint8)


@query(
    "geo05_opened_sums",
    f"""WITH {_PIXELS},
    er AS (SELECT p.ord, p.y, p.x, min(q.v) AS v FROM px p JOIN px q ON q.ord = p.ord AND q.y BETWEEN p.y - 1 AND p.y + 1 AND q.x BETWEEN p.x - 1 AND p.x + 1 GROUP BY ALL),
    op AS (SELECT p.ord, p.y, p.x, max(q.v) AS v FROM er p JOIN er q ON q.ord = p.ord AND q.y BETWEEN p.y - 1 AND p.y + 1 AND q.x BETWEEN p.x - 1 AND p.x + 1 GROUP BY ALL)
    SELECT ord, (SELECT sum(v)::BIGINT FROM er e WHERE e.ord = op.ord) AS eroded, sum(v)::BIGINT AS opened FROM op GROUP BY ord""",
)
def _(s, d):
    m = table(s, d, "manifest_w_lang").where("size(line_bbox) = 4").select("ord")
    sums = T.StructType([T.StructField("eroded", T.LongType()), T.StructField("opened", T.LongType())])

    @F.pandas_udf(sums)
    def both(col: pd.Series) -> pd.DataFrame:
        drawn = [_drawn(int(n)) for n in col]
        return pd.DataFrame({"eroded": [int(images.eroded(g).sum(dtype="int64")) for g in drawn], "opened": [int(images.opened(g).sum(dtype="int64")) for g in drawn]})

    return m.select("ord", both("ord").alias("r")).select("ord", "r.*")


@query("geo14_variant_counts", "SELECT ord, CASE WHEN n = 1 THEN 'plain' WHEN n = 2 THEN 'elastic' WHEN n < 6 THEN 'ink' || (n - 3) WHEN n < 9 THEN 'rotation' || (n - 6) ELSE 'noise' || (n - 9) END AS name, 48::BIGINT AS pixels FROM manifest_w_lang, range(1, 13) r(n) WHERE len(line_bbox) = 4")
def _(s, d):
    m = table(s, d, "manifest_w_lang").where("size(line_bbox) = 4").select("ord")

    def run(batches):
        for pdf in batches:
            rows = [(n, name, int(a.size)) for n in pdf["ord"] for name, a in images.variants(_drawn(int(n)), int(n))]
            yield pd.DataFrame(rows, columns=["ord", "name", "pixels"])

    return m.mapInPandas(run, "ord long, name string, pixels long")
