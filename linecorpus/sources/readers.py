"""Reading the corpus's files into typed DataFrames.

Functions named ``*_rows`` parse columns of text and work on any source; the
others read paths.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linecorpus.functions.text import WS, percent_after, url_parts
from linecorpus.sources import files

# Field names and types of the corpus's records.
MANIFEST = (
    "image_path STRING, source_scan STRING, column_index INT, line_index INT, line_bbox ARRAY<INT>, initial_ocr STRING, label STRING, status STRING, "
    "predicted_lang STRING, ftm_ocr STRING, ftm_confidence DOUBLE, dataset STRING, split STRING"
)
UPLOADS = "id STRING, original_filename STRING, uploaded_at TIMESTAMP"
LATTICE = T.ArrayType(T.ArrayType(T.ArrayType(T.StructType([T.StructField("ch", T.StringType()), T.StructField("conf", T.DoubleType())]))))
IMAGES = ("png", "jpg", "jpeg", "tif", "tiff", "jp2")


# JSON -------------------------------------------------------------------------


def keyed_rows(df: DataFrame, text: str, schema: str = MANIFEST) -> DataFrame:
    """``ord`` (place in the file), ``id`` and the fields of a column of ``{id: record}`` JSON texts.

    Absent keys become null.  A text that is no JSON gives no rows.
    """
    m = F.from_json(F.col(text), f"MAP<STRING, STRUCT<{', '.join(f'{x.split()[0]}: {x.split()[1]}' for x in schema.split(', '))}>>")
    return df.select(F.posexplode(m).alias("ord", "id", "r")).select(F.col("ord").cast("long").alias("ord"), "id", "r.*")


def json_map(spark: SparkSession, path: str, schema: str = MANIFEST) -> DataFrame:
    return keyed_rows(spark.read.text(path, wholetext=True), "value", schema)


def json_list(spark: SparkSession, path: str, schema: str = UPLOADS) -> DataFrame:
    """A list of records; a missing or broken file gives none."""
    if not files.exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("multiLine", True).option("mode", "DROPMALFORMED").json(path)


def first_present(spark: SparkSession, *paths: str) -> str:
    for p in paths:
        if files.exists(spark, p):
            return p
    raise FileNotFoundError(", ".join(paths))


def config_rows(df: DataFrame, text: str, fields: dict[str, tuple[str, object]]) -> DataFrame:
    """Configurations from JSON texts: ``fields`` maps a name to its type and default; unknown keys are dropped."""
    r = F.from_json(F.col(text), ", ".join(f"{k} {t}" for k, (t, _) in fields.items()))
    return df.select(r.alias("r")).select(*[(F.coalesce(F.col("r")[k], F.lit(d).cast(t)) if d is not None else F.col("r")[k]).alias(k) for k, (t, d) in fields.items()])


def sweep_rows(df: DataFrame, text: str, config: str) -> DataFrame:
    """One row per experiment of a sweep's JSON text: ``i`` (place), ``id``, ``config`` and ``eval_epochs``."""
    r = F.from_json(F.col(text), f"experiments ARRAY<STRUCT<id: STRING, config: STRUCT<{config}>, eval_epochs: ARRAY<INT>>>")
    return df.select(F.posexplode(r["experiments"]).alias("i", "e")).select("i", "e.*")


def exclusion_rows(df: DataFrame, text: str) -> DataFrame:
    """``(verse_key, original_word)`` from any of the four shapes of exclusion lists.

    Lists of records, lists of ``key:word``, records of lists and records of words.
    """
    t = F.col(text)
    records = F.transform(F.from_json(t, "ARRAY<STRUCT<verse_key: STRING, original_word: STRING>>"), lambda x: F.struct(x["verse_key"].alias("verse_key"), x["original_word"].alias("original_word")))
    pair = lambda x: F.struct(F.regexp_extract(x, r"^([^:]*):", 1).alias("verse_key"), F.regexp_replace(x, r"^[^:]*:", "").alias("original_word"))
    strings = F.transform(F.filter(F.from_json(t, "ARRAY<STRING>"), lambda x: x.contains(":") & ~x.startswith("{")), pair)
    lists = F.flatten(F.transform(F.map_entries(F.from_json(t, "MAP<STRING, ARRAY<STRING>>")), lambda e: F.transform(e["value"], lambda w: F.struct(e["key"].alias("verse_key"), w.alias("original_word")))))
    words = F.transform(F.filter(F.map_entries(F.from_json(t, "MAP<STRING, STRING>")), lambda e: ~F.ltrim(e["value"]).startswith("[")), lambda e: F.struct(e["key"].alias("verse_key"), e["value"].alias("original_word")))
    none = F.array().cast("array<struct<verse_key:string,original_word:string>>")
    kind = F.substring(F.ltrim(t), 1, 1)
    every = F.when(kind == "[", F.concat(F.coalesce(records, none), F.coalesce(strings, none))).otherwise(F.concat(F.coalesce(lists, none), F.coalesce(words, none)))
    return df.select(F.explode(every).alias("x")).select("x.*").where("verse_key is not null and original_word is not null").distinct()


# files ------------------------------------------------------------------------


def scans(spark: SparkSession, folder: str, recursive: bool = True, skip_overlays: bool = True) -> DataFrame:
    """``(path, modificationTime, length)`` of image files, sorted; contents are not read."""
    f = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower()).load(folder).select("path", "modificationTime", "length")
    f = f.where(F.lower("path").rlike(rf"\.({'|'.join(IMAGES)})$"))
    if skip_overlays:
        f = f.where(~F.col("path").rlike(r"/bbox_overlay_[^/]*$"))
    return f.orderBy("path")


def books(spark: SparkSession, folder: str, pattern: str = "book_*/segment_map.json") -> DataFrame:
    """Text of every book's file with ``book`` from its path; missing books are no error."""
    t = spark.read.text(f"{folder}/{pattern}", wholetext=True).select("value", F.col("_metadata.file_path").alias("path"))
    return t.select("value", F.regexp_extract("path", r"/(book_\d+)/", 1).alias("book"))


def ground_truth(spark: SparkSession, folder: str) -> DataFrame:
    """``(stem, truth)`` of all ``.gt.txt`` files, stripped."""
    t = spark.read.text(f"{folder}/*.gt.txt", wholetext=True).select("value", F.col("_metadata.file_name").alias("name"))
    strip = lambda c: F.regexp_replace(c, rf"^{WS}+|{WS}+$", "")
    return t.select(F.regexp_replace("name", r"\.gt\.txt$", "").alias("stem"), strip(F.col("value")).alias("truth"))


def with_truth(images: DataFrame, truths: DataFrame, inner: bool = False) -> DataFrame:
    """Images with their truth; without one it is empty, or with ``inner`` they are left out."""
    j = images.join(truths, "stem", "inner" if inner else "left")
    return j if inner else j.withColumn("truth", F.coalesce("truth", F.lit("")))


def matrix(spark: SparkSession, path: str) -> DataFrame:
    """``(truth, pred, n)`` of a dense CSV matrix without its last column."""
    m = spark.read.option("header", True).option("quote", '"').csv(path)
    cols = m.columns[1:-1]
    return m.select(F.col(f"`{m.columns[0]}`").alias("truth"), *[F.col(f"`{c}`").cast("long").alias(c) for c in cols]).unpivot(["truth"], cols, "pred", "n").where("n > 0")


def box_rows(df: DataFrame, text: str) -> DataFrame:
    """Line boxes (level 4 with an area) of tab-separated recognition output, whole texts with a header."""
    rows = df.select(F.explode(F.split(text, r"\r?\n")).alias("r")).where(~F.col("r").startswith("level\t") & (F.col("r") != ""))
    names = "level INT, page_num INT, block_num INT, par_num INT, line_num INT, word_num INT, left INT, top INT, width INT, height INT, conf DOUBLE, text STRING"
    p = rows.select(F.from_csv("r", names, {"sep": "\t", "quote": ""}).alias("p")).select("p.*")
    return p.where("level = 4 and width > 0 and height > 0").select("left", "top", (F.col("left") + F.col("width")).alias("right"), (F.col("top") + F.col("height")).alias("bottom"))


def seed_rows(df: DataFrame, text: str) -> DataFrame:
    """Distinct base URL, date and edition of seed lines; other lines are skipped."""
    return df.select(url_parts(F.col(text)).alias("u")).where("u is not null").select("u.*").dropDuplicates(["base_url"])


def log_rows(df: DataFrame, text: str) -> DataFrame:
    """Iterations and rates of a training log's progress lines."""
    it = r"At iteration (\d+)/(\d+)/(\d+)"
    num = lambda i: F.regexp_extract(text, it, i).try_cast("int")
    d = df.where(F.col(text).rlike(it))
    return d.select(
        num(1).alias("learning_iteration"), num(2).alias("training_iteration"), num(3).alias("sample_iteration"), percent_after(F.col(text), "BCER train").alias("bcer"), percent_after(F.col(text), "BWER train").alias("bwer"), percent_after(F.col(text), "skip ratio").alias("skip_ratio")
    )


def unencodable_rows(df: DataFrame, text: str) -> DataFrame:
    """Transcriptions that a log says cannot be encoded."""
    t = F.regexp_extract(text, r"Can't encode transcription: '(.*)'", 1)
    return df.select(t.alias("transcription")).where("transcription <> ''")


def eval_rows(df: DataFrame, text: str) -> DataFrame:
    """``BCER eval`` and ``BWER eval`` of evaluation output."""
    d = df.where(F.col(text).contains("BCER eval"))
    return d.select(percent_after(F.col(text), "BCER eval").alias("bcer"), percent_after(F.col(text), "BWER eval").alias("bwer"))


def report_rates(text: Column) -> Column:
    """Blocks of an evaluation report's whole text: an array of title, lines and both mean rates."""
    block = r"([^\n(]+?) \((\d+) lines(?: total)?\):\s+(?:Weighted )?Mean CER:\s+([0-9.]+)%\s+(?:Weighted )?Mean WER:\s+([0-9.]+)%"
    part = lambda i: F.regexp_extract_all(text, F.lit(block), F.lit(i))
    z = F.arrays_zip(part(1).alias("title"), part(2).alias("n"), part(3).alias("c"), part(4).alias("w"))
    return F.transform(z, lambda x: F.struct(F.trim(x["title"]).alias("title"), x["n"].try_cast("int").alias("lines"), x["c"].try_cast("double").alias("cer"), x["w"].try_cast("double").alias("wer")))


def vocabulary_rows(df: DataFrame, text: str, line_no: str) -> DataFrame:
    """Characters of a vocabulary's lines (numbered from 0): the sign after ``#``, else the first token; white space is added."""
    named = F.regexp_extract(text, r"#\s*(\S+)", 1)
    first = F.regexp_extract(F.trim(F.col(text)), r"^(\S+)", 1)
    kept = df.where((F.col(line_no) > 0) & (first != "") & ~first.isin("NULL", "Joined", "|Broken|0|1"))
    chars = kept.select(F.when(named != "", named).otherwise(first).alias("ch")).distinct()
    blanks = df.sparkSession.createDataFrame([(" ",), ("\t",), ("\n",), ("\r",)], "ch string")
    return chars.unionByName(blanks).distinct()


def completed_scans(manifest: DataFrame, listed: DataFrame | None = None) -> DataFrame:
    """Scans a list names as done, else all that the manifest has lines of."""
    if listed is not None:
        return listed.distinct()
    return manifest.where("source_scan is not null").select("source_scan").distinct()


# HTML -------------------------------------------------------------------------

#: elements that stand alone; all others are closed by their own end tags
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())


class _Tree(HTMLParser):
    """A small element tree: [tag, attributes, children], children being elements or strings."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root: list = ["", {}, []]
        self.open = [self.root]

    def handle_starttag(self, tag, attrs):
        el = [tag, dict(attrs), []]
        self.open[-1][2].append(el)
        if tag not in _VOID:
            self.open.append(el)

    def handle_endtag(self, tag):
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i][0] == tag:
                del self.open[i:]
                return

    def handle_data(self, data):
        self.open[-1][2].append(data)


def html_tree(text: str | None) -> list:
    t = _Tree()
    t.feed(text or "")
    t.close()
    return t.root


def elements(el: list, tag: str) -> Iterator[list]:
    for c in el[2]:
        if isinstance(c, list):
            if c[0] == tag:
                yield c
            yield from elements(c, tag)


def own_text(el: list) -> str:
    """The element's own strings, without its children's."""
    return "".join(c for c in el[2] if isinstance(c, str)).strip()


def all_text(el: list) -> str:
    return "".join(c if isinstance(c, str) else all_text(c) for c in el[2])


VERSE = T.ArrayType(T.StructType([T.StructField(c, T.StringType()) for c in ("image", "english", "cherokee", "phonetic")]))


@F.pandas_udf(VERSE)
def verse_tables(col: pd.Series) -> pd.Series:
    """Verses of scraped pages: bordered tables with an image and three texts in their heads."""

    def one(text):
        out = []
        for t in elements(html_tree(text), "table"):
            if "border" not in t[1]:
                continue
            heads = list(elements(t, "th"))
            image = next(elements(heads[0], "img"), None) if len(heads) >= 4 else None
            if image is not None and image[1].get("src"):
                out.append({"image": image[1]["src"], "english": own_text(heads[1]), "cherokee": own_text(heads[2]), "phonetic": own_text(heads[3])})
        return out

    return col.map(one)


@F.pandas_udf(LATTICE)
def lattices(col: pd.Series) -> pd.Series:
    """Words of hOCR texts as positions of alternatives, best first; a bad confidence is 0."""

    def has(el, cls, prefix=None):
        return cls in (el[1].get("class") or "").split() and (prefix is None or (el[1].get("id") or "").startswith(prefix))

    def option(el):
        try:
            conf = float((el[1].get("title") or "").split("x_confs")[1].strip())
        except (IndexError, ValueError):
            conf = 0.0
        return {"ch": all_text(el), "conf": conf}

    def one(text):
        words = []
        for w in (s for s in elements(html_tree(text), "span") if has(s, "ocrx_word")):
            places = [[option(o) for o in elements(p, "span") if has(o, "ocrx_cinfo", "choice_")] for p in elements(w, "span") if has(p, "ocrx_cinfo", "lstm_choices_")]
            if places := [sorted(p, key=lambda x: -x["conf"]) for p in places if p]:
                words.append(places)
        return words

    return col.map(one)


def chapter_links(html: Column, book: str) -> Column:
    """Links to a book's chapters, each once, in order."""
    return F.array_distinct(F.regexp_extract_all(html, F.lit(rf'href="({book}\d+\.html)"'), F.lit(1)))


def book_range(text: str) -> list[int]:
    """``01-03,7`` as numbers."""
    out: list[int] = []
    for part in text.split(","):
        a, _, b = part.strip().partition("-")
        out += range(int(a), int(b or a) + 1)
    return out


def read_json(path: str):
    with open(path, encoding="utf-8") as f:
        return json.load(f)
