"""Queries over the driver's tables, by problem, with their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linecorpus.llm import forms, grouping, language, mixing, overlap, packing, pieces, repair, terms
from linecorpus.plans.lineage import cut
from linecorpus.plans.tables import table


def spec(spark: SparkSession, d: str) -> dict[str, int]:
    return {r["spec"]: int(r["tokens"]) for r in table(spark, d, "size_specs").collect()}


def two_fields(spark: SparkSession, d: str) -> DataFrame:
    """``label`` of manifest_w_lang and ``initial_ocr`` of line_metadata as one table."""
    m = table(spark, d, "manifest_w_lang").select(F.lit("manifest_w_lang").alias("tbl"), F.col("ord").cast("string").alias("row_key"), "id", "ord", F.col("label").alias("text"))
    o = table(spark, d, "line_metadata").select(F.lit("line_metadata").alias("tbl"), F.col("id").alias("row_key"), "id", F.lit(0).cast("long").alias("ord"), F.col("initial_ocr").alias("text"))
    return m.unionByName(o)


def language_rows(spark: SparkSession, d: str) -> DataFrame:
    line = F.coalesce(F.when(F.col("label") != "", F.col("label")), F.col("initial_ocr")).alias("text")
    m = table(spark, d, "manifest_w_lang").select(F.lit("manifest_w_lang").alias("tbl"), F.col("ord").cast("string").alias("row_key"), line, F.col("predicted_lang").alias("recorded"))
    o = table(spark, d, "line_metadata").select(F.lit("line_metadata").alias("tbl"), F.col("id").alias("row_key"), line, F.col("predicted_lang").alias("recorded"))
    x = table(spark, d, "documents").select(F.lit("documents").alias("tbl"), F.col("doc_id").cast("string").alias("row_key"), "text", F.col("lang").alias("recorded"))
    return m.unionByName(o).unionByName(x)


def _judge(spark: SparkSession, d: str):
    return language.fitted(spark, table(spark, d, "lexicon"), table(spark, d, "lang_samples"))


def _reader(spark: SparkSession, d: str):
    readings = table(spark, d, "manifest_w_lang").select("ord", "label", "initial_ocr", "ftm_ocr")
    return repair.fitted(spark, table(spark, d, "lexicon"), table(spark, d, "documents"), two_fields(spark, d), "text", readings)


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    g = grouping.group_facts(table(spark, d, "manifest_w_lang"), table(spark, d, "rescans"))
    return g.where("train > 0 and test > 0").select("grp")


def p1_splits(spark: SparkSession, d: str) -> DataFrame:
    m = table(spark, d, "manifest_w_lang").select("ord", "id", "source_scan")
    shares = [(r["split"], float(r["share_pct"])) for r in table(spark, d, "split_targets").orderBy(F.desc("share_pct"), "split").collect()]
    facts = cut(grouping.pages(m, table(spark, d, "rescans"), split=None, keep="rescans").select("own", "n", "grp"))
    deal = grouping.dealt(facts.groupBy("grp").agg(F.sum("n").alias("n")), shares).select("grp", "split")
    return grouping.with_pages(m, facts.join(deal, "grp")).select("ord", "grp", "split")


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return language.wrong_labels(language_rows(spark, d), _judge(spark, d), "text", "recorded").select("tbl", "row_key")


def p2_languages(spark: SparkSession, d: str) -> DataFrame:
    got = language.languages(language_rows(spark, d), _judge(spark, d), "text")
    return got.select("tbl", "row_key", "language", F.round("confidence", 4).alias("confidence"), "segments")


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    pairs = overlap.cross_split_pairs(table(spark, d, "manifest_w_lang"))
    return pairs.select(F.least("test_ord", "train_ord").alias("ord_a"), F.greatest("test_ord", "train_ord").alias("ord_b"))


def p3_report(spark: SparkSession, d: str) -> DataFrame:
    m = table(spark, d, "manifest_w_lang")
    source = F.coalesce(grouping.page_name(F.col("source_scan"), F.lit(None).cast("string")), F.col("dataset"), F.lit("none"))
    return overlap.overlap_report(m.select("ord", "split", "label", source.alias("source")), "source")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return terms.marked_terms(table(spark, d, "manifest_w_lang"), "label").where(F.col("mark").isNotNull()).select("term", "mark")


def p4_terms(spark: SparkSession, d: str) -> DataFrame:
    return terms.marked_terms(table(spark, d, "manifest_w_lang"), "label")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return repair.faulty(two_fields(spark, d), _reader(spark, d), ["tbl", "row_key"], "text").select("tbl", "row_key")


def p5_paragraphs(spark: SparkSession, d: str) -> DataFrame:
    return repair.paragraphs(two_fields(spark, d), _reader(spark, d), "text", table(spark, d, "documents"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    f = forms.canonical_forms(two_fields(spark, d), ["tbl", "row_key"], "text")
    return f.where(F.col("text") != F.col("form")).select("tbl", "row_key")


def p6_forms(spark: SparkSession, d: str) -> DataFrame:
    return forms.canonical_forms(two_fields(spark, d), ["tbl", "row_key"], "text", known=table(spark, d, "lexicon")).select("tbl", "row_key", "form")


def p7_containers(spark: SparkSession, d: str) -> DataFrame:
    return packing.containers(table(spark, d, "documents"), "doc_id", "text", spec(spark, d)["container_capacity"])


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return mixing.stopped(table(spark, d, "documents"), table(spark, d, "mix_targets"))


def p8_mix(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mixed(table(spark, d, "documents"), table(spark, d, "mix_targets"))[0]


def p8_report(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mixed(table(spark, d, "documents"), table(spark, d, "mix_targets"))[1]


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    s = spec(spark, d)
    # a document has a second piece if and only if it is larger than the limit
    return pieces.pieces(table(spark, d, "documents"), ["doc_id"], "text", s["piece_limit"], s["piece_overlap"]).where("piece = 1").select("doc_id")


def p9_pieces(spark: SparkSession, d: str) -> DataFrame:
    s = spec(spark, d)
    return pieces.pieces(table(spark, d, "documents"), ["doc_id"], "text", s["piece_limit"], s["piece_overlap"])


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    named = (p1_found, p1_splits, p2_found, p2_languages, p3_found, p3_report, p4_found, p4_terms, p5_found, p5_paragraphs, p6_found, p6_forms, p7_containers, p8_found, p8_mix, p8_report, p9_found, p9_pieces)
    return {f.__name__: f for f in named}


_PAGES = """
    WITH RECURSIVE rows_ AS (
      SELECT split, id, lower(source_scan) AS s FROM manifest_w_lang
    ), own AS (
      SELECT split, CASE
        WHEN s IS NULL AND id LIKE 'cnt\\_%' ESCAPE '\\' THEN regexp_replace(id, '_line_.*$', '')
        ELSE regexp_replace(p, '^.*?(\\d{4})-?(\\d{2})-?(\\d{2})[/_\\\\]seq[-_ ]?0*(\\d+).*$', '\\1-\\2-\\3/seq-\\4.jp2') END AS grp
      FROM (SELECT *, CASE WHEN regexp_matches(s, '\\d{4}-?\\d{2}-?\\d{2}[/_\\\\]seq[-_ ]?\\d+') THEN s ELSE lower(id) END AS p FROM rows_)
    ), e AS (
      SELECT scan AS a, same_as AS b FROM rescans UNION SELECT same_as, scan FROM rescans
    ), reach AS (
      SELECT a, b FROM e UNION SELECT reach.a, e.b FROM reach JOIN e ON reach.b = e.a
    ), named AS (
      SELECT a AS page, least(a, min(b)) AS name FROM reach GROUP BY a
    )
"""

_TERMS = """
    WITH lines AS (
      SELECT ord, string_split_regex(upper(replace(replace(replace(replace(replace(replace(nfc_normalize(label), 'ﬃ', 'ffi'), 'ﬄ', 'ffl'), 'ﬁ', 'fi'), 'ﬂ', 'fl'), 'ﬀ', 'ff'), 'ß', 'ss')),
        '[\\s\\x0B\\x1C-\\x1F\\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]+') AS ws
      FROM manifest_w_lang WHERE label <> ''
    ), words AS (
      SELECT ord, unnest(ws) AS term FROM lines
    ), counted AS (
      SELECT term, count(*) AS occurrences, count(DISTINCT ord) AS records FROM words WHERE term <> '' GROUP BY term
    ), marked AS (
      SELECT term, occurrences, records, CASE WHEN records < 3 THEN 'rare' WHEN records > 0.01 * (SELECT count(*) FROM lines) THEN 'common' END AS mark FROM counted
    )
"""


def oracle_sql() -> dict[str, str]:
    return {
        "p1_found": _PAGES
        + "SELECT coalesce(name, grp) AS grp FROM own LEFT JOIN named ON own.grp = named.page WHERE split IN ('train', 'test') GROUP BY 1 HAVING count(DISTINCT split) = 2",
        "p4_found": _TERMS + "SELECT term, mark FROM marked WHERE mark IS NOT NULL",
        "p4_terms": _TERMS + "SELECT term, occurrences::BIGINT AS occurrences, records::BIGINT AS records, mark FROM marked",
        "p8_found": """
            WITH s AS (SELECT m.source, m.target_pct, m.max_repeats, coalesce((SELECT sum(strlen(text)) FROM documents d WHERE d.source = m.source), 0) AS size FROM mix_targets m)
            SELECT source FROM s WHERE size * max_repeats * 100 < target_pct * (SELECT sum(size) FROM s)""",
        "p9_found": "SELECT doc_id FROM documents WHERE strlen(text) > (SELECT tokens FROM size_specs WHERE spec = 'piece_limit')",
    }
