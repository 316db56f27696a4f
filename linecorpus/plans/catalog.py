"""All core queries over the driver's tables, with the SQL that says the same.

A query is named after its operator's family and number: ``flt`` filters,
``join``, ``agg``, ``ord`` order-dependent, ``top``, ``set``, ``str`` strings,
``dist`` distances and alignments, ``split`` splits and samples, ``nest``,
``src`` sources, ``snk`` sinks, ``geo`` geometry, ``run`` sweeps.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from linecorpus.functions import metrics, sequences, text
from linecorpus.operators import manifest, search, splits, stats, sweep, verses
from linecorpus.plans import alignment_sql
from linecorpus.plans.tables import spread, table
from linecorpus.sources import readers, sinks

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql is not None:
            SQL[name] = sql
        return f

    return add


# SQL pieces -------------------------------------------------------------------

_WS = r"[\s\x0B\x1C-\x1F\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
_CHR, _CHRW = r"[\x{13A0}-\x{13FF}\x{AB70}-\x{ABBF}]", r"[\x{13A0}-\x{13FF}\x{AB70}-\x{ABFF}]"


def _norm(c: str) -> str:
    c = f"nfc_normalize({c})"
    for a, b in (("ﬃ", "FFI"), ("ﬄ", "FFL"), ("ﬁ", "FI"), ("ﬂ", "FL"), ("ﬀ", "FF"), ("ß", "SS")):
        c = f"replace({c}, '{a}', '{b}')"
    return f"coalesce(trim(regexp_replace(upper({c}), '{_WS}+', ' ', 'g')), '')"


def _count(c: str, cls: str) -> str:
    return f"coalesce(len(regexp_extract_all({c}, '{cls}')), 0)"


def _chars(c: str) -> str:
    return f"regexp_extract_all({c}, '(?s).')"


def _lev(a: str, b: str) -> str:
    """Edit distance of two lists: every distinct item becomes one byte, on which the engine's distance counts."""
    code = lambda x: f"coalesce(array_to_string(list_transform({x}, lambda z: chr((list_position(list_distinct(list_concat({a}, {b})), z) + 32)::INT)), ''), '')"
    return f"levenshtein({code(a)}, {code(b)})"


def _rate(dist: str, n: str, m: str) -> str:
    return f"CASE WHEN {n} = 0 THEN CASE WHEN {m} = 0 THEN 0.0 ELSE 100.0 END ELSE least(100.0, 100.0 * ({dist}) / {n}) END"


_TOK = lambda c: f"list_filter(string_split_regex({c}, '{_WS}+'), lambda z: z <> '')"

_EVAL_SQL = f"""
    WITH two AS (
      SELECT 'initial' AS algo, id, ord, label, initial_ocr AS ocr, ftm_confidence, dataset, split FROM manifest_w_lang WHERE label <> ''
      UNION ALL SELECT 'ftm', id, ord, label, ftm_ocr, ftm_confidence, dataset, split FROM manifest_w_lang WHERE label <> ''
    ), n AS (
      SELECT *, {_norm("label")} AS t, {_norm("ocr")} AS r FROM two
    ), l AS (
      SELECT *, {_chars("t")} AS tc, {_chars("r")} AS rc, {_TOK("t")} AS tw, {_TOK("r")} AS rw FROM n
    ), ev AS (
      SELECT algo, id, ord, ftm_confidence, dataset, split, label, ocr,
        CASE WHEN id LIKE 'cnt\\_%' ESCAPE '\\' THEN array_to_string(string_split(id, '_')[1:3], '_') ELSE regexp_extract(id, '^(\\d{{4}}-\\d{{2}}-\\d{{2}}_seq-\\d+)', 1) END AS doc_id,
        {_rate(_lev("tc", "rc"), "len(tc)", "len(rc)")} AS cer, {_rate(_lev("tw", "rw"), "len(tw)", "len(rw)")} AS wer, {_lev("tc", "rc")} AS dist
      FROM l
    )
"""


def evaluated(spark: SparkSession, d: str) -> DataFrame:
    """Every labelled line against both of its readings, with its rates."""
    m = table(spark, d, "manifest_w_lang").where("label <> ''").select("id", "ord", "label", "initial_ocr", "ftm_ocr", "ftm_confidence", "dataset", "split")
    # the truth's normal form is made once for both readings
    m = m.select("*", text.normalize_truth(F.col("label")).alias("t"), text.normalize_truth(F.col("initial_ocr")).alias("a"), text.normalize_truth(F.col("ftm_ocr")).alias("b"))
    both = F.explode(F.array(F.struct(F.lit("initial").alias("algo"), F.col("initial_ocr").alias("ocr"), F.col("a").alias("r")), F.struct(F.lit("ftm").alias("algo"), F.col("ftm_ocr").alias("ocr"), F.col("b").alias("r"))))
    e = m.select("id", "ord", "label", "ftm_confidence", "dataset", "split", "t", both.alias("x")).select("*", "x.*").drop("x")
    e = e.withColumn("dist", F.levenshtein("t", "r"))
    e = e.withColumn("cer", metrics.capped_rate(F.col("dist"), F.length("t"), F.length("r"))).withColumn("wer", metrics.wer(F.col("t"), F.col("r")))
    return e.withColumn("doc_id", text.document_of(F.col("id"))).withColumn("line_id", text.line_of(F.col("id")))


def flagship(spark: SparkSession, d: str) -> DataFrame:
    e = evaluated(spark, d).where("algo = 'initial'")
    return stats.error_summary(e, ["doc_id"]).select("doc_id", F.round("mean", 6).alias("mean"), F.round("median", 6).alias("median"), "n")


# filters ------------------------------------------------------------------------


@query("flt01_labeled_target", "SELECT ord FROM manifest_w_lang WHERE status = 'labeled' AND predicted_lang = 'Cherokee'")
def _(s, d):
    return table(s, d, "manifest_w_lang").where(manifest.is_labeled_target()).select("ord")


@query("flt02_searchable", "SELECT ord FROM manifest_w_lang WHERE predicted_lang = 'Cherokee' OR label <> ''")
def _(s, d):
    return table(s, d, "manifest_w_lang").where(manifest.is_searchable()).select("ord")


@query("flt03_candidate_cases", "SELECT ord FROM manifest_w_lang WHERE (status = 'labeled' OR label <> '') AND predicted_lang = 'Cherokee'")
def _(s, d):
    return table(s, d, "manifest_w_lang").where(manifest.is_candidate_case()).select("ord")


@query("flt04_error_purge", "SELECT ord FROM manifest_w_lang WHERE ftm_ocr IS DISTINCT FROM 'Error' AND predicted_lang IS DISTINCT FROM 'Error'")
def _(s, d):
    return table(s, d, "manifest_w_lang").where(~manifest.is_error()).select("ord")


_OUTCOME = """SELECT CASE WHEN coalesce(status, '') <> 'unlabeled' THEN 'keep_labeled' WHEN length(coalesce(initial_ocr, '')) <= 10 THEN 'skip_short_initial'
    WHEN NOT have THEN 'missing_file' WHEN ftm_ocr IS NOT DISTINCT FROM 'Error' THEN 'error_reading_image'
    WHEN lang IN ('English', 'Empty') THEN 'skip_' || lower(lang) ELSE 'keep_matched_' || lower(lang) END AS outcome
    FROM (SELECT *, coalesce(predicted_lang, 'Mixed') AS lang, id IN (SELECT id FROM line_metadata) AS have FROM manifest_w_lang)"""


@query("flt05_outcome_cascade", f"SELECT outcome, count(*) AS n FROM ({_OUTCOME}) GROUP BY outcome")
def _(s, d):
    have = table(s, d, "line_metadata").select("id", F.lit(True).alias("have"))
    m = table(s, d, "manifest_w_lang").select("id", "status", "initial_ocr", "ftm_ocr", "predicted_lang").join(have, "id", "left")
    o = manifest.outcome(F.coalesce("have", F.lit(False)), ~F.col("ftm_ocr").eqNullSafe("Error"), F.coalesce("predicted_lang", F.lit("Mixed")))
    return m.select(o.alias("outcome")).groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


@query("flt07_ignored", "SELECT ord FROM manifest_w_lang WHERE status IN ('not_cherokee', 'bad_crop') OR label IN ('not_cherokee', 'bad_crop')")
def _(s, d):
    return table(s, d, "manifest_w_lang").where(manifest.is_ignored()).select("ord")


@query("flt08_not_dataset", "SELECT count(*) AS n FROM manifest_w_lang WHERE dataset IS DISTINCT FROM 'cnt'")
def _(s, d):
    return table(s, d, "manifest_w_lang").where(manifest.not_dataset("cnt")).agg(F.count(F.lit(1)).alias("n"))


@query("flt09_script_chars", f"SELECT ord FROM manifest_w_lang WHERE {_count('initial_ocr', _CHR)} >= 5")
def _(s, d):
    return table(s, d, "manifest_w_lang").where(manifest.has_script_chars(F.col("initial_ocr"))).select("ord")


_CLS = lambda c: (
    f"CASE WHEN {_count(c, _CHR)} + {_count(c, '[A-Za-z]')} = 0 THEN 'Empty' WHEN {_count(c, _CHR)} / ({_count(c, _CHR)} + {_count(c, '[A-Za-z]')}) < 0.40 THEN 'English'"
    f" WHEN {_count(c, _CHR)} / ({_count(c, _CHR)} + {_count(c, '[A-Za-z]')}) > 0.45 THEN 'Cherokee' ELSE 'Mixed' END"
)


@query("flt10_column_gate", f"SELECT doc_id FROM documents WHERE {_CLS('text')} IN ('Cherokee', 'Mixed')")
def _(s, d):
    return table(s, d, "documents").where(text.script_class(F.col("text")).isin("Cherokee", "Mixed")).select("doc_id")


@query("flt11_nonblank_lines", f"SELECT ord FROM manifest_w_lang WHERE regexp_replace(ftm_ocr, '{_WS}+', '', 'g') <> ''")
def _(s, d):
    return table(s, d, "manifest_w_lang").where(F.regexp_replace("ftm_ocr", text.WS + "+", "") != "").select("ord")


_VOCAB_SQL = "(SELECT list(DISTINCT c) FROM (SELECT unnest(regexp_extract_all(upper(term) || lower(term), '(?s).')) AS c FROM lexicon) )"


@query(
    "flt12_encodable",
    f"""WITH v AS (SELECT {_VOCAB_SQL} AS v), b AS (SELECT ord, label, list_sort(list_filter(list_distinct({_chars("coalesce(label, '')")}), lambda z: NOT list_contains(v, z) AND z NOT IN (' ', '.', ','))) AS bad FROM manifest_w_lang, v)
    SELECT CASE WHEN coalesce(label, '') = '' THEN 'no_gt' WHEN len(bad) > 0 THEN 'encoding_error' ELSE 'ok' END AS status, count(*) AS n FROM b GROUP BY 1""",
)
def _(s, d):
    # a lexicon's alphabet is bounded by its scripts
    v = table(s, d, "lexicon").select(F.explode(F.split(F.concat(F.upper("term"), F.lower("term")), "")).alias("c")).agg(F.array_distinct(F.concat(F.collect_set("c"), F.array(F.lit(" "), F.lit("."), F.lit(",")))).alias("v"))
    m = table(s, d, "manifest_w_lang").select("label").withColumn("v", v.scalar())
    return m.select(metrics.line_status(F.col("label"), F.col("v")).alias("status")).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


@query(
    "flt13_presence",
    "SELECT CASE WHEN a AND b THEN 'both' WHEN a THEN 'initial_only' WHEN b THEN 'ftm_only' ELSE 'neither' END AS presence, count(*) AS n FROM (SELECT coalesce(trim(initial_ocr), '') <> '' AS a, coalesce(trim(ftm_ocr), '') <> '' AS b FROM manifest_w_lang) GROUP BY 1",
)
def _(s, d):
    m = table(s, d, "manifest_w_lang")
    return m.select(metrics.presence(F.col("initial_ocr"), F.col("ftm_ocr")).alias("presence")).groupBy("presence").agg(F.count(F.lit(1)).alias("n"))


@query(
    "flt14_triage",
    _EVAL_SQL
    + "SELECT CASE WHEN ftm_confidence >= 80 AND dist > 0 THEN 'confidently_disagrees' WHEN ftm_confidence < 70 THEN 'low_confidence' WHEN dist = 0 THEN 'high_confidence_correct' ELSE 'low_error_other' END AS category, count(*) AS n FROM ev WHERE algo = 'ftm' AND ocr IS NOT NULL GROUP BY 1",
)
def _(s, d):
    e = evaluated(s, d).where("algo = 'ftm' and ocr is not null")
    return e.select(metrics.triage(F.col("ftm_confidence"), F.col("dist")).alias("category")).groupBy("category").agg(F.count(F.lit(1)).alias("n"))


@query("flt15_viewer_search", "SELECT ord FROM manifest_w_lang WHERE contains(lower(coalesce(label, '')), 'the') OR contains(lower(coalesce(ftm_ocr, '')), 'the') OR contains(id, 'the')")
def _(s, d):
    m = table(s, d, "manifest_w_lang").select("ord", F.col("label").alias("truth"), F.col("ftm_ocr").alias("ocr"), F.col("id").alias("verse_key"))
    return search.matching(m, "the").select("ord")


@query("flt16_pending", "SELECT DISTINCT id FROM line_metadata WHERE id NOT IN (SELECT id FROM manifest_w_lang WHERE ftm_ocr IS NOT NULL AND ftm_ocr <> 'Error')")
def _(s, d):
    done = table(s, d, "manifest_w_lang").where("ftm_ocr is not null and ftm_ocr <> 'Error'")
    return manifest.pending(table(s, d, "line_metadata"), done, "id").select("id").distinct()


@query("flt17_first_open", "SELECT ord FROM manifest_w_lang WHERE ord >= (SELECT min(ord) FROM manifest_w_lang WHERE dataset IS DISTINCT FROM 'cnt')")
def _(s, d):
    return manifest.from_first_open(table(s, d, "manifest_w_lang").select("ord", "dataset"), "ord", F.col("dataset").eqNullSafe("cnt")).select("ord")


@query("flt18_upload_names", "SELECT id, original_filename FROM uploads WHERE regexp_matches(lower(original_filename), '\\.(png|jpg|jpeg|tif|tiff|jp2)$')")
def _(s, d):
    return table(s, d, "uploads").where(F.lower("original_filename").rlike(rf"\.({'|'.join(readers.IMAGES)})$")).select("id", "original_filename")


@query("flt21_routed", "SELECT CASE WHEN split IS NULL THEN 'open' WHEN split IN ('train', 'test') THEN split ELSE 'train' END AS split, count(*) AS n FROM manifest_w_lang GROUP BY 1")
def _(s, d):
    return manifest.routed(table(s, d, "manifest_w_lang").select("ord", "split"), F.lit("open")).groupBy("split").agg(F.count(F.lit(1)).alias("n"))


# joins --------------------------------------------------------------------------


@query(
    "join01_phrase_search",
    r"""SELECT DISTINCT m.id, m.label FROM line_metadata m JOIN fts_candidates f USING (id)
    WHERE contains(' ' || array_to_string(list_filter(string_split_regex(lower(f.candidates), '[^\p{L}\p{N}\p{M}]+'), lambda z: z <> ''), ' ') || ' ', ' of the ')""",
)
def _(s, d):
    i = search.token_index(table(s, d, "fts_candidates"))
    return search.search(i, table(s, d, "line_metadata"), 'of "the"').select("id", "label")


@query("join02_lookup_default", "SELECT m.ord, coalesce(l.initial_ocr, '') AS found FROM manifest_w_lang m LEFT JOIN line_metadata l USING (id)")
def _(s, d):
    lookup = table(s, d, "line_metadata").select("id", F.col("initial_ocr").alias("found"))
    return manifest.with_default(table(s, d, "manifest_w_lang").select("ord", "id"), lookup, "id", {"found": ""}).select("ord", "found")


@query("join04_present_crops", "SELECT ord FROM manifest_w_lang WHERE image_path IN (SELECT image_path FROM line_metadata)")
def _(s, d):
    return table(s, d, "manifest_w_lang").join(table(s, d, "line_metadata").select("image_path"), "image_path", "left_semi").select("ord")


@query(
    "join05_missing_crops",
    "SELECT source_scan, count(*) AS n FROM manifest_w_lang WHERE NOT coalesce(status IN ('not_cherokee', 'bad_crop'), false) AND NOT coalesce(label IN ('not_cherokee', 'bad_crop'), false) AND image_path NOT IN (SELECT image_path FROM line_metadata WHERE image_path IS NOT NULL) GROUP BY source_scan",
)
def _(s, d):
    return manifest.missing_crops(table(s, d, "manifest_w_lang"), table(s, d, "line_metadata")).groupBy("source_scan").agg(F.count(F.lit(1)).alias("n"))


@query("join06_transfer_labels")
def _(s, d):
    m = table(s, d, "manifest_w_lang").where("dataset is null")
    new = manifest.latest(m.select("id", "ord", "source_scan", "initial_ocr"), "id", "ord").select("id", "ord", "source_scan", F.lit("unlabeled").alias("status"), F.lit(None).cast("string").alias("label"), "initial_ocr")
    return manifest.transfer_labels(m, new)


_FILES = [(0, "chr_9.7_1000_2000.checkpoint"), (1, "chr_8.1_1500_2600.checkpoint"), (2, "chr_7.9_1800_3400.checkpoint"), (3, "chr_checkpoint"), (4, "chr_7.7_1900_3400.checkpoint")]


@query("join08_nearest_checkpoint", "SELECT 'chr_8.1_1500_2600.checkpoint' AS path, 2600::INT AS iteration")
def _(s, d):
    return sweep.nearest_checkpoint(s.createDataFrame(_FILES, "ord long, path string"), 3000)


_FEATURES_SQL = f"""SELECT ord, coalesce(ftm_confidence, 0) AS ftm_conf, 40 + ord % 60 AS chr_conf, ord % 55 AS eng_conf, predicted_lang AS true_label,
    CASE WHEN {_count('label', _CHR)} + {_count('label', '[A-Za-z]')} > 0 THEN {_count('label', _CHR)} / ({_count('label', _CHR)} + {_count('label', '[A-Za-z]')}) ELSE 0 END AS pct_cherokee
    FROM manifest_w_lang WHERE label <> '' AND predicted_lang IS NOT NULL"""


def features(s: SparkSession, d: str) -> DataFrame:
    m = table(s, d, "manifest_w_lang").where("label <> '' and predicted_lang is not null")
    return m.select("ord", F.coalesce("ftm_confidence", F.lit(0.0)).alias("ftm_conf"), (40 + F.col("ord") % 60).alias("chr_conf"), (F.col("ord") % 55).alias("eng_conf"), F.col("predicted_lang").alias("true_label"), F.coalesce(text.script_share(F.col("label")), F.lit(0.0)).alias("pct_cherokee"))


_GRID = {"t": [0.3, 0.4, 0.5, 0.6], "a": [40.0, 60.0], "b": [50.0], "c": [30.0, 60.0]}


@query(
    "join09_rule_grid",
    f"""WITH f AS ({_FEATURES_SQL}), p AS (SELECT t, a, b, c FROM (VALUES (0.3), (0.4), (0.5), (0.6)) x(t), (VALUES (40), (60)) y(a), (VALUES (50)) z(b), (VALUES (30), (60)) w(c))
    SELECT t::DOUBLE AS t, a::DOUBLE AS a, c::DOUBLE AS c, round(avg(((pct_cherokee >= t OR (pct_cherokee >= 0.15 AND ftm_conf >= a AND chr_conf >= b AND eng_conf < c)) = (true_label = 'Cherokee'))::INT), 6) AS accuracy FROM f, p GROUP BY t, a, c""",
)
def _(s, d):
    return sweep.rule_grid(features(s, d), sweep.grid(s, **_GRID)).select("t", "a", "c", F.round("accuracy", 6).alias("accuracy"))


def _words_of(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Tokens of a verse's lines in two readings, and the words of its truth."""
    v = table(s, d, "verses").where("cherokee is not null").groupBy("verse_key").agg(F.min("cherokee").alias("truth"))
    words = v.select("verse_key", F.explode(text.tokens(F.col("truth"))).alias("word"))
    m = manifest.latest(table(s, d, "manifest_w_lang").where("dataset = 'cnt'").select("id", "ord", "label", "ftm_ocr"), "id", "ord")
    m = m.select(F.regexp_extract("id", r"^cnt_\d+_(\d+)_", 1).alias("verse_key"), F.regexp_extract("id", r"_line_(\d+)$", 1).try_cast("int").alias("line_no"), "label", "ftm_ocr")
    r = m.select("verse_key", "line_no", F.explode(F.array(F.struct(F.lit("stock").alias("model"), F.coalesce("label", F.lit("")).alias("t")), F.struct(F.lit("ftm").alias("model"), F.coalesce("ftm_ocr", "label", F.lit("")).alias("t")))).alias("x")).select("verse_key", "line_no", "x.*")
    tok = r.select("verse_key", "model", "line_no", text.ends_hyphenated(F.col("t")).alias("hyphenated"), F.posexplode(text.tokens(F.col("t"))).alias("p", "tok"))
    return tok.select("verse_key", "model", "line_no", "hyphenated", (F.col("line_no") * 1000 + F.col("p")).alias("pos"), text.clean_word(F.col("tok")).alias("token")).where("token <> ''"), words


@query("join11_missing_spaces")
def _(s, d):
    return verses.missing_spaces(*_words_of(s, d))


@query("join13_apply_splits")
def _(s, d):
    lines = manifest.latest(table(s, d, "manifest_w_lang").where("dataset = 'cnt' and label <> ''").select("id", "ord", "label"), "id", "ord").withColumn("verse_key", F.regexp_extract("id", r"^cnt_\d+_(\d+)_", 1))
    return verses.apply_splits(lines, verses.missing_spaces(*_words_of(s, d)), "label").select("id", "label", "changed")


@query("join14_algorithm_matrix", _EVAL_SQL + "SELECT ord AS base_name, round(avg(cer) FILTER (algo = 'initial' AND ocr IS NOT NULL), 6) AS initial, round(avg(cer) FILTER (algo = 'ftm' AND ocr IS NOT NULL), 6) AS ftm, round(avg(cer) FILTER (ocr IS NOT NULL), 6) AS mean FROM ev GROUP BY ord")
def _(s, d):
    e = evaluated(s, d).select(F.col("ord").alias("base_name"), "algo", F.when(F.col("ocr").isNotNull(), F.col("cer")).alias("cer"))
    p = stats.algorithm_matrix(e, ["initial", "ftm"])
    return p.select("base_name", *[F.round(c, 6).alias(c) for c in ("initial", "ftm", "mean")])


# aggregations -------------------------------------------------------------------


@query("agg01_split_means", _EVAL_SQL + "SELECT algo, split, round(avg(cer), 6) AS mean_cer, round(avg(wer), 6) AS mean_wer, count(*) AS n FROM ev GROUP BY algo, split")
def _(s, d):
    e = evaluated(s, d).withColumn("k", F.struct("algo", "split"))
    return stats.split_means(e, "k").select("k.algo", "k.split", F.round("mean_cer", 6).alias("mean_cer"), F.round("mean_wer", 6).alias("mean_wer"), "n")


@query("agg02_weighted_mean", _EVAL_SQL + ", g AS (SELECT dataset, avg(cer) AS m, count(*) AS n FROM ev WHERE algo = 'initial' GROUP BY dataset) SELECT round(sum(m * n) / sum(n), 6) AS mean, sum(n)::BIGINT AS n FROM g")
def _(s, d):
    g = stats.error_summary(evaluated(s, d).where("algo = 'initial'"), ["dataset"])
    return stats.weighted_mean(g, "mean", "n").select(F.round("mean", 6).alias("mean"), "n")


@query("agg04_by_document", _EVAL_SQL + "SELECT doc_id, round(avg(cer), 6) AS mean, round(median(cer), 6) AS median, count(*) AS n FROM ev WHERE algo = 'initial' GROUP BY doc_id")
def _(s, d):
    return flagship(s, d)


@query(
    "agg05_by_algorithm",
    _EVAL_SQL
    + "SELECT algo, round(avg(cer) FILTER (ocr IS NOT NULL), 6) AS mean, round(median(cer) FILTER (ocr IS NOT NULL), 6) AS median, count(*) FILTER (ocr IS NOT NULL) AS ok, count(*) FILTER (ocr IS NULL) AS err, count(*) AS total FROM ev GROUP BY algo",
)
def _(s, d):
    e = evaluated(s, d).withColumn("status", F.when(F.col("ocr").isNull(), "encoding_error").otherwise("ok"))
    return stats.algorithm_summary(e).select("algo", F.round("mean", 6).alias("mean"), F.round("median", 6).alias("median"), "ok", "err", "total")


@query("agg06_macro_mean", _EVAL_SQL + "SELECT round(avg(m), 6) AS cer, count(*) AS groups FROM (SELECT doc_id, avg(cer) AS m FROM ev GROUP BY doc_id)")
def _(s, d):
    return stats.macro_of(evaluated(s, d), "doc_id", "cer").select(F.round("cer", 6).alias("cer"), "groups")


@query(
    "agg07_mean_confidence",
    "SELECT ord, CASE WHEN len(list_filter(c, lambda x: x <> -1)) > 0 THEN round(list_avg(list_filter(c, lambda x: x <> -1)), 5) ELSE 0.0 END AS conf FROM (SELECT ord, [coalesce(ftm_confidence, -1.0), (ord % 4 - 1)::DOUBLE] AS c FROM manifest_w_lang)",
)
def _(s, d):
    c = F.array(F.coalesce("ftm_confidence", F.lit(-1.0)), (F.col("ord") % 4 - 1).cast("double"))
    return table(s, d, "manifest_w_lang").select("ord", metrics.mean_confidence(c, 5).alias("conf"))


def confusions(s: SparkSession, d: str) -> DataFrame:
    e = evaluated(s, d).where("algo = 'ftm' and ocr is not null and ocr <> 'Error'")
    return stats.events_counted(spread(e.select("t", "r")).select(sequences.alignment(F.col("t"), F.col("r")).alias("events")))


_LINES = f"SELECT {_norm('label')} AS t, {_norm('ftm_ocr')} AS r FROM manifest_w_lang WHERE label <> '' AND ftm_ocr IS NOT NULL AND ftm_ocr <> 'Error'"
#: distinct pairs are aligned once each and counted as often as they occur
_EVENTS = alignment_sql.edits(f"SELECT t || chr(0) || r AS k, {_chars('t')} AS a, {_chars('r')} AS b FROM (SELECT DISTINCT * FROM ({_LINES}))") + f""",
    often AS (SELECT t || chr(0) || r AS k, count(*) AS times FROM ({_LINES}) GROUP BY 1),
    counts AS MATERIALIZED (SELECT t, p, op, sum(times)::BIGINT AS n FROM events JOIN often USING (k) GROUP BY t, p, op) """


@query("agg08_confusion_counts", _EVENTS + "SELECT * FROM counts")
def _(s, d):
    return confusions(s, d)


def _share(op: str) -> str:
    return f"(sum(n) FILTER (op = '{op}'))"


@query("agg09_confusion_rates", _EVENTS + "SELECT sum(n) FILTER (op <> 'insertion')::BIGINT AS truth, " + ", ".join(f"coalesce({_share(o)}, 0)::BIGINT AS {o}, round(100.0 * coalesce({_share(o)}, 0) / sum(n) FILTER (op <> 'insertion'), 2) AS {o}_pct" for o in ("match", "substitution", "deletion", "insertion")) + " FROM counts")
def _(s, d):
    return stats.confusion_rates(confusions(s, d))


@query("agg10_deletion_rates", _EVENTS + "SELECT t AS ch, (sum(n) FILTER (op = 'deletion'))::BIGINT AS deleted, sum(n)::BIGINT AS total, round(100.0 * sum(n) FILTER (op = 'deletion') / sum(n), 2) AS rate FROM counts WHERE op <> 'insertion' GROUP BY t HAVING sum(n) FILTER (op = 'deletion') > 0 ORDER BY rate DESC, ch LIMIT 15")
def _(s, d):
    return stats.deletion_rates(confusions(s, d))


@query("agg11_character_frequency", f"SELECT ch, count(*) AS n, min(ord) AS first_ord FROM (SELECT ord, unnest(regexp_extract_all({_norm('label')}, '{_CHRW}')) AS ch FROM manifest_w_lang WHERE status = 'labeled') GROUP BY ch")
def _(s, d):
    m = table(s, d, "manifest_w_lang").where("status = 'labeled'")
    return stats.character_counts(m, text.normalize_truth(F.col("label")), text.CHEROKEE_WIDE)


@query("agg12_histogram", _EVAL_SQL + "SELECT least(25, 1 + floor(cer / 4))::INT AS bin, count(*) AS n FROM ev WHERE algo = 'initial' GROUP BY 1")
def _(s, d):
    return stats.histogram(evaluated(s, d).where("algo = 'initial'"), "cer")


@query("agg13_status_counts", "SELECT count(*) FILTER (status = 'unlabeled') AS unlabeled, count(*) FILTER (status = 'labeled') AS labeled, count(*) FILTER (status = 'not_cherokee') AS not_cherokee, count(*) FILTER (status = 'nasty_crop') AS nasty_crop, count(*) AS total FROM manifest_w_lang")
def _(s, d):
    return stats.status_counts(table(s, d, "manifest_w_lang"))


@query("agg15_language_confusion", f"SELECT predicted_lang, count(*) FILTER (c = 'Cherokee') AS Cherokee, count(*) FILTER (c = 'English') AS English, count(*) FILTER (c = 'Mixed') AS Mixed, count(*) FILTER (c = 'Empty') AS Empty FROM (SELECT predicted_lang, {_CLS('label')} AS c FROM manifest_w_lang) GROUP BY predicted_lang")
def _(s, d):
    m = table(s, d, "manifest_w_lang").select("predicted_lang", text.script_class(F.col("label")).alias("c"))
    return stats.class_confusion(m, "predicted_lang", "c", ["Cherokee", "English", "Mixed", "Empty"])


@query(
    "agg17_group_boxes",
    "SELECT source_scan, column_index, min(line_bbox[1]) AS xmin, min(line_bbox[2]) AS ymin, max(line_bbox[3]) AS xmax, max(line_bbox[4]) AS ymax FROM manifest_w_lang WHERE len(line_bbox) = 4 GROUP BY source_scan, column_index HAVING count(*) >= 3 OR max(line_bbox[4]) - min(line_bbox[2]) >= 200",
)
def _(s, d):
    c = lambda i: F.element_at("line_bbox", i)
    g = table(s, d, "manifest_w_lang").where("size(line_bbox) = 4").groupBy("source_scan", "column_index").agg(F.min(c(1)).alias("xmin"), F.min(c(2)).alias("ymin"), F.max(c(3)).alias("xmax"), F.max(c(4)).alias("ymax"), F.count(F.lit(1)).alias("n"))
    return g.where("n >= 3 or ymax - ymin >= 200").drop("n")


@query("agg19_lines_by_scan", "SELECT source_scan, count(*) AS n, min(ord) AS first_ord FROM manifest_w_lang WHERE source_scan IS NOT NULL GROUP BY source_scan")
def _(s, d):
    return table(s, d, "manifest_w_lang").where("source_scan is not null").groupBy("source_scan").agg(F.count(F.lit(1)).alias("n"), F.min("ord").alias("first_ord"))


_STRIP = "trim({0}, '" + text.SIGNS.replace("'", "''") + "')"


@query(
    "agg20_top_k_recall",
    f"""WITH c AS (SELECT {_TOK('label')} AS ts, {_TOK('candidates')} AS cs FROM (SELECT DISTINCT * FROM fts_candidates) JOIN (SELECT id, label FROM line_metadata WHERE label <> '') USING (id)),
    w AS (SELECT unnest(ts) AS truth, cs AS pool FROM c)
    SELECT count(*) AS words, """
    + ", ".join(f"sum((list_contains(list_transform(pool[1:{k}], lambda z: {_STRIP.format('z')}), {_STRIP.format('truth')}))::INT)::BIGINT AS top{k}, round(100.0 * sum((list_contains(list_transform(pool[1:{k}], lambda z: {_STRIP.format('z')}), {_STRIP.format('truth')}))::INT) / count(*), 2) AS pct{k}" for k in (1, 2, 5))
    + " FROM w",
)
def _(s, d):
    """Each truth word among its line's candidates in their order, so that k matters."""
    c = table(s, d, "fts_candidates").distinct().join(table(s, d, "line_metadata").select("id", "label"), "id").where("label <> ''")
    pairs = F.transform(text.tokens(F.col("label")), lambda t: F.struct(t.alias("truth"), text.tokens(F.col("candidates")).alias("cands")))
    return search.recall_at(c.select(F.explode(pairs).alias("p")).select("p.*"))


@query("agg21_mixture", "SELECT count(*) FILTER (dataset IS DISTINCT FROM 'cnt') AS main, count(*) FILTER (dataset = 'cnt') AS other, round(count(*) FILTER (dataset IS DISTINCT FROM 'cnt') / count(*), 6) AS ratio FROM manifest_w_lang WHERE split = 'train'")
def _(s, d):
    return stats.mixture(table(s, d, "manifest_w_lang")).withColumn("ratio", F.round("ratio", 6))


@query("agg22_dashboard", _EVAL_SQL + "SELECT round(avg(ftm_confidence), 1) AS conf, round(avg(cer), 1) AS cer FROM ev WHERE algo = 'ftm' AND ocr IS NOT NULL")
def _(s, d):
    return evaluated(s, d).where("algo = 'ftm' and ocr is not null").agg(F.round(F.avg("ftm_confidence"), 1).alias("conf"), F.round(F.avg("cer"), 1).alias("cer"))


@query("agg24_invalid_chars", f"SELECT ord, array_to_string(list_sort(list_distinct(regexp_extract_all(label, '[^\\x{{13A0}}-\\x{{13F5}}A-Za-z0-9 .,;:!?-]'))), '') AS bad FROM manifest_w_lang WHERE len(regexp_extract_all(label, '[^\\x{{13A0}}-\\x{{13F5}}A-Za-z0-9 .,;:!?-]')) > 0")
def _(s, d):
    allowed = [chr(c) for c in range(0x13A0, 0x13F6)] + list("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789 .,;:!?-")
    bad = metrics.invalid_chars(F.col("label"), F.array(*map(F.lit, allowed)))
    return table(s, d, "manifest_w_lang").select("ord", F.array_join(bad, "").alias("bad")).where("bad <> ''")


# order and rank -----------------------------------------------------------------


@query("ord01_line_in_verse", "SELECT book, verse_key, n - 1 AS line_no, crops[n] AS line_crop FROM (SELECT book, verse_key, line_crops AS crops, unnest(range(1, len(line_crops) + 1)) AS n FROM verses)")
def _(s, d):
    return verses.flattened(table(s, d, "verses")).withColumn("line_no", F.col("line_no").cast("long"))


@query("ord02_ranked_documents", _EVAL_SQL + ", g AS (SELECT doc_id, round(avg(cer), 6) AS mean FROM ev WHERE algo = 'initial' GROUP BY doc_id) SELECT doc_id, mean, row_number() OVER (ORDER BY mean, doc_id) AS rank FROM g")
def _(s, d):
    return stats.ranked(flagship(s, d).select("doc_id", "mean"), "mean", "doc_id")


@query("ord03_next_token", f"SELECT ord, p, w[p] AS token, w[p + 1] AS next FROM (SELECT ord, w, unnest(range(1, len(w) + 1)) AS p FROM (SELECT ord, {_TOK('label')} AS w FROM manifest_w_lang WHERE label <> ''))")
def _(s, d):
    t = table(s, d, "manifest_w_lang").where("label <> ''").select("ord", F.posexplode(text.tokens(F.col("label"))).alias("p", "token"))
    w = Window.partitionBy("ord").orderBy("p")
    return t.select("ord", (F.col("p") + 1).cast("long").alias("p"), "token", F.lead("token").over(w).alias("next"))


@query("ord07_rate_schedule", "SELECT e::INT AS epoch, 0.002 * pow(0.5, floor((e - 1) / 4)) AS learning_rate, (e * 200)::BIGINT AS max_iterations FROM range(1, 37) t(e)")
def _(s, d):
    return sweep.schedule(s, 36, 0.002, 0.5, 4, "step", 200).select("epoch", "learning_rate", F.col("max_iterations").cast("long").alias("max_iterations"))


@query("ord09_newest_upload", "SELECT id FROM uploads ORDER BY uploaded_at DESC, id DESC LIMIT 1")
def _(s, d):
    u = table(s, d, "uploads").select(F.col("id").alias("path"), F.col("uploaded_at").alias("modificationTime"))
    return sweep.newest(u).select(F.col("path").alias("id"))


@query("top01_worst_lines", _EVAL_SQL + "SELECT ord, round(cer, 6) AS cer FROM ev WHERE algo = 'initial' ORDER BY cer DESC, ord LIMIT 10")
def _(s, d):
    e = evaluated(s, d).where("algo = 'initial'").select("ord", "cer")
    return stats.worst(e, "cer", ["ord"], 10).select("ord", F.round("cer", 6).alias("cer"))


@query("top02_worst_files", _EVAL_SQL + "SELECT id, round(avg(cer), 6) AS cer FROM ev GROUP BY id ORDER BY 2 DESC, id LIMIT 15")
def _(s, d):
    g = evaluated(s, d).groupBy("id").agg(F.round(F.avg("cer"), 6).alias("cer"))
    return stats.worst(g, "cer", ["id"], 15)


@query("top03_confusions", _EVENTS + "SELECT * FROM counts WHERE op = 'substitution' ORDER BY n DESC, t, p LIMIT 30")
def _(s, d):
    return stats.top_confusions(confusions(s, d))


@query("top05_all_newest_first", "SELECT id, original_filename, row_number() OVER (ORDER BY uploaded_at DESC NULLS LAST, id, original_filename) AS rank FROM uploads")
def _(s, d):
    u = table(s, d, "uploads").orderBy(F.desc_nulls_last("uploaded_at"), "id", "original_filename").select("id", "original_filename")
    return splits.placed(u)


@query("top07_rare_characters", f"""WITH c AS (SELECT ch, count(*) AS n, min(ord) AS first_ord FROM (SELECT ord, unnest(regexp_extract_all({_norm('label')}, '{_CHRW}')) AS ch FROM manifest_w_lang WHERE status = 'labeled') GROUP BY ch)
    SELECT * FROM (SELECT ch, n, first_ord, row_number() OVER (ORDER BY n, first_ord, ch)::INT AS rank FROM c) WHERE rank <= greatest(1, floor((SELECT count(*) FROM c) / 5))""")
def _(s, d):
    m = table(s, d, "manifest_w_lang").where("status = 'labeled'")
    return stats.rarest_fifth(stats.character_counts(m, text.normalize_truth(F.col("label")), text.CHEROKEE_WIDE))


# sets -----------------------------------------------------------------------------


@query("set01_first_wins", "SELECT id, initial_ocr FROM (SELECT id, initial_ocr, row_number() OVER (PARTITION BY id ORDER BY src, ord) AS r FROM (SELECT 0 AS src, id, ord, initial_ocr FROM manifest_w_lang UNION ALL SELECT 1, id, 0, initial_ocr FROM line_metadata)) WHERE r = 1")
def _(s, d):
    a = table(s, d, "manifest_w_lang").select("id", "ord", "initial_ocr")
    b = table(s, d, "line_metadata").select("id", "initial_ocr", F.lit(0).cast("long").alias("ord"))
    return manifest.keyed_union([a, b], "id", "first", "ord").select("id", "initial_ocr")


@query("set02_last_wins", "SELECT id, initial_ocr FROM (SELECT id, initial_ocr, row_number() OVER (PARTITION BY id ORDER BY src DESC, ord DESC) AS r FROM (SELECT 0 AS src, id, ord, initial_ocr FROM manifest_w_lang UNION ALL SELECT 1, id, 0, initial_ocr FROM line_metadata)) WHERE r = 1")
def _(s, d):
    a = table(s, d, "manifest_w_lang").select("id", "ord", "initial_ocr")
    b = table(s, d, "line_metadata").select("id", "initial_ocr", F.lit(0).cast("long").alias("ord"))
    return manifest.keyed_union([a, b], "id", "last", "ord").select("id", "initial_ocr")


@query(
    "set03_merge_keeping",
    """WITH b AS (SELECT id, arg_max(initial_ocr, ord) FILTER (true) AS x FROM (SELECT id, ord, coalesce(initial_ocr, chr(1)) AS initial_ocr FROM manifest_w_lang) GROUP BY id)
    SELECT coalesce(b.id, o.id) AS id, CASE WHEN b.id IS NULL THEN o.initial_ocr ELSE nullif(b.x, chr(1)) END AS initial_ocr, o.predicted_lang FROM b FULL JOIN line_metadata o ON b.id = o.id""",
)
def _(s, d):
    base = manifest.latest(table(s, d, "manifest_w_lang").select("id", "ord", "initial_ocr"), "id", "ord").select("id", "initial_ocr")
    out = table(s, d, "line_metadata").select("id", "initial_ocr", "predicted_lang")
    return manifest.merge_keeping(base, out, "id", "predicted_lang").select("id", "initial_ocr", "predicted_lang")


@query("set05_alphabets", f"SELECT DISTINCT ch FROM (SELECT unnest({_chars('label')}) AS ch FROM manifest_w_lang UNION ALL SELECT unnest({_chars('ftm_ocr')}) FROM manifest_w_lang)")
def _(s, d):
    m = table(s, d, "manifest_w_lang")
    one = lambda c: m.select(F.explode(F.split(c, "")).alias("ch")).where("ch <> ''")
    return one("label").union(one("ftm_ocr")).distinct()


@query("set06_difference", "SELECT DISTINCT id FROM manifest_w_lang WHERE id NOT IN (SELECT id FROM fts_candidates)")
def _(s, d):
    return table(s, d, "manifest_w_lang").select("id").join(table(s, d, "fts_candidates").select("id"), "id", "left_anti").distinct()


@query("set07_without_scan", "SELECT ord FROM manifest_w_lang WHERE source_scan IS DISTINCT FROM '1828-01-03/seq-0.jp2'")
def _(s, d):
    return manifest.without_key(table(s, d, "manifest_w_lang"), "source_scan", "1828-01-03/seq-0.jp2").select("ord")


# strings ----------------------------------------------------------------------------


@query("str01_normal_form", f"SELECT ord, {_norm('label')} AS label FROM manifest_w_lang")
def _(s, d):
    return table(s, d, "manifest_w_lang").select("ord", text.normalize_truth(F.col("label")).alias("label"))


@query("str05_class_counts", f"SELECT doc_id, {_count('text', _CHR)}::INT AS chr, {_count('text', '[A-Za-z]')}::INT AS lat FROM documents")
def _(s, d):
    return table(s, d, "documents").select("doc_id", text.count_class(F.col("text"), text.CHEROKEE).alias("chr"), text.count_class(F.col("text"), text.LATIN).alias("lat"))


@query("str06_script_class", f"SELECT doc_id, {_CLS('text')} AS class FROM documents")
def _(s, d):
    return table(s, d, "documents").select("doc_id", text.script_class(F.col("text")).alias("class"))


@query(
    "str07_weighted_class",
    f"""WITH f AS ({_FEATURES_SQL}), g AS (SELECT *, 0.2 * ftm_conf + 0.5 * chr_conf - 0.5 * eng_conf + 0.5 * pct_cherokee * 100 AS s FROM f)
    SELECT ord, CASE WHEN s >= 32.1158 THEN 'Cherokee' WHEN pct_cherokee > 0.05 OR s >= 20 THEN 'Mixed' ELSE 'English' END AS class FROM g""",
)
def _(s, d):
    f = features(s, d)
    return f.select("ord", text.weighted_class(F.col("ftm_conf"), F.col("chr_conf"), F.col("eng_conf"), F.col("pct_cherokee"), F.lit(1)).alias("class"))


@query("str09_clean_words", r"SELECT ord, array_to_string(list_transform(list_filter(string_split_regex(label, '" + _WS + r"+'), lambda z: z <> ''), lambda z: regexp_replace(z, '[^\p{L}\p{N}\x{13A0}-\x{13FF}\x{AB70}-\x{ABBF}]', '', 'g')), '|') AS words FROM manifest_w_lang WHERE label <> ''")
def _(s, d):
    ws = F.transform(text.tokens(F.col("label")), text.clean_word)
    return table(s, d, "manifest_w_lang").where("label <> ''").select("ord", F.array_join(ws, "|").alias("words"))


@query("str10_strip_signs", "SELECT ord, trim(label, '.,!?\"()''-“”') AS label FROM manifest_w_lang")
def _(s, d):
    return table(s, d, "manifest_w_lang").select("ord", text.strip_signs(F.col("label")).alias("label"))


@query("str12_line_names", "SELECT ord, replace(replace(regexp_replace(source_scan, '\\.[^./]*$', ''), '/', '_'), '\\', '_') || format('_col_{:02d}_line_{:03d}', column_index, line_index) AS name FROM manifest_w_lang WHERE source_scan IS NOT NULL AND column_index IS NOT NULL AND line_index IS NOT NULL")
def _(s, d):
    m = table(s, d, "manifest_w_lang").where("source_scan is not null and column_index is not null and line_index is not null")
    return m.select("ord", text.line_name(F.col("source_scan"), F.col("column_index"), F.col("line_index")).alias("name"))


@query(
    "str13_name_parts",
    "SELECT ord, CASE WHEN id LIKE 'cnt\\_%' ESCAPE '\\' THEN array_to_string(string_split(id, '_')[1:3], '_') ELSE regexp_extract(id, '^(\\d{4}-\\d{2}-\\d{2}_seq-\\d+)', 1) END AS doc_id, CASE WHEN id LIKE 'cnt\\_%' ESCAPE '\\' THEN array_to_string(string_split(id, '_')[4:5], '_') ELSE regexp_extract(id, '(line_\\d+)', 1) END AS line_id, try_cast(nullif(regexp_extract(id, '(\\d{4}-\\d{2}-\\d{2})', 1), '') AS DATE)::VARCHAR AS day FROM manifest_w_lang",
)
def _(s, d):
    i = F.col("id")
    return table(s, d, "manifest_w_lang").select("ord", text.document_of(i).alias("doc_id"), text.line_of(i).alias("line_id"), text.date_of(i).cast("string").alias("day"))


@query("str18_verse_parts", "SELECT verse_key, substr(verse_key, 1, 2)::INT AS book, substr(verse_key, 3, 2)::INT AS chapter, substr(verse_key, 5, 2)::INT AS verse FROM verses")
def _(s, d):
    return table(s, d, "verses").select("verse_key", text.verse_parts(F.col("verse_key")).alias("p")).select("verse_key", "p.*")


@query("str20_hyphen_ends", f"SELECT ord FROM manifest_w_lang WHERE regexp_matches(label, '-{_WS}*$')")
def _(s, d):
    return table(s, d, "manifest_w_lang").where(text.ends_hyphenated(F.col("label"))).select("ord")


@query("str21_replace_token", f"SELECT ord, CASE WHEN list_contains({_TOK('label')}, 'the') THEN array_to_string(list_transform({_TOK('label')}, lambda z: CASE WHEN z = 'the' THEN 'ye' ELSE z END), ' ') ELSE label END AS label FROM manifest_w_lang")
def _(s, d):
    return table(s, d, "manifest_w_lang").select("ord", text.replace_token(F.col("label"), F.lit("the"), F.lit("ye")).alias("label"))


@query("str24_any_rare", "SELECT ord FROM manifest_w_lang WHERE regexp_matches(label, '[ᎩᏑᎶ4]')")
def _(s, d):
    return table(s, d, "manifest_w_lang").where(text.has_any(F.col("label"), list("ᎩᏑᎶ4"))).select("ord")


@query("str25_lower_script", "SELECT ord, array_to_string(list_transform(regexp_extract_all(label, '(?s).'), lambda z: CASE WHEN z BETWEEN chr(5024) AND chr(5109) THEN lower(z) ELSE z END), '') AS label FROM manifest_w_lang WHERE label IS NOT NULL")
def _(s, d):
    return table(s, d, "manifest_w_lang").where("label is not null").select("ord", text.lower_script(F.col("label")).alias("label"))


@query("str27_or_else", "SELECT ord, coalesce(nullif(label, ''), nullif(initial_ocr, '')) AS reference FROM manifest_w_lang")
def _(s, d):
    return table(s, d, "manifest_w_lang").select("ord", text.or_else(F.col("label"), F.col("initial_ocr")).alias("reference"))


# distances and alignments -------------------------------------------------------------


@query("dist02_line_rates", _EVAL_SQL + "SELECT algo, ord, round(cer, 6) AS cer, round(wer, 6) AS wer FROM ev")
def _(s, d):
    return evaluated(s, d).select("algo", "ord", F.round("cer", 6).alias("cer"), F.round("wer", 6).alias("wer"))


@query("dist04_viewer_rate", f"WITH c AS (SELECT ord, {_chars('label')} AS a, {_chars("coalesce(ftm_ocr, '')")} AS b FROM manifest_w_lang WHERE label <> '') SELECT ord, round(100.0 * {_lev('a', 'b')} / greatest(1, len(a)), 2) AS cer FROM c")
def _(s, d):
    return table(s, d, "manifest_w_lang").where("label <> ''").select("ord", metrics.viewer_cer(F.col("label"), F.col("ftm_ocr")).alias("cer"))


@query("dist06_difference", alignment_sql.differences(f"SELECT ord AS k, {_chars('label')} AS a, {_chars('ftm_ocr')} AS b FROM manifest_w_lang WHERE label <> '' AND ftm_ocr <> '' AND label <> ftm_ocr") + "SELECT k AS ord, pos, t, p, op FROM events WHERE op <> 'match'")
def _(s, d):
    m = table(s, d, "manifest_w_lang").where("label <> '' and ftm_ocr <> '' and label <> ftm_ocr").select("ord", "label", "ftm_ocr")
    marks = spread(m).select("ord", F.posexplode(sequences.difference(F.col("label"), F.col("ftm_ocr"))).alias("pos", "e"))
    return marks.select("ord", F.col("pos").cast("long").alias("pos"), "e.*").where("op <> 'match'")


def voted(s: SparkSession, d: str) -> DataFrame:
    """Every line with three readings, empty ones too, and its vote; rates of the first reading and of the vote where there is a truth."""
    o = table(s, d, "line_metadata").select("id", F.col("initial_ocr").alias("third"))
    m = table(s, d, "manifest_w_lang").select("id", "ord", "label", "initial_ocr", "ftm_ocr").join(o, "id").where("initial_ocr is not null and ftm_ocr is not null and third is not null")
    v = spread(m).select("ord", "label", "initial_ocr", sequences.majority(F.col("initial_ocr"), F.col("ftm_ocr"), F.col("third")).alias("voted"))
    rate = lambda c: F.when(F.col("label") != "", metrics.cer(F.col("label"), F.col(c)))
    return v.select("ord", "voted", rate("initial_ocr").alias("base_cer"), rate("voted").alias("ensemble_cer"))


@query("dist07_three_way_vote")
def _(s, d):
    return voted(s, d).select("ord", "voted", F.round("base_cer", 6).alias("base_cer"), F.round("ensemble_cer", 6).alias("ensemble_cer"))


@query("run15_ensemble_rates")
def _(s, d):
    return voted(s, d).agg(F.count("base_cer").alias("n"), F.round(F.avg("base_cer"), 6).alias("base_cer"), F.round(F.avg("ensemble_cer"), 6).alias("ensemble_cer"))


@query("dist08_similarity")
def _(s, d):
    m = table(s, d, "manifest_w_lang").where("label <> '' and initial_ocr <> ''")
    return m.select("ord", F.round(sequences.ratio(F.col("label"), F.col("initial_ocr")), 6).alias("ratio"))


@query("dist09_aligned_verses")
def _(s, d):
    v = table(s, d, "verses").where("cherokee is not null").select("verse_key", F.col("cherokee").alias("truth"))
    m = manifest.latest(table(s, d, "manifest_w_lang").where("dataset = 'cnt'").select("id", "ord", "label", "ftm_ocr"), "id", "ord")
    lines = m.select(F.regexp_extract("id", r"^cnt_\d+_(\d+)_", 1).alias("verse_key"), F.regexp_extract("id", r"_line_(\d+)$", 1).try_cast("int").alias("line_no"), F.coalesce("ftm_ocr", "label").alias("line_text"))
    return verses.align_verses(v, lines)


# splits and samples --------------------------------------------------------------------


@query("split01_every_nth", "SELECT ord, CASE WHEN rn0 > 0 AND rn0 % 5 = 0 THEN 'test' ELSE 'train' END AS split FROM (SELECT ord, row_number() OVER (ORDER BY ord) - 1 AS rn0 FROM manifest_w_lang WHERE status = 'labeled' AND predicted_lang = 'Cherokee')")
def _(s, d):
    m = table(s, d, "manifest_w_lang").where(manifest.is_labeled_target()).select("ord")
    return splits.every_nth_split(m, "ord").select("ord", "split")


@query("split02_unset_only", "SELECT ord, split FROM manifest_w_lang WHERE split IS NOT NULL UNION ALL SELECT ord, CASE WHEN rn0 > 0 AND rn0 % 5 = 0 THEN 'test' ELSE 'train' END FROM (SELECT ord, row_number() OVER (ORDER BY ord) - 1 AS rn0 FROM manifest_w_lang WHERE split IS NULL)")
def _(s, d):
    return splits.split_unset(table(s, d, "manifest_w_lang").select("ord", "split"), "ord").select("ord", "split")


@query(
    "split03_stratified",
    "SELECT ord, CASE WHEN r <= floor(n * 0.9) THEN 'train' ELSE 'test' END AS split FROM (SELECT ord, row_number() OVER (PARTITION BY g ORDER BY md5(concat(ord, ':42')), ord) AS r, count(*) OVER (PARTITION BY g) AS n FROM (SELECT ord, contains(label, 'Ꮐ') AS g FROM manifest_w_lang WHERE label <> ''))",
)
def _(s, d):
    m = table(s, d, "manifest_w_lang").where("label <> ''").select("ord", "label")
    return splits.stratified_split(m, "ord", F.col("label").contains("Ꮐ"), 0.9).select("ord", "split")


@query(
    "split04_guaranteed",
    """WITH m AS (SELECT substr(id, 1, 6) AS book, ord, contains(label, '4') AS four, regexp_matches(label, '[\\[\\]]') AS bracket FROM manifest_w_lang WHERE dataset = 'cnt' AND label <> ''),
    r AS (SELECT *, count(*) OVER (PARTITION BY book) AS n, CASE WHEN four THEN row_number() OVER (PARTITION BY book, four ORDER BY ord) END AS k4, CASE WHEN bracket THEN row_number() OVER (PARTITION BY book, bracket ORDER BY ord) END AS kb FROM m),
    p AS (SELECT *, CASE WHEN k4 <= 3 THEN 0 WHEN kb <= 3 THEN 1 ELSE 2 END AS place FROM r)
    SELECT book, ord FROM (SELECT *, row_number() OVER (PARTITION BY book ORDER BY place, CASE WHEN place < 2 THEN ord END, md5(concat(ord, ':salt')), ord) AS k FROM p) WHERE k <= floor(n * 0.1)""",
)
def _(s, d):
    m = table(s, d, "manifest_w_lang").where("dataset = 'cnt' and label <> ''").select(F.substring("id", 1, 6).alias("book"), "ord", "label")
    return splits.guaranteed_sample(m, "book", "ord", "ord", [F.col("label").contains("4"), F.col("label").rlike(r"[\[\]]")], 0.1).select("book", "ord")


@query("split06_corrupted", "SELECT ord, CASE WHEN hit THEN array_to_string(list_transform(regexp_extract_all(label, '(?s).'), lambda z: CASE WHEN z BETWEEN chr(5024) AND chr(5109) THEN lower(z) ELSE z END), '') ELSE label END AS label, hit AS corrupted FROM (SELECT ord, label, ('0x' || substr(md5(concat(ord, ':42')), 1, 8))::BIGINT / 4294967296.0 < 0.05 AS hit FROM manifest_w_lang WHERE label <> '')")
def _(s, d):
    m = table(s, d, "manifest_w_lang").where("label <> ''").select("ord", "label")
    return splits.corrupted(m, "ord", "label")


@query("split07_sample_size", "SELECT floor(n * 0.6::DOUBLE / 0.4::DOUBLE)::BIGINT AS k FROM (SELECT count(*) AS n FROM manifest_w_lang WHERE dataset IS NULL AND label <> '')")
def _(s, d):
    n = table(s, d, "manifest_w_lang").where("dataset is null and label <> ''").agg(F.count(F.lit(1)).alias("n"))
    return n.select(splits.sample_size(F.col("n"), 0.4).cast("long").alias("k"))


@query("split08_rare_first", "SELECT ord FROM (SELECT ord, regexp_matches(label, '[ᎩᏑᎶ]') AS rare FROM manifest_w_lang WHERE label <> '' AND dataset = 'cnt') ORDER BY rare DESC, md5(concat(ord, ':3')), ord LIMIT 40")
def _(s, d):
    m = table(s, d, "manifest_w_lang").where("label <> '' and dataset = 'cnt'").select("ord", "label")
    return splits.rare_first_sample(m, "ord", "label", list("ᎩᏑᎶ"), 40, 3).select("ord")


@query("split09_epoch_rows", "SELECT split, count(*) AS n FROM manifest_w_lang WHERE split IN ('train', 'test') GROUP BY split")
def _(s, d):
    return splits.epoch_rows(table(s, d, "manifest_w_lang")).groupBy("split").agg(F.count(F.lit(1)).alias("n"))


@query("split10_variations", "SELECT ord, unnest(range(0, CASE WHEN regexp_matches(label, '[ᎩᏑᎶ]') THEN 4 ELSE 2 END))::INT AS variation FROM manifest_w_lang WHERE label <> ''")
def _(s, d):
    return splits.variations(table(s, d, "manifest_w_lang").where("label <> ''").select("ord", "label"), "label", list("ᎩᏑᎶ")).select("ord", "variation")


def _unit(key: str, salt: str) -> str:
    return f"(('0x' || substr(md5(concat({key}, ':{salt}')), 1, 8))::BIGINT / 4294967296.0)"


@query(
    "split11_typos",
    f"""SELECT ord, CASE WHEN {_unit('ord', '7')} < 0.05 THEN CASE
        WHEN kind = 0 THEN left(label, cut) || letter || substr(label, cut + 2) WHEN kind = 1 AND n > 1 THEN left(label, cut) || substr(label, cut + 2)
        WHEN kind = 1 THEN label ELSE left(label, cut) || letter || substr(label, cut + 1) END ELSE label END AS label
      FROM (SELECT ord, label, length(label) AS n, floor({_unit('ord', '7at')} * length(label))::INT AS cut, floor({_unit('ord', '7kind')} * 3)::INT AS kind, chr(5024 + floor({_unit('ord', '7letter')} * 86)::INT) AS letter FROM manifest_w_lang WHERE label <> '')""",
)
def _(s, d):
    return splits.typo(table(s, d, "manifest_w_lang").where("label <> ''").select("ord", "label"), "ord", "label")


@query("split12_chosen_binarisation", "SELECT ord, ['otsu', 'sauvola', 'wolf'][1 + floor(('0x' || substr(md5(concat(ord, ':5')), 1, 8))::BIGINT / 4294967296.0 * 3)::INT] AS algo FROM manifest_w_lang")
def _(s, d):
    return table(s, d, "manifest_w_lang").select("ord", splits.chosen_of(["otsu", "sauvola", "wolf"], F.col("ord"), 5).alias("algo"))


@query("split13_binarisation_grid", "SELECT 'otsu' AS name UNION ALL SELECT format('sauvola_w{}_k0.1', w) FROM (VALUES (15), (25), (35), (45)) t(w) UNION ALL SELECT format('wolf_w{}_k0.{}', w, k) FROM (VALUES (15), (25), (35), (45)) t(w), (VALUES (1), (2), (3)) u(k)")
def _(s, d):
    return sweep.binarisations(s).select("name")


@query("split14_shuffled_all", "SELECT id, row_number() OVER (ORDER BY md5(concat(id, ':42')), id) AS rank FROM (SELECT DISTINCT id FROM manifest_w_lang WHERE label <> '')")
def _(s, d):
    m = table(s, d, "manifest_w_lang").where("label <> ''").select("id").distinct()
    return splits.numbered_by_hash(m, "id", 42)


# nested, sources, sinks, geometry, runs ---------------------------------------------------


@query("nest02_rebuilt_verses", "SELECT verse_key, array_to_string(list(label ORDER BY n), '|') AS lines FROM (SELECT regexp_extract(id, '^cnt_\\d+_(\\d+)_', 1) AS verse_key, regexp_extract(id, '_line_(\\d+)$', 1)::INT AS n, arg_max(coalesce(label, ''), ord) AS label FROM manifest_w_lang WHERE dataset = 'cnt' GROUP BY id) GROUP BY verse_key")
def _(s, d):
    m = manifest.latest(table(s, d, "manifest_w_lang").where("dataset = 'cnt'").select("id", "ord", "label"), "id", "ord")
    m = m.select(F.regexp_extract("id", r"^cnt_\d+_(\d+)_", 1).alias("verse_key"), F.regexp_extract("id", r"_line_(\d+)$", 1).try_cast("int").alias("n"), F.coalesce("label", F.lit("")).alias("label"))
    return verses.rebuilt(m, ["verse_key"], "n", ["label"]).select("verse_key", F.array_join(F.transform("lines", lambda x: x["label"]), "|").alias("lines"))


@query("nest06_joined_words", f"SELECT ord, array_to_string({_TOK('initial_ocr')}, ' ') AS words FROM manifest_w_lang WHERE initial_ocr IS NOT NULL")
def _(s, d):
    return table(s, d, "manifest_w_lang").where("initial_ocr is not null").select("ord", search.joined_words(text.tokens(F.col("initial_ocr"))).alias("words"))


@query("src01_keyed_json", "SELECT ord, id, status, column_index::VARCHAR AS column_index, label FROM manifest_w_lang")
def _(s, d):
    j = table(s, d, "manifest_w_lang").select(F.to_json(F.create_map(F.col("id"), F.struct(F.col("ord").alias("n"), "status", "column_index", "label"))).alias("value"))
    r = readers.keyed_rows(j, "value", "n BIGINT, status STRING, column_index INT, label STRING")
    return r.select(F.col("n").alias("ord"), "id", "status", F.col("column_index").cast("string").alias("column_index"), "label")


@query("src16_completed_scans", "SELECT DISTINCT source_scan FROM manifest_w_lang WHERE source_scan IS NOT NULL")
def _(s, d):
    return readers.completed_scans(table(s, d, "manifest_w_lang"))


@query("src20_training_log", "SELECT 2777::INT AS learning_iteration, 4700::INT AS training_iteration, 5188::INT AS sample_iteration, 9.763 AS bcer, 20.406 AS bwer, 10.2 AS skip_ratio")
def _(s, d):
    lines = ["Loaded file x, unpacking...", "At iteration 2777/4700/5188, mean rms=1.0%, delta=2.0%, BCER train=9.763%, BWER train=20.406%, skip ratio=10.200%, wrote checkpoint."]
    return readers.log_rows(s.createDataFrame([(x,) for x in lines], "value string"), "value")


@query("snk10_box_files", "SELECT ord, 'WordStr 0 0 ' || w || ' ' || h || ' 0 #' || label || chr(10) || chr(9) || ' 0 0 ' || w || ' ' || h || ' 0' || chr(10) AS box FROM (SELECT ord, label, line_bbox[3] - line_bbox[1] AS w, line_bbox[4] - line_bbox[2] AS h FROM manifest_w_lang WHERE label <> '' AND len(line_bbox) = 4)")
def _(s, d):
    m = table(s, d, "manifest_w_lang").where("label <> '' and size(line_bbox) = 4")
    return m.select("ord", sinks.box_text(F.col("label"), F.element_at("line_bbox", 3) - F.element_at("line_bbox", 1), F.element_at("line_bbox", 4) - F.element_at("line_bbox", 2)).alias("box"))


@query("snk13_updated_rows", "SELECT m.ord, coalesce(l.label, m.label) AS label FROM manifest_w_lang m LEFT JOIN line_metadata l USING (id)")
def _(s, d):
    up = table(s, d, "line_metadata").select("id", "label")
    return manifest.update_rows(table(s, d, "manifest_w_lang").select("ord", "id", "label"), up, "id", ["label"]).select("ord", "label")


@query("geo04_columns")
def _(s, d):
    b = table(s, d, "manifest_w_lang").where("size(line_bbox) = 4 and source_scan is not null")
    b = b.select(F.col("source_scan").alias("page_id"), F.lit(3000).alias("page_width"), F.lit(4000).alias("page_height"), F.col("ord").alias("block_ord"), F.col("line_bbox").cast("array<double>").alias("bbox"))
    return manifest.column_boxes(manifest.running_groups(b))


_BOX_SQL = """WITH b AS (SELECT ord, line_bbox AS x, greatest(1, line_bbox[4] - line_bbox[2]) AS h FROM manifest_w_lang WHERE len(line_bbox) = 4),
    p AS (SELECT *, CASE WHEN h <= 45 THEN 10 ELSE trunc(10 / (30.0::DOUBLE / h))::INT END AS px, CASE WHEN h <= 45 THEN 3 ELSE trunc(3 / (30.0::DOUBLE / h))::INT END AS py FROM b)
    SELECT ord, greatest(0, x[1] - px)::INT AS x1, greatest(0, x[2] - py)::INT AS y1, least(3000, x[3] + px)::INT AS x2, least(4000, x[4] + py)::INT AS y2, round(CASE WHEN h <= 45 THEN 1.0 ELSE 30.0::DOUBLE / h END, 6) AS scale FROM p"""


@query("geo09_padded_boxes", _BOX_SQL)
def _(s, d):
    m = table(s, d, "manifest_w_lang").where("size(line_bbox) = 4")
    return m.select("ord", manifest.padded_box(F.col("line_bbox"), F.lit(3000), F.lit(4000)).alias("p")).select("ord", "p.x1", "p.y1", "p.x2", "p.y2", F.round("p.scale", 6).alias("scale"))


@query(
    "geo11_unscaled_heights",
    """WITH h AS (SELECT DISTINCT (line_bbox[4] - line_bbox[2])::INT AS crop FROM manifest_w_lang WHERE len(line_bbox) = 4 AND line_bbox[4] > line_bbox[2]),
    u AS (SELECT crop, min(x) AS found FROM h LEFT JOIN range(30, 4000) r(x) ON x < greatest(31, crop) AND x + 2 * floor(3 / (30.0 / x))::INT = crop GROUP BY crop)
    SELECT crop, round(CASE WHEN crop <= 51 THEN 1.0 WHEN found IS NOT NULL THEN 30.0 / found ELSE 36.0 / crop END, 6)::DOUBLE AS scale,
      (CASE WHEN crop <= 51 THEN greatest(1, crop - 6) WHEN found IS NOT NULL THEN found ELSE floor(30 / (36.0::DOUBLE / crop)) END)::INT AS height FROM u""",
)
def _(s, d):
    c = lambda i: F.element_at("line_bbox", i)
    h = table(s, d, "manifest_w_lang").where(F.size("line_bbox") == 4).select((c(4) - c(2)).cast("int").alias("crop")).where("crop > 0").distinct()
    return h.select("crop", manifest.unscaled_height(F.col("crop")).alias("p")).select("crop", F.round("p.scale", 6).alias("scale"), F.col("p.height").cast("int").alias("height"))



@query("run10_dry_run", "SELECT id, parent_id, epochs, avg_BCER, avg_BWER FROM (SELECT 'e' || i || '_epoch_' || ep AS id, 'e' || i AS parent_id, ep::INT AS epochs, (25.0 - 0.5 * i - 0.1 * ep)::DOUBLE AS avg_BCER, (55.0 - 0.8 * i - 0.2 * ep)::DOUBLE AS avg_BWER FROM range(0, 3) t(i), (VALUES (4), (8)) u(ep))")
def _(s, d):
    e = s.createDataFrame([(i, f"e{i}", [4, 8]) for i in range(3)], "i int, id string, eval_epochs array<int>")
    return sweep.dry_run(s, e)


@query("run16_best_run", "SELECT 'e2_epoch_8' AS id, 23.2::DOUBLE AS avg_BCER")
def _(s, d):
    e = s.createDataFrame([(i, f"e{i}", [4, 8]) for i in range(3)], "i int, id string, eval_epochs array<int>")
    return stats.best_run(sweep.dry_run(s, e), "avg_BCER", "id").select("id", F.round("avg_BCER", 6).alias("avg_BCER"))


def _all() -> None:
    import linecorpus.plans.catalog_io  # noqa: F401 - adds its queries
    import linecorpus.plans.catalog_more  # noqa: F401 - adds its queries


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _all()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    _all()
    return dict(SQL)
