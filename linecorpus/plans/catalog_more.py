"""Further core queries: parsers, scalars, sources and choices, over tables or written-down inputs."""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linecorpus.functions import metrics, sequences, text
from linecorpus.operators import images, search, splits, stats, sweep, verses
from linecorpus.plans import alignment_sql
from linecorpus.plans.catalog import _CHR, _EVAL_SQL, _EVENTS, _FEATURES_SQL, _TOK, _chars, _lev, _norm, confusions, evaluated, features, query
from linecorpus.plans.tables import spread, table
from linecorpus.sources import readers, sinks


@query("flt19_excluded", "SELECT DISTINCT verse_key || ':' || book AS id FROM verses WHERE verse_key NOT IN (SELECT verse_key FROM verses WHERE english = '' OR english IS NULL)")
def _(s, d):
    v = table(s, d, "verses").select("verse_key", F.col("book").alias("original_word"), "english")
    bad = v.where("english = '' or english is null").select("verse_key").distinct().join(v.select("verse_key", "original_word"), "verse_key")
    return verses.without_excluded(v, bad).select(F.concat_ws(":", "verse_key", "original_word").alias("id")).distinct()


@query("join03_truth_by_stem", "SELECT m.ord, l.label AS truth FROM manifest_w_lang m JOIN line_metadata l ON regexp_replace(regexp_replace(m.image_path, '^.*[/\\\\]', ''), '\\.[^.]*$', '') = regexp_replace(regexp_replace(l.image_path, '^.*[/\\\\]', ''), '\\.[^.]*$', '')")
def _(s, d):
    i = table(s, d, "manifest_w_lang").select("ord", text.base_name(F.col("image_path")).alias("stem"))
    t = table(s, d, "line_metadata").select(text.base_name(F.col("image_path")).alias("stem"), F.col("label").alias("truth"))
    return readers.with_truth(i, t, inner=True).select("ord", "truth")


@query("join10_parameter_grid", "SELECT a::DOUBLE AS a, b::DOUBLE AS b, c::DOUBLE AS c FROM (VALUES (1), (2), (3)) x(a), (VALUES (1), (2), (3), (4)) y(b), (VALUES (5), (6), (7)) z(c)")
def _(s, d):
    return sweep.grid(s, a=[1, 2, 3], b=[1, 2, 3, 4], c=[5, 6, 7]).drop("ord")


@query("agg03_exact_median", _EVAL_SQL + "SELECT algo, split, round(median(cer), 6) AS median FROM ev GROUP BY algo, split")
def _(s, d):
    return evaluated(s, d).groupBy("algo", "split").agg(F.round(F.median("cer"), 6).alias("median"))


@query(
    "agg14_best_grid_point",
    f"""WITH f AS ({_FEATURES_SQL}), p AS (SELECT (row_number() OVER (ORDER BY t, a, c))::INT - 1 AS ord, t::DOUBLE AS t, a::DOUBLE AS a, 50.0::DOUBLE AS b, c::DOUBLE AS c FROM (VALUES (0.3), (0.4), (0.5), (0.6)) x(t), (VALUES (40), (60)) y(a), (VALUES (30), (60)) w(c)),
    g AS (SELECT p.*, avg(((pct_cherokee >= t OR (pct_cherokee >= 0.15 AND ftm_conf >= a AND chr_conf >= b AND eng_conf < c)) = (true_label = 'Cherokee'))::INT) AS accuracy FROM f, p GROUP BY ALL)
    SELECT t, a, b, c, round(accuracy, 6) AS accuracy FROM g ORDER BY g.accuracy DESC, ord LIMIT 1""",
)
def _(s, d):
    g = sweep.grid(s, t=[0.3, 0.4, 0.5, 0.6], a=[40.0, 60.0], b=[50.0], c=[30.0, 60.0])
    return sweep.best_point(sweep.rule_grid(features(s, d), g)).select("t", "a", "b", "c", F.round("accuracy", 6).alias("accuracy"))


@query("agg23_skew_angles")
def _(s, d):
    """The skew of drawn pages, one per angle: rows are judged by their variance."""
    @F.pandas_udf("double")
    def found(angle: pd.Series) -> pd.Series:
        import numpy as np

        page = np.full((80, 160), 255, np.uint8)
        page[20:60:8, 10:150] = 0
        return angle.map(lambda a: images.skew(images.rotate(page, a)))

    return s.range(-3, 4).select(F.col("id").cast("double").alias("angle")).select("angle", F.round(found("angle"), 2).alias("skew"))


@query("ord10_latest_iterations", "SELECT * FROM (VALUES ('b_3_900.checkpoint', 900), ('d_1_700.checkpoint', 700)) t(path, iteration)")
def _(s, d):
    f = s.createDataFrame([("a_1_100.checkpoint",), ("b_3_900.checkpoint",), ("c.checkpoint",), ("d_1_700.checkpoint",)], "path string")
    return sweep.latest_iterations(f, 2)


@query("top04_off_diagonal", _EVENTS + "SELECT * FROM counts WHERE op = 'substitution' ORDER BY n DESC, t, p LIMIT 20")
def _(s, d):
    c = confusions(s, d).where("op = 'substitution'")
    return stats.top_confusions(c, top=20)


_VERSE = "regexp_extract(id, '^cnt_\\d+_(\\d+)_', 1), try_cast(regexp_extract(id, '_line_(\\d+)$', 1) AS INT) NULLS FIRST, id"
_VIEWER = {"cer_desc": "cer DESC NULLS LAST, id", "cer_asc": "cer NULLS LAST, id", "conf_asc": "ftm_confidence NULLS LAST, id", "conf_desc": "ftm_confidence DESC NULLS LAST, id", "verse": _VERSE}


@query(
    "top06_all_viewer_orders",
    f"WITH c AS (SELECT *, {_chars('label')} AS a, {_chars("coalesce(ftm_ocr, '')")} AS b FROM manifest_w_lang), e AS (SELECT ord, id, ftm_confidence, CASE WHEN label <> '' THEN round(100.0 * {_lev('a', 'b')} / greatest(1, len(a)), 2) END AS cer FROM c) "
    + " UNION ALL ".join(f"SELECT '{k}' AS by, ord, row_number() OVER (ORDER BY {o}, ord) AS rank FROM e" for k, o in _VIEWER.items()),
)
def _(s, d):
    m = table(s, d, "manifest_w_lang").select("ord", "id", "ftm_confidence", F.when(F.col("label") != "", metrics.viewer_cer(F.col("label"), F.col("ftm_ocr"))).alias("cer"))
    parts = [splits.placed(stats.ordered(m, by, "ord").select(F.lit(by).alias("by"), "ord")) for by in stats.ORDERS]
    return reduce(DataFrame.unionByName, parts)


@query("top09_first_existing", "SELECT id FROM line_metadata WHERE image_path IN (SELECT image_path FROM manifest_w_lang WHERE label <> '') ORDER BY id LIMIT 20")
def _(s, d):
    have = table(s, d, "manifest_w_lang").where("label <> ''").select("image_path")
    return table(s, d, "line_metadata").join(have, "image_path", "left_semi").orderBy("id").limit(20).select("id")


@query("set04_task_lists", "SELECT ord, 'Cherokee' AS truth FROM manifest_w_lang WHERE status = 'labeled' AND predicted_lang = 'Cherokee' UNION ALL SELECT ord, 'English' FROM manifest_w_lang WHERE status = 'not_cherokee' UNION ALL SELECT ord, 'English' FROM manifest_w_lang WHERE status = 'labeled' AND predicted_lang = 'English'")
def _(s, d):
    m = table(s, d, "manifest_w_lang")
    part = lambda c, lang: m.where(c).select("ord", F.lit(lang).alias("truth"))
    return part("status = 'labeled' and predicted_lang = 'Cherokee'", "Cherokee").unionByName(part("status = 'not_cherokee'", "English")).unionByName(part("status = 'labeled' and predicted_lang = 'English'", "English"))


@query("str03_wide_range", "SELECT doc_id, len(regexp_extract_all(text, '[\\x{13A0}-\\x{13FF}\\x{AB70}-\\x{ABFF}]'))::INT AS n FROM documents")
def _(s, d):
    return table(s, d, "documents").select("doc_id", text.count_class(F.col("text"), text.CHEROKEE_WIDE).alias("n"))


@query("str08_language_rule", f"SELECT ord, (p >= 0.5 OR (p >= 0.15 AND f >= 60 AND c >= 50 AND e < 30)) AS cherokee FROM (SELECT ord, coalesce(ftm_confidence, 0) AS f, 40 + ord % 60 AS c, ord % 55 AS e, CASE WHEN len(regexp_extract_all(label, '{_CHR}')) + len(regexp_extract_all(label, '[A-Za-z]')) > 0 THEN len(regexp_extract_all(label, '{_CHR}')) / (len(regexp_extract_all(label, '{_CHR}')) + len(regexp_extract_all(label, '[A-Za-z]'))) ELSE 0 END AS p FROM manifest_w_lang WHERE label <> '' AND predicted_lang IS NOT NULL)")
def _(s, d):
    f = features(s, d)
    return f.select("ord", text.rule_is_cherokee(F.col("ftm_conf"), F.col("chr_conf"), F.col("eng_conf"), F.col("pct_cherokee"), 0.5, 60.0, 50.0, 30.0).alias("cherokee"))


@query("str11_token_counts", f"SELECT doc_id, len({_TOK('text')})::INT AS n FROM documents")
def _(s, d):
    return table(s, d, "documents").select("doc_id", F.size(text.tokens(F.col("text"))).alias("n"))


_SEEDS = ["https://papers.example.org/lccn/sn1/1828-02-21/ed-1/seq-1/ eval junk", "https://papers.example.org/lccn/sn1/1828-02-21/ed-1/seq-2/", "# none", "https://papers.example.org/lccn/sn1/1828-02-28/ed-2/"]


@query("str14_seed_urls", "SELECT * FROM (VALUES ('https://papers.example.org/lccn/sn1/1828-02-21/ed-1/', '1828-02-21', 'ed-1'), ('https://papers.example.org/lccn/sn1/1828-02-28/ed-2/', '1828-02-28', 'ed-2')) t(base_url, date, edition)")
def _(s, d):
    return readers.seed_rows(s.createDataFrame([(x,) for x in _SEEDS], "value string"), "value")


@query("str16_eval_metrics", "SELECT 7.033::DOUBLE AS bcer, 15.781::DOUBLE AS bwer")
def _(s, d):
    return readers.eval_rows(s.createDataFrame([("At iteration 0, stage 0, BCER eval=7.033, BWER eval=15.781",), ("noise",)], "value string"), "value")


@query("str17_report_metrics", "SELECT * FROM (VALUES ('Main Test Set', 101, 11.88::DOUBLE, 40.1::DOUBLE), ('CNT Test Set', 738, 3.23::DOUBLE, 9.9::DOUBLE)) t(title, lines, cer, wer)")
def _(s, d):
    t = "Main Test Set (101 lines):\n  Mean CER: 11.88%\n  Mean WER: 40.1%\nCNT Test Set (738 lines):\n  Mean CER: 3.23%\n  Mean WER: 9.9%\n"
    return s.createDataFrame([(t,)], "t string").select(F.explode(readers.report_rates(F.col("t"))).alias("r")).select("r.*")


@query("str19_numbered_verses", "SELECT ord, CASE WHEN regexp_extract(id, '_line_(\\d+)$', 1)::INT = 0 THEN CASE WHEN coalesce(label, '') = '' THEN v ELSE v || ' ' || label END ELSE label END AS label FROM (SELECT *, substr(regexp_extract(id, '^cnt_\\d+_(\\d+)_', 1), 5, 2)::INT::VARCHAR AS v FROM manifest_w_lang WHERE dataset = 'cnt')")
def _(s, d):
    m = table(s, d, "manifest_w_lang").where("dataset = 'cnt'")
    v = text.verse_parts(F.regexp_extract("id", r"^cnt_\d+_(\d+)_", 1))["verse"].cast("string")
    first = F.regexp_extract("id", r"_line_(\d+)$", 1).try_cast("int") == 0
    return m.select("ord", text.numbered(v, F.col("label"), first).alias("label"))


@query("str23_contains", "SELECT ord FROM manifest_w_lang WHERE contains(label, 'Ꮐ') OR contains(label, '4') OR contains(label, '[')")
def _(s, d):
    return table(s, d, "manifest_w_lang").where(F.col("label").contains("Ꮐ") | F.col("label").contains("4") | F.col("label").contains("[")).select("ord")


@query("str28_image_titles", "SELECT ord, '<div title=''image \"' || image_path || '\"; bbox''>' AS hocr FROM manifest_w_lang WHERE image_path IS NOT NULL")
def _(s, d):
    h = F.lit("<div title='image \"old.png\"; bbox'>")
    return table(s, d, "manifest_w_lang").where("image_path is not null").select("ord", text.image_title(h, F.col("image_path")).alias("hocr"))


@query("dist01_edit_distance", "SELECT id, levenshtein(regexp_replace(label, '[^ -~]', '', 'g'), regexp_replace(initial_ocr, '[^ -~]', '', 'g')) AS d FROM line_metadata WHERE label IS NOT NULL AND initial_ocr IS NOT NULL")
def _(s, d):
    a, b = (F.regexp_replace(c, "[^ -~]", "") for c in ("label", "initial_ocr"))
    return table(s, d, "line_metadata").where("label is not null and initial_ocr is not null").select("id", F.levenshtein(a, b).cast("long").alias("d"))


@query("dist05_alignments", alignment_sql.edits(f"SELECT ord AS k, {_chars('t')} AS a, {_chars('r')} AS b FROM (SELECT ord, {_norm('label')} AS t, {_norm('ftm_ocr')} AS r FROM manifest_w_lang WHERE label <> '' AND ftm_ocr <> '') WHERE t <> r") + "SELECT k AS ord, pos, t, p, op FROM events WHERE op <> 'match'")
def _(s, d):
    e = evaluated(s, d).where("algo = 'ftm' and ocr <> '' and t <> r").select("ord", "t", "r")
    events = spread(e).select("ord", F.posexplode(sequences.alignment(F.col("t"), F.col("r"))).alias("pos", "e"))
    return events.select("ord", F.col("pos").cast("long").alias("pos"), "e.*").where("op <> 'match'")


@query("dist12_realigned_once")
def _(s, d):
    """Align, find missing spaces, correct the truth, align once more."""
    from linecorpus.plans.catalog import _words_of

    tok, words = _words_of(s, d)
    found = verses.missing_spaces(tok, words)
    v = table(s, d, "verses").where("cherokee is not null").select("verse_key", F.col("cherokee").alias("truth"))
    lines = tok.where("model = 'ftm'").groupBy("verse_key", "line_no").agg(F.array_sort(F.collect_list(F.struct("pos", "token"))).alias("a")).select("verse_key", "line_no", F.array_join(F.transform("a", lambda x: x["token"]), " ").alias("line_text"))
    return verses.align_verses(verses.apply_splits(v, found, "truth").select("verse_key", "truth"), lines)


@query("dist13_lattice_beam", "SELECT ord, 'th' AS best FROM manifest_w_lang")
def _(s, d):
    p = F.array(F.array(F.struct(F.lit("t").alias("ch"), (F.col("ord") % 7 + 1).cast("double").alias("conf")), F.struct(F.lit("f").alias("ch"), F.lit(0.5).alias("conf"))), F.array(F.struct(F.lit("h").alias("ch"), F.lit(2.0).alias("conf")), F.struct(F.lit("b").alias("ch"), F.lit(1.0).alias("conf"))))
    return table(s, d, "manifest_w_lang").select("ord", F.element_at(search.beam(p, 3), 1).alias("best"))


@query("split05_shuffled", "SELECT id, CASE WHEN r <= floor(n * 0.8) THEN 'train' ELSE 'test' END AS split FROM (SELECT id, row_number() OVER (ORDER BY md5(concat(id, ':42')), id) AS r, count(*) OVER () AS n FROM line_metadata)")
def _(s, d):
    m = table(s, d, "line_metadata").select("id")
    n = m.agg(F.count(F.lit(1))).scalar()
    return splits.numbered_by_hash(m, "id", 42).select("id", F.when(F.col("rank") <= F.floor(n * 0.8), "train").otherwise("test").alias("split"))


_HTML = '<html><a href="mat1.html">1</a><a href="mat2.html">2</a><a href="mat1.html">1</a><table border="1"><tr><th><img src="010101.png"></th><th>In the<i>x</i></th><th>ᎠᎡ</th><th>ae</th></tr></table></html>'


@query("src13_scraped_verses", "SELECT '010101.png' AS image, 'In the' AS english, 'ᎠᎡ' AS cherokee, 'ae' AS phonetic")
def _(s, d):
    return s.createDataFrame([(_HTML,)], "h string").select(F.explode(readers.verse_tables("h")).alias("v")).select("v.*")


@query("nest05_chapter_links", "SELECT * FROM (VALUES ('mat1.html'), ('mat2.html')) t(link)")
def _(s, d):
    return s.createDataFrame([(_HTML,)], "h string").select(F.explode(readers.chapter_links(F.col("h"), "mat")).alias("link"))


@query("nest03_hocr_words", "SELECT 'c' AS best, 20.0::DOUBLE AS conf")
def _(s, d):
    h = "<span class='ocrx_word'><span class='ocrx_cinfo' id='lstm_choices_1'><span class='ocrx_cinfo' id='choice_1' title='x_confs 9.5'>a</span><span class='ocrx_cinfo' id='choice_3' title='x_confs 20'>c</span></span></span>"
    w = s.createDataFrame([(h,)], "h string").select(readers.lattices("h")[0][0][0].alias("o"))
    return w.select(F.col("o.ch").alias("best"), F.col("o.conf").alias("conf"))


@query("src04_config_defaults", "SELECT 5::INT AS total_epochs, 0.0005::DOUBLE AS learning_rate, 'constant' AS lr_schedule")
def _(s, d):
    c = s.createDataFrame([('{"total_epochs": 5, "old_key": [1]}',)], "value string")
    return readers.config_rows(c, "value", {"total_epochs": ("INT", 12), "learning_rate": ("DOUBLE", 0.0005), "lr_schedule": ("STRING", "constant")})


@query("src05_sweep_experiments", "SELECT * FROM (VALUES ('a', 3, 2), ('b', 12, 1)) t(id, total_epochs, n)")
def _(s, d):
    w = s.createDataFrame([('{"experiments": [{"id": "a", "config": {"total_epochs": 3}, "eval_epochs": [1, 2]}, {"id": "b", "config": {}, "eval_epochs": [4]}]}',)], "value string")
    return readers.sweep_rows(w, "value", "total_epochs: INT").select("id", F.coalesce("config.total_epochs", F.lit(12)).alias("total_epochs"), F.size("eval_epochs").alias("n"))


@query("src11_line_boxes", "SELECT 10::INT AS \"left\", 20::INT AS top, 40::INT AS \"right\", 60::INT AS bottom")
def _(s, d):
    t = "level\tpage_num\tblock_num\tpar_num\tline_num\tword_num\tleft\ttop\twidth\theight\tconf\ttext\n4\t1\t1\t1\t1\t0\t10\t20\t30\t40\t-1\t\n5\t1\t1\t1\t1\t1\t0\t0\t1\t1\t90\ta\n"
    return readers.box_rows(s.createDataFrame([(t,)], "t string"), "t")


@query("src15_vocabulary", "SELECT * FROM (VALUES ('Ꭰ'), ('b'), (' '), (chr(9)), (chr(10)), (chr(13))) t(ch)")
def _(s, d):
    v = s.createDataFrame([(0, "4"), (1, "NULL 0"), (2, "x 1 # Ꭰ [1]"), (3, "b 3")], "n int, value string")
    return readers.vocabulary_rows(v, "value", "n")


@query("src17_exclusions", "SELECT * FROM (VALUES ('1', 'w'), ('2', 'x'), ('2', 'y'), ('3', 'z')) t(verse_key, original_word)")
def _(s, d):
    shapes = ['[{"verse_key":"1","original_word":"w"}]', '["1:w"]', '{"2":["x","y"]}', '{"3":"z"}', "[]"]
    return readers.exclusion_rows(s.createDataFrame([(x,) for x in shapes], "value string"), "value")


_ALPHABET = "SELECT chr(x::INT) AS ch FROM range(5024, 5110) r(x) UNION ALL SELECT chr(x::INT) FROM range(32, 127) r(x)"


@query(
    "snk05_confusion_matrix",
    _EVENTS + f""", alphabet AS ({_ALPHABET}), cells AS (
      SELECT r.ch AS truth, c.ch AS pred FROM (SELECT ch FROM alphabet UNION ALL SELECT '<ins>') r, (SELECT ch FROM alphabet UNION ALL SELECT '<del>') c WHERE r.ch <> '<ins>' OR c.ch <> '<del>')
    SELECT truth, pred, coalesce(n, 0)::BIGINT AS n FROM cells LEFT JOIN (SELECT CASE WHEN op = 'insertion' THEN '<ins>' ELSE t END AS truth, CASE WHEN op = 'deletion' THEN '<del>' ELSE p END AS pred, sum(n) AS n FROM counts GROUP BY 1, 2) USING (truth, pred)""",
)
def _(s, d):
    # the alphabet is that of two scripts, not of the data
    alphabet = [chr(x) for x in range(0x13A0, 0x13F6)] + [chr(x) for x in range(0x20, 0x7F)]
    return stats.confusion_cells(confusions(s, d), alphabet)


@query("snk10_triplets", "SELECT ord || '.gt.txt' AS path, label AS content FROM manifest_w_lang WHERE label <> '' UNION ALL SELECT ord || '.box', 'WordStr 0 0 100 42 0 #' || label || chr(10) || chr(9) || ' 0 0 100 42 0' || chr(10) FROM manifest_w_lang WHERE label <> ''")
def _(s, d):
    m = table(s, d, "manifest_w_lang").where("label <> ''").select(F.col("ord").cast("string").alias("stem"), F.col("label").alias("text"), F.lit(100).alias("width"), F.lit(42).alias("height"))
    return sinks.triplets(m)


@query("snk15_script_once", "SELECT '<body><script/></body>' AS html UNION ALL SELECT '<body>hocrjs</body>'")
def _(s, d):
    h = s.createDataFrame([("<body></body>",), ("<body>hocrjs</body>",)], "h string")
    return h.select(sinks.with_script(F.col("h"), "<script/>").alias("html"))


@query("run19_labelling_list", f"SELECT ord, coalesce(predicted_lang, CASE WHEN len(regexp_extract_all(t, '{_CHR}')) + len(regexp_extract_all(t, '[A-Za-z]')) = 0 THEN 'Empty' WHEN len(regexp_extract_all(t, '{_CHR}')) / (len(regexp_extract_all(t, '{_CHR}')) + len(regexp_extract_all(t, '[A-Za-z]'))) < 0.4 THEN 'English' WHEN len(regexp_extract_all(t, '{_CHR}')) / (len(regexp_extract_all(t, '{_CHR}')) + len(regexp_extract_all(t, '[A-Za-z]'))) > 0.45 THEN 'Cherokee' ELSE 'Mixed' END) AS classification FROM (SELECT ord, predicted_lang, coalesce(nullif(label, ''), nullif(initial_ocr, ''), '') AS t FROM manifest_w_lang)")
def _(s, d):
    m = table(s, d, "manifest_w_lang")
    return m.select("ord", F.coalesce("predicted_lang", text.script_class(text.or_else(F.col("label"), F.col("initial_ocr")))).alias("classification"))


@query("run25_viewer_lines", _EVAL_SQL + "SELECT ord, CASE WHEN ftm_confidence >= 80 AND dist > 0 THEN 'confidently_disagrees' WHEN ftm_confidence < 70 THEN 'low_confidence' WHEN dist = 0 THEN 'high_confidence_correct' ELSE 'low_error_other' END AS category FROM ev WHERE algo = 'ftm' AND ocr IS NOT NULL AND dataset = 'cnt'")
def _(s, d):
    e = evaluated(s, d).where("algo = 'ftm' and ocr is not null and dataset = 'cnt'")
    return e.select("ord", metrics.triage(F.col("ftm_confidence"), F.col("dist")).alias("category"))


@query("run12_missing_symbols", "SELECT DISTINCT c AS ch FROM (SELECT unnest(regexp_extract_all(label, '(?s).')) AS c FROM manifest_w_lang) WHERE c NOT IN (SELECT unnest(regexp_extract_all(term, '(?s).')) FROM lexicon)")
def _(s, d):
    one = lambda t, c: t.select(F.explode(F.split(c, "")).alias("ch")).where("ch <> ''")
    return one(table(s, d, "manifest_w_lang"), "label").join(one(table(s, d, "lexicon"), "term").distinct(), "ch", "left_anti").distinct()

