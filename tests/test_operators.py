"""Manifests, splits, search, sources, sinks and streams on small fixtures."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from linecorpus.operators import images, manifest, search, splits, stats, sweep, verses
from linecorpus.sources import readers, sinks
from linecorpus.streaming import incremental


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_keyed_union(spark):
    a = spark.createDataFrame([("x", 1, "a"), ("x", 2, "b")], "id string, ord int, v string")
    b = spark.createDataFrame([("x", 1, "c", 1.0), ("y", 1, None, 2.0)], "id string, ord int, v string, w double")
    assert rows(manifest.keyed_union([a, b], "id", "first", "ord").select("id", "v", "w")) == [("x", "a", None), ("y", None, 2.0)]
    assert rows(manifest.keyed_union([a, b], "id", "last", "ord").select("id", "v")) == [("x", "c"), ("y", None)]


def test_merge_keeping(spark):
    base = spark.createDataFrame([("a", "new", None), ("b", "new", None), ("d", "only", "E")], "id string, t string, lang string")
    out = spark.createDataFrame([("a", "old", "C"), ("b", "old", None), ("c", "old", "C")], "id string, t string, lang string")
    assert rows(manifest.merge_keeping(base, out, "id", "lang")) == [("a", "new", "C"), ("b", "new", None), ("c", "old", "C"), ("d", "only", "E")]


def test_transfer_is_one_to_one_and_strict(spark):
    schema = "id string, ord int, source_scan string, status string, label string, initial_ocr string"
    old = spark.createDataFrame([("o1", 1, "s", "labeled", "abcdefgh", None), ("o2", 2, "s", "labeled", "", "abcdefgh"), ("o3", 3, "s", "labeled", "abce", None), ("o4", 4, "t", "unlabeled", "zzzz", None)], schema)
    new = spark.createDataFrame([("n1", 1, "s", "unlabeled", None, "abcdefgh"), ("n2", 2, "s", "unlabeled", None, "abcdefgx"), ("n3", 3, "s", "unlabeled", None, "abcd")], schema)
    got = rows(manifest.transfer_labels(old, new).select("old_id", "new_id"))
    assert got == [("o1", "n1"), ("o2", "n2")]  # 0.75 exactly is no match


def test_transfer_against_the_plain_loop(spark, monkeypatch):
    import difflib
    import random

    monkeypatch.setattr(manifest, "TRANSFER_BLOCK", 5)
    rng = random.Random(3)
    base = ["".join(rng.choices("abcdef ", k=12)).strip() or "a" for _ in range(12)]
    vary = lambda t: "".join(rng.choice("abcdef") if rng.random() < 0.15 else x for x in t).strip() or "a"
    schema = "id string, ord int, source_scan string, status string, label string, initial_ocr string"
    olds = [(f"o{i}", i, "st"[i % 2], "labeled", vary(rng.choice(base)), None) for i in range(40)]
    news = [(f"n{i}", i, "st"[i % 2], "unlabeled", None, vary(rng.choice(base))) for i in range(40)]
    want, free = [], list(news)
    for o in olds:
        best, at = 0.75, None
        for n in free:
            if n[2] == o[2] and (r := difflib.SequenceMatcher(None, o[4], n[5]).ratio()) > best:
                best, at = r, n
        if at:
            free.remove(at)
            want.append((o[0], at[0]))
    got = manifest.transfer_labels(spark.createDataFrame(olds, schema), spark.createDataFrame(news, schema))
    assert rows(got.select("old_id", "new_id")) == sorted(want, key=repr)


def test_error_values_are_three_states(spark):
    df = spark.createDataFrame([(None, None), ("Error", None), ("", "Error"), ("x", "")], "ftm_ocr string, predicted_lang string")
    assert df.where(~manifest.is_error()).count() == 2


def test_numbering_and_accumulator(spark):
    df = spark.range(0, 1000).select((F.col("id") * 7 % 1000).alias("ord"))
    r = splits.numbered(df, "ord").collect()
    assert all(x["ord"] == x["rn0"] for x in r)
    for ratio in (0.8, 0.75, 0.7, 0.6):
        got = sorted(x["ord"] for x in splits.every_nth_split(df, "ord", ratio).where("split = 'test'").collect())
        assert got == splits.accumulator_tests(1000, ratio)
    assert splits.accumulator_tests(21, 0.8) == [5, 10, 15, 20]
    assert splits.accumulator_tests(12, 0.75) == [3, 7, 11]


def test_sample_size_rejects_bad_ratios(spark):
    with pytest.raises(Exception, match="between 0 and 1"):
        spark.range(1).select(splits.sample_size(F.lit(5), 1.0)).collect()


def test_typo_is_one_edit_and_repeatable(spark):
    df = spark.createDataFrame([(str(i), "ᎠᎡᎢᎣᎤᎥ") for i in range(300)], "id string, t string")
    got = [r["t"] for r in splits.typo(df, "id", "t", rate=0.5).orderBy("id").collect()]
    assert got == [r["t"] for r in splits.typo(df, "id", "t", rate=0.5).orderBy("id").collect()]
    assert all(verses.distance(x, "ᎠᎡᎢᎣᎤᎥ") <= 1 for x in got)
    assert 90 < sum(x != "ᎠᎡᎢᎣᎤᎥ" for x in got) < 210


def test_beam_and_recall(spark):
    df = spark.createDataFrame([([[("a", 0.9), ("b", 0.5)], [("c", 0.9), ("d", 0.8)]],), ([],)], "p array<array<struct<ch:string,conf:double>>>")
    assert [r[0] for r in df.select(search.beam(F.col("p"), 2)).collect()] == [["ac", "ad"], [""]]
    w = spark.createDataFrame([("the,", ["the", "thc"]), ("a", ["b", "a"]), ("x", ["y"])], "truth string, cands array<string>")
    assert tuple(search.recall_at(w).first())[:4] == (3, 1, 2, 2)


def test_alternatives_keep_their_order_where_equal(spark):
    df = spark.createDataFrame([([("a", 1.0), ("b", 5.0), ("c", 1.0), ("d", 5.0)],)], "a array<struct<ch:string,conf:double>>")
    assert [x["ch"] for x in df.select(search.by_confidence(F.col("a")).alias("x")).first()["x"]] == ["b", "d", "a", "c"]


def test_phrase_search(spark):
    c = spark.createDataFrame([("1", "big red dog"), ("1", "big red dog"), ("2", "red big dog"), ("3", None), ("4", "")], "id string, candidates string")
    i = search.token_index(c)
    assert i.where("id = '1'").count() == 3
    assert rows(search.phrase_ids(i, 'Red "dog')) == [("1",)]
    assert rows(search.phrase_ids(i, "big")) == [("1",), ("2",)]
    assert search.phrase_ids(i, '"').count() == 0


def test_missing_spaces(spark):
    t = spark.createDataFrame([("v", m, p, l, w, h) for m in ("stock", "ftm") for p, (l, w, h) in enumerate([(0, "abc", False), (0, "defg", False), (1, "x", False)])], "verse_key string, model string, pos int, line_no int, token string, hyphenated boolean")
    raw = spark.createDataFrame([("v", "“ab-c-defg,")], "verse_key string, word string")
    assert rows(verses.missing_spaces(t, raw)) == [("v", "“ab-c-defg,", "“ab-c -defg,")]
    w = spark.createDataFrame([("v", "abcdefg"), ("v", "short")], "verse_key string, word string")
    assert rows(verses.missing_spaces(t, w)) == [("v", "abcdefg", "abc defg")]
    lines = spark.createDataFrame([("v", "z abcdefg z"), ("u", "abcdefg")], "verse_key string, label string")
    got = rows(verses.apply_splits(lines, verses.missing_spaces(t, w), "label").select("label", "changed"))
    assert got == [("abcdefg", False), ("z abc defg z", True)]


def test_columns(spark):
    b = [("p", 1000, 1000, i, [x, y, x + 200.0, y + 20.0]) for i, (x, y) in enumerate([(10.0, 0.0), (500.0, 0.0), (20.0, 30.0), (15.0, 60.0)])]
    df = spark.createDataFrame(b, "page_id string, page_width int, page_height int, block_ord int, bbox array<double>")
    assert rows(manifest.column_boxes(manifest.running_groups(df)).select("column_index", "xmin", "ymax", "blocks")) == [(0, 10.0, 80.0, 3)]


def test_heights(spark):
    def scaled(h, pad=3, target=30):
        return h if h <= 45 else h + 2 * int(pad / (target / h))

    hs = [51, *range(52, 200)]
    df = spark.createDataFrame([(scaled(h),) for h in hs if scaled(h) > 51], "c int").select(manifest.unscaled_height(F.col("c")).alias("u"), "c").select("c", "u.height")
    assert all(scaled(r["height"]) == r["c"] for r in df.collect())


def test_golden_aggregates(spark):
    c = spark.createDataFrame([("a", "a", "match", 28683), ("a", "b", "substitution", 381), ("a", "", "deletion", 406), ("", "a", "insertion", 195)], "t string, p string, op string, n long")
    r = stats.confusion_rates(c).first()
    assert (r["truth"], r["match_pct"], r["substitution_pct"], r["deletion_pct"], r["insertion_pct"]) == (29470, 97.33, 1.29, 1.38, 0.66)
    d = spark.createDataFrame([("]", "", "deletion", 20), ("]", "]", "match", 2)], "t string, p string, op string, n long")
    assert stats.deletion_rates(d).first()["rate"] == 90.91
    assert spark.createDataFrame([(x,) for x in (1.0, 2.0, 4.0, 9.0)], "x double").agg(F.median("x")).first()[0] == 3.0
    m = stats.confusion_matrix(stats.confusion_cells(c, ["a", "b", "A"]), ["a", "b", "A"])
    got = {r["truth"]: (r["u0061"], r["u0062"], r["u0041"], r["del"]) for r in m.collect()}
    assert got == {"a": (28683, 381, 0, 406), "b": (0, 0, 0, 0), "A": (0, 0, 0, 0), "<ins>": (195, 0, 0, 0)}


def test_schedules_and_choices(spark):
    assert [round(r[1], 6) for r in sweep.schedule(spark, 5, 0.002, 0.5, 2, "step", 10).collect()] == [0.002, 0.002, 0.001, 0.001, 0.0005]
    f = spark.createDataFrame([(0, "a_1_100.checkpoint"), (1, "b_1_300.checkpoint")], "ord long, path string")
    assert sweep.nearest_checkpoint(f, 200).first()["path"].startswith("a")  # the first of equals
    assert sweep.nearest_checkpoint(f.where("false"), 200).count() == 0
    g = spark.createDataFrame([(0, 0.5), (1, 0.9), (2, 0.9)], "ord long, accuracy double")
    assert sweep.best_point(g).first()["ord"] == 1
    assert sweep.binarisations(spark).count() == 17


def test_readers(spark, tmp_path):
    m = {"a": {"label": "x", "line_bbox": [1, 2, 3, 4]}, "b": {"status": "Error", "label": ""}}
    (tmp_path / "m.json").write_text(json.dumps(m))
    got = readers.json_map(spark, str(tmp_path / "m.json")).select("ord", "id", "label", "status").collect()
    assert [tuple(r) for r in got] == [(0, "a", "x", None), (1, "b", "", "Error")]
    assert readers.json_list(spark, str(tmp_path / "none.json")).count() == 0
    shapes = ['[{"verse_key":"1","original_word":"w"}]', '["1:w"]', '{"1":["w"]}', '{"1":"w"}', "[]"]
    df = spark.createDataFrame([(x,) for x in shapes], "value string")
    assert rows(readers.exclusion_rows(df, "value")) == [("1", "w")]
    for x in shapes[:4]:
        assert rows(readers.exclusion_rows(spark.createDataFrame([(x,)], "value string"), "value")) == [("1", "w")]
    cfg = spark.createDataFrame([('{"total_epochs": 5, "unknown": 1}',)], "value string")
    assert readers.config_rows(cfg, "value", {"total_epochs": ("INT", 12), "learning_rate": ("DOUBLE", 0.0005)}).first() == (5, 0.0005)
    sw = spark.createDataFrame([('{"experiments": [{"id": "e", "config": {"total_epochs": 3, "x": 1}, "eval_epochs": [1, 2]}]}',)], "value string")
    assert readers.sweep_rows(sw, "value", "total_epochs: INT").first()["config"]["total_epochs"] == 3
    html = '<table border="1"><tr><th><img src="a.png"></th><th>eng<b>no</b></th><th> chr </th><th>pho</th></tr></table><table><th></th></table>'
    v = spark.createDataFrame([(html,), (None,)], "h string").select(readers.verse_tables("h").alias("v")).collect()
    assert v[0]["v"][0]["english"] == "eng" and v[0]["v"][0]["cherokee"] == "chr" and v[1]["v"] == []
    hocr = "<span class='ocrx_word'><span class='ocrx_cinfo' id='lstm_choices_1'><span class='ocrx_cinfo' id='choice_1' title='x_confs 9.5'>a</span><span class='ocrx_cinfo' id='choice_2' title='x_confs bad'>b</span><span class='ocrx_cinfo' id='choice_3' title='x_confs 20'>c</span></span></span>"
    w = spark.createDataFrame([(hocr,)], "h string").select(readers.lattices("h").alias("w")).first()["w"]
    assert [(o["ch"], o["conf"]) for o in w[0][0]] == [("c", 20.0), ("a", 9.5), ("b", 0.0)]
    voc = spark.createDataFrame([(0, "5"), (1, "NULL 0"), (2, "x 1 # Ꭰ [1]"), (3, "b 3"), (4, "|Broken|0|1 f")], "n int, value string")
    assert {r[0] for r in readers.vocabulary_rows(voc, "value", "n").collect()} == {"Ꭰ", "b", " ", "\t", "\n", "\r"}
    (tmp_path / "gt").mkdir()
    (tmp_path / "gt" / "l1.gt.txt").write_text("  hi \n")
    assert rows(readers.ground_truth(spark, str(tmp_path / "gt"))) == [("l1", "hi")]
    for f in ("a.png", "b.txt", "bbox_overlay_c.png"):
        (tmp_path / "gt" / f).write_bytes(b"x")
    assert readers.scans(spark, str(tmp_path / "gt")).count() == 1
    tsv = "level\tpage_num\tblock_num\tpar_num\tline_num\tword_num\tleft\ttop\twidth\theight\tconf\ttext\n4\t1\t1\t1\t1\t0\t10\t20\t30\t40\t-1\t\n5\t1\t1\t1\t1\t1\t0\t0\t1\t1\t90\ta\n"
    assert rows(readers.box_rows(spark.createDataFrame([(tsv,)], "t string"), "t")) == [(10, 20, 40, 60)]
    assert readers.book_range("01-03,7") == [1, 2, 3, 7]
    assert readers.log_rows(spark.createDataFrame([("x",)], "value string"), "value").count() == 0
    rep = "Main Test Set (10 lines):\n  Mean CER: 5.1%\n  Mean WER: 9.0%\nOverall (12 lines total):\n  Weighted Mean CER: 4.0%\n  Weighted Mean WER: 8.5%\n"
    r = spark.createDataFrame([(rep,), ("",)], "t string").select(readers.report_rates(F.col("t")).alias("r")).collect()
    assert [tuple(x) for x in r[0]["r"]] == [("Main Test Set", 10, 5.1, 9.0), ("Overall", 12, 4.0, 8.5)] and r[1]["r"] == []


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, float("nan"), [1, 2])], "a int, b double, c array<int>")
    sinks.json_records(df, str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).columns == ["a", "b", "c"]
    sinks.csv_report(df, str(tmp_path / "c"))
    assert spark.read.option("header", True).csv(str(tmp_path / "c")).first()["c"] == "1,2"
    (tmp_path / "v").mkdir()
    for _ in range(3):
        last = sinks.versioned(df, str(tmp_path / "v"))
    assert sinks.current(spark, str(tmp_path / "v")) == last and len(list((tmp_path / "v").iterdir())) == 2
    t = spark.createDataFrame([("s", "ᎠᎡ", 10, 20)], "stem string, text string, width int, height int")
    sinks.write_files(sinks.triplets(t), str(tmp_path / "t")).collect()
    assert (tmp_path / "t" / "s.box").read_text() == "WordStr 0 0 10 20 0 #ᎠᎡ\n\t 0 0 10 20 0\n"
    assert "| 1 | N/A |" in sinks.markdown(df.select("a", "b"), "t")
    assert spark.range(1).select(sinks.with_script(F.lit("<body></body>"), "<script/>")).first()[0] == "<body><script/></body>"


def test_images():
    rng = np.random.default_rng(3)
    g = np.full((60, 80), 230, np.uint8)
    g[20:24, 10:70] = 20
    assert set(np.unique(images.binarise(g, "otsu"))) == {0, 255}
    for algo in ("sauvola", "wolf_w15_k0.1"):
        b = images.binarise(g, algo)
        assert b[22, 40] == 0 and b[50, 40] == 255
    assert (images.binarise(g, "unknown") == g).all()
    a = rng.integers(0, 255, (9, 11)).astype(np.uint8)
    mean, dev = images.local_moments(a, 3)
    assert mean[4, 5] == pytest.approx(a[3:6, 4:7].mean()) and dev[4, 5] == pytest.approx(a[3:6, 4:7].std())
    assert abs(images.skew(images.rotate(g, 3.0), 10, 81) + 3.0) <= 0.5
    assert images.to_height(g).shape == (42, 56) and images.shrunk(np.zeros((4800, 100), np.uint8)).shape[0] == 2400
    assert images.odd_window(15, (8, 8)) == 9 and images.odd_window(14, (80, 80)) == 13


def test_stream_enriches_once_and_resumes(spark, tmp_path):
    src, out, ck = (str(tmp_path / x) for x in ("src", "out", "ck"))
    spark.createDataFrame([("a", "x"), ("b", "y"), ("a", "x")], "id string, t string").write.parquet(src)
    schema = spark.read.parquet(src).schema
    how = lambda df: df.withColumn("text", F.upper("t"))
    incremental.enrich(incremental.lines_stream(spark, src, schema), how, out, ck).awaitTermination(120)
    spark.createDataFrame([("b", "y"), ("c", "z")], "id string, t string").write.mode("append").parquet(src)
    incremental.enrich(incremental.lines_stream(spark, src, schema), how, out, ck).awaitTermination(120)
    assert rows(spark.read.parquet(out).select("id", "text")) == [("a", "X"), ("b", "Y"), ("c", "Z")]


def test_recognition_backend(spark):
    df = spark.createDataFrame([("a", bytearray(b"1")), ("b", bytearray(b""))], "id string, content binary")
    got = incremental.recognised(df, lambda: lambda items: [(x.decode(), 90.0) if x else None for x in map(bytes, items)])
    assert rows(got.select("id", "text", "confidence")) == [("a", "1", 90.0), ("b", "Error", 0.0)]


def test_empty_tables(spark):
    m = spark.createDataFrame([], "id string, ord long, source_scan string, status string, label string, initial_ocr string")
    assert manifest.transfer_labels(m, m).count() == 0
    assert splits.every_nth_split(m, "ord").count() == 0
    assert manifest.latest(m, "id", "ord").count() == 0


def test_image_variants_and_contrast():
    rng = np.random.default_rng(1)
    g = rng.integers(60, 160, (40, 90)).astype(np.uint8)
    got = dict(images.variants(g, 5))
    assert len(got) == 12 and all(a.shape == g.shape and a.dtype == np.uint8 for a in got.values())
    assert all((a == b).all() for a, b in zip(got.values(), dict(images.variants(g, 5)).values()))
    assert (got["plain"] == g).all() and sum((a == g).all() for a in got.values()) == 1
    assert got["ink0"].mean() < g.mean() < got["ink1"].mean()
    # brute force
    p = np.pad(g, 1, mode="edge")
    least = np.min([p[y : y + 40, x : x + 90] for y in range(3) for x in range(3)], axis=0)
    assert (images.eroded(g) == least).all() and (images.opened(g) <= g).all() and (images.closed(g) >= g).all()
    speck = np.zeros((20, 20), np.uint8)
    speck[5, 5] = 255
    assert images.opened(speck).sum() == 0
    # one tile without a limit is the usual equalisation
    one = images.equalised(g, 1, 1e9)
    cdf = np.cumsum(np.bincount(g.reshape(-1), minlength=256)) * 255 / g.size
    assert (one == np.rint(cdf[g]).astype(np.uint8)).all()
    assert images.equalised(g).std() > g.std() and images.normalised(g).shape == g.shape
    flat = np.full((30, 30), 200, np.uint8)
    flat[10:14, 5:25] = 30
    b = images.adaptive(flat, 16, 10)
    assert set(np.unique(b)) == {0, 255} and (b[11:13, 6:24] == 0).all() and (b[25:, :] == 255).all()
    assert images.equalised(np.zeros((1, 1), np.uint8)).shape == (1, 1)


@pytest.mark.parametrize("least", [0.75, 0.9, 0.6])
def test_similar_lines_lose_no_pair(spark, least):
    import difflib
    import random

    rng = random.Random(12)
    base = ["".join(rng.choices("abcdefgh ", k=rng.choice([3, 6, 9, 12, 16, 20, 40]))) for _ in range(25)]

    def near(t):
        t = list(t)
        for _ in range(rng.randint(0, max(1, len(t) // 3))):
            i = rng.randrange(len(t))
            t[i : i + rng.randint(0, 1)] = rng.choice(["", "x", "yz", "a"])
            t = t or ["a"]
        return "".join(t)

    a = [(rng.choice("st"), i, "o", near(rng.choice(base))) for i in range(120)]
    b = [(rng.choice("st"), i, "n", near(rng.choice(base))) for i in range(120)]
    kind = "scan string, ord int, id string, text string"
    got = {(r["a_ord"], r["b_ord"]): round(r["ratio"], 9) for r in manifest.similar_lines(spark.createDataFrame(a, kind), spark.createDataFrame(b, kind), least).collect()}
    want = {}
    for s, i, _, x in a:
        for t, j, _, y in b:
            if s == t and (q := difflib.SequenceMatcher(None, x, y).ratio()) > least:
                want[i, j] = round(q, 9)
    assert len(want) > 50 and got == want
