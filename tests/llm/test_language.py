"""Language profiles: held-out accuracy and the classes of texts."""

import random

import pytest

from linecorpus.llm import language
from linecorpus.llm.hyper import Profiles, spell
from linecorpus.llm.queries import language_rows
from linecorpus.plans.tables import table


@pytest.fixture(scope="module")
def trained(spark, data):
    lex = [tuple(r) for r in table(spark, data, "lexicon").select("term", "lang").orderBy("term", "lang").collect()]
    sam = [tuple(r) for r in table(spark, data, "lang_samples").orderBy("sample_id").select("text", "lang").collect()]
    random.Random(1).shuffle(lex)
    n = int(0.8 * len(lex))
    return language.Judge.train(lex[:n], sam[:200]), lex[n:], sam[200:]


def test_held_out_words(trained):
    judge, lex, _ = trained
    right = sum((judge.margin(w) > 0) == (lang == "en") for w, lang in lex)
    assert right / len(lex) > 0.985


def test_held_out_lines(trained):
    judge, _, sam = trained
    wrong = [t for t, lang in sam if judge.judge(t)[0] != lang]
    assert len(wrong) <= 0.02 * len(sam)


def test_classes(trained):
    judge = trained[0]
    assert judge.judge(None)[0] == judge.judge("")[0] == judge.judge(" 12 — [3] ")[0] == "Empty"
    assert judge.judge("the farmers and the letters of the village")[0] == "English"
    assert judge.judge("ᎠᎡᎢ ᎣᎤᎥ ᎦᎧᎨ")[0] == "Cherokee"
    # a name counts for neither language
    assert judge.judge("ᎠᎡᎢ ᎣᎤᎥ Tholurstoke ᎦᎧᎨ")[0] == "Cherokee"
    lang, conf, segs = judge.judge("the letters of the village ᎠᎡᎢ ᎣᎤᎥ ᎦᎧᎨ ᎩᎪᎫ", segments=True)
    assert lang == "Mixed" and 0 < conf <= 1 and [s[0] for s in segs] == ["English", "Cherokee"]
    assert judge.judge("the " * 30000)[0] == "English"


def test_columns_and_rows(spark, data, trained):
    judge = spark.sparkContext.broadcast(trained[0])
    df = spark.createDataFrame([(1, None, "x"), (2, "", None), (3, "the letters of the village", "en"), (3, "the letters of the village", "Error")], "language int, text string, recorded string").withColumnRenamed("language", "k")
    got = language.languages(df, judge, "text").collect()
    assert [r["language"] for r in got] == ["Empty", "Empty", "English", "English"]
    assert sorted(r["recorded"] or "" for r in language.wrong_labels(df, judge, "text", "recorded").collect()) == ["", "Error", "x"]
    assert language.languages(df.where("false"), judge, "text").count() == 0


def test_clashing_names(spark, trained):
    judge = spark.sparkContext.broadcast(trained[0])
    df = spark.createDataFrame([(1, "the letters of the village", "Cherokee", 0.5)], "segments int, text string, language string, confidence double")
    assert language.languages(df, judge, "text").first()["language"] == "English"
    assert language.wrong_labels(df, judge, "text", "language").count() == 1


def test_text_without_spaces(trained):
    judge = trained[0]
    assert judge.judge("thefarmersandthelettersofthevillage" * 500)[0] == "English"
    assert judge.judge("tsulehasdinohiyasgawidvgetsadosi" * 500)[0] == "Cherokee"


def test_most_recorded_labels_agree(spark, data, trained):
    judge = spark.sparkContext.broadcast(trained[0])
    rows = language_rows(spark, data)
    n, wrong = rows.count(), language.wrong_labels(rows, judge, "text", "recorded").count()
    assert 0 < wrong < 0.2 * n


def test_profiles_of_nothing():
    p = Profiles.train({"a": [], "b": []}, dims=64)
    assert p.word("x").tolist() == [0.0, 0.0] and spell("É-l1ve") == "ELVE"
