"""Repair does the whole job: what tasks hold is bounded, what they know and learn is not."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from linecorpus.llm import forms, repair
from linecorpus.llm.channel import Channel, Spelling

LEXICON = ["letters", "village", "farmers", "nation", "ᎡᏌᎸ", "ᏔᏌᎸᎠ"]
# GREETEB and ᏒᏍᎸᎠ occur twice only, beside words one edit from them that are much commoner
TEXTS = ["the village greeted the farmers"] * 60 + ["ᎠᎡᎢᎣ ᏒᏌᎸᎠ nation"] * 40 + ["greeteb of the vi|lage-farmerz"] * 2 + ["ᎠᎡᎢᎤ ᎳᏍᎸᎠ farmerz ᏒᏍᎸᎠ"] * 2 + ["nations once"]
LINES = [
    "the greeteb village", "the greetes village", "the farmerz-greeteb of", "the farmerz-greetes of", "the vi|lage of", "the vi|llage of", "ᎠᎡᎢᎤ the", "ᎠᎡᎢᎥ ᎠᎡᎢᎣ", "RᏍᎸ ᎠᎡᎢᎣ", "RᏍᎸᎠ ᎠᎡᎢᎣ", "WᏍᎸᎠ ᎠᎡᎢᎣ",
    "WᏌᎸ ᎠᎡᎢᎣ", "the lettars", "the natiom once", "the gree-", "River Town Herald 7 greeteb", "", None,
]
READINGS = [("the farmers", "the farrners", None), ("greeteb of", "greeteh of", ""), ("ᎠᎡᎢᎤ RᏍᎸᎠ", "ᎠᎡᎢᎤ ᏒᏍᎸᎥ", None), ("the village", "the vi|llage", "the vi|lage")] * 5


def fitted(spark):
    lex = spark.createDataFrame([(w, "en") for w in LEXICON], "term string, lang string")
    docs = spark.createDataFrame([(t,) for t in TEXTS], "text string")
    lines = spark.createDataFrame([(f"River Town Herald {i}",) for i in range(5)], "text string")
    readings = spark.createDataFrame([(i, *r) for i, r in enumerate(READINGS)], "ord int, a string, b string, c string")
    return repair.fitted(spark, lex, docs, lines, "text", readings)


@pytest.mark.parametrize("held", [1, 9])
def test_words_that_tasks_do_not_hold_are_known(spark, monkeypatch, held):
    df = spark.createDataFrame(list(enumerate(LINES)), "k int, text string")

    def results():
        s = fitted(spark)
        channel, spelling, log_total = s.models.value
        faults = sorted(map(str, repair.faulty(df, s, ["k"], "text").collect()))
        texts = sorted(map(str, repair.mended(df, s, ["k"], "text").collect()))
        return len(s.lines.value.known) == s.vocabulary.count(), (faults, texts, channel.logs, channel.unseen, spelling.tri, spelling.ends, spelling.have, log_total)

    whole, want = results()
    assert whole
    monkeypatch.setattr(repair, "COMMON", held)
    whole, got = results()
    assert not whole
    assert got == want


def test_a_lexicon_of_any_size_is_taken(spark, monkeypatch):
    monkeypatch.setattr(repair, "MOST_TERMS", 3, raising=False)
    assert fitted(spark).vocabulary.where(F.col("word") == "NATION").count() == 1


def test_all_lines_read_several_times_are_learnt_from(spark):
    rng = random.Random(5)
    words = ["LETTERS", "VILLAGE", "FARMERS", "NATION"]
    rows = []
    for _ in range(12_000):
        w = rng.choice(words).lower()
        i = rng.randrange(len(w))
        rows.append((w, w[:i] + rng.choice("abcdxyz") + w[i + 1 :], None))
    rows += [("farmers", "farrners", None)] * 3
    lex = spark.createDataFrame([(w, "en") for w in words], "term string, lang string")
    none = spark.createDataFrame([], "text string")
    readings = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "ord int, a string, b string, c string")
    channel = repair.fitted(spark, lex, none, none, "text", readings).models.value[0]
    seen, letters = repair.learnt([r for r in rows if r[0] != r[1]], frozenset(words))
    want = Channel(seen, letters)
    assert ("M", "RN") in channel.logs
    assert (channel.logs, channel.unseen) == (want.logs, want.unseen)


def test_spelling_counts_all_stems(spark):
    tails = ["".join(t) for t in itertools.product("ABCDEFGHIJKLMNO", repeat=2)]
    words = [s + t for s in ("XAXA", "YBYB", "ZCZC") for t in tails] + ["ᎠᎡᎢᎣ", "ᎠᎡᎢᎤ", "A", "AB", "ABC"]
    one = Spelling([(w, 1) for w in words], 1e-4)
    # each of these stems has more than 200 endings
    assert one.ends["AB", "CD"] == 3
    many = repair.spelling(spark.createDataFrame([(w, 1) for w in words], "word string, n long"), len(words), 1e-4)
    assert (many.tri, many.bi, many.uni, many.ends) == (one.tri, one.bi, one.uni, one.ends)
    for known, word in (("XAXAAB", "XAXACD"), ("ᎠᎡᎢᎣ", "ᎠᎡᎢᎥ"), ("ABC", "ABD")):
        assert many.right(word, [known]) == pytest.approx(one.right(word, [known]))


def test_settling_terms_are_all_that_are_looked_for(spark):
    words = ["ᎡᏌᎸ", "ᏒᏌᎸ", "ᏔᎳᎠ", "ᏔᎳᏌᏌ", "ᎠᎢ", "VILLAGE"]
    rows = [(1, "RᏌᎸ ᎠᎢ", None), (2, None, "ᎠᎢ WWᏌᏌ"), (3, "the village", ""), (4, "ᎡᏌᎸ", "RᎠ ᎢᎠ"), (5, "ᏒᏌᎸ RᏌᎸ", "WᎳᎠ")]
    df = spark.createDataFrame(rows, "k int, a string, b string")
    got = {r["k"]: frozenset(r["terms"]) for r in forms.settling_terms(df, ["k"], ["a", "b"], spark.createDataFrame([(w,) for w in words], "word string")).collect()}
    assert got == {1: {"ᎡᏌᎸ", "ᏒᏌᎸ"}, 2: {"ᏔᎳᏌᏌ"}, 5: {"ᎡᏌᎸ", "ᏒᏌᎸ", "ᏔᎳᎠ"}}
    for k, *texts in rows:
        for t in texts:
            assert forms.canonical(t, got.get(k, frozenset())) == forms.canonical(t, frozenset(words))
