"""One consistent form of look-alike text."""

import random
import unicodedata

import pytest

from linecorpus.llm import forms

CASES = [
    ("ᏩᏥJᎨ ᏜEᏮ", "ᏩᏥᎫᎨ ᏜᎬᏮ"),
    ("ｆｒｏｍ，", "from,"),
    ("offiﬃce ﬁsh", "offifficefish".replace("fish", " fish")),
    ("û é", "û é"),
    ("ậb", "ậb"),
    ("ậb", "ậb"),
    ("Ꮫ‍﻿­Ꮿ", "ᏛᏯ"),
    ("a b　c", "a b c"),
    ("school‐house ‑", "school-house -"),
    ("SweeТly мark", "SweeTly мark"),
    ("ᎢHAT MEМBERS", "THAT MEMBERS"),
    ("ᎸᎮ Vb ᏥᏰ", "ᎸᎮ ᏙᏏ ᏥᏰ"),
    ("ᎸᎮ THE OF", "ᎸᎮ THE OF"),
    ("ᏕᏫᏦ6Ꮖ 46 4", "ᏕᏫᏦᏮᏆ 46 4"),
    ("Ꭰ — a – b § ¬", "Ꭰ — a – b § ¬"),
    ("ꮳꮩ Abc  two   spaces\nline", "ꮳꮩ Abc  two   spaces\nline"),
    ("", ""),
    (None, None),
    ("𝐛𝐨𝐥𝐝", "bold"),
]


@pytest.mark.parametrize(("text", "want"), CASES)
def test_python_form(text, want):
    assert forms.canonical(text) == want


def test_spark_form_equals_python(spark):
    rng = random.Random(9)
    pool = list("ᎠᎡᏔᎳMKRHWVb46id aeTHE \n") + ["u", "̂", "̣", "ｆ", "ﬁ", "‍", "　", "‐", "е", "К", "ꭰ", "𝐚", ",", "é"]
    rows = [(i, t, "x") for i, (t, _) in enumerate(CASES)] + [(1000 + i, "".join(rng.choices(pool, k=rng.randint(0, 14))), None) for i in range(800)] + [(5000, "Ꭰ" * 20000 + "M", "y")]
    df = spark.createDataFrame(rows, "k int, pos string, form string".replace("pos", "t"))
    got = forms.canonical_forms(df, ["k"], "t").collect()
    assert len(got) == len(rows)
    for r in got:
        assert r["form"] == forms.canonical(r["t"]), r


def test_clashing_column_names(spark):
    df = spark.createDataFrame([("1", 7, "ᏩᏥJᎨ")], "cp string, pos int, text string")
    assert forms.canonical_forms(df, ["cp", "pos"], "text").first()["form"] == "ᏩᏥᎫᎨ"


def test_empty_table(spark):
    df = spark.createDataFrame([], "k string, text string")
    assert forms.canonical_forms(df, ["k"], "text").count() == 0


def test_known_terms_settle_two_look_alikes():
    assert forms.canonical("WᎻᏊ") == "ᏔᎻᏊ"
    assert forms.canonical("WᎻᏊ", {"ᎳᎻᏊ"}) == "ᎳᎻᏊ"


def test_spark_settles_like_python(spark):
    terms = ["ᎳᎻᏊ", "ᏏᎻᏚ", "ᏔᏒ", "ᏚᎽᎩ", "ᎡᏒᎡ", "ᎢᎢ"]
    texts = ["WᎻᏊ", "bᎻS dᏒ", "ᏔᎻᏊ WᎻᏊ, ᎡRE", "ᏔR.", "SYᎩ ᏚYY", "ᎡRᎡ\n(WᎻᏊ)", "W Ꭰ", None, "ᎠK"]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, text string")
    known = spark.createDataFrame([(t, "chr") for t in [*terms, None]], "term string, lang string")
    for r in forms.canonical_forms(df, ["k"], "text", known=known).collect():
        assert r["form"] == forms.canonical(r["text"], set(terms)), r


def test_form_is_stable():
    for t, _ in CASES:
        assert forms.canonical(forms.canonical(t)) == forms.canonical(t)


def usual(ch):
    """Neither another form of a usual character nor a look-alike."""
    return ch not in forms.LOOKS_LATIN and unicodedata.category(ch) not in ("Cf", "Zs", "Cs", "Cn", "Co") and unicodedata.normalize("NFKC", ch) == unicodedata.normalize("NFC", ch) and ch not in forms.HYPHENS and forms.plain_map().get(ch, ch) == unicodedata.normalize("NFC", ch)


def canonically_equal():
    """Characters that decompose, alone and with marks in any order, and letters that compose without marks."""
    rng = random.Random(4)
    composed = [chr(cp) for cp in range(0xC0, 0x20000) if unicodedata.decomposition(chr(cp)) and unicodedata.decomposition(chr(cp))[0] != "<" and usual(chr(cp))]
    marks = [m for m in forms.mark_classes() if usual(m)]
    texts = ["\u00e9\u0327", "e\u0327\u0301", "\u00e2\u0323", "\u1ead", "\u304b\u3099", "\u1112\u1161\u11ab", "\ud55c", "\u0344", "\u0958", "\u0915\u093c", "\u09c7\u09be", "\u212b", "a\u0300\u0315\u0300", "\u0301\u0327", "\u1100\u1161\u0301\u11a8", "\U0001d15e"]
    texts += [unicodedata.normalize("NFD", c) for c in composed[::3]] + composed[1::3]
    for _ in range(1500):
        texts.append("".join(rng.choice([rng.choice("aeoAEO "), rng.choice(composed), rng.choice(marks), "\u1100", "\u1161", "\u11a8", "\uac00"]) for _ in range(rng.randint(1, 7))))
    return [t for t in texts if not any(c in forms.LOOKS_LATIN for c in unicodedata.normalize("NFD", t))]


def test_python_form_is_nfc_on_all_of_unicode():
    for cp in range(0x20, 0x110000):
        ch = chr(cp)
        if usual(ch):
            assert forms.canonical(ch) == unicodedata.normalize("NFC", ch), hex(cp)
    for t in canonically_equal():
        assert forms.canonical(t) == unicodedata.normalize("NFC", t), t.encode("unicode-escape")


def test_spark_form_is_nfc(spark):
    texts = canonically_equal()
    df = spark.createDataFrame(list(enumerate(texts)), "k int, t string")
    got = {r["t"]: r["form"] for r in forms.canonical_forms(df, ["k"], "t").collect()}
    assert {t: got[t] for t in texts} == {t: unicodedata.normalize("NFC", t) for t in texts}


@pytest.mark.parametrize(("text", "want"), [("\u2460 \u2163 x\u00b2 \U0001f130", "1 IV x2 A"), ("\ufe8d", "\u0627"), ("\u00bd \u2026", "\u00bd \u2026"), ("\ua4d0\u0251\u0131\u0578", "Bain")])
def test_other_dress(spark, text, want):
    assert forms.canonical(text) == want
    assert forms.canonical_forms(spark.createDataFrame([(1, text)], "k int, t string"), ["k"], "t").first()["form"] == want


def test_many_doubtful_letters_are_settled(spark):
    term, other = "ᎳᎰ" * 10, "ᏔᎰ" * 10 + "Ꭰ"
    text = "Ꮿ " + "WᎰ" * 10 + "."
    assert forms.canonical(text, frozenset({term, other})) == f"Ꮿ {term}."
    known = spark.createDataFrame([(term, "chr"), (other, "chr")], "term string, lang string")
    assert forms.canonical_forms(spark.createDataFrame([(1, text)], "k int, t string"), ["k"], "t", known=known).first()["form"] == f"Ꮿ {term}."


def test_two_terms_of_the_same_letters(spark):
    terms = {"ᏔᏒ", "ᎳᏒ"}
    known = spark.createDataFrame([(t, "chr") for t in terms], "term string, lang string")
    for text in ("ᎳᏒ ᎳR Ꭰ", "ᏔR", "WᏒ"):
        assert forms.canonical_forms(spark.createDataFrame([(1, text)], "k int, t string"), ["k"], "t", known=known).first()["form"] == forms.canonical(text, frozenset(terms))
