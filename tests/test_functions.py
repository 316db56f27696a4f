"""Strings, rates and alignments against brute force and case tables."""

import random
import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from linecorpus.functions import metrics, sequences, text
from linecorpus.operators import verses


def one(spark, column, **values):
    schema = ", ".join(f"{k} {'double' if isinstance(v, float) else 'int' if isinstance(v, int) else 'string'}" for k, v in values.items())
    return spark.createDataFrame([tuple(values.values())], schema).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("given_", "want"),
    [("ä", "Ä"), ("ꭰꭱꭲꭳꭴ", "ᎠᎡᎢᎣᎤ"), ("  Hello \t World \n Cherokee \t\t  ", "HELLO WORLD CHEROKEE"), ("", ""), (None, ""), ("straße", "STRASSE"), ("a b", "A B"), ("a\u001cb", "A B")],
)
def test_normal_form(spark, given_, want):
    assert one(spark, text.normalize_truth(F.col("t")), t=given_) == want


def test_normal_form_like_python(spark):
    rng = random.Random(4)
    pool = [chr(c) for c in [*range(0x20, 0x180), *range(0x300, 0x310), *range(0x13A0, 0x13F6), *range(0x2000, 0x2030), 0x3000, 0x85, 0xAB70]]
    rows = [("".join(rng.choices(pool, k=rng.randint(0, 30))),) for _ in range(300)]
    df = spark.createDataFrame(rows, "t string")
    for t, got in df.select("t", text.normalize_truth(F.col("t")).alias("x")).collect():
        assert got == " ".join(unicodedata.normalize("NFC", t).upper().split())


@pytest.mark.parametrize(("t", "o", "want"), [(0, 0, "Empty"), (39, 61, "English"), (40, 60, "Mixed"), (45, 55, "Mixed"), (46, 54, "Cherokee")])
def test_script_class(spark, t, o, want):
    assert one(spark, text.script_class(F.col("t")), t="Ꭰ" * t + "a" * o) == want


@pytest.mark.parametrize(("truth", "read", "cer", "wer"), [("", "", 0, 0), ("", "x", 100, 100), ("ABC", "ABD", 33.33, 100), ("A", "WXYZ", 100, 100), ("A B C", "a  b c", 0, 0), (None, None, 0, 0)])
def test_rates(spark, truth, read, cer, wer):
    assert one(spark, metrics.cer(F.col("a"), F.col("b")), a=truth, b=read) == pytest.approx(cer, abs=0.01)
    got = metrics.rated(spark.createDataFrame([(truth, read)], "a string, b string"), "a", "b").first()
    assert (got["cer"], got["wer"]) == (pytest.approx(cer, abs=0.01), pytest.approx(wer, abs=0.01))


def test_viewer_rate_is_neither_normalised_nor_capped(spark):
    assert one(spark, metrics.viewer_cer(F.col("a"), F.col("b")), a="a", b="AAAA") == 400.0


def test_word_distance(spark):
    rng = random.Random(2)
    rows = [(rng.choices("abcd", k=rng.randint(0, 6)), rng.choices("abcd", k=rng.randint(0, 6))) for _ in range(150)]
    df = spark.createDataFrame(rows, "a array<string>, b array<string>")
    for a, b, d in df.select("a", "b", metrics.word_distance(F.col("a"), F.col("b")).alias("d")).collect():
        assert d == sequences.edit_table(a, b)[-1][-1]


short = st.text(alphabet="abcᎠᎡ", max_size=9)


@settings(max_examples=150, deadline=None)
@given(short, short)
def test_alignment_invariants(a, b):
    ev = sequences.align(a, b)
    assert "".join(t for t, _, _ in ev) == a and "".join(p for _, p, _ in ev) == b
    n = {op: sum(e[2] == op for e in ev) for op in ("match", "substitution", "deletion", "insertion")}
    assert n["match"] + n["substitution"] + n["deletion"] == len(a)
    assert n["substitution"] + n["deletion"] + n["insertion"] == verses.distance(a, b)
    marks = sequences.lcs_marks(a, b)
    assert "".join(t for t, _, _ in marks) == a and "".join(p for _, p, _ in marks) == b


@settings(max_examples=60, deadline=None)
@given(short, short)
def test_vote_of_two_against_one(a, b):
    assert sequences.vote(a, a, a) == a
    assert len(sequences.vote(a, b, b)) >= len(b) - abs(len(a) - len(b))


def test_confidence_without_sentinel(spark):
    df = spark.createDataFrame([([-1.0, 80.0, 91.0],), ([-1.0],), ([],)], "c array<double>")
    assert [r[0] for r in df.select(metrics.mean_confidence(F.col("c"))).collect()] == [85.5, 0.0, 0.0]


def test_names(spark):
    assert one(spark, text.line_name(F.col("s"), F.lit(1), F.lit(7)), s="1828-02-21/seq-4.jp2") == "1828-02-21_seq-4_col_01_line_007"
    assert one(spark, text.document_of(F.col("s")), s="cnt_01_010101_line_00") == "cnt_01_010101"
    assert one(spark, text.line_of(F.col("s")), s="1828-02-21_seq-4_col_01_line_007_x") == "line_007"
    assert one(spark, text.document_of(F.col("s")), s="other") == "unknown_doc"
    assert one(spark, text.checkpoint_iteration(F.col("s")), s="a/chr_9.7_10_2600.checkpoint") == 2600
    assert one(spark, text.url_parts(F.col("s"))["date"], s=" https://x.org/lccn/sn1/1828-02-21/ed-1/seq-1/ junk") == "1828-02-21"
    assert one(spark, text.url_parts(F.col("s")), s="no url") is None
    assert one(spark, text.numbered(F.lit("7"), F.col("s"), F.lit(True)), s="") == "7"
    assert one(spark, text.image_title(F.col("s"), F.lit("b.png")), s='title=\'image "a.png"; x\'') == 'title=\'image "b.png"; x\''


def test_partition_and_hyphens():
    rng = random.Random(5)
    for _ in range(80):
        words = ["".join(rng.choices("abc", k=rng.randint(1, 4))) for _ in range(rng.randint(0, 7))]
        lines = ["".join(rng.choices("abc ", k=rng.randint(0, 9))) for _ in range(rng.randint(1, 3))]
        got = verses.partition(words, lines)
        assert len(got) == len(lines) and " ".join(x for x in got if x).split() == words
        cost = lambda seg: sum(verses.distance(a, b) for a, b in zip(seg, lines))  # noqa: E731, B023

        def every(k, w):
            if k == 1:
                yield [" ".join(words[w:])]  # noqa: B023
                return
            for e in range(w, len(words) + 1):  # noqa: B023
                for r in every(k - 1, e):
                    yield [" ".join(words[w:e]), *r]  # noqa: B023

        assert cost(got) == min(map(cost, every(len(lines), 0)))
    words = ["alpha", "beta", "wonderful", "gamma"]
    got = verses.align_words(words, ["alpha beta wonder-", "ful gamma"])
    assert got == ["alpha beta wonder-", "ful gamma"]
    assert verses.align_words(words, []) == []
