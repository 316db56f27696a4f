"""The prefilter of canonical forms leaves out no text that would change."""

import random
import re

import pytest

from linecorpus.llm import forms

TEXTS = ["ᎻILL COUNTY LEAF 59", "Ꭲsugè quehiquowuquìnvti", "Ꭱeport.", "oᎻ", "Ꭰ.b", "b'ᎠᎢ", "ᎸᎮ V.b ᏥᏰ", "ᎸᎮ 4-V"]


def everything(monkeypatch, texts):
    with monkeypatch.context() as m:
        m.setattr(forms, "_SUSPECT", re.compile(""))
        return [forms.canonical(t) for t in texts]


def test_python_prefilter_changes_nothing(monkeypatch):
    rng = random.Random(3)
    pool = list("ᎠᎡᏔᎻᎢᎫKRHWVb46id aeTHEnO7 \n.,-\'")
    texts = TEXTS + ["".join(rng.choices(pool, k=rng.randint(1, 9))) for _ in range(30000)]
    for t, want in zip(texts, everything(monkeypatch, texts)):
        assert forms.canonical(t) == want, t


@pytest.mark.parametrize(("text", "want"), [("ᎻILL COUNTY LEAF 59", "HILL COUNTY LEAF 59"), ("Ꭱeport.", "Report.")])
def test_look_alike_beside_any_latin_letter(text, want):
    assert forms.canonical(text) == want


def test_spark_prefilter_changes_nothing(spark, monkeypatch):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "k int, t string")
    got = {r["t"]: r["form"] for r in forms.canonical_forms(df, ["k"], "t").collect()}
    assert [got[t] for t in TEXTS] == everything(monkeypatch, TEXTS)
