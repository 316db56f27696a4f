"""Queries do the whole job: no rows left out, no length at which another way is taken."""

import random

import pytest

from linecorpus.functions import sequences
from linecorpus.plans import catalog


def plain_vote(s):
    """The vote cell by cell."""
    moves = [(1, 1, 1), (1, 1, 0), (1, 0, 1), (0, 1, 1), (1, 0, 0), (0, 1, 0), (0, 0, 1)]
    letters = lambda at, m: [q[p - 1] for q, p, x in zip(s, at, m) if x]
    price = lambda chars: 1 if len(chars) == 1 else len(set(chars)) - 1
    cost = {(0, 0, 0): 0}
    ways = lambda at: ((m, tuple(p - x for p, x in zip(at, m))) for m in moves if all(p >= x for p, x in zip(at, m)))
    for i in range(len(s[0]) + 1):
        for j in range(len(s[1]) + 1):
            for k in range(len(s[2]) + 1):
                if i or j or k:
                    cost[i, j, k] = min(cost[back] + price(letters((i, j, k), m)) for m, back in ways((i, j, k)))
    at, out = tuple(map(len, s)), []
    while at != (0, 0, 0):
        m, at_ = next((m, back) for m, back in ways(at) if cost[at] == cost[back] + price(letters(at, m)))
        chars = letters(at, m)
        out.append(max(chars, key=lambda ch: (chars.count(ch), -chars.index(ch))))
        at = at_
    return "".join(reversed(out))


@pytest.mark.parametrize("kept", [48 << 20, 200])
def test_votes_equal_the_plain_vote(monkeypatch, kept):
    rng = random.Random(5)
    lines = [tuple("".join(rng.choices("abc "[: rng.randint(1, 4)], k=rng.randint(0, 9))) for _ in range(3)) for _ in range(200)]
    lines.append(("a" * 12, "b" * 14, "c" * 16))
    lines += [("a" * 31, "b" * 30, "c"), ("xx", "x", "x"), ("", "", "")]
    monkeypatch.setattr(sequences, "_KEPT", kept)
    assert sequences.votes(lines) == [plain_vote(s) for s in lines]


def test_long_lines_are_voted(spark):
    a, b, c = "x" + "ab" * 70, "y" + "ab" * 70, "y" + "ab" * 70
    df = spark.createDataFrame([(a, b, c)], "a string, b string, c string")
    assert df.select(sequences.majority(df.a, df.b, df.c)).first()[0] == b


def test_every_line_with_three_readings_is_voted(spark, data):
    m, o = (spark.read.parquet(f"{data}/{t}.parquet") for t in ("manifest_w_lang", "line_metadata"))
    want = m.join(o.selectExpr("id", "initial_ocr as third"), "id").where("initial_ocr is not null and ftm_ocr is not null and third is not null")
    want = {r["ord"]: r for r in want.select("ord", "label", "initial_ocr", "ftm_ocr", "third").collect()}
    got = {r["ord"]: r for r in catalog.queries()["dist07_three_way_vote"](spark, data).collect()}
    assert got.keys() == want.keys()
    assert any(r["ftm_ocr"] == r["third"] != r["initial_ocr"] for r in want.values())
    assert all((got[k]["ensemble_cer"] is not None) == bool(r["label"]) for k, r in want.items())
    rates = catalog.queries()["run15_ensemble_rates"](spark, data).first()
    known = [r for r in got.values() if r["base_cer"] is not None]
    assert rates["n"] == len(known)
    for c in ("base_cer", "ensemble_cer"):
        assert rates[c] == pytest.approx(sum(r[c] for r in known) / len(known), abs=1e-4)


@pytest.mark.parametrize(("name", "source", "groups"), [("split14_shuffled_all", "SELECT DISTINCT id FROM m WHERE label <> ''", 1), ("top05_all_newest_first", "SELECT id FROM u", 1), ("top06_all_viewer_orders", "SELECT ord FROM m", 5)])
def test_no_row_is_cut(spark, data, name, source, groups):
    for view, t in (("m", "manifest_w_lang"), ("u", "uploads")):
        spark.read.parquet(f"{data}/{t}.parquet").createOrReplaceTempView(view)
    n = spark.sql(source).count()
    ranks = sorted(r["rank"] for r in catalog.queries()[name](spark, data).select("rank").collect())
    assert ranks == sorted([*range(1, n + 1)] * groups)


def test_verse_order_reads_line_numbers_as_numbers(spark):
    from linecorpus.operators import splits, stats

    df = spark.createDataFrame([("cnt_01_010101_line_10", 1), ("cnt_01_010101_line_2", 2)], "id string, ord int")
    assert [r["ord"] for r in splits.placed(stats.ordered(df, "verse", "ord")).orderBy("rank").collect()] == [2, 1]
