"""Term counts against brute force; pieces by round trip; packing and mixing by their rules."""

import random
import unicodedata
from collections import Counter

import pytest
from pyspark.sql import functions as F

from linecorpus.llm import mixing, packing, pieces, terms, tokens
from linecorpus.llm.queries import oracle_sql, queries


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_against_sql(name, same):
    same(queries()[name], oracle_sql()[name])


def test_terms_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(terms, "HELD", 5)  # counters passed on in parts
    rng = random.Random(3)
    pool = ["a", "A", "ß", "ꭰ", "Ꭰ", "é", "é", "ﬁ", "b,", " ", "　", " ", " ", "\u001c"]
    rows = [("".join(rng.choices(pool, k=rng.randint(0, 12))),) for _ in range(200)] + [(None,), ("",), (" ",)]
    df = spark.createDataFrame(rows, "label string").repartition(3)
    occ, rec = Counter(), Counter()
    for (t,) in rows:
        ws = unicodedata.normalize("NFC", t or "").upper().split()
        occ.update(ws)
        rec.update(set(ws))
    got = {r["term"]: (r["occurrences"], r["records"]) for r in terms.term_counts(df, "label").collect()}
    assert got == {w: (occ[w], rec[w]) for w in occ}


def test_marks(spark):
    df = spark.createDataFrame([(f"all w{i // 2} x{i // 5}",) for i in range(400)], "t string")
    m = {r["term"]: r["mark"] for r in terms.marked_terms(df, "t").collect()}
    assert m["ALL"] == "common" and m["W0"] == "rare" and m["X0"] == "common"
    even = spark.createDataFrame([("a b" if i < 7 else "b",) for i in range(700)], "t string")
    assert {r["term"]: r["mark"] for r in terms.marked_terms(even, "t").collect()} == {"A": None, "B": "common"}
    assert terms.marked_terms(df.where("false"), "t").count() == 0


def texts():
    rng = random.Random(8)
    out = ["", "a", "Ꭰ" * 400, "x" * 1000, "\n" * 300, " " * 300, "éß𝐚" * 200]
    for _ in range(60):
        words = ["".join(rng.choices("abcᎠᎡᎢé", k=rng.randint(1, 30))) for _ in range(rng.randint(1, 120))]
        out.append("".join(w + rng.choice([" ", " ", ". ", "\n", "\n\n", ""]) for w in words))
    return out


@pytest.mark.parametrize(("limit", "overlap"), [(100, 0), (100, 20), (257, 100), (8, 0)])
def test_pieces_round_trip(spark, limit, overlap):
    ts = texts()
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate([*ts, None])], "doc_id int, text string, piece int")
    got = {}
    for r in pieces.pieces(df, ["doc_id"], "text", limit, overlap).collect():
        got.setdefault(r["doc_id"], []).append(r)
    assert len(ts) not in got and len(got) == len(ts)
    for i, t in enumerate(ts):
        raw = t.encode()
        ps = sorted(got[i], key=lambda r: r["piece"])
        assert [p["piece"] for p in ps] == list(range(len(ps)))
        end = 0
        for k, p in enumerate(ps):
            b = p["body"].encode()
            assert b == raw[p["start"] : p["start"] + p["tokens"]] and len(b) <= limit
            if k:
                assert end - p["start"] >= min(overlap, end) and end - p["start"] <= overlap + pieces.SLACK
            else:
                assert p["start"] == 0
            end = p["start"] + p["tokens"]
        assert end == len(raw)
        assert (len(ps) > 1) == (len(raw) > limit)


def test_strong_boundaries_win(spark):
    t = "one two three. four five\n\nsix seven eight. nine ten eleven twelve"
    df = spark.createDataFrame([(1, t)], "doc_id int, text string")
    got = [r["body"] for r in pieces.pieces(df, ["doc_id"], "text", 40).orderBy("piece").collect()]
    assert got[0] == "one two three. four five\n\n" and all(not g.startswith(" ") for g in got)
    with pytest.raises(ValueError, match="limit"):
        pieces.pieces(df, ["doc_id"], "text", 100, 60)


def test_best_two_fit():
    rng = random.Random(2)
    for _ in range(30):
        sizes = [rng.randint(0, 100) for _ in range(rng.randint(0, 120))]
        bins = packing.pack(sizes, 100)
        assert sorted(i for b in bins for i in b) == list(range(len(sizes)))
        assert all(sum(sizes[i] for i in b) <= 100 for b in bins)
    # greedy takes 60 and 30 and leaves ten empty; 25 and 15 fill it instead of 30
    assert any(sorted(b) == [0, 2, 3] for b in packing.pack([60, 30, 25, 15], 100))
    sizes = [rng.randint(1, 4096) for _ in range(3000)]
    assert len(packing.pack(sizes, 4096)) <= 1.03 * sum(sizes) / 4096 + 1


def test_containers(spark):
    rng = random.Random(6)
    rows = [(i, "w " * rng.randint(0, 60) + "x") for i in range(500)] + [(900, "y" * 750), (901, None), (902, ""), (903, "z" * 100), (904, "z" * 100)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("tokens", F.lit(1))
    got = packing.containers(df, "doc_id", "text", 200, shard=100).collect()
    per, filled = Counter(), {}
    for r in got:
        per[r["container"]] += r["tokens"]
        filled[r["container"]] = r["filled"]
    assert per == filled and max(per.values()) <= 200
    whole = {r["doc_id"] for r in got if r["piece"] is None}
    assert whole == {i for i, t in rows if t is not None and len(t) <= 200}
    cut = sorted((r["piece"], r["tokens"]) for r in got if r["doc_id"] == 900)
    assert [p for p, _ in cut] == list(range(len(cut))) and sum(t for _, t in cut) == 750
    assert sum(per.values()) >= 0.93 * 200 * len(per)
    again = packing.containers(df, "doc_id", "text", 200, shard=100).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    assert packing.containers(df.where("false"), "doc_id", "text", 200).count() == 0


def test_apportionment():
    assert mixing.apportion({"a": 53, "b": 24, "c": 23}, 7) == {"a": 3, "b": 2, "c": 2}
    assert mixing.apportion({"a": 1, "b": 1}, 10, {"a": 2.0, "b": 99.0}) == {"a": 2, "b": 8}
    assert mixing.apportion({"a": 1}, 10, {"a": 0.5}) == {"a": 0}


def test_mix(spark):
    docs = [(i, "x" * (50 + i % 40), "big") for i in range(4000)] + [(10_000 + i, "y" * 50, "small") for i in range(40)] + [(20_000, None, "big"), (20_001, "z", None), (20_002, "z", "other")]
    d = spark.createDataFrame(docs, "doc_id long, text string, source string")
    t = spark.createDataFrame([("big", 70, 1), ("small", 20, 3), ("absent", 10, 2)], "source string, target_pct int, max_repeats int")
    chosen, report = mixing.mixed(d, t)
    r = {x["source"]: x for x in report.collect()}
    assert not r["small"]["reachable"] and not r["absent"]["reachable"] and r["big"]["reachable"]
    assert r["absent"]["given"] == 0 and r["small"]["given"] == 40 * 50 * 3
    rows = chosen.collect()
    assert len(rows) == len({x["doc_id"] for x in rows})
    assert all(1 <= x["repeats"] <= {"big": 1, "small": 3}[x["source"]] for x in rows)
    assert abs(r["big"]["given"] - r["big"]["quota"]) <= 0.02 * r["big"]["quota"]
    assert mixing.mixed(d.where("false"), t)[0].count() == 0
    assert mixing.mixed(d, t.where("false"))[0].count() == 0


def test_shares_follow_targets(spark):
    d = spark.createDataFrame([(i, "x" * 60, "abc"[i % 3]) for i in range(6000)], "doc_id long, text string, source string")
    t = spark.createDataFrame([("a", 50, 2), ("b", 30, 1), ("c", 20, 1)], "source string, target_pct int, max_repeats int")
    chosen, report = mixing.mixed(d, t)
    for r in report.collect():
        assert abs(r["actual_pct"] - r["target_pct"]) < 1.0
    assert chosen.where("source = 'a'").agg(F.max("repeats")).first()[0] == 2


def test_token_sizes(spark):
    df = spark.createDataFrame([("abcᎠ",), (None,), ("",)], "t string")
    assert [r[0] for r in df.select(tokens.size(F.col("t"))).collect()] == [6, None, 0]
    with pytest.raises(ValueError, match="path"):
        tokens.size(F.col("t"), "tiktoken")
    pytest.importorskip("tokenizers")
    import os

    path = "/opt/tokenizers/byte_bpe_50k.json"
    if os.path.exists(path):
        assert [r[0] for r in df.select(tokens.size(F.col("t"), "tokenizers", path)).collect()][1:] == [None, 0]


def test_time_is_in_proportion(spark):
    """Twice the text takes about twice as long, not four times; pieces of one long text are whole."""
    import time

    took = {}
    for mb in (1, 2, 4):
        t = ("some words and more of them Ꭰ. " * 40_000)[: mb * 1_000_000]
        df = spark.createDataFrame([(mb, t)], "k int, text string")
        start = time.time()
        got = pieces.pieces(df, ["k"], "text", 2048, 128).agg(F.count(F.lit(1)).alias("n"), F.max(F.col("start") + F.col("tokens")).alias("end")).first()
        took[mb] = time.time() - start
        assert got["end"] == len(t.encode()) and got["n"] > len(t.encode()) / 2048
    assert took[4] < 3 * took[2] + 2


@pytest.mark.parametrize("name", ["byte_bpe_50k.json"])
def test_pieces_by_other_tokenizers(spark, name):
    import os

    path = f"/opt/tokenizers/{name}"
    if not os.path.exists(path):
        pytest.skip("no vocabulary file")
    texts = ["one two three. four five six\nseven eight nine ten. " * 12, "ᎠᎡᎢ ᎣᎤᎥ ᎦᎧᎨ " * 20, "short", "", None, "x" * 3000]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, text string")
    got: dict = {}
    for r in pieces.pieces(df, ["k"], "text", 32, 4, "tokenizers", path).collect():
        got.setdefault(r["k"], []).append(r)
    for k, t in enumerate(texts):
        ps = sorted(got.get(k, []), key=lambda r: r["piece"])
        if t is None:
            assert not ps
            continue
        ends = tokens.spans("tokenizers", path, t)
        assert [p["piece"] for p in ps] == list(range(len(ps))) and all(p["tokens"] <= 32 for p in ps)
        assert ps[0]["start"] == 0 and ps[-1]["start"] + ps[-1]["tokens"] == len(ends)
        for a, b in zip(ps, ps[1:]):
            assert b["start"] == a["start"] + a["tokens"] - 4
        raw, made = t.encode(), ps[0]["body"]
        for p in ps[1:]:
            made += raw[ends[p["start"] + 3] : ends[p["start"] + p["tokens"] - 1]].decode("utf-8", "ignore")
        if t.isascii():
            assert made == t
    some = df.where("text != ''").withColumn("source", F.lit("s"))
    boxes = packing.containers(some, "k", "text", 64, tokenizer="tokenizers", path=path).collect()
    assert {r["k"] for r in boxes} == {0, 1, 2, 5} and max(r["filled"] for r in boxes) <= 64
    t = spark.createDataFrame([("s", 100, 1)], "source string, target_pct int, max_repeats int")
    size = sum(len(tokens.spans("tokenizers", path, x)) for x in texts if x)
    assert mixing.mixed(some.withColumnRenamed("k", "doc_id"), t, tokenizer="tokenizers", path=path)[1].first()["size"] == size


def test_sources_stopped_by_their_repeats(spark):
    d = spark.createDataFrame([(i, "x" * 100, "abc"[i % 3]) for i in range(300)], "doc_id long, text string, source string")
    for pct, want in (((34, 33, 33), {"a"}), ((33, 33, 34), {"c"}), ((30, 30, 30), set()), ((50, 25, 25), {"a"}), ((100, 0, 0), {"a"})):
        t = spark.createDataFrame([(s, p, 1) for s, p in zip("abc", pct)], "source string, target_pct int, max_repeats int")
        assert {r[0] for r in mixing.stopped(d, t).collect()} == want
    # exactly enough is enough
    assert mixing.stopped(d.where("source != 'c'"), spark.createDataFrame([("a", 50, 1), ("b", 50, 1)], "source string, target_pct int, max_repeats int")).count() == 0
    assert mixing.stopped(d.where("false"), t).count() == 0
