"""Groups and splits; the trie, faults and repair."""

import dataclasses
import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from linecorpus.llm import grouping, repair
from linecorpus.llm.channel import Channel, Spelling
from linecorpus.llm.trie import Trie
from linecorpus.operators.verses import distance


def test_page_names(spark):
    cases = {
        "1828-02-07/seq-1.jp2": "1828-02-07/seq-1.jp2", "18280207/seq-1.jp2": "1828-02-07/seq-1.jp2", "1828-02-14/seq_1.jp2": "1828-02-14/seq-1.jp2", "./1828-02-14/seq-2.tif": "1828-02-14/seq-2.jp2",
        "1828-02-07/SEQ-2.JP2": "1828-02-07/seq-2.jp2", "scans/1828-02-07/seq-03.jp2": "1828-02-07/seq-3.jp2", "1828-03-06\\seq-3.jp2": "1828-03-06/seq-3.jp2", " 1828-02-07/seq-0.jp2 ": "1828-02-07/seq-0.jp2",
    }
    df = spark.createDataFrame([(k, v) for k, v in cases.items()], "s string, want string")
    for r in df.select("want", grouping.page_name(F.col("s"), F.lit(None).cast("string")).alias("got")).collect():
        assert r["got"] == r["want"]
    none = spark.createDataFrame([(None, "1828-02-07_seq-3_col_00_line_006"), ("??", "x")], "s string, i string")
    assert [r[0] for r in none.select(grouping.page_name(F.col("s"), F.col("i"))).collect()] == ["1828-02-07/seq-3.jp2", None]


@pytest.mark.parametrize("seed", [1, 2])
def test_components_and_forest(spark, seed):
    rng = random.Random(seed)
    links = [(f"v{rng.randrange(40):02d}", f"v{rng.randrange(40):02d}") for _ in range(30)] + [(f"c{i:02d}", f"c{i + 1:02d}") for i in range(20)] + [("c00", "c00"), (None, "v01"), ("c03", "c02")]
    df = spark.createDataFrame(links, "scan string, same_as string")
    comp, forest = grouping.components(df, "scan", "same_as")
    up: dict = {}

    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in links:
        if a and b and a != b:
            x, y = sorted((find(a), find(b)))
            up[y] = x
    names: dict = {}
    for v in up:
        names.setdefault(find(v), []).append(v)
    want = {v: min(g) for g in names.values() for v in g}
    assert {r["vertex"]: r["root"] for r in comp.collect()} == want
    edges = [tuple(r) for r in forest.collect()]
    assert len(edges) == len(want) - len(names)  # a forest: one edge fewer than vertices in each tree
    assert {tuple(sorted(e)) for e in edges} <= {tuple(sorted(x)) for x in links if x[0] and x[1]}


def test_no_links(spark):
    df = spark.createDataFrame([], "scan string, same_as string")
    comp, forest = grouping.components(df, "scan", "same_as")
    assert comp.count() == forest.count() == 0


def test_deal(spark):
    rng = random.Random(4)
    groups = [(f"g{i}", rng.choice([1, 2, 3, 5, 8, 40])) for i in range(3000)] + [("hot", 9000), ("warm", 700)]
    df = spark.createDataFrame(groups, "grp string, n long")
    got = grouping.dealt(df, [("train", 80.0), ("val", 10.0), ("test", 10.0)]).collect()
    assert sorted(r["grp"] for r in got) == sorted(g for g, _ in groups)
    total = sum(n for _, n in groups)
    for s, share in (("train", 0.8), ("val", 0.1), ("test", 0.1)):
        assert abs(sum(r["n"] for r in got if r["split"] == s) / total - share) < 0.01
    assert grouping.dealt(df.where("false"), [("train", 80.0), ("val", 20.0)]).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_shares_are_met_within_half_the_largest_group(spark, seed):
    rng = random.Random(seed)
    sizes = {0: [1] * 500, 1: [rng.randint(1, 60) for _ in range(400)], 2: [3000, 900, 800, 500] + [rng.randint(1, 40) for _ in range(200)], 3: [16, 16, 16, 16, 16]}[seed]
    df = spark.createDataFrame([(f"g{i}", n) for i, n in enumerate(sizes)], "grp string, n long")
    shares = [("train", 70.0), ("val", 10.0), ("test", 20.0)]
    got = {r["grp"]: r["split"] for r in grouping.dealt(df, shares).collect()}
    for s, share in shares:
        # every row is dealt once, and no split misses its share by more than half the largest group
        assert abs(sum(n for i, n in enumerate(sizes) if got[f"g{i}"] == s) - share / 100 * sum(sizes)) <= max(sizes) / 2 + 1
    # the same groups on every run, however the table is partitioned
    assert {r["grp"]: r["split"] for r in grouping.dealt(df.repartition(7), shares).collect()} == got


def test_kept_forest_stands_for_its_links(spark):
    links = [(f"v{i:02d}", f"v{(i * 7) % 30:02d}") for i in range(30)] + [("a", "b"), ("b", "c"), ("a", "c")]
    more = [("c", "v01"), ("x", "y"), (None, "a")]
    kind = "scan string, same_as string"
    _, forest = grouping.components(spark.createDataFrame(links, kind), "scan", "same_as")
    grouping.keep_forest(forest, "test-forest")
    kept = grouping.kept_forest(spark, "test-forest")
    whole, _ = grouping.components(spark.createDataFrame(links + more, kind), "scan", "same_as")
    added, _ = grouping.components(spark.createDataFrame(more, kind), "scan", "same_as", kept)
    assert sorted(map(tuple, added.collect())) == sorted(map(tuple, whole.collect()))


def test_groups_stay_together(spark):
    m = spark.createDataFrame(
        [(1, "a_col", "1828-01-01/seq-1.jp2", "train"), (2, "b", "18280101/seq-01.jp2", "test"), (3, "c", "1828-01-02/seq-1.tif", "test"), (4, "cnt_01_010101_line_00", None, "train"), (5, "cnt_01_010101_line_01", None, None), (6, "zzz", None, "train"), (6, "zzz", None, "train")],
        "ord int, id string, source_scan string, split string",
    ).withColumn("grp", F.lit("clash"))
    links = spark.createDataFrame([("1828-01-02/seq-1.jp2", "1827-01-01/seq-9.jp2")], "scan string, same_as string")
    got = {(r["ord"]): r["grp"] for r in grouping.grouped(m, links).collect()}
    assert got == {1: "1828-01-01/seq-1.jp2", 2: "1828-01-01/seq-1.jp2", 3: "1827-01-01/seq-9.jp2", 4: "cnt_01_010101", 5: "cnt_01_010101", 6: None}
    facts = {r["grp"]: (r["n"], r["train"], r["test"]) for r in grouping.group_facts(m, links).collect()}
    assert facts == {"1828-01-01/seq-1.jp2": (2, 1, 1), "1827-01-01/seq-9.jp2": (1, 0, 1), "cnt_01_010101": (2, 1, 0)}


def test_trie_finds_all_within_bound():
    rng = random.Random(7)
    words = list({"".join(rng.choices("ABCX", k=rng.randint(1, 6))) for _ in range(150)})
    trie = Trie([(w, 1) for w in words])
    for _ in range(150):
        q = "".join(rng.choices("ABCXY", k=rng.randint(1, 6)))
        for k in (0, 1, 2):
            assert set(trie.within(q, k)) == {w for w in words if distance(w, q) <= k}


def test_trie_with_learnt_edits_equals_the_whole_search():
    rng = random.Random(9)
    trie = Trie([(w, 1) for w in {"".join(rng.choices("ABCX", k=rng.randint(1, 6))) for _ in range(150)}])
    ch = Channel({("AB", "C"): 5, ("X", "BC"): 7, ("A", "B"): 9, ("BA", "XC"): 4}, dict.fromkeys("ABCX", 100))
    for _ in range(200):
        q = "".join(rng.choices("ABCX", k=rng.randint(1, 7)))
        for k in (1, 2):
            whole: dict = {}
            Trie._search(trie.root, q, k, k, 0, ch.edit, ch.multi, -1e9, False, whole)
            got = trie.within(q, k, ch)
            assert {w: round(p, 9) for w, (_, p) in got.items()} == {w: round(p, 9) for w, (_, p) in whole.items()}
            assert set(trie.within(q, k, ch, -9.0)) == {w for w, (_, p) in whole.items() if p >= -9.0}


def test_learnt_edits():
    seen, letters = repair.learnt([("the fanners came", "the farmers came", None), ("x y", "x", "x y z"), ("mend it", "rnend it", "mend it")], {"THE", "FARMERS", "CAME", "MEND", "IT"})
    assert seen == {("RM", "NN"): 1, ("M", "RN"): 1}
    assert letters["T"] == 5
    ch = Channel({("M", "RN"): 50}, {"M": 1000, "R": 1000})
    assert ch.edit("M", "RN") > ch.edit("N", "U") == ch.unseen
    trie = Trie([("MEND", 3), ("BOND", 1)])
    assert trie.within("RNEND", 1, ch) == {"MEND": (3, ch.edit("M", "RN"))}


def lexicon_judge(data):
    import pandas as pd

    words = sorted({t.upper() for t in pd.read_parquet(f"{data}/lexicon.parquet", columns=["term"])["term"]})
    text = pd.read_parquet(f"{data}/documents.parquet", columns=["text"])["text"].dropna()
    n = Counter(repair.fold(w) for t in text for w in t.split())
    total = sum(n.values())
    words = [(w, max(1, n[w])) for w in words]
    lines = pd.read_parquet(f"{data}/manifest_w_lang.parquet", columns=["label", "initial_ocr", "ftm_ocr"]).sample(2000, random_state=1)
    seen, letters = repair.learnt([tuple(r) for r in lines.values], frozenset(w for w, _ in words))
    return repair.Judge(words, Channel(seen, letters), Spelling(words, 1e-4), math.log(total)), seen


def test_unseen_misreadings_are_found_and_right_words_stay(data):
    """Substitutions that were never learnt, in known words, are found; a word held out of the vocabulary seldom changes."""
    j, seen = lexicon_judge(data.replace("sf0.001", "sf0.01"))
    rng = random.Random(3)
    for ok in (str.isascii, lambda w: all("\u13a0" <= c <= "\u13f5" for c in w)):
        pool = [w for w in words_of(j) if ok(w) and len(w) > 3]
        letters = sorted({c for w in pool for c in w if c.isalpha()})
        found = tried = changed = kept = 0
        for w in rng.sample(pool, 300):
            i = rng.randrange(len(w))
            q = w[:i] + rng.choice(letters) + w[i + 1 :]
            if q not in j.trie:
                tried += 1
                right, derived, got = j.readings(q, 0)
                found += bool(got)
            # as if the word itself were unknown
            right, derived, got = j.readings(w, 0)
            odds = max((s for _, s in got), default=-99.0) - max(right, derived)
            kept += 1
            changed += odds > repair.CLEAR
        assert found >= 0.9 * tried
        assert changed <= 0.03 * kept


def words_of(j):
    out, stack = [], [(j.trie.root, "")]
    while stack:
        node, made = stack.pop()
        for ch, nxt in node.items():
            if ch:
                stack.append((nxt, made + ch))
            else:
                out.append(made)
    return sorted(out)


WORDS = ["LETTERS", "VILLAGE", "FARMERS", "THE", "OF", "GREETED", "ᎠᎡᎢᎣ", "ᎤᎥᎦᎧ", "SCHOOL", "HOUSE", "SCHOOL-HOUSE", "TOWN", "NATION", "ARE", "WERE", "PEOPLE", "EXAMPLES"]


@pytest.fixture(scope="module")
def shared(spark):
    lex = spark.createDataFrame([(w.lower(), "en") for w in WORDS], "term string, lang string")
    docs = spark.createDataFrame([(" ".join(WORDS * 40),), (None,), ("",), ("the letters of the village",)], "text string")
    lines = spark.createDataFrame([(f"River Town Herald {i}",) for i in range(5)] + [(None,), ("",)], "text string")
    rows = [("the farmers", "the farrners", None), ("the village", "the vi|llage", ""), ("ᎠᎡᎢᎣ the", None, "ᎠᎡᎢ the")] * 30
    readings = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "ord int, a string, b string, c string")
    return repair.fitted(spark, lex, docs, lines, "text", readings)


FAULTS = [
    (None, []), ("", []), ("the letters of the village", []), ("the village —", []), ("4 the village", []), ("the village 1835 farmers", []), ("[46] the village", ["number"]), ("the village — 46 —", ["number"]), ("(217)", ["number"]), ("47.", ["number"]),
    ("RIVER TOWN HERALD. 33", ["header"]), ("River Town Herald the letters", ["header"]), ("the gre-", ["broken"]), ("the gre¬\neted farmers", ["broken"]), ("the vi|llage", ["misread"]), ("the farrners", ["misread"]), ("the ᎠᎡ3Ꭳ", ["misread"]), ("the ᎠᎡᎢ of", ["misread"]), ("eted the farmers", []),
    ("the school-house", []), ("the Zelbrook of", []), ("ᎠᎡᎢᎣ M the", []), ("the " + "x" * 5000, []), ("the lettars of", ["misread"]),
]


def test_faults(spark, shared):
    df = spark.createDataFrame([(i, t, "clash") for i, (t, _) in enumerate(FAULTS)], "k int, text string, faults string")
    got = {r["k"]: r["faults"] for r in repair.faulty(df, shared, ["k"], "text").collect()}
    assert {i: got.get(i, []) for i in range(len(FAULTS))} == {i: want for i, (_, want) in enumerate(FAULTS)}
    assert repair.faulty(df.where("false"), shared, ["k"], "text").count() == 0


def test_shards_give_the_same_verdicts(spark, shared):
    words = spark.createDataFrame([(w,) for w in ("FARRNERS", "LETTARS", "XYZZY", "VI|LLAGE", "NATIONS", "ETED")], "word string")
    want = sorted(map(str, repair.judged(words, shared).collect()))
    assert sorted(map(str, repair.judged(words, dataclasses.replace(shared, shards=5)).collect())) == want


def test_mending(spark, shared):
    cases = {
        "[46] the vi|llage of Farrners.": ("the village of Farmers.", False), "the gre¬\neted farmers": ("the greeted farmers", False), "RIVER TOWN HERALD 99 the letters gre-": ("the letters gre", True),
        "RIVER TOWN HERALD. 33": ("", False), "(217)": ("", False), "the village " * 3000: (("the village " * 3000).strip(), False), "The people were here to-day": ("The people were here to-day", False),
    }
    df = spark.createDataFrame([(i, t) for i, t in enumerate(cases)], "k int, text string")
    docs = spark.createDataFrame([("the village of farmers",)], "text string")
    for more in (None, docs):
        got = {r["k"]: (r["mended"], r["goes_on"]) for r in repair.mended(df, shared, ["k"], "text", more).collect()}
        assert got == dict(enumerate(cases.values()))


def test_paragraphs(spark, shared):
    rows = [
        ("m", "p_col_00_line_000", 1, "River Town Herald 7"), ("m", "p_col_00_line_001", 2, "the letters were gre-"), ("m", "p_col_00_line_002", 3, "eted of the"), ("m", "p_col_00_line_002", 4, "eted of the vi|llage."), ("m", "p_col_00_line_003", 5, None), (None, None, 6, "x"), ("m", "p_col_00_line_004", 7, "The farmers"),
        ("m", "q_col_01_line_063", 7, "the far-"), ("m", "q_col_01_line_064", 8, "mers of"), ("m", "r_col_00_line_1", 1, "the people of the na-"), ("m", "r_col_00_line_2", 1, "[12]"), ("m", "r_col_00_line_3", 1, "tion are here today"), ("m", "s_col_00_line_1", 1, "the exam-"), ("m", "s_col_00_line_2", 1, "ple-"), ("m", "s_col_00_line_3", 1, "s of"),
    ]
    df = spark.createDataFrame(rows, "tbl string, id string, ord long, text string")
    got = {(r["place"], r["par"]): r["body"] for r in repair.paragraphs(df, shared, "text").collect()}
    assert got == {
        ("p_col_00", 0): "the letters were greeted of the village.", ("p_col_00", 1): "The farmers", ("q_col_01", 0): "the farmers of", ("r_col_00", 0): "the people of the nation are here today", ("s_col_00", 0): "the examples of",
    }
    assert repair.paragraphs(df.where("false"), shared, "text").count() == 0


def test_headers_and_counts(spark):
    long = " ".join(f"W{'x' * i}" for i in range(40))
    lines = spark.createDataFrame([(f"Hill Leaf {i}",) for i in (3, 4, 5)] + [(f"{i} {long}",) for i in (3, 4, 5)] + [("[9] Hill Leaf",), ("one two 7",), ("one two 7",), ("Hill Leaf",), (None,)], "text string")
    assert {r[0] for r in repair.running_headers(lines, "text").collect()} == {"HILL LEAF", long.upper()}
    docs = spark.createDataFrame([("some gre-\neted, some greeted once",), (None,), ("",)], "text string")
    assert {r["word"]: r["n"] for r in repair.word_counts(docs).collect()} == {"SOME": 2, "GREETED": 2, "ONCE": 1}
