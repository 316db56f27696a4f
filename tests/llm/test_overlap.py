"""Cross-split pairs against brute force."""

import random

import numpy as np

from linecorpus.llm import overlap
from linecorpus.operators.verses import distance


def brute(rows):
    keep = [(o, s, *overlap.comparable(t)) for o, s, t in rows if s in ("train", "test") and t]
    keep = [r for r in keep if r[3] >= overlap.MIN_LETTERS]
    out = set()
    for o, s, t, _ in keep:
        for p, q, u, _ in keep:
            if s == "test" and q == "train":
                m = max(len(t), len(u))
                if abs(len(t) - len(u)) * 8 <= m and distance(t, u) * 8 <= m:
                    out.add((o, p))
    return out


def noisy(rng, t, k):
    t = list(t)
    for _ in range(k):
        i = rng.randrange(len(t))
        kind = rng.random()
        if kind < 0.4:
            t[i] = rng.choice("abcdeᎠᎡ")
        elif kind < 0.7 and len(t) > 1:
            del t[i]
        else:
            t.insert(i, rng.choice("abcdeᎠᎡ"))
    return "".join(t)


def pairs(spark, rows):
    df = spark.createDataFrame(rows, "ord long, split string, label string")
    got = overlap.cross_split_pairs(df).collect()
    assert len(got) == len({(r["test_ord"], r["train_ord"]) for r in got})
    return {(r["test_ord"], r["train_ord"]): r for r in got}


def test_against_brute_force(spark):
    rng = random.Random(11)
    rows, n = [], 0
    for _ in range(40):
        base = "".join(rng.choices("abcdefgh ᎠᎡᎢᎣ", k=rng.randint(20, 90)))
        for _ in range(rng.randint(2, 4)):
            n += 1
            rows.append((n, rng.choice(["train", "test", None]), noisy(rng, base, rng.randint(0, max(1, len(base) // 7)))))
    # edits spread as evenly as they can be: the hardest case for shared windows
    base = "".join(rng.choices("abcdefgh", k=64))
    even = "".join("x" if i % 8 == 7 else c for i, c in enumerate(base))
    rows += [(900, "train", base), (901, "test", even), (902, "train", "ab" * 20), (903, "test", "ab" * 20 + "ba"), (904, "test", "aaaaaaaaaaaaaaaaaaaaaaaa"), (905, "train", "aaaaaaaaaaaaaaaaaaaaaaaaa")]
    assert set(pairs(spark, rows)) == brute(rows)


def test_forms_nulls_repeats(spark):
    a = "ᏝᏍ ᏮᎼ ᏧᏣᏢ ᏛᏓᏜ ᏎᏇᎻᎯ ᎱᏆᎷᏈᏋ ᏤᏅ"
    rows = [(1, "train", a), (2, "train", a), (3, "test", a.lower().replace(" ", "  ")), (4, "test", a.replace("Ꮇ", "M").replace(" ", " ") + "."), (5, None, a), (6, "train", None), (7, "test", ""), (8, "test", "short"), (9, "val", a)]
    got = pairs(spark, rows)
    assert set(got) == {(3, 1), (3, 2), (4, 1), (4, 2)}
    assert all(r["edits"] == 0 and r["overlap"] == 1.0 for r in got.values())


def test_empty_table(spark):
    assert pairs(spark, []) == {}


def test_report(spark):
    a, b = "one two three four five six seven", "quite another line of many words here"
    rows = [(1, "train", a, "s"), (2, "test", a, "s"), (3, "test", a + "x", "t"), (4, "test", a, "s"), (5, "train", b, None), (6, "test", "short", "s"), (7, None, a, "s")]
    df = spark.createDataFrame(rows, "ord long, split string, label string, source string")
    got = {(r["split"], r["source"]): (r["rows"], r["linked_rows"], r["exact_rows"], r["links"]) for r in overlap.overlap_report(df, "source").collect()}
    assert got == {("train", "s"): (1, 1, 1, 3), ("test", "s"): (2, 2, 2, 2), ("test", "t"): (1, 1, 0, 1), ("train", None): (1, 0, 0, 0)}
    assert overlap.overlap_report(df.where("false"), "source").count() == 0


def test_report_counts_what_the_pairs_are(spark):
    rng = random.Random(5)
    bases = ["".join(rng.choices("abcdefgh", k=40)) for _ in range(12)]
    rows = [(i, rng.choice(["train", "test"]), noisy(rng, rng.choice(bases), rng.randint(0, 4)), rng.choice("xyz")) for i in range(150)]
    df = spark.createDataFrame(rows, "ord long, split string, label string, source string")
    found = pairs(spark, [r[:3] for r in rows])
    want: dict = {}
    for o, s, _, src in rows:
        want[s, src] = want.get((s, src), 0) + sum(o in k for k in found)
    assert {(r["split"], r["source"]): r["links"] for r in overlap.overlap_report(df, "source").collect()} == want
    texts = overlap.classes(overlap.normalised(df))
    for exact in (True, False):
        assert sorted(map(tuple, overlap.candidates(texts, exact, hot=1).collect())) == sorted(map(tuple, overlap.candidates(texts, exact).collect()))


def test_content_chunks():
    rng = random.Random(2)
    texts = ["".join(rng.choices("abcdefgh", k=k)) for k in (0, 1, 3, 4, 50, 400)]
    h, row, place, size = overlap.content_chunks(texts)
    for i, t in enumerate(texts):
        mine = row == i
        assert size[mine].sum() == len(t) and place[mine].tolist() == [0, *np.cumsum(size[mine])[:-1].tolist()][: mine.sum()]
        # each text alone gives the same chunks, so cuts depend on content only
        assert overlap.content_chunks([t])[0].tolist() == h[mine].tolist()
    named: dict = {}
    for d, r, p, n in zip(h.tolist(), row.tolist(), place.tolist(), size.tolist()):
        assert named.setdefault(d, texts[r][p : p + n]) == texts[r][p : p + n]
    # letters put in front change the first chunks only
    tail = set(overlap.content_chunks(["xyzxy" + texts[5]])[0].tolist())
    kept = size[row == 5][[d in tail for d in h[row == 5].tolist()]].sum()
    assert kept > 0.9 * len(texts[5]) and 4 < size[row == 5].mean() < 12


def test_the_first_join_finds_what_shares_half_its_chunks(spark):
    rng = random.Random(8)
    rows, n = [], 0
    for _ in range(60):
        base = "".join(rng.choices("abcdefgh", k=rng.randint(40, 120)))
        for s in ("train", "test"):
            n += 1
            rows.append((n, s, noisy(rng, base, rng.randint(0, 3))))
    texts = overlap.classes(overlap.normalised(spark.createDataFrame(rows, "ord long, split string, label string"))).collect()
    df = spark.createDataFrame(texts, "d binary, norm string, tid long, n_test long, n_train long")
    got = {tuple(r) for r in overlap.candidates(df, False).collect()}
    both = [(a, b) for a in texts for b in texts if a["n_test"] and b["n_train"] and a["tid"] != b["tid"] and abs(len(a["norm"]) - len(b["norm"])) * 8 <= max(len(a["norm"]), len(b["norm"]))]
    import pandas as pd

    share = overlap.shared_share.func(pd.Series([a["norm"] for a, _ in both]), pd.Series([b["norm"] for _, b in both]))
    want = {(a["tid"], b["tid"]) for (a, b), x in zip(both, share) if x >= overlap.SHARE}
    assert len(want) > 20 and want <= got


def test_windows():
    h, row, place = overlap.windows(["abcde", "ab", "abcd"])
    assert row.tolist() == [0, 0, 2] and place.tolist() == [0, 1, 0] and h[0] == h[2] != h[1]
    n = np.arange(20, 400)
    # beyond the windows that edits can touch there are always T more
    assert ((n - overlap.Q + 1) - overlap.Q * overlap.allowed(n) >= overlap.T).all()
