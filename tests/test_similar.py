"""Similar texts against the plain comparison of all pairs, and the label transfer against the plain loop."""

import difflib
import random

import pytest

from linecorpus.operators import manifest, similar


def ratio(x, y):
    return difflib.SequenceMatcher(None, x, y).ratio()


def varied(rng, t, share=4):
    t = list(t)
    for _ in range(rng.randint(0, max(1, len(t) // share))):
        i = rng.randrange(len(t))
        t[i : i + rng.randint(0, 1)] = rng.choice(["", "x", "yz", "a"])
        t = t or ["a"]
    return "".join(t)


@pytest.mark.parametrize(("least", "kinds", "tile", "batch"), [(0.75, 20, (512, 1024), 1 << 15), (0.75, 400, (4, 3), 7), (0.5, 2, (4, 3), 50), (0.9, 5, (3, 5), 1 << 15)])
def test_no_similar_pair_is_lost(monkeypatch, least, kinds, tile, batch):
    monkeypatch.setattr(similar, "TILE", tile)
    monkeypatch.setattr(similar, "BATCH", batch)
    rng = random.Random(kinds)
    letters = [chr((97 if k < 26 else 0x4E00) + k) for k in range(kinds)]
    base = ["".join(rng.choices(letters, k=k)) for k in (1, 3, 20, 50, 63, 64, 65, 128, 150, 199, 200, 240, 300)]
    a, b = ([varied(rng, rng.choice(base)) for _ in range(40)] for _ in "ab")
    b += a[:5]
    of_a, of_b = [rng.choice("st") for _ in a], [rng.choice("stu") for _ in b]
    want = sorted((i, j, r) for i, x in enumerate(a) for j, y in enumerate(b) if of_a[i] == of_b[j] and (r := ratio(x, y)) > least)
    assert want and sorted(similar.similar_pairs(a, b, least, of_a, of_b)) == want


@pytest.mark.parametrize("rounds", [0, 3])
def test_transfer_with_equal_long_and_displaced_lines(spark, monkeypatch, rounds):
    monkeypatch.setattr(manifest, "TRANSFER_BLOCK", 7)
    monkeypatch.setattr(manifest, "TRANSFER_ROUNDS", rounds)
    rng = random.Random(9)
    base = ["".join(rng.choices("abcdef ", k=12)).strip() or "a" for _ in range(8)]
    old = [varied(rng, rng.choice(base), 6).strip() or "a" for _ in range(60)]
    new = [rng.choice([rng.choice(old), varied(rng, rng.choice(base), 6).strip() or "a"]) for _ in range(50)]
    # each line takes the new line that the next one has as its own
    old += ["qrstuvwx" + "0123456789"[k:] + "ghijklmn"[:k] for k in range(6)]
    new += [old[-5 + k] for k in range(5)]
    # difflib sees no similarity in long lines of few letters, though they are equal
    old, new = [*old, "ab" * 120], [*new, "ab" * 120]
    schema = "id string, ord int, source_scan string, status string, label string, initial_ocr string"
    olds = [(f"o{i}", i, "st"[i % 7 == 0], "labeled", t, None) for i, t in enumerate(old)]
    news = [(f"n{i}", i, "st"[i % 7 == 0], "unlabeled", None, t) for i, t in enumerate(new)]
    olds[-1], news[-1] = ((*r[:2], "s", *r[3:]) for r in (olds[-1], news[-1]))
    want, free = [], list(news)
    for o in olds:
        best, at = 0.75, None
        for n in free:
            if n[2] == o[2] and (r := ratio(o[4], n[5])) > best:
                best, at = r, n
        if at:
            free.remove(at)
            want.append((o[0], at[0], "labeled", o[4], round(best, 9)))
    got = manifest.transfer_labels(spark.createDataFrame(olds, schema), spark.createDataFrame(news, schema)).collect()
    assert sorted((*r[:4], round(r[4], 9)) for r in got) == sorted(want)
