"""All pairs of similar texts (``difflib`` ratio above a bound), by bounds that are counted for many pairs at once.

A ratio is twice the letters matched by the letters of both texts.  Matched
letters are common to both, and stand in the same order in both: neither the
letters in common nor the longest common subsequence can be fewer.  The first
are counted by matrix products, the second by bits for the pairs that are left,
and what both let through is compared.
"""

from __future__ import annotations

import difflib

import numpy as np

#: columns for the k-th occurrence of a letter, and columns that all others share
OWN, REST = 160, 32
#: texts of the two sides of one product
TILE = (512, 1024)
#: pairs whose subsequences are counted at once
BATCH = 1 << 15
#: letters after which pairs that cannot be similar any more are given up
LOOK = 8
#: words of 64 letters whose places are kept as bits
WORDS = 4
#: from this length on difflib leaves out common letters of a text, so that even equal texts need not be similar
PLAIN = 200


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lengths, all letters as small numbers one after the other, and a place for each text that brings like scripts together.

    Only rare letters have a number in common, which makes bounds larger, never smaller.
    """
    size = np.array([len(t) for t in texts], np.int64)
    names, at, often = np.unique(np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32), return_inverse=True, return_counts=True)
    small = np.empty(len(names), np.uint8)
    rank = np.argsort(-often, kind="stable")
    small[rank[:OWN]] = np.arange(min(OWN, len(names)))
    small[rank[OWN:]] = OWN + np.arange(max(0, len(names) - OWN)) % REST
    row = np.repeat(np.arange(len(size)), size)
    return size, small[at], np.bincount(row, at, len(size)) / np.maximum(size, 1)


def _columns(size: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """A row for each text; the product of two is no less than the letters they have in common.

    The k-th occurrence of a letter has its own column of 0 and 1, as far as columns go; what a text
    has beyond that is added up in shared columns, whose products are at least the common part.
    """
    kinds = OWN + REST
    have = np.ascontiguousarray(np.bincount(np.repeat(np.arange(len(size)), size) * kinds + codes, minlength=len(size) * kinds).reshape(-1, kinds).T.astype(np.int32))
    often = sorted(((int((have[x] >= k).sum()), -x, -k) for x in range(OWN) for k in range(1, min(int(have[x].max()), OWN) + 1)), reverse=True)[:OWN]
    out = np.zeros((OWN + REST, len(size)), np.float32)
    held = np.zeros((kinds, 1), np.int32)
    for c, (_, x, k) in enumerate(often):
        out[c] = have[-x] >= -k
        held[-x] += 1  # the first occurrences of a letter are the most frequent ones, so they come first
    have = np.maximum(have - held, 0)
    for x in np.flatnonzero(have.any(1)):
        out[OWN + x % REST] += have[x]
    return np.ascontiguousarray(out.T)


def _ordered_enough(masks: np.ndarray, p: np.ndarray, codes: np.ndarray, start: np.ndarray, size: np.ndarray, need: np.ndarray) -> np.ndarray:
    """Which patterns ``p`` of ``masks`` have more than ``need`` letters in common, in order, with the texts that start in ``codes`` there; longest text first.

    ``masks`` has, for each pattern, letter and word of 64 places, the letter's places as bits.  Pairs
    whose count cannot get there with all letters that are left are given up on the way.
    """
    words, kinds = masks.shape[2], masks.shape[1]
    flat = [np.ascontiguousarray(masks[:, :, w]).ravel() for w in range(words)]
    p = p * kinds
    at = np.arange(len(p))
    v = [np.full(len(p), ~np.uint64(0)) for _ in range(words)]
    count = lambda: sum(np.bitwise_count(~x).astype(np.int64) for x in v)
    out = np.zeros(len(p), bool)
    for k in range(int(size.max(initial=0))):
        if k % LOOK == 0 and k:
            so_far = count()
            out[at[so_far > need]] = True
            can = (so_far <= need) & (so_far + size - k > need) & (size > k)
            at, p, start, size, need, v = at[can], p[can], start[can], size[can], need[can], [x[can] for x in v]
        m = np.searchsorted(-size, -k, "left")
        letter, carry = p[:m] + codes.take(start[:m] + k), None
        for w in range(words):
            old = v[w][:m]
            both = flat[w].take(letter)
            both &= old
            new = old + both
            if words > 1:
                over = new < both
                if carry is not None:
                    new += carry
                    over |= new < carry
                carry = over.astype(np.uint64)
            old -= both
            old |= new
    out[at[count() > need]] = True
    return out


def subsequence(a: str, b: str) -> int:
    """Length of the longest common subsequence."""
    masks: dict[str, int] = {}
    for i, x in enumerate(a):
        masks[x] = masks.get(x, 0) | 1 << i
    every = v = (1 << len(a)) - 1
    for y in b:
        both = v & masks.get(y, 0)
        v = (v + both | v - both) & every
    return len(a) - v.bit_count()


def _ordered(old: list[str], new: list[str], i: np.ndarray, j: np.ndarray, least: float, size: np.ndarray, codes: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Which pairs have enough letters in the same order; ``size`` and ``start`` are of the old texts, then of the new."""
    n = j + len(old)
    words = (size[i] + 63) // 64
    need = least / 2 * (size[i] + size[n])
    keep = np.zeros(len(i), bool)
    for w in np.unique(words):
        at = np.flatnonzero(words == w)
        if w > WORDS:
            keep[at] = [subsequence(old[x], new[y]) > k for x, y, k in zip(i[at], j[at], need[at])]
            continue
        at = at[np.argsort(-size[n[at]], kind="stable")]
        which, place = np.unique(i[at], return_inverse=True)
        masks = np.zeros((len(which), OWN + REST, w), np.uint64)
        for k in range(int(size[which].max())):
            has = np.flatnonzero(size[which] > k)
            masks[has, codes[start[which[has]] + k], k // 64] |= np.uint64(1 << k % 64)
        keep[at] = _ordered_enough(masks, place, codes, start[n[at]], size[n[at]], need[at])
    return keep


def similar_pairs(old: list[str], new: list[str], least: float, of_old=None, of_new=None) -> list[tuple[int, int, float]]:
    """All pairs of two lists of texts with a similarity above ``least``, by place; of the same group only, if groups are given."""
    if not old or not new:
        return []
    size, codes, place = _codes([*old, *new])
    start = np.cumsum(size) - size
    cut = len(old)
    rows = _columns(size, codes)
    # the product has half the bound for both lengths taken off, and a little for rounding put on
    half = np.float32(least / 2 * (1 - 1e-4)) * size.astype(np.float32)[:, None]
    left, right = np.hstack([rows[:cut], -half[:cut], np.ones_like(half[:cut])]), np.hstack([rows[cut:], np.ones_like(half[cut:]), -half[cut:]])
    names, of = np.unique(np.concatenate([np.zeros(cut) if of_old is None else of_old, np.zeros(len(new)) if of_new is None else of_new]), return_inverse=True)
    by_old, by_new = np.lexsort((place[:cut], of[:cut])), np.lexsort((place[cut:], of[cut:]))
    left, right = left[by_old], right[by_new]
    ends = [np.searchsorted(x, np.arange(len(names) + 1)) for x in (of[:cut][by_old], of[cut:][by_new])]
    m = difflib.SequenceMatcher(None)
    out: list[tuple[int, int, float]] = []
    found: list[tuple[np.ndarray, np.ndarray]] = []

    def judge() -> None:
        every_i, every_j = (np.concatenate(x) for x in zip(*found))
        found.clear()
        for s in range(0, len(every_i), BATCH):
            i, j = every_i[s : s + BATCH], every_j[s : s + BATCH]
            keep = _ordered(old, new, i, j, least, size, codes, start)
            for x, y in zip(i[keep].tolist(), j[keep].tolist()):
                if old[x] == new[y] and len(new[y]) < PLAIN:
                    out.append((x, y, 1.0))
                    continue
                m.set_seq2(new[y])
                m.set_seq1(old[x])
                if (r := m.ratio()) > least:
                    out.append((x, y, r))

    for g in range(len(names)):
        (a, z), (c, e) = (x[g : g + 2] for x in ends)
        if a == z or c == e:
            continue
        tiles = np.arange(c, e, TILE[1])
        most = np.maximum.reduceat(right[c:e], tiles - c) if len(tiles) > 1 else None
        for s in range(a, z, TILE[0]):
            some = left[s : min(z, s + TILE[0])]
            can = None if most is None else some @ most.T > -1e-3
            for k, u in enumerate(tiles):
                at = np.arange(len(some)) if can is None else np.flatnonzero(can[:, k])
                if not len(at):
                    continue
                x, y = np.divmod(np.flatnonzero((some[at] if len(at) < len(some) else some) @ right[u : min(e, u + TILE[1])].T > -1e-3), min(e, u + TILE[1]) - u)
                if len(x):
                    found.append((by_old[s + at[x]], by_new[u + y]))
        if sum(len(x) for x, _ in found) >= BATCH:
            judge()
    if found:
        judge()
    return out
