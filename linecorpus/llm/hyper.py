"""Hyperdimensional letter-n-gram profiles.

Every letter has a random vector of +1 and -1, seeded by its code point, so all
machines hold the same ones without exchanging them.  An n-gram's vector binds
(multiplies) its letters' vectors, each permuted (rotated) by its place; a
text's vector bundles (adds) those of its n-grams.  A language's prototype is
the bundle of its training words.  Since bundling is a sum, a word's cosine
with a prototype is the mean of its n-grams' products with it, and these are
remembered per n-gram and per word.
"""

from __future__ import annotations

import math
import re
import unicodedata

import numpy as np

DIMS = 6144
SIZES = (1, 2, 3, 4)
#: words kept per process; then the memory is cleared
CACHE = 300_000


class Letters:
    def __init__(self, dims: int = DIMS, seed: int = 7):
        self.dims, self.seed, self.known = dims, seed, {}

    def vector(self, ch: str, place: int) -> np.ndarray:
        v = self.known.get((ch, place))
        if v is None:
            base = np.random.Generator(np.random.PCG64([self.seed, ord(ch)])).integers(0, 2, self.dims, dtype=np.int8) * 2 - 1
            v = self.known[ch, place] = np.roll(base, place).astype(np.int8)
        return v

    def gram(self, g: str) -> np.ndarray:
        out = self.vector(g[0], 0)
        for i in range(1, len(g)):
            out = out * self.vector(g[i], i)
        return out


def spell(word: str) -> str:
    """The letters of a word as profiles see them: upper case, accents off."""
    up = word.upper()
    if not up.isascii():
        up = "".join(x for x in unicodedata.normalize("NFD", up) if not unicodedata.combining(x))
    return re.sub(r"[\W\d_]", "", up)


def grams(letters: str, sizes=SIZES) -> list[str]:
    padded = f"\x02{letters}\x03"
    out = list(letters) if 1 in sizes else []
    for n in sizes:
        if n > 1:
            out += [padded[i : i + n] for i in range(len(padded) - n + 1)]
    return out


class Profiles:
    """Prototypes of several classes and the words' cosines with them."""

    def __init__(self, names: list[str], vectors: np.ndarray, dims: int, seed: int, sizes=SIZES):
        self.names, self.vectors, self.letters, self.sizes = names, vectors.astype(np.float32), Letters(dims, seed), sizes
        self.by_gram: dict[str, np.ndarray] = {}
        self.by_word: dict[str, tuple] = {}

    @classmethod
    def train(cls, words: dict[str, list[str]], dims: int = DIMS, seed: int = 7, sizes=SIZES, epochs: int = 24) -> Profiles:
        """One prototype for each class from its words; n-grams count by the logarithm of their number.

        In ``epochs`` further passes each word that is taken for another class,
        or nearly so, is added to its own prototype and taken from the other.
        """
        letters, k = Letters(dims, seed), len(words)
        spelt = [(c, gs) for c, ws in enumerate(words.values()) for w in ws if (gs := grams(spell(w), sizes) if spell(w) else [])]
        index: dict[str, int] = {}
        ids = np.array([index.setdefault(g, len(index)) for _, gs in spelt for g in gs], np.int64)
        size = np.array([len(gs) for _, gs in spelt], np.int64)
        start = np.cumsum(size) - size
        cls_of = np.array([c for c, _ in spelt], np.int64)
        matrix = np.array([letters.gram(g) for g in index], np.int8).reshape(len(index), dims)
        slabs = [slice(i, i + 4096) for i in range(0, len(index), 4096)]

        def bundle(coef: np.ndarray) -> np.ndarray:
            return sum((coef[:, s] @ matrix[s].astype(np.float32) for s in slabs), np.zeros((k, dims), np.float32))

        total = np.maximum(1, np.bincount(cls_of, minlength=k)).astype(np.float32)
        counts = np.zeros((k, len(index)), np.float32)
        np.add.at(counts, (np.repeat(cls_of, size), ids), 1.0)
        v = bundle(np.log1p(1000 * counts / total[:, None]))
        v /= np.maximum(1e-9, np.linalg.norm(v, axis=1, keepdims=True))
        weight = np.sqrt(total.max() / total)
        best, rows = (math.inf, v), np.arange(len(spelt))
        for e in range(epochs + 1 if len(spelt) and k > 1 else 0):
            by_gram = np.concatenate([matrix[s].astype(np.float32) @ v.T for s in slabs])
            score = np.add.reduceat(by_gram[ids], start, axis=0) / np.sqrt(size * dims)[:, None]
            own = score[rows, cls_of]
            score[rows, cls_of] = -9.0
            other = score.argmax(axis=1)
            lead = own - score[rows, other]
            wrong = float(weight[cls_of][lead < 0].sum())
            if wrong < best[0]:
                best = wrong, v
            near = lead < 0.015
            if e == epochs or not near.any():
                break
            coef = np.zeros((k, len(index)), np.float32)
            by = np.where(near, weight[cls_of] / np.sqrt(size * dims), 0).astype(np.float32)
            np.add.at(coef, (np.repeat(cls_of, size), ids), np.repeat(by, size))
            np.add.at(coef, (np.repeat(other, size), ids), -np.repeat(by, size))
            v = v + 0.0008 / (1 + e / 4) * bundle(coef)
            v /= np.maximum(1e-9, np.linalg.norm(v, axis=1, keepdims=True))
        return cls(list(words), best[1], dims, seed, sizes)

    def word(self, word: str) -> np.ndarray:
        """Cosines of one word with every prototype."""
        s = spell(word)
        gs = grams(s, self.sizes) if s else []
        if not gs:
            return np.zeros(len(self.names), np.float32)
        if len(self.by_gram) > CACHE:
            self.by_gram.clear()
        total = np.zeros(len(self.names), np.float32)
        for g in gs:
            p = self.by_gram.get(g)
            if p is None:
                p = self.by_gram[g] = self.vectors @ self.letters.gram(g).astype(np.float32)
            total += p
        return total / math.sqrt(len(gs) * self.letters.dims)
