"""What scanning does to words, and what words look like, both learnt from the corpus.

:class:`Channel` holds the probability of every edit (letters read for others,
signs put in, letters lost), counted from pairs of readings of one line: of two
tokens in the same place, the one that the vocabulary knows is the truth.  An
edit that was never seen keeps the probability that all unseen ones share, so
no candidate is shut out.

:class:`Spelling` tells how likely a word that the vocabulary lacks is right
all the same: by its letters (a trigram model) and by the endings that turn
known words into others (``settle`` and ``settles``).
"""

from __future__ import annotations

import math
from collections import Counter

#: letters that one edit may replace by how many
SPAN = 2
#: letters of the two endings of one stem
TAIL = 3
#: letters that a stem has at least
STEM = 3
#: stems that must have both of two endings
OFTEN = 3
#: signs before and after a word
FIRST, LAST = "\x02", "\x03"


def edit_of(true: str, read: str) -> tuple[str, str] | None:
    """The one edit between two tokens, without what they share at both ends; None if it spans too much."""
    n = 0
    while n < len(true) and n < len(read) and true[n] == read[n]:
        n += 1
    m = 0
    while m < len(true) - n and m < len(read) - n and true[-1 - m] == read[-1 - m]:
        m += 1
    a, b = true[n : len(true) - m], read[n : len(read) - m]
    return (a, b) if (a or b) and len(a) <= SPAN and len(b) <= SPAN else None


class Channel:
    """Log-probabilities of edits; ``seen`` counts ``(true, read)``, ``letters`` how often each letter was looked at."""

    def __init__(self, seen: dict[tuple[str, str], int], letters: dict[str, int]):
        total = sum(letters.values())
        once = sum(1 for n in seen.values() if n == 1)
        alphabet = max(30, len(letters))
        # what unseen edits share, and no less than one in a million letters
        self.unseen = math.log(max(1e-6, (once + 1) / (total + 1000)) / alphabet)
        self.logs: dict[tuple[str, str], float] = {}
        #: edits of several letters seen more than once or twice: by the first letter read, and reversed by the last
        self.multi: dict[str, list[tuple[str, str]]] = {}
        self.multi_back: dict[str, list[tuple[str, str]]] = {}
        for (a, b), n in seen.items():
            at = total if not a else min(letters.get(x, 0) for x in a)
            p = n / (max(at, n) + 100)
            if math.log(p) > self.unseen:
                self.logs[a, b] = math.log(p)
            if n > 2 and b and (len(a) > 1 or len(b) > 1):
                self.multi.setdefault(b[0], []).append((b, a))
                self.multi_back.setdefault(b[-1], []).append((b[::-1], a[::-1]))

    def edit(self, true: str, read: str) -> float:
        return self.logs.get((true, read), self.unseen)


class Spelling:
    """Log-probability of a right word that the vocabulary lacks."""

    def __init__(self, words: list[tuple[str, int]], unknown: float):
        """``unknown`` is the share of tokens that are right and unknown."""
        tri, have, stems = Counter(), Counter(), {}
        for w, _ in words:
            s = f"{FIRST}{FIRST}{w}{LAST}"
            tri.update(s[i - 2 : i + 1] for i in range(2, len(s)))
            for t in range(TAIL + 1):
                if len(w) - t >= STEM:
                    stems.setdefault(w[: len(w) - t], []).append(w[len(w) - t :])
                    have[w[len(w) - t :]] += 1
        ends: Counter = Counter()
        for tails in stems.values():
            tails = [t for t in tails if have[t] >= OFTEN]
            ends.update((a, b) for a in tails for b in tails if a != b)
        self._fit(len(words), tri, have, ends, unknown)

    @classmethod
    def counted(cls, types: int, tri: dict[str, int], have: dict[str, int], ends: dict[tuple[str, str], int], unknown: float) -> Spelling:
        """From counts over ``types`` words: trigrams, stems that have an ending, stems that have both of two endings; below :data:`OFTEN` the last two may be left out."""
        out = cls.__new__(cls)
        out._fit(types, tri, have, ends, unknown)
        return out

    def _fit(self, types: int, tri: dict[str, int], have: dict[str, int], ends: dict[tuple[str, str], int], unknown: float) -> None:
        self.log_unknown = math.log(unknown)
        self.types = max(1, types)
        self.tri, self.bi, self.uni = Counter(tri), Counter(), Counter()
        for g, n in tri.items():
            self.bi[g[1:]] += n
            self.uni[g[2:]] += n
        self.pre3, self.pre2 = Counter(), Counter()
        for g, n in self.tri.items():
            self.pre3[g[:2]] += n
        for g, n in self.bi.items():
            self.pre2[g[:1]] += n
        self.total = sum(self.uni.values()) or 1
        self.size = len(self.uni) + 1
        # endings: of all stems that have one ending, the share that has the other too
        self.ends = Counter({ab: n for ab, n in ends.items() if n >= OFTEN})
        self.have = Counter(have)

    def letters(self, word: str) -> float:
        s, out = f"\x02\x02{word}\x03", 0.0
        for i in range(2, len(s)):
            p1 = (self.uni[s[i]] + 0.5) / (self.total + 0.5 * self.size)
            n2, n3 = self.pre2[s[i - 1]], self.pre3[s[i - 2 : i]]
            p2 = (self.bi[s[i - 1 : i + 1]] + 4 * p1) / (n2 + 4)
            p3 = (self.tri[s[i - 2 : i + 1]] + 4 * p2) / (n3 + 4)
            out += math.log(p3)
        return out

    def derived(self, known: str, word: str) -> float:
        """Log-probability that ``word`` is another form of ``known``, by their endings."""
        n = 0
        while n < len(known) and n < len(word) and known[n] == word[n]:
            n += 1
        best = 0.0
        for cut in range(max(STEM, len(known) - TAIL, len(word) - TAIL), n + 1):
            a, b = known[cut:], word[cut:]
            c = self.ends[a, b]
            if c >= OFTEN:
                best = max(best, c / (self.have[a] + 10))
        return math.log(best / self.types) if best else -math.inf

    def right(self, word: str, known=()) -> float:
        """``known`` are vocabulary words near ``word``."""
        return self.log_unknown + max([self.letters(word), *(self.derived(v, word) for v in known)])
