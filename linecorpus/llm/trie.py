"""Vocabulary trie and its intersection with a Levenshtein automaton.

The automaton is the usual one (insert, delete, substitute, each one edit),
widened by the edits of several letters that a channel has learnt (``rn`` read
for ``m``).  It is run over the trie as a set of states, so every vocabulary
word within the bound is found, whatever its edits cost.
"""

from __future__ import annotations

END = ""


class Plain:
    """A channel that knows nothing: every edit has the same log-probability."""

    multi: dict[str, list[tuple[str, str]]] = {}
    multi_back: dict[str, list[tuple[str, str]]] = {}

    def edit(self, true: str, read: str) -> float:
        return -1.0


def _grown(words, backwards: bool) -> dict:
    root: dict = {}
    for w, n in words:
        node = root
        for x in reversed(w) if backwards else w:
            node = node.setdefault(x, {})
        node[END] = max(n, node.get(END, 0))
    return root


class Trie:
    """Vocabulary as nested dictionaries, once forwards and once backwards; a word's count stands at its end."""

    def __init__(self, words):
        words = list(words)
        self.root, self.back = _grown(words, False), _grown(words, True)

    def count(self, word: str) -> int:
        node = self.root
        for x in word:
            node = node.get(x)
            if node is None:
                return 0
        return node.get(END, 0)

    def __contains__(self, word: str) -> bool:
        return self.count(word) > 0

    def within(self, word: str, k: int = 1, channel=None, floor: float = float("-inf")) -> dict[str, tuple[int, float]]:
        """All vocabulary words within ``k`` edits that are read as ``word`` with a log-probability of ``floor`` or more: word to (count, that).

        Of ``k`` edits at most ``k // 2`` lie in the first half or fewer than
        ``k / 2`` in the second, so the trie is searched from both ends, each
        time with few edits near its root, where it is broad.
        """
        channel = channel or Plain()
        out: dict[str, tuple[int, float]] = {}
        half = len(word) // 2
        self._search(self.root, word, k, k // 2, half, channel.edit, channel.multi, floor, False, out)
        # an edit of two letters that spans the middle is left to the second half
        self._search(self.back, word[::-1], k, k - k // 2 - 1, max(0, len(word) - half - 1), channel.edit, channel.multi_back, floor, True, out)
        return out

    @staticmethod
    def _search(root: dict, word: str, k: int, first: int, half: int, edit, multi, floor: float, backwards: bool, out: dict) -> None:
        """States of the automaton over the trie; at most ``first`` edits among the first ``half`` letters."""
        n = len(word)
        stack = [(root, 0, k, 0.0, "")]
        while stack:
            node, i, left, logp, made = stack.pop()
            if logp < floor:
                continue
            # without further edits the rest of the word must lie in the trie as it is
            if not left or (i < half and k - left >= first):
                x, at, stop = node, i, n if not left else half
                while at < stop and (x := x.get(word[at])) is not None:
                    at += 1
                if x is None or at < stop:
                    continue
                made += word[i:stop]
                if not left:
                    if END in x:
                        full = made[::-1] if backwards else made
                        if full not in out or out[full][1] < logp:
                            out[full] = (x[END], logp)
                    continue
                node, i = x, stop
            if i == n:
                if END in node:
                    full = made[::-1] if backwards else made
                    if full not in out or out[full][1] < logp:
                        out[full] = (node[END], logp)
                for ch, nxt in node.items():
                    if ch:
                        stack.append((nxt, i, left - 1, logp + edit(ch, ""), made + ch))
                continue
            cur = word[i]
            same = node.get(cur)
            if same is not None:
                stack.append((same, i + 1, left, logp, made + cur))
            stack.append((node, i + 1, left - 1, logp + edit("", cur), made))
            for ch, nxt in node.items():
                if ch:
                    if ch != cur:
                        stack.append((nxt, i + 1, left - 1, logp + edit(ch, cur), made + ch))
                    stack.append((nxt, i, left - 1, logp + edit(ch, ""), made + ch))
            for read, true in multi.get(cur, ()):
                if word.startswith(read, i):
                    x = node
                    for ch in true:
                        x = x.get(ch)
                        if x is None:
                            break
                    if x is not None:
                        p = edit(true[::-1], read[::-1]) if backwards else edit(true, read)
                        stack.append((x, i + len(read), left - 1, logp + p, made + true))
