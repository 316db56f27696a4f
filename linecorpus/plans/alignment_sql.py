"""Alignments in SQL: the table is filled row by row in one recursion and walked back in another.

``pr`` has the distinct pairs: ``k``, and the characters ``a`` and ``b``.
"""

from __future__ import annotations

# a row of costs: what comes from above or aslant, then the cheapest way along the row
_COSTS = """
    dp AS (
      SELECT k, 0 AS i, range(0, len(b) + 1) AS row FROM pr
      UNION ALL
      SELECT k, i, list_transform(range(1, len(cand) + 1), lambda q: list_min(cand[1:q]) + q) FROM (
        SELECT dp.k, dp.i + 1 AS i, list_transform(range(1, len(b) + 2), lambda q: CASE WHEN q = 1 THEN dp.i + 1 ELSE least(dp.row[q - 1] + (a[dp.i + 1] <> b[q - 1])::INT, dp.row[q] + 1) END - q) AS cand
        FROM dp JOIN pr ON pr.k = dp.k WHERE dp.i < len(a))
    )"""

# a row of the longest common subsequence: lengths grow along the row
_LENGTHS = """
    dp AS (
      SELECT k, 0 AS i, list_transform(range(0, len(b) + 1), lambda q: 0) AS row FROM pr
      UNION ALL
      SELECT k, i, list_transform(range(1, len(cand) + 1), lambda q: list_max(cand[1:q])) FROM (
        SELECT dp.k, dp.i + 1 AS i, list_transform(range(1, len(b) + 2), lambda q: CASE WHEN q = 1 THEN 0 ELSE greatest(dp.row[q], CASE WHEN a[dp.i + 1] = b[q - 1] THEN dp.row[q - 1] + 1 ELSE 0 END) END) AS cand
        FROM dp JOIN pr ON pr.k = dp.k WHERE dp.i < len(a))
    )"""

_EDIT_MOVE = """CASE WHEN w.i > 0 AND w.j > 0 AND a[w.i] = b[w.j] THEN 'match'
          WHEN w.i > 0 AND w.j > 0 AND h.row[w.j + 1] = u.row[w.j] + 1 THEN 'substitution'
          WHEN w.i > 0 AND h.row[w.j + 1] = u.row[w.j + 1] + 1 THEN 'deletion' ELSE 'insertion' END"""
_LCS_MOVE = """CASE WHEN w.i > 0 AND w.j > 0 AND a[w.i] = b[w.j] THEN 'match'
          WHEN w.j > 0 AND (w.i = 0 OR h.row[w.j] >= u.row[w.j + 1]) THEN 'ins' ELSE 'del' END"""


def _walk(move: str) -> str:
    return f"""
    walk AS (
      SELECT k, len(a) AS i, len(b) AS j, 0 AS step, '' AS t, '' AS p, '' AS op FROM pr
      UNION ALL
      SELECT k, i - (op NOT IN ('insertion', 'ins'))::INT, j - (op NOT IN ('deletion', 'del'))::INT, step + 1, CASE WHEN op IN ('insertion', 'ins') THEN '' ELSE a[i] END, CASE WHEN op IN ('deletion', 'del') THEN '' ELSE b[j] END, op FROM (
        SELECT w.k, w.i, w.j, w.step, a, b, {move} AS op
        FROM walk w JOIN pr ON pr.k = w.k JOIN dp h ON h.k = w.k AND h.i = w.i LEFT JOIN dp u ON u.k = w.k AND u.i = w.i - 1
        WHERE w.i > 0 OR w.j > 0)
    ), ev AS MATERIALIZED (
      SELECT k, max(step) OVER (PARTITION BY k) - step AS pos, t, p, op, step FROM walk
    ), events AS MATERIALIZED (
      SELECT k, pos, t, p, op FROM ev WHERE step > 0
    )"""


def edits(pairs: str) -> str:
    """``events(k, pos, t, p, op)`` of the pairs that the select ``pairs(k, a, b)`` gives: least-cost alignments."""
    return f"WITH RECURSIVE pr AS ({pairs}), {_COSTS}, {_walk(_EDIT_MOVE)} "


def differences(pairs: str) -> str:
    """The same for longest common subsequences."""
    return f"WITH RECURSIVE pr AS ({pairs}), {_LENGTHS}, {_walk(_LCS_MOVE)} "
