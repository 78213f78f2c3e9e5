"""Plain-Python brute force of the detector semantics, for small fixtures."""

from __future__ import annotations

from fractions import Fraction


def brute_scores(rows, factor=3.0, max_gap=20):
    """rows: iterable of dicts with seq, user_id, txn_time, amount, location.

    Returns {seq: (amount_score, velocity_score, location_score)}.
    """
    by_user = {}
    for r in sorted(rows, key=lambda r: r["seq"]):
        by_user.setdefault(r["user_id"], []).append(r)
    out = {}
    for rs in by_user.values():
        total = count = None
        prev_time = None
        first_loc = None
        for i, r in enumerate(rs):
            a = Fraction(str(r["amount"]))
            if i == 0:
                total, count = a, 1
                prev_time = r["txn_time"]
                first_loc = r["location"]
                out[r["seq"]] = (0, 0, 0)
                continue
            if a >= (total / count) * Fraction(str(factor)):
                sa = 1
            else:
                sa = 0
                total += a
                count += 1
            sv = 1 if r["txn_time"] - prev_time <= max_gap else 0
            prev_time = r["txn_time"]
            sl = 1 if r["location"] != first_loc else 0
            out[r["seq"]] = (sa, sv, sl)
    return out
