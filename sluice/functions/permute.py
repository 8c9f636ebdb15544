"""A keyed permutation of 0..n-1 for any n, as a column expression (no sort, no shuffle).

A Feistel network over a rectangle of a x b >= n places (a and b next to the root of n): a number is a
pair (row, column), and every round adds a hash of one to the other, which can be undone, so the
network permutes the rectangle. A number that lands behind n - 1 walks on through the network until
it does not (there are fewer than a such places), which permutes 0..n-1. Neighbours end up
unrelated, unlike under i -> a * i + b mod n, where their difference is constant.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from .expressions import hex_to_long

ROUNDS = 4
#: Steps of a walk. Fewer than a places are out of range, so walks of n <= 1024 are never longer; for larger n
#: a longer one has chance n ** -16 and fails the job instead of breaking the permutation.
WALKS = 32
HEX_DIGITS = 13


def rectangle(n: int) -> tuple[int, int]:
    """(a, b) with a * b >= n, a * b - n < a."""
    a = max(1, math.isqrt(max(n, 1) - 1) + 1)
    return a, max(1, -(-n // a))


def _hash(key: str, step: Column, value: Column) -> Column:
    return hex_to_long(F.md5(F.concat_ws("|", F.lit(key), step.cast("string"), value.cast("string"))), 1, HEX_DIGITS)


def permuted(idx: Column, n: int, key: str) -> Column:
    """Where `idx` (0 <= idx < n) goes under the permutation that `key` names."""
    a, b = rectangle(n)

    def network(y: Column) -> Column:
        start = F.struct(F.floor(y / F.lit(b)).cast("long").alias("u"), (y % F.lit(b)).alias("v"))

        def turn(p: Column, i: Column) -> Column:
            even = F.struct(((p["u"] + _hash(key, i, p["v"])) % F.lit(a)).alias("u"), p["v"].alias("v"))
            odd = F.struct(p["u"].alias("u"), ((p["v"] + _hash(key, i, p["u"])) % F.lit(b)).alias("v"))
            return F.when(i % 2 == 0, even).otherwise(odd)
        return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, turn, lambda p: p["u"] * F.lit(b) + p["v"])
    walk = F.aggregate(F.sequence(F.lit(1), F.lit(WALKS)), idx.cast("long"),
                       lambda y, i: F.when((i > 1) & (y < n), y).otherwise(network(y)))
    return F.when(walk < n, walk).otherwise(F.raise_error(F.lit("a walk of the permutation is too long")).cast("long"))
