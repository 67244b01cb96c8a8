"""Keyed permutations of 0..n-1 as Spark column expressions.

A Feistel network over Z_a x Z_b with a = ceil(sqrt n) and b = ceil(n / a):
halves are changed in turn by adding a keyed hash of the other half modulo
the half's size, which is a bijection of the a*b values.  Fewer than ``a``
of them lie outside 0..n-1; such a value is permuted again until it falls
inside (cycle walking), so the whole is a bijection of 0..n-1.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ROUNDS = 8
# A walk visits each outside value at most once, and there are fewer than a
# of those: below a = 64 this many steps always suffice.  Above, each step
# stays outside with probability under 1/64, and a walk that still did not
# end raises an error instead of returning a wrong value.
WALK = 64


def _mix(key: str, tweak: Column, i: Column, half: Column, secure: bool) -> Column:
    """Keyed hash of a half as a long; ``secure`` takes SHA-256 instead of xxHash."""
    if not secure:
        return F.xxhash64(F.lit(key), tweak, i, half)
    text = F.concat_ws("\x1f", F.lit(key), tweak, i.cast("string"), half.cast("string"))
    return F.conv(F.substr(F.sha2(text, 256), F.lit(1), F.lit(15)), 16, 10).cast("long")


def _once(x: Column, a: Column, b: Column, key: str, tweak: Column, secure: bool) -> Column:
    start = F.struct(F.floor(x / b).cast("long").alias("l"), F.pmod(x, b).alias("r"))

    def step(acc: Column, i: Column) -> Column:
        l, r = acc["l"], acc["r"]
        new_l = F.pmod(l + F.pmod(_mix(key, tweak, i, r, secure), a), a)
        new_r = F.pmod(r + F.pmod(_mix(key, tweak, i, l, secure), b), b)
        even = i % 2 == 0
        return F.struct(F.when(even, new_l).otherwise(l).alias("l"),
                        F.when(even, r).otherwise(new_r).alias("r"))

    rounds = F.array(*[F.lit(i) for i in range(ROUNDS)])
    return F.aggregate(rounds, start, step, lambda acc: acc["l"] * b + acc["r"])


def permute(x: Column, n: Column, key: str, tweak: Column | None = None, secure: bool = False) -> Column:
    """Position of ``x`` (0 <= x < n < 2**52) under the permutation named by ``key``."""
    tweak = F.lit("") if tweak is None else tweak
    x, n = x.cast("long"), n.cast("long")
    a = F.greatest(F.ceil(F.sqrt(n.cast("double"))).cast("long"), F.lit(1).cast("long"))
    b = F.greatest(F.ceil(n / a).cast("long"), F.lit(1).cast("long"))
    steps = F.array(*[F.lit(i) for i in range(WALK)])
    out = F.aggregate(steps, _once(x, a, b, key, tweak, secure),
                      lambda acc, i: F.when(acc < n, acc).otherwise(_once(acc, a, b, key, tweak, secure)))
    return F.when(out < n, out).otherwise(
        F.raise_error(F.lit("cycle walk did not end")).cast("long"))
