"""Keyed permutations of [0, n) as column expressions: no sort, no exchange, and an inverse.

A number is a pair (left, right) of digits, ``left`` below ``a`` and ``right`` below ``b``, with ``a * b`` barely above
``n``.  Rounds of a Feistel network add to either digit a mixture of the other, which can be undone whatever the
mixture is.  A result of ``n`` or more goes through the network again until it falls below (cycle walking); there are
``a * b - n`` such numbers, so that many steps always suffice, and hardly any row takes one.
"""

from __future__ import annotations

import math
import random

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.functions.text import let

PRIME = (1 << 31) - 1
ROUNDS = 6
# How many values of ``a`` from the square root of ``n`` on are looked at.
CHOICES = 64


def digits(n: int) -> tuple[int, int]:
    """(a, b): the factors from the square root on that leave the fewest numbers above ``n``."""
    root = max(1, math.isqrt(n))
    a = min(range(root, root + CHOICES), key=lambda x: (-n % x, x))
    return a, max(1, -(-n // a))


def keys(seed: int, rounds: int = ROUNDS) -> list[tuple[int, int, int]]:
    """Multiplier and two summands of each round."""
    rng = random.Random(seed)
    return [(rng.randrange(1, PRIME), rng.randrange(PRIME), rng.randrange(PRIME)) for _ in range(rounds)]


def _network(x: Column, n: int, seed: int, back: bool) -> Column:
    """All rounds in one fold over their keys, so that the expression stays small."""
    a, b = digits(n)
    big = F.lit(b).cast("long")
    order = list(enumerate(keys(seed)))
    rounds = [
        F.struct(*[F.lit(v).cast("long").alias(f) for f, v in zip(("on_left", "m", "c", "d"), (k % 2 == 0, *key))])
        for k, key in (reversed(order) if back else order)
    ]

    def turn(s: Column, k: Column) -> Column:
        on_left = k["on_left"] == 1
        t = (F.when(on_left, s["r"]).otherwise(s["l"]) * k["m"] + k["c"]) % F.lit(PRIME)
        below = F.when(on_left, F.lit(a)).otherwise(F.lit(b))
        move = ((t * t + k["d"]) % F.lit(PRIME)) % below
        moved = (F.when(on_left, s["l"]).otherwise(s["r"]) + (below - move if back else move)) % below
        return F.struct(F.when(on_left, moved).otherwise(s["l"]).alias("l"), F.when(on_left, s["r"]).otherwise(moved).alias("r"))

    start = F.struct(F.call_function("div", x, big).alias("l"), (x % big).alias("r"))
    return F.aggregate(F.array(*rounds), start, turn, lambda s: s["l"] * big + s["r"])


def _walked(x: Column, n: int, seed: int, back: bool) -> Column:
    a, b = digits(n)
    out = _network(x.cast("long"), n, seed, back)
    spare = a * b - n
    if not spare:
        return out

    def more(y: Column) -> Column:
        again = F.aggregate(F.sequence(F.lit(1), F.lit(spare)), y, lambda acc, _: F.when(acc < n, acc).otherwise(_network(acc, n, seed, back)))
        return F.when(y < n, y).when(y >= n, again)

    return let(out, more)


def permute(x: Column, n: int, seed: int = 0) -> Column:
    """Where the permutation of [0, n) puts ``x``; null stays null.  ``n`` is at most 2**61."""
    return _walked(x, n, seed, back=False)


def unpermute(x: Column, n: int, seed: int = 0) -> Column:
    """The number that ``permute`` puts at ``x``."""
    return _walked(x, n, seed, back=True)
