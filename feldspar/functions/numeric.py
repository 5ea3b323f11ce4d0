"""Number expressions with the float behaviour of a numeric array library (x/0 is infinite, 0/0 missing)."""

from __future__ import annotations

from math import exp

from pyspark.sql import Column
from pyspark.sql import functions as F

INF = float("inf")


def divide(a: Column, b: Column) -> Column:
    """a/b; x/0 gives infinity with the sign of x, and 0/0 gives null."""
    a, b = a.cast("double"), b.cast("double")
    by_zero = F.when(a > 0, F.lit(INF)).when(a < 0, F.lit(-INF))
    return F.when(b == 0, by_zero).otherwise(a / b)


def log1p(x: Column) -> Column:
    """ln(1+x); -infinity at -1 and null below."""
    x = x.cast("double")
    return F.when(x == -1, F.lit(-INF)).otherwise(F.log1p(x))


def round_even(x: Column, digits: int) -> Column:
    """Scale, round half to even, unscale."""
    scale = float(10**digits)
    return F.rint(x * F.lit(scale)) / F.lit(scale)


def is_infinite(x: Column) -> Column:
    return F.coalesce(F.abs(x.cast("double")) == F.lit(INF), F.lit(False))


def inverse_or_zero(x: Column) -> Column:
    """1/x, and 0 where x is 0."""
    return F.when(x == 0, F.lit(0.0)).otherwise(F.lit(1.0) / F.nullif(x.cast("double"), F.lit(0.0)))


def clip_max(x: Column, limit: float) -> Column:
    return F.when(x > limit, F.lit(limit)).otherwise(x)


def multiplicative_noise(x: Column, level: float, key: Column | None = None, seed: int = 7) -> Column:
    """x * (1 + level * standard normal), drawn from the key; level 0 is the identity."""
    if level == 0:
        return x
    if key is None:
        raise ValueError("noise above level 0 needs a key to be drawn from")
    return x * (F.lit(1.0) + F.lit(float(level)) * keyed_normal(key, seed))


def laplace_noise(x: Column, scale: float, key: Column, seed: int = 7) -> Column:
    """x + Laplace(0, scale), drawn from the key: the inverse distribution function of a uniform number."""
    u = keyed_uniform(key, seed) - F.lit(0.5)
    return x - F.lit(float(scale)) * F.signum(u) * F.log(F.lit(1.0) - 2 * F.abs(u))


def keyed_uniform(key: Column, seed: int = 0, part: int = 0) -> Column:
    """A repeatable number inside (0, 1), never an end, from 52 bits of the md5 of key and seed; a key has two such parts."""
    digits = F.substring(F.md5(F.concat(key.cast("string"), F.lit(f"#{seed}"))), 1 + 16 * part, 13)
    return (F.conv(digits, 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(1 << 52))


def keyed_normal(key: Column, seed: int = 0) -> Column:
    """A repeatable standard normal number: both uniform parts of the key by the transform of Box and Muller."""
    radius = F.sqrt(F.lit(-2.0) * F.log(keyed_uniform(key, seed, 0)))
    return radius * F.cos(F.lit(2.0) * F.pi() * keyed_uniform(key, seed, 1))


def keyed_poisson(key: Column, mean: float, seed: int = 0) -> Column:
    """A repeatable Poisson number: how many steps of the distribution function the key's uniform number passes."""
    steps, share, total = [], exp(-mean), 0.0
    while total + share < 1.0 and (share > 2.0**-52 or len(steps) <= mean):
        total += share
        steps.append(total)
        share *= mean / len(steps)
    u = keyed_uniform(key, seed)
    return F.size(F.filter(F.array(*[F.lit(s) for s in steps]), lambda s: s <= u))


def hash_share(key: Column, seed: int = 0) -> Column:
    """A repeatable uniform number in [0, 1) from the md5 of a key."""
    text = F.concat(key.cast("string"), F.lit(f"#{seed}")) if seed else key.cast("string")
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") / F.lit(float(1 << 32))


def hash_fold(key: Column, k: int) -> Column:
    """A repeatable fold number 0..k-1 from the md5 of a key."""
    return (F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("long") % k).cast("int")
