"""Numbers, arrays and hashes as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def softmax(logits: Column, temperature: float = 1.0) -> Column:
    """Probabilities of an array of logits, shifted by their maximum."""
    top = F.array_max(logits)
    powers = F.transform(logits, lambda x: F.exp((x - top) / temperature))
    total = F.aggregate(powers, F.lit(0.0), lambda a, x: a + x)
    return F.transform(powers, lambda x: x / total)


def one_hot(options: Column, target: Column) -> Column:
    """1 at the target's place among options, else 0."""
    return F.transform(options, lambda o: (o == target).cast("double"))


def cross_entropy(probabilities: Column, target: Column) -> Column:
    parts = F.zip_with(probabilities, target, lambda p, t: F.when(t == 0, 0.0).otherwise(-t * F.ln(F.greatest(p, F.lit(1e-300)))))
    return F.aggregate(parts, F.lit(0.0), lambda a, x: a + x)


def brier(probabilities: Column, target: Column) -> Column:
    return F.aggregate(F.zip_with(probabilities, target, lambda p, t: (p - t) * (p - t)), F.lit(0.0), lambda a, x: a + x)


def ranked_probability(probabilities: Column, target: Column) -> Column:
    """Squared distance of cumulative distributions over ordered options, divided by options less one."""
    start = F.struct(F.lit(0.0).alias("c"), F.lit(0.0).alias("s"))
    parts = F.zip_with(probabilities, target, lambda p, t: p - t)
    total = F.aggregate(parts, start, lambda a, x: F.struct((a["c"] + x).alias("c"), (a["s"] + (a["c"] + x) * (a["c"] + x)).alias("s")), lambda a: a["s"])
    return F.when(F.size(probabilities) > 1, total / (F.size(probabilities) - 1)).otherwise(0.0)


def entropy(probabilities: Column) -> Column:
    """Entropy over its largest value for that many options; 0 for one option."""
    parts = F.transform(probabilities, lambda p: F.when(p > 0, -p * F.ln(p)).otherwise(0.0))
    return F.when(F.size(probabilities) > 1, F.aggregate(parts, F.lit(0.0), lambda a, x: a + x) / F.ln(F.size(probabilities))).otherwise(0.0)


def argmax(values: Column) -> Column:
    """Index from 0 of the first largest value."""
    return (F.array_position(values, F.array_max(values)) - 1).cast("int")


def wilson_upper(errors: Column, n: Column, z: float = 1.959963984540054) -> Column:
    """Upper end of Wilson's interval for errors among n; 1 for none."""
    p = errors / n
    centre, spread = p + z * z / (2 * n), z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n))
    return F.when(n == 0, 1.0).otherwise(F.least(F.lit(1.0), (centre + spread) / (1 + z * z / n)))


def bin_of(value: Column, bins: int = 10) -> Column:
    """Index of the equal-width bin of a value in 0..1, its upper end in the last."""
    return F.least(F.lit(bins - 1), F.floor(value * bins)).cast("int")


def nearest_rank(values: Column, share: float) -> Column:
    """Element of a sorted array at round-half-even(share * (n - 1)); null if empty."""
    return F.when(F.size(values) > 0, F.element_at(values, (F.bround(share * (F.size(values) - 1)) + 1).cast("int")))


def exclusive_quantile(values: Column, share: float) -> Column:
    """Quantile of a sorted array at share * (n + 1), interpolated, held to the ends."""
    n = F.size(values)
    at = F.greatest(F.least(F.lit(share) * (n + 1), n.cast("double")), F.lit(1.0))
    low = F.floor(at).cast("int")
    a, b = F.element_at(values, low), F.element_at(values, F.least(low + 1, n))
    return F.when(n > 0, a + (at - low) * (b - a))


def affine(i: Column, multiplier: int, shift: int, n: Column) -> Column:
    """(multiplier * i + shift) mod n: a permutation of 0..n-1 if multiplier and n share no factor."""
    return F.pmod(i * multiplier + shift, n)


def coprime(n: int, start: int) -> int:
    """The first multiplier from start on that shares no factor with n."""
    import math

    return next(a for a in range(max(1, start), max(1, start) + n + 1) if math.gcd(a, n) == 1)


def diagonal_pair(position: Column, na: int, nb: int) -> tuple[Column, Column]:
    """position in 0..na*nb-1 as a pair (i, j), walking diagonals of the product."""
    import math

    turn = na * nb // math.gcd(na, nb)
    return F.pmod(position, F.lit(na)), F.pmod(position + F.floor(position / turn), F.lit(nb))


def part_of(key: Column, parts: int) -> Column:
    """A stable part number of a key."""
    return F.pmod(F.xxhash64(key), F.lit(parts)).cast("int")


def hash_rank(seed: str, *keys: Column) -> Column:
    """A digest to order rows by: a seeded pseudorandom order that any engine with md5 repeats."""
    return F.md5(F.concat_ws("|", F.lit(seed), *(k.cast("string") for k in keys)))
