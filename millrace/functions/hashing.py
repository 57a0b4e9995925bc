"""Pseudo-random numbers that depend on a row's key and a seed, and on nothing else.

A retried task, another partitioning or another engine gives the same draw, which
`rand()` cannot promise.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

_DIGITS = 13  # hexadecimal digits taken from the digest: 52 bits, exact in a double
_SPAN = float(1 << (4 * _DIGITS))


def hash_uniform(key: Column, *parts: Column | int | str) -> Column:
    """Uniform number in [0, 1) made from the MD5 digest of `key:part:...`, the seed first."""
    rest = [p.cast("string") if isinstance(p, Column) else F.lit(str(p)) for p in parts]
    text = F.concat(F.coalesce(key.cast("string"), F.lit("")), *[F.concat(F.lit(":"), p) for p in rest])
    digest = F.md5(text.cast("binary"))
    return F.conv(F.substring(digest, 1, _DIGITS), 16, 10).cast("bigint") / F.lit(_SPAN)


def hash_normals(key: Column, n: int, *parts: Column | int | str) -> Column:
    """Array of `n` standard normal numbers; one digest of `key:part:...:pair` makes two of them.

    Its first and second 13 digits are two uniform numbers, and these a pair by Box-Muller. Each
    step is an array of its own, so that no digest is computed twice.
    """
    rest = [p.cast("string") if isinstance(p, Column) else F.lit(str(p)) for p in parts]
    head = F.concat(F.coalesce(key.cast("string"), F.lit("")), *[F.concat(F.lit(":"), p) for p in rest], F.lit(":"))
    pairs = F.array(*[F.lit(str(p)) for p in range((n + 1) // 2)])
    digests = F.transform(pairs, lambda p: F.md5(F.concat(head, p).cast("binary")))

    def uniform(digest: Column, start: int) -> Column:
        return F.conv(F.substring(digest, start, _DIGITS), 16, 10).cast("bigint") / F.lit(_SPAN)

    polar = F.transform(
        digests,
        lambda d: F.struct(
            F.sqrt(F.lit(-2.0) * F.log(1 - uniform(d, 1))).alias("radius"),
            (F.lit(2.0 * math.pi) * uniform(d, 1 + _DIGITS)).alias("angle"),
        ),
    )
    both = F.transform(polar, lambda s: F.array(s["radius"] * F.cos(s["angle"]), s["radius"] * F.sin(s["angle"])))
    return F.slice(F.flatten(both), 1, n)
