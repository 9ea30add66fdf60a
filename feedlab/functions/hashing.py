"""Randomness as a function of keys.

Every draw is a hash of the row's own keys and a seed, so results do not depend
on partitioning, task retries or the order of rows. Two hashes are offered:
``xxhash64`` is the fast one; ``md5`` gives the same numbers in other SQL
engines and is used where results are compared with them.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

HASHES = ("xxhash64", "md5")
MD5_SPAN = 16.0 ** 15
XX_SPAN = 2.0 ** 53


def md5_long(text: Column) -> Column:
    """First 15 hex digits of the md5 as BIGINT."""
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def _joined(parts: tuple[Column, ...]) -> Column:
    return F.concat_ws(":", *[p.cast("string") for p in parts])


def hash_long(*parts: Column, method: str = "xxhash64") -> Column:
    """Non-negative hash of the parts."""
    if method == "md5":
        return md5_long(_joined(parts))
    if method == "xxhash64":
        return F.shiftrightunsigned(F.xxhash64(*parts), 1)
    raise ValueError(f"method must be one of {HASHES}")


def uniform(*parts: Column, method: str = "xxhash64") -> Column:
    """Uniform number in [0, 1)."""
    if method == "md5":
        return hash_long(*parts, method=method) / F.lit(MD5_SPAN)
    return F.shiftrightunsigned(F.xxhash64(*parts), 11) / F.lit(XX_SPAN)


# The five primes of XXH64.
XX_PRIMES = (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)
XX_SEED = 42  # of Spark's own function
_WORD = (1 << 64) - 1


def _rotated(x: int, bits: int) -> int:
    return ((x << bits) | (x >> (64 - bits))) & _WORD


def _unshifted(x: int, bits: int) -> int:
    """The x that ``x ^ (x >> bits)`` came from."""
    found = x
    for _ in range(64 // bits):
        found = x ^ (found >> bits)
    return found


def number_hashed_to(wanted: int) -> int:
    """The eight-byte number whose hash by Spark's function is ``wanted``: every step of the hash can be undone."""
    p1, p2, p3, p4, p5 = XX_PRIMES
    undo = {p: pow(p, -1, 1 << 64) for p in (p1, p2, p3)}
    h = _unshifted(wanted & _WORD, 32) * undo[p3] & _WORD
    h = _unshifted(h, 29) * undo[p2] & _WORD
    h = (_unshifted(h, 33) - p4) * undo[p1] & _WORD
    lane = _rotated(h, 64 - 27) ^ (XX_SEED + p5 + 8)
    number = _rotated(lane * undo[p1] & _WORD, 64 - 31) * undo[p2] & _WORD
    return number - (1 << 64) if number >> 63 else number


def xxh64(key: Column, seed: int = 0) -> Column:
    """XXH64 of a BIGINT's eight bytes (an INT's four) with any seed, as the library of that name gives it.

    Spark's function hashes its arguments one after the other, each seeded by the hash of those before it. A first
    argument whose hash is ``seed`` thus seeds the next one. The result is the signed form of the unsigned hash.
    """
    return F.xxhash64(F.lit(number_hashed_to(seed)), key)


def unsigned_mod(number: Column, divisor: int) -> Column:
    """Remainder of a BIGINT read as an unsigned number."""
    rest = F.pmod(number, F.lit(divisor))
    return F.when(number < 0, F.pmod(rest + (1 << 64) % divisor, F.lit(divisor))).otherwise(rest)


def bucket(key: Column, buckets: int, method: str = "xxhash64", tag: str = "bucket") -> Column:
    """Bucket number in [0, buckets).

    With ``xxhash64`` and the default tag the bucket is XXH64 with seed 0, unsigned, modulo ``buckets``, as analytic
    databases compute it. Other tags are hashed in front of the key, so their buckets are independent of these.
    """
    if method == "md5":
        return (md5_long(_joined((F.lit(tag), key))) % buckets).cast("int")
    if method != "xxhash64":
        raise ValueError(f"method must be one of {HASHES}")
    hashed = xxh64(key) if tag == "bucket" else F.xxhash64(F.lit(tag), key)
    return unsigned_mod(hashed, buckets).cast("int")


def poisson_cdf(last: int = 18) -> list[float]:
    """P(X <= k) of Poisson(1) for k = 0 … last - 1."""
    total, steps = 0.0, []
    for k in range(last):
        total += math.exp(-1.0) / math.factorial(k)
        steps.append(total)
    return steps


def poisson_weight(u: Column) -> Column:
    """Poisson(1) draw by inverting the distribution at ``u``."""
    steps = poisson_cdf()
    weight = F.when(u < steps[0], 0)
    for k, step in enumerate(steps[1:], start=1):
        weight = weight.when(u < step, k)
    return weight.otherwise(len(steps))
