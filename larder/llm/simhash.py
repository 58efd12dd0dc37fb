"""Signed bit votes of 64-bit hashes as plain sums, shared by operators 1 and 5."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Two votes travel in one long: bit i in the low half, bit i + 32 in the high half.
PAIR = (1 << 32) + 1
LOW = (1 << 32) - 1


def vote_sums(hashed: Column, weight: Column | None, name: str) -> list[Column]:
    """32 sums that hold the weight for each of the 64 bits of ``hashed``.

    A half overflows only if the weights of one text add up to 2**31 or more.
    """
    votes = [F.shiftright(hashed, i).bitwiseAND(F.lit(PAIR)) for i in range(32)]
    if weight is not None:
        votes = [v * weight for v in votes]
    return [F.sum(v).alias(f"{name}{i}") for i, v in enumerate(votes)]


def majority(name: str, total: Column) -> Column:
    """The 64-bit fingerprint: a bit is set if over half of ``total`` voted for it."""
    bits = None
    for i in range(32):
        s = F.col(f"{name}{i}")
        low = F.when(s.bitwiseAND(F.lit(LOW)) * 2 > total, F.lit(1 << i)).otherwise(F.lit(0))
        one = 1 << (i + 32)
        one = one - (1 << 64) if one >= 1 << 63 else one
        high = F.when(F.shiftrightunsigned(s, 32) * 2 > total, F.lit(one).cast("long"))
        both = low.cast("long").bitwiseOR(high.otherwise(F.lit(0).cast("long")))
        bits = both if bits is None else bits.bitwiseOR(both)
    return bits


def hex16(fingerprint: Column) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))
