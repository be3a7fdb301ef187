"""The polynomial text hash behind the bitmap distinct count."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: multiplier and bitmap size (2^29 bits)
HASH_SEED = 34
BITMAP_BITS = 29


def masked_hash(value: Column, seed: int = HASH_SEED, bits: int = BITMAP_BITS) -> Column:
    """``sum(code(c_i) * seed^(n-1-i)) mod 2^bits`` over the characters of ``value``.

    The mask is applied at every step: the residue is the same as masking once at the end, and
    the running product stays far below the range of a long however long the text is.
    """
    mask = F.lit((1 << bits) - 1).cast("long")
    codes = F.transform(F.split(value.cast("string"), ""), lambda c: F.ascii(c).cast("long"))
    return F.aggregate(
        codes,
        F.lit(0).cast("long"),
        lambda acc, code: (acc * F.lit(seed).cast("long") + code).bitwiseAND(mask),
    )
