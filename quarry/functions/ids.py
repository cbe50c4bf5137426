"""String-id helpers for ALS-style integer ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the reference keeps 23 bits of Java's String.hashCode.
HASH23_MASK = 0x7FFFFF


def hash23(c: Column | str) -> Column:
    """Java ``s.hashCode & 0x7FFFFF`` as a Spark expression.

    Folding ``h * 31 + code`` while masking at every step equals masking once at
    the end, because 2^23 divides 2^32.  Exact for strings of BMP characters
    (one UTF-16 unit per character); NULL in, NULL out.
    """
    s = F.col(c) if isinstance(c, str) else c
    chars = F.filter(F.split(s, ""), lambda ch: ch != "")
    codes = F.transform(chars, lambda ch: F.ascii(ch).cast("bigint"))
    return F.aggregate(codes, F.lit(0).cast("bigint"),
                       lambda h, x: (h * 31 + x).bitwiseAND(F.lit(HASH23_MASK).cast("bigint"))
                       ).cast("int")
