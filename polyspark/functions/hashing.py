"""One hash for splits, shuffles, sampling, the stand-in scorer and the bootstrap.

md5 is used because every SQL engine has it, so a result can be checked elsewhere.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SEPARATOR = "\x1f"
NULL_MARK = "\x1e"
HASH_RANGE = float(16**15)


def _text(part) -> Column:
    column = part if isinstance(part, Column) else F.lit(part)
    return F.coalesce(column.cast("string"), F.lit(NULL_MARK))


def hash_hex(*parts) -> Column:
    """md5 of the parts joined by a separator; plain values are taken as literals."""
    return F.md5(F.concat_ws(SEPARATOR, *[_text(p) for p in parts]))


def hash_int(*parts) -> Column:
    """60 bits of the hash as a non-negative bigint."""
    return F.conv(F.substring(hash_hex(*parts), 1, 15), 16, 10).cast("bigint")


def hash_unit(*parts) -> Column:
    """The hash as a double in [0, 1)."""
    return hash_int(*parts).cast("double") / F.lit(HASH_RANGE)


def content_key(*columns) -> Column:
    """Key under which two rows with equal columns are equal."""
    return hash_hex(*columns)
