"""Leave out rows whose key is surely not in a set before they are moved to meet it.

The set's keys are hashed into a bitmap, which is kept as words of 64 bits: a
word's number and its bits are one row, so that a lookup is a broadcast join on a
long.  The bitmap is sized by the counted keys and never over a fixed size; the
fuller it gets, the more rows pass that are not in the set, and an exact join
must follow in any case.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Bits for a key: with 8, one row in eight that is not in the set passes.
BITS_PER_KEY = 8
# Words at most; a broadcast row of two longs takes about 32 bytes, so 64 MB.
MOST_WORDS = 1 << 21

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_HASHED_ALIKE = (T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BinaryType)


def comparable_key(key: Column, own: T.DataType, other: T.DataType) -> Column | None:
    """The key in a form whose hash is the same on both sides where the keys are equal; None if there is none."""
    if isinstance(own, _INTEGRAL) and isinstance(other, _INTEGRAL):
        return key.cast("bigint")
    if own == other and (isinstance(own, (*_HASHED_ALIKE, T.DecimalType)) or own == T.StringType()):
        return key
    return None


def _slot(keys: list[Column], words: int) -> Column:
    flags = [part for k in keys for part in (k, k.isNull())]
    return F.pmod(F.xxhash64(*flags), F.lit(words * 64))


def words_of(keys: DataFrame, number: int) -> tuple[DataFrame, int]:
    """The bitmap of a set of keys (all columns together) as (word, bits), and how many words it has."""
    words = 64
    while words < MOST_WORDS and words * 64 < number * BITS_PER_KEY:
        words *= 2
    slot = _slot([F.col(c) for c in keys.columns], words)
    placed = keys.select(slot.alias("slot")).selectExpr("slot div 64 as word", "shiftleft(1L, cast(slot % 64 as int)) as bit")
    return placed.groupBy("word").agg(F.bit_or("bit").alias("bits")), words


def maybe_in(df: DataFrame, keys: list[Column], bitmap: DataFrame, words: int) -> DataFrame:
    """The rows of ``df`` whose key may be in the bitmap's set."""
    slot = _slot(keys, words)
    small = F.broadcast(bitmap.withColumnsRenamed({"word": "_word", "bits": "_bits"}))
    is_set = F.getbit(F.col("_bits"), F.pmod(slot, F.lit(64)).cast("int")) == 1
    return df.join(small, (F.call_function("div", slot, F.lit(64)) == F.col("_word")) & is_set, "left_semi")
