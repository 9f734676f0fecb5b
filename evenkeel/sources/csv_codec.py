"""Values as text of a CSV file, and back, type by type.

CSV has no types, and the writers of its values lose what their patterns leave
out: microseconds, years of five digits, the zone of a time, bytes.  Here each
type has a text of its own from which the same value comes back, and no text
holds a line break, so a file can always be split between tasks.

===================  ===========================================================
type                 text
===================  ===========================================================
string               as it is; a backslash doubled, line breaks and NUL as
                     ``\\n``, ``\\r``, ``\\0``
number, boolean      shortest text that reads as the same value
date                 ``2024-05-06``; outside the years 1 to 9999 ``@`` and the
                     number of days since 1970
timestamp            ``2024-05-06 07:08:09.123456Z``, always in UTC; outside the
                     years 1 to 9999 ``@`` and the microseconds since 1970
timestamp_ntz        ``2024-05-06 07:08:09.123456``, years of any length
binary               hexadecimal
array, map, struct   JSON whose leaves are these texts; a map is an array of
                     its entries
===================  ===========================================================
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# What stands for characters that may not be in a line, after a backslash.
_ESCAPES = (("\n", "n"), ("\r", "r"), ("\0", "0"))
_FAR = "@"
_EPOCH = "1970-01-01 00:00:00"
#: First and last moment with a year of four digits, in microseconds and days since 1970.
_MICROS = (-62_135_596_800_000_000, 253_402_300_799_999_999)
_DAYS = (-719_162, 2_932_896)


def _column(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def is_nested(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.ArrayType, T.MapType, T.StructType))


def _escaped(text: Column) -> Column:
    found = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for raw, letter in _ESCAPES:
        found = F.replace(found, F.lit(raw), F.lit("\\" + letter))
    return found


def _unescaped(text: Column) -> Column:
    """Between doubled backslashes, every other one begins an escape."""

    def plain(part: Column) -> Column:
        for raw, letter in _ESCAPES:
            part = F.replace(part, F.lit("\\" + letter), F.lit(raw))
        return part

    parts = F.transform(F.split(text, r"\\\\"), plain)
    return F.when(F.contains(text, F.lit("\\")), F.array_join(parts, "\\")).otherwise(text)


def _in_utc(micros: Column) -> Column:
    """The time of day in UTC, whatever the session's zone."""
    return F.timestamp_add("MICROSECOND", micros, F.lit(_EPOCH).cast("timestamp_ntz"))


def _near_or_far(number: Column, limits: tuple[int, int], near: Column) -> Column:
    return F.when(number.between(*limits), near).otherwise(F.concat(F.lit(_FAR), number.cast("string")))


def _far_number(text: Column) -> Column:
    return F.substring(text, 2, 32).cast("bigint")


def _leaf_text(value: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.BinaryType):
        return F.hex(value)
    if isinstance(dtype, T.DateType):
        return _near_or_far(F.unix_date(value), _DAYS, value.cast("string"))
    if isinstance(dtype, T.TimestampType):
        micros = F.unix_micros(value)
        return _near_or_far(micros, _MICROS, F.concat(_in_utc(micros).cast("string"), F.lit("Z")))
    return value.cast("string")


def _leaf_value(text: Column, dtype: T.DataType) -> Column:
    far = text.startswith(_FAR)
    if isinstance(dtype, T.NullType):
        return F.lit(None)
    if isinstance(dtype, T.BinaryType):
        return F.unhex(text)
    if isinstance(dtype, T.DateType):
        return F.when(far, F.date_from_unix_date(_far_number(text).cast("int"))).otherwise(text.cast(dtype))
    if isinstance(dtype, T.TimestampType):
        return F.when(far, F.timestamp_micros(_far_number(text))).otherwise(text.cast(dtype))
    return text.cast(dtype)


def _json_type(dtype: T.DataType) -> T.DataType:
    """The type that JSON holds a nested value as: its shape, with text at the leaves."""
    if isinstance(dtype, T.ArrayType):
        return T.ArrayType(_json_type(dtype.elementType))
    if isinstance(dtype, T.MapType):
        return T.ArrayType(T.StructType([T.StructField("key", _json_type(dtype.keyType)), T.StructField("value", _json_type(dtype.valueType))]))
    if isinstance(dtype, T.StructType):
        return T.StructType([T.StructField(f"_{i}", _json_type(f.dataType)) for i, f in enumerate(dtype)])
    return T.StringType()


def _shaped(value: Column, dtype: T.DataType) -> Column:
    """A nested value as its JSON type.  Fields are numbered, since JSON readers may not tell names by case."""
    if isinstance(dtype, T.ArrayType):
        return F.transform(value, lambda x: _shaped(x, dtype.elementType))
    if isinstance(dtype, T.MapType):
        return F.transform(F.map_entries(value), lambda x: F.struct(
            _shaped(x["key"], dtype.keyType).alias("key"), _shaped(x["value"], dtype.valueType).alias("value")
        ))
    if isinstance(dtype, T.StructType):
        fields = [_shaped(value.getField(f.name), f.dataType).alias(f"_{i}") for i, f in enumerate(dtype)]
        return F.when(value.isNotNull(), F.struct(*fields))
    return _leaf_text(value, dtype)


def _restored(value: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.ArrayType):
        return F.transform(value, lambda x: _restored(x, dtype.elementType))
    if isinstance(dtype, T.MapType):
        return F.map_from_entries(F.transform(value, lambda x: F.struct(_restored(x["key"], dtype.keyType), _restored(x["value"], dtype.valueType))))
    if isinstance(dtype, T.StructType):
        fields = [_restored(value.getField(f"_{i}"), f.dataType).alias(f.name) for i, f in enumerate(dtype)]
        return F.when(value.isNotNull(), F.struct(*fields))
    return _leaf_value(value, dtype)


def text_of(value: Column, dtype: T.DataType) -> Column:
    """The text of a value; null stays null."""
    if is_nested(dtype):
        # a doubled backslash in JSON would otherwise be taken for an escaped one on the way back
        return _escaped(F.to_json(_shaped(value, dtype), {"ignoreNullFields": "false"}))
    if isinstance(dtype, T.VariantType):
        return _escaped(F.to_json(value))
    if isinstance(dtype, T.StringType):
        return _escaped(value)
    return _leaf_text(value, dtype)


def value_of(text: Column, dtype: T.DataType) -> Column:
    """The value of such a text."""
    if is_nested(dtype):
        # in an array of one, so that the JSON is read once and not for each of its fields
        read = F.array(F.from_json(_unescaped(text), _json_type(dtype)))
        return F.transform(read, lambda x: _restored(x, dtype)).getItem(0)
    if isinstance(dtype, T.VariantType):
        return F.parse_json(_unescaped(text))
    if isinstance(dtype, T.StringType):
        return _unescaped(text)
    return _leaf_value(text, dtype)


def as_text(df: DataFrame) -> DataFrame:
    """All columns as text.  A name may hold a line break, which a header may not."""
    names = [c.replace("\n", " ").replace("\r", " ") for c in df.columns]
    return df.select(*(text_of(_column(f.name), f.dataType).alias(n) for f, n in zip(df.schema, names, strict=True)))


def from_text(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The values of ``as_text``; ``df`` has the names of ``schema``."""
    return df.select(*(value_of(_column(f.name), f.dataType).alias(f.name) for f in schema))


def text_schema(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, T.StringType()) for f in schema])
