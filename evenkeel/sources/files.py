"""CSV and Parquet snapshots of a table.

A snapshot is a directory written in parallel.  Parquet keeps types by itself;
a CSV snapshot stores its schema next to the data, and its values as the text of
``csv_codec``, from which every value comes back.  The CSV options keep empty
strings, nulls and blanks around a value apart.
"""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evenkeel.sources import buckets, csv_codec
from evenkeel.sources.workspace import remove

CSV_OPTIONS = {
    "header": "true",
    "quoteAll": "true",
    "escape": '"',
    "nullValue": "\\N",
    "emptyValue": "",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def _schema_path(path: str) -> str:
    return path.rstrip("/") + "_schema"


# Fixed value: key of the note that values hold line breaks, in the metadata of the stored schema.
_MULTILINE = "multiLine"


# Fixed value: key of the note that all values are text of the codec, in the metadata of the stored schema.
_CODEC = "codec"


def _column(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


# Earlier versions kept values as the writer prints them, and only put a backslash before what looks like the null marker.
def _unescaped(value: Column) -> Column:
    return F.when(value.rlike(r"^\\{2,}N$"), F.substring(value, 2, 2**31 - 1)).otherwise(value)


def _earlier_text(df: DataFrame, schema: T.StructType) -> DataFrame:
    texts = {f.name for f in schema if isinstance(f.dataType, T.StringType)}
    return df.select(*(_unescaped(_column(c)).alias(c) if c in texts else _column(c) for c in df.columns))


def write_csv(df: DataFrame, path: str) -> None:
    """Write ``df`` as text from which every value comes back, and its schema beside it; an empty frame leaves the schema.

    No value holds a line break then, so files of any size are split on reading.
    """
    spark = df.sparkSession
    csv_codec.as_text(df).write.mode("overwrite").options(**CSV_OPTIONS).csv(path)
    note = json.dumps({"schema": df.schema.jsonValue(), _CODEC: 1, _MULTILINE: False})
    spark.createDataFrame([(note,)], "value string").coalesce(1).write.mode("overwrite").text(_schema_path(path))


def _reader(spark: SparkSession, *, multiline: bool):
    return spark.read.options(**CSV_OPTIONS).option("multiLine", multiline)


def _stored(spark: SparkSession, path: str) -> dict | None:
    try:
        row = spark.read.option("wholetext", True).text(_schema_path(path)).first()
    except AnalysisException:
        return None
    note = json.loads(row.value)
    # a schema alone is what the first version stored
    return note if "schema" in note else {"schema": note, _MULTILINE: True}


def read_csv(spark: SparkSession, path: str, *, schema=None, as_text=False, multiline: bool | None = None) -> DataFrame:
    """Read a CSV snapshot with its stored schema.

    Without a stored schema the types are inferred, which costs one more pass,
    and text is taken as it is.  ``as_text`` reads every column as a string.
    Values with line breaks need ``multiline``; without it Spark can split a
    file between tasks.  By default the snapshot's own note decides, and where
    there is none, ``multiline`` is on.
    """
    stored = _stored(spark, path)
    if multiline is None:
        multiline = stored[_MULTILINE] if stored else True
    reader = _reader(spark, multiline=multiline)
    kept = T.StructType.fromJson(stored["schema"]) if stored else None
    if stored and _CODEC in stored:
        texts = reader.schema(csv_codec.text_schema(kept)).csv(path)
        if not as_text:
            return csv_codec.from_text(texts, kept if schema is None else schema)
        return texts.select(*(csv_codec.value_of(_column(f.name), T.StringType()).alias(f.name) for f in kept))
    schema = kept if schema is None else schema
    if as_text:
        found = reader.option("inferSchema", False).csv(path)
        return _earlier_text(found, schema) if schema is not None and found.columns == schema.names else found
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    found = reader.schema(schema).csv(path)
    return _earlier_text(found, schema) if stored else found


def save_snapshot(df: DataFrame, path: str, fmt: str = "parquet", *, keys=()) -> None:
    """Write a snapshot.  One as Parquet with ``keys`` is put in buckets by them, unless a hot key makes them uneven."""
    if keys:
        if fmt != "parquet":
            raise ValueError(f"only a Parquet snapshot can be in buckets, not {fmt!r}")
        buckets.save(df, path, list(keys))
        return
    if fmt == "csv":
        write_csv(df, path)
    else:
        df.write.mode("overwrite").format(fmt).save(path)
    if fmt == "parquet":
        remove(df.sparkSession, buckets.note_path(path))


def load_snapshot(spark: SparkSession, path: str, fmt: str = "parquet", *, schema=None, **options) -> DataFrame:
    """Read a snapshot; with its ``schema`` given no job is needed to find it. ``options`` are those of the format's reader."""
    if fmt == "csv":
        return read_csv(spark, path, schema=schema, **options)
    if fmt == "parquet" and not options and (found := buckets.load(spark, path)) is not None:
        return found
    reader = spark.read.format(fmt).options(**options)
    return (reader if schema is None else reader.schema(schema)).load(path)
