"""Column catalogs of live tables and the type names of each database."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evenkeel.sources.jdbc import read_jdbc

# Logical or foreign type name to the name a database uses.
DIALECT_TYPES = {
    "mysql": {
        "int8": "TINYINT", "int16": "SMALLINT", "int32": "INT", "int64": "BIGINT",
        "float32": "FLOAT", "float64": "DOUBLE", "number": "DOUBLE",
        "string": "TEXT", "str": "TEXT",
        "bool": "TINYINT(1)", "boolean": "TINYINT(1)",
        "integer": "INT",
        "datetime": "DATETIME", "timestamp_ntz": "DATETIME",
    },
    "snowflake": {
        "int8": "NUMBER(3,0)", "int16": "NUMBER(5,0)", "int32": "NUMBER(10,0)", "int64": "NUMBER(19,0)",
        "integer": "NUMBER(10,0)", "int": "NUMBER(10,0)",
        "decimal": "NUMBER",
        "float32": "FLOAT", "float64": "FLOAT",
        "string": "VARCHAR", "str": "VARCHAR", "varchar": "VARCHAR(256)",
        "bool": "BOOLEAN", "boolean": "BOOLEAN",
        "datetime": "TIMESTAMP_NTZ", "datetime2": "TIMESTAMP_NTZ", "timestamp": "TIMESTAMP_NTZ",
        "timestamp_ntz": "TIMESTAMP_NTZ", "timestampntz": "TIMESTAMP_NTZ",
    },
    "postgres": {
        "int8": "SMALLINT", "int16": "SMALLINT", "int32": "INTEGER", "int64": "BIGINT",
        "integer": "INTEGER", "int": "INTEGER",
        "decimal": "NUMERIC",
        "float32": "REAL", "float64": "DOUBLE PRECISION",
        "string": "TEXT", "str": "TEXT", "varchar": "VARCHAR(255)",
        "bool": "BOOLEAN", "boolean": "BOOLEAN",
        "datetime": "TIMESTAMP",
    },
}

_TYPE = re.compile(r"\s*(\w+)\s*(\([^)]*\))?\s*$")


def dialect_type(declared: str | None, dialect: str) -> str:
    """Name of a declared type in ``dialect``; unknown types keep their own name.

    Length and scale that the declaration gives win over a default length.
    """
    names = DIALECT_TYPES[dialect]
    if not declared or not declared.strip():
        return "VARCHAR(255)" if dialect == "mysql" else "VARCHAR"
    parts = _TYPE.match(declared)
    if not parts:
        return declared.strip()
    base, size = parts.group(1), parts.group(2) or ""
    mapped = names.get(base.lower())
    if mapped is None:
        return declared.strip()
    display_width = dialect != "mysql" and base.lower() in ("int", "integer")
    if not size or display_width:
        return mapped
    default_length = base.lower() == "varchar"
    return mapped.split("(")[0] + size if default_length or "(" not in mapped else mapped


_SPARK_NAMES = (
    (T.ByteType, "int8"), (T.ShortType, "int16"), (T.IntegerType, "int32"), (T.LongType, "int64"),
    (T.FloatType, "float32"), (T.DoubleType, "float64"), (T.StringType, "string"),
    (T.BooleanType, "bool"), (T.TimestampType, "datetime"), (T.TimestampNTZType, "datetime"),
    (T.DateType, "DATE"),
)


def _logical_name(dtype: T.DataType) -> str:
    if isinstance(dtype, T.DecimalType):
        return f"DECIMAL({dtype.precision},{dtype.scale})"
    for kind, name in _SPARK_NAMES:
        if isinstance(dtype, kind):
            return name
    return dtype.simpleString()


def schema_catalog(spark: SparkSession, schema: T.StructType, dialect: str = "mysql") -> DataFrame:
    """The catalog ``(column_name, data_type)`` of a Spark schema in the names of ``dialect``."""
    rows = [(f.name.upper(), dialect_type(_logical_name(f.dataType), dialect).upper()) for f in schema]
    return spark.createDataFrame(rows, "column_name string, data_type string")


def declared_catalog(spark: SparkSession, columns: dict[str, str], dialect: str = "mysql") -> DataFrame:
    """The catalog of declared ``{column: type}`` pairs."""
    rows = [(c.upper(), dialect_type(t, dialect).upper()) for c, t in columns.items()]
    return spark.createDataFrame(rows, "column_name string, data_type string")


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def mysql_catalog_query(schema: str, table: str) -> str:
    return (
        "SELECT COLUMN_NAME, COLUMN_TYPE, ORDINAL_POSITION FROM INFORMATION_SCHEMA.COLUMNS "
        f"WHERE TABLE_SCHEMA = {_quoted(schema)} AND TABLE_NAME = {_quoted(table)}"
    )


def snowflake_catalog_query(database: str, schema: str, table: str) -> str:
    if not re.fullmatch(r"\w+", database):
        raise ValueError(f"not a database name: {database!r}")
    return (
        "SELECT COLUMN_NAME, DATA_TYPE, CHARACTER_MAXIMUM_LENGTH, NUMERIC_PRECISION, NUMERIC_SCALE, "
        f"ORDINAL_POSITION FROM {database.upper()}.INFORMATION_SCHEMA.COLUMNS "
        f"WHERE TABLE_SCHEMA = {_quoted(schema.upper())} AND TABLE_NAME = {_quoted(table.upper())}"
    )


def mysql_catalog(spark: SparkSession, options: dict, schema: str, table: str) -> DataFrame:
    return from_mysql_rows(read_jdbc(spark, options, mysql_catalog_query(schema, table)))


def snowflake_catalog(spark: SparkSession, options: dict, database: str, table: str, schema=None) -> DataFrame:
    schema = schema or options.get("sfSchema", "PUBLIC")
    return from_snowflake_rows(read_jdbc(spark, options, snowflake_catalog_query(database, schema, table)))


def from_mysql_rows(rows: DataFrame) -> DataFrame:
    """Catalog rows of MySQL as ``(column_name, data_type)`` in table order."""
    return _catalog(rows, F.upper("COLUMN_TYPE"))


def from_snowflake_rows(rows: DataFrame) -> DataFrame:
    """Catalog rows of Snowflake; length, precision and scale are put back into the type."""
    base = F.upper("DATA_TYPE")
    length, precision, scale = (
        F.col(c).cast("int") for c in ("CHARACTER_MAXIMUM_LENGTH", "NUMERIC_PRECISION", "NUMERIC_SCALE")
    )
    return _catalog(
        rows,
        F.when(base.isin("TEXT", "VARCHAR") & (length > 0), F.format_string("VARCHAR(%d)", length))
        .when((base == "NUMBER") & (precision > 0) & (scale > 0), F.format_string("NUMBER(%d,%d)", precision, scale))
        .when((base == "NUMBER") & (precision > 0), F.format_string("NUMBER(%d)", precision))
        .otherwise(base),
    )


def _catalog(rows: DataFrame, data_type: Column) -> DataFrame:
    return rows.orderBy("ORDINAL_POSITION").select(
        F.upper("COLUMN_NAME").alias("column_name"), data_type.alias("data_type")
    )
