"""Canonical values: what "the same value" means across two systems.

Both sides of a comparison may hold a column in different types (a double on
one side, a decimal on the other).  The rules are chosen on the driver from the
two schemas and written as SQL expressions, so the work stays in generated code
and a table of several hundred columns is still planned in a moment.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Places kept for a float column when no side declares a scale,
# and the widest decimal Spark has.
FLOAT_SCALE = 6
MAX_PRECISION = 38

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FLOATING = (T.FloatType, T.DoubleType)
_NUMERIC = _INTEGRAL + _FLOATING + (T.DecimalType,)
_TIMES = (T.TimestampType, T.TimestampNTZType)

# Decimal digits that an integral type can have.
_DIGITS = ((T.ByteType, 3), (T.ShortType, 5), (T.IntegerType, 10), (T.LongType, 19))


def quoted(name: str) -> str:
    """A column name as SQL."""
    return "`" + name.replace("`", "``") + "`"


def literal(text: str) -> str:
    """A string as SQL."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _both(left: T.DataType, right: T.DataType, kinds) -> bool:
    return isinstance(left, kinds) and isinstance(right, kinds)


def scale_for(left: T.DataType, right: T.DataType) -> int:
    """Decimal places both sides are brought to before they are compared."""
    declared = [t.scale for t in (left, right) if isinstance(t, T.DecimalType)]
    if declared:
        return max(declared)
    if isinstance(left, _FLOATING) or isinstance(right, _FLOATING):
        return FLOAT_SCALE
    return 0


def precision_map(left: T.StructType, right: T.StructType, columns) -> dict[str, int]:
    """Rounding scale of every column that has a fractional type on some side."""
    fractional = _FLOATING + (T.DecimalType,)
    return {
        c: scale_for(left[c].dataType, right[c].dataType)
        for c in columns
        if isinstance(left[c].dataType, fractional) or isinstance(right[c].dataType, fractional)
    }


def clean_string(value: str) -> str:
    """Trim blanks, then fold the words true/false to lower case.

    The length test keeps ``lower`` away from almost every value.
    """
    trimmed = f"trim({value})"
    is_word = f"octet_length({trimmed}) between 4 and 5 and lower({trimmed}) in ('true', 'false')"
    return f"if({is_word}, lower({trimmed}), {trimmed})"


def _as_decimal(value: str, scale: int, precision: int = MAX_PRECISION) -> str:
    return f"try_cast({value} as decimal({precision},{scale}))"


def rounded_double(value: str, scale: int) -> str:
    """A double rounded half up by its decimal digits, without building a decimal
    for almost any value.

    Scaling by a power of ten is off by less than 0.04 while the result is
    below 2**47, so the nearest integer is the rounded one unless the fraction
    is close to a half; dividing two exact numbers then gives the double
    nearest to the rounded decimal.  All other values go through a decimal.
    """
    unit, limit = f"{10**scale}D", f"{2**47}D"
    scaled = f"{value} * {unit}"
    is_clear = (
        f"{scaled} between -{limit} and {limit} and {scaled} - rint({scaled}) between -0.45D and 0.45D"
    )
    exact = f"cast({_as_decimal(value, scale)} as double)"
    return f"coalesce(if({is_clear}, rint({scaled}) / {unit}, {exact}), {value})"


# Digits that a number is written out with; beyond it stands an exponent.
WRITTEN_OUT = 40


def exact_number(value: str, dtype: T.DataType) -> str:
    """A number as decimal text, the same for every type that can hold it, however large or small.

    A float stands for the decimal it prints as.  The printed text is taken
    apart into sign, digits without zeros at either end, and exponent, which are
    the same for equal numbers; put together again, each number has one text.
    """
    text = f"cast({value} as string)"
    if isinstance(dtype, _INTEGRAL):
        return text
    pattern = "'^-?([0-9]*)[.]?([0-9]*)'"
    fraction = f"regexp_extract({text}, {pattern}, 2)"
    leading = f"ltrim('0', concat(regexp_extract({text}, {pattern}, 1), {fraction}))"
    digits = f"rtrim('0', {leading})"
    power = f"coalesce(try_cast(regexp_extract({text}, 'E([+-]?[0-9]+)$', 1) as int), 0)"
    exponent = f"({power} - length({fraction}) + length({leading}) - length({digits}))"
    sign = f"if({text} like '-%', '-', '')"
    point = f"(length({digits}) + {exponent})"
    return (
        f"case when not {text} rlike '^-?[0-9]' then {text} when {digits} = '' then '0' "
        f"when {exponent} >= 0 and {point} <= {WRITTEN_OUT} then concat({sign}, {digits}, repeat('0', {exponent})) "
        f"when {exponent} < 0 and {point} > 0 then concat({sign}, left({digits}, {point}), '.', right({digits}, -{exponent})) "
        f"when {exponent} < 0 and -{exponent} <= {WRITTEN_OUT} then concat({sign}, '0.', repeat('0', -{point}), {digits}) "
        f"else concat({sign}, {digits}, 'E', {exponent}) end"
    )


def nested(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.ArrayType, T.MapType, T.StructType, T.VariantType))


def _whole_digits(dtype: T.DataType) -> int:
    if isinstance(dtype, T.DecimalType):
        return dtype.precision - dtype.scale
    return next(n for kind, n in _DIGITS if isinstance(dtype, kind))


@dataclass(frozen=True)
class Comparable:
    """One column of a comparison with the types it has on both sides.

    The methods take a value as SQL and give SQL; ``left`` says whose type it has.
    """

    name: str
    left_type: T.DataType
    right_type: T.DataType
    coerce: bool = False

    @property
    def scale(self) -> int:
        return scale_for(self.left_type, self.right_type)

    def _are(self, kinds) -> bool:
        return _both(self.left_type, self.right_type, kinds)

    def text(self, value: str, left: bool) -> str:
        """Canonical string of ``value``; null stays null."""
        dtype, other = (self.left_type, self.right_type) if left else (self.right_type, self.left_type)
        if nested(dtype):
            parts = self._parts(value, left)
            return f"to_json({parts}, map('ignoreNullFields', 'false'))"
        if self._are((T.BinaryType,)):
            return f"hex({value})"
        if self.coerce:
            if isinstance(dtype, T.StringType) and isinstance(other, _NUMERIC + _TIMES + (T.DateType,)):
                return self._text_as(value, other)
            if isinstance(dtype, T.DateType) and isinstance(other, _TIMES + (T.StringType,)):
                return f"cast(cast({value} as timestamp_ntz) as string)"
            if isinstance(dtype, T.BooleanType) and isinstance(other, _NUMERIC):
                value, dtype = f"cast({value} as int)", T.IntegerType()
        if isinstance(dtype, T.StringType):
            return clean_string(value)
        if isinstance(dtype, _INTEGRAL) and self.scale == 0 or not isinstance(dtype, _NUMERIC):
            return f"cast({value} as string)"
        if isinstance(dtype, T.FloatType):
            value = f"cast({value} as double)"
        # NaN, infinities and values too wide for the decimal keep their own text,
        # so that a null never stands for a value
        return f"coalesce(cast({_as_decimal(value, self.scale)} as string), cast({value} as string))"

    def _parts(self, value: str, left: bool, depth: int = 0) -> str:
        """A nested value with its leaves in canonical text; the entries of a map are put in order."""
        dtype, other = (self.left_type, self.right_type) if left else (self.right_type, self.left_type)
        x = f"x{depth}"

        def leaf(inner: str, own: T.DataType, theirs: T.DataType) -> str:
            types = (own, theirs) if left else (theirs, own)
            pair = Comparable(self.name, *types, self.coerce)
            return pair._parts(inner, left, depth + 1) if nested(own) else pair.text(inner, left)

        if isinstance(dtype, T.VariantType):
            return value
        if isinstance(dtype, T.ArrayType):
            theirs = other.elementType if isinstance(other, T.ArrayType) else dtype.elementType
            return f"transform({value}, {x} -> {leaf(x, dtype.elementType, theirs)})"
        if isinstance(dtype, T.MapType):
            same = other if isinstance(other, T.MapType) else dtype
            entry = f"struct({leaf(f'{x}.key', dtype.keyType, same.keyType)}, {leaf(f'{x}.value', dtype.valueType, same.valueType)})"
            return f"array_sort(transform(map_entries({value}), {x} -> {entry}))"
        same = other if isinstance(other, T.StructType) and other.names == dtype.names else dtype
        fields = ", ".join(
            f"{literal(f.name)}, {leaf(f'{value}.{quoted(f.name)}', f.dataType, same[f.name].dataType)}" for f in dtype
        )
        return f"if({value} is null, null, named_struct({fields}))"

    def _text_as(self, value: str, other: T.DataType) -> str:
        """Text read by the type of the other side; text that does not fit stays as it is."""
        cleaned = clean_string(value)
        if isinstance(other, _NUMERIC):
            wanted = "bigint" if self.scale == 0 else f"decimal({MAX_PRECISION},{self.scale})"
        else:
            wanted = "timestamp_ntz"
        return f"coalesce(cast(try_cast({cleaned} as {wanted}) as string), {cleaned})"

    def hash_inputs(self, value: str, left: bool) -> list[str]:
        """Values to hash: equal on two sides exactly when the canonical text is equal.

        Where both sides have the same kind of type the typed value is hashed
        and no text is built.  A null flag follows the value because a hash
        skips nulls, so (null, x) and (x, null) would otherwise agree.
        """
        flag = f"{value} is null"
        if self._are(_INTEGRAL):
            return [f"cast({value} as bigint)", flag]
        if self._are(_FLOATING):
            return [rounded_double(f"cast({value} as double)", self.scale), flag]
        if self._are(_INTEGRAL + (T.DecimalType,)):
            digits = max(_whole_digits(self.left_type), _whole_digits(self.right_type)) + self.scale
            if digits <= MAX_PRECISION:
                return [_as_decimal(value, self.scale, digits), flag]
        if self._are(_NUMERIC):
            exact = _as_decimal(value, self.scale)
            return [exact, f"if({exact} is null, cast({value} as string), null)", flag]
        if self._are((T.BooleanType,)) or self._are((T.DateType,)):
            return [value, flag]
        if self._are(_TIMES):
            return [f"cast({value} as timestamp_ntz)", flag]
        return [self.text(value, left), flag]

    def differs(self, left: str, right: str) -> str:
        """Null-safe inequality of the canonical values.

        Raw values that are equal in the same type are equal in canonical form
        too, so the text is only built for the rows where they are not.
        """
        text_differs = f"not ({self.text(left, True)} <=> {self.text(right, False)})"
        if self.left_type != self.right_type or nested(self.left_type):
            return f"({text_differs})"
        raw_differs = f"not ({left} <=> {right})"
        if self._are(_INTEGRAL + (T.BooleanType, T.DateType)):
            return f"({raw_differs})"
        return f"({raw_differs} and {text_differs})"

    def key(self, value: str, left: bool) -> str:
        """Join and grouping value: typed where the types allow it, never rounded."""
        if self._are(_INTEGRAL):
            # the column itself where it can be: rows that already lie by it need not be moved
            return value if self.left_type == self.right_type else f"cast({value} as bigint)"
        if self._are(_NUMERIC) and (
            isinstance(self.left_type, _FLOATING) or isinstance(self.right_type, _FLOATING)
        ):
            return exact_number(value, self.left_type if left else self.right_type)
        if self._are((T.BooleanType,)) or self._are((T.DateType,)):
            return value
        if self._are(_TIMES):
            return f"cast({value} as timestamp_ntz)"
        return self.text(value, left)


def comparables(left: T.StructType, right: T.StructType, columns, coerce: bool = False) -> list[Comparable]:
    return [Comparable(c, left[c].dataType, right[c].dataType, coerce) for c in columns]


def key_text(keys) -> str:
    r"""Printable key as SQL: different keys have different texts.

    Null is ``\N``, a backslash is doubled, and the separator ``|`` inside a
    piece of a composite key is written ``\|``.
    """

    def piece(k: str) -> str:
        text = rf"replace(cast({quoted(k)} as string), '\\', '\\\\')"
        if len(keys) > 1:
            text = rf"replace({text}, '|', '\\|')"
        return rf"coalesce({text}, '\\N')"

    return "concat_ws('|', " + ", ".join(piece(k) for k in keys) + ")"


def fold_names(df):
    """Lower-case column names; two names that fold to one are an error."""
    folded = [c.lower() for c in df.columns]
    clash = sorted({c for c in folded if folded.count(c) > 1})
    if clash:
        raise ValueError(f"column names differ only in case: {clash}")
    return df.toDF(*folded)


def normalise(df, columns, against=None):
    """The canonical string table of ``df``: one projection, other columns left out.

    ``against`` is the schema of the other side; by default the table is
    normalised by its own types.
    """
    df = fold_names(df)
    other = fold_schema(against) if against is not None else df.schema
    pairs = comparables(df.schema, other, [c.lower() for c in columns])
    return df.selectExpr(*[f"{c.text(quoted(c.name), True)} as {quoted(c.name)}" for c in pairs])


def fold_schema(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name.lower(), f.dataType, f.nullable) for f in schema])
