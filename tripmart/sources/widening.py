"""Types that hold the values of files whose schemas differ.

``least_common`` gives the least type that holds all values of the given ones:

* whole numbers: the widest; with decimals a decimal with the digits of both;
* a floating type with other numbers: DOUBLE.  Values that it cannot hold
  exactly (whole numbers beyond 2^53, decimals of too many digits) fail the
  read, with the file named, instead of changing;
* dates and both kinds of timestamps: TIMESTAMP_NTZ, at the session's zone; an
  instant that has no local time of its own fails the read;
* text with any other plain type: text;
* structs field by field (a field missing on one side is NULL), arrays and maps
  by their parts.

Other pairs have no common type: a ``WideningError``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType, AtomicType, BinaryType, ByteType, DataType, DateType, DecimalType, DoubleType, FloatType, IntegerType, IntegralType, LongType,
    MapType, NullType, NumericType, ShortType, StringType, StructField, StructType, TimestampNTZType, TimestampType)

#: Decimal digits of the whole-number types, narrowest first.
DIGITS = {ByteType: 3, ShortType: 5, IntegerType: 10, LongType: 19}
#: Whole numbers up to these are exact.
EXACT_DOUBLE, EXACT_FLOAT = 1 << 53, 1 << 24
_TIMES = (DateType, TimestampNTZType, TimestampType)


class WideningError(TypeError):
    """Types without a common one."""


def same(a: DataType, b: DataType) -> bool:
    """Equal but for nullability."""
    return a.simpleString() == b.simpleString()


def least_common(types: Sequence[DataType]) -> DataType:
    """The least type that holds the values of all the given ones."""
    kinds = [t for t in dict.fromkeys(types) if not isinstance(t, NullType)]
    if not kinds:
        return NullType()
    if all(same(t, kinds[0]) for t in kinds):
        return kinds[0]
    if all(isinstance(t, IntegralType) for t in kinds):
        return max(kinds, key=lambda t: DIGITS[type(t)])
    if all(isinstance(t, NumericType) for t in kinds):
        if any(isinstance(t, (FloatType, DoubleType)) for t in kinds):
            return FloatType() if all(isinstance(t, (FloatType, ByteType, ShortType)) for t in kinds) else DoubleType()
        scale = max(t.scale for t in kinds if isinstance(t, DecimalType))
        whole = max(t.precision - t.scale if isinstance(t, DecimalType) else DIGITS[type(t)] for t in kinds)
        if whole + scale <= 38:
            return DecimalType(whole + scale, scale)
    elif all(isinstance(t, _TIMES) for t in kinds):
        return TimestampNTZType()
    elif all(isinstance(t, StructType) for t in kinds):
        fields: dict[str, list[DataType]] = {}
        for t in kinds:
            for f in t.fields:
                fields.setdefault(f.name, []).append(f.dataType)
        return StructType([StructField(n, least_common(ts)) for n, ts in fields.items()])
    elif all(isinstance(t, ArrayType) for t in kinds):
        return ArrayType(least_common([t.elementType for t in kinds]))
    elif all(isinstance(t, MapType) for t in kinds):
        return MapType(least_common([t.keyType for t in kinds]), least_common([t.valueType for t in kinds]))
    elif any(isinstance(t, StringType) for t in kinds) and all(isinstance(t, AtomicType) and not isinstance(t, BinaryType) for t in kinds):
        return StringType()
    raise WideningError(f"no common type of {', '.join(t.simpleString() for t in kinds)}")


def _holds(to: DataType, kind: DataType) -> bool:
    """Whether every value of ``kind`` is exact in ``to``."""
    if isinstance(kind, NullType) or isinstance(to, StringType):
        return True
    if isinstance(to, DoubleType):
        return isinstance(kind, (ByteType, ShortType, IntegerType, FloatType))
    if isinstance(to, FloatType):
        return isinstance(kind, (ByteType, ShortType))
    if isinstance(to, (IntegralType, DecimalType)) and isinstance(kind, (IntegralType, DecimalType)):
        digits = lambda t: (t.precision - t.scale, t.scale) if isinstance(t, DecimalType) else (DIGITS[type(t)], 0)
        # A whole-number type does not hold all numbers of its digits.
        return all(x >= y for x, y in zip(digits(to), digits(kind))) and (isinstance(to, DecimalType) or isinstance(kind, IntegralType))
    return isinstance(to, TimestampNTZType) and isinstance(kind, DateType)


def exact_cast(value: Column, kind: DataType, to: DataType, name: str, source: Column) -> Column:
    """``value`` of type ``kind`` as ``to``; a value that would change fails the
    read with the column, the value and its ``source``."""
    if same(kind, to):
        return value
    if isinstance(to, StructType) and isinstance(kind, StructType):
        have = {f.name: f.dataType for f in kind.fields}
        fields = [(exact_cast(value[f.name], have[f.name], f.dataType, f"{name}.{f.name}", source) if f.name in have
                   else F.lit(None).cast(f.dataType)).alias(f.name) for f in to.fields]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(to, ArrayType) and isinstance(kind, ArrayType):
        return F.transform(value, lambda x: exact_cast(x, kind.elementType, to.elementType, name, source))
    if isinstance(to, MapType) and isinstance(kind, MapType):
        keyed = F.transform_keys(value, lambda k, _: exact_cast(k, kind.keyType, to.keyType, name, source))
        return F.transform_values(keyed, lambda _, v: exact_cast(v, kind.valueType, to.valueType, name, source))
    cast = value.cast(to) if _holds(to, kind) else value.try_cast(to)
    if _holds(to, kind):
        return cast
    if isinstance(kind, IntegralType) and isinstance(to, (DoubleType, FloatType)):
        limit = EXACT_DOUBLE if isinstance(to, DoubleType) else EXACT_FLOAT
        exact = value.between(-limit, limit)
    elif isinstance(kind, (IntegralType, DecimalType, FloatType, DoubleType, StringType, *_TIMES)) and isinstance(to, AtomicType):
        exact = cast.try_cast(kind) == value
    else:
        raise WideningError(f"column {name}: no cast from {kind.simpleString()} to {to.simpleString()}")
    text = F.concat(F.lit(f"column {name}: "), value.cast("string"), F.lit(f" ({kind.simpleString()}) is not exact as {to.simpleString()} in "), source)
    return F.when(value.isNull() | F.coalesce(exact, F.lit(False)), cast).otherwise(F.raise_error(text).cast(to))


def union_widened(parts: Sequence[tuple[DataFrame, str]], wanted: StructType | None = None) -> DataFrame:
    """Rows of all parts, (frame, source), by column name: columns of ``wanted``
    in its types, others in their least common ones, missing columns NULL."""
    fixed = {f.name: f.dataType for f in wanted.fields} if wanted else {}
    kinds: dict[str, list[tuple[DataType, str]]] = {}
    for df, source in parts:
        for f in df.schema.fields:
            kinds.setdefault(f.name, []).append((f.dataType, source))

    def common(name: str) -> DataType:
        if name in fixed:
            return fixed[name]
        try:
            return least_common([t for t, _ in kinds[name]])
        except WideningError as e:
            where = {t.simpleString(): s for t, s in reversed(kinds[name])}
            raise WideningError(f"column {name}: {e}; " + "; ".join(f"{t} in {s}" for t, s in where.items())) from None
    types = {name: common(name) for name in kinds}
    out = None
    for df, source in parts:
        source = F.coalesce(F.col("_metadata.file_path"), F.lit(source)) if _has_files(df) else F.lit(source)
        cast = df.select(*[exact_cast(F.col(f"`{f.name}`"), f.dataType, types[f.name], f.name, source).alias(f.name) for f in df.schema.fields])
        out = cast if out is None else out.unionByName(cast, allowMissingColumns=True)
    return out


def _has_files(df: DataFrame) -> bool:
    """Whether the rows come right from files, so that each row's file is known."""
    try:
        df.select("_metadata.file_path")
        return True
    except Exception:  # noqa: BLE001 - the analyzer's errors have no common class
        return False
