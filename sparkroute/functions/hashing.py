"""The seeded 64-bit key hash, from built-in functions only.

``hash64`` is the first eight bytes, read as a little-endian signed integer, of the MD5
of: a 32-bit seed, a 32-bit type tag, and the value bytes. Structs and arrays are hashed
element by element, each with its tag and its zero-ended name, closed by a zero tag.
Numbers of every width hash alike: they are truncated to 64-bit integers first.
"""

from __future__ import annotations

import struct
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values. The tag of numbers follows from the known answer
# hash64(42) = -944302157085130861; the other tags are this package's own choice.
SEED = 0
TAG_END = 0
TAG_NULL = 5
TAG_NUMBER = 10
TAG_STRING = 15
TAG_OBJECT = 20
TAG_ARRAY = 25
TAG_BINARY = 30
TAG_BOOLEAN = 40
TAG_DATE = 45

# Kinds of key values of documents without a schema, in the order that they sort in.
LEAST, NULL, NUMBER, TEXT, OBJECT, ARRAY, BINARY, OBJECT_ID, BOOLEAN, DATE, STAMP, REGEX, MOST = (
    0, 5, 10, 15, 20, 25, 30, 35, 40, 45, 47, 50, 127)
EXACT = "decimal(38,18)"
#: A key value of any kind: orders by kind, then by number, then by text.
KEY_TYPE = T.StructType([
    T.StructField("rank", T.IntegerType()), T.StructField("number", T.DoubleType()),
    T.StructField("exact", T.DecimalType(38, 18)), T.StructField("text", T.StringType()),
])

INT64_MAX = 2**63 - 1
INT64_MIN = -(2**63)


def raw(data: bytes) -> Column:
    """Constant bytes."""
    return F.lit(bytearray(data))


def tag_bytes(value: int) -> bytes:
    """A seed or tag as four little-endian bytes."""
    return struct.pack("<i", value)


def swap_bytes(x: Column) -> Column:
    """The eight bytes of a bigint in reverse order, by shifts and masks."""
    parts = []
    for i in range(4):
        low, high = 8 * i, 56 - 8 * i
        mask = F.lit(0xFF << low).cast("bigint")
        parts.append(F.shiftleft(x.bitwiseAND(mask), high - low))
        parts.append(F.shiftrightunsigned(x, high - low).bitwiseAND(mask))
    return reduce(lambda a, b: a.bitwiseOR(b), parts)


def le64_bytes(x: Column) -> Column:
    """A bigint as eight little-endian bytes."""
    return F.unhex(F.lpad(F.hex(swap_bytes(x)), 16, "0"))


def le32_bytes(x: Column) -> Column:
    """A non-negative integer below 2^31 as four little-endian bytes."""
    swapped = F.shiftrightunsigned(swap_bytes(x.cast("bigint")), 32)
    return F.unhex(F.lpad(F.hex(swapped), 8, "0"))


def truncated(x: Column) -> Column:
    """A double as bigint: towards zero, saturating, NaN as 0."""
    return (
        F.when(F.isnan(x), F.lit(0).cast("bigint"))
        .when(x >= F.lit(float(2**63)), F.lit(INT64_MAX).cast("bigint"))
        .when(x <= F.lit(-float(2**63)), F.lit(INT64_MIN).cast("bigint"))
        .otherwise(x.cast("bigint"))
    )


def as_int64(x: Column, dtype: T.DataType) -> Column:
    """Any numeric column squashed to bigint."""
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return truncated(x.cast("double"))
    if isinstance(dtype, T.DecimalType):  # this cast goes towards zero
        limit = F.when(x < 0, F.lit(INT64_MIN)).otherwise(F.lit(INT64_MAX)).cast("bigint")
        return F.coalesce(x.try_cast("bigint"), F.when(x.isNotNull(), limit))
    return x.cast("bigint")


def millis(x: Column, dtype: T.DataType) -> Column:
    """Milliseconds since 1970. Zone-less values count as UTC, whatever the session zone is."""
    if isinstance(dtype, T.TimestampType):
        return F.unix_millis(x)
    if isinstance(dtype, T.DateType):
        return F.unix_date(x).cast("bigint") * F.lit(86_400_000)
    days = F.unix_date(x.cast("date")).cast("bigint")
    seconds = days * 86400 + F.hour(x) * 3600 + F.minute(x) * 60
    return seconds * 1000 + F.floor(F.date_part(F.lit("SECOND"), x) * 1000).cast("bigint")


def value_bytes(x: Column, dtype: T.DataType) -> tuple[int, Column]:
    """Type tag and value bytes of a scalar that is not null."""
    if isinstance(dtype, T.BooleanType):
        return TAG_BOOLEAN, F.when(x, raw(b"\x01")).otherwise(raw(b"\x00"))
    if isinstance(dtype, T.NumericType):
        return TAG_NUMBER, le64_bytes(as_int64(x, dtype))
    if isinstance(dtype, T.StringType):
        data = F.encode(x, "UTF-8")
        return TAG_STRING, F.concat(le32_bytes(F.octet_length(x) + 1), data, raw(b"\x00"))
    if isinstance(dtype, T.BinaryType):
        return TAG_BINARY, F.concat(le32_bytes(F.octet_length(x)), raw(b"\x00"), x)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return TAG_DATE, le64_bytes(millis(x, dtype))
    raise TypeError(f"no hash form for {dtype.simpleString()}")


def _element(x: Column, dtype: T.DataType, name: Column) -> Column:
    """Tagged bytes of one value; ``name`` is binary, already zero-ended (empty at the top)."""
    null = F.concat(raw(tag_bytes(TAG_NULL)), name)
    if isinstance(dtype, T.StructType):
        fields = [
            _element(x[f.name], f.dataType, raw(f.name.encode() + b"\x00")) for f in dtype.fields
        ]
        full = F.concat(raw(tag_bytes(TAG_OBJECT)), name, *fields, raw(tag_bytes(TAG_END)))
    elif isinstance(dtype, T.ArrayType):
        items = F.transform(
            x,
            lambda v, i: F.hex(
                _element(
                    v,
                    dtype.elementType,
                    F.concat(F.encode(i.cast("string"), "UTF-8"), raw(b"\x00")),
                )
            ),
        )
        body = F.unhex(F.array_join(items, ""))
        full = F.concat(raw(tag_bytes(TAG_ARRAY)), name, body, raw(tag_bytes(TAG_END)))
    elif isinstance(dtype, T.NullType):
        return null
    else:
        tag, data = value_bytes(x, dtype)
        full = F.concat(raw(tag_bytes(tag)), name, data)
    return F.when(x.isNull(), null).otherwise(full)


def digest64(data: Column) -> Column:
    """First eight MD5 bytes of ``data`` as a little-endian signed bigint.

    Reversing the hex text reverses the bytes and the two digits of each; the digits are
    put back by one masked shift. That names the digest twice, where ``swap_bytes`` would
    name it eight times and a filter (no common subexpressions there) would compute it so.
    """
    return _digits_back(_reversed_head(data))


def _reversed_head(data: Column) -> Column:
    """The first 16 hex digits of the MD5 of ``data`` in reverse order, as a number."""
    return F.conv(F.reverse(F.substring(F.md5(data), 1, 16)), 16, -10).cast("bigint")


def _digits_back(head: Column) -> Column:
    """The two hex digits of each byte of a bigint exchanged."""
    digits = F.lit(0x0F0F0F0F0F0F0F0F)
    upper = F.shiftrightunsigned(head, 4).bitwiseAND(digits)
    return F.shiftleft(head.bitwiseAND(digits), 4).bitwiseOR(upper)


def hash64(x: Column, dtype: T.DataType | None = None, seed: int = SEED) -> Column:
    """The 64-bit hash of a column of type ``dtype`` (bigint if not given). NULL stays NULL."""
    dtype = dtype or T.LongType()
    if dtype == KEY_TYPE:
        return _key_hash(x, seed)
    if isinstance(dtype, T.NumericType):
        prefix = raw(tag_bytes(seed) + tag_bytes(TAG_NUMBER))
        return digest64(F.concat(prefix, le64_bytes(as_int64(x, dtype))))
    data = F.concat(raw(tag_bytes(seed)), _element(x, dtype, raw(b"")))
    return F.when(x.isNotNull(), digest64(data))


def _key_number(part: Column) -> Column:
    """The number of a key part as bigint."""
    return F.coalesce(as_int64(part["exact"], T.DecimalType(38, 18)), truncated(part["number"]))


def _key_data(part: Column, number: Column, seed: int) -> Column:
    """The bytes to hash of a key part: those of a column of its kind. A missing field has none."""
    rank, text = part["rank"], part["text"]
    sized = F.concat(le32_bytes(F.octet_length(text)), F.encode(text, "UTF-8"))

    def tagged(tag: int, *data: Column) -> Column:
        return F.concat(raw(tag_bytes(seed) + tag_bytes(tag)), *data)

    def plain(x: Column, dtype: T.DataType) -> Column:
        return F.when(x.isNotNull(), F.concat(raw(tag_bytes(seed)), _element(x, dtype, raw(b""))))

    return (
        F.when(rank.isNull(), None).when(rank == NUMBER, tagged(TAG_NUMBER, le64_bytes(number)))
        .when(rank.isin(TEXT, OBJECT_ID), plain(text, T.StringType())).when(rank == NULL, tagged(TAG_NULL))
        .when(rank == BOOLEAN, plain(part["exact"] == 1, T.BooleanType()))
        .when(rank.isin(DATE, STAMP), tagged(TAG_DATE, le64_bytes(number)))
        .when(rank == ARRAY, tagged(TAG_ARRAY, sized)).otherwise(tagged(TAG_OBJECT, le32_bytes(rank), sized)))


def _key_hash(part: Column, seed: int) -> Column:
    """The hash of a key part: that of a column of its kind. A missing field has none."""
    return digest64(_key_data(part, _key_number(part), seed))


def with_hash(df: DataFrame, name: str, out: str, seed: int = SEED) -> DataFrame:
    """``df`` with the hash of a column as ``out``.

    The hash of a key part names its number sixteen times and its digest twice, in branches, where Spark finds no common parts. Each stands
    in a projection of its own, which the optimizer keeps apart, as the next one names it more than once.
    """
    dtype = df.select(name).schema[0].dataType
    if dtype != KEY_TYPE:
        return df.withColumn(out, hash64(F.col(name), dtype, seed))
    part, others = F.col(name), [c for c in df.columns if c != out]
    df = df.withColumn("__number", _key_number(part))
    df = df.select(*others, _reversed_head(_key_data(part, F.col("__number"), seed)).alias("__head"))
    return df.select(*others, _digits_back(F.col("__head")).alias(out))


def hash_column(df: DataFrame, name: str, seed: int = SEED) -> Column:
    """``hash64`` of a column of ``df``, typed from its schema."""
    return hash64(F.col(name), df.select(name).schema[0].dataType, seed)
