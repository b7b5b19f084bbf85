"""Whole documents without a schema: keys, order, hash, size and text of variants.

A document stays one variant column through load, reshard, dump and restore, so no field needs to be declared
and none is lost. What a variant cannot do in Spark (be compared, grouped or hashed) is done on
columns made from it: a key part per key field, which any two values can be ordered by, and the canonical
text of a document, in which the fields stand by name and every value as JSON.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkroute.functions.extjson import Value, step
from sparkroute.functions.hashing import (
    ARRAY,
    BINARY,
    BOOLEAN,
    DATE,
    EXACT,
    KEY_TYPE,
    LEAST,
    MOST,
    NULL,
    NUMBER,
    OBJECT,
    OBJECT_ID,
    REGEX,
    STAMP,
    TEXT,
)
from sparkroute.functions.keys import ShardKey
from sparkroute.operators.once import computed_once

DOC = "doc"
def has_variant(dtype: T.DataType) -> bool:
    """Whether values of the type contain variants."""
    if isinstance(dtype, T.StructType):
        return any(has_variant(f.dataType) for f in dtype.fields)
    if isinstance(dtype, T.ArrayType):
        return has_variant(dtype.elementType)
    return isinstance(dtype, T.VariantType) or (isinstance(dtype, T.MapType) and has_variant(dtype.valueType))


def comparable(df: DataFrame, name: str) -> Column:
    """A column that can be grouped, ordered and hashed: variants as their canonical text."""
    return F.to_json(F.col(name)) if has_variant(df.schema[name].dataType) else F.col(name)


def canonical_text(doc: Column) -> Column:
    """A document as JSON with its fields by name, at every depth."""
    return F.to_json(doc)


def _forms(x: Value) -> Column:
    """What a value is as a number, a date, a timestamp (in one number), a truth value and an object id; the others are NULL."""
    date = x.wrapped("$date")
    millis = F.coalesce(date.try_cast("bigint"), F.unix_millis(date.try_cast("timestamp")))
    number = F.coalesce(x.number, x.whole, x.wrapped("$numberDouble", "$numberDecimal"))
    part = lambda name: F.try_variant_get(x.v, f'$["$timestamp"]["{name}"]', EXACT)
    stamp = F.when(x.wrapper("$timestamp", "OBJECT<i: BIGINT, t: BIGINT>"), part("t") * 4294967296 + part("i"))
    truth = F.when(x.kind == "BOOLEAN", F.when(x.text == "true", 1).otherwise(0))
    return F.struct(number.alias("number"), millis.alias("millis"), stamp.try_cast(EXACT).alias("stamp"), truth.alias("truth"),
                    F.lower(x.wrapped("$oid")).alias("oid"))


def _rank(x: Value, forms: Column) -> Column:
    opens = lambda *names: F.regexp_extract(x.kind, "^OBJECT<`([^`]*)`", 1).isin(*names)
    return (
        F.when(x.kind.isNull(), None).when(x.kind == "VOID", NULL).when(forms["number"].isNotNull(), NUMBER)
        .when(x.is_text, TEXT).when(forms["truth"].isNotNull(), BOOLEAN).when(x.kind.startswith("ARRAY"), ARRAY)
        .when(forms["oid"].isNotNull(), OBJECT_ID).when(forms["millis"].isNotNull(), DATE).when(forms["stamp"].isNotNull(), STAMP)
        .when(~x.kind.startswith("OBJECT<`$"), OBJECT).when(opens("$undefined"), NULL).when(opens("$binary"), BINARY)
        .when(opens("$regex", "$options"), REGEX).when(opens("$minkey", "$minKey"), LEAST)
        .when(opens("$maxkey", "$maxKey"), MOST).otherwise(OBJECT))


def _key_part(x: Value, forms: Column, rank: Column) -> Column:
    """A value as a key part; NULL where the field is missing, which is not the same as a null value."""
    exact = F.coalesce(forms["number"].try_cast(EXACT), forms["truth"].cast(EXACT), forms["millis"].cast(EXACT), forms["stamp"])
    double = F.when(forms["number"].isNotNull(), forms["number"].try_cast("double")).otherwise(exact.cast("double"))
    plain = F.when(rank == TEXT, x.text).when(rank == OBJECT_ID, forms["oid"])
    text = F.when(rank.isin(NULL, NUMBER, TEXT, BOOLEAN, DATE, STAMP, OBJECT_ID), plain).otherwise(F.to_json(x.v))
    part = F.struct(rank.alias("rank"), double.alias("number"), exact.alias("exact"), text.alias("text"))
    return F.when(rank.isNotNull(), part).cast(KEY_TYPE)


def with_keys(df: DataFrame, key: ShardKey | str | dict, doc: str = DOC) -> DataFrame:
    """Adds the key fields of the variant ``doc`` as key parts, which route, sort and hash like plain columns.

    A null field has a key part, the lowest; a missing field has NULL, so the row has no complete key.
    """
    key = ShardKey.parse(key)
    others, every = [c for c in df.columns if c not in key.names], list(enumerate(key.names))
    values = {f"__v{i}": Value.of(F.try_variant_get(F.col(doc), "$" + step(n), "variant")) for i, n in every}
    df = computed_once(df, others, values)
    forms = {f"__f{i}": _forms(Value(F.col(f"__v{i}"))) for i, _ in every}
    df = computed_once(df, [*others, *values], forms)
    ranks = {f"__r{i}": _rank(Value(F.col(f"__v{i}")), F.col(f"__f{i}")) for i, _ in every}
    df = computed_once(df, [*others, *values, *forms], ranks)
    parts = {n: _key_part(Value(F.col(f"__v{i}")), F.col(f"__f{i}"), F.col(f"__r{i}")) for i, n in every}
    return computed_once(df, others, parts)


def with_id(line: Column, made: Column, name: str = "_id") -> Column:
    """The JSON text of a document with an id as its first field."""
    rest = F.ltrim(F.substring(F.ltrim(line), F.lit(2), F.length(line)))
    comma = F.when(rest.startswith("}"), F.lit("")).otherwise(F.lit(", "))
    return F.concat(F.lit(f'{{"{name}": {{"$oid": "'), made, F.lit('"}'), comma, rest)
