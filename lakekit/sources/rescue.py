"""Comparison of semi-structured values with a wanted type: what fits comes back typed, what does not as JSON text.

Nothing is lost: the typed value and the rest together hold every field, element and entry of the original. The comparison
is one expression over a VARIANT, made from the wanted type, so it runs inside the scan's stage, in batch and stream alike.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StringType, StructType, VariantType

#: A value as both parts: typed, and what does not fit (JSON text, NULL if all does).
VALUE, REST = "value", "rest"


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def quoted(text: Column) -> Column:
    """A string as JSON text."""
    return F.regexp_extract(F.to_json(F.array(text)), r"(?s)^\[(.*)\]$", 1)


def json_object(rests: Column) -> Column:
    """JSON object of a map from names to JSON texts, NULL if it is empty."""
    entries = F.transform(F.map_entries(rests), lambda e: F.concat(quoted(e["key"]), F.lit(":"), e["value"]))
    return F.when(F.size(rests) > 0, F.concat(F.lit("{"), F.array_join(entries, ","), F.lit("}")))


def _as(v: Column, kind: str) -> Column:
    return F.try_variant_get(v, "$", kind)


def _part(value: Column, rest: Column, kind: DataType) -> Column:
    return F.struct(value.cast(kind).alias(VALUE), rest.cast("string").alias(REST))


def fit(v: Column, kind: DataType) -> Column:
    """STRUCT<value, rest> of a VARIANT and a type.

    Structs, arrays and maps with text keys are compared part by part, at any depth; field names with their case. A null, and a
    JSON null, fits everything. A field that the type lacks is rest. A scalar that has no cast to the type is rest, and so is any
    value of another shape; an array of which an element does not fit is rest as a whole, with NULL for that element in the value.
    """
    absent = v.isNull() | F.is_variant_null(v)
    whole = F.to_json(v)
    if isinstance(kind, VariantType):
        return F.struct(v.alias(VALUE), F.lit(None).cast("string").alias(REST))
    if isinstance(kind, StructType):
        def fields(m: Column) -> Column:
            parts = F.struct(*(fit(m[f.name], f.dataType).alias(f"f{i}") for i, f in enumerate(kind.fields)))

            def both(p: Column) -> Column:
                known = [f.name for f in kind.fields]
                value = F.struct(*(p[f"f{i}"][VALUE].alias(n) for i, n in enumerate(known)))
                bad = F.map_from_arrays(F.array(*map(F.lit, known)), F.array(*(p[f"f{i}"][REST] for i in range(len(known)))))
                more = F.transform_values(F.map_filter(m, lambda k, _: ~k.isin(known)), lambda _, x: F.to_json(x))
                return _part(value, json_object(F.map_concat(F.map_filter(bad, lambda _, r: r.isNotNull()), more)), kind)

            return let(parts, both)

        return _shaped(v, absent, whole, _as(v, "map<string, variant>"), fields, kind)
    if isinstance(kind, ArrayType):
        def elements(a: Column) -> Column:
            parts = F.transform(a, lambda x: fit(x, kind.elementType))
            return let(parts, lambda p: _part(F.transform(p, lambda x: x[VALUE]), F.when(F.exists(p, lambda x: x[REST].isNotNull()), whole), kind))

        return _shaped(v, absent, whole, _as(v, "array<variant>"), elements, kind)
    if isinstance(kind, MapType) and isinstance(kind.keyType, StringType):
        def entries(m: Column) -> Column:
            parts = F.transform_values(m, lambda _, x: fit(x, kind.valueType))
            return let(parts, lambda p: _part(
                F.transform_values(p, lambda _, x: x[VALUE]),
                json_object(F.transform_values(F.map_filter(p, lambda _, x: x[REST].isNotNull()), lambda _, x: x[REST])), kind))

        return _shaped(v, absent, whole, _as(v, "map<string, variant>"), entries, kind)
    text = v.cast("string")
    value = text if isinstance(kind, StringType) else text.try_cast(kind)
    return let(value, lambda x: F.struct(
        F.when(~absent, x).cast(kind).alias(VALUE), F.when(~absent & x.isNull(), whole).cast("string").alias(REST)))


def _shaped(v: Column, absent: Column, whole: Column, inside: Column, body, kind: DataType) -> Column:
    """``body`` of the value's inside where the value has that shape."""
    nothing = F.lit(None).cast(kind)
    return let(inside, lambda x: F.when(absent, _part(nothing, F.lit(None), kind)).when(x.isNull(), _part(nothing, whole, kind)).otherwise(body(x)))
