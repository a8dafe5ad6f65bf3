"""Fields of JSON objects and of arrays of JSON objects, as text.

Inputs may be JSON text or already parsed (struct, array of structs).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.names import q


def _object_type(field: str) -> T.StructType:
    return T.StructType([T.StructField(field, T.StringType())])


def json_field(value: Column, field: str, dtype: T.DataType | None = None) -> Column:
    """Text of one field of a JSON object; NULL when missing, null or not an object.

    ``dtype`` is the type of ``value``; leave it out for JSON text.
    """
    if isinstance(dtype, T.StructType):
        if field not in dtype.names:
            return F.lit(None).cast("string")
        return _field_text(value.getField(field), dtype[field].dataType)
    if "'" in field:
        return F.from_json(value, _object_type(field)).getField(field)
    return F.get_json_object(value, _path(field))


def json_array_join(
    value: Column, field: str, separator: str = ", ", dtype: T.DataType | None = None
) -> Column:
    """Join one field of every object of a JSON array, in array order.

    Elements without the field, or with a null in it, are skipped; when none is
    left the result is NULL, not empty text. Elements that are not objects count
    as having no field. A lone object is read as an array of one.
    """
    if isinstance(dtype, T.ArrayType):
        element = dtype.elementType
        if isinstance(element, T.StructType):
            values = F.transform(value, lambda e: json_field(e, field, element))
        else:
            values = F.transform(value, lambda e: json_field(e.cast("string"), field))
    else:
        parsed = F.from_json(value, T.ArrayType(_object_type(field))).getField(field)
        # An array that mixes objects with other elements does not fit the
        # typed parse; only those rows take the second, untyped one.
        values = parsed if "'" in field else F.coalesce(parsed, _loose_fields(value, field))
    joined = F.array_join(values, separator)
    # Joining skips nulls, so empty text means no value at all, or empty ones.
    return F.when((joined != "") | F.array_contains(values, ""), joined)


def _loose_fields(value: Column, field: str) -> Column:
    variants = F.try_variant_get(F.try_parse_json(value), "$", "array<variant>")
    return F.transform(variants, lambda v: F.try_variant_get(v, _path(field), "string"))


def _path(field: str) -> str:
    return f"$['{field}']"


def _field_text(value: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_json(value)
    return value.cast("string")


def complex_to_text(name: str, dtype: T.DataType) -> Column:
    """A column as text; nested values become JSON text."""
    return _field_text(F.col(q(name)), dtype)
