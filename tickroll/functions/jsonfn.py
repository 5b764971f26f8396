"""JSON payload helpers on Spark's VARIANT type.

A payload is parsed once (``try_parse_json``: bad JSON -> NULL) and then
inspected with ``schema_of_variant`` / ``variant_get`` on the JVM side.
An absent key gives SQL NULL; a JSON ``null`` gives a variant null.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from tickroll.functions.textfn import safe_float_text

_IDENT = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*$")


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse(c) -> Column:
    """Text -> VARIANT; NULL for text that is not JSON."""
    return F.try_parse_json(_col(c))


def json_path(path) -> str:
    """('quote','USD','x') -> "$.quote.USD.x" (bracket-quoted when needed)."""
    if isinstance(path, str):
        path = (path,)
    out = "$"
    for key in path:
        if _IDENT.match(key):
            out += "." + key
        else:
            out += "['" + key.replace("'", "\\'") + "']"
    return out


# Casting to a struct succeeds for any object (missing fields are NULL) and
# fails fast for every other kind, so it tests "is an object" without
# walking the value (``schema_of_variant`` builds the full schema text).
_OBJECT_PROBE = "struct<`__tickroll_object_probe`: boolean>"


def kind(v) -> Column:
    """'OBJECT', 'ARRAY', 'STRING', 'BIGINT', ..., 'VOID' (JSON null) or NULL.

    Cost grows with the size of ``v``: use it on scalars (or not at all).
    """
    s = F.schema_of_variant(_col(v))
    return F.when(_col(v).isNotNull(), F.regexp_extract(s, r"^([A-Z_]+)", 1))


def is_object(v) -> Column:
    return F.try_variant_get(_col(v), "$", _OBJECT_PROBE).isNotNull()


def as_array(v) -> Column:
    """Variant array -> array<variant> (NULL when not an array)."""
    return F.try_variant_get(_col(v), "$", "array<variant>")


def is_array(v) -> Column:
    return as_array(v).isNotNull()


def nonempty_object(v) -> Column:
    return F.size(F.try_variant_get(_col(v), "$", "map<string,variant>")) > 0


def get(v, path, dtype: str = "variant") -> Column:
    """Value at a nested path; NULL at any missing or non-object step."""
    return F.try_variant_get(_col(v), json_path(path), dtype)


def _scalar_truthy(v: Column) -> Column:
    k = kind(v)
    return (F.when(k == "BOOLEAN", F.try_variant_get(v, "$", "boolean"))
             .when(k == "STRING", F.length(F.try_variant_get(v, "$", "string")) > 0)
             .otherwise(F.coalesce(F.try_variant_get(v, "$", "double") != 0, F.lit(True))))


def truthy(v) -> Column:
    """Python truthiness of a JSON value (None, false, 0, '', [], {} are false)."""
    v = _col(v)
    return (F.when(v.isNull() | F.is_variant_null(v), F.lit(False))
             .when(is_object(v), nonempty_object(v))
             .when(is_array(v), F.size(as_array(v)) > 0)
             .otherwise(_scalar_truthy(v)))


def safe_float(v) -> Column:
    """Tolerant JSON value -> double (numbers, booleans, numeric text).

    Strings go through the text guard; every other kind is cast directly
    (objects, arrays and nulls give NULL).
    """
    v = _col(v)
    return F.when(F.schema_of_variant(v) == F.lit("STRING"),
                  safe_float_text(F.try_variant_get(v, "$", "string"))) \
            .otherwise(F.try_variant_get(v, "$", "double"))


def to_text(v) -> Column:
    """Nested values as compact JSON text; strings pass through; null -> NULL."""
    v = _col(v)
    k = kind(v)
    return (F.when(k == "STRING", F.try_variant_get(v, "$", "string"))
            .when(k.isNotNull() & (k != "VOID"), F.to_json(v)))
