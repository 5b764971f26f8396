"""Declared column mappings: JSON record -> typed table row in one ``select``.

A mapping is a list of :class:`ColumnSpec`. Missing keys become NULL and
unmapped keys are dropped. Wide mappings (hundreds of columns) still build
a single projection, never a ``withColumn`` loop.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tickroll.functions import jsonfn as J
from tickroll.functions.textfn import safe_float_text


@dataclass(frozen=True)
class ColumnSpec:
    """One mapped column.

    ``dtype`` is a Spark SQL type name, or ``'json'`` for values stored as
    JSON text (strings pass through). ``value_type='float'`` applies the
    tolerant numeric cast. ``source_path`` reads a nested path instead of
    the top-level ``json_key``.
    """

    json_key: str
    column: str
    dtype: str = "string"
    source_path: tuple | None = None
    value_type: str | None = None

    @property
    def path(self) -> tuple:
        return tuple(self.source_path) if self.source_path else (self.json_key,)


def specs_from_config(columns: Sequence, dtypes: Mapping[str, str] | None = None,
                      default_dtype: str = "string") -> list[ColumnSpec]:
    """Mapping config -> specs. Plain names expand to identity mappings."""
    dtypes = dict(dtypes or {})
    out = []
    for c in columns:
        if isinstance(c, ColumnSpec):
            out.append(c)
        elif isinstance(c, Mapping):
            col = str(c["column"])
            out.append(ColumnSpec(str(c["json_key"]), col,
                                  c.get("dtype", dtypes.get(col, default_dtype)),
                                  tuple(c["source_path"]) if c.get("source_path") else None,
                                  c.get("value_type")))
        else:
            out.append(ColumnSpec(str(c), str(c), dtypes.get(str(c), default_dtype)))
    return out


def _leaf_type(spec: ColumnSpec) -> str:
    return "variant" if (spec.value_type == "float" or spec.dtype == "json") else spec.dtype


def _finish(value: Column, spec: ColumnSpec) -> Column:
    """Post-process a leaf read with ``_leaf_type``."""
    if spec.value_type == "float":
        v = J.safe_float(value)
        return v if spec.dtype in ("double", "string") else v.cast(spec.dtype)
    if spec.dtype == "json":
        return J.to_text(value)
    return value


def extract(rec, spec: ColumnSpec) -> Column:
    """The typed value of one spec from a VARIANT record (single column use)."""
    return _finish(J.get(rec, spec.path, _leaf_type(spec)), spec)


def _quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def record_struct_type(specs: Sequence[ColumnSpec]) -> str | None:
    """One nested struct type covering every spec path, or None on a clash.

    Reading a record as this struct (one ``try_variant_get``) looks every
    field up in a single pass; hundreds of separate path reads per row are
    about 100x slower. Keys match case-sensitively; a field whose value
    cannot be cast, or a path step that is not an object, gives NULL for
    that field only.
    """
    tree: dict = {}
    for s in specs:
        node = tree
        for key in s.path[:-1]:
            nxt = node.setdefault(key, {})
            if not isinstance(nxt, dict):
                return None
            node = nxt
        leaf, t = s.path[-1], _leaf_type(s)
        if leaf in node and node[leaf] != t:
            return None
        node[leaf] = t

    def render(node: dict) -> str:
        return "struct<" + ", ".join(
            f"{_quote(k)}: {render(v) if isinstance(v, dict) else v}" for k, v in node.items()) + ">"
    return render(tree) if tree else None


def map_columns(records: DataFrame, specs: Sequence[ColumnSpec], rec_col: str = "rec",
                keep=(), overrides: Mapping[str, Column] | None = None) -> DataFrame:
    """Project records to the mapped columns (plus ``keep`` columns).

    ``overrides`` replaces the value of named output columns, e.g. a
    dimension column that must win over a record field. The record is
    read once as a struct; each column is then a field access. ``rec_col``
    may hold records that were read as ``record_struct_type`` already.
    """
    overrides = dict(overrides or {})
    todo = [s for s in specs if s.column not in overrides]
    read = isinstance(records.schema[rec_col].dataType, StructType)
    stype = record_struct_type(todo)
    if stype is None and not read:            # clashing paths: read each column on its own
        rec = F.col(rec_col)
        return records.select(*keep, *[
            (overrides[s.column] if s.column in overrides else extract(rec, s)).alias(s.column)
            for s in specs])
    staged = records.select(*records.columns, (F.col(rec_col) if read else F.try_variant_get(F.col(rec_col), "$", stype)).alias("_rs"))
    # Leaves needing the tolerant float cast are split into kind, text and
    # number columns first and combined in the next projection: one CASE
    # over freshly computed VARIANT reads is several times slower.
    parts, finals = [], []
    for i, s in enumerate(specs):
        if s.column in overrides:
            finals.append(overrides[s.column].alias(s.column))
            continue
        field = F.col("_rs")
        for key in s.path:
            field = field.getField(key)
        if s.value_type == "float":
            parts += [F.schema_of_variant(field).alias(f"_k{i}"),
                      F.try_variant_get(field, "$", "string").alias(f"_s{i}"),
                      F.try_variant_get(field, "$", "double").alias(f"_d{i}")]
            v = F.when(F.col(f"_k{i}") == "STRING", safe_float_text(f"_s{i}")).otherwise(F.col(f"_d{i}"))
            finals.append((v if s.dtype in ("double", "string") else v.cast(s.dtype)).alias(s.column))
        else:
            parts.append(_finish(field, s).alias(f"_v{i}"))
            finals.append(F.col(f"_v{i}").alias(s.column))
    return staged.select(*records.columns, *parts).select(*keep, *finals)


def fill_falsy(rec, key: str, default, dtype: str = "string") -> Column:
    """The record's ``key``, or ``default`` when it is missing, null, '' or 0."""
    raw = J.get(rec, key)
    d = F.col(default) if isinstance(default, str) else default
    return F.when(J.truthy(raw), J.get(rec, key, dtype)).otherwise(d.cast(dtype))
