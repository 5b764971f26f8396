"""Payload envelopes -> one row per record.

Each landed payload row is parsed once into a VARIANT (``doc``). Unwrapping
is a ``posexplode`` of an ``array<variant>`` built per row, so the work is
spread over partitions like any projection: no payload, record list or
group is ever gathered in one place.

Modes (how the original pipelines read their envelopes):

``records``  ``data`` if the document is an object holding it, else the
             document; an object is one record, an array gives its object
             elements; falsy values give nothing.
``array``    as ``records`` but only arrays are accepted (an object is
             rejected). What says ``message`` and ``code`` beside its data is
             data; a load whose source means an error by them asks for
             ``skip_errors``.
``first``    the first record only: ``data[0]``, the ``data`` object, the
             document itself when it has no ``data``, or the first element
             of an array document.
``list``     the document must be an object; its ``data`` array's objects.
``path``     the array at a nested path (e.g. ``data.quotes``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickroll.functions import jsonfn as J

MODES = ("records", "array", "first", "list", "path")


def _v(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def message_code_error(doc) -> Column:
    doc = _v(doc)
    return J.is_object(doc) & J.truthy(J.get(doc, "message")) & J.truthy(J.get(doc, "code"))


def status_error(doc) -> Column:
    doc = _v(doc)
    return J.is_object(doc) & J.truthy(J.get(doc, ("status", "error_message")))


def error_kind(doc) -> Column:
    doc = _v(doc)
    return (F.when(message_code_error(doc), F.lit("message_code"))
             .when(status_error(doc), F.lit("status")))


def split_errors(docs: DataFrame, doc_col: str = "doc") -> tuple[DataFrame, DataFrame]:
    """(data payloads, error payloads with ``error_kind`` and ``message``)."""
    kind = error_kind(doc_col)
    msg = F.coalesce(J.get(doc_col, "message", "string"),
                     J.get(doc_col, ("status", "error_message"), "string"))
    data = docs.where(kind.isNull())
    errors = (docs.where(kind.isNotNull())
                  .withColumn("error_kind", kind).withColumn("message", msg))
    return data, errors


def raise_on_errors(errors: DataFrame) -> None:
    """The 'fail' policy: any error payload aborts the load."""
    if not errors.isEmpty():
        first = errors.select("error_kind", "message").first()
        raise RuntimeError(f"payload error ({first['error_kind']}): {first['message']}")


def unwrap(docs: DataFrame, mode: str = "records", doc_col: str = "doc", keep=None,
           path=("data", "quotes"), skip_errors: str | None = None, dead: str | None = None,
           rec_type: str | None = None) -> DataFrame:
    """One row per record object: ``keep`` columns, ``_pos`` and ``rec``.

    Array elements that are not objects (numbers, strings, nulls) are
    dropped. Intermediate values are computed in stacked projections so
    each is evaluated once per payload (Catalyst does not collapse a
    projection whose non-trivial expressions are used more than once).

    ``skip_errors`` ('message_code', 'status' or 'any') yields no records for
    error payloads. It masks the record array inside the projection rather
    than filtering on the document: a filter would be pushed below the
    projections and re-evaluate the JSON parse once per reference.

    ``dead`` names the payload column: payloads that give no records because
    they are 'unreadable' (no JSON), errors (under the name of their test) or
    of the 'wrong_shape' then come out as rows of their own, with ``_kind`` and
    ``_payload`` (both NULL on records), in the same pass.

    ``rec_type`` (mode 'path') names the struct type that records are read as:
    the whole array is read in one go, in place of a VARIANT copy of each
    element that is probed for an object and then read. What is no object is
    NULL as such a struct, so the same elements are dropped.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
    if rec_type and mode != "path":
        raise ValueError("rec_type goes with mode 'path'")
    keep = [c for c in (keep if keep is not None else docs.columns) if c != doc_col]
    out_keep = list(keep)
    if skip_errors:
        test = {"message_code": message_code_error, "status": status_error,
                "any": lambda d: error_kind(d).isNotNull()}[skip_errors]
        docs = docs.select(*keep, *[dead] * (dead is not None and dead not in keep), doc_col, test(doc_col).alias("_skip"))
        keep = [*keep, "_skip"]
    if dead:
        kind = F.when(F.col(doc_col).isNull(), F.lit("unreadable"))
        kind = kind.when(F.col("_skip"), F.lit(skip_errors)) if skip_errors else kind
        docs = docs.select(*keep, doc_col, kind.alias("_why"), F.col(dead).alias("_text"))
        keep = [*keep, "_why", "_text"]
    doc = F.col(doc_col)
    if mode in ("records", "array"):
        # ``data`` if the document is an object holding it (even as null), else the document
        s1 = docs.select(*keep, doc.alias("_doc"), J.get(doc, "data").alias("_data"))
        s2 = s1.select(*keep, F.coalesce("_data", "_doc").alias("_d"))
        s3 = s2.select(*keep, "_d", J.as_array("_d").alias("_arr"))
        if mode == "records":
            cand = F.coalesce(F.col("_arr"),
                              F.when(J.is_object("_d") & J.nonempty_object("_d"), F.array("_d")))
        else:
            cand = F.col("_arr")
    elif mode == "first":
        s1 = docs.select(*keep, doc.alias("_doc"), J.get(doc, "data").alias("_data"),
                         J.is_object(doc).alias("_obj"))
        first_of_data = F.coalesce(F.slice(J.as_array("_data"), 1, 1),
                                   F.when(J.is_object("_data"), F.array("_data")))
        cand0 = (F.when(F.col("_obj") & F.col("_data").isNotNull(), first_of_data)
                  .when(F.col("_obj"), F.array("_doc"))
                  .otherwise(F.slice(J.as_array("_doc"), 1, 1)))
        s3 = s1.select(*keep, cand0.alias("_cand"))
        cand = F.col("_cand")
    elif mode == "list":
        s3 = docs.select(*keep, doc.alias("_doc"))
        cand = F.when(J.is_object("_doc"), J.as_array(J.get("_doc", "data")))
    else:  # path
        s3 = docs.select(*keep, doc.alias("_doc"))
        cand = J.get("_doc", path, f"array<{rec_type}>") if rec_type else J.as_array(J.get("_doc", path))
    if skip_errors:
        cand = F.when(~F.col("_skip"), cand)
    ok = F.col("rec").isNotNull() if rec_type else J.is_object("rec")
    if mode == "first":
        ok = ok & J.nonempty_object("rec")
    if dead:
        s4 = s3.select(*out_keep, "_why", "_text", cand.alias("_records"))
        s5 = s4.withColumn("_kind", F.coalesce("_why", F.when(F.col("_records").isNull(), F.lit("wrong_shape"))))
        return s5.select(*out_keep, "_kind", F.when(F.col("_kind").isNotNull(), F.col("_text")).alias("_payload"),
                         F.posexplode_outer("_records").alias("_pos", "rec")).where(F.col("_kind").isNotNull() | ok)
    # the outer form: from the inner one Spark infers that the array is not empty, and tests it at the scan,
    # where every use of the document parses it once more
    return s3.select(*out_keep, F.posexplode_outer(cand).alias("_pos", "rec")).where(ok)


def object_counts(docs: DataFrame, doc_col: str = "doc", keep=None) -> DataFrame:
    """Per array payload (``data`` array or array document): elements seen,
    object elements kept and elements dropped."""
    keep = [c for c in (keep if keep is not None else docs.columns) if c != doc_col]
    s1 = docs.select(*keep, F.col(doc_col).alias("_doc"), J.get(doc_col, "data").alias("_data"))
    with_arr = (s1.select(*keep, J.as_array(F.coalesce("_data", "_doc")).alias("_arr"))
                  .where(F.col("_arr").isNotNull()))
    objects = F.size(F.filter("_arr", lambda e: J.is_object(e)))
    return with_arr.select(*keep, F.size("_arr").alias("elements"),
                           objects.alias("objects"),
                           (F.size("_arr") - objects).alias("dropped"))
