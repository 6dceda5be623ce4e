"""Captured REST responses: collection envelopes and error bodies.

Responses are text columns (one response per row, e.g. read with
``spark.read.text`` or landed by a collector). Parsing is ``from_json`` with
a declared schema: narrow, no shuffle, no schema inference pass.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T



def envelope_schema(outer: str, inner: str, item: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(outer, T.StructType([
        T.StructField(inner, T.ArrayType(item), True)]), True)])


def flatten_envelope(df: DataFrame, json_col: str, outer: str, inner: str,
                     item: T.StructType, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per item of ``{outer: {inner: [item, ...]}}``.

    A null or missing ``outer`` (the resource manager sends
    ``{"apps": null}`` when there are none), a null or empty list and an
    unparseable body give no rows.
    """
    parsed = F.from_json(F.col(json_col), envelope_schema(outer, inner, item))
    return (df.select(*keep, F.explode(parsed[outer][inner]).alias("_item"))
            .select(*keep, "_item.*"))


# Status labels of error bodies.
STATUS_REMOTE = "remote"          # RemoteException with a message
STATUS_REMOTE_OTHER = "remote_other"  # RemoteException without a message
STATUS_NOT_JSON = "not_json"      # body is not JSON: raw text is the message
STATUS_UNKNOWN = "unknown"        # JSON without RemoteException


def split_error_responses(df: DataFrame, text_col: str = "body") -> DataFrame:
    """Add ``status`` and ``message`` for failed-response bodies, in one pass.

    Message: the RemoteException's message; else the exception value's own
    text; else the raw body when it is not JSON. Valid JSON without a
    RemoteException (a KeyError or TypeError in the reference) gets status
    ``unknown``.

    ``try_parse_json`` gives a VARIANT, or NULL when the text is not JSON, but
    ignores what follows a value. So a body is parsed twice, as an object's only
    value and as an array's only item: text behind its first value would have to
    close the object with ``}`` and the array with ``]``, so only a body that is
    one value alone passes both.
    """
    body = F.col(text_col)
    v = F.try_parse_json(F.concat(F.lit('{"v":'), body, F.lit("}")))
    rex = F.try_variant_get(v, "$.v.RemoteException", "string")
    msg = F.try_variant_get(v, "$.v.RemoteException.message", "string")
    not_json = v.isNull() | F.try_parse_json(F.concat(F.lit("["), body, F.lit("]"))).isNull()
    status = (F.when(not_json, STATUS_NOT_JSON)
              .when(msg.isNotNull(), STATUS_REMOTE)
              .when(rex.isNotNull(), STATUS_REMOTE_OTHER)
              .otherwise(STATUS_UNKNOWN))
    message = (F.when(not_json, F.col(text_col))
               .when(msg.isNotNull(), msg)
               .when(rex.isNotNull(), rex))
    return df.withColumn("status", status).withColumn("message", message)
