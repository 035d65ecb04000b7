"""Pushed JSON bodies: one event, a wrapper with ``events`` or a raw array."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from vantrail.functions import computed_once
from vantrail.schema import EVENT_REQUEST, MAX_BODY_BYTES, TOO_LARGE

# --- Fixed values: body errors ------------------------------------------------
EMPTY_BODY = "empty body"
NOT_A_CONTAINER = "expected JSON object or array"
BAD_ARRAY = "invalid JSON array"
BAD_OBJECT = "invalid JSON object"
BAD_EVENTS = "invalid JSON in events array"
# -----------------------------------------------------------------------------

_FIRST_CHARACTER = r"^[ \t\r\n\x0B\f]*([^ \t\r\n\x0B\f])"


_JSON_TYPES = {
    T.StringType: ("STRING",),
    T.DoubleType: ("BIGINT", "DOUBLE", "FLOAT", "DECIMAL"),
    T.LongType: ("BIGINT",),
    T.BooleanType: ("BOOLEAN",),
}


def _malformed(event: Column) -> Column:
    """True when an element is no object or a field has a JSON type it must not have.

    A null is allowed everywhere and leaves the field unset.
    """
    kind = F.schema_of_variant(event)
    wrong = ~(kind.startswith("OBJECT") | (kind == "VOID"))
    for field in EVENT_REQUEST.fields:
        # Kinds are plain words, but for DECIMAL(p,s).
        found = F.substring_index(F.schema_of_variant(F.try_variant_get(event, f"$.{field.name}", "variant")), "(", 1)
        allowed = (*_JSON_TYPES[type(field.dataType)], "VOID")
        wrong = wrong | F.coalesce(~found.isin(*allowed), F.lit(False))
    return wrong


def _typed(event: Column) -> Column:
    return F.try_variant_get(event, "$", EVENT_REQUEST.simpleString())


def parse_bodies(df: DataFrame, body: str = "body") -> DataFrame:
    """Adds ``events`` (array of requests) and ``body_error``.

    One malformed element rejects the whole body, as does a body over the size
    limit, so the events of one row are bounded. The body is parsed inside
    brackets: a valid body is then an array of exactly one value, so text after
    the JSON value is an error too.
    """
    text = F.col(body)
    fits = F.octet_length(text) <= MAX_BODY_BYTES
    in_brackets = F.when(fits, F.try_parse_json(F.concat(F.lit("["), text, F.lit("]"))))
    read = computed_once(
        df,
        _head=F.regexp_extract(text, _FIRST_CHARACTER, 1),
        _values=F.try_variant_get(in_brackets, "$", "array<variant>"),
    )
    value = F.when(F.size("_values") == 1, F.get("_values", F.lit(0)))
    valued = computed_once(read, _value=value, _inner=F.try_variant_get(value, "$.events", "variant"))
    is_list = F.col("_head") == "["
    is_wrapper = (F.col("_head") == "{") & F.col("_inner").isNotNull()
    elements = (
        F.when(is_list, F.try_variant_get("_value", "$", "array<variant>"))
        .when(is_wrapper & F.is_variant_null("_inner"), F.array().cast("array<variant>"))
        .when(is_wrapper, F.try_variant_get("_inner", "$", "array<variant>"))
        .when(F.col("_value").isNotNull(), F.array("_value"))
    )
    listed = computed_once(valued, _elements=elements)
    unreadable = F.coalesce(F.exists("_elements", _malformed), F.lit(True))
    error = (
        F.when(~fits, TOO_LARGE)
        .when(text.isNull() | (F.col("_head") == ""), EMPTY_BODY)
        .when(~F.col("_head").isin("[", "{"), NOT_A_CONTAINER)
        .when(unreadable, F.when(is_list, BAD_ARRAY).when(is_wrapper, BAD_EVENTS).otherwise(BAD_OBJECT))
    )
    judged = computed_once(listed, body_error=error)
    events = F.when(F.col("body_error").isNull(), F.transform("_elements", _typed))
    return computed_once(judged, events=events).drop("_head", "_values", "_value", "_inner", "_elements")


def explode_payloads(df: DataFrame, body: str = "body") -> tuple[DataFrame, DataFrame]:
    """(events, refused bodies). Events are flat, with their ``index`` in the body."""
    parsed = parse_bodies(df, body)
    keep = [c for c in df.columns if c != body]
    events = (
        parsed.filter(F.col("body_error").isNull())
        .select(*keep, F.posexplode("events").alias("index", "_event"))
        .select(*keep, "index", "_event.*")
    )
    return events, parsed.filter(F.col("body_error").isNotNull()).drop("events")
