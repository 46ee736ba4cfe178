"""Typed access to arrays of key/value structs.

Lookups use ``array_position`` on the key array rather than a lambda: it takes the first
match, never fails on repeated keys and stays inside whole-stage code generation.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.schema import FLOAT64, INT64, STRING


def param_value(params: Column, key: str) -> Column:
    """Value struct of the first entry with this key, NULL if there is none."""
    position = F.array_position(params["key"], F.lit(key))
    return F.get(params, position - 1)["value"]


def to_integer(number: Column) -> Column:
    """Floating to integer, halves away from zero; NULL if it is no number or out of range."""
    return F.round(number).try_cast("bigint")


def extracted_type(name: str, data_type: str) -> str:
    """Column type that :func:`extract_param` gives for a registered parameter."""
    return FLOAT64 if "percent" in name else data_type


def extract_param(params: Column, name: str, data_type: str) -> Column:
    """One event parameter as a column of its registered type."""
    value = param_value(params, name)
    if "percent" in name:
        return F.coalesce(value["double_value"], value["int_value"].cast("double")) / 100
    if data_type == STRING:
        return F.coalesce(
            value["string_value"],
            value["int_value"].cast("string"),
            value["double_value"].cast("string"),
        )
    if data_type == FLOAT64:
        return F.coalesce(value["double_value"], value["int_value"].cast("double"))
    return F.coalesce(value["int_value"], to_integer(value["double_value"]))


def extract_item_param(params: Column, name: str, data_type: str) -> Column:
    """One item parameter: the single field of its registered type."""
    field = {STRING: "string_value", FLOAT64: "double_value", INT64: "int_value"}[data_type]
    return param_value(params, name)[field]


def session_id(params: Column) -> Column:
    """Session number; text that is no number gives NULL instead of failing the job."""
    value = param_value(params, "ga_session_id")
    return F.coalesce(value["int_value"], value["string_value"].try_cast("bigint"))


def observed_type(value: Column) -> Column:
    """Type of an event parameter's value struct (float-only values count as STRING)."""
    return (
        F.when(value["int_value"].isNotNull(), INT64)
        .when(value["double_value"].isNotNull(), FLOAT64)
        .otherwise(STRING)
    )


def observed_item_type(value: Column) -> Column:
    """Type of an item parameter's value struct: text wins."""
    return (
        F.when(value["string_value"].isNotNull(), STRING)
        .when(value["double_value"].isNotNull(), FLOAT64)
        .when(value["int_value"].isNotNull(), INT64)
        .otherwise(STRING)
    )
