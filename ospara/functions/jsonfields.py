"""Fields of JSON payloads whose shape moves between record types."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def text_or_value(payload: str, field: str) -> Column:
    """A field that is a string in some records and ``{"value": ..}`` in others."""
    nested = F.get_json_object(payload, f"$.{field}.value")
    plain = F.get_json_object(payload, f"$.{field}")
    return F.when(F.startswith(F.ltrim(plain), F.lit("{")), nested).otherwise(plain)


def analysis_text(payload: str) -> Column:
    """The words of an incident record that describe it, joined by blanks."""
    parts = [
        F.get_json_object(payload, "$.properties.error.message"),
        text_or_value(payload, "operationName"),
        text_or_value(payload, "status"),
        F.get_json_object(payload, "$.category"),
    ]
    return F.concat_ws(" ", *[F.nullif(p, F.lit("")) for p in parts])


def environment(payload: str) -> Column:
    """Environment of a record, looked for in four places; may be NULL."""
    resource = F.get_json_object(payload, "$.resourceId")

    def named(name: str) -> Column:
        return resource.contains(f"{name}-") | resource.contains(f"/{name}/")

    places = [
        F.get_json_object(payload, "$.properties.environment"),
        F.get_json_object(payload, "$.properties.env"),
        F.get_json_object(payload, "$.tags.Environment"),
    ]
    by_resource = F.when(named("prod"), "prod").when(named("uat"), "uat").when(named("dev"), "dev")
    return F.coalesce(*[F.nullif(p, F.lit("")) for p in places], by_resource)
