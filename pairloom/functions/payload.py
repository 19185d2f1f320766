"""Request and response documents of a text-generation service."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

RESPONSE_SCHEMA = "predictions array<struct<candidates: array<struct<text: string>>>>"


@dataclass(frozen=True)
class GenParams:
    """Generation settings; ``max_tokens`` caps the output."""

    max_tokens: int = 100
    temperature: float = 1.0

    def column(self) -> Column:
        return F.struct(
            F.lit(self.max_tokens).alias("max_tokens"),
            F.lit(float(self.temperature)).alias("temperature"),
        )


def request_payload(prompts: Column, params: GenParams) -> Column:
    """``{"inputs": {"prompt": [...]}, "params": {...}}`` from an array of prompts."""
    return F.to_json(
        F.struct(F.struct(prompts.alias("prompt")).alias("inputs"), params.column().alias("params"))
    )


def response_payload(texts: Column) -> Column:
    """The service's answer to one request: one candidate for each text, in order."""
    candidate = F.transform(
        texts, lambda t: F.struct(F.array(F.struct(t.alias("text"))).alias("candidates"))
    )
    return F.to_json(F.struct(candidate.alias("predictions")))


def response_text(col: Column) -> Column:
    """First candidate of the first prediction; null for a malformed document."""
    return F.get_json_object(col, "$.predictions[0].candidates[0].text")


def response_texts(col: Column) -> Column:
    """First candidate of every prediction, in order, as an array."""
    return F.transform(
        F.from_json(col, RESPONSE_SCHEMA)["predictions"],
        lambda p: F.get(p["candidates"], F.lit(0))["text"],
    )
