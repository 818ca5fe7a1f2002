"""Encoding and decoding of message payloads."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def decode_json(payload: Column, schema: str) -> Column:
    """JSON text or bytes as a struct; fields of malformed input are null."""
    return F.from_json(payload.cast("string"), schema)


def encode_json(*columns: str) -> Column:
    """The named columns (all, if none is named) as one JSON text."""
    return F.to_json(F.struct(*columns) if columns else F.struct("*"))
