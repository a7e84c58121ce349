"""Content hashes over canonical JSON."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def canonical_json(json: Column) -> Column:
    """JSON text with keys in order at every level and numbers in one form; null for what is no JSON."""
    return F.to_json(F.try_parse_json(json))


def content_sha256(*fields: Column) -> Column:
    """SHA-256 of the fields as a JSON object in the order given; null fields are left out."""
    return F.sha2(F.to_json(F.struct(*fields)), 256)
