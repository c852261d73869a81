"""Licence of a source."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Source fragment -> licence, first match in this order wins.
SOURCE_LICENSES = {
    "fineweb-edu": "mit",
    "coco": "cc-by-4.0",
    "finevideo": "cc-by-4.0",
    "huggingfacefv": "cc-by-4.0",
    "msr-vtt": "research-only",
    "msrvtt": "research-only",
    "librispeech": "cc-by-4.0",
    "openslr": "cc-by-4.0",
}


def license_of(source: Column, own: Column | None = None) -> Column:
    """A row's own licence if present, else the one its source implies."""
    low = F.lower(source)
    matches = [
        F.when(low.contains(key), F.lit(name)) for key, name in SOURCE_LICENSES.items()
    ]
    derived = F.coalesce(*matches, F.lit("unknown"))
    return derived if own is None else F.coalesce(own, derived)
