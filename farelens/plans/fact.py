"""Raw trips -> fact table (the transform step, P1-P19 and F7)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from farelens.functions.features import add_features
from farelens.operators.quality import quality_filter
from farelens.schema import FACT_COLUMNS


def build_fact(raw: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Featured, quality-filtered trips with the 23 fact columns in order.

    ``keep`` names extra raw columns to carry along (for example a test key).
    """
    clean = quality_filter(add_features(raw))
    return clean.select(*(keep or []), *FACT_COLUMNS)
