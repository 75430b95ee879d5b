"""Named relations for SQL text."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame


def register_views(frames: Mapping[str, DataFrame], prefix: str = "") -> None:
    """Make each frame a temp view of its own session."""
    for name, df in frames.items():
        df.createOrReplaceTempView(prefix + name)
