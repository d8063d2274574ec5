"""Optional size limits.

Nothing is limited unless a caller asks for it. What a limit keeps out is returned as rows with the
reason, never dropped in silence.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Limits:
    """Longest texts in characters and files in bytes; None is no limit."""

    url: int | None = None
    domain: int | None = None
    filename: int | None = None
    content_type: int | None = None
    code: int | None = None
    document_bytes: int | None = None
    image_bytes: int | None = None


NO_LIMITS = Limits()
#: What the columns of a crawl database hold, and how much of a file it takes.
COLUMN_LIMITS = Limits(
    url=3000, domain=500, filename=255, content_type=50, code=20,
    document_bytes=2_000_000, image_bytes=3_000_000,
)


def reason(texts: dict[str, tuple[Column, int | None]]) -> Column:
    """Why a row does not fit: its first text that is too long; NULL if it fits."""
    tests = [
        F.when(F.length(text) > limit, F.lit(f"{name} longer than {limit}"))
        for name, (text, limit) in texts.items() if limit is not None
    ]
    return F.coalesce(*tests, F.lit(None).cast("string"))


def fitting(df: DataFrame, texts: dict[str, tuple[Column, int | None]]) -> DataFrame:
    return df if all(limit is None for _, limit in texts.values()) else df.where(reason(texts).isNull())


def rejected(df: DataFrame, texts: dict[str, tuple[Column, int | None]]) -> DataFrame:
    """The rows that do not fit, with ``reason``."""
    return df.withColumn("reason", reason(texts)).where(F.col("reason").isNotNull())
