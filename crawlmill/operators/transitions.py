"""What becomes of a page once its response is known."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlmill.constants import ERROR_STATUS
from crawlmill.functions.times import ntz


def page_state(status: Column) -> Column:
    """``ok``, ``error``, or NULL if there was no response."""
    return F.when(status >= ERROR_STATUS, "error").when(status.isNotNull(), "ok")


def page_transitions(responses: DataFrame, final_dequeue: bool = False) -> DataFrame:
    """Add the new page values to ``responses``.

    Input: ``old_type, old_status, status, has_body, is_dup``. Result columns:

    - ``page_type_code``, ``http_status_code``: the new values of the page,
    - ``requeue``: whether the page is queued again,
    - ``store_content``: whether body and hash are stored and links are followed.

    No response leaves the page as it is and queues it again. The first error queues it
    again, an error after an earlier status ends it. ``final_dequeue`` gives the effect
    of a loop that removes each processed page from the queue afterwards in any case.
    """
    state = page_state(F.col("status"))
    failed_before = F.coalesce(F.col("old_status"), F.lit(0)) != 0
    body = F.coalesce(F.col("has_body"), F.lit(False))
    duplicate = F.coalesce(F.col("is_dup"), F.lit(False))
    code = (
        F.when(state.isNull(), F.col("old_type"))
        .when((state == "error") & ~failed_before, "FRONTIER")
        .when(state == "error", "HTML")
        .when(~body, "HTML")
        .when(duplicate, "DUPLICATE")
        .otherwise("HTML")
    )
    again = F.lit(False) if final_dequeue else (
        state.isNull() | ((state == "error") & ~failed_before)
    )
    return responses.withColumns({
        "page_type_code": code,
        "http_status_code": F.coalesce(F.col("status"), F.col("old_status")),
        "requeue": F.coalesce(again, F.lit(False)),
        "store_content": F.coalesce((state == "ok") & body & ~duplicate, F.lit(False)),
    })


def forbid(decisions: DataFrame, as_of: datetime) -> DataFrame:
    """Page values of forbidden pages: type FORBIDDEN, no status, accessed now.

    The same rows tell which pages leave the frontier (``frontier.remove``).
    """
    return decisions.where(F.col("decision") == "FORBIDDEN").select(
        "page_id",
        F.lit("FORBIDDEN").alias("page_type_code"),
        F.lit(None).cast("int").alias("http_status_code"),
        ntz(as_of).alias("accessed_time"),
    )
