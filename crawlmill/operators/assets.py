"""Rows for linked documents and images."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlmill import constants as C
from crawlmill.functions.times import ntz
from crawlmill.operators.links import DOCUMENT, PICTURE
from crawlmill.operators.store import Payloads


def _with_refs(rows: DataFrame, files: Payloads | None) -> DataFrame:
    """Add the digest and size of the file behind each URL.

    Rows refer to a payload by its digest and never carry it. Without ``files`` the reference is NULL. A
    file that is missing there failed to load, and its row is lost.
    """
    if files is None:
        return rows.withColumns({
            "digest": F.lit(None).cast("string"), "n_bytes": F.lit(None).cast("long"), "is_cut": F.lit(False)
        })
    return rows.join(files.refs, "url")


def document_rows(links: DataFrame, files: Payloads | None = None) -> DataFrame:
    """``page_data`` rows: the type is the upper-cased text after the last dot.

    Types without a code (for instance PDFX) are rejected by the code table.
    """
    rows = links.where(F.col("cls") == DOCUMENT).select(
        "page_id", "url", F.upper(F.substring_index("url", ".", -1)).alias("data_type_code")
    ).where(F.col("data_type_code").isin(*C.DATA_TYPES))
    return _with_refs(rows, files)


def image_rows(links: DataFrame, as_of: datetime, files: Payloads | None = None) -> DataFrame:
    """``image`` rows: the file name is the URL before the last dot, without dots.

    Names that are too long for a table are the business of the writer, which returns them.
    """
    name = F.replace(
        F.regexp_extract("url", r"^(.*)\.[^.]*$", 1), F.lit("."), F.lit("")
    )
    rows = links.where(F.col("cls") == PICTURE).select(
        "page_id", "url", name.alias("filename"),
        F.lower(F.substring_index("url", ".", -1)).alias("content_type"),
        ntz(as_of).alias("accessed_time"),
    ).where(F.col("content_type").isin(*C.STORED_IMAGE_TYPES))
    return _with_refs(rows, files)
