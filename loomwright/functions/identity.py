"""Identity of a teacher record."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def identity(windows: bool = False) -> Column:
    """doc|place|stage|teacher|mode; the place is chunk:<index>, or bytes:<start>-<end> where there is no index.

    windows: also the bounds of the selected window, so that windows of one chunk are records of their own.
    """
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    place = F.when(F.col("chunk_index").isNotNull(), F.concat(F.lit("chunk:"), text("chunk_index"))).otherwise(F.concat(F.lit("bytes:"), text("byte_start"), F.lit("-"), text("byte_end")))
    parts = [text("doc_id"), place, text("stage_name"), text("teacher_name"), text("mode")]
    if windows:
        parts += [text("selected_window_start"), text("selected_window_end")]
    return F.concat_ws("|", *parts)


def signature(windows: bool = False) -> Column:
    return F.sha2(identity(windows), 256)
