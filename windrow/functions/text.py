"""Expressions on text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def words(text: Column | str) -> Column:
    """The blank-separated pieces of a text, empty ones left out. An adapter: operators take ready tokens."""
    t = F.col(text) if isinstance(text, str) else text
    return F.filter(F.split(t, " "), lambda x: x != "")


def duration_text(ms: Column | str) -> Column:
    """Milliseconds as ``1h 2m 3s``, ``2m 3s`` or ``3s``, cut to whole seconds."""
    column = F.col(ms) if isinstance(ms, str) else ms
    whole = F.floor(column / 1000).cast("bigint")
    # A unit is written if the duration reaches it, the smallest always; each counts up to the next one.
    units = (("h", 3600, None), ("m", 60, 60), ("s", 1, 60))
    parts = []
    for name, size, limit in units:
        count = F.floor(whole / size)
        text = F.concat((count % limit if limit else count).cast("string"), F.lit(name))
        parts.append(text if size == 1 else F.when(whole >= size, text))
    return F.when(whole.isNotNull(), F.concat_ws(" ", *parts))
