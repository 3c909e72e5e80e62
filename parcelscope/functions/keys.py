"""Surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def surrogate_key(*parts: Column, sep: str = "") -> Column:
    """MD5 of the natural key as lower-case hex; null if any part is null.

    With the default empty separator ('1', 11) and ('11', 1) get the same key, which is safe only
    for fixed-width ids. Pass ``sep`` where ids vary in length and the key must be unique.
    """
    texts = [p.cast("string") for p in parts]
    if not sep:
        return F.md5(F.concat(*texts))
    spaced = [texts[0]]
    for text in texts[1:]:
        spaced += [F.lit(sep), text]
    return F.md5(F.concat(*spaced))
