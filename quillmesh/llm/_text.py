"""Words and lines as all operators of this subpackage see them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: ASCII white space that parts words.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def whole(text: Column) -> Column:
    """The text, with null as empty."""
    return F.coalesce(text, F.lit(""))


def words(text: Column) -> Column:
    """Array of the words of a text; null and empty texts have none."""
    return F.array_remove(F.split(whole(text), SPACE), "")


def n_words(text: Column) -> Column:
    return F.regexp_count(whole(text), F.lit(WORD)).cast("long")
