"""Text clean-up as built-in column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A run of tags, named or decimal entities and white space. Tags and entities
# hold no white space at their ends, so replacing a whole run by one blank
# equals replacing each piece by a blank and collapsing the blanks afterwards;
# one pass over the text does it. The quantifiers are possessive: nothing is
# retried, and long runs need no deep matcher stack.
MARKUP_RUN = r"(?:<[^>]*+>|&(?:[a-zA-Z]++|#[0-9]++);|\s++)++"

# Fixed value: the form of an enumeration prefix, as in ``_7_COMPLETED``.
ENUM_PREFIX = r"^_\d+_"


def strip_html(text: Column) -> Column:
    """Remove tags and entities (not decoded), collapse white space, trim.

    Hexadecimal entities such as ``&#x27;`` stay.
    """
    return F.trim(F.regexp_replace(text, MARKUP_RUN, " "))


def strip_enum_prefix(text: Column) -> Column:
    """``_7_COMPLETED`` to ``COMPLETED``; text without the prefix is unchanged."""
    return F.regexp_replace(text, ENUM_PREFIX, "")
