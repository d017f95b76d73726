"""Text to terms."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: what separates terms, the white space of Unicode and four control characters.
SEPARATOR = r"(?U)[\s\x1c-\x1f]+"


def tokenize(text: Column) -> Column:
    """Lower-case terms split at white space; an underscore counts as a space."""
    words = F.split(F.lower(F.translate(text, "_", " ")), SEPARATOR)
    return F.filter(words, lambda w: w != "")
