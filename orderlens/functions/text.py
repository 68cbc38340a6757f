"""Text cleaning. Two trims exist because two kinds of input rules do."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Everything up to and including the space: tabs, line ends, other control characters.
BLANKS = "".join(map(chr, range(0x21)))


def trim_blanks(c: Column) -> Column:
    """Control characters and spaces trimmed from both ends.

    The wide trim looks every character up in its list, so it is kept for texts
    that still start or end with a control character once spaces are gone.
    """
    text = F.trim(c)
    odd_end = (text < " ") | (F.substring(text, -1, 1) < " ")
    return F.when(odd_end, F.btrim(text, F.lit(BLANKS))).otherwise(text)


def key_text(c: Column) -> Column:
    """Grouping-key form: control characters and spaces trimmed, upper case, NULL as ''."""
    return F.coalesce(F.upper(trim_blanks(c)), F.lit(""))


def label_text(c: Column) -> Column:
    """Category form: spaces trimmed, upper case, NULL kept."""
    return F.upper(F.trim(c))


def trimmed(c: Column) -> Column:
    """Spaces trimmed, case and NULL kept."""
    return F.trim(c)


def is_present(c: Column) -> Column:
    """True for text with at least one character; false, never NULL, otherwise."""
    return F.coalesce(F.length(c) > 0, F.lit(False))
