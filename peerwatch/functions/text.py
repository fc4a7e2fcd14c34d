"""Text functions, as Column expressions that stay inside generated code."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trimmed(c) -> Column:
    """``trim`` of any column as text: blanks (not tabs) off both ends."""
    return F.trim(_col(c).cast("string"))


def squeeze_question_marks(c) -> Column:
    """A run of ``?`` becomes one ``?``."""
    return F.regexp_replace(_col(c), r"\?+", "?")


def squeeze_zeros(c) -> Column:
    """A run of ``0`` becomes one ``0``, also inside longer numbers."""
    return F.regexp_replace(_col(c), "0+", "0")


def squeeze_blanks(c) -> Column:
    """A run of blanks and tabs becomes one blank."""
    return F.regexp_replace(_col(c), "[ \t]+", " ")


def clean_text(c) -> Column:
    """Normalised message text: trim, then squeeze ``?``, ``0`` and blanks.

    The runs never touch each other's characters, so with tabs made blanks one
    matcher squeezes all three.  It can change a text only if that holds a
    double character or a tab; a byte search for those is far cheaper than a
    matcher, so most rows never reach one.
    """
    raw = _col(c).cast("string")
    text = F.trim(raw)
    has_run = (
        F.contains(raw, F.lit("??"))
        | F.contains(raw, F.lit("00"))
        | F.contains(raw, F.lit("  "))
        | F.contains(raw, F.lit("\t"))
    )
    squeezed = F.regexp_replace(F.replace(text, F.lit("\t"), F.lit(" ")), r"([?0 ])\1+", "$1")
    return F.when(has_run, squeezed).otherwise(text)


def is_filled(c) -> Column:
    """0 for NULL or the empty string, else 1; a blank text counts as filled."""
    text = _col(c).cast("string")
    return F.when(text.isNull() | (text == F.lit("")), F.lit(0)).otherwise(F.lit(1))
