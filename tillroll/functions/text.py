"""Text and date expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Date layouts tried in turn, per value.
DATE_FORMATS = [
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd HH:mm",
    "yyyy-MM-dd'T'HH:mm:ss",
    "yyyy-MM-dd",
    "M/d/yyyy H:mm:ss",
    "M/d/yyyy H:mm",
    "M/d/yyyy",
]

# Words of two or more letters, digits or underscores, in any script.
WORD_PATTERN = r"[\p{L}\p{N}_]{2,}"


# The Unicode white space that text stripping removes.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def sql_text(value: str) -> str:
    """``value`` as a SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def tidy_description(text: Column) -> Column:
    """Upper-case and strip all Unicode white space; null becomes ``NAN``."""
    return F.btrim(F.upper(F.coalesce(text, F.lit("nan"))), F.lit(WHITE_SPACE))


def contains_any(text: str, literals: list[str]) -> Column:
    """Case-insensitive test for any of the literal substrings.

    ``text`` is a column name or SQL expression.  It is bound once as an array element, so that the expression behind
    it is evaluated per row and not per literal; plain substring search is
    several times faster than one pattern of all literals.
    """
    tests = " OR ".join(f"contains(t, {sql_text(k.upper())})" for k in literals)
    return F.expr(f"exists(array(upper({text})), t -> {tests})")


def try_mixed_timestamp(text: Column, formats: list[str] = DATE_FORMATS) -> Column:
    """Timestamp from text that may use any of ``formats``, null where none fits."""
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(f)) for f in formats])


def parse_mixed_timestamp(text: Column, formats: list[str] = DATE_FORMATS) -> Column:
    """Timestamp from text that may use any of ``formats``.

    A null stays null; text that fits no format raises, so that bad rows are
    not lost silently.
    """
    parsed = try_mixed_timestamp(text, formats)
    complain = F.raise_error(F.concat(F.lit("unreadable date: "), text)).cast("timestamp")
    return F.when(text.isNull() | parsed.isNotNull(), parsed).otherwise(complain)


def words(text: Column) -> Column:
    """Array of the lower-cased words of ``text``."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD_PATTERN), F.lit(0))
