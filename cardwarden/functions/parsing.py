"""Text to typed value; anything unreadable becomes null instead of an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cardwarden.config import TRUE_TOKENS, YEAR_FIRST_DATE, YEAR_LAST_DATE


def parse_date(text: Column) -> Column:
    """Timestamp without zone of a date in one of the accepted layouts.

    Year-last dates are rewritten year first, month before day unless only the other order exists.
    Casting that text is several times faster than a formatter per layout, and knows no time zone.
    """

    def rewritten(order: str) -> Column:
        dated = F.regexp_replace(text, YEAR_LAST_DATE, order)
        seconds = F.when(F.contains(text, F.lit(":")), ":00").otherwise("")
        return F.concat(dated, seconds).try_cast("timestamp_ntz")

    return F.when(
        F.contains(text, F.lit("/")), F.coalesce(rewritten("$3-$1-$2$4"), rewritten("$3-$2-$1$4"))
    ).when(text.rlike(YEAR_FIRST_DATE), text.try_cast("timestamp_ntz"))


def parse_money(text: Column) -> Column:
    """``"$1,234.50"`` to 1234.5: currency sign, thousands commas and outer blanks dropped."""
    nothing = F.lit("")
    digits = F.trim(F.replace(F.replace(text.cast("string"), F.lit("$"), nothing), F.lit(","), nothing))
    # A trailing d or f would be taken for a Java number suffix.
    return F.when(~F.right(digits, F.lit(1)).isin("d", "D", "f", "F"), digits.try_cast("double"))


def parse_flag(value: Column) -> Column:
    """True for YES/TRUE/1 in any case, null stays null; blanks are significant."""
    return F.upper(value.cast("string")).isin(*TRUE_TOKENS)


def mcc_key(code: Column) -> Column:
    """Join key of a category code: ``"0742"`` and ``742`` are the same code."""
    text = code.cast("string")
    return F.coalesce(F.trim(text).try_cast("bigint").cast("string"), text)
