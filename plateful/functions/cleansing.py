"""Text to typed columns. Bad text never raises, also under ANSI mode."""

from pyspark.sql import Column, functions as F

from plateful.schemas import DATE_FORMAT, TIME_LENGTH, TIME_TEXT, TRUE_WORDS


def plain_text(column):
    """Text as loaded: an empty field stays a blank and is not NULL."""
    return F.coalesce(F.col(column), F.lit(""))


def blank_to_null(text: Column, trim: bool = False) -> Column:
    return F.nullif(F.trim(text) if trim else text, F.lit(""))


def parse_boolean(text: Column) -> Column:
    """True for the accepted words in any case; every other text and NULL is false."""
    return F.coalesce(F.lower(text).isin(*TRUE_WORDS), F.lit(False))


def parse_date(text: Column) -> Column:
    return F.try_to_date(text, DATE_FORMAT)


def parse_timestamp(text: Column) -> Column:
    """Zone-free time from the leading date and time; fraction and zone marker are cut off."""
    head = F.left(text, F.lit(TIME_LENGTH))
    return F.when(head.rlike(TIME_TEXT), head.try_cast("timestamp_ntz"))


def parse_decimal(text: Column, strict: bool = False) -> Column:
    return _number(text, text.try_cast("decimal(10,2)"), "decimal(10,2)", strict)


def parse_integer(text: Column, strict: bool = False) -> Column:
    """Whole number; a fraction is rounded half up."""
    return _number(text, text.try_cast("decimal(20,0)").try_cast("int"), "int", strict)


def _number(text, parsed, dtype, strict):
    # Lenient loads turn unreadable numbers into 0, strict ones into NULL.
    return parsed if strict else F.when(text.isNotNull(), F.coalesce(parsed, F.lit(0).cast(dtype)))
