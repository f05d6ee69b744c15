"""Date parsing and date-format checks on text columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

ISO = "yyyy-MM-dd"
DAY = "yyyyMMdd"
DAY_FIRST = "ddMMyyyy"
SLASHED = "M/d/yyyy"
DAY_MONTH_NAME = "dd-MMM-yy"

# Date directives, the pattern letter Spark parses them with, and their shape.
_DIRECTIVES = {
    "Y": ("yyyy", "(?!0000)[0-9]{4}"),
    "y": ("yy", "[0-9]{2}"),
    "m": ("M", "[0-9]{1,2}"),
    "d": ("d", "[0-9]{1,2}"),
    "b": ("MMM", "[A-Za-z]{3}"),
    "B": ("MMMM", "[A-Za-z]+"),
    "H": ("H", "[0-9]{1,2}"),
    "M": ("m", "[0-9]{1,2}"),
    "S": ("s", "[0-9]{1,2}"),
}


def is_date_name(name: str) -> bool:
    return name == "DATE" or name.startswith("DATE_") or "_DATE" in name


def date_columns(names: list[str]) -> list[str]:
    return [n for n in names if is_date_name(n)]


def named_day(text: Column) -> Column:
    """Day of eight digits, as yyyyMMdd or ddMMyyyy; NULL for any other text.

    No text is a day of this century or the last one in both spellings: read the other way
    round its year would be a month.
    """
    eight = F.when(text.rlike("^[0-9]{8}$"), text)
    return F.coalesce(F.try_to_date(eight, DAY), F.try_to_date(eight, DAY_FIRST))


def file_day(text: Column) -> Column:
    """``named_day`` that stops on a text which is no day."""
    wrong = F.concat(F.lit("not a day as yyyyMMdd or ddMMyyyy: "), text)
    return F.when(text.isNull(), F.lit(None).cast("date")).otherwise(
        F.coalesce(named_day(text), F.raise_error(wrong).cast("date"))
    )


def day_text(text: Column) -> Column:
    """A day in either spelling as yyyyMMdd; any other text as it is."""
    return F.coalesce(F.date_format(named_day(text), DAY), text)


def parse_date(column: Column, data_type: T.DataType, *formats: str) -> Column:
    """Day of a date, timestamp or text column; NULL where no format fits."""
    if isinstance(data_type, T.DateType):
        return column
    if not isinstance(data_type, T.StringType):
        return column.cast("date")
    return F.coalesce(*[F.try_to_date(column, f) for f in formats])


def parse_historical_date(column: Column, data_type: T.DataType) -> Column:
    """Dashed text is year-month-day, anything else month/day/year."""
    if not isinstance(data_type, T.StringType):
        return parse_date(column, data_type)
    return F.when(column.contains("-"), F.try_to_date(column, ISO)).otherwise(
        F.try_to_date(column, SLASHED)
    )


def _translate(strptime_format: str) -> tuple[str, str]:
    pattern, shape, i = "", "", 0
    while i < len(strptime_format):
        char = strptime_format[i]
        if char == "%":
            i += 1
            letters, digits = _DIRECTIVES[strptime_format[i]]
            pattern, shape = pattern + letters, shape + digits
        else:
            pattern += f"'{char}'" if char.isalpha() else char
            shape += f"[{char}]" if char not in "^\\]" else "\\" + char
        i += 1
    return pattern, f"^{shape}$"


def matches_any_format(text: Column, formats: list[str] | tuple[str, ...]) -> Column:
    """TRUE where text is a real date in one of the strptime-style formats; never NULL."""
    checks = []
    for strptime_format in formats:
        pattern, shape = _translate(strptime_format)
        # Year-month-day is what a plain cast reads, at a third of the cost of a formatter.
        plain = pattern == "yyyy-M-d"
        day = text.try_cast("date") if plain else F.try_to_timestamp(text, F.lit(pattern))
        checks.append(text.rlike(shape) & day.isNotNull())
    result = F.lit(False)
    for check in checks:
        result = result | F.coalesce(check, F.lit(False))
    return result
