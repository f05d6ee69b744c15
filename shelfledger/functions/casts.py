"""Casts that give NULL instead of raising, whatever the ANSI setting."""

from pyspark.sql import Column
from pyspark.sql import functions as F

_INTEGRAL = {"tinyint", "byte", "smallint", "short", "int", "integer", "bigint", "long"}


def lenient_cast(text: Column, type_name: str) -> Column:
    """Text to ``type_name``; a whole number written with decimals ("12.0") still counts as
    an integer, as it does in a non-ANSI cast."""
    plain = text.try_cast(type_name)
    if type_name.lower() not in _INTEGRAL:
        return plain
    whole = F.regexp_extract(F.trim(text), r"^([+-]?[0-9]*)\.[0-9]*$", 1).try_cast(type_name)
    return F.coalesce(plain, whole)
