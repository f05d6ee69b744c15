"""Parts of a dropped file's path: TABLE-DDMMYYYY-SEQ.ext inside a folder named TABLE."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def file_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def folder_name(path: Column) -> Column:
    return F.substring_index(F.substring_index(path, "/", -2), "/", 1)


def stem(name: Column) -> Column:
    return F.substring_index(name, ".", 1)


def extension(name: Column) -> Column:
    return F.substring_index(name, ".", -1)


def dash_part(name: Column, position: int) -> Column:
    """Part of a name between dashes, counted from 1 or, if negative, from the end."""
    return F.try_element_at(F.split(name, "-"), F.lit(position))
