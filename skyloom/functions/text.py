"""String expressions with the semantics that file names and label lines need."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_WHITE = " \t\n\r\x0b\x0c"


def strip(value: Column) -> Column:
    """Both ends without any ASCII white space (trim() takes blanks only)."""
    return F.btrim(value, F.lit(_WHITE))


def stem(name: Column) -> Column:
    """A file name without its folder and last suffix, stripped."""
    return strip(F.regexp_replace(F.regexp_replace(name, r"^.*/", ""), r"^(.+)\.[^.]+$", "$1"))


def match_key(name: Column) -> Column:
    """The key that joins tiles, parents and cameras (P11): base name, lower case, stripped."""
    return F.lower(strip(F.regexp_replace(F.regexp_replace(name, r"^.*/", ""), r"^(.+)\.[^./]+$", "$1")))


def fill_colour(name: Column) -> Column:
    """# and the first six hex digits of the name's MD5."""
    return F.concat(F.lit("#"), F.substring(F.md5(name.cast("binary")), 1, 6))


def chance(key: Column) -> Column:
    """A number in [0, 1) that depends on nothing but the key."""
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def share(part: Column, whole: Column) -> Column:
    """Percent with an empty whole counted as 1."""
    return part * 100.0 / F.greatest(F.lit(1), whole)
