"""Spelling rules for keys, units, hashes and titles, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The characters that Unicode calls white space.
SPACES = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0 " + "".join(map(chr, range(0x2000, 0x200B))) + "    　"


def clean(c: Column | str) -> Column:
    """A key or unit in its one spelling: without white space at both ends, in lower case."""
    return F.lower(F.btrim(F.col(c) if isinstance(c, str) else c, F.lit(SPACES)))


def sha256_of(c: Column | str) -> Column:
    """The 64 hexadecimal digits of a SHA-256 value however it is spelled (case, spaces, a prefix such as ``sha256:``);
    what holds no 64 digits is its own cleaned text."""
    lowered = clean(c)
    digits = F.regexp_extract(lowered, "([0-9a-f]{64})$", 1)
    return F.when(digits != "", digits).otherwise(lowered)
