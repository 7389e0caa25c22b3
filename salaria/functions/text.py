"""Text rules of the line parsers.

* Trim removes every code point <= U+0020 at both ends (Java ``String.trim``);
  Spark's ``trim`` only strips U+0020, so ``btrim`` with an explicit set is used.
  A regex ending in ``$`` is avoided on purpose: Java's ``$`` also matches before
  a final line terminator such as U+2028.
* Split keeps empty fields (``limit=-1``) and knows no quoting.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# All code points from U+0000 to U+0020, the set Java's String.trim removes.
TRIM_CHARS = "".join(chr(cp) for cp in range(0x21))


def java_trim(col: Column) -> Column:
    """Strip code points <= U+0020 from both ends; U+00A0 and others are kept."""
    return F.btrim(col, F.lit(TRIM_CHARS))


def split_fields(col: Column, delimiter: str = ",", max_fields: int = -1) -> Column:
    """Split on a literal delimiter, keeping trailing empty fields.

    ``max_fields > 0`` stops after that many parts, the last holding the rest of
    the line (trailing empty fields are still kept); with ``expected + 1`` the
    array is at most one longer than a valid line, so a field-count check is
    unchanged and a junk line with thousands of delimiters stays cheap.
    """
    return F.split(col, re.escape(delimiter), max_fields)


def field(fields: Column, index: int) -> Column:
    """Trimmed field ``index`` (0-based) of a split line; NULL when absent.

    ``get`` is used instead of ``fields[index]`` because the latter raises under
    ANSI mode when the line has fewer fields.
    """
    return java_trim(F.get(fields, index))
