"""Text expressions on columns."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def quote_number(text: Column, field: str, blank: str = "", closers: str = ",") -> Column:
    """Turn ``"field":1.5,`` into ``"field":"1.5",``.

    ``blank`` is the text allowed between colon and number and ``closers`` the
    characters that may follow the number. Signs and exponents do not match.
    Lines that do not mention the field are not searched.
    """
    ends = "".join(re.escape(c) for c in closers)
    # fixed value: the shape of the pattern decides which numbers match
    pattern = f'("{re.escape(field)}":{re.escape(blank)})([0-9.]+)([{ends}])'
    return F.when(
        text.contains(field), F.regexp_replace(text, pattern, '$1"$2"$3')
    ).otherwise(text)


def words(text: Column) -> Column:
    """Words between blanks or line ends; empty words stay and must be dropped."""
    return F.split(text, "[ \n]")
