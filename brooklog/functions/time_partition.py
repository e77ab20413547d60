"""Parsers that give a message its time partition."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def json_time(path: str, pattern: str = "yyyy/MM/dd") -> Callable[[Column], Column]:
    """Format the timestamp found at a JSON path of the message."""

    def parse(message: Column) -> Column:
        found = F.get_json_object(message, path)
        return F.date_format(found.try_cast("timestamp_ntz"), pattern)

    return parse


def column_time(column: str, pattern: str = "yyyy/MM/dd") -> Callable[[Column], Column]:
    """Format a timestamp column of the record; the message is not looked at."""

    def parse(_message: Column) -> Column:
        return F.date_format(F.col(column), pattern)

    return parse


def series_time(parse_many: Callable[[pd.Series], pd.Series]) -> Callable[[Column], Column]:
    """Use a Python function of many message texts at once, in Arrow batches."""

    def parse(messages: pd.Series) -> pd.Series:
        return parse_many(messages)

    return F.pandas_udf(parse, "string")


def python_time(parse_one: Callable[[str | None], str | None]) -> Callable[[Column], Column]:
    """Use a Python function of one message text, called for each; ``series_time`` is faster."""
    return series_time(lambda messages: messages.map(parse_one))
