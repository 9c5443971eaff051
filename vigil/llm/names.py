"""Tables with any column names: for the time of a step, columns that it does not know have plain names."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame

#: The columns that steps over documents use.
KNOWN = ("doc_id", "text", "lang")


def any_names(step: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """A step that gives back the columns of its table in their order, whatever else these are called."""

    @functools.wraps(step)
    def renamed(docs: DataFrame, *args, **options) -> DataFrame:
        plain = [c if c in KNOWN else f"other{i}" for i, c in enumerate(docs.columns)]
        return step(docs.toDF(*plain), *args, **options).toDF(*docs.columns)

    return renamed
