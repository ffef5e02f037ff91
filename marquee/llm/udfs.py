"""Pandas functions on columns, made into Spark functions when they are called, not on import."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column
from pyspark.sql import functions as F


def batch_udf(returns: str, *, once: bool = False) -> Callable:
    """As ``pandas_udf`` with a DDL type, but importable where no session exists yet.

    With ``once`` the optimizer may not repeat it, as it does for a filter on its result that it moves below.
    """

    def wrap(function: Callable) -> Callable[..., Column]:
        @wraps(function)
        def call(*columns) -> Column:
            made = F.pandas_udf(function, returns)
            return (made.asNondeterministic() if once else made)(*columns)

        return call

    return wrap
