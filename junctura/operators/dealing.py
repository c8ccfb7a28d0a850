"""How rows are dealt to tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame


def dealt(d: DataFrame, parts: int | None, *by: str) -> DataFrame:
    """``d`` dealt by its columns ``by`` into ``parts``, which a caller makes as many as the rows need; for None Spark deals it where an operator asks for it.

    A join with rows dealt like this deals its other side into as many parts, and groupings and windows by ``by`` or more need no other exchange.
    """
    return d if parts is None else d.repartition(parts, *by)
