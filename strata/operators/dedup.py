"""Keep one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def placed(df: DataFrame, pk_cols: Sequence[str], tiebreak_col: str | None = None, prefer_value: str | None = None,
           order_by: Sequence[Column] | None = None, name: str = "__place") -> DataFrame:
    """``df`` with each row's place within its key, 1 for the row that ``deduplicate`` keeps."""
    preferring = [c for c in (tiebreak_col, prefer_value) if c is not None]
    if len(preferring) == 1:
        raise ValueError("a preferred value needs its column, and the other way round: tiebreak_col and prefer_value go together")
    keys = [F.col(f"`{c}`") for c in pk_cols]
    best_first = [F.col(tiebreak_col).eqNullSafe(prefer_value).desc()] if preferring else []
    best_first += list(order_by or [])
    best_first += [F.col(f"`{c}`").asc_nulls_last() for c in df.columns if c not in set(pk_cols)]
    # The hash leads the sort: text keys that share their first characters are told apart by one long.
    order = Window.partitionBy(F.xxhash64(*keys), *keys).orderBy(*(best_first or [F.lit(0)]))
    return df.select("*", F.row_number().over(order).alias(name))


def deduplicate(df: DataFrame, pk_cols: Sequence[str], tiebreak_col: str | None = None,
                prefer_value: str | None = None,
                order_by: Sequence[Column] | None = None) -> DataFrame:
    """One row per ``pk_cols``; rows with ``tiebreak_col == prefer_value`` win.

    The survivor is deterministic: after the preference come ``order_by`` and
    then every remaining column ascending (NULLs last), so equal-preference
    rows never resolve arbitrarily. NULL keys form one group, as in SQL.

    Plan: the first row of a window is planned as a partial WindowGroupLimit before
    the exchange, so each map task ships at most one row per key — a hot key
    holding a third of the input never reaches one reducer whole.
    """
    found = placed(df, pk_cols, tiebreak_col, prefer_value, order_by)
    return found.where("__place = 1").drop("__place")
