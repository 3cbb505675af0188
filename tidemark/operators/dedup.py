"""One row per key: latest wins (W1) or first wins (A5).

Written as a grouped ``max_by`` / ``min_by`` of the whole row ordered by
``(stamp present, stamp, tiebreak)``. An aggregate always gets a map-side
partial step before its shuffle -- also when adaptive execution splits a
skewed join below it and has to insert the exchange itself -- so a key that
holds a third of all rows costs one row per map task in the exchange, never a
third of the data in one task. The pick equals ``qualify row_number() over
(partition by key order by stamp desc nulls last, tiebreak desc) = 1``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _as_list(x) -> list[str]:
    if x is None:
        return []
    return [x] if isinstance(x, str) else list(x)


def _rank(order: list[str], ties: list[str], nulls_high: bool) -> Column:
    """Struct compared field by field; a NULL-ness flag before each stamp ranks NULL stamps above
    (``nulls_high``) or below every value."""
    parts = []
    for c in order:
        flag = F.col(c).isNull() if nulls_high else F.col(c).isNotNull()
        parts += [flag, F.col(c)]
    parts += [F.col(c) for c in ties]
    return F.struct(*[p.alias(f"r{i}") for i, p in enumerate(parts)])


def latest_per_key(df: DataFrame, keys: str | list[str], order_by: str | list[str],
                   tiebreak: str | list[str] | None = None, nulls_first: bool = False) -> DataFrame:
    """Keep the row with the greatest ``order_by`` per key.

    NULL stamps lose by default, so an unstamped row never wins; set
    ``nulls_first=True`` to reproduce engines that treat NULL as largest.
    ``tiebreak`` makes the pick among equal stamps deterministic (highest wins).
    """
    return _top1(df, _as_list(keys), _as_list(order_by), _as_list(tiebreak), F.max_by, nulls_first)


def first_per_key(df: DataFrame, keys: str | list[str], order_by: str | list[str],
                  tiebreak: str | list[str] | None = None) -> DataFrame:
    """Keep the earliest row per key (first-ever row wins), lowest tiebreak on equal stamps,
    NULL stamps last."""
    return _top1(df, _as_list(keys), _as_list(order_by), _as_list(tiebreak), F.min_by, True)


def _top1(df: DataFrame, keys, order, ties, pick, nulls_high: bool) -> DataFrame:
    # ``nulls_high``: NULL stamps rank above every value (win under max_by, lose under min_by)
    rest = [c for c in df.columns if c not in keys]
    row = F.struct(*[F.col(c) for c in rest])
    best = df.groupBy(*keys).agg(pick(row, _rank(order, ties, nulls_high)).alias("__best"))
    return best.select(*keys, *[F.col("__best")[c].alias(c) for c in rest]).select(*df.columns)
