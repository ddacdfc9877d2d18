"""Keep-last de-duplication by key.

"Last" is decided by explicit order columns (for the silver stage: the raw row
id, then the record's position in its page, then the position inside a link
array), never by physical row order, so the result is deterministic.

Written as an aggregate (``max_by``) rather than ``row_number() over (partition
by key)``: a key that holds a third of all rows is reduced inside every map task
before the shuffle instead of being sorted in one task.  Spark runs ``max_by``
over structs as a sort aggregate, so rows are sorted by key on both sides of the
shuffle; that is the price for not meeting a hot key in one place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keep_last(df: DataFrame, keys: list[str], order: list[str | Column],
              drop_order: bool = False) -> DataFrame:
    """One row per distinct ``keys`` value: the row greatest in ``order``.

    Null key values form their own group (as in a keep-last ``unique``).
    With ``drop_order`` the order columns (given by name) are left out.
    """
    order_cols = [F.col(c) if isinstance(c, str) else c for c in order]
    order_names = {c for c in order if isinstance(c, str)}
    payload = [c for c in df.columns if c not in keys and not (drop_order and c in order_names)]
    out_cols = [c for c in df.columns if c in keys or c in payload]
    if not payload:
        return df.select(*keys).distinct()
    last = F.max_by(F.struct(*payload), F.struct(*order_cols)).alias("__last")
    return (df.groupBy(*keys).agg(last)
            .select(*keys, *[F.col(f"__last.{c}").alias(c) for c in payload])
            .select(*out_cols))
