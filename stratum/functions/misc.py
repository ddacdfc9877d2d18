"""Small scalar helpers: numbers in names, last element, display formats."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def number_in_name(name: Column | str, prefix: str) -> Column:
    """The number of a batch folder or page file: ``prefix_N`` -> N (int).

    ``name`` is a path, a folder name or a file name.  A page number is taken
    from the file's stem (``page_3.json``), a batch number from the folder that
    holds the file (``batch_12/page_3.json``); the same words further up in the
    path mean nothing.  Folders as Spark writes them (``batch_id=N/page=P/...``)
    are read too.  NULL when absent."""
    c = F.col(name) if isinstance(name, str) else name
    bare = rf"{prefix}_(\d+)(?:\.[^/]*)?"
    folder = rf"{prefix}_(\d+)/[^/]*\.[^/]*" if prefix != "page" else r"(?!)()"
    written = rf"{prefix}(?:_id)?=(\d+)(?:/page=\d+)?(?:/[^/]*)?"
    found = [F.nullif(F.regexp_extract(c, rf"(?:^|/){p}$", 1), F.lit("")) for p in (bare, folder, written)]
    return F.coalesce(*found).try_cast("int")


def last_element(arr: Column | str) -> Column:
    """Last element of an array, NULL for an empty or NULL array."""
    a = F.col(arr) if isinstance(arr, str) else arr
    return F.when(F.size(a) > 0, F.element_at(a, -1))


def fmt_2dp(c: Column | str) -> Column:
    """``{:.2f}`` (no thousands separator)."""
    x = F.col(c) if isinstance(c, str) else c
    return F.format_string("%.2f", x)


def fmt_thousands(c: Column | str) -> Column:
    """``{:,}`` for integers: 1234567 -> '1,234,567'."""
    x = F.col(c) if isinstance(c, str) else c
    return F.format_number(x, 0)
