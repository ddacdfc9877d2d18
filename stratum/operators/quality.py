"""Key and null checks (the declared tests of the silver tables) and the
column-set check done before a staging overwrite.

Each check returns the failing rows as a DataFrame, so it runs distributed and
only its (usually empty) result is looked at; ``assert_*`` helpers raise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def not_null_failures(df: DataFrame, column: str) -> DataFrame:
    """Rows whose ``column`` is NULL."""
    return df.where(F.col(column).isNull())


def unique_failures(df: DataFrame, columns: list[str] | str) -> DataFrame:
    """Key values (non-null) that occur more than once, with their count.

    A partial aggregate: map tasks count their share of a hot key before the
    shuffle, so skew costs nothing extra.
    """
    cols = [columns] if isinstance(columns, str) else list(columns)
    nonnull = df
    for c in cols:
        nonnull = nonnull.where(F.col(c).isNotNull())
    return (nonnull.groupBy(*cols).agg(F.count(F.lit(1)).alias("n_rows"))
            .where(F.col("n_rows") > 1))


def key_violations(df: DataFrame, key: list[str], not_null: list[str] | None = None) -> dict:
    """Counts of NULL values in key / not-null columns and whether a non-null
    key occurs twice, from one grouped aggregate (partial counts per key
    map-side, then one small global aggregate)."""
    extra = [c for c in dict.fromkeys(not_null or []) if c not in key]
    per_key = df.groupBy(*key).agg(
        F.count(F.lit(1)).alias("__n"),
        *[F.count(F.when(F.col(c).isNull(), 1)).alias(f"__null_{c}") for c in extra])
    key_null = F.lit(False)
    for k in key:
        key_null = key_null | F.col(k).isNull()
    row = per_key.agg(
        F.max(F.when(~key_null, F.col("__n"))).alias("__max_n"),
        *[F.coalesce(F.sum(F.when(F.col(k).isNull(), F.col("__n"))), F.lit(0)).alias(k) for k in key],
        *[F.coalesce(F.sum(f"__null_{c}"), F.lit(0)).alias(c) for c in extra]).first()
    cols = list(key) + extra
    return {"nulls": {c: int(row[c]) for c in cols},
            "duplicate_keys": bool(row["__max_n"] is not None and row["__max_n"] > 1)}


def assert_key(df: DataFrame, key: list[str], not_null: list[str] | None = None,
               name: str = "table") -> None:
    """Raise like a PRIMARY KEY / NOT NULL constraint would on write."""
    v = key_violations(df, key, not_null)
    bad = {c: n for c, n in v["nulls"].items() if n}
    if bad or v["duplicate_keys"]:
        raise ValueError(f"Constraint violation in {name}: null counts {bad or 'none'}, "
                         f"duplicate key {key if v['duplicate_keys'] else 'none'}")


def column_mismatch(frame_columns: list[str], table_columns: list[str],
                    ignore: tuple[str, ...] = ("loaded_at",)) -> tuple[list[str], list[str]]:
    """Sorted lists of the columns that the frame lacks and that only it has."""
    frame, table = set(frame_columns), set(table_columns)
    return sorted(table - frame - set(ignore)), sorted(frame - table)


def assert_same_columns(frame_columns: list[str], table_columns: list[str],
                        target_name: str = "table", ignore: tuple[str, ...] = ("loaded_at",)) -> None:
    lacking, unknown = column_mismatch(frame_columns, table_columns, ignore)
    problems = [f"{word} {', '.join(cols)}" for word, cols in (("lacks", lacking), ("has unknown", unknown)) if cols]
    if problems:
        raise ValueError(f"frame for {target_name} {' and '.join(problems)}")


def declared_tests(tables: dict[str, DataFrame], tests: list[tuple[str, str, str]]) -> DataFrame:
    """Run declared column tests and report failures: one row per test with
    (table_name, column_name, test, failures).

    ``tests`` holds (table, column, "not_null" | "unique").  The not_null columns of
    a table are counted in one scan of them, without a row per value; a unique column
    is counted by value (combined map-side), its nulls among them.
    """
    kinds = {kind for _, _, kind in tests}
    if kinds - {"not_null", "unique"}:
        raise ValueError(f"unknown tests {sorted(kinds - {'not_null', 'unique'})}")
    unique = {(t, c) for t, c, kind in tests if kind == "unique"}
    counts = None
    for table in dict.fromkeys(t for t, _, _ in tests):
        columns = list(dict.fromkeys(c for t, c, _ in tests if t == table))
        parts = []
        for c in (c for c in columns if (table, c) in unique):
            by_value = tables[table].groupBy(F.col(c).cast("string").alias("v")).agg(F.count(F.lit(1)).alias("n"))
            parts.append(by_value.agg(
                F.sum(F.when(F.col("v").isNull(), F.col("n"))).alias("not_null"),
                F.sum(F.when(F.col("v").isNotNull() & (F.col("n") > 1), F.col("n"))).alias("unique"))
                .select(F.lit(c).alias("column_name"), "not_null", "unique"))
        plain = [c for c in columns if (table, c) not in unique]
        if plain:
            nulls = tables[table].agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(f"n{i}") for i, c in enumerate(plain)])
            parts.append(nulls.select(F.explode(F.array(*[
                F.struct(F.lit(c).alias("column_name"), F.col(f"n{i}").alias("not_null"), F.lit(0).cast("long").alias("unique"))
                for i, c in enumerate(plain)])).alias("x")).select("x.*"))
        for part in parts:
            part = part.select(F.lit(table).alias("table_name"), "*")
            counts = part if counts is None else counts.unionByName(part)
    declared = counts.sparkSession.createDataFrame(tests, "table_name string, column_name string, test string")
    failures = F.when(F.col("test") == "unique", F.col("unique")).otherwise(F.col("not_null"))
    return declared.join(counts, ["table_name", "column_name"], "left").select(
        "table_name", "column_name", "test", F.coalesce(failures, F.lit(0)).cast("long").alias("failures"))
