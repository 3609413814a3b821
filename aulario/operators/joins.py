"""Joins: size-checked lookups, null-safe matching, value-set transfer."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aulario.sources.stages import stage

# A lookup side is broadcast only when it is known to hold no more rows than this (or, for
# rows that hold lists, no more entries in all). A row or entry is a short text and a number
# or two, so the bound is some tens of megabytes.
BROADCAST_ROWS = 200_000
# Up to this size a lookup is repeated once per salt; a larger one would cost more to repeat
# than a hot key costs, and adaptive execution splits the hot partitions instead.
SALTED_ROWS = 5_000_000
SALTS = 32


def fits_broadcast(small: DataFrame, rows: int = BROADCAST_ROWS, entries: Column | None = None) -> bool:
    """Whether a lookup side has at most ``rows`` rows, or ``entries`` summed over its rows.

    Counted where the rows lie: a number per task reaches the driver.
    """
    if entries is None:
        return small.count() <= rows
    return (small.agg(F.sum(entries)).first()[0] or 0) <= rows


def join_lookup(
    big: DataFrame,
    small: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    rows: int = BROADCAST_ROWS,
    entries: Column | None = None,
) -> DataFrame:
    """Join a large table to a lookup with at most one row per key.

    Broadcast when the size check passes. Beyond it, both sides are shuffled on the keys plus
    a salt: each lookup row is repeated once per salt and each large row takes one salt, so a
    key holding a large part of the table is spread over that many tasks. A very large lookup
    is joined on the keys alone, which leaves hot keys to adaptive skew splitting. Both ask for a
    merge join: Spark guesses the size of the repeated rows from the file, and would broadcast
    tens of millions of them through the driver where the file is compact. The lookup
    is computed for the check and again for the join, so one that costs more than a scan is
    better written first (see ``stage``).
    """
    keys = list(keys)
    count = None if entries is not None else small.count()
    if fits_broadcast(small, rows, entries) if count is None else count <= rows:
        return big.join(F.broadcast(small), keys, how)
    if (small.count() if count is None else count) > SALTED_ROWS:
        return big.join(small.hint("merge"), keys, how)
    # Maps cannot be hashed; any other column that tells rows of one key apart will do.
    others = [c for c, kind in big.dtypes if c not in keys and "map<" not in kind]
    salted = big.withColumn("_salt", F.pmod(F.xxhash64(*(others or keys)), F.lit(SALTS)))
    spread = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)).cast("array<bigint>")))
    return salted.join(spread.hint("merge"), [*keys, "_salt"], how).drop("_salt")


def join_null_safe(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner", spread: bool = True
) -> DataFrame:
    """Equi-join in which a null key matches a null key (``inner`` or ``left``).

    SQL equality would drop such rows. The right side's key columns are not repeated.
    Duplicate ids fan out; adaptive skew splitting applies, as the condition stays an
    equi-join. Rows with a null key, which may be a large part of a table, are spread: the
    right side's are repeated once per salt and each of the left side's takes one. ``spread=False`` leaves
    that out, for sides that hold few rows per key or none without one.
    """
    keys = list(keys)
    if not spread:
        plain = right.select(*[F.col(f"`{c}`").alias(f"_r_{c}") if c in keys else F.col(f"`{c}`") for c in right.columns])
        matches = F.lit(True)
        for key in keys:
            matches = matches & left[key].eqNullSafe(plain[f"_r_{key}"])
        return left.join(plain, matches, how).drop(*[f"_r_{k}" for k in keys])

    def incomplete(df: DataFrame) -> Column:
        found = F.lit(False)
        for key in keys:
            found = found | df[key].isNull()
        return found

    hashed = [left[c] for c, kind in left.dtypes if "map<" not in kind]
    salt = F.when(incomplete(left), F.pmod(F.xxhash64(*hashed), F.lit(SALTS))).otherwise(F.lit(0).cast("bigint"))
    one = F.array(F.lit(0).cast("bigint"))
    salts = F.when(incomplete(right), F.sequence(F.lit(0), F.lit(SALTS - 1)).cast("array<bigint>")).otherwise(one)
    renamed = right.select(
        *[F.col(f"`{c}`").alias(f"_r_{c}") if c in keys else F.col(f"`{c}`") for c in right.columns],
        F.explode(salts).alias("_r_salt"),
    )
    salted = left.withColumn("_l_salt", salt)
    condition = salted["_l_salt"] == renamed["_r_salt"]
    for key in keys:
        condition = condition & salted[key].eqNullSafe(renamed[f"_r_{key}"])
    return salted.join(renamed, condition, how).drop("_l_salt", "_r_salt", *[f"_r_{k}" for k in keys])


def with_equivalence(df: DataFrame, table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join to an equivalence table; rows without a counterpart keep null text.

    The table's text is trimmed and rows without a complete key are left out first. Several
    texts for one key fan out, as in any left join.
    """
    clean = table.select(
        *[F.trim(F.col(c).cast("string")).alias(c) for c in table.columns]
    ).dropna(subset=list(keys))
    return join_lookup(df, clean, keys, "left")


def keep_values_of(df: DataFrame, column: str, source: DataFrame, source_column: str) -> DataFrame:
    """Rows whose value occurs among another table's values (a filter moved across tables)."""
    values = source.select(F.col(source_column).alias(column)).distinct()
    return df.join(values, column, "left_semi")


def group_total_back(
    df: DataFrame, keys: Sequence[str], column: str, name: str, skip_null_keys: bool = True
) -> DataFrame:
    """Sum per group, joined back to the detail rows.

    Rows with a null in the keys get a null total, since such groups are dropped first. The
    totals are pre-aggregated before they meet the detail, so one large group costs one
    partial sum per task and no sorting of the detail by group. The totals are written once,
    as both the size check and the join read them.
    """
    base = df.dropna(subset=list(keys)) if skip_null_keys else df
    totals = stage(base.groupBy(*keys).agg(F.sum(column).alias(name)), "totals")
    return join_lookup(df, totals, keys, "left")
