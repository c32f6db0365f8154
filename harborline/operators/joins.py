"""Joins that can be split when one key holds a large share of the rows.

AQE splits a hot key on either side of an inner join and on the preserved side of a left join.
Right and full joins leave a hot key whole: a right join is stated as parts that can be split, a full join salts
its hot keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harborline.session import cut

HOT = 1 << 20  # rows of a key on one side that one task takes


def _nulls_for(df: DataFrame, like: DataFrame, names: Sequence[str]) -> DataFrame:
    types = dict(like.dtypes)
    return df.select("*", *[F.lit(None).cast(types[c]).alias(c) for c in names if c not in df.columns])


def unmatched(rows: DataFrame, other: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key the other side lacks."""
    return rows.join(other.select(*on), list(on), "left_anti")


def join_groups(rows: DataFrame, groups: DataFrame, by: Sequence[str], how: str = "inner") -> DataFrame:
    """Rows with the columns of their group, null keys matching null keys as they do in a grouping.

    The null-safe condition also keeps Spark from pushing a not-null filter into only one of the
    uses of a shared aggregate, which would make it compute the aggregate twice.
    """
    match = F.lit(True)
    for key in by:
        match = match & F.col(key).eqNullSafe(F.col(f"_g_{key}"))
    named = groups.withColumnsRenamed({k: f"_g_{k}" for k in by})
    return rows.join(named, match, how).drop(*[f"_g_{k}" for k in by])


def right_join(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    matched = left.join(right, list(on))
    rest = _nulls_for(unmatched(right, left, on), left, left.columns)
    return matched.unionByName(rest.select(*matched.columns))


def full_join(left: DataFrame, right: DataFrame, on: Sequence[str], hot: int = HOT) -> DataFrame:
    """Full join on equal, not null keys; a key with more than ``hot`` rows on a side is dealt to several tasks.

    Rows are counted by key on both sides first. The larger side of a hot key is dealt over salts by its content, the
    other side comes once for each salt. A copy that meets nothing in its salt met something in another, as
    the larger side has rows, and is dropped. Null keys match nothing, so both sides deal them freely.
    Equal rows of one key share a salt. Columns other than the keys must have different names.
    """
    known = F.lit(True)
    for key in on:
        known = known & F.col(key).isNotNull()
    tagged = left.where(known).select(*on, F.lit(1).alias("_l"), F.lit(0).alias("_r")).unionByName(
        right.where(known).select(*on, F.lit(0).alias("_l"), F.lit(1).alias("_r"))
    )
    sizes = tagged.groupBy(*on).agg(F.sum("_l").alias("_l"), F.sum("_r").alias("_r"))
    salts = cut(
        sizes.where(F.greatest("_l", "_r") > hot).select(
            *on, F.ceil(F.greatest("_l", "_r") / hot).cast("int").alias("_salts"), (F.col("_l") >= F.col("_r")).alias("_left_dealt")
        )
    )

    def salted(rows: DataFrame, dealt, side: str) -> DataFrame:
        """``rows`` with the salt they stand at, marked as present and as one of several copies."""
        spread = lambda n: F.pmod(F.xxhash64(*[F.col(c) for c in rows.columns]), n).cast("int")
        everywhere = F.sequence(F.lit(0), F.col("_salts") - 1)
        at = F.when(~known, F.array(spread(F.lit(1 << 10)))).when(F.col("_salts").isNull(), F.array(F.lit(0)))
        at = at.when(dealt, F.array(spread(F.col("_salts")))).otherwise(everywhere)
        copied = F.coalesce(~dealt, F.lit(False))
        return rows.join(salts, list(on), "left").select(*rows.columns, F.explode(at).alias("_salt"), copied.alias(f"_{side}_copied"), F.lit(True).alias(f"_{side}"))

    met = salted(left, F.col("_left_dealt"), "l").join(salted(right, ~F.col("_left_dealt"), "r"), [*on, "_salt"], "full")
    false_left = F.col("_r").isNull() & F.col("_l_copied")
    false_right = F.col("_l").isNull() & F.col("_r_copied")
    names = [*on, *[c for c in left.columns if c not in on], *[c for c in right.columns if c not in on]]
    return met.where(~F.coalesce(false_left | false_right, F.lit(False))).select(*names)


def align_columns(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Horizontal concatenation aligned on unique keys: both sides stacked, then one aggregate."""
    values = [c for c in (*left.columns, *right.columns) if c not in on]
    stacked = left.unionByName(right, allowMissingColumns=True)
    return stacked.groupBy(*on).agg(*[F.first(c, ignorenulls=True).alias(c) for c in values])


def join_counts(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """(how, rows) for inner, left, right and outer, from key counts instead of four joins."""
    a = left.groupBy(*on).agg(F.count(F.lit(1)).alias("a"))
    b = right.groupBy(*on).agg(F.count(F.lit(1)).alias("b"))
    both = align_columns(a, b, on).fillna(0, subset=["a", "b"])
    # A null key matches nothing but is kept by the side that preserves it.
    known = F.lit(True)
    for key in on:
        known = known & F.col(key).isNotNull()
    pairs = F.when(known, F.col("a") * F.col("b")).otherwise(F.lit(0))
    left_only = F.when(~known | (F.col("b") == 0), F.col("a")).otherwise(F.lit(0))
    right_only = F.when(~known | (F.col("a") == 0), F.col("b")).otherwise(F.lit(0))
    sums = both.agg(F.sum(pairs).alias("i"), F.sum(left_only).alias("l"), F.sum(right_only).alias("r"))
    cell = lambda how, rows: F.struct(F.lit(how).alias("how"), rows.alias("rows"))
    i, l, r = F.col("i"), F.col("l"), F.col("r")
    return sums.select(F.inline(F.array(cell("inner", i), cell("left", i + l), cell("right", i + r), cell("outer", i + l + r))))


def known_keys(requested: DataFrame, reference: DataFrame, on: Sequence[str]) -> DataFrame:
    return requested.join(reference.select(*on), list(on), "left_semi")


def unknown_keys(requested: DataFrame, reference: DataFrame, on: Sequence[str]) -> DataFrame:
    return unmatched(requested, reference, on)


def latest_before(df: DataFrame, by: Sequence[str], date: str, origin) -> DataFrame:
    """Latest row per group with a date before ``origin``; one pre-combined aggregate, no sort."""
    rest = [c for c in df.columns if c not in by]
    return (
        df.where(F.col(date) < origin)
        .groupBy(*by)
        .agg(F.max_by(F.struct(*rest), F.col(date)).alias("_row"))
        .select(*by, "_row.*")
    )


def value_days_ago(df: DataFrame, by: Sequence[str], date: str, source: str, days: int, name: str) -> DataFrame:
    """Value exactly ``days`` earlier by key equality; null when that day has no row."""
    earlier = df.select(*by, F.date_add(F.col(date), days).alias(date), F.col(source).alias(name))
    return df.join(earlier, [*by, date], "left")
