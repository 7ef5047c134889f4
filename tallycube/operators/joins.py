"""Join shapes that stay whole and balanced when one key holds a large share of the rows.

No join carries a broadcast hint: Catalyst broadcasts a side whose size it knows to be below
spark.sql.autoBroadcastJoinThreshold, and otherwise shuffles, where adaptive execution splits a
hot key of the fact side. That split exists for inner, left, semi and anti joins only, so full and
right joins are written with those.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keep_listed(df: DataFrame, codes: DataFrame, column: str, code: str = "code") -> DataFrame:
    """Rows whose `column` occurs in the code list."""
    return df.join(_codes(codes, column, code), column, "left_semi")


def drop_listed(df: DataFrame, codes: DataFrame, column: str, code: str = "code") -> DataFrame:
    """Rows whose `column` does not occur in the code list; a null code is kept."""
    return df.join(_codes(codes, column, code), column, "left_anti")


def keep_listed_if_any(
    df: DataFrame, codes: DataFrame, column: str, code: str = "code", any_of: DataFrame | None = None
) -> DataFrame:
    """Like `keep_listed`, but nothing is restricted while the list (or `any_of`) is empty."""
    # Grouping makes the list unique, so the left join adds no rows.
    listed = apart(_codes(codes, column, code).distinct(), column).withColumn("_listed", F.lit(True))
    size = (codes if any_of is None else any_of).agg(F.count(F.lit(1))).scalar()
    return df.join(listed, column, "left").filter(F.col("_listed") | (size == 0)).drop("_listed")


def apart(df: DataFrame, column: str) -> DataFrame:
    """The text column formed anew, so that what was grouped by it is shuffled once more, by itself, for a join.

    Adaptive execution splits a hot key only where each input of the join is a shuffle and nothing else.
    """
    return df.withColumn(column, F.concat(column, F.lit("")))


def full_join(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Full outer join on equal names; other columns must have different names on both sides.

    Written as left join plus the unmatched right rows, for keys that may repeat. Null keys match nothing on either side.
    """
    on = list(on)
    both = left.join(right, on, "left")
    unmatched = right.join(left.select(*on).distinct(), on, "left_anti")
    return both.unionByName(unmatched, allowMissingColumns=True)


def full_join_unique(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Full outer join of two tables in which no key occurs twice, in one pass over each.

    Both become rows of one table and meet in one grouping, whose groups have two rows at most; so no key can be hot. A
    key that occurs twice on one side is an error (`full_join` takes such tables). Null keys match nothing.
    """
    on = list(on)
    sides = (left, right)
    own = [[c for c in df.columns if c not in on] for df in sides]
    if shared := set(own[0]) & set(own[1]):
        raise ValueError(f"both sides have the columns {sorted(shared)}")
    # A row with a null in its key stays by itself.
    incomplete = reduce(lambda a, b: a | b, [F.col(f"`{c}`").isNull() for c in on])
    alone = F.when(incomplete, F.monotonically_increasing_id())
    tagged = [
        df.select(*on, *own[k], alone.alias("_alone"), F.lit(k == 0).alias("_first")) for k, df in enumerate(sides)
    ]
    rows = tagged[0].unionByName(tagged[1], allowMissingColumns=True)
    kept = [F.max(f"`{c}`").alias(c) for c in own[0] + own[1]]
    sizes = [F.count(F.when(F.col("_first") == first, 1)) for first in (True, False)]
    met = rows.groupBy(*on, "_alone", F.when(F.col("_alone").isNotNull(), F.col("_first")).alias("_side")).agg(*kept, F.greatest(*sizes).alias("_most"))
    twice = F.raise_error(F.concat(F.lit("a key occurs twice: "), F.to_json(F.struct(*on)))).cast("boolean")
    return met.filter(F.when(F.col("_most") > 1, twice).otherwise(True)).select(*on, *own[0], *own[1])


def group_total(df: DataFrame, by: Sequence[str], **totals) -> DataFrame:
    """Write totals of each group back to every row of it.

    Partial sums and a join instead of a window: a window would sort a hot group in one task.
    Null keys form a group of their own.
    """
    by = list(by)
    sums = df.groupBy(*[F.col(c).alias(f"_by_{c}") for c in by]).agg(*[v.alias(k) for k, v in totals.items()])
    same = reduce(lambda a, b: a & b, [df[c].eqNullSafe(sums[f"_by_{c}"]) for c in by])
    return df.join(sums, same, "left").select(df["*"], *totals)


def _codes(codes: DataFrame, column: str, code: str) -> DataFrame:
    return codes.select(F.col(code).alias(column))
