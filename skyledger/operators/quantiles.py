"""Exact quantiles of groups of any size.

``F.percentile`` holds a group's values in one task. Here a group's values never meet: a round takes a sketch of the values
that the wanted rank may lie among (``percentile_approx``, of bounded size and merged map-side), counts how many values lie
below, at, between and at the other end of the sketch's two values around the rank, and goes on between them; so a round
leaves about a hundredth whatever the distribution, until few values are left, which are then ranked. What the sketch says
is never trusted: the counts decide, and ends that many values share are answers themselves.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..sources.staging import staged

#: Values of a group that one task may hold; larger groups are narrowed first.
FEW = 200_000
#: Steps of a sketch's quantiles and its accuracy, the inverse of its relative error in rank.
STEPS, ACCURACY = 256, 2_000


def largest(df: DataFrame, keys: Sequence[str]) -> int:
    """Rows of the largest group."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0


def number(c: str) -> Column:
    """The column as a double, null where it is NaN or infinite."""
    v = F.col(c).cast("double")
    return F.when(~F.isnan(v) & (F.abs(v) < float("inf")), v)


def group_quantiles(df: DataFrame, keys: Sequence[str], columns: Sequence[str], q: float = 0.5, few: int | None = None, most: int | None = None) -> DataFrame:
    """Keys, n (rows of the group) and each column's quantile q with linear interpolation, under the column's name.

    Nulls, NaN and infinities are left out; a group without other values has null. Groups are narrowed all at once, two
    or three rounds for any size, and only if one of them has more than ``few`` rows. With ``most``, the largest group's
    rows, df is taken as it is; else it is staged and counted, as each pass reads it.
    """
    g, few = list(keys), FEW if few is None else few
    x = df.select(*g, *[number(c).alias(c) for c in columns])
    if most is None:
        x = staged(x, "values")
        most = largest(x, g)
    sizes = [F.count(F.lit(1)).alias("n")]
    if most <= few:
        return x.groupBy(*g).agg(*sizes, *[F.percentile(c, q).alias(c) for c in columns])
    found = staged(selected(x, g, columns, q, few), "quantiles")
    wide = found.groupBy(*[F.col(k).alias(f"_w{i}") for i, k in enumerate(g)]).agg(*[F.max(F.when(F.col("_c") == c, F.col("v"))).alias(f"_q{j}") for j, c in enumerate(columns)])
    same = [F.col(k).eqNullSafe(F.col(f"_w{i}")) for i, k in enumerate(g)]
    n = x.groupBy(*g).agg(*sizes)
    out = n.join(wide, same, "left") if g else n.crossJoin(F.broadcast(wide))  # without keys both have one row
    return out.select(*g, "n", *[F.col(f"_q{j}").alias(c) for j, c in enumerate(columns)])


def selected(x: DataFrame, g: list[str], columns: Sequence[str], q: float, few: int) -> DataFrame:
    """(keys, _c, v): the quantile of each group and column (_c) of a table that can be read again and again."""
    keys = [f"_k{i}" for i in range(len(g))]
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).alias("v")) for c in columns]))
    long = x.select(*[F.col(k).alias(i) for k, i in zip(g, keys)], each.alias("_x")).select(*keys, F.col("_x.c").alias("_c"), F.col("_x.v").alias("v")).where("v is not null")
    group, by = [*keys, "_c"], [*keys, "_c", "rank"]

    def within(focus: DataFrame) -> DataFrame:
        """The values between the ends of each focus, with its facts."""
        f = focus.select(*[F.col(c).alias(f"f{c}") for c in group], "rank", "low", "high", "below", "inside")
        same = [F.col(c).eqNullSafe(F.col(f"f{c}")) for c in group]
        return long.join(f, same).where((F.col("v") > F.col("low")) & (F.col("v") < F.col("high"))).drop(*[f"f{c}" for c in group])

    # A row for each of the two ranks that the quantile lies between, from 0 on; ends are outside until they are known.
    n = staged(long.groupBy(*group).agg(F.count(F.lit(1)).alias("inside")), "sizes").withColumn("at", (F.col("inside") - 1) * q)
    ranks = F.explode(F.array_distinct(F.array(F.floor("at"), F.ceil("at"))))
    ends = {"low": F.lit(float("-inf")), "high": F.lit(float("inf")), "below": F.lit(0).cast("long"), "v": F.lit(None).cast("double")}
    focus = staged(n.select(*group, ranks.alias("rank"), "inside").withColumns(ends), "focus")
    wide = f"v is null and inside > {few}"
    steps = [i / STEPS for i in range(STEPS + 1)]
    while focus.where(wide).limit(1).count():
        sketch = within(focus.where(wide)).groupBy(*by, "below", "inside").agg(F.percentile_approx("v", steps, ACCURACY).alias("_s"))
        place = F.floor((F.col("rank") - F.col("below")) / F.col("inside") * STEPS).cast("int")
        a, b = F.element_at("_s", F.greatest(place, F.lit(1))), F.element_at("_s", F.least(place + 3, F.lit(STEPS + 1)))
        around = staged(sketch.select(*[F.col(c).alias(f"s{c}") for c in by], a.alias("_a"), b.alias("_b")), "around")
        w = within(focus.where(wide)).join(around, [F.col(c).eqNullSafe(F.col(f"s{c}")) for c in by])
        counts = w.groupBy(*by, "low", "high", "below", "inside", "_a", "_b").agg(*[F.count_if(c).alias(k) for k, c in (("_1", F.col("v") < F.col("_a")), ("_2", F.col("v") == F.col("_a")), ("_3", (F.col("v") > F.col("_a")) & (F.col("v") < F.col("_b"))), ("_4", (F.col("v") == F.col("_b")) & (F.col("_a") < F.col("_b"))))])
        upto = [F.col("below") + sum((F.col(f"_{i}") for i in range(2, k + 1)), F.col("_1")) for k in range(1, 5)]
        part = F.lit(5)
        for k in (4, 3, 2, 1):
            part = F.when(F.col("rank") < upto[k - 1], k).otherwise(part)
        x5 = F.col("inside") - F.col("_1") - F.col("_2") - F.col("_3") - F.col("_4")
        pick = lambda *c: F.element_at(F.array(*c), F.col("_p"))
        inf = F.lit(None).cast("double")
        focus_next = counts.withColumn("_p", part).select(
            *by,
            pick(F.col("_1"), F.lit(0), F.col("_3"), F.lit(0), x5).cast("long").alias("inside"),
            pick(F.col("low"), F.col("low"), F.col("_a"), F.col("low"), F.col("_b")).alias("low"),
            pick(F.col("_a"), F.col("high"), F.col("_b"), F.col("high"), F.col("high")).alias("high"),
            pick(F.col("below"), F.col("below"), upto[1], F.col("below"), upto[3]).alias("below"),
            pick(inf, F.col("_a"), inf, F.col("_b"), inf).alias("v"),
        )
        focus = staged(focus_next.unionByName(focus.where(f"not ({wide})")), "focus")
    place = F.row_number().over(W.partitionBy(*by).orderBy("v")) - 1 + F.col("below")
    last = within(focus.where("v is null")).withColumn("_r", place).where("_r = rank").select(*by, "v")
    values = focus.where("v is not null").select(*by, "v").unionByName(last)
    ends = values.groupBy(*group).agg(F.min("rank").alias("_r"), F.min("v").alias("a"), F.max("v").alias("b")).join(n.select(*[F.col(c).alias(f"n{c}") for c in group], "at"), [F.col(c).eqNullSafe(F.col(f"n{c}")) for c in group])
    return ends.select(*[F.col(i).alias(k) for k, i in zip(g, keys)], "_c", (F.col("a") + (F.col("b") - F.col("a")) * (F.col("at") - F.col("_r"))).alias("v"))
