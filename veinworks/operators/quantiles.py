"""Exact quantiles without gathering a column in one place.

``percentile`` keeps every distinct value of a column in a single task. Here a
sketch first brackets the wanted ranks; then the brackets are counted and
narrowed, all in the same pass, until few values remain inside, which are
fetched. Values that many rows share fall out at the ends of a bracket, so ties
never stop the narrowing. The way is the same for every size; brackets travel
as a table that the values are joined with, so the plan does not grow with the
number of groups and columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from veinworks.session import from_rows

SKETCH_ACCURACY = 10_000
GRID = 64
FETCHED = 1_000  # values inside a bracket that may be fetched


def exact_quantiles(
    df: DataFrame, cols: Sequence[str], probs: Sequence[float], by: Sequence[str] = (), small: int = FETCHED
) -> dict[tuple, dict[str, list[float | None]]]:
    """Linear-interpolated quantiles as ``{group values: {column: [one per prob]}}``.

    Groups must be few (cluster numbers, classes); columns without values give
    ``None``. The result is small, so it comes back to the caller, who turns it
    into literals or into a table. At most ``small`` values per quantile are
    fetched on the way.
    """
    cols, probs, by = list(cols), list(probs), list(by)
    if not cols:
        return {}
    long = _long(df, cols, by)
    slack = 4.0 / SKETCH_ACCURACY
    wanted = [max(0.0, p - slack) for p in probs] + [min(1.0, p + slack) for p in probs]
    bracket = long.groupBy("_group", "_feature").agg(
        F.count("_value").alias("n"), F.min("_value").alias("least"), F.max("_value").alias("most"),
        F.percentile_approx("_value", wanted, SKETCH_ACCURACY).alias("marks"),
    )
    out: dict[tuple, dict[str, list]] = {} if by else {(): {c: [None] * len(probs) for c in cols}}
    targets = []
    for row in bracket.collect():  # a row per group and column
        found = out.setdefault(tuple(row["_group"]) if by else (), {c: [None] * len(probs) for c in cols})
        if not row["n"]:
            continue
        for j, p in enumerate(probs):
            rank = p * (row["n"] - 1)
            targets.append({
                "group": row["_group"], "feature": row["_feature"], "at": (found[cols[row["_feature"]]], j), "rank": rank,
                "first": int(rank), "last": int(rank) + (rank > int(rank)), "low": row["marks"][j],
                "high": row["marks"][len(probs) + j], "least": row["least"], "most": row["most"],
            })
    while targets:
        targets = _narrow(long, targets, small)
    return out


def _long(df: DataFrame, cols: list[str], by: list[str]) -> DataFrame:
    """(_group, _feature, _value): a row per value, the feature by number."""
    group = F.struct(*[F.col(b) for b in by]) if by else F.lit(0)
    cells = F.array(*[F.struct(F.lit(i).alias("_feature"), F.col(c).cast("double").alias("_value")) for i, c in enumerate(cols)])
    return df.select(group.alias("_group"), F.inline(cells))


def _with_targets(long: DataFrame, targets: list[dict]) -> DataFrame:
    """Every value with the brackets of its group and column: a few rows per quantile asked for."""
    kind = long.schema["_group"].dataType.simpleString()
    rows = [(t["group"], t["feature"], k, t["low"], t["high"]) for k, t in enumerate(targets)]
    table = from_rows(long.sparkSession, rows, f"_key {kind}, _number int, _target int, _low double, _high double")
    same = F.col("_group").eqNullSafe(F.col("_key")) & (F.col("_feature") == F.col("_number"))
    return long.where("_value is not null").join(F.broadcast(table), same)


def _narrow(long: DataFrame, targets: list[dict], small: int) -> list[dict]:
    """Count below and inside every bracket; those with few values inside are answered, others come back narrower."""
    value, low, high = F.col("_value"), F.col("_low"), F.col("_high")
    inside = (value >= low) & (value <= high)
    counted = _with_targets(long, targets).where(value <= high).groupBy("_target").agg(
        F.count_if(value < low).alias("below"), F.count_if(inside).alias("inside"),
        F.count_if(value == low).alias("at_low"), F.count_if(value == high).alias("at_high"),
        F.min(F.when(value > low, value)).alias("after_low"), F.max(F.when(inside & (value < high), value)).alias("before_high"),
        F.percentile_approx(F.when(inside, value), [i / GRID for i in range(GRID + 1)], SKETCH_ACCURACY).alias("grid"),
    )
    seen = {r["_target"]: r for r in counted.collect()}  # a row per quantile asked for
    ready, again = [], []
    for k, t in enumerate(targets):
        r = seen.get(k)
        below, n = (r["below"], r["inside"]) if r else (0, 0)
        first, last = t["first"] - below, t["last"] - below
        answers, j = t["at"]
        part = t["rank"] - int(t["rank"])
        if first < 0 or last >= n:  # the sketch missed: widen
            again.append({**t, "low": t["least"], "high": t["most"]})
        elif t["low"] == t["high"] or last < r["at_low"]:
            answers[j] = t["low"]
        elif first >= n - r["at_high"]:
            answers[j] = t["high"]
        elif first < r["at_low"]:  # one of the two ranks is the last of the lowest values
            answers[j] = t["low"] + (r["after_low"] - t["low"]) * part
        elif last >= n - r["at_high"]:
            answers[j] = r["before_high"] + (t["high"] - r["before_high"]) * part
        elif n <= small:
            ready.append({**t, "rank": t["rank"] - below})
        else:
            share = float(GRID) / n
            new_low = r["grid"][max(0, int(first * share) - 2)]
            new_high = r["grid"][min(GRID, int(last * share) + 3)]
            again.append({**t, "low": max(new_low, r["after_low"]), "high": min(new_high, r["before_high"])})
    if ready:
        picked = _with_targets(long, ready).where(inside).groupBy("_target", "_value").count()
        values: dict[int, list] = {}
        for r in picked.collect():  # at most ``small`` rows per quantile
            values.setdefault(r["_target"], []).append((r["_value"], r["count"]))
        for k, t in enumerate(ready):
            answers, j = t["at"]
            answers[j] = _at_rank(sorted(values[k]), t["rank"])
    return again


def _at_rank(counts: list[tuple[float, int]], rank: float) -> float | None:
    first, part = int(rank), rank - int(rank)
    seen, low = 0, None
    for value, n in counts:
        if low is None and seen + n > first:
            low = value
        if low is not None and (part == 0 or seen + n > first + 1):
            return low + (value - low) * part if part else low
        seen += n
    return low


def medians(df: DataFrame, cols: Sequence[str]) -> dict[str, float | None]:
    result = exact_quantiles(df, cols, [0.5])
    return {c: v[0] for c, v in result.get((), {}).items()}


def quantile_table(
    df: DataFrame, cols: Sequence[str], probs: Sequence[float], names: Sequence[str]
) -> DataFrame:
    """One row per column with the named quantiles."""
    found = exact_quantiles(df, cols, probs).get((), {})
    rows = [(c, *[found[c][i] for i in range(len(probs))]) for c in cols]
    return from_rows(
        df.sparkSession, rows, "feature string, " + ", ".join(f"{n} double" for n in names)
    )


def box_statistics(
    df: DataFrame, cols: Sequence[str], by: Sequence[str] = (), whisker: float = 1.5
) -> DataFrame:
    """Quartiles, whiskers (furthest values within 1.5 IQR) and outlier counts.

    Two aggregations whatever the number of columns: quartiles first, then
    bounded extremes and counts, with the few fences of each group as literals.
    """
    by, cols = list(by), list(cols)
    quartiles = exact_quantiles(df, cols, [0.25, 0.5, 0.75], by)
    spark = df.sparkSession
    group_schema = "".join(f"{b} {df.schema[b].dataType.simpleString()}, " for b in by)
    fences = []
    for key, found in quartiles.items():
        for c in cols:
            q1, q2, q3 = found[c]
            if q1 is None:
                continue
            reach = whisker * (q3 - q1)
            fences.append((*key, c, q1, q2, q3, q1 - reach, q3 + reach))
    fence_df = from_rows(
        spark,
        fences,
        group_schema + "feature string, q1 double, median double, q3 double, low double, high double",
    )
    long = df.select(
        *by,
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value"))
                    for c in cols
                ]
            )
        ).alias("cell"),
    ).select(*by, "cell.feature", "cell.value")
    keys = [*by, "feature"]
    joined = long.where(F.col("value").isNotNull()).join(F.broadcast(fence_df), keys)
    inside = F.col("value").between(F.col("low"), F.col("high"))
    return joined.groupBy(*keys, "q1", "median", "q3").agg(
        F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
        F.count_if(~inside).alias("n_outliers"),
    )


def running_totals(
    df: DataFrame,
    key: str,
    totals: dict[str, Column],
    descending: bool = False,
    by: Sequence[str] = (),
    ties: Sequence[str] = (),
) -> DataFrame:
    """Cumulative sums along a numeric ``key`` without a window over a whole group.

    A sketch cuts the key of each group into ranges of about equal size; each
    range is summed on its own and shifted by the totals of the ranges before
    it. Groups are few; rows level on ``key`` follow ``ties``.
    """
    by, ties = list(by), list(ties)
    parts = max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    marks = df.groupBy(*by).agg(
        F.percentile_approx(F.col(key), [i / parts for i in range(1, parts)], SKETCH_ACCURACY).alias("_marks")
    )
    # Without groups the marks are a single row; with groups Spark picks the join by size.
    with_marks = df.join(marks, by) if by else df.join(F.broadcast(marks))
    staged = with_marks.select(
        *df.columns,
        F.size(F.filter("_marks", lambda m: m < F.col(key))).alias("_range"),
        *[c.alias(f"_in_{n}") for n, c in totals.items()],
    )
    side = F.desc if descending else F.asc
    groups = [*by, "_range"]
    before = (Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))).orderBy(side("_range"))
    before = before.rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        staged.groupBy(*groups)
        .agg(*[F.sum(f"_in_{n}").alias(f"_sum_{n}") for n in totals])
        .select(*groups, *[F.coalesce(F.sum(f"_sum_{n}").over(before), F.lit(0)).alias(f"_off_{n}") for n in totals])
    )
    within = Window.partitionBy(*groups).orderBy(side(key), *ties).rowsBetween(Window.unboundedPreceding, 0)
    summed = staged.select("*", *[F.sum(f"_in_{n}").over(within).alias(f"_run_{n}") for n in totals])
    return summed.join(offsets, groups).select(
        *df.columns, *[(F.col(f"_run_{n}") + F.col(f"_off_{n}")).alias(n) for n in totals]
    )
