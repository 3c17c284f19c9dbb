"""Sampling, splitting, weighting and oversampling by row key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from veinworks.functions.numeric import HASH_PRIME, hash_order

# Stratified downsampling starts above this size and aims at it.
LARGE_TABLE = 10_000


def sample_rows(df: DataFrame, n: int, row_id: str = "row_id", seed: int = 42) -> DataFrame:
    """Exactly n rows (all, when there are fewer) in reproducible pseudo-random order."""
    return df.orderBy(hash_order(row_id, seed), row_id).limit(n)


def sample_per_class(
    df: DataFrame, label: str, sizes: DataFrame | int, row_id: str = "row_id", seed: int = 42
) -> DataFrame:
    """Exactly n rows per class; ``sizes`` is one number or a (label, n) table.

    The rank filter is a top-k per class, so each task keeps at most k rows of a
    class before the shuffle.
    """
    w = Window.partitionBy(label).orderBy(hash_order(row_id, seed), row_id)
    ranked = df.withColumn("_rank", F.row_number().over(w))
    if isinstance(sizes, int):
        return ranked.where(F.col("_rank") <= sizes).drop("_rank")
    top = sizes.agg(F.max("n")).first()[0] or 0
    wanted = sizes.select(F.col("label").alias("_label"), F.col("n").alias("_wanted"))
    return (
        ranked.where(F.col("_rank") <= top)
        .join(F.broadcast(wanted), F.col(label) == F.col("_label"))
        .where(F.col("_rank") <= F.col("_wanted"))
        .drop("_rank", "_label", "_wanted")
    )


def stratified_sizes(df: DataFrame, label: str, target: int) -> DataFrame:
    """(label, n): proportional share of ``target`` per class, floored."""
    counts = df.groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("count"))
    total = F.sum("count").over(Window.partitionBy(F.lit(0)))
    share = F.floor(F.lit(target) * F.col("count") / total)
    return counts.select("label", F.least(share, F.col("count")).cast("int").alias("n")).where("n > 0")


def stratified_downsample(
    df: DataFrame, label: str, row_id: str = "row_id", seed: int = 42, above: int = LARGE_TABLE
) -> DataFrame:
    """Above ``above`` rows: min(above, half) rows, classes in proportion."""
    n = df.count()
    if n <= above:
        return df
    sizes = stratified_sizes(df, label, min(above, n // 2))
    return sample_per_class(df, label, sizes, row_id, seed)


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """(label, weight) with weight = rows / (classes · rows of the class)."""
    counts = df.groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("count"))
    w = Window.partitionBy(F.lit(0))
    weight = F.sum("count").over(w) / (F.count(F.lit(1)).over(w) * F.col("count"))
    return counts.select("label", weight.alias("weight"))


def with_class_weights(df: DataFrame, label: str, output: str = "weight") -> DataFrame:
    """Each row with the balanced weight of its class (classes are few)."""
    weights = class_weights(df, label).select(F.col("label").alias("_label"), F.col("weight").alias(output))
    return df.join(F.broadcast(weights), F.col(label) == F.col("_label")).drop("_label")


def split_rows(
    df: DataFrame, test_fraction: float = 0.2, row_id: str = "row_id", seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """(train, test) by a hash of the row key: stable, no shuffle, no state."""
    is_test = hash_order(row_id, seed) < F.lit(int(test_fraction * HASH_PRIME))
    return df.where(~is_test), df.where(is_test)


def fold_column(row_id: str = "row_id", folds: int = 5, seed: int = 42):
    """Fold number of a row for cross-validation."""
    return F.floor(hash_order(row_id, seed) * F.lit(float(folds)) / F.lit(float(HASH_PRIME))).cast("int")


def oversample(
    df: DataFrame,
    label: str,
    features: Sequence[str],
    row_id: str = "row_id",
    k: int = 5,
    seed: int = 42,
) -> DataFrame:
    """Synthetic minority rows up to the size of the largest class.

    Every row of a class is used equally often; the rows that serve once more
    are those first in pseudo-random order. A synthetic row lies between its
    base row and one of the base row's k nearest neighbours of the same class.
    Real rows come back unchanged with ``synthetic = false``.
    """
    from veinworks.operators.neighbors import nearest_neighbors

    features = list(features)
    counts = {r["label"]: r["count"] for r in df.groupBy(F.col(label).alias("label")).count().collect()}
    real = df.select(row_id, label, *[F.col(c).cast("double").alias(c) for c in features])
    real = real.withColumn("synthetic", F.lit(False))
    if not counts:
        return real
    biggest = max(counts.values())
    minor = {c: n for c, n in counts.items() if 1 < n < biggest}
    if not minor:
        return real
    rows = df.where(F.col(label).isin(list(minor)))
    extra = _first_per_class(rows, label, row_id, {c: (biggest - n) % n for c, n in minor.items()}, seed)
    base_uses = F.lit(0)
    for c, n in minor.items():
        base_uses = F.when(F.col(label) == F.lit(c), F.lit((biggest - n) // n)).otherwise(base_uses)
    uses = rows.join(extra.select(row_id, F.lit(1).alias("_more")), row_id, "left").withColumn(
        "_uses", base_uses + F.coalesce("_more", F.lit(0))
    )
    drawn = uses.where("_uses > 0").select(
        row_id, label, *features, F.explode(F.sequence(F.lit(1), F.col("_uses"))).alias("_draw")
    )
    near = nearest_neighbors(rows, features, k, row_id=row_id, group=label)
    have = near.groupBy("query_id").agg(F.max("rank").alias("_k"))
    pick = hash_order(F.col(row_id) * 31 + F.col("_draw"), seed + 1)
    drawn = drawn.join(have, drawn[row_id] == have["query_id"]).withColumn(
        "_pick", (F.pmod(pick, F.col("_k")) + 1).cast("int")
    )
    chosen = drawn.join(
        near.select("query_id", F.col("rank").alias("_pick"), F.col("neighbor_id").alias("_near")),
        ["query_id", "_pick"],
    )
    other = rows.select(F.col(row_id).alias("_near"), *[F.col(c).alias(f"_n_{c}") for c in features])
    step = hash_order(F.col(row_id) * 31 + F.col("_draw"), seed + 2) / F.lit(float(HASH_PRIME))
    made = chosen.join(other, "_near").select(
        row_id,
        label,
        *[(F.col(c) + step * (F.col(f"_n_{c}") - F.col(c))).alias(c) for c in features],
        F.lit(True).alias("synthetic"),
    )
    return real.unionByName(made)


def _first_per_class(rows, label, row_id, wanted: dict, seed: int) -> DataFrame:
    """The first n rows of each class in pseudo-random order, n possibly large.

    The cut-off is an exact order statistic, so no class is sorted as a whole;
    only rows level with the cut-off are ranked.
    """
    from veinworks.operators.quantiles import exact_quantiles

    keyed = rows.withColumn("_key", hash_order(row_id, seed).cast("double"))
    out = None
    for c, n in wanted.items():
        mine = keyed.where(F.col(label) == F.lit(c))
        if n == 0:
            part = mine.limit(0)
        else:
            size = mine.count()
            cut = exact_quantiles(mine, ["_key"], [(n - 1) / max(size - 1, 1)])[()]["_key"][0]
            cut = float(round(cut))
            below = mine.where(F.col("_key") < cut)
            level = mine.where(F.col("_key") == cut).orderBy(row_id).limit(n - below.count())
            part = below.unionByName(level)
        out = part if out is None else out.unionByName(part)
    return out.drop("_key")
