"""Validated settings of a run, and the base of user-defined steps."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from datetime import datetime

import pandas as pd
from pyspark.sql import DataFrame

from veinworks.operators.classification import DEFAULTS, FITTERS, SEARCHES
from veinworks.operators.clustering import METHODS
from veinworks.operators.scoring import metric_name

TASKS = ("classification", "clustering")
REPORTED = ("silhouette", "calinski_harabasz", "davies_bouldin")


@dataclass(frozen=True)
class Settings:
    """Everything a run depends on, checked when it is built."""

    task: str
    row_id: str = "row_id"
    label: str | None = None
    as_of: str = ""
    missing_threshold: float = 0.9
    max_categories: int = 50
    correlation_threshold: float = 0.9
    select: bool = True
    n_features: int | None = None
    importance_threshold: float | None = None
    downsample: bool = False
    test_fraction: float = 0.2
    seed: int = 42
    models: tuple[str, ...] = tuple(DEFAULTS)
    search: str | None = None
    metric: str = "roc auc"
    balance: bool = True
    n_samples: int | None = None
    methods: tuple[str, ...] = METHODS
    k_range: tuple[int, int] = (2, 8)
    starts: int = 10
    output: str | None = None
    run_id: str = field(default_factory=lambda: datetime.now().strftime("%Y%m%d_%H%M%S_%f"))  # a run never overwrites another
    options: dict = field(default_factory=dict)

    def __post_init__(self):
        if self.task not in TASKS:
            raise ValueError(f"task must be one of: {', '.join(TASKS)}")
        if self.task == "classification" and not self.label:
            raise ValueError("classification needs a label column")
        if self.search not in SEARCHES:
            raise ValueError("search must be None, 'grid' or 'random'")
        metric_name(self.metric)
        for name, value in (
            ("missing_threshold", self.missing_threshold), ("correlation_threshold", self.correlation_threshold),
        ):
            if not 0 < value <= 1:
                raise ValueError(f"{name} must be above 0 and at most 1")
        if not 0 < self.test_fraction < 1:
            raise ValueError("test_fraction must lie between 0 and 1")
        if self.k_range[0] > self.k_range[1]:
            raise ValueError("k_range must be (low, high)")
        unknown = [m for m in self.models if m not in FITTERS] + [m for m in self.methods if m not in METHODS]
        if unknown:
            raise ValueError(f"unknown models or methods: {', '.join(unknown)}")


def apply_in_batches(
    df: DataFrame, func: Callable[[pd.DataFrame], pd.DataFrame], schema: str, batch_rows: int = 10_000
) -> DataFrame:
    """Run a function over batches of at most ``batch_rows`` rows, all batches of all partitions."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for start in range(0, len(part), batch_rows):
                yield func(part.iloc[start : start + batch_rows])

    return df.mapInPandas(run, schema)
