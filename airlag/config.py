"""Settings from the environment."""

from __future__ import annotations

import os
from dataclasses import dataclass, field

# A flight is late above this many minutes, silver keeps arrival
# delays inside these bounds, and old versions expire after this many hours.
LATE_AFTER = 15
ARR_DELAY_MIN = -60
ARR_DELAY_MAX = 360
RETENTION_HOURS = 168
SEED = 42
TEST_FRACTION = (1, 5)

BUSINESS_KEY = ["flight_date", "airline", "flight_number", "origin", "dest"]
PARTITIONS = ["year", "month"]
CLUSTER_BY = ["origin", "dest", "hour"]


@dataclass(frozen=True)
class Settings:
    """Where the tables live, and how the models train.

    ``sample_rows`` bounds the labelled rows that a classifier is fitted on;
    nothing else is bounded. ``train_tasks`` is the number of partitions the
    models train on: forests draw their samples by partition, so it is fixed
    and not taken from the cluster.
    """

    data_root: str = field(default_factory=lambda: os.getenv("DATA_ROOT", "data"))
    sample_rows: int = field(
        default_factory=lambda: int(os.getenv("ML_SAMPLE_ROWS", "50000"))
    )
    train_tasks: int = field(default_factory=lambda: int(os.getenv("ML_TRAIN_TASKS", "16")))

    def path(self, *parts: str) -> str:
        return "/".join([self.data_root.rstrip("/"), *parts])
