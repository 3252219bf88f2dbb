"""``python -m airlag``: run all stages on ``DATA_ROOT``; with ``--incremental``
only over what came since the last such run."""

import sys

from airlag.config import Settings
from airlag.plans.incremental import run_incremental
from airlag.plans.stages import Lakehouse, run_all
from airlag.session import get_spark

if __name__ == "__main__":
    run = run_incremental if "--incremental" in sys.argv[1:] else run_all
    run(Lakehouse(get_spark(), Settings()))
