"""Python functions that run in tasks travel with the job."""

from __future__ import annotations

import sys

from pyspark import cloudpickle


def ship_by_value(module_name: str) -> None:
    """Lets executors run a module's functions without having this package installed."""
    cloudpickle.register_pickle_by_value(sys.modules[module_name])
