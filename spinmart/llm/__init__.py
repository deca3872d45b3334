"""Operators for training-data pipelines. Nothing outside this folder imports it."""

import sys

from pyspark import cloudpickle


def ship_with_tasks(module: str) -> None:
    """Send the functions of ``module`` to the workers inside the task, so these need no copy of the package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


ship_with_tasks(__name__)
