"""Send Python functions to the executors by value."""

from __future__ import annotations

import sys

from pyspark import cloudpickle


def by_value(module_name: str) -> None:
    """Pickle the functions of a module with their code, so that executors need no copy of this package."""
    cloudpickle.register_pickle_by_value(sys.modules[module_name])
