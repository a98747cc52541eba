"""Operators of a training-data pipeline. Nothing else in the package imports them."""

import os
import sys
from pathlib import Path

from pyspark import cloudpickle

_root = Path(__file__).resolve().parent.parent.parent
_paths = [Path(p).resolve() for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
if _root not in [*_paths, Path.cwd().resolve()]:
    # Workers get no path to this package then; its functions travel with the job.
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
