"""Credit-application risk analytics as Spark DataFrame jobs."""

import sys

from pyspark import cloudpickle

from riskloom.params import Params
from riskloom.session import build_session, tune

__all__ = ["Params", "build_session", "tune"]

# functions sent to executors carry their code, so executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
