"""Event ingestion and landing on Spark."""

import sys

from pyspark import cloudpickle

from eventlake import sources
from eventlake.functions import digest, envelope, payload
from eventlake.operators import ack, align, avro, monitor, registry
from eventlake.plans import jobs, transforms
from eventlake.streaming import sinks

# The functions a UDF uses travel with it, so executors need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = [
    "ack",
    "align",
    "avro",
    "digest",
    "envelope",
    "jobs",
    "monitor",
    "payload",
    "registry",
    "sinks",
    "sources",
    "transforms",
]
