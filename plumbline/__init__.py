"""Data-quality pipelines written as Spark jobs.

``functions``  column expressions: metrics, extraction, redaction, draws
``operators``  DataFrame in, DataFrame out: dedup, references, cooldown
``plans``      whole questions: monitors, validated table, semantic model
``sources``    declared schemas, raw tables, versioned and appended parquet
``streaming``  the same plans kept up to date by Structured Streaming
"""

import sys

from pyspark import cloudpickle

# The helpers that run inside tasks travel with the job, so executors need no
# installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
