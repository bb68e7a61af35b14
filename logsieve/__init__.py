"""logsieve: access-log analytics as lazy Spark DataFrame operators.

Read CSV logs with a declared schema, report on and drop invalid rows, add
derived columns, compute KPI tables and anomaly tables, and write them as
Parquet. Every operator is built from Spark's own expressions.
"""

from logsieve.operators import *  # noqa: F401,F403
from logsieve.operators import __all__ as _ops
from logsieve.plans import *  # noqa: F401,F403
from logsieve.plans import __all__ as _plans
from logsieve.schema import LOG_SCHEMA, MANDATORY_COLUMNS, Thresholds
from logsieve.sources import *  # noqa: F401,F403
from logsieve.sources import __all__ as _sources

__all__ = [*_ops, *_plans, *_sources, "LOG_SCHEMA", "MANDATORY_COLUMNS", "Thresholds"]
