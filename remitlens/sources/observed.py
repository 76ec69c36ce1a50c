"""Row counts of jobs, taken by the jobs themselves.

A frame is observed under a name, and a listener of finished queries hands over what the job counted. (``Observation`` objects
would do the same, but a session that has used one can no longer ship the functions of fitted models to tasks: Spark 4.1 then tries
to send the session's observation manager along.)
"""

from __future__ import annotations

import threading
import uuid

from pyspark.java_gateway import ensure_callback_server_started
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Seconds to wait for the report of a job that has ended; listeners hear of it a little later.
PATIENCE = 10.0


class _Finished:
    """Called by Spark after each query of the session."""

    def __init__(self, counts: RowCounts):
        self._counts = counts

    def onSuccess(self, function, execution, nanoseconds) -> None:
        found = execution.observedMetrics().iterator()
        while found.hasNext():
            entry = found.next()
            self._counts.report(entry._1(), entry._2().getLong(0))

    def onFailure(self, function, execution, error) -> None:
        pass

    class Java:
        implements = ["org.apache.spark.sql.util.QueryExecutionListener"]


class RowCounts:
    """Counts the rows of observed frames while it is open."""

    def __init__(self, spark: SparkSession):
        self._spark, self._rows, self._changed = spark, {}, threading.Condition()
        self._mark = uuid.uuid4().hex

    def __enter__(self) -> RowCounts:
        ensure_callback_server_started(self._spark.sparkContext._gateway)
        self._listener = _Finished(self)
        self._spark._jsparkSession.listenerManager().register(self._listener)
        return self

    def __exit__(self, *_) -> None:
        self._spark._jsparkSession.listenerManager().unregister(self._listener)

    def report(self, name: str, rows: int) -> None:
        if name.endswith(self._mark):
            with self._changed:
                # The first job that reads all of a frame counts it; later ones count the same rows again.
                self._rows.setdefault(name, rows)
                self._changed.notify_all()

    def observed(self, df: DataFrame, name: str) -> DataFrame:
        return df.observe(f"{name}-{self._mark}", F.count(F.lit(1)).alias("rows"))

    def rows(self, name: str) -> int | None:
        """The rows of a frame that a finished job has read; None if no job reports them."""
        with self._changed:
            self._changed.wait_for(lambda: f"{name}-{self._mark}" in self._rows, PATIENCE)
            return self._rows.get(f"{name}-{self._mark}")
