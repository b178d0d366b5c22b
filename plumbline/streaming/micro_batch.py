"""Run a suite on every micro-batch of a stream and keep the results, one run per batch.

A repeated batch (after a failure) replaces its own results, so the history has no duplicates.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from plumbline.operators.checks import Suite
from plumbline.operators.validate import validate
from plumbline.sources.sinks import write_run


def validate_stream(stream: DataFrame, suite: Suite, path: str, checkpoint: str, load_date: dt.date,
                    refs: Mapping[str, DataFrame] | None = None, as_of=None) -> StreamingQuery:
    """Start the query; it stops when all data available now has been checked."""

    def check(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()  # read by several parts of the suite
        try:
            results = validate(batch, suite, refs, as_of=as_of)
            write_run(results, path, f"batch-{batch_id}", dt.datetime.combine(load_date, dt.time()), load_date)
        finally:
            batch.unpersist()

    return (stream.writeStream.foreachBatch(check).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
