"""Continuous operation on Structured Streaming.

The file source notices new files and remembers them in its checkpoint; each
micro-batch hands its paths to one scan. The ledger, keyed by content, decides
what is loaded, so a replayed micro-batch changes nothing.
"""

from __future__ import annotations

import dataclasses
import logging
import uuid
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ordergate.plans.table_job import Run
from ordergate.sources.files import stream_files
from ordergate.streaming.scan import run_once

# Fixed value: default seconds between polls.
POLL_SECONDS = 30

_BINARY = "path string, modificationTime timestamp, length bigint, content binary"


def _next_run(run: Run) -> Run:
    """The same settings with a clock and staging folder of its own."""
    now = datetime.now(timezone.utc).replace(tzinfo=None).isoformat(sep=" ")
    return dataclasses.replace(run, run_id=uuid.uuid4().hex, run_timestamp=now)


def watch(
    run: Run,
    stream_dir: str,
    checkpoint: str,
    poll_seconds: int | None = POLL_SECONDS,
    rescan: bool = True,
    on_status: Callable[[DataFrame], None] | None = None,
) -> StreamingQuery:
    """Start loading slots as they arrive; ``stop()`` the returned query to end.

    ``poll_seconds=None`` loads what is there and ends. Every micro-batch looks at
    the whole day, which also catches a file whose content changed under a known
    name and tries failed files again; without ``rescan`` it looks at the new
    files only, and at the whole day after a failed scan. A scan that raises is
    logged and does not end the query.
    """
    whole_day = rescan
    arrivals = (
        run.spark.readStream.format("binaryFile").schema(_BINARY)
        .option("recursiveFileLookup", True)
        .load(f"{stream_dir}/{run.run_date}")
        .select("path", "length")
    )

    def load(batch: DataFrame, _: int) -> None:
        nonlocal whole_day
        try:
            found = stream_files(run.spark, stream_dir, run.run_date)
            if not whole_day:
                found = found.join(batch.select("path"), "path", "left_semi")
            status = run_once(_next_run(run), stream_dir, found)
            whole_day = rescan
        except Exception:  # noqa: BLE001 - the next micro-batch tries again
            logging.getLogger(__name__).exception("scan failed")
            whole_day = True
            return
        if on_status is not None:
            on_status(status)

    writer = arrivals.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    if poll_seconds is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{poll_seconds} seconds").start()
