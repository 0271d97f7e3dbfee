"""Event-time windows over a stream, emitted once when they are complete.

Rows up to ``delay`` behind the latest time seen are counted; a window is emitted when the
watermark has passed its end, and never changed again. Its rows fill a batch's slot in
their zone, so a batch that is done again replaces what it had emitted. The state holds
sums of open windows only, so it goes with the delay and the keys, not with the stream.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from casemill import commits
from casemill.layout import Zones
from casemill.streaming.clean_stream import start_stream

#: What an emitted window holds, beside its keys.
WINDOW = {"window_start": "timestamp", "window_end": "timestamp", "records": "bigint"}


def _counted(rows: DataFrame, time: str, delay: str, window: Column, keys: Sequence[str]) -> DataFrame:
    counted = rows.withWatermark(time, delay).groupBy(window.alias("_window"), *keys).agg(F.count(F.lit(1)).alias("records"))
    ends = [F.col("_window.start").alias("window_start"), F.col("_window.end").alias("window_end")]
    return counted.select(*keys, *ends, "records")


def tumbling(
    rows: DataFrame, time: str, width: str, delay: str, keys: Sequence[str] = (), *, slide: str | None = None
) -> DataFrame:
    """Records per key in windows of one width side by side, or overlapping by a ``slide``.

    A row counts unless the watermark has passed the end of its window.
    """
    return _counted(rows, time, delay, F.window(time, width, slide), keys)


def sessions(rows: DataFrame, time: str, gap: str, delay: str, keys: Sequence[str]) -> DataFrame:
    """Records per key in runs without a pause of ``gap``; a session ends ``gap`` after its last row."""
    return _counted(rows, time, delay, F.session_window(time, gap), keys)


def run_window_stream(
    windows: DataFrame, zones: Zones, *, trigger: Mapping[str, object] | None = None, name: str = "windows"
) -> StreamingQuery:
    """Store the emitted windows of a streaming frame, batch by batch, in the windows zone."""
    spark = windows.sparkSession

    def write(batch: DataFrame, run_id: str, batch_id: int) -> None:
        staged = commits.stage_if_any(batch, zones, "windows", commits.new_attempt(), run_id, batch_id)
        commits.commit(spark, zones, [staged])

    return start_stream(windows, f"{zones.checkpoints}/{name}", trigger or {"availableNow": True}, write)
