"""Jobs as a stream: states with allowed transitions, and timers for jobs that fall silent."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ledgerloom.operators.views import LIVE

#: What a job's state may become; a job without one may begin to run, or fail to.
ALLOWED = {None: ("running", "failed"), "running": ("stopping", "succeeded", "failed", "killed"), "stopping": ("killed", "failed")}
CHANGES = "job string, event_id long, us long, status string, verdict string"


class JobStates(StatefulProcessor):
    """For each job its state and when it was last heard of. Each event gives a row: `applied` if its status is allowed
    after the job's state, else `refused`, and the state stays. A job that has not ended and isn't heard of for longer
    than `silence` gives a row `timed out` and is orphaned: by a timer once the watermark is past that time, or by the
    event that comes after it, whichever is first, so it doesn't matter how the events are cut into batches."""

    def __init__(self, silence: int) -> None:
        self.silence = silence  # microseconds

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("job", "status string, heard long, timer long")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        status, heard, timer = self.state.get() if self.state.exists() else (None, None, None)
        for event_id, at, said in sorted(((r.event_id, r.us, r.status) for r in rows), key=lambda r: (r[1], r[0])):
            if status in LIVE and at > heard + self.silence:
                status = "orphaned"
                yield _change(key[0], None, heard + self.silence, status, "timed out")
            applied = said in ALLOWED.get(status, ())
            status = said if applied else status
            heard = at
            yield _change(key[0], event_id, at, said, "applied" if applied else "refused")
        if status in LIVE and timer is None:  # one timer a job: it looks again when it rings
            timer = self._timer(heard)
            self.handle.registerTimer(timer)
        self.state.update((status, heard, timer))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        status, heard, _ = self.state.get()
        timer = None
        if status in LIVE and self._timer(heard) > expiredTimerInfo.getExpiryTimeInMs():
            mark = timerValues.getCurrentWatermarkInMs()
            timer = self._timer(heard)
            if timer <= mark:  # what is set for the past would ring a batch late
                timer = None
            else:
                self.handle.registerTimer(timer)
        if status in LIVE and timer is None:
            yield _change(key[0], None, heard + self.silence, "orphaned", "timed out")
            status = "orphaned"
        self.state.update((status, heard, timer))

    def close(self) -> None:
        pass

    def _timer(self, heard: int) -> int:
        """Milliseconds of the first watermark by which the job is silent for too long."""
        return (heard + self.silence) // 1000 + 1


def _change(job: str, event_id: int | None, us: int, status: str, verdict: str) -> Row:
    return Row(job=job, event_id=event_id, us=us, status=status, verdict=verdict)


def changes(events: DataFrame, silence: int, delay: str = "0 seconds") -> DataFrame:
    """A stream of job, event_id, at (a timestamp), status to CHANGES; us: microseconds. silence: seconds. Needs
    KEYED_STATE."""
    rows = events.withWatermark("at", delay).select("job", "event_id", "at", F.unix_micros("at").alias("us"), "status")
    return rows.groupBy("job").transformWithState(JobStates(silence * 1_000_000), CHANGES, "Append", "EventTime")
