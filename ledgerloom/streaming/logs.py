"""Lines of jobs to their subscribers: a snapshot of the last lines first, then each line as it comes."""

from __future__ import annotations

import json
from collections import deque
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.listener import StreamingQueryListener

#: Lines that a job keeps for snapshots.
TAIL = 500
SENT = "subscriber string, job string, kind string, seq long, line string"


#: Keys of the state: a job's lines stand with those of its shard, since each key costs several calls a batch.
SHARDS = 512
#: Jobs of one entry of a shard's state.
BLOCK = 64


class FanOut(StatefulProcessor):
    """For each job a ring of its last `tail` lines and the list of its subscribers; a key is a shard of jobs. A row with a
    subscriber asks for the job's lines: it gives the ring as rows `snapshot`; each later line gives a row `line` for each
    subscriber. Rows are taken in the order of seq, a line before a subscription of the same seq."""

    def __init__(self, tail: int) -> None:
        self.tail = tail

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.jobs = handle.getListState("jobs", "block string")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        blocks = self.jobs.get() if self.jobs.exists() else ()
        held = {job: (deque(map(tuple, ring), self.tail), subscribers) for (block,) in blocks for job, ring, subscribers in json.loads(block)}
        sent = Row("subscriber", "job", "kind", "seq", "line")
        for job, seq, subscriber, line in sorted(((r.job, r.seq, r.subscriber, r.line) for r in rows), key=lambda r: (r[0] is not None, r[0] or "", r[1], r[2] is not None, r[2] or "")):
            ring, subscribers = held.setdefault(job, (deque((), self.tail), []))
            if subscriber is not None:
                subscribers.append(subscriber)
                for kept in ring:
                    yield sent(subscriber, job, "snapshot", *kept)
            else:
                ring.append((seq, line))
                for to in subscribers:
                    yield sent(to, job, "line", seq, line)
        if held:
            jobs = [(job, list(ring), subscribers) for job, (ring, subscribers) in held.items()]
            self.jobs.put([(json.dumps(jobs[k : k + BLOCK]),) for k in range(0, len(jobs), BLOCK)])

    def close(self) -> None:
        pass


def fan_out(rows: DataFrame, tail: int = TAIL, shards: int = SHARDS) -> DataFrame:
    """A stream of job, seq, line (of a line), subscriber (of a subscription, else null) to SENT. Needs KEYED_STATE. shards:
    keys of the state, the same whenever a checkpoint is used again; those of one must fit a task."""
    shard = F.pmod(F.xxhash64("job"), F.lit(shards)).alias("shard")
    return rows.select(shard, "job", "seq", "line", "subscriber").groupBy("shard").transformWithState(FanOut(tail), SENT, "Append", "None")


class Progress(StreamingQueryListener):
    """The last `most` batches of the session's streams: (query's name or id, batch, rows in, milliseconds), and what
    queries have ended with."""

    def __init__(self, most: int = 1000) -> None:
        self.batches: deque = deque(maxlen=most)
        self.ended: deque = deque(maxlen=most)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self.batches.append((p.name or str(p.id), p.batchId, p.numInputRows, p.durationMs.get("triggerExecution", 0)))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended.append((str(event.id), event.exception))
