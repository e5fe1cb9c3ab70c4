"""Label sources over rows: a source is asked for batches of inputs inside tasks, and every attempt comes back as a row."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from ledgerloom.operators.select import RETRYABLE_CODES

#: An answer: the raw output, or null and the code of an error.
Answer = tuple[str | None, str | None]
#: A source: from inputs and the number of the attempt (from 0) to an answer for each.
Source = Callable[[list[str], int], list[Answer]]
ATTEMPTS = "attempt int, raw_output string, code string, waited double"
#: Bytes of a fixture that is sent to all tasks, at most.
FIXTURE_BYTES = 64 << 20


def fixture(settings: dict) -> Source:
    """Answers from a fixture, JSON text by input: `raw_output` or `output`; with `error` and `times`, the first so many
    attempts (all, without times) fail with that code. What isn't in it is an error."""
    lines = {k: json.loads(v) for k, v in settings["fixture"].items()}

    def answer(text: str, attempt: int) -> Answer:
        line = lines.get(text)
        if line is None:
            return None, "NotInFixture"
        if "error" in line and attempt < line.get("times", attempt + 1):
            return None, line["error"]
        return line.get("raw_output") or json.dumps(line.get("output"), ensure_ascii=False, separators=(",", ":")), None

    return lambda texts, attempt: [answer(t, attempt) for t in texts]


#: Sources by type. A client of a hosted model is added here by who has one.
SOURCES: dict[str, Callable[[dict], Source]] = {"fake": fixture}


def attempts(rows: DataFrame, text: str, kind: str, settings: dict, batch: int = 16, retries: int = 3, base: float = 1.0, most: float = 60.0, rate: float | None = None, pause: Callable[[float], None] = time.sleep) -> DataFrame:
    """rows with attempt, raw_output, code and waited: a row for each attempt that was made for it. A source of type
    `kind` is made once a task and asked for `batch` inputs at a time; those that fail with a code that passes are asked
    again together, `retries` times at most, after min(most, base * 2^attempt) seconds. rate: requests a second that a
    task makes at most. A null input is no request and has no row. A task that is lost asks again: sources may be asked
    more than once for an input, rows come once."""
    if sum(len(k) + len(v) for k, v in settings.get("fixture", {}).items()) > FIXTURE_BYTES:
        raise ValueError(f"the fixture is larger than {FIXTURE_BYTES} bytes: join it as a table")
    make, own = SOURCES[kind], rows.where(F.col(text).isNotNull())
    names = [*own.columns, *(c.split()[0] for c in ATTEMPTS.split(", "))]
    place = own.columns.index(text)
    schema = StructType([*own.schema.fields, *StructType.fromDDL(ATTEMPTS).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        source, free = make(settings), time.monotonic()

        def ask(texts: list[str], n: int) -> list[Answer]:
            nonlocal free
            if rate:
                pause(max(0.0, free - time.monotonic()))
                free = max(free, time.monotonic()) + 1 / rate
            return source(texts, n)

        for part in batches:
            for at in range(0, part.num_rows, batch):
                some = part.slice(at, batch)
                texts, left, waited = some.column(place).to_pylist(), list(range(some.num_rows)), 0.0
                made: list[tuple] = []
                for n in range(retries + 1):
                    if n:
                        wait = min(most, base * 2.0 ** (n - 1))
                        pause(wait)
                        waited += wait
                    got = ask([texts[i] for i in left], n)
                    made += [(i, n, raw, code, waited) for i, (raw, code) in zip(left, got, strict=True)]
                    left = [i for i, (_, code) in zip(left, got, strict=True) if code in RETRYABLE_CODES]
                    if not left:
                        break
                rows_, *columns = zip(*made, strict=True)
                kinds = (pa.int32(), pa.string(), pa.string(), pa.float64())
                yield pa.RecordBatch.from_arrays([*some.take(pa.array(rows_)).columns, *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], names=names)

    return own.mapInArrow(run, schema)
