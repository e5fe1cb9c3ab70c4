"""Folders of runs, `<run>/meta.json` and `<run>/output.log`, as a data source: spark.read.format("runs").

Options: path, a folder that all executors share (a path or a URI that pyarrow knows); what: `meta` (the default) or `log`;
runs_a_task (256). A file that is torn, missing or no JSON object gives a row that says so; it never fails the read.
Written are whole meta files (each beside its place first, then moved there) and, as a stream, segments of logs, which a
batch that comes again replaces. Rows of one run must stand in one task: use by_run()."""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamWriter, DataSourceWriter, InputPartition, WriterCommitMessage

META = "run string, id string, flow string, label string, status string, exit_code int, started_at string, ended_at string, torn boolean"
LOG = "run string, number long, line string"
#: The fields of meta.json and the columns that hold them.
FIELDS = {"id": "id", "flowId": "flow", "label": "label", "status": "status", "exitCode": "exit_code", "startedAt": "started_at", "endedAt": "ended_at"}


def _folder(path: str):
    """The file system of a path, and the path in it."""
    from pyarrow import fs

    if path.startswith("file:/") and not path.startswith("file:///"):  # as Hadoop writes it
        path = path.removeprefix("file:")
    system, at = fs.FileSystem.from_uri(path)
    return fs, system, at.rstrip("/")


def _names(path: str) -> list[str]:
    """Run folders, in order; none if there is no such folder."""
    fs, system, at = _folder(path)
    found = system.get_file_info(fs.FileSelector(at, allow_not_found=True))
    return sorted(f.base_name for f in found if f.type == fs.FileType.Directory and not f.base_name.startswith((".", "_")))


def _text(system, at: str) -> str | None:
    try:
        with system.open_input_stream(at) as f:
            return f.read().decode(errors="replace")
    except (FileNotFoundError, OSError):
        return None


@dataclass
class Some(InputPartition):
    runs: tuple[str, ...]


class Reader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.path, self.log = options["path"], options.get("what", "meta") == "log"
        self.most = int(options.get("runs_a_task", 256))

    def partitions(self) -> list[InputPartition]:
        runs = _names(self.path)
        return [Some(tuple(runs[k : k + self.most])) for k in range(0, len(runs), self.most)] or [Some(())]

    def read(self, partition: Some) -> Iterator[tuple]:
        fs, system, at = _folder(self.path)
        for run in partition.runs:
            yield from self._log(fs, system, f"{at}/{run}", run) if self.log else [self._meta(system, f"{at}/{run}", run)]

    def _meta(self, system, at: str, run: str) -> tuple:
        try:
            meta = json.loads(_text(system, f"{at}/meta.json") or "")
        except ValueError:
            meta = None
        torn = not isinstance(meta, dict)
        own = {} if torn else meta
        value = {c: own.get(k) for k, c in FIELDS.items()}
        code = value.pop("exit_code")
        value = {c: v if v is None or isinstance(v, str) else json.dumps(v) for c, v in value.items()}
        code = code if isinstance(code, int) and not isinstance(code, bool) else None
        return (run, value["id"], value["flow"], value["label"], value["status"], code, value["started_at"], value["ended_at"], torn)

    def _log(self, fs, system, at: str, run: str) -> Iterator[tuple]:
        """Lines of output.log, then of its segments by number; empty lines are no lines."""
        parts = sorted(f.path for f in system.get_file_info(fs.FileSelector(at)) if f.base_name.startswith("output") and f.base_name.endswith(".log"))
        number = 0
        for part in sorted(parts, key=lambda p: (not p.endswith("/output.log"), p)):
            for line in (_text(system, part) or "").replace("\r\n", "\n").split("\n"):
                if line:
                    number += 1
                    yield (run, number, line)


def _put(system, at: str, text: str) -> None:
    """A whole file in place of what is there."""
    with system.open_output_stream(f"{at}.new") as f:
        f.write(text.encode())
    system.move(f"{at}.new", at)


class MetaWriter(DataSourceWriter):
    """Replaces the meta file of each run by the row's."""

    def __init__(self, options: dict) -> None:
        self.path = options["path"]

    def write(self, rows: Iterator) -> WriterCommitMessage:
        _, system, at = _folder(self.path)
        for row in rows:
            system.create_dir(f"{at}/{row['run']}")
            _put(system, f"{at}/{row['run']}/meta.json", json.dumps({k: row[c] for k, c in FIELDS.items()}, ensure_ascii=False, indent=2))
        return WriterCommitMessage()


@dataclass
class Written(WriterCommitMessage):
    parts: tuple[tuple[str, str], ...]


class LogWriter(DataSourceStreamWriter):
    """Appends lines to logs: each batch is one segment a run, put in its place when the batch is committed."""

    def __init__(self, options: dict) -> None:
        self.path = options["path"]

    def write(self, rows: Iterator) -> WriterCommitMessage:
        import uuid

        _, system, at = _folder(self.path)
        lines: dict[str, list[tuple[int, str]]] = {}
        for row in rows:
            lines.setdefault(row["run"], []).append((row["number"], row["line"]))
        parts = []
        for run, own in lines.items():
            system.create_dir(f"{at}/{run}")
            part = f"{at}/{run}/.part-{uuid.uuid4().hex}"
            with system.open_output_stream(part) as f:
                f.write("".join(f"{line}\n" for _, line in sorted(own)).encode())
            parts.append((run, part))
        return Written(tuple(parts))

    def commit(self, messages: list, batchId: int) -> None:
        _, system, at = _folder(self.path)
        for message in messages:
            for run, part in message.parts if message else ():
                system.move(part, f"{at}/{run}/output-{batchId:09d}.log")

    def abort(self, messages: list, batchId: int) -> None:
        _, system, _ = _folder(self.path)
        for message in messages:
            for _, part in message.parts if message else ():
                system.delete_file(part)


class RunFolders(DataSource):
    @classmethod
    def name(cls) -> str:
        return "runs"

    def schema(self) -> str:
        return LOG if self.options.get("what", "meta") == "log" else META

    def reader(self, schema) -> DataSourceReader:
        return Reader(self.options)

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return MetaWriter(self.options)

    def streamWriter(self, schema, overwrite: bool) -> DataSourceStreamWriter:
        return LogWriter(self.options)


def read_runs(spark: SparkSession, path: str, what: str = "meta") -> DataFrame:
    spark.dataSource.register(RunFolders)
    return spark.read.format("runs").option("what", what).load(path)


def by_run(rows: DataFrame) -> DataFrame:
    """The rows of each run in one task, which writes its file."""
    rows.sparkSession.dataSource.register(RunFolders)
    return rows.repartition("run")
