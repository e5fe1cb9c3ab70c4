"""JSON Lines in files of a few rows, as a data source to write with: spark.write.format("json_blocks").

Options: path, a folder that all executors share; rows, the most of a file. Spark's own writer renames each file on the
driver and, on a mounted folder, starts processes for each; here a task writes its files into a folder of its own, and all
of them are moved into place at once. The folder is replaced as a whole, so readers never see half of it, and what a task
that broke off has left is not in it."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import batched

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from ledgerloom.sources.runfolders import _folder


@dataclass
class Part(WriterCommitMessage):
    name: str


class BlockWriter(DataSourceWriter):
    def __init__(self, options: dict) -> None:
        self.path, self.rows = options["path"].rstrip("/"), int(options["rows"])
        above, name = self.path.rsplit("/", 1)
        self.staged = f"{above}/_{name}-{uuid.uuid4().hex}"  # readers pass over a leading underscore

    def write(self, rows: Iterator) -> WriterCommitMessage:
        _, system, at = _folder(self.staged)
        part = uuid.uuid4().hex
        system.create_dir(f"{at}/{part}")
        for k, block in enumerate(batched(rows, self.rows)):
            with system.open_output_stream(f"{at}/{part}/{k:09d}.json") as f:
                f.write("".join(f"{row[0]}\n" for row in block).encode())
        return Part(part)

    def commit(self, messages: list) -> None:
        fs, system, staged = _folder(self.staged)
        _, _, at = _folder(self.path)
        system.create_dir(staged)
        done = {m.name for m in messages if m}
        for info in system.get_file_info(fs.FileSelector(staged)):
            if info.base_name not in done:
                system.delete_dir(info.path)
        if system.get_file_info(at).type != fs.FileType.NotFound:
            system.delete_dir(at)
        system.move(staged, at)

    def abort(self, messages: list) -> None:
        fs, system, staged = _folder(self.staged)
        if system.get_file_info(staged).type != fs.FileType.NotFound:
            system.delete_dir(staged)


class JsonBlocks(DataSource):
    @classmethod
    def name(cls) -> str:
        return "json_blocks"

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return BlockWriter(self.options)


def write(rows: DataFrame, path: str, most: int) -> None:
    """The folder `path` with the rows as JSON Lines, nulls kept, in files of `most` rows at most."""
    rows.sparkSession.dataSource.register(JsonBlocks)
    lines = rows.select(F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"}).alias("line"))
    lines.write.format("json_blocks").mode("append").option("rows", most).save(path)
