"""Lines as parts of a bounded size, written by all tasks and published at once: a Spark data source for writing.

    write_parts(lines, path)    # lines: a column `line`

Each task rolls its rows into parts of at most `limit` bytes, a header in each, under a pending folder beside the path. When all
tasks are done, the driver drops what failed attempts left and moves the folder into place; when one fails, the folder goes,
and what stood at the path stays as it was. Names sort in the order of tasks and rows: lines in a global order stay in it. Files
are reached through Arrow's file systems, so a path may be a URI of any of them.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

#: Fixed value: most bytes of a part.
LIMIT = 20_000_000


@dataclass
class Written(WriterCommitMessage):
    names: list[str]
    rows: int


def _open(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path)


class PartsWriter(DataSourceArrowWriter):
    def __init__(self, options: dict, overwrite: bool):
        self.path, self.overwrite = options["path"].rstrip("/"), overwrite
        self.limit, self.suffix = int(options.get("limit", LIMIT)), options.get("suffix", ".jsonl")
        self.header = (options["header"] + "\n").encode() if options.get("header") else b""
        self.pending = f"{self.path}.pending-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        from pyspark import TaskContext

        files, folder = _open(self.pending)
        task, attempt = TaskContext.get().partitionId(), uuid.uuid4().hex[:12]
        names, rows, size, out = [], 0, 0, None
        try:
            for batch in iterator:
                for line in batch.column("line").to_pylist():
                    data = line.encode() + b"\n"
                    if len(self.header) + len(data) > self.limit:
                        raise ValueError(f"a line of {len(data)} bytes is above the limit of {self.limit}")
                    if out is None or size + len(data) > self.limit:
                        if out is not None:
                            out.close()
                        names.append(f"part-{task:06d}-{len(names):06d}-{attempt}{self.suffix}")
                        out = files.open_output_stream(f"{folder}/{names[-1]}")
                        out.write(self.header)
                        size = len(self.header)
                    out.write(data)
                    size, rows = size + len(data), rows + 1
        finally:
            if out is not None:
                out.close()
        return Written(names, rows)

    def commit(self, messages: list[Written | None]) -> None:
        files, folder = _open(self.pending)
        files.create_dir(folder, recursive=True)
        kept = {name for m in messages if m is not None for name in m.names}
        for found in files.get_file_info(fs.FileSelector(folder)):
            if found.base_name not in kept:
                files.delete_file(found.path)
        final = _open(self.path)[1]
        if files.get_file_info(final).type == fs.FileType.NotFound:
            files.move(folder, final)
            return
        if not self.overwrite:
            self.abort(messages)
            raise ValueError(f"{self.path} exists")
        aside = f"{final}.old-{uuid.uuid4().hex}"
        files.move(final, aside)
        try:
            files.move(folder, final)
        except BaseException:
            files.move(aside, final)
            raise
        if files.get_file_info(aside).type == fs.FileType.Directory:
            files.delete_dir(aside)
        else:
            files.delete_file(aside)

    def abort(self, messages: list[Written | None]) -> None:
        files, folder = _open(self.pending)
        if files.get_file_info(folder).type == fs.FileType.Directory:
            files.delete_dir(folder)


class PartsSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "parts"

    def schema(self) -> str:
        return "line string"

    def writer(self, schema: StructType, overwrite: bool) -> PartsWriter:
        out = PartsWriter(dict(self.options), overwrite)
        files, folder = _open(out.pending)
        # made once: a task that is still at work when the others' failure has removed it makes no new one
        files.create_dir(folder, recursive=True)
        return out


def write_parts(lines: DataFrame, path: str, header: str = "", suffix: str = ".jsonl", limit: int = LIMIT) -> None:
    """Writes column `line` at a path, in place of what is there. A null line, or one above the limit, is an error, and then nothing changes."""
    lines.sparkSession.dataSource.register(PartsSource)
    whole = F.coalesce(F.col("line"), F.raise_error(F.lit("no line")).cast("string")).alias("line")
    options = {"path": path, "header": header, "suffix": suffix, "limit": str(limit)}
    lines.select(whole).write.format("parts").mode("overwrite").options(**options).save()
