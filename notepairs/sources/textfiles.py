"""One text per file, written by a job that leaves either all of its files or none."""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

#: Rows of a file of keys that a task holds before it writes them.
_KEYS = 1 << 16
_KEY_SCHEMA = pa.schema([("key", pa.string()), ("bytes", pa.int64())])


@dataclass
class Written(WriterCommitMessage):
    """What one task attempt leaves: the folder of its own."""

    attempt: str


class TextFileWriter(DataSourceArrowWriter):
    """Task attempts write to folders of their own beside the target; the commit moves it all there at once.

    A repeated attempt has another folder, and folders of attempts that did not count are
    removed before the move. A job that dies before its commit leaves the target as it was.
    """

    def __init__(self, folder: str, overwrite: bool):
        self.folder, self.overwrite = folder.rstrip("/"), overwrite
        self.staging = f"{self.folder}.writing-{uuid.uuid4().hex}"

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        attempt = uuid.uuid4().hex
        target, root = fs.FileSystem.from_uri(self.staging)
        target.create_dir(f"{root}/texts/{attempt}", recursive=True)
        target.create_dir(f"{root}/keys", recursive=True)
        with target.open_output_stream(f"{root}/keys/{attempt}.parquet") as out, pq.ParquetWriter(out, _KEY_SCHEMA) as keys:
            names, sizes = [], []
            for batch in batches:
                for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    data = (text or "").encode("utf-8")
                    with target.open_output_stream(f"{root}/texts/{attempt}/{name}.txt") as file:
                        file.write(data)
                    names.append(name)
                    sizes.append(len(data))
                if len(names) >= _KEYS:
                    keys.write_table(pa.table([names, sizes], schema=_KEY_SCHEMA))
                    names, sizes = [], []
            keys.write_table(pa.table([pa.array(names, pa.string()), pa.array(sizes, pa.int64())], schema=_KEY_SCHEMA))
        return Written(attempt)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        target, root = fs.FileSystem.from_uri(self.staging)
        goal = fs.FileSystem.from_uri(self.folder)[1]
        counted = {m.attempt for m in messages if m is not None}
        for part, ending in (("texts", ""), ("keys", ".parquet")):
            target.create_dir(f"{root}/{part}", recursive=True)
            for left in target.get_file_info(fs.FileSelector(f"{root}/{part}")):
                if left.base_name.removesuffix(ending) not in counted:
                    (target.delete_dir if left.type == fs.FileType.Directory else target.delete_file)(left.path)
        if not counted:
            pq.write_table(_KEY_SCHEMA.empty_table(), f"{root}/keys/none.parquet", filesystem=target)
        there = target.get_file_info(goal).type != fs.FileType.NotFound
        if there and not self.overwrite:
            target.delete_dir(root)
            raise FileExistsError(f"{self.folder} exists")
        old = f"{goal}.replaced-{uuid.uuid4().hex}"
        if there:
            target.move(goal, old)
        target.move(root, goal)
        if there:
            target.delete_dir(old)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        """Remove what was written; tasks that still run may hold on to a folder beside the target, which nothing reads."""
        target, root = fs.FileSystem.from_uri(self.staging)
        for wait in (0.1, 0.5, 1.0, 2.0):
            try:
                if target.get_file_info(root).type != fs.FileType.NotFound:
                    target.delete_dir(root)
                return
            except OSError:
                time.sleep(wait)


class TextFiles(DataSource):
    """Sink for (key, text) rows: ``<folder>/texts/*/<key>.txt`` and a table of the keys, ``<folder>/keys``."""

    @classmethod
    def name(cls) -> str:
        return "committed_texts"

    def writer(self, schema: StructType, overwrite: bool) -> TextFileWriter:
        return TextFileWriter(self.options["path"], overwrite)


def export_texts(df: DataFrame, folder: str, *, key: str = "pair_id", text: str = "text", overwrite: bool = False) -> None:
    """Write ``<key>.txt`` for every row, from the tasks, to any file system Arrow knows.

    Readers see all files of the job or none. Null texts are empty. An existing folder is an
    error, or is replaced with ``overwrite``.
    """
    df.sparkSession.dataSource.register(TextFiles)
    rows = df.select(df[key].cast("string").alias("key"), df[text].cast("string").alias("text"))
    rows.write.format("committed_texts").mode("overwrite" if overwrite else "append").save(folder if "://" in folder else f"file://{folder}")
