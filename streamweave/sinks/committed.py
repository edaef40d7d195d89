"""K2/K5/K6 rows delivered exactly once: a data source whose files count only once committed.

Each task attempt writes a file of its own below ``data`` and reports its name. The driver commits a batch with one
manifest, ``commits/<batch>.json``, put in place by a rename; readers take the files that manifests name and no others.
So the files of failed, repeated or speculative attempts are never read, and a batch that a restart replays after
its commit finds its manifest there and leaves it as it is. The folder must be shared by the driver and all executors.

    spark.dataSource.register(CommittedFiles)
    df.writeStream.format("committed").option("path", folder).option("checkpointLocation", ...).start()
    df.write.format("committed").option("path", folder).option("batch", "7").mode("append").save()
    read_committed(spark, folder)
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceStreamArrowWriter, WriterCommitMessage)
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType


@dataclass
class Written(WriterCommitMessage):
    """What a task attempt wrote: a file's name, None if it had no rows."""

    name: str | None
    rows: int


class Folder:
    """Files and manifests of a delivery below ``path`` (a plain path or a URI)."""

    def __init__(self, path: str, schema: StructType):
        self.path, self.schema = path.rstrip("/"), schema

    def store(self) -> tuple[fs.FileSystem, str]:
        return fs.FileSystem.from_uri(self.path)

    def write_file(self, batches: Iterator[pa.RecordBatch]) -> Written:
        store, base = self.store()
        name, rows, out = f"{uuid.uuid4().hex}.parquet", 0, None
        arrow = to_arrow_schema(self.schema)
        try:
            for batch in batches:
                if out is None:
                    store.create_dir(f"{base}/data", recursive=True)
                    out = pq.ParquetWriter(f"{base}/data/{name}", arrow, filesystem=store)
                out.write_table(pa.Table.from_batches([batch]).cast(arrow))
                rows += batch.num_rows
        finally:
            if out is not None:
                out.close()
        return Written(name if out is not None else None, rows)

    def commit_batch(self, messages: list[Written | None], batch: str) -> bool:
        """Makes a batch's files count; False if the batch was committed before, its new files then go."""
        store, base = self.store()
        target = f"{base}/commits/{batch}.json"
        if store.get_file_info(target).type != fs.FileType.NotFound:
            self.drop(messages)
            return False
        store.create_dir(f"{base}/commits", recursive=True)
        draft = f"{base}/commits/.{batch}-{uuid.uuid4().hex}"
        with store.open_output_stream(draft) as f:
            f.write(json.dumps([m.name for m in messages if m is not None and m.name]).encode())
        store.move(draft, target)
        return True

    def drop(self, messages: list[Written | None]) -> None:
        """Deletes the files of attempts that don't count; one that can't be deleted is never read anyway."""
        store, base = self.store()
        for m in messages:
            if m is not None and m.name and store.get_file_info(f"{base}/data/{m.name}").type == fs.FileType.File:
                store.delete_file(f"{base}/data/{m.name}")


class StreamWriter(DataSourceStreamArrowWriter):
    def __init__(self, folder: Folder):
        self.folder = folder

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        return self.folder.write_file(iterator)

    def commit(self, messages: list[Written | None], batchId: int) -> None:
        self.folder.commit_batch(messages, str(int(batchId)))

    def abort(self, messages: list[Written | None], batchId: int) -> None:
        self.folder.drop(messages)


class BatchWriter(DataSourceArrowWriter):
    def __init__(self, folder: Folder, batch: str):
        self.folder, self.batch = folder, batch

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        return self.folder.write_file(iterator)

    def commit(self, messages: list[Written | None]) -> None:
        self.folder.commit_batch(messages, self.batch)

    def abort(self, messages: list[Written | None]) -> None:
        self.folder.drop(messages)


class CommittedFiles(DataSource):
    """``path``: the shared folder. ``batch``: the name of a bounded delivery; a name counts once. Without it each
    write is a delivery of its own. Streams take their batch ids: one stream to a folder."""

    @classmethod
    def name(cls) -> str:
        return "committed"

    def folder(self, schema: StructType) -> Folder:
        if not self.options.get("path"):
            raise ValueError("committed: set the option path to a folder that the driver and all executors share")
        return Folder(self.options["path"], schema)

    def writer(self, schema: StructType, overwrite: bool) -> BatchWriter:
        if overwrite:
            raise ValueError("committed: deliveries are appended, mode overwrite isn't supported")
        batch = self.options.get("batch") or uuid.uuid4().hex
        if not all(c.isalnum() or c in "-_" for c in batch):
            raise ValueError("committed: a batch's name has letters, digits, - and _ only")
        return BatchWriter(self.folder(schema), batch)

    def streamWriter(self, schema: StructType, overwrite: bool) -> StreamWriter:
        return StreamWriter(self.folder(schema))


def read_committed(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The rows of all committed batches, each once; none committed: no rows.

    Only names reach the driver, one per file, as with any listing of a table's files."""
    store, base = Folder(path, schema).store()
    listed = store.get_file_info(fs.FileSelector(f"{base}/commits", allow_not_found=True))
    names = []
    for info in sorted(listed, key=lambda i: i.base_name):
        if info.base_name.endswith(".json") and not info.base_name.startswith("."):
            with store.open_input_stream(info.path) as f:
                names += json.loads(f.read())
    if not names:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{path.rstrip('/')}/data/{n}" for n in names])
