"""A sink of one file for each row, with a manifest, by Spark's Python data source API.

Rows are (location, document); locations are relative to the option ``folder``, which may
be any file system that pyarrow reaches.  A task writes each file under another name and then
moves it to its place, so a reader never sees half a document and a repeated task writes the
same files again.  What it has written is listed in a manifest part of its own; the driver
gets only counts, and the commit publishes the manifest by writing ``_manifest/complete``.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType


def _open(folder: str):
    from pyarrow import fs

    if "://" not in folder and not folder.startswith("file:"):
        return fs.LocalFileSystem(), folder
    return fs.FileSystem.from_uri(folder if "://" in folder else "file://" + folder.removeprefix("file:"))


@dataclass
class Written(WriterCommitMessage):
    files: int
    size: int


class DocumentWriter(DataSourceWriter):
    def __init__(self, folder: str, schema: StructType):
        self.folder, self.columns = folder, schema.names

    def _put(self, files, path: str, data: bytes) -> None:
        task = TaskContext.get()
        other = f"{path}.{task.taskAttemptId() if task else 0}.tmp"
        files.create_dir(path.rsplit("/", 1)[0], recursive=True)
        with files.open_output_stream(other) as out:
            out.write(data)
        files.move(other, path)

    def write(self, iterator) -> Written:
        files, root = _open(self.folder)
        lines, size = [], 0
        place, text = (self.columns.index(c) for c in ("output_location", "document"))
        for row in iterator:
            if row[place].startswith("/") or ".." in row[place].split("/"):
                raise ValueError(f"a location must lie in the folder: {row[place]}")
            data = (row[text] or "").encode()
            self._put(files, f"{root}/{row[place]}", data)
            lines.append(json.dumps({"output_location": row[place], "bytes": len(data)}))
            size += len(data)
        if lines:
            self._put(files, f"{root}/_manifest/part-{TaskContext.get().partitionId():06d}.jsonl", "\n".join(lines).encode())
        return Written(len(lines), size)

    def commit(self, messages) -> None:
        files, root = _open(self.folder)
        done = [m for m in messages if m is not None]
        total = {"files": sum(m.files for m in done), "bytes": sum(m.size for m in done)}
        self._put(files, f"{root}/_manifest/complete", json.dumps(total).encode())

    def abort(self, messages) -> None:
        """Files of a failed run stay: without the mark they are not published, and the next run writes them again."""


class Documents(DataSource):
    @classmethod
    def name(cls) -> str:
        return "documents"

    def writer(self, schema: StructType, overwrite: bool) -> DocumentWriter:
        missing = {"output_location", "document"} - set(schema.names)
        if missing or "folder" not in self.options:
            raise ValueError(f"documents need a folder and the columns output_location and document; missing: {sorted(missing)}")
        return DocumentWriter(self.options["folder"], schema)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(Documents)


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    """What the commit published."""
    spark.read.text(f"{folder}/_manifest/complete")  # raises where no run has been committed
    return spark.read.schema("output_location string, bytes long").option("pathGlobFilter", "part-*.jsonl").json(f"{folder}/_manifest")


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """The published files: a row for each line of the manifest, with the file that lies there."""
    texts = spark.read.option("wholetext", "true").option("recursiveFileLookup", "true").option("pathGlobFilter", "*_*.json").text(f"{folder}/reports")
    place = F.regexp_extract(F.input_file_name(), "(reports/.*)$", 1)
    return manifest(spark, folder).join(texts.select(place.alias("output_location"), F.col("value").alias("document")), "output_location", "left")
