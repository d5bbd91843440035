"""One JSON file per section, under an exact name.

Spark's own writers name files themselves, so this is a small data source. Its
readers keep a row a file on the driver and pack a few small files to a task,
so files are listed and read in tasks, too.
"""

from __future__ import annotations

import json
import os
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from korpusmill.session import shared_folder, store


@dataclass
class _Written(WriterCommitMessage):
    files: int


def _filesystem(path: str):
    from pyarrow import fs

    path = re.sub("^file:/+", "/", path)  # taken as it stands, as Spark does; a URI's percent signs would be decoded
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


class _Writer(DataSourceArrowWriter):
    """Each file is written under a spare name and then moved, so a repeated task does no harm.

    Spare files lie in one folder of the run, which goes when the run ends, well or not.
    """

    def __init__(self, path: str):
        self.path, self.spare = path, f".spare-{uuid.uuid4().hex}"

    def write(self, batches):
        filesystem, base = _filesystem(self.path)
        filesystem.create_dir(f"{base}/{self.spare}", recursive=True)
        made, files = set(), 0
        for batch in batches:
            for row in batch.to_pylist():
                folder = f"{base}/{row['folder']}"
                if folder not in made:
                    filesystem.create_dir(folder, recursive=True)
                    made.add(folder)
                body = json.dumps(row["record"], ensure_ascii=False, indent=2)
                spare = f"{base}/{self.spare}/{uuid.uuid4().hex}"
                with filesystem.open_output_stream(spare) as out:
                    out.write(body.encode("utf-8"))
                filesystem.move(spare, f"{folder}/{row['file_name']}")
                files += 1
        return _Written(files)

    def _end(self):
        from pyarrow import fs

        filesystem, base = _filesystem(self.path)
        if filesystem.get_file_info(f"{base}/{self.spare}").type != fs.FileType.NotFound:
            filesystem.delete_dir(f"{base}/{self.spare}")

    def commit(self, messages):
        self._end()

    def abort(self, messages):
        self._end()


class SectionFiles(DataSource):
    """``df.write.format("section_files").mode("append").save(path)``."""

    @classmethod
    def name(cls):
        return "section_files"

    def writer(self, schema, overwrite):
        return _Writer(self.options["path"])


def write_section_files(files: DataFrame, path: str) -> None:
    """Write folder/file_name with the record as JSON, indented by two, in UTF-8.

    Two records of one path are an error, found before anything is written
    (``keep_last`` settles them). The path is any place all executors reach: a
    mounted folder or a store's URL.
    """
    files.sparkSession.dataSource.register(SectionFiles)
    # The check and the writer both read the records, so they are stored.
    rows = store(files.select("folder", "file_name", "record"), shared_folder(files.sparkSession, "records"))
    twice = rows.groupBy("folder", "file_name").agg(F.count("*").alias("n")).where("n > 1").head(1)
    if twice:
        raise ValueError(f"{twice[0]['n']} records for {twice[0]['folder']}/{twice[0]['file_name']}")
    rows.write.format("section_files").mode("append").save(path)


#: Paths of a batch, and bytes of files from which a batch is passed on.
_PATHS, _BYTES = 10_000, 4 << 20


def _entries(filesystem, folder: str) -> Iterator[tuple[str, bool]]:
    """Name of each entry of a folder, and whether it is a folder. A local or mounted folder's names are never held together."""
    from pyarrow import fs

    if isinstance(filesystem, fs.LocalFileSystem):
        with os.scandir(folder) as found:
            for x in found:
                yield x.name, x.is_dir()
    else:
        for x in filesystem.get_file_info(fs.FileSelector(folder)):
            yield x.base_name, x.type == fs.FileType.Directory


def _shown(name: str, is_folder: bool) -> bool:
    """Spark's rule for hidden names, but that a section's name may begin with an underscore."""
    if not is_folder and name.startswith("_") and name.endswith(".json"):
        return True
    return not (name.startswith(".") or name.startswith("_") and "=" not in name or name.endswith("._COPYING_"))


def _walk(filesystem, top: str) -> Iterator[str]:
    """Paths of all files below a folder."""
    folders = [top]
    while folders:
        folder = folders.pop()
        for name, is_folder in _entries(filesystem, folder):
            if _shown(name, is_folder):
                if is_folder:
                    folders.append(f"{folder}/{name}")
                else:
                    yield f"{folder}/{name}"


def _list(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, base = _filesystem(path)
        for batch in batches:
            paths = []
            for _ in range(batch.num_rows):
                for found in _walk(filesystem, base.rstrip("/")):
                    paths.append(found)
                    if len(paths) == _PATHS:
                        yield pa.RecordBatch.from_pydict({"path": paths})
                        paths = []
            if paths:
                yield pa.RecordBatch.from_pydict({"path": paths})

    return run


def _read(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, _ = _filesystem(path)
        rows, size = [], 0
        for batch in batches:
            for place in batch.column(0).to_pylist():
                with filesystem.open_input_stream(place) as file:
                    body = file.read()
                rows.append((*place.split("/")[-2:], body))
                size += len(body) + len(place)
                if size >= _BYTES:
                    yield _batch(rows)
                    rows, size = [], 0
        if rows:
            yield _batch(rows)

    return run


def _batch(rows: list[tuple[str, str, bytes]]) -> pa.RecordBatch:
    kinds = {"folder": pa.string(), "file_name": pa.string(), "value": pa.binary()}
    columns = [pa.array(c, kind) for c, kind in zip(zip(*rows), kinds.values())]
    return pa.RecordBatch.from_arrays(columns, names=list(kinds))


def read_section_files(spark: SparkSession, path: str) -> DataFrame:
    """folder, file_name and record of the files that ``write_section_files`` wrote.

    One task lists the names, which are then dealt to as many tasks as a
    shuffle has; these read the files. The driver sees no file. The path is any
    that the writer takes.
    """
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    paths = spark.range(0, 1, 1, 1).mapInArrow(_list(path), "path string").repartition(tasks, "path")
    texts = paths.mapInArrow(_read(path), "folder string, file_name string, value binary")
    metadata = "section_name string, page_numbers array<int>, language string, rag_header string"
    record = F.from_json(F.col("value").cast("string"), f"source_name string, content string, metadata struct<{metadata}>")
    return texts.select("folder", "file_name", record.alias("record"))


def write_jsonl(docs: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    """JSON lines with nulls written out; one subfolder per value of ``partition_by``."""
    writer = docs.write.mode("errorifexists").option("ignoreNullFields", "false")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.json(path)
