"""A stream over the files of a folder in the order of their names.

Spark's own file stream takes files by modification time, which says nothing about a folder whose files were written
by parallel tasks or copied.  Here the offset is the name of the last file taken, so the order of names decides,
whatever the times say, and a file that appears later under a smaller name is never taken.

Files are listed and read through Arrow's file systems, listing on the driver and reading in the tasks, a file each.  A
source is not told where a restarted query stands, so with ``checkpoint``, the query's own checkpoint folder, it looks
that up; without it the files present at the start make the first batch.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

#: The offset before the first file.
START = ""


def _file_system(folder: str):
    """The file system of a folder and the folder's path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)


def names_in_order(folder: str, prefix: str) -> list[str]:
    """Names, relative to the folder, of the files in it whose own name starts with ``prefix``, in order."""
    from pyarrow import fs

    system, base = _file_system(folder)
    base = base.rstrip("/")
    found = system.get_file_info(fs.FileSelector(base, recursive=True))
    kept = (f.path[len(base) + 1 :] for f in found if f.type == fs.FileType.File and f.base_name.startswith(prefix))
    return sorted(name for name in kept if not any(part.startswith(("_", ".")) for part in name.split("/")))


class FilePartition(InputPartition):
    def __init__(self, name: str) -> None:
        self.name = name


class NamedFilesReader(DataSourceStreamReader):
    def __init__(self, schema: StructType, options: dict[str, str]) -> None:
        self.schema = schema
        self.folder = options["path"]
        self.format = options.get("fileformat", "parquet")
        self.prefix = options.get("prefix", "part-")
        self.most = int(options.get("filesperbatch", "1"))
        if self.format not in ("parquet", "text"):
            raise ValueError(f"unknown file format {self.format}")
        self.checkpoint = options.get("checkpoint")
        #: The last file handed out, once it is known.
        self.taken: str | None = None

    def initialOffset(self) -> dict:
        return self._offset(START)

    def _offset(self, name: str) -> dict:
        return {"folder": self.folder, "file": name}

    def latestOffset(self) -> dict:
        names = names_in_order(self.folder, self.prefix)
        if self.taken is None and not self.checkpoint:
            self.taken = names[-1] if names else START
        elif self.taken is None:
            self.taken = self._planned()
        waiting = [name for name in names if name > self.taken]
        if waiting:
            self.taken = waiting[: self.most][-1]
        return self._offset(self.taken)

    def _planned(self) -> str:
        """The last file of the last batch that the query's offset log plans; Spark does not tell a source."""
        from pyarrow import fs

        system, base = _file_system(f"{self.checkpoint.rstrip('/')}/offsets")
        found = system.get_file_info(fs.FileSelector(base, allow_not_found=True))
        batches = [int(f.base_name) for f in found if f.base_name.isdigit()]
        if not batches:
            return START
        with system.open_input_stream(f"{base}/{max(batches)}") as file:
            lines = file.read().decode().splitlines()
        offsets = [json.loads(line) for line in lines if line.startswith("{")]
        return next((o["file"] for o in offsets if o.get("folder") == self.folder), START)

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        return [FilePartition(n) for n in names_in_order(self.folder, self.prefix) if start["file"] < n <= end["file"]]

    def read(self, partition: FilePartition) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        system, base = _file_system(self.folder)
        path = f"{base.rstrip('/')}/{partition.name}"
        wanted = to_arrow_schema(self.schema)
        if self.format == "text":
            with system.open_input_stream(path) as file:
                lines = file.read().decode().splitlines()
            yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], schema=wanted)
            return
        import pyarrow.parquet as pq

        with system.open_input_file(path) as file:
            for batch in pq.ParquetFile(file).iter_batches(columns=wanted.names):
                yield from pa.Table.from_batches([batch]).select(wanted.names).cast(wanted).to_batches()

    def commit(self, end: dict) -> None:
        pass


class NamedFiles(DataSource):
    """``spark.readStream.format("named_files")`` with path, fileFormat, prefix, filesPerBatch and checkpoint."""

    @classmethod
    def name(cls) -> str:
        return "named_files"

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return NamedFilesReader(schema, {key.lower(): value for key, value in self.options.items()})
