"""Files opened by tasks. Spark's readers hand over rows; a task that needs bytes at a place opens them with Arrow's file
systems, which know local, HDFS and object-store addresses."""

from __future__ import annotations

from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def located(address: str) -> tuple[fs.FileSystem, str]:
    """The file system and the path in it; an address without a scheme is local."""
    if "://" not in address and not address.startswith("file:"):
        return fs.LocalFileSystem(), address
    if address.startswith("file:"):
        return fs.LocalFileSystem(), "/" + address.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(address)


def opened(address: str) -> BinaryIO:
    """For reading at any place."""
    system, path = located(address)
    return system.open_input_file(path)


def put(address: str, data: bytes, made: set[str] | None = None) -> None:
    """A whole file, which a task that runs again writes again: another name first, then renamed. Folders in `made` are there."""
    import uuid

    system, path = located(address)
    folder = path.rsplit("/", 1)[0]
    if made is None or folder not in made:
        system.create_dir(folder, recursive=True)
        if made is not None:
            made.add(folder)
    aside = f"{path}.{uuid.uuid4().hex}"
    with system.open_output_stream(aside) as out:
        out.write(data)
    system.move(aside, path)


def listed(address: str, suffix: str) -> list[str]:
    """Addresses of the files of a folder with an ending, in order of name."""
    system, path = located(address)
    found = system.get_file_info(fs.FileSelector(path, recursive=False))
    prefix = address.rstrip("/")
    return [f"{prefix}/{f.base_name}" for f in sorted(found, key=lambda f: f.base_name) if f.is_file and f.base_name.endswith(suffix)]


def put_all(rows: DataFrame, folder: str, name: str = "name", content: str = "content") -> int:
    """Writes a file for each row, by tasks; gives their number. A name that comes twice is one file, of either content."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, made = 0, set()
        for batch in batches:
            for called, data in zip(*[c.to_pylist() for c in batch.columns]):
                put(f"{folder}/{called}", data or b"", made)
                n += 1
        yield pa.RecordBatch.from_pydict({"n": pa.array([n], pa.int64())})

    return rows.filter(F.col(name).isNotNull()).select(name, content).mapInArrow(run, "n long").agg(F.sum("n")).first()[0] or 0


def get_all(folders: DataFrame, suffix: str, column: str = "folder") -> DataFrame:
    """path, content of the files with an ending in each of the folders (addresses), listed and read by tasks: the driver keeps
    no list of files, of which there may be as many as rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for folder in batch.column(0).to_pylist():
                system, place = located(folder)
                paths, contents, held = [], [], 0
                for found in system.get_file_info(fs.FileSelector(place, recursive=False, allow_not_found=True)):
                    if found.is_file and found.base_name.endswith(suffix):
                        with system.open_input_file(found.path) as f:
                            contents.append(f.read())
                        paths.append(f"{folder.rstrip('/')}/{found.base_name}")
                        held += len(contents[-1])
                        if held > 1 << 24:
                            yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(contents, pa.binary())], ["path", "content"])
                            paths, contents, held = [], [], 0
                if paths:
                    yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(contents, pa.binary())], ["path", "content"])

    return folders.select(column).mapInArrow(run, "path string, content binary")
