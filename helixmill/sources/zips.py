"""Zip archives by members: a data source that reads each member by its own range.

The driver reads the archives' central directories, a few bytes a member; partitions are runs
of members of some MB, and a task opens its archive at its members' places. So an archive may
be larger than a row or a task's memory, and one archive is read by many tasks. Files are
opened by pyarrow's file systems (local, S3, GCS, Azure, HDFS).
"""

from __future__ import annotations

import io
import json
import re
import zipfile
from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from helixmill.sources import schemas

#: Bytes of members, as they are after unpacking, in one partition, about.
LOT = 64 << 20


class _File(io.RawIOBase):
    """A file of pyarrow as Python's library expects files: a place before its start is an OSError."""

    def __init__(self, raw):
        self.raw, self.size = raw, raw.size()

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def tell(self) -> int:
        return self.raw.tell()

    def seek(self, offset: int, whence: int = 0) -> int:
        place = offset + (0, self.raw.tell(), self.size)[whence]
        if place < 0:
            raise OSError("a place before the file's start")
        return self.raw.seek(place)

    def readinto(self, buffer) -> int:
        data = self.raw.read(len(buffer))
        buffer[: len(data)] = data
        return len(data)

    def close(self) -> None:
        self.raw.close()
        super().close()


def opened(uri: str):
    """A seekable file, or None where pyarrow has no file system for the address."""
    from pyarrow import ArrowInvalid, ArrowNotImplementedError, fs

    try:
        store, path = fs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", uri))
    except (ArrowInvalid, ArrowNotImplementedError, OSError):
        return None
    return io.BufferedReader(_File(store.open_input_file(path)), 1 << 18)


class Members(InputPartition):
    def __init__(self, archive: str, names: list[int]):
        self.archive, self.names = archive, names


class ZipReader(DataSourceReader):
    def __init__(self, options: dict):
        self.archives = json.loads(options["archives"])
        self.pattern, self.lot = options.get("pattern", ".*"), int(options.get("lot", LOT))

    def partitions(self) -> list[Members]:
        want, found = re.compile(self.pattern), []
        for archive in self.archives:
            lot, size = [], 0
            with opened(archive) as raw, zipfile.ZipFile(raw) as z:
                for i, info in enumerate(z.infolist()):
                    if info.is_dir() or not want.search(info.filename):
                        continue
                    if lot and size + info.file_size > self.lot:
                        found.append(Members(archive, lot))
                        lot, size = [], 0
                    lot.append(i)
                    size += info.file_size
            if lot:
                found.append(Members(archive, lot))
        return found or [Members("", [])]

    def read(self, partition: Members) -> Iterator[tuple]:
        if not partition.names:
            return
        with opened(partition.archive) as raw, zipfile.ZipFile(raw) as z:
            every = z.infolist()
            for i in partition.names:
                yield partition.archive, every[i].filename, z.read(every[i])


class ZipSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "zip_by_members"

    def schema(self) -> StructType:
        return schemas.MEMBERS

    def reader(self, schema: StructType) -> ZipReader:
        return ZipReader(self.options)


def reachable(paths: list[str]) -> bool:
    """Whether pyarrow can open the files."""
    for path in paths[:1]:
        file = opened(path)
        if file is None:
            return False
        file.close()
    return True


def by_members(spark: SparkSession, paths: list[str], pattern: str, lot: int = LOT):
    spark.dataSource.register(ZipSource)
    return spark.read.format(ZipSource.name()).option("archives", json.dumps(paths)).option("pattern", pattern).option("lot", lot).load()
