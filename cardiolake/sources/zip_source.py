"""ZIP exports as a Python data source (S01, U01, L19): ``spark.read.format("export_zip")``.

An archive is read by as many tasks as its size asks for. The driver only lists
archives and their sizes; a task opens its archive, reads the central directory
at the end, and seeks to the entries whose headers lie in its part of the file.
So archives beyond 2 GiB load, no archive is held whole in memory, and a task
holds one entry at a time.

A damaged archive or entry (truncated, bad checksum, encrypted, unknown
compression, larger than Spark's values) does not end the job: it becomes a row
without content whose ``error`` tells why.

Paths are those of ``pyarrow.fs`` (a local or mounted path, ``file://``, ``hdfs://``,
``s3://``, ``gs://``). For stores that Spark alone can read there is
``archive.unzip_entries`` over Spark's binary files.

The stream (``readStream``) keeps a journal: each batch's archives are written down
before they are read, so a restart reads the same ones, and an archive counts as
new by its path, time and size. ``ArchiveJournal`` also moves loaded archives (L19):
*loaded* is noted, files are moved, *moved* is noted, and whoever comes next
finishes what was left half-done.
"""

from __future__ import annotations

import datetime as dt
import fnmatch
import json
import re
import sys
import zipfile
import zlib

from pyspark import cloudpickle
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

# Python code of this module runs in Spark's Python workers; ship it with the
# task so executors need no installed copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

ENTRY_SCHEMA = ("subject_id long, archive string, modified_at timestamp, file_name string, content binary, error string")
#: Bytes of an archive that one task reads, and the largest entry that is one value.
PART_BYTES, LARGEST = 64 << 20, (1 << 31) - 64


def _fs(path: str):
    """(filesystem, path in it) of a URI or a local path."""
    from pyarrow import fs

    if "://" not in path and not path.startswith("file:"):
        import os

        return fs.LocalFileSystem(), os.path.abspath(path)
    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))


def listing(path: str, glob: str = "*.zip") -> list[tuple[str, float, int]]:
    """(path, modification time, size) of the archives under a folder (or of one archive), by path."""
    from pyarrow import fs

    store, root = _fs(path)
    info = store.get_file_info(root)
    if info.type == fs.FileType.File:
        found = [info]
    elif info.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    else:
        found = store.get_file_info(fs.FileSelector(root, recursive=True))
    return sorted((f.path, f.mtime.timestamp() if f.mtime else 0.0, f.size) for f in found
                  if f.type == fs.FileType.File and fnmatch.fnmatch(f.base_name, glob))


class Part(InputPartition):
    """One part of an archive: entries whose headers lie in ``lo <= offset < hi``."""

    def __init__(self, archive: str, modified: float, lo: int, hi: int, first: bool):
        self.archive, self.modified, self.lo, self.hi, self.first = archive, modified, lo, hi, first


def parts_of(archives: list[tuple[str, float, int]], part_bytes: int) -> list[Part]:
    out = []
    for path, modified, size in archives:
        n = max(1, -(-size // part_bytes))
        out += [Part(path, modified, size * k // n, size * (k + 1) // n if k < n - 1 else size + 1, k == 0)
                for k in range(n)]
    return out


def read_part(part: Part, base: str, default_subject: int, json_only: bool):
    """Rows of ``ENTRY_SCHEMA``; errors of the whole archive come from its first part alone."""
    store, _ = _fs(base)
    subject = re.findall(r"subject_id=(\d+)/", part.archive)
    head = (int(subject[-1]) if subject else default_subject, part.archive,
            dt.datetime.fromtimestamp(part.modified, dt.timezone.utc))
    name = part.archive.rsplit("/", 1)[-1]
    try:
        file = store.open_input_file(part.archive)
    except FileNotFoundError:
        if part.first:
            yield (*head, name, None, "archive_missing")
        return
    with file:
        try:
            entries = zipfile.ZipFile(file).infolist()
        except (zipfile.BadZipFile, OSError, ValueError, EOFError) as bad:
            if part.first:
                yield (*head, name, None, f"damaged_archive: {bad}")
            return
        with zipfile.ZipFile(file) as archive:
            for info in entries:
                if info.is_dir() or not part.lo <= info.header_offset < part.hi:
                    continue
                if json_only and not info.filename.lower().endswith(".json"):
                    continue
                if info.flag_bits & 1:
                    yield (*head, info.filename, None, "encrypted_entry")
                elif info.file_size > LARGEST:
                    yield (*head, info.filename, None, "entry_too_large")
                else:
                    try:
                        yield (*head, info.filename, archive.read(info), None)
                    except (zipfile.BadZipFile, zlib.error, EOFError, OSError, ValueError, NotImplementedError,
                            RuntimeError) as bad:
                        yield (*head, info.filename, None, f"damaged_entry: {bad}")


class ZipDataSource(DataSource):
    """Options: path, glob (``*.zip``), default_subject (0), json_only (true), part_bytes; for streams journal."""

    @classmethod
    def name(cls) -> str:
        return "export_zip"

    def schema(self) -> str:
        return ENTRY_SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return ZipReader(self.options)

    def streamReader(self, schema) -> DataSourceStreamReader:
        return ZipStreamReader(self.options)


class _Settings:
    def __init__(self, options):
        # option names come in any case
        o = {k.lower(): v for k, v in dict(options).items()}
        self.path, self.glob = o["path"], o.get("glob", "*.zip")
        self.subject, self.json_only = int(o.get("default_subject", 0)), o.get("json_only", "true").lower() == "true"
        self.part_bytes, self.journal = int(o.get("part_bytes", PART_BYTES)), o.get("journal")

    def read(self, part: Part):
        return read_part(part, self.path, self.subject, self.json_only)


class ZipReader(DataSourceReader):
    def __init__(self, options):
        self.settings = _Settings(options)

    def partitions(self):
        found = parts_of(listing(self.settings.path, self.settings.glob), self.settings.part_bytes)
        return found or [Part("", 0.0, 0, 0, False)]  # Spark wants one

    def read(self, partition: Part):
        return self.settings.read(partition) if partition.archive else iter(())


class ZipStreamReader(DataSourceStreamReader):
    """Offsets are numbers of journal pages."""

    def __init__(self, options):
        self.settings = _Settings(options)
        if not self.settings.journal:
            raise ValueError("option journal: a folder for the stream's journal is needed")

    def initialOffset(self) -> dict:
        return {"n": 0}

    def latestOffset(self) -> dict:
        s = self.settings
        return {"n": ArchiveJournal(s.journal).assign(listing(s.path, s.glob))}

    def partitions(self, start: dict, end: dict):
        journal = ArchiveJournal(self.settings.journal)
        pages = [journal.page(n) for n in range(start["n"] + 1, end["n"] + 1) if not journal.has(n, "loaded")]
        found = parts_of([tuple(a) for page in pages for a in page], self.settings.part_bytes)
        return found or [Part("", 0.0, 0, 0, False)]

    def read(self, partition: Part):
        return self.settings.read(partition) if partition.archive else iter(())


class ArchiveJournal:
    """Numbered pages of archives, and notes that a page was *loaded* and *moved*."""

    def __init__(self, folder: str):
        self.store, self.folder = _fs(folder)
        self.store.create_dir(self.folder, recursive=True)

    def _names(self) -> set[str]:
        from pyarrow import fs

        return {f.base_name for f in self.store.get_file_info(fs.FileSelector(self.folder))}

    def _write(self, name: str, content) -> None:
        # a page is whole or not there
        with self.store.open_output_stream(f"{self.folder}/_{name}.part") as out:
            out.write(json.dumps(content).encode())
        self.store.move(f"{self.folder}/_{name}.part", f"{self.folder}/{name}")

    def _read(self, name: str):
        with self.store.open_input_stream(f"{self.folder}/{name}") as f:
            return json.loads(f.read().decode())

    def last(self) -> int:
        return max((int(n[:-5]) for n in self._names() if re.fullmatch(r"\d+\.json", n)), default=0)

    def page(self, n: int) -> list:
        return self._read(f"{n}.json")

    def has(self, n: int, what: str) -> bool:
        return f"{n}.{what}" in self._names()

    def assign(self, archives: list[tuple[str, float, int]]) -> int:
        """Write archives that no page has on a new page; the number of the last page."""
        last = self.last()
        seen = {tuple(a) for n in range(1, last + 1) for a in self.page(n)}
        new = [a for a in archives if tuple(a) not in seen]
        if new:
            last += 1
            self._write(f"{last}.json", new)
        return last

    def loaded(self) -> None:
        """Note that all pages up to now are loaded."""
        names = self._names()
        for n in range(1, self.last() + 1):
            if f"{n}.loaded" not in names:
                self._write(f"{n}.loaded", {"at": dt.datetime.now(dt.timezone.utc).isoformat()})

    def move(self, source: str, archive_dir: str) -> list[str]:
        """Move the archives of loaded pages from ``source`` to ``archive_dir`` and note it; the moved paths.

        Archives that are gone were moved before; one that was replaced since stays for the next page.
        """
        from pyarrow import fs

        store, root = _fs(source)
        _, target = _fs(archive_dir)
        names, out = self._names(), []
        for n in range(1, self.last() + 1):
            if f"{n}.loaded" not in names or f"{n}.moved" in names:
                continue
            moved = []
            for path, modified, size in self.page(n):
                info = store.get_file_info(path)
                to = f"{target}/{path[len(root):].lstrip('/')}"
                if info.type == fs.FileType.File and (info.mtime.timestamp(), info.size) == (modified, size):
                    store.create_dir(to.rsplit("/", 1)[0], recursive=True)
                    store.move(path, to)
                    out.append(to)
                moved.append([path, to])
            self._write(f"{n}.moved", {"at": dt.datetime.now(dt.timezone.utc).isoformat(), "archives": moved})
        return out


def register(spark: SparkSession) -> None:
    spark.dataSource.register(ZipDataSource)
