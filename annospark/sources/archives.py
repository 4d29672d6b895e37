"""Archives unpacked by tasks, from and to any file system.

The members of all archives are a table first: zip directories and tar headers tell where each lies.  Then each member is copied
by a task of its own that reads its bytes only, a piece at a time.  A gzipped file or tar can't be entered in the middle, so one task
streams it from its beginning.
"""

from __future__ import annotations

import gzip
import io
import posixpath
import tarfile
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from annospark.lineage import cut
from annospark.sources.files import Output, filesystem, listed

#: Kinds of archives by their endings; in a folder only the first kind that occurs is unpacked.
KINDS = ((".zip",), (".tar.gz", ".tgz"), (".gz",), (".tar",))
ENDINGS = tuple(e for kind in KINDS for e in kind)
#: Bytes that are copied at a time, and members that go to a task together, about.
PIECE, TOGETHER = 4 << 20, 16
MEMBERS = "archive string, member string, at long, size long"


def chosen(source: str) -> list[str]:
    """The archives of a folder, or one level deep in it, of the first of ``KINDS``; names that begin with ``disabled`` are left out."""
    root = source.rstrip("/")
    near = [f for f in listed(root) if f.removeprefix(root).count("/") <= 2 and not posixpath.basename(f).startswith("disabled")]
    for kind in KINDS:
        if found := [f for f in near if f.endswith(kind)]:
            return found
    return []


def safe(name: str) -> str:
    """A member's name as a path below the target; one that leads out of it raises."""
    path = posixpath.normpath(name)
    if path.startswith(("/", "..")):
        raise ValueError(f"{name!r} leads out of the folder")
    return path


class _Opened(io.RawIOBase):
    """A file of any file system as Python's archive readers want it, read at its offsets."""

    def __init__(self, path: str):
        system, at = filesystem(path)
        self.file, self.place = system.open_input_file(at), 0
        self.length = self.file.size()

    def readable(self):
        return True

    def seekable(self):
        return True

    def seek(self, offset, whence=io.SEEK_SET):
        self.place = offset + (0, self.place, self.length)[whence]
        return self.place

    def tell(self):
        return self.place

    def readinto(self, buffer):
        data = self.file.read_at(min(len(buffer), max(0, self.length - self.place)), self.place)
        buffer[: len(data)] = data
        self.place += len(data)
        return len(data)

    def close(self):
        self.file.close()
        super().close()


def members_of(archive: str) -> Iterator[tuple[str, int | None, int | None]]:
    """(name, offset, size) of the files of an archive; no offset where it is compressed, and one entry without a size where all must be streamed."""
    if archive.endswith(".zip"):
        with zipfile.ZipFile(io.BufferedReader(_Opened(archive))) as z:
            yield from ((i.filename, None, i.file_size) for i in z.infolist() if not i.is_dir())
    elif archive.endswith(".tar"):
        with tarfile.open(fileobj=io.BufferedReader(_Opened(archive))) as t:
            yield from ((m.name, m.offset_data, m.size) for m in t if m.isfile())
    else:
        yield ("", None, None)


def _copy(source, target: str, size: int | None = None) -> str:
    """Copy ``size`` bytes, or all there are, into a file, which appears when it is whole."""
    out, left = Output(target), size
    try:
        while data := source.read(PIECE if left is None else min(PIECE, left)):
            out.write(data)
            left = None if left is None else left - len(data)
        out.close()
    except BaseException:
        out.abort()
        raise
    return target


def extracted(archive: str, member: str, at: int | None, size: int | None, target: str) -> Iterator[str]:
    """Copy one member, or all of an archive that must be streamed, below ``target``; yields the new files."""
    if archive.endswith(".zip"):
        with zipfile.ZipFile(io.BufferedReader(_Opened(archive))) as z, z.open(member) as f:
            yield _copy(f, f"{target}/{safe(member)}")
    elif archive.endswith(".tar"):
        with _Opened(archive) as f:
            f.seek(at)
            yield _copy(io.BufferedReader(f), f"{target}/{safe(member)}", size)
    elif archive.endswith((".tar.gz", ".tgz")):
        with tarfile.open(fileobj=io.BufferedReader(_Opened(archive)), mode="r|gz") as t:
            for m in t:
                if m.isfile():
                    yield _copy(t.extractfile(m), f"{target}/{safe(m.name)}")
    else:
        with gzip.open(io.BufferedReader(_Opened(archive))) as f:
            yield _copy(f, f"{target}/{posixpath.basename(archive)[:-3]}")


def member_table(spark: SparkSession, archives: list[str]) -> DataFrame:
    """``archive, member, at, size`` of all files in ``archives``, listed by tasks; written."""

    def each(batches):
        for batch in batches:
            for archive in batch.column("archive").to_pylist():
                rows = list(members_of(archive))
                columns = [pa.array([archive] * len(rows), pa.string()), *(pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.int64(), pa.int64())))]
                yield pa.RecordBatch.from_arrays(columns, ["archive", "member", "at", "size"])

    rows = spark.createDataFrame([(a,) for a in archives], "archive string").repartition(max(1, len(archives)))
    return cut(rows.mapInArrow(each, MEMBERS), "members")


def unpack(spark: SparkSession, source: str, target: str) -> list[str]:
    """Unpack the archives of ``chosen`` into the folder ``target``, both paths that all executors reach or URIs; returns the new files."""
    if not (archives := chosen(source)):
        return []
    members, target = member_table(spark, archives), target.rstrip("/")

    def each(batches):
        for batch in batches:
            done = [f for row in batch.to_pylist() for f in extracted(**row, target=target)]
            yield pa.RecordBatch.from_pydict({"file": pa.array(done, pa.string())})

    tasks = max(1, -(-members.count() // TOGETHER), len(archives))
    done = members.repartition(tasks, "archive", "member").mapInArrow(each, "file string")
    return sorted({r["file"] for r in done.collect()})  # names only
