"""Files by path or URI, from tasks and from the driver: local and mounted paths, HDFS, and object stores."""

from __future__ import annotations

import os
import re
import uuid

from pyarrow import fs


def filesystem(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it.  ``s3a://`` and ``s3n://`` are ``s3://``."""
    if not re.match(r"[a-z0-9]+:/", path):
        return fs.LocalFileSystem(), os.path.abspath(path)
    return fs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", path))


def can_move(path: str) -> bool:
    """Whether the path's file system moves files without copying them."""
    return isinstance(filesystem(path)[0], fs.LocalFileSystem | fs.HadoopFileSystem)


def put_in_place(source: str, target: str) -> None:
    """Move a file, over one that is there; if it has gone there already, all is well."""
    system, at = filesystem(source)
    _, to = filesystem(target)
    if system.get_file_info(at).type == fs.FileType.NotFound:
        if system.get_file_info(to).type != fs.FileType.File:
            raise FileNotFoundError(source)
        return
    system.create_dir(to.rpartition("/")[0], recursive=True)
    if not isinstance(system, fs.LocalFileSystem) and system.get_file_info(to).type == fs.FileType.File:
        system.delete_file(to)
    system.move(at, to)


def names_in(folder: str) -> list[str]:
    """Names of the files of a folder."""
    system, root = filesystem(folder.rstrip("/"))
    return [f.base_name for f in system.get_file_info(fs.FileSelector(root, allow_not_found=True)) if f.type == fs.FileType.File]


def remove_files(paths: list[str]) -> None:
    for p in paths:
        system, at = filesystem(p)
        system.delete_file(at)


def remove_folder(path: str) -> None:
    system, root = filesystem(path)
    if system.get_file_info(root).type == fs.FileType.Directory:
        system.delete_dir(root)


class Output:
    """A file being written; it appears under its name when it is closed, so a task that runs twice leaves one whole file."""

    def __init__(self, path: str):
        self.system, self.path = filesystem(path)
        # An object store shows an object when it is whole, and renaming one there copies it.
        self.renames = can_move(path)
        folder, _, name = self.path.rpartition("/")
        if self.renames:
            self.system.create_dir(folder, recursive=True)
        self.now = f"{folder}/.{name}.{uuid.uuid4().hex}.part" if self.renames else self.path
        self.stream = self.system.open_output_stream(self.now)

    def write(self, content) -> None:
        self.stream.write(content)

    def close(self) -> None:
        self.stream.close()
        if self.renames:
            self.system.move(self.now, self.path)

    def abort(self) -> None:
        if self.renames:
            self.stream.close()
            self.system.delete_file(self.now)


def write_text(path: str, text: str) -> None:
    out = Output(path)
    out.write(text.encode())
    out.close()


def listed(path: str) -> list[str]:
    """All files below a folder, or the file itself, as paths of the same form; as in Spark, names that begin with ``.`` or ``_`` are hidden."""
    system, root = filesystem(path)
    found = system.get_file_info([root])[0]
    if found.type == fs.FileType.File:
        return [path]
    below = system.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True))
    names = (f.path.removeprefix(root.rstrip("/") + "/") for f in below if f.type == fs.FileType.File)
    return sorted(f"{path.rstrip('/')}/{n}" for n in names if not re.search(r"(^|/)[._]", n))
