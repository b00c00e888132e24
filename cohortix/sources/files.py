"""Byte ranges of files at any address that Arrow's file systems know: local paths, file:, hdfs:, s3:, gs:, abfs:."""

from __future__ import annotations

from collections import OrderedDict

import pyarrow.fs as pafs


def place(path: str) -> tuple[pafs.FileSystem, str]:
    if "://" not in path and not path.startswith("file:"):
        return pafs.LocalFileSystem(), path
    return pafs.FileSystem.from_uri(path if "://" in path else path.replace("file:/", "file:///", 1))


def exists(path: str) -> bool:
    fs, p = place(path)
    return fs.get_file_info(p).type != pafs.FileType.NotFound


def size(path: str) -> int:
    fs, p = place(path)
    return fs.get_file_info(p).size


def files_of(path: str) -> list[str]:
    """The file itself, or the files of a folder in order, hidden ones left out."""
    fs, p = place(path)
    if fs.get_file_info(p).type != pafs.FileType.Directory:
        return [path]
    names = [f.base_name for f in fs.get_file_info(pafs.FileSelector(p)) if f.type == pafs.FileType.File]
    return [f"{path.rstrip('/')}/{n}" for n in sorted(names) if not n.startswith(("_", "."))]


def write(path: str, data: bytes) -> None:
    fs, p = place(path)
    fs.create_dir(p.rpartition("/")[0], recursive=True)
    with fs.open_output_stream(p, compression=None) as out:  # a suffix must not compress bytes again
        out.write(data)


def keep_named(folder: str, kept: list[str]) -> list[str]:
    """Remove the files of a folder that are not of these names, whatever their suffix."""
    own = set(kept)
    for path in files_of(folder):
        if path.rpartition(".")[0] not in own:
            fs, p = place(path)
            fs.delete_file(p)
    return kept


class Ranges:
    """Reads ranges of files; a few stay open."""

    def __init__(self, most: int = 16):
        self.most, self.open = most, OrderedDict()

    def __call__(self, path: str, lo: int, n: int) -> bytes:
        if path not in self.open:
            fs, p = place(path)
            self.open[path] = fs.open_input_file(p)
            if len(self.open) > self.most:
                self.open.popitem(last=False)[1].close()
        self.open.move_to_end(path)
        return self.open[path].read_at(n, lo)
