"""Files of any store that tasks can open by themselves, outside Spark's own readers."""

from __future__ import annotations

from collections.abc import Iterator
from fnmatch import fnmatch

import pyarrow.fs as pafs


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path or address, and the path in it; ``s3a`` is read as ``s3``."""
    if "://" not in path and not path.startswith("file:"):
        return pafs.LocalFileSystem(), path
    return pafs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


def matching(pattern: str) -> dict[str, int]:
    """Sizes of the files whose names match the last part of the pattern, by path; nothing is opened."""
    folder, _, name = pattern.rpartition("/")
    fs, root = file_system(folder or "/")
    found = fs.get_file_info(pafs.FileSelector(root, allow_not_found=True))
    return {f"{folder}/{i.base_name}": i.size for i in sorted(found, key=lambda i: i.path) if i.type == pafs.FileType.File and fnmatch(i.base_name, name)}


def head(path: str, size: int) -> bytes:
    fs, name = file_system(path)
    with fs.open_input_stream(name) as f:
        return f.read(size)


def lines_ending_in(path: str, low: int, high: int, block: int = 1 << 20) -> Iterator[tuple[int, bytes]]:
    """(position, line with its line feed) of the lines whose line feed lies in [low, high).

    So the ranges of a file give each complete line once, wherever they are cut, and a tail without a line feed is left for the
    range that will have it. A line's beginning is looked for backwards from ``low``.
    """
    fs, name = file_system(path)
    with fs.open_input_file(name) as f:
        start, at = 0, low
        while at > 0:
            back = max(0, at - (64 << 10))
            f.seek(back)
            found = f.read(at - back).rfind(b"\n")
            if found >= 0:
                start = back + found + 1
                break
            at = back
        f.seek(start)
        parts: list[bytes] = []
        at = start
        while at < high:
            data = f.read(min(block, high - at))
            if not data:
                return
            at += len(data)
            first = 0
            while (end := data.find(b"\n", first)) >= 0:
                parts.append(data[first : end + 1])
                line = b"".join(parts)
                yield start, line
                start, first, parts = start + len(line), end + 1, []
            if first < len(data):
                parts.append(data[first:])
