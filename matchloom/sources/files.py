"""Files of the shared folder, as Python on the driver and on executors reaches them."""

from __future__ import annotations

import re

import pyarrow.fs


def open_store(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system of a path or URI, and the path within it."""
    return pyarrow.fs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", uri) if "://" in uri else f"file://{uri.removeprefix('file:')}")


def listed(uri: str) -> list[pyarrow.fs.FileInfo]:
    """The files below a folder, by path; what begins with a dot or an underscore is not there yet. None if there is no folder."""
    fs, base = open_store(uri)
    found = fs.get_file_info(pyarrow.fs.FileSelector(base, recursive=True, allow_not_found=True))
    inside = lambda f: f.path[len(base) :].split("/")
    return sorted((f for f in found if f.is_file and not any(p[:1] in ("_", ".") for p in inside(f))), key=lambda f: f.path)
