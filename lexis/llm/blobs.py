"""Sorted hash arrays as files of the shared folder, memory-mapped by tasks.

A blob is one numpy array.  Tasks write blobs under names that depend on their
data alone and rename them into place, so a repeated or speculative attempt
writes the same bytes.  On a shared file system (a mounted folder) readers map
the file and only touched pages are read; on another store, which nothing can
map, readers load it.
"""

from __future__ import annotations

import uuid
from pathlib import Path
from urllib.parse import urlparse

import numpy as np
from pyarrow import fs


def _local(uri: str) -> str | None:
    parts = urlparse(uri)
    return parts.path if parts.scheme in ("", "file") else None


def save(folder: str, name: str, values: np.ndarray) -> None:
    values = np.ascontiguousarray(values)
    local = _local(folder)
    if local is not None:
        target = Path(local) / name
        target.parent.mkdir(parents=True, exist_ok=True)
        draft = target.with_name(f".{name}-{uuid.uuid4().hex}")
        draft.write_bytes(values.tobytes())
        draft.rename(target)
        return
    store, path = fs.FileSystem.from_uri(folder)
    store.create_dir(path, recursive=True)
    draft = f"{path}/.{name}-{uuid.uuid4().hex}"
    with store.open_output_stream(draft) as out:
        out.write(values.tobytes())
    store.move(draft, f"{path}/{name}")


def load(folder: str, name: str, kind) -> np.ndarray:
    """The array, or an empty one when no task had anything to save."""
    local = _local(folder)
    if local is not None:
        path = Path(local) / name
        if not path.exists() or not path.stat().st_size:
            return np.empty(0, kind)
        return np.memmap(path, dtype=kind, mode="r")
    store, path = fs.FileSystem.from_uri(folder)
    if store.get_file_info(f"{path}/{name}").type == fs.FileType.NotFound:
        return np.empty(0, kind)
    with store.open_input_file(f"{path}/{name}") as found:
        return np.frombuffer(found.read(), dtype=kind)
