"""Small files in the shared folder, reached from the driver and from tasks alike."""

from __future__ import annotations

import uuid


def open_folder(path: str):
    """The file system that holds ``path`` (a path or a URI) and the folder's name in it."""
    from pyarrow.fs import FileSystem

    files, root = FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")
    return files, root.rstrip("/")


def is_file(files, path: str) -> bool:
    from pyarrow.fs import FileType

    return files.get_file_info(path).type == FileType.File


def read_bytes(files, path: str) -> bytes:
    with files.open_input_stream(path) as f:
        return f.read()


def put(files, path: str, body: bytes) -> None:
    """Write a file in one step: under a name of its own, then renamed (its folder is made)."""
    folder = path.rsplit("/", 1)[0]
    files.create_dir(folder, recursive=True)
    temporary = f"{folder}/.{uuid.uuid4().hex}.tmp"
    with files.open_output_stream(temporary) as f:
        f.write(body)
    files.move(temporary, path)


def remove(files, path: str) -> None:
    if is_file(files, path):
        files.delete_file(path)


def remove_folder(files, path: str) -> None:
    from pyarrow.fs import FileType

    if files.get_file_info(path).type == FileType.Directory:
        files.delete_dir(path)
