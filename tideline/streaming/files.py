"""Small driver-side file operations on the shared folder (any pyarrow file system).

Used only for names and existence checks. Table data is always read and written by Spark.
"""

from __future__ import annotations


def arrow_target(path: str):
    """pyarrow file system + inner path for a Spark-style URI (``file:/x``, ``hdfs://``, ``s3a://``)."""
    from pyarrow import fs

    if path.startswith("file:"):
        local = path[len("file:"):]
        while local.startswith("//"):
            local = local[1:]
        return fs.LocalFileSystem(), local
    if "://" not in path:
        return fs.LocalFileSystem(), path
    if path.startswith(("s3a://", "s3n://")):
        path = "s3://" + path.split("://", 1)[1]
    return fs.FileSystem.from_uri(path)


def exists(path: str) -> bool:
    from pyarrow import fs

    filesystem, inner = arrow_target(path)
    return filesystem.get_file_info(inner).type != fs.FileType.NotFound


def list_names(path: str) -> list[str]:
    """Names of the direct children of ``path`` (empty if it does not exist)."""
    from pyarrow import fs

    filesystem, inner = arrow_target(path)
    if filesystem.get_file_info(inner).type == fs.FileType.NotFound:
        return []
    infos = filesystem.get_file_info(fs.FileSelector(inner, recursive=False))
    return [i.base_name for i in infos]


def remove(path: str) -> None:
    """Remove a folder with all it holds."""
    filesystem, inner = arrow_target(path)
    filesystem.delete_dir(inner)
