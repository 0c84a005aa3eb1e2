"""Binary files written and read inside tasks, in any store that pyarrow knows."""

from __future__ import annotations

import uuid

from pyarrow import fs
from pyspark.sql import SparkSession

from tidemark.session import shared_dir


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder of its own below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def store(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


def create(folder: str, name: str):
    """An output stream for a new file; its folder is made if needed."""
    system, path = store(folder)
    system.create_dir(path, recursive=True)
    return system.open_output_stream(f"{path}/{name}", compression=None)


def open_file(folder: str, name: str):
    system, path = store(folder)
    return system.open_input_file(f"{path}/{name}")
