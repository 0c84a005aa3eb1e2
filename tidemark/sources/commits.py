"""Commit lists: a folder of short JSON entries that say which written folders count."""

from __future__ import annotations

import json
import uuid

from pyarrow import fs


def _at(place: str):
    return fs.FileSystem.from_uri(place)


def is_folder(place: str) -> bool:
    system, path = _at(place)
    return system.get_file_info(path).type == fs.FileType.Directory


def has(folder: str, name: str) -> bool:
    system, path = _at(f"{folder}/{name}.json")
    return system.get_file_info(path).type == fs.FileType.File


def put(folder: str, name: str, entry: dict) -> None:
    """Add or replace one entry; it is written aside first, so that a reader never sees half of it."""
    system, path = _at(folder)
    system.create_dir(path, recursive=True)
    aside = f"{path}/_{name}-{uuid.uuid4().hex}"
    with system.open_output_stream(aside) as out:
        out.write((json.dumps(entry) + "\n").encode())
    system.move(aside, f"{path}/{name}.json")


def drop(folder: str, name: str) -> None:
    system, path = _at(f"{folder}/{name}.json")
    if system.get_file_info(path).type == fs.FileType.File:
        system.delete_file(path)


def entries(spark, folder: str, schema: str):
    """The entries as a DataFrame, read by the executors."""
    if not is_folder(folder):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json(folder)


def remove_folders(parent: str, prefix: str) -> None:
    """Remove the folders in ``parent`` whose names start with ``prefix``."""
    system, path = _at(parent)
    if system.get_file_info(path).type != fs.FileType.Directory:
        return
    for found in system.get_file_info(fs.FileSelector(path)):
        if found.type == fs.FileType.Directory and found.base_name.startswith(prefix):
            system.delete_dir(found.path)
