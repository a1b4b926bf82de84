"""Files that tasks write into the shared folder, and read back, through pyarrow's file systems."""

import uuid

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext


def located(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    return fs.FileSystem.from_uri(path)


def attempt_path(folder: str, suffix: str) -> str:
    """A file name no other attempt of this task uses; only files named in a task's result count."""
    context = TaskContext.get()
    number = context.partitionId() if context else 0
    return f"{folder}/{number:06d}-{uuid.uuid4().hex}{suffix}"


def opened_for_writing(path: str) -> pa.NativeFile:
    system, inner = located(path)
    system.create_dir(inner.rpartition("/")[0], recursive=True)
    return system.open_output_stream(inner)


def opened_stream(path: str) -> pa.NativeFile:
    system, inner = located(path)
    return system.open_input_stream(inner)


def mapped(path: str, dtype: type | str) -> np.ndarray:
    """A file's numbers: memory-mapped where the file system is local, else read."""
    system, inner = located(path)
    size = system.get_file_info(inner).size
    if not size:
        return np.zeros(0, dtype)
    if isinstance(system, fs.LocalFileSystem):
        return np.memmap(inner, dtype, "r")
    with system.open_input_file(inner) as file:
        return np.frombuffer(file.read(), dtype)
