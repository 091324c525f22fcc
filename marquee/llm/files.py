"""Binary files in a store that all executors reach, by URI."""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import BinaryIO

import numpy as np
from pyarrow import fs, parquet


def _at(uri: str) -> tuple[fs.FileSystem, str]:
    # Hadoop's names of a store and those of Arrow differ in this scheme only.
    found, path = fs.FileSystem.from_uri(re.sub("^s3[an]://", "s3://", re.sub("^file:/(?!/)", "file:///", uri)))
    return found, path


def write_stream(uri: str) -> BinaryIO:
    store, path = _at(uri)
    store.create_dir(path.rpartition("/")[0], recursive=True)
    return store.open_output_stream(path)


def read_stream(uri: str) -> BinaryIO:
    store, path = _at(uri)
    return store.open_input_file(path)


def read_columns(uri: str, names: list[str]) -> Iterator[list[np.ndarray]]:
    """Columns of every batch of a folder of Parquet files, without nulls, in any order of the files."""
    store, path = _at(uri)
    for entry in store.get_file_info(fs.FileSelector(path)):
        if entry.base_name.endswith(".parquet"):
            with store.open_input_file(entry.path) as source:
                for batch in parquet.ParquetFile(source).iter_batches(columns=names):
                    yield [batch.column(name).to_numpy() for name in names]
