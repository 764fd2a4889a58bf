"""Raw files in the shared folder, read and written by tasks.

Any store that Arrow's file systems reach works (``file:``, ``s3:``, ``gs:``,
``hdfs:`` or a plain path). A task writes under a name of its own, and readers
learn names only from rows of tasks that succeeded, so what failed or
speculative attempts leave behind is never read.
"""

from __future__ import annotations

import uuid

from pyarrow import fs

from strata.llm.common import strip_scheme


def filesystem(uri: str) -> tuple[fs.FileSystem, str]:
    plain = strip_scheme(uri)
    return fs.FileSystem.from_uri(plain) if "://" in plain else (fs.LocalFileSystem(), plain)


def create(folder: str, stem: str, suffix: str):
    """(uri, open output stream) of a new file that no other attempt writes."""
    uri = f"{folder.rstrip('/')}/{stem}-{uuid.uuid4().hex}{suffix}"
    store, path = filesystem(uri)
    store.create_dir(path.rsplit("/", 1)[0], recursive=True)
    return uri, store.open_output_stream(path, compression=None)


def open_file(uri: str):
    store, path = filesystem(uri)
    return store.open_input_file(path)
