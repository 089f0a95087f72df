"""A lock per table, so that two loaders don't write it at the same time.

The lock is a small file in the warehouse folder, made by the file system's own
create-if-absent: HDFS creates atomically, and on a local file system the operating
system does (Hadoop's local create looks first and creates then).  Most object stores
don't; there the table's own format has to order its commits.  The file names its
owner and says when the lock ends, so a loader that died doesn't block the table for
good.  A lock file is only ever deleted by who holds a second file, the guard, and has
read it again under it.
"""

from __future__ import annotations

import contextlib
import json
import os
import socket
import time
import uuid
from collections.abc import Iterator

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

DEFAULT_TTL = 6 * 3600.0
#: A guard is held for a read and a delete; one as old as this belongs to a process that died.
GUARD_TTL = 60.0


class TableLockedError(RuntimeError):
    """Another loader holds the table's lock."""


def lock_path(spark: SparkSession, name: str) -> str:
    folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    parts = [p.strip("`").lower() for p in name.split(".")]
    if len(parts) > 2 and parts[0] == "spark_catalog":
        parts = parts[1:]
    if len(parts) == 1:
        parts = [spark.catalog.currentDatabase().lower(), *parts]
    return f"{folder}/_load_locks/{'.'.join(parts)}.json"


class _File:
    """One small file, on a local file system or one that Hadoop reaches."""

    def __init__(self, spark: SparkSession, path: str):
        self.at = spark._jvm.org.apache.hadoop.fs.Path(path)
        self.fs = self.at.getFileSystem(spark._jsc.hadoopConfiguration())
        whole = self.fs.makeQualified(self.at).toUri()
        self.local = whole.getPath() if whole.getScheme() == "file" else None

    def create(self, content: dict) -> bool:
        """Make the file; ``False`` if there is one."""
        data = json.dumps(content).encode()
        if self.local is not None:
            os.makedirs(os.path.dirname(self.local), exist_ok=True)
            try:
                handle = os.open(self.local, os.O_CREAT | os.O_EXCL | os.O_WRONLY)
            except FileExistsError:
                return False
            with os.fdopen(handle, "wb") as f:
                f.write(data)
            return True
        try:
            stream = self.fs.create(self.at, False)
        except Py4JJavaError:
            if self.fs.exists(self.at):
                return False
            raise
        try:
            stream.write(bytearray(data))
        finally:
            stream.close()
        return True

    def read(self) -> tuple[dict, float] | None:
        """(contents, seconds since it was written); empty contents while it is being written, ``None`` without a file."""
        try:
            if self.local is not None:
                with open(self.local, "rb") as f:
                    data, written = f.read(), os.fstat(f.fileno()).st_mtime
            else:
                status = self.fs.getFileStatus(self.at)
                stream = self.fs.open(self.at)
                try:
                    data, written = bytes(stream.readNBytes(status.getLen())), status.getModificationTime() / 1000
                finally:
                    stream.close()
        except FileNotFoundError:
            return None
        except Py4JJavaError:
            if not self.fs.exists(self.at):
                return None
            raise
        try:
            return json.loads(data), time.time() - written
        except ValueError:
            return {}, time.time() - written

    def delete(self) -> None:
        if self.local is not None:
            with contextlib.suppress(FileNotFoundError):
                os.unlink(self.local)
        else:
            self.fs.delete(self.at, False)


def _delete_if(lock: _File, guard: _File, own: dict, wanted) -> bool:
    """Delete the lock file if ``wanted`` says so of its contents, read under the guard; ``False`` if the guard is taken."""
    if not guard.create(own):
        held = guard.read()
        if held is not None and held[1] > GUARD_TTL:
            guard.delete()
        return False
    try:
        held = lock.read()
        if held is not None and wanted(*held):
            lock.delete()
    finally:
        guard.delete()
    return True


@contextlib.contextmanager
def load_lock(spark: SparkSession, name: str, ttl: float = DEFAULT_TTL, wait: float = 0.0) -> Iterator[str]:
    """Hold the lock of table ``name``; yields the owner's id.

    If another loader holds it, tries again for ``wait`` seconds and then raises
    ``TableLockedError``.  A lock older than its owner's ``ttl`` is stale and is taken
    over by one of those who ask.  On leaving, the lock is deleted if it is still the
    owner's.
    """
    owner = f"{socket.gethostname()}-{os.getpid()}-{uuid.uuid4().hex[:12]}"
    path = lock_path(spark, name)
    lock, guard = _File(spark, path), _File(spark, f"{path}.guard")

    def stale(held: dict, age: float) -> bool:
        # a lock without contents is being written, or its writer died while at it
        return held["until"] < time.time() if "until" in held else age > GUARD_TTL

    begun = time.monotonic()
    while not lock.create({"owner": owner, "table": name, "until": time.time() + ttl}):
        found = lock.read()
        if found is None:
            continue
        if stale(*found):
            _delete_if(lock, guard, {"owner": owner}, stale)
            continue
        if time.monotonic() - begun >= wait:
            raise TableLockedError(f"{name} is being loaded by {found[0].get('owner', 'another loader')} (lock file {path})")
        time.sleep(min(0.2, max(wait, 0.01)))
    try:
        yield owner
    finally:
        mine = lambda held, age: held.get("owner") == owner
        while not _delete_if(lock, guard, {"owner": owner}, mine):
            time.sleep(0.02)
