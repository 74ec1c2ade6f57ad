"""Folders that are replaced whole without a moment in which they are empty.

Every write goes to a folder of its own below the path and counts once a small commit file names it. Readers take the
folder of the last commit, so a write that fails leaves the path as it was, and a table may be read and replaced in one
plan. A path without commits is read as it stands: files that other tools wrote are the state before the first commit.

Commit files are created exclusively, so of two writers that start from one state the second fails with ``Conflict``. Object stores
without exclusive creation let the last writer win.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

_COMMITS = "_commits"
#: Older states that stay readable for plans that began with them.
KEPT = 3


class Conflict(RuntimeError):
    """Another writer has committed since the state was read."""


@dataclass(frozen=True)
class Snapshot:
    """A state of a path: its number (0 before the first commit), its folder, and whether there is anything to read."""

    number: int
    folder: str
    exists: bool


class _Folder:
    """A path of whatever file system the session resolves it to."""

    def __init__(self, spark: SparkSession, path: str):
        self.java = spark._jvm
        self.path = self.java.org.apache.hadoop.fs.Path(path)
        self.fs = self.path.getFileSystem(spark._jsc.hadoopConfiguration())

    def child(self, *names: str) -> object:
        path = self.path
        for name in names:
            path = self.java.org.apache.hadoop.fs.Path(path, name)
        return path

    def names(self, path: object) -> list[str]:
        return sorted(s.getPath().getName() for s in self.fs.listStatus(path)) if self.fs.exists(path) else []

    def commits(self) -> dict[int, str]:
        """Folder names by number; a commit whose name was never written doesn't count."""
        found = {}
        for name in self.names(self.child(_COMMITS)):
            if name.isdigit():
                stream = self.fs.open(self.child(_COMMITS, name))
                found[int(name)] = self.java.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
                stream.close()
        return found

    def commit(self, number: int, folder: str) -> None:
        try:
            stream = self.fs.create(self.child(_COMMITS, f"{number:020d}"), False)
        except Py4JJavaError as error:
            if "FileAlreadyExistsException" in str(error.java_exception):
                raise Conflict(f"{self.path} has a commit {number} already") from None
            raise
        stream.write(bytearray(folder, "utf-8"))
        stream.close()


def latest(spark: SparkSession, path: str) -> Snapshot:
    folder = _Folder(spark, path)
    commits = {n: name for n, name in folder.commits().items() if name}
    if commits:
        number = max(commits)
        return Snapshot(number, folder.child(commits[number]).toString(), True)
    found = [n for n in folder.names(folder.path) if n != _COMMITS and not n.startswith("snapshot-")] if folder.fs.exists(folder.path) else []
    return Snapshot(0, path, bool(found) or "*" in path)


def replace(spark: SparkSession, path: str, write: Callable[[str], None], base: Snapshot | None = None) -> int:
    """Commits what ``write`` puts into the folder that it is given, and returns the number of the new state.

    With ``base`` the write counts only if nothing was committed after that state. A write that fails leaves nothing behind.
    """
    folder = _Folder(spark, path)
    name = f"snapshot-{uuid.uuid4()}"
    try:
        write(folder.child(name).toString())
        commits = folder.commits()
        if base and max((n for n, named in commits.items() if named), default=0) != base.number:
            raise Conflict(f"{path} has changed since state {base.number}")
        number = max(commits, default=0) + 1
        folder.commit(number, name)
    except BaseException:
        folder.fs.delete(folder.child(name), True)
        raise
    _drop_old(folder, number)
    return number


def _drop_old(folder: _Folder, number: int) -> None:
    """Deletes states that more than ``KEPT`` commits have followed, the plain files before the first commit included."""
    for old, name in folder.commits().items():
        if old < number - KEPT:
            if name:
                folder.fs.delete(folder.child(name), True)
            folder.fs.delete(folder.child(_COMMITS, f"{old:020d}"), False)
    if number > KEPT:
        for name in folder.names(folder.path):
            if name != _COMMITS and not name.startswith("snapshot-"):
                folder.fs.delete(folder.child(name), True)
