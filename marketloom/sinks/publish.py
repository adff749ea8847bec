"""Putting written data in place of a table, or of some of its days, with recovery.

Data is first written whole to a staged folder beside the table. A log in that folder,
which appears by one rename, says what is to happen; from then on the publication counts as
done, and whoever finds the log finishes it: :func:`recover` runs before every load. A stop
before the log leaves the table as it was, a stop after it the new table, and each step can
be repeated. One writer at a time may work on a table; readers that start while days are
being moved see some of them old and some new.

Beside a table ``t`` there may be ``t--new-…`` (staged, with or without log), ``t--old-…``
(the table that is being replaced) and ``t--updates-…`` (input of an upsert).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import SparkSession

LOG = "_publish.json"
NEW, OLD, UPDATES = "new", "old", "updates"

#: Called with the name of each step before it is taken; tests stop the writer there.
Step = Callable[[str], None]


def beside(path: str, what: str) -> str:
    """A new folder next to the table, on the same file system."""
    return f"{path.rstrip('/')}--{what}-{uuid.uuid4().hex}"


class Files:
    """The operations on a file system that publishing needs; failures raise."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm = spark._jvm
        self._fs = self._path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def delete(self, path: str) -> None:
        if not self._fs.delete(self._path(path), True) and self.exists(path):
            raise OSError(f"cannot delete {path}")

    def move(self, source: str, target: str) -> None:
        """Rename to a name that is free; its parent is made where it lacks."""
        place = self._path(target)
        if self._fs.exists(place):
            raise OSError(f"cannot move {source}: {target} exists")
        self._fs.mkdirs(place.getParent())
        if not self._fs.rename(self._path(source), place):
            raise OSError(f"cannot move {source} to {target}")

    def names(self, path: str) -> list[str]:
        if not self.exists(path):
            return []
        return sorted(status.getPath().getName() for status in self._fs.listStatus(self._path(path)))

    def has_data(self, path: str) -> bool:
        if not self.exists(path):
            return False
        found = self._fs.listFiles(self._path(path), True)
        while found.hasNext():
            if found.next().getPath().getName().endswith(".parquet"):
                return True
        return False

    def mean_size(self, path: str) -> float:
        """Mean bytes of the files below a folder, 0 without any."""
        if not self.exists(path):
            return 0
        found = self._fs.getContentSummary(self._path(path))
        return found.getLength() / max(1, found.getFileCount())

    def read(self, path: str) -> str:
        stream = self._fs.open(self._path(path))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, path: str, text: str) -> None:
        """Make a file that is either not there or whole."""
        unfinished = f"{path}.{uuid.uuid4().hex}"
        stream = self._fs.create(self._path(unfinished), True)
        try:
            stream.writeBytes(text)  # the text is ASCII
        finally:
            stream.close()
        self.move(unfinished, path)


def siblings(files: Files, path: str, what: str) -> list[str]:
    """Folders of one kind beside a table."""
    parent, _, name = path.rstrip("/").rpartition("/")
    return [f"{parent}/{n}" for n in files.names(parent) if n.startswith(f"{name}--{what}-")]


def publish_table(spark: SparkSession, staged: str, path: str, step: Step | None = None) -> None:
    """Put a staged folder in place of the table."""
    _logged(Files(spark, path), staged, path, {"whole": True}, step)


def publish_parts(
    spark: SparkSession, staged: str, path: str, touched: Iterable[str], step: Step | None = None
) -> None:
    """Put the staged partition folders in place of the table's; touched ones that are not
    staged have lost all their rows and are removed."""
    files = Files(spark, path)
    put = [name for name in files.names(staged) if "=" in name]
    gone = sorted(set(touched) - set(put))
    _logged(files, staged, path, {"whole": False, "put": put, "gone": gone}, step)


def _logged(files: Files, staged: str, path: str, what: dict, step: Step | None) -> None:
    step = step or (lambda _name: None)
    step("log")
    files.write(f"{staged}/{LOG}", json.dumps(what))
    _finish(files, staged, path, step)


def _finish(files: Files, staged: str, path: str, step: Step) -> None:
    """Do what the log says; steps that were taken before are passed over."""
    what = json.loads(files.read(f"{staged}/{LOG}"))
    if what["whole"]:
        if files.exists(path):
            step("set the table aside")
            files.move(path, beside(path, OLD))
        step("move the table")
        files.move(staged, path)
        step("remove the log")
        files.delete(f"{path}/{LOG}")
    else:
        for name in what["put"]:
            if files.exists(f"{staged}/{name}"):
                step(f"remove {name}")
                files.delete(f"{path}/{name}")
                step(f"move {name}")
                files.move(f"{staged}/{name}", f"{path}/{name}")
        for name in what["gone"]:
            step(f"remove {name}")
            files.delete(f"{path}/{name}")
        step("remove the staged folder")
        files.delete(staged)
    for old in siblings(files, path, OLD):
        step("remove the old table")
        files.delete(old)


def recover(spark: SparkSession, path: str, step: Step | None = None) -> str | None:
    """Bring a table into the state that an interrupted writer was making, or had found.

    Gives what was done: ``finished`` a logged publication, ``restored`` a table that had
    been set aside, ``cleaned`` remains, or None where there was nothing to do.
    """
    step = step or (lambda _name: None)
    files, done = Files(spark, path), None
    for staged in siblings(files, path, NEW):
        if files.exists(f"{staged}/{LOG}"):
            _finish(files, staged, path, step)
            done = "finished"
        else:
            files.delete(staged)
            done = done or "cleaned"
    if files.exists(f"{path}/{LOG}"):  # stopped after the move
        files.delete(f"{path}/{LOG}")
        done = "finished"
    aside = siblings(files, path, OLD)
    if aside and not files.exists(path):
        files.move(aside.pop(), path)
        done = "restored"
    for remains in aside + siblings(files, path, UPDATES):
        files.delete(remains)
        done = done or "cleaned"
    return done
