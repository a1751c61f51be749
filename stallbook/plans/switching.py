"""Publishing a run as a whole: all outputs are written beside the old ones and then switched.

Outputs are written into a staging folder within the output folder. Only when all are there do they take the old ones'
places: the old metadata goes first and the new metadata comes last, so whoever finds metadata finds a whole run.
What is replaced is kept in the staging folder until then. A failure, at any step, puts it back. If the driver
itself is lost half way, metadata is missing and the next run puts the old outputs back before it begins.
Other files in the output folder are never touched.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession

STAGING = "_staging-"
REPLACED = "_replaced"
REPLACES_INPUT = "An output would replace the input."


class Folder:
    """An output folder, of whatever file system its path names."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm = spark._jvm.org.apache.hadoop.fs
        self._conf = spark._jsc.hadoopConfiguration()
        self.path = path.rstrip("/")
        self._files = self._path(self.path).getFileSystem(self._conf)

    def _path(self, path: str):
        return self._jvm.Path(path)

    def at(self, *names: str) -> str:
        return "/".join([self.path, *names])

    def exists(self, *names: str) -> bool:
        return self._files.exists(self._path(self.at(*names)))

    def names(self, *names: str) -> list[str]:
        if not self.exists(*names):
            return []
        return sorted(status.getPath().getName() for status in self._files.listStatus(self._path(self.at(*names))))

    def make(self, *names: str) -> None:
        self._files.mkdirs(self._path(self.at(*names)))

    def move(self, old: list[str], new: list[str]) -> None:
        if not self._files.rename(self._path(self.at(*old)), self._path(self.at(*new))):
            raise OSError(f"{self.at(*old)} could not be moved to {self.at(*new)}.")

    def delete(self, *names: str) -> None:
        self._files.delete(self._path(self.at(*names)), True)

    def absolute(self, path: str) -> str:
        """path with its file system and without dots, up to the first wildcard."""
        fixed = path
        for sign in "*?[{":
            fixed = fixed.split(sign, 1)[0]
        if fixed != path:
            fixed = fixed.rsplit("/", 1)[0] or "/"
        named = self._path(fixed.rstrip("/") or "/")
        files = named.getFileSystem(self._conf)
        uri = files.makeQualified(named).toUri().normalize()
        return f"{uri.getScheme()}://{uri.getAuthority() or ''}{uri.getPath()}".rstrip("/")


def require_apart(folder: Folder, source: str, names: list[str]) -> None:
    """Fail if the source is, holds or lies in one of the outputs."""
    read = folder.absolute(source)
    for name in names:
        output = folder.absolute(folder.at(name))
        if f"{read}/".startswith(f"{output}/") or f"{output}/".startswith(f"{read}/"):
            raise ValueError(REPLACES_INPUT)


def recover(folder: Folder, metadata: str) -> None:
    """Undo what a lost driver left: without metadata the outputs that were set aside go back."""
    for staging in folder.names():
        if staging.startswith(STAGING):
            if not folder.exists(metadata):
                _put_back(folder, staging, metadata)
            folder.delete(staging)


def _put_back(folder: Folder, staging: str, metadata: str) -> None:
    # Metadata last here too: until all else is back the run counts as broken, and this can be done again.
    for name in sorted(folder.names(staging, REPLACED), key=lambda name: name == metadata):
        if folder.exists(name):
            folder.delete(name)
        folder.move([staging, REPLACED, name], [name])


def publish(folder: Folder, writers: dict[str, Callable[[str], None]], metadata: str, at_once: int) -> None:
    """Write all outputs, each by its writer, which is given the folder to write into, and switch to them."""
    recover(folder, metadata)
    staging = f"{STAGING}{uuid.uuid4().hex}"
    folder.make(staging, REPLACED)
    switched: list[str] = []
    try:
        with ThreadPoolExecutor(at_once) as pool:
            list(pool.map(lambda write: write(folder.at(staging)), writers.values()))
        names = [name for name in writers if name != metadata]
        for name in [metadata, *names]:
            if folder.exists(name):
                folder.move([name], [staging, REPLACED, name])
        for name in [*names, metadata]:
            folder.move([staging, name], [name])
            switched.append(name)
    except BaseException:
        for name in switched:
            folder.delete(name)
        _put_back(folder, staging, metadata)
        raise
    finally:
        folder.delete(staging)
