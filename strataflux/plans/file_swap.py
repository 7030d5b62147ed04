"""Put staged files in the place of exactly the files they were made from.

Files are noted with length and time before they are read. To swap a folder, the staged files are
moved in and then the noted ones removed, which are steps of the file system alone: no row is written
twice. Files that others add meanwhile are not touched. Where noted files have gone or changed before
the swap began, another writer has replaced the rows the staged ones were made from, so
the folder stays as it is and is told to the caller. A swap that broke off goes on where it stopped; between the
two steps rows show twice, and none is ever missing.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import LongType, StringType, StructField, StructType

from strataflux.sources.tables import no_rows, read_dataset

NOTED = StructType(
    [
        StructField("folder", StringType()),
        StructField("name", StringType()),
        StructField("length", LongType()),
        StructField("modified", LongType()),
    ]
)
AT_ONCE = 16


@dataclass(frozen=True)
class FileSwap:
    """One swap in the dataset at ``path``; ``state`` is a folder of its own until it is finished.

    Folders are named by their place below ``path``, ``""`` being ``path`` itself.
    """

    spark: SparkSession
    path: str
    state: str

    @property
    def staged(self) -> str:
        """Where the new rows are to be written, in the layout of the dataset."""
        return f"{self.state}/rows"

    @property
    def _noted(self) -> str:
        return f"{self.state}/files"

    @cached_property
    def _new_path(self):
        """Looked up once: each part of such a name is a call to the JVM, and every file takes several paths."""
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path

    @cached_property
    def _file_system(self):
        return self._at(self.path).getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _at(self, *parts: str):
        return self._new_path("/".join(part for part in parts if part))

    def _system(self):
        return self._file_system

    def _files_in(self, root: str, folder: str) -> dict[str, tuple[int, int]]:
        """Name, length and time of the data files of one folder."""
        system, place = self._system(), self._at(root, folder)
        if not system.exists(place):
            return {}
        listed = [status for status in system.listStatus(place) if status.isFile()]
        found = {status.getPath().getName(): (status.getLen(), status.getModificationTime()) for status in listed}
        return {name: fact for name, fact in found.items() if name[0] not in "_."}

    def _staged_files(self) -> dict[str, list[str]]:
        """Names of the staged data files by folder, folders of one depth listed at once."""
        system, found = self._system(), defaultdict(list)
        if not system.exists(self._at(self.staged)):
            return found

        def listed(folder: str) -> list[tuple[str, str, bool]]:
            statuses = system.listStatus(self._at(self.staged, folder))
            return [(folder, status.getPath().getName(), status.isDirectory()) for status in statuses]

        level = [""]
        with ThreadPoolExecutor(AT_ONCE) as pool:
            while level:
                entries = [entry for part in pool.map(listed, level) for entry in part]
                level = [f"{folder}/{name}".lstrip("/") for folder, name, is_folder in entries if is_folder]
                for folder, name, is_folder in entries:
                    if not is_folder and name[0] not in "_.":
                        found[folder].append(name)
        return found

    def begin(self, folders: Iterable[str], schema: StructType) -> DataFrame:
        """Note the files of some folders and read exactly those."""
        return self.begin_files([(folder, None) for folder in folders], schema)

    def begin_files(self, wanted: Iterable[tuple[str, str | None]], schema: StructType) -> DataFrame:
        """As ``begin``, for (folder, name); a name of None stands for all files of its folder."""
        self.clear()
        names = defaultdict(set)
        for folder, name in wanted:
            names[folder].add(name)
        with ThreadPoolExecutor(AT_ONCE) as pool:
            listed = zip(names, pool.map(lambda folder: self._files_in(self.path, folder), names), strict=True)
        noted = [
            (folder, name, *fact)
            for folder, files in listed
            for name, fact in sorted(files.items())
            if None in names[folder] or name in names[folder]
        ]
        self.spark.createDataFrame(noted, NOTED).coalesce(1).write.mode("overwrite").parquet(self._noted)
        if not noted:
            return no_rows(self.spark, schema)
        # Paths are read as patterns.
        paths = [re.sub(r"([{}\[\]*?\\])", r"\\\1", self._at(self.path, row[0], row[1]).toString()) for row in noted]
        return self.spark.read.schema(schema).option("basePath", self.path).parquet(*paths)

    def ready(self) -> None:
        """Note that everything is staged, where no log of the caller's says so."""
        self._system().create(self._at(self.state, "_ready"), True).close()

    def resume(self) -> list[str]:
        """Finish a swap that broke off after it was ready; one that was not has changed nothing."""
        return self.finish() if self._system().exists(self._at(self.state, "_ready")) else []

    def finish(self) -> list[str]:
        """Swap what is staged; the folders that others have changed, which stay as they are."""
        system = self._system()
        noted, staged = defaultdict(dict), self._staged_files()
        for row in read_dataset(self.spark, self._noted, NOTED).collect():
            noted[row["folder"]][row["name"]] = (row["length"], row["modified"])

        def swap(folder: str) -> bool:
            if folder and not noted[folder] and not system.exists(self._at(self.path, folder)):
                # Nothing to put it beside, so it moves as a whole.
                parent = folder.rpartition("/")[0]
                system.mkdirs(self._at(self.path, parent))
                self._move(system, parent, folder.rpartition("/")[2])
                return True
            here = self._files_in(self.path, folder)
            left = [name for name, fact in noted[folder].items() if here.get(name) == fact]
            if staged[folder] and len(left) < len(noted[folder]):
                return False
            system.mkdirs(self._at(self.path, folder))
            for name in staged[folder]:
                self._move(system, folder, name)
            for name in left:
                system.delete(self._at(self.path, folder, name), False)
            return True

        folders = sorted({*noted, *staged})
        for folder in folders:
            noted[folder], staged[folder]
        with ThreadPoolExecutor(AT_ONCE) as pool:
            swapped = list(pool.map(swap, folders))
        self.spark.catalog.refreshByPath(self.path)
        self.clear()
        return [folder for folder, done in zip(folders, swapped, strict=True) if not done]

    def _move(self, system, folder: str, name: str) -> None:
        source, target = self._at(self.staged, folder, name), self._at(self.path, folder, name)
        if not system.rename(source, target):
            raise OSError(f"{source.toString()} could not be moved to {target.toString()}")

    def clear(self) -> None:
        self._system().delete(self._at(self.state), True)


def places_of(spark: SparkSession, path: str, files: Sequence[str]) -> list[tuple[str, str]]:
    """(folder, name) below a dataset's path of files named by URIs, as the rows' metadata have them."""
    jvm, context = spark.sparkContext._jvm, spark.sparkContext._jsc
    new_path = jvm.org.apache.hadoop.fs.Path
    root = new_path(path)
    root_text = root.getFileSystem(context.hadoopConfiguration()).makeQualified(root).toUri().getPath().rstrip("/")
    found = []
    for file in files:
        inside = new_path(jvm.java.net.URI(file)).toUri().getPath().removeprefix(root_text).lstrip("/")
        folder, _, name = inside.rpartition("/")
        found.append((folder, name))
    return found
