"""A set of reports that readers see change as one.

Reports are written to a staging folder beside the published one. Each that is finished has an entry
in the staging folder's manifest, with its number of rows and columns, so that a run that was
broken off goes on after the last finished report. When all are there the folders change places, by
two renames: the published folder becomes the previous one, staging the published one. A run
that ends between the two is completed by the next. Renames of folders are single steps in local
file systems and HDFS; a store that copies instead needs a table format.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from tourledger.sources.publish import publish

#: A file in each report's folder with what was written; Spark leaves such names out when it reads.
ENTRY = "_entry.json"
#: A file in the staging folder with what the run is about.
RUN = "_run.json"
#: A file in the published folder with all entries.
MANIFEST = "_manifest.json"


class Files:
    """Small files and folders in any store that Spark can write to."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._system = self._path(folder).getFileSystem(spark._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        return self._system.exists(self._path(path))

    def rename(self, old: str, new: str) -> None:
        if not self._system.rename(self._path(old), self._path(new)):
            raise OSError(f"{old} could not be renamed to {new}")

    def remove(self, path: str) -> None:
        self._system.delete(self._path(path), True)

    def read(self, path: str) -> str | None:
        if not self.exists(path):
            return None
        stream = self._system.open(self._path(path))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def write(self, path: str, text: str) -> None:
        """The file appears whole: it is written under another name first."""
        stream = self._system.create(self._path(f"{path}.part"), True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        self.remove(path)
        self.rename(f"{path}.part", path)


class Release:
    """One run's reports on their way to ``out``.

    ``about`` says what decides the reports, such as input paths and dates. A staging folder that is
    about something else is started anew.
    """

    def __init__(self, spark: SparkSession, out: str, about: Mapping[str, str]) -> None:
        self.spark = spark
        self.out = out.rstrip("/")
        self.staging, self.previous = f"{self.out}.staging", f"{self.out}.previous"
        self.files = Files(spark, self.out)
        self._complete()
        wanted = json.dumps(dict(sorted(about.items())))
        if self.files.read(f"{self.staging}/{RUN}") != wanted:
            self.files.remove(self.staging)
            self.files.write(f"{self.staging}/{RUN}", wanted)

    def _complete(self) -> None:
        """Finish a change of folders that was broken off between its two renames."""
        if self.files.exists(self.out):
            return
        if self.files.exists(f"{self.staging}/{MANIFEST}"):
            self.files.rename(self.staging, self.out)
        elif self.files.exists(self.previous):
            self.files.rename(self.previous, self.out)

    def entry(self, name: str) -> dict | None:
        """What the staging folder has of a report, if it is finished."""
        text = self.files.read(f"{self.staging}/{name}/{ENTRY}")
        return None if text is None else json.loads(text)

    def add(self, name: str, report: Callable[[], DataFrame], single_file: bool = True) -> bool:
        """Write a report unless it is finished; whether it was written.

        Its rows are counted in what was written, so that the manifest tells what readers get.
        """
        if self.entry(name) is not None:
            return False
        path = f"{self.staging}/{name}"
        df = publish(report(), path, single_file)
        written = self.spark.read.option("header", True).option("escape", '"').option("multiLine", True).csv(path)
        entry = {"report": name, "rows": written.count() if written.columns else 0, "columns": written.columns}
        if entry["columns"] and len(entry["columns"]) > len(df.columns):
            raise OSError(f"{path} has columns that the report has not")
        self.files.write(f"{path}/{ENTRY}", json.dumps(entry))
        return True

    def switch(self, names: list[str]) -> None:
        """Publish the reports of ``names``, all of which must be finished."""
        entries = {name: self.entry(name) for name in names}
        if missing := [name for name, entry in entries.items() if entry is None]:
            raise ValueError(f"not finished: {', '.join(missing)}")
        self.files.write(f"{self.staging}/{MANIFEST}", json.dumps(list(entries.values()), indent=1))
        self.files.remove(self.previous)
        if self.files.exists(self.out):
            self.files.rename(self.out, self.previous)
        self.files.rename(self.staging, self.out)
        self.files.remove(self.previous)


def manifest(spark: SparkSession, out: str) -> dict[str, int]:
    """The reports published in ``out`` and their numbers of rows; empty where none are."""
    text = Files(spark, out).read(f"{out.rstrip('/')}/{MANIFEST}")
    return {} if text is None else {entry["report"]: entry["rows"] for entry in json.loads(text)}
