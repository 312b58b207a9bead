"""Where a run keeps its layers, and its record of the stages that are done.

A stage is known by its name and a fingerprint of what it was made from: the landing listing, the options, and
the fingerprints of the stages before it. Its layer is written to a new folder or table, and one row is then
added to the record (``run_manifest``, a table, or a folder with a small file for each): stage, fingerprint, target,
schema, time. Only recorded layers are read, so
a run that was killed goes on behind the last recorded stage, whatever files the unfinished one left; the
same run again writes nothing.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import json
import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from strata.sinks.tables import write_table
from strata.sources.tables import is_folder, read_table

_ENTRY = "stage string, fingerprint string, target string, schema string, done_at timestamp_ntz"


def fingerprint(*parts: object) -> str:
    return hashlib.sha256(json.dumps([str(part) for part in parts]).encode()).hexdigest()[:32]


class RunStore:
    """Layers below ``store``, a folder or a catalog database."""

    def __init__(self, spark: SparkSession, store: str):
        self.spark, self.store = spark, store
        self.manifest = self.target("run_manifest")
        self._entries = self._read()

    def target(self, name: str) -> str:
        return f"{self.store.rstrip('/')}/{name}" if is_folder(self.store) else f"{self.store}.{name}"

    def _read(self) -> dict[tuple[str, str], tuple[str, str]]:
        """Target and schema by stage and fingerprint: as many as the stages of the runs."""
        try:
            if is_folder(self.manifest):
                record = self.spark.read.schema(_ENTRY).json(self.manifest)
            else:
                record = read_table(self.spark, self.manifest)
            rows = record.orderBy("done_at").collect()
        except AnalysisException:
            return {}
        entries: dict[tuple[str, str], tuple[str, str]] = {}
        for row in rows:
            # In the order of their last record.
            entries.pop((row.stage, row.fingerprint), None)
            entries[row.stage, row.fingerprint] = (row.target, row.schema)
        return entries

    def latest(self, stage: str) -> str | None:
        """The fingerprint of the version of a stage that was recorded last."""
        found = [mark for name, mark in self._entries if name == stage]
        return found[-1] if found else None

    def done(self, stage: str, mark: str) -> DataFrame | None:
        """The recorded layer of a stage, unless a later version took the place of its table."""
        target, schema = self._entries.get((stage, mark), (None, ""))
        at_target = [key for key, (other, _) in self._entries.items() if other == target]
        if target is None or at_target[-1] != (stage, mark):
            return None
        return read_table(self.spark, target, StructType.fromJson(json.loads(schema)))

    def layer(self, stage: str, mark: str, rows: Callable[[], DataFrame]) -> DataFrame:
        """The recorded layer, or that of ``rows``, written and recorded now. ``rows`` is only called for
        a stage that is not done."""
        stored = self.done(stage, mark)
        if stored is not None:
            return stored
        made = rows()
        target = self.target(stage)
        if is_folder(target):
            # A folder is written once: another version, or one that was not finished, keeps the plain name.
            target = target if self._is_free(target) else f"{target}-{uuid.uuid4().hex[:12]}"
        write_table(made, target)
        self._record(stage, mark, target, made.schema)
        return self.done(stage, mark)

    def _is_free(self, folder: str) -> bool:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        return not path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)

    def _write_file(self, line: str) -> None:
        """A file of the record, under a name that readers leave out until it is whole."""
        path, name = self.spark._jvm.org.apache.hadoop.fs.Path, f"{uuid.uuid4().hex}.json"
        unfinished, finished = path(self.manifest, f"_{name}"), path(self.manifest, name)
        files = finished.getFileSystem(self.spark._jsc.hadoopConfiguration())
        out = files.create(unfinished, False)
        try:
            out.write(bytearray(line.encode()))
        finally:
            out.close()
        if not files.rename(unfinished, finished):
            raise OSError(f"{unfinished} cannot be renamed")

    def _record(self, stage: str, mark: str, target: str, schema: StructType) -> None:
        entry = (stage, mark, target, schema.json(), dt.datetime.now(dt.timezone.utc).replace(tzinfo=None))
        if is_folder(self.manifest):
            self._write_file(json.dumps(dict(zip(StructType.fromDDL(_ENTRY).names, entry)), default=str))
        else:
            rows = self.spark.createDataFrame([entry], _ENTRY).coalesce(1)
            if self.spark.catalog.tableExists(self.manifest):
                rows.write.mode("append").insertInto(self.manifest)
            else:
                write_table(rows, self.manifest)
        self._entries.pop((stage, mark), None)
        self._entries[stage, mark] = (target, schema.json())
