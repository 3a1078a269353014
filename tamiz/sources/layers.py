"""Layers: tables that change together. Each release of a layer is one small file, put last.

Rows of a table lie in one folder for each release that wrote some of them (``<table>/carga_n=<number>``). A file
``_releases/<number>.json`` says for every table which of these folders hold its rows now, and the highest number
counts. Until a release's file is there, readers see the one before, whole; a job that is lost half-way
leaves nothing that anybody reads. A layer has one writer at a time and any number of readers.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tamiz.sources.tables import files_of, laid_out, remove, rows_of_new_periods

Tables = dict[str, DataFrame]

RELEASES, LOAD = "_releases", "carga_n"
JOBS_AT_ONCE = 4
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def concurrently(work: Callable, tables: dict) -> list:
    """Results of ``work(name, value)`` in order; the first failure is raised."""
    with ThreadPoolExecutor(JOBS_AT_ONCE) as pool:
        return list(pool.map(lambda item: work(*item), tables.items()))


class Layer:
    """Tables of one layer below a common folder. ``partitions`` names the columns a table's files are laid out by;
    ``keep`` releases stay readable."""

    def __init__(self, spark: SparkSession, folder: str, partitions: dict[str, Sequence[str]] | None = None, keep: int = 2):
        self.spark, self.folder, self.partitions, self.keep = spark, folder.rstrip("/"), partitions or {}, keep

    def releases(self) -> list[int]:
        return sorted(int(name.removesuffix(".json")) for name in _listed(self.spark, f"{self.folder}/{RELEASES}") if name.endswith(".json"))

    def current(self, number: int | None = None) -> tuple[int, dict[str, list[int]]]:
        """Number of the newest release (or of the one asked for), and the loads each table consists of."""
        numbers = self.releases() if number is None else [number]
        if not numbers:
            return 0, {}
        return numbers[-1], json.loads(_text(self.spark, self._pointer(numbers[-1])))

    def _pointer(self, number: int) -> str:
        return f"{self.folder}/{RELEASES}/{number:012d}.json"

    def folders(self, name: str) -> list[str]:
        """Folders that hold a table's rows."""
        loads = self.current()[1].get(name)
        if loads is None:
            raise LookupError(f"{self.folder} has no table {name}")
        return [f"{self.folder}/{name}/{LOAD}={n}" for n in loads]

    def get(self, name: str, schema: T.StructType | None = None) -> DataFrame:
        return self._read(name, self.folders(name), schema)

    def _read(self, name: str, folders: list[str], schema: T.StructType | None) -> DataFrame:
        reader = self.spark.read.schema(schema) if schema else self.spark.read
        if len(folders) == 1:
            rows = reader.parquet(folders[0])
        else:
            rows = reader.option("basePath", f"{self.folder}/{name}").parquet(*folders).drop(LOAD)
        return rows.select([F.col(f"`{f.name}`") for f in schema.fields]) if schema else rows

    def latest(self, name: str, period: str, schema: T.StructType | None = None) -> DataFrame:
        """Rows of a table's highest period, a column its files are laid out by. The folders say which it is,
        so no row is read to find it and only that period's files are opened."""
        rows = self.get(name, schema)
        found = [v for folder in self.folders(name) for v in partition_values(self.spark, folder, period)]
        if not found:
            return rows.where(F.lit(False))
        kind = rows.schema[period].dataType
        if isinstance(kind, T.StringType):
            return rows.where(F.col(period) == max(found))
        # typed by Spark, so that 10 comes after 9
        return rows.where(F.col(period) == F.lit(max(found, key=float) if isinstance(kind, T.NumericType) else max(found)).cast(kind))

    @contextmanager
    def release(self) -> Iterator[Release]:
        """Tables written inside the block become visible together when it ends, and not at all if it fails."""
        new = Release(self)
        yield new
        new.publish()

    def put(self, name: str, df: DataFrame) -> DataFrame:
        return self.put_all({name: df})[name]

    def put_all(self, tables: Tables) -> Tables:
        """Write tables that do not depend on each other, as concurrent jobs and one release."""
        with self.release() as new:
            return new.put_all(tables)

    def put_filled(self, tables: Tables) -> Tables:
        """As :meth:`put_all`, leaving alone the tables that have no rows to load."""
        with self.release() as new:
            return new.put_filled(tables)

    def append_periods(self, name: str, rows: DataFrame, period: str) -> DataFrame:
        with self.release() as new:
            return new.append_periods(name, rows, period)

    def vacuum(self) -> None:
        """Delete what none of the last ``keep`` releases refers to."""
        numbers = self.releases()
        kept = numbers[-self.keep :]
        used = {(name, n) for number in kept for name, loads in self.current(number)[1].items() for n in loads}
        for name in {t for number in numbers for t in self.current(number)[1]}:
            for folder in _listed(self.spark, f"{self.folder}/{name}"):
                n = int(folder.removeprefix(f"{LOAD}=")) if folder.startswith(f"{LOAD}=") else None
                if n is not None and n <= numbers[-1] and (name, n) not in used:
                    remove(self.spark, f"{self.folder}/{name}/{folder}")
        for number in numbers[: -self.keep]:
            remove(self.spark, self._pointer(number))


class Release:
    """The next release of a layer, seen by nobody but its maker until :meth:`publish`."""

    def __init__(self, layer: Layer):
        self.layer = layer
        before, self.tables = layer.current()
        self.number = before + 1

    def get(self, name: str, schema: T.StructType | None = None) -> DataFrame:
        """A table as this release will have it."""
        folders = [f"{self.layer.folder}/{name}/{LOAD}={n}" for n in self.tables[name]]
        return self.layer._read(name, folders, schema)

    def _write(self, name: str, df: DataFrame) -> DataFrame:
        if self.tables.get(name, [0])[-1] == self.number:
            raise ValueError(f"{name} is written twice in one release")
        by = self.layer.partitions.get(name, ())
        folder = f"{self.layer.folder}/{name}/{LOAD}={self.number}"
        # a release that was lost may have left files of the same number
        laid_out(df, by).write.mode("overwrite").partitionBy(*by).parquet(folder)
        return self.layer._read(name, [folder], df.schema)

    def put(self, name: str, df: DataFrame) -> DataFrame:
        """Replace a table."""
        stored = self._write(name, df)
        self.tables[name] = [self.number]
        return stored

    def put_all(self, tables: Tables) -> Tables:
        return dict(zip(tables, concurrently(self.put, tables)))

    def put_filled(self, tables: Tables) -> Tables:
        def put(name: str, df: DataFrame) -> DataFrame | None:
            stored = self._write(name, df)
            if stored.isEmpty():
                return None
            self.tables[name] = [self.number]
            return stored

        loaded = zip(tables, concurrently(put, tables))
        return {name: df for name, df in loaded if df is not None}

    def append_periods(self, name: str, rows: DataFrame, period: str) -> DataFrame:
        """Add the periods the table lacks; what it holds is not written again."""
        existing = self.get(name, rows.schema)
        if not self._write(name, rows_of_new_periods(rows, existing, period)).isEmpty():
            self.tables[name] = [*self.tables[name], self.number]
        return self.get(name, rows.schema)

    def publish(self) -> None:
        layer = self.layer
        _put_text(layer.spark, layer._pointer(self.number), json.dumps(self.tables, sort_keys=True))
        layer.vacuum()


def partition_values(spark: SparkSession, folder: str, column: str) -> list[str]:
    """Values of the first column a folder's files are laid out by, from the names of its folders; NULL is left out."""
    start = f"{column}="
    found = [unquote(name.removeprefix(start)) for name in _listed(spark, folder) if name.startswith(start)]
    return [v for v in found if v != NULL_PARTITION]


def _listed(spark: SparkSession, folder: str) -> list[str]:
    files, to_path = files_of(spark, folder)
    return [s.getPath().getName() for s in files.listStatus(to_path(folder))] if files.exists(to_path(folder)) else []


def _text(spark: SparkSession, path: str) -> str:
    files, to_path = files_of(spark, path)
    stream = files.open(to_path(path))
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _put_text(spark: SparkSession, path: str, text: str) -> None:
    """A file that is there as a whole or not at all."""
    files, to_path = files_of(spark, path)
    if files.exists(to_path(path)):
        raise FileExistsError(f"{path}: another writer was first")
    draft = to_path(f"{path}.draft")
    stream = files.create(draft, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if not files.rename(draft, to_path(path)):
        raise OSError(f"{path} could not be put in place")
