"""CSV and Parquet tables."""

from __future__ import annotations

from functools import reduce
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.columns import quoted, require, update_cells
from .quoted_lines import records

_NEVER = "\u0000"


def string_schema(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def read_contacts(
    spark: SparkSession, path: str | list[str], names: list[str] | None = None, header: bool = True,
    multi_line: bool = True, in_pieces: bool = False,
) -> DataFrame:
    """A CSV file or folder as strings, with blank cells as ``''``; columns go by their header.

    Several paths may differ in columns and order: each is read by its own header, and what a path
    lacks is blank. Files of one folder must have one header, else reading them is an error. With a
    header ``names`` picks columns; files without one need ``names``, which then go by place.

    Quoted fields may hold commas, doubled quotes and line breaks. With line breaks a file is one task's work, unless
    ``in_pieces`` is set: many tasks then share a file, which must have quotes around cells only
    (``quoted_lines.records``) and comes back in no order. Without line breaks set ``multi_line`` to false, which also splits files.
    """
    if isinstance(path, list):
        parts = [read_contacts(spark, p, None if header else names, header, multi_line, in_pieces) for p in path]
        df = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts).na.fill("")
        return _picked(df, names) if header and names else df
    reader = (
        spark.read.option("header", header)
        .option("multiLine", multi_line)
        .option("escape", '"')
        .option("nullValue", _NEVER)
        .option("emptyValue", "")
        .option("encoding", "UTF-8")
        .option("enforceSchema", False)
    )
    if not header and names:
        reader = reader.schema(string_schema(*names))
    elif header and spark.conf.get("spark.sql.caseSensitive") != "true":
        top = (
            spark.read.option("multiLine", multi_line).option("escape", '"').csv(path).first()
        )
        lowered = [str(n).lower() for n in top] if top else []
        if len(set(lowered)) < len(lowered):
            raise ValueError(f"set spark.sql.caseSensitive=true before reading this header: {top}")
    df = reader.csv(path)
    if in_pieces:
        df = _from_records(records(spark, path), df.columns, header)
    df = df.na.fill("")
    return _picked(df, names) if header and names else df


def _from_records(rows: DataFrame, names: list[str], header: bool) -> DataFrame:
    """Cells of CSV records. With a header the first record of each file is left out, after a look whether all are the same."""
    places = [f"_{i}" for i in range(len(names) + 1)]  # one more shows a header that is longer
    options = {"escape": '"', "nullValue": _NEVER, "emptyValue": "", "multiLine": "true"}
    cells = F.from_csv("text", ", ".join(f"{c} string" for c in places), options)
    if header:
        top = (F.col("block") == 0) & (F.col("n") == 0)
        tops = [list(r[0]) for r in rows.where(top).select(cells).distinct().limit(2).collect()]
        if len(tops) > 1:
            raise ValueError(f"files with different headers: {tops}")
        rows = rows.where(~top)
    return rows.select(cells.alias("_")).select(*[F.col(f"_.{c}").alias(n) for c, n in zip(places, names)])


def _picked(df: DataFrame, names: list[str]) -> DataFrame:
    require(df, *names)
    return df.select(*[quoted(n) for n in names])


def write_csv(
    df: DataFrame, path: str, quote_all: bool = False, mode: str = "overwrite", header: bool = True
) -> None:
    """CSV that keeps cells as they are, outer blanks included."""
    df.write.mode(mode).options(
        header=header, quoteAll=quote_all, escape='"', emptyValue="",
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    ).csv(path)


def read_table(spark: SparkSession, name_or_path: str) -> DataFrame:
    """A table by name, or a Parquet folder by path."""
    if "/" in name_or_path:
        return spark.read.parquet(name_or_path)
    return spark.table(name_or_path)


def scan_pages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).select("page_id", "url", "html")


def append_results(df: DataFrame, path: str, schema: T.StructType) -> None:
    """Append with a fixed set of columns; the first append makes the table."""
    df.select(*[F.col(f.name).cast(f.dataType) for f in schema]).write.mode("append").parquet(path)


class TableFolder:
    """Tables below one folder that can be replaced while they are being read.

    A version is a manifest, the list of its data files, and counts once its number is in the commit list: a failed
    write leaves the old table in place, a table may be computed from itself, and versions share the files that did not
    change. The driver holds the list of files, not their rows. One writer per table at a time.
    """

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root

    def _commits(self, name: str) -> str:
        return f"{self.root}/{name}/commits"

    def _data(self, name: str, version: int) -> str:
        return f"{self.root}/{name}/data/version={version}"

    def _manifest(self, name: str, version: int) -> str:
        return f"{self.root}/{name}/manifests/version={version}"

    def version(self, name: str) -> int:
        """Number of the current version, 0 when there is none."""
        try:
            commits = self.spark.read.schema("version int").json(self._commits(name))
            return commits.agg(F.max("version")).first()[0] or 0
        except AnalysisException as gone:
            if "PATH_NOT_FOUND" not in str(gone):
                raise
            return 0

    def files(self, name: str, version: int | None = None) -> list[str]:
        """Data files of a version, the current one by default."""
        version = self.version(name) if version is None else version
        if not version:
            raise ValueError(f"no table {name!r}")
        rows = self.spark.read.schema("file string").json(self._manifest(name, version)).collect()
        return sorted(r.file for r in rows)

    def read(self, name: str, version: int | None = None) -> DataFrame:
        return self.spark.read.parquet(*self.files(name, version))

    def _commit(self, name: str, version: int, files: list[str]) -> None:
        manifest = self.spark.createDataFrame([(f,) for f in files], "file string").coalesce(1)
        manifest.write.mode("overwrite").json(self._manifest(name, version))
        self.spark.range(1).select(F.lit(version).alias("version")).write.mode("append").json(self._commits(name))

    def _write(self, name: str, version: int, df: DataFrame) -> list[str]:
        df.write.mode("overwrite").parquet(self._data(name, version))
        return [unquote(f) for f in self.spark.read.schema(df.schema).parquet(self._data(name, version)).inputFiles()]

    def replace(self, name: str, df: DataFrame, *by: str) -> DataFrame:
        """A new version; files hold ranges of the columns ``by``, so that updates by these touch few of them."""
        version = self.version(name) + 1
        rows = df.repartitionByRange(*[quoted(c) for c in by]).sortWithinPartitions(*[quoted(c) for c in by]) if by else df
        self._commit(name, version, self._write(name, version, rows))
        return self.read(name)

    def update(self, name: str, column: str, rows: Column, value: Column) -> DataFrame:
        """New values, of the old type, for one column on the selected rows. Files without such rows stay as they are.

        Parquet's own key ranges keep files that cannot hold a selected row from being read.
        """
        version = self.version(name)
        table, files = self.read(name), self.files(name)
        hit = table.filter(F.coalesce(rows, F.lit(False)))
        touched = {r[0] for r in hit.select(F.col("_metadata.file_path")).distinct().collect()}
        by_name = {_tail(f): f for f in files}
        old = sorted(by_name[_tail(f)] for f in touched)
        if old:
            part = self.spark.read.schema(table.schema).parquet(*old)
            new = update_cells(part, column, rows, value.cast(table.schema[column].dataType))
            self._commit(name, version + 1, sorted({*files} - {*old}) + self._write(name, version + 1, new))
        return self.read(name)


def _tail(file: str) -> str:
    """Version folder and name of a data file, however its path is written."""
    return "/".join(unquote(file).rsplit("/", 2)[1:])


def update_table(
    tables: TableFolder, name: str, column: str, rows: Column, value: Column
) -> DataFrame:
    """New values for one column on the selected rows of a table, as a new version."""
    return tables.update(name, column, rows, value)
