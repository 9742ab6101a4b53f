"""Processed tables: sinks, ad-hoc SQL and the dashboard's loads."""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from murmura.sources.scratch import fresh_path, stage

_RUN = "run"


def _run_name(run: str | None) -> str:
    """A name that is safe as part of a path on any file system."""
    name = run or uuid.uuid4().hex
    if not re.fullmatch(r"[\w.-]+", name, re.ASCII):
        raise ValueError(f"run may hold letters, digits, '_', '.' and '-', not {name!r}")
    return name


class FolderStore:
    """Parquet tables under one folder of any Hadoop file system.

    Appends go to a partition per run. A run that is repeated after a failure
    replaces its own rows, while a new run adds to the earlier ones.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def _path(self, table: str) -> str:
        return f"{self.folder}/{table}"

    def append(self, df: DataFrame, table: str, run: str | None = None) -> DataFrame:
        """Append ``df`` and return a frame that reads back the appended rows only."""
        path = f"{self._path(table)}/{_RUN}={_run_name(run)}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def replace(self, df: DataFrame, table: str) -> DataFrame:
        df.write.mode("overwrite").parquet(self._path(table))
        return self.spark.read.schema(df.schema).parquet(self._path(table))

    def read(self, table: str, schema: StructType | None = None) -> DataFrame:
        """The table, or with ``schema`` an empty frame while it does not exist."""
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        try:
            found = reader.parquet(self._path(table))
        except AnalysisException as error:
            if schema is not None and error.getCondition() == "PATH_NOT_FOUND":
                return self.spark.createDataFrame([], schema)
            raise
        return found.drop(_RUN)

    def read_run(self, table: str, run: str, schema: StructType) -> DataFrame:
        """The rows of one run; none if there is no such run."""
        try:
            return self.spark.read.schema(schema).parquet(f"{self._path(table)}/{_RUN}={_run_name(run)}")
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return self.spark.createDataFrame([], schema)
            raise

    def reset(self, schemas: Mapping[str, StructType]) -> None:
        for table, schema in schemas.items():
            self.replace(self.spark.createDataFrame([], schema), table)


class CatalogStore:
    """Tables of the session catalog, optionally with a common name prefix."""

    def __init__(self, spark: SparkSession, prefix: str = "", source: str = "parquet"):
        self.spark = spark
        self.prefix = prefix
        self.source = source

    def append(self, df: DataFrame, table: str, run: str | None = None) -> DataFrame:
        name = self.prefix + table
        run = _run_name(run)
        if self.spark.catalog.tableExists(name):
            # Names the partition, so that only this run's rows are replaced.
            columns = ", ".join(f"`{c}`" for c in self.read(table).columns)
            self.spark.sql(
                f"INSERT OVERWRITE TABLE IDENTIFIER(:name) PARTITION ({_RUN} = :run) "
                f"SELECT {columns} FROM {{rows}}",
                {"name": name, "run": run},
                rows=df,
            )
        else:
            tagged = df.withColumn(_RUN, F.lit(run))
            tagged.write.format(self.source).partitionBy(_RUN).saveAsTable(name)
        return self.spark.table(name).filter(F.col(_RUN) == run).drop(_RUN)

    def replace(self, df: DataFrame, table: str) -> DataFrame:
        df.write.format(self.source).mode("overwrite").saveAsTable(self.prefix + table)
        return self.spark.table(self.prefix + table)

    def read(self, table: str, schema: StructType | None = None) -> DataFrame:
        if schema is not None:
            return table_or_empty(self.spark, self.prefix + table, schema).drop(_RUN)
        return self.spark.table(self.prefix + table).drop(_RUN)

    def reset(self, schemas: Mapping[str, StructType]) -> None:
        for table in schemas:
            self.spark.sql("DROP TABLE IF EXISTS IDENTIFIER(:name)", {"name": self.prefix + table})


# SQLSTATE of an unknown table or view: the standard, and common databases.
_NO_TABLE = ("42P01", "42S02", "42X05", "42704")


def _is_missing_table(error: Exception) -> bool:
    """Whether the database said that it has no such table, by SQLSTATE anywhere in the causes."""
    cause = getattr(error, "java_exception", None) or getattr(error, "_origin", None)
    while cause is not None and hasattr(cause, "getCause"):
        state = cause.getSQLState() if "SQL" in cause.getClass().getName() else None
        if state in _NO_TABLE:
            return True
        cause = cause.getCause()
    state = error.getSqlState() if isinstance(error, PySparkException) else None
    return state in _NO_TABLE


@dataclass
class JdbcStore:
    """Tables of a database reached over JDBC.

    ``connections`` bounds the number of parallel writers; ``partitioning``
    holds the four ``partitionColumn``/``lowerBound``/``upperBound``/
    ``numPartitions`` options for a parallel read of a large table.
    """

    spark: SparkSession
    url: str
    properties: Mapping[str, str] = field(default_factory=dict)
    prefix: str = ""
    connections: int = 16

    def write_options(self, table: str) -> dict[str, str]:
        return {
            **self.properties,
            "url": self.url,
            "dbtable": self.prefix + table,
            "numPartitions": str(self.connections),
            "batchsize": "10000",
        }

    def read_options(
        self, source: Mapping[str, str], partitioning: Mapping[str, str] | None = None
    ) -> dict[str, str]:
        return {**self.properties, "url": self.url, **source, **(partitioning or {})}

    def append(self, df: DataFrame, table: str, run: str | None = None) -> DataFrame:
        """Append ``df``. A database keeps no runs apart, so a repeated run would double its rows."""
        if run is not None:
            raise ValueError("a database table has no runs to replace; append without run")
        # Staged, so that the rows are computed once and not again by whoever
        # reads the returned frame.
        rows = stage(df, table)
        rows.write.format("jdbc").options(**self.write_options(table)).mode("append").save()
        return rows

    def replace(self, df: DataFrame, table: str) -> DataFrame:
        df.write.format("jdbc").options(**self.write_options(table)).mode("overwrite").save()
        return df

    def read(
        self,
        table: str,
        schema: StructType | None = None,
        partitioning: Mapping[str, str] | None = None,
    ) -> DataFrame:
        """The table, or with ``schema`` an empty frame while the database does not have it."""
        options = self.read_options({"dbtable": self.prefix + table}, partitioning)
        try:
            return self.spark.read.format("jdbc").options(**options).load()
        except Exception as error:
            if schema is not None and _is_missing_table(error):
                return self.spark.createDataFrame([], schema)
            raise

    def reset(self, schemas: Mapping[str, StructType]) -> None:
        for table, schema in schemas.items():
            self.replace(self.spark.createDataFrame([], schema), table)

    def query(self, sql: str) -> DataFrame:
        """Rows of a query that the database itself runs."""
        options = self.read_options({"query": sql})
        return self.spark.read.format("jdbc").options(**options).load()


def run_sql(spark: SparkSession, query: str, views: Mapping[str, DataFrame] = {}) -> DataFrame:
    """Ad-hoc SQL over the catalog, and over the given frames as ``{name}``.

    The frames are no views of the session, before or after. Braces that are
    not names are doubled.
    """
    return spark.sql(query, **views) if views else spark.sql(query)


def table_or_empty(spark: SparkSession, name: str, schema: StructType) -> DataFrame:
    """The table, or no rows while it does not exist yet. Other errors surface."""
    if spark.catalog.tableExists(name):
        return spark.table(name)
    return spark.createDataFrame([], schema)


def resolve_column(df: DataFrame, name: str, position: int = 1) -> str:
    """``name`` if the table has it, otherwise the name of the column at ``position``."""
    return name if name in df.columns else df.columns[position]


def processed_preview(posts: DataFrame, n: int = 5) -> DataFrame:
    return posts.select("title", "clean_body", "sentiment", "score").limit(n)


def comments_sample(
    comments: DataFrame, n: int | None = None, order: Sequence[str] = ()
) -> DataFrame:
    """All comments, or the first ``n`` by ``order``."""
    if n is None:
        return comments
    return (comments.orderBy(*order) if order else comments).limit(n)


class Snapshot:
    """Copies of frames, held from one refresh to the next and visible to SQL by name.

    The copies are written rather than cached: a cache that is lost with an
    executor, or dropped by a write to the source, would come back with newer
    rows. Two slots are written in turn, so that readers of the last snapshot
    can finish and disk use stays at two copies.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.folder = fresh_path(spark, "snapshot")
        self.refreshes = 0
        self.frames: dict[str, DataFrame] = {}

    def refresh(self, **frames: DataFrame) -> Snapshot:
        slot = f"{self.folder}/{self.refreshes % 2}"
        held = {}
        for name, df in frames.items():
            df.write.mode("overwrite").parquet(f"{slot}/{name}")
            held[name] = self.spark.read.schema(df.schema).parquet(f"{slot}/{name}")
        for name, df in held.items():
            df.createOrReplaceTempView(name)
        self.frames = held
        self.refreshes += 1
        return self

    def __getitem__(self, name: str) -> DataFrame:
        return self.frames[name]
