"""The ``tables`` mapping every view reads from.

A :class:`Tables` maps the 18 source-table names to DataFrames.  Where
the frames come from (Parquet files, a catalog database, JDBC, or the
derived fixtures) is decided once, when the mapping is built; views only
ever see ``tables["Donation"]`` and so on.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hemotab.session import stored
from hemotab.sources.schema import DIMENSIONS, TABLE_NAMES, schemas

Loader = Callable[[], DataFrame]


def declared(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with the declared columns and types: flags kept as integers or
    as text become booleans, and so on."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def balanced_edges(keys: DataFrame, column: str, parts: int, error: float = 0.001) -> list[int]:
    """Keys that split the rows of ``keys`` into about ``parts`` ranges of equal
    size, by approximate quantiles; fewer where keys repeat.  A summary of fixed
    size reaches the driver."""
    shares = [k / parts for k in range(1, parts)]
    found = keys.approxQuantile(column, shares, min(error, 0.1 / parts)) if shares else []
    return sorted({math.ceil(x) for x in found})


def range_predicates(column: str, edges: Sequence[int]) -> list[str]:
    """Conditions of which each row meets exactly one; null keys meet the first."""
    if not edges:
        return ["1 = 1"]
    inner = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(edges, edges[1:])]
    return [f"{column} < {edges[0]} OR {column} IS NULL", *inner, f"{column} >= {edges[-1]}"]


class Tables(Mapping[str, DataFrame]):
    def __init__(self, spark: SparkSession, loaders: Mapping[str, Loader | DataFrame]):
        self.spark = spark
        self._loaders = dict(loaders)
        self._frames: dict[str, DataFrame] = {}
        # Optional stored collapse of the donation views (plans.materialize).
        self.donation_base: DataFrame | None = None
        self.donation_base_profile: str | None = None
        # Optional stored event views: view name -> (frame, profile name).
        self.view_bases: dict[str, tuple[DataFrame, str]] = {}
        # Optional stored monthly counts (plans.partials): view name -> (frame, profile name).
        self.monthly_counts: dict[str, tuple[DataFrame, str]] = {}

    # Mapping protocol -------------------------------------------------------
    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            src = self._loaders[name]
            self._frames[name] = src if isinstance(src, DataFrame) else src()
        return self._frames[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._loaders)

    def __len__(self) -> int:
        return len(self._loaders)

    def replaced(self, **frames: DataFrame) -> "Tables":
        """The same mapping with some tables replaced (stored bases are left out)."""
        return Tables(self.spark, {**{n: self[n] for n in self}, **frames})

    def hold(self, name: str) -> "Tables":
        """Stores a table that takes work to derive, so that what reads it again
        and again (also tables derived from it later) reads files.  In place."""
        self._frames[name] = stored(self.spark, self[name], f"source-{name}")
        return self

    # Constructors ------------------------------------------------------------
    @classmethod
    def from_files(cls, spark: SparkSession, root: str, fmt: str = "parquet",
                   test_id_type: T.DataType = T.BinaryType(),
                   names: Mapping[str, str] | None = None,
                   options: Mapping[str, str] | None = None) -> "Tables":
        """One folder per table under ``root`` (``root/Donation`` ...), in any
        file format Spark reads (``options`` go to the reader, such as
        ``{"header": "true"}`` for CSV); the schema is always given."""
        sch = schemas(test_id_type)
        paths = {n: f"{root.rstrip('/')}/{(names or {}).get(n, n)}" for n in TABLE_NAMES}
        opts = dict(options or {})

        def loader(n: str) -> Loader:
            return lambda: spark.read.schema(sch[n]).format(fmt).options(**opts).load(paths[n])

        return cls(spark, {n: loader(n) for n in TABLE_NAMES})

    @classmethod
    def from_catalog(cls, spark: SparkSession, database: str,
                     test_id_type: T.DataType = T.BinaryType()) -> "Tables":
        """Catalog tables ``database.<Name>`` (S2: database-qualified scan),
        cast to the declared schema."""
        sch = schemas(test_id_type)

        def loader(n: str) -> Loader:
            return lambda: declared(spark.table(f"{database}.{n}"), sch[n])

        return cls(spark, {n: loader(n) for n in TABLE_NAMES})

    @classmethod
    def from_jdbc(cls, spark: SparkSession, url: str, properties: dict[str, str],
                  partitioning: Mapping[str, tuple[str, int, int, int]],
                  test_id_type: T.DataType = T.BinaryType(), balanced: bool = False) -> "Tables":
        """Operational database as the source (S4), cast to the declared schema.

        ``partitioning`` gives (column, lower, upper, partitions) for every
        table that is not a code list, so that no large table is read through
        one connection in one task; a missing entry is an error.  With
        ``balanced`` the bounds split the key alone, which is read once for its
        quantiles, and the table is read in ranges of about equal row counts, so
        that gaps in the keys leave no range with most rows.
        """
        lacking = [n for n in TABLE_NAMES if n not in DIMENSIONS and n not in partitioning]
        if lacking:
            raise ValueError(f"no partitioning given for {lacking}")
        sch = schemas(test_id_type)

        def loader(n: str) -> Loader:
            def load() -> DataFrame:
                if n in partitioning:
                    col, lo, hi, parts = partitioning[n]
                    df = spark.read.jdbc(url, n, column=col, lowerBound=lo, upperBound=hi,
                                         numPartitions=parts, properties=properties)
                    if balanced:
                        edges = balanced_edges(df.select(col), col, parts)
                        df = spark.read.jdbc(url, n, predicates=range_predicates(col, edges), properties=properties)
                else:
                    df = spark.read.jdbc(url, n, properties=properties)
                return declared(df, sch[n])
            return load

        return cls(spark, {n: loader(n) for n in TABLE_NAMES})
