"""SQL-database tables as a storage backend (A7-A10), through Spark JDBC.

A path maps to a sanitised table name; writes create the table on first
use and append; list columns are stored as JSON text and parsed back on
read; a multi-table scan unions every table whose name matches a glob. The
hybrid store writes both backends and reads the primary first.
"""

from __future__ import annotations

import fnmatch
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def table_name(path: str) -> str:
    """``data/raw/run1/prices.parquet`` -> ``data_raw_run1_prices``."""
    p = re.sub(r"\.parquet$", "", str(path))
    return re.sub(r"_+", "_", re.sub(r"[^0-9A-Za-z_]", "_", p)).strip("_")


class JdbcStore:
    """Tables in one database reached by a JDBC URL (no server is started here)."""

    def __init__(self, spark: SparkSession, url: str, properties: dict | None = None,
                 num_partitions: int = 8):
        self.spark, self.url = spark, url
        self.props = dict(properties or {})
        self.num_partitions = num_partitions

    # -- A7
    def write(self, df: DataFrame, path: str) -> str:
        """Create-if-absent and append; arrays/structs/maps go in as JSON text."""
        name = table_name(path)
        out = df.select(*[F.to_json(F.col(f.name)).alias(f.name)
                          if isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType)) else F.col(f.name)
                          for f in df.schema.fields])
        out.write.mode("append").jdbc(self.url, name, properties=self.props)
        return name

    # -- A8
    def exists(self, path: str) -> bool:
        return table_name(path).upper() in {t.upper() for t in self.tables()}

    def read(self, path: str, schema: T.StructType | None = None, partition_column: str | None = None,
             lower: int | None = None, upper: int | None = None) -> DataFrame:
        """Read a table; with ``partition_column`` and bounds the read is split
        into ``num_partitions`` range queries. List columns named in
        ``schema`` are parsed back from JSON."""
        name = table_name(path)
        if partition_column is not None and lower is not None and upper is not None:
            df = self.spark.read.jdbc(self.url, name, column=partition_column, lowerBound=lower,
                                      upperBound=upper, numPartitions=self.num_partitions, properties=self.props)
        else:
            df = self.spark.read.jdbc(self.url, name, properties=self.props)
        df = df.toDF(*[c.lower() for c in df.columns])
        if schema is not None:
            cols = []
            for f in schema.fields:
                c = F.col(f.name.lower())
                if isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType)):
                    c = F.from_json(c, f.dataType)
                else:
                    c = c.cast(f.dataType)
                cols.append(c.alias(f.name))
            df = df.select(*cols)
        return df

    # -- A9
    def tables(self) -> list[str]:
        """Table names from the database metadata (one small JDBC call)."""
        jvm = self.spark.sparkContext._jvm
        props = jvm.java.util.Properties()
        for k, v in self.props.items():
            if k != "driver":
                props.setProperty(k, str(v))
        if "driver" in self.props:
            jvm.java.lang.Class.forName(self.props["driver"])
        conn = jvm.java.sql.DriverManager.getConnection(self.url, props)
        try:
            types = self.spark.sparkContext._gateway.new_array(jvm.java.lang.String, 1)
            types[0] = "TABLE"
            rs = conn.getMetaData().getTables(None, None, "%", types)
            out = []
            while rs.next():
                out.append(rs.getString("TABLE_NAME"))
            return out
        finally:
            conn.close()

    def scan(self, pattern: str, schema: T.StructType | None = None) -> DataFrame | None:
        """Union of every non-empty table whose name matches the glob made
        from ``pattern``; an empty frame (with ``schema``) when none does."""
        glob = table_name(pattern.replace("*", "STAR")).replace("STAR", "*")
        names = [t for t in self.tables() if fnmatch.fnmatch(t.upper(), glob.upper())]
        frames = [f for f in (self.read(n, schema) for n in sorted(names)) if f.limit(1).count() > 0]
        if not frames:
            return self.spark.createDataFrame([], schema) if schema is not None else None
        out = frames[0]
        for f in frames[1:]:
            out = out.unionByName(f)
        return out


class HybridStore:
    """A10: write to both backends (primary first); read the primary, else the fallback."""

    def __init__(self, primary, fallback):
        self.primary, self.fallback = primary, fallback

    def write(self, df: DataFrame, path: str):
        df = df.persist()
        try:
            first = self.primary.write(df, path)
            self.fallback.write(df, path)
            return first
        finally:
            df.unpersist()

    def read(self, path: str, **kw) -> DataFrame:
        if self.primary.exists(path):
            return self.primary.read(path, **kw)
        return self.fallback.read(path, **kw)


class ParquetStore:
    """The Parquet side with the same interface (versioned writes)."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _p(self, path: str) -> str:
        return path if path.startswith("/") or "://" in path else f"{self.root}/{path}"

    def write(self, df: DataFrame, path: str) -> str:
        from oddsline.sources.files import write_versioned

        return write_versioned(df, self._p(path))

    def exists(self, path: str) -> bool:
        from oddsline.sources.files import path_exists

        return path_exists(self.spark, self._p(path))

    def read(self, path: str, schema=None, **_kw) -> DataFrame:
        r = self.spark.read.schema(schema) if schema is not None else self.spark.read
        return r.parquet(self._p(path))
