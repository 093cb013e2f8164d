"""Parquet scans and sinks.

Paths go through Hadoop's FileSystem API (via the session's JVM), so the
same code lists and writes local, HDFS or object-store paths. Nothing here
reads data on the driver: listings and schema footers only.
"""

from __future__ import annotations

import datetime as _dt
import itertools
import logging
import re
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oddsline.schemas import MANIFEST, REQUIRED_COLUMNS

log = logging.getLogger("oddsline.sources")

_VERSION_RE = re.compile(r"^(?P<stem>.*)_(?P<n>\d{3,})$")


# ------------------------------------------------------------ Hadoop FS helpers

def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, hpath


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def glob_paths(spark: SparkSession, pattern: str) -> list[str]:
    fs, p = _fs(spark, pattern)
    st = fs.globStatus(p)
    return sorted(s.getPath().toString() for s in (st or []))


def list_dir(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().toString() for s in fs.listStatus(p))


def delete_dir(spark: SparkSession, path: str) -> None:
    """Remove a folder that this program made and nothing names."""
    fs, p = _fs(spark, path)
    fs.delete(p, True)


# ------------------------------------------------------------ A1 scan

def scan_parquet(spark: SparkSession, paths, schema: T.StructType | None = None) -> DataFrame | None:
    """Scan one path, a glob or a list of them; ``None`` (with a warning) when
    nothing matches or the files cannot be read."""
    if isinstance(paths, str):
        paths = [paths]
    found: list[str] = []
    for p in paths:
        found += glob_paths(spark, p) if any(ch in p for ch in "*?[") else ([p] if path_exists(spark, p) else [])
    if not found:
        log.warning("no parquet input at %s", paths)
        return None
    try:
        reader = spark.read.schema(schema) if schema is not None else spark.read
        df = reader.parquet(*found)
        df.schema  # noqa: B018 -- resolve now so unreadable input fails here
        return df
    except Exception as e:  # noqa: BLE001
        log.warning("cannot read %s: %s", found, e)
        return None


# ------------------------------------------------------------ A2 run directories

@dataclass
class RunInput:
    """Where a stage finds a table: one run directory, explicit files, or all runs."""
    mode: str  # "run_dir" | "files" | "scan"
    root: str | None = None
    run_dir: str | None = None
    files: dict[str, str | list[str]] | None = None


def run_table_paths(spark: SparkSession, cfg: RunInput, name: str) -> list[str]:
    """Paths of table ``name``: the single file if present, else its ordered
    ``name_partNNNN.parquet`` parts; in scan mode all files of the table
    (single, versioned or parts) of every run."""
    if cfg.mode == "files":
        given = (cfg.files or {}).get(name) or []
        return [p for p in ([given] if isinstance(given, str) else given) if path_exists(spark, p)]
    if cfg.mode == "scan":
        own = re.compile(rf"/{re.escape(name)}(_part\d+|_\d{{3,}})?\.parquet/?$")
        return [p for p in glob_paths(spark, f"{cfg.root}/raw/*/{name}*.parquet") if own.search(p)]
    single = f"{cfg.run_dir}/{name}.parquet"
    if path_exists(spark, single):
        return [single]
    return part_paths(spark, cfg.run_dir, name)


def part_paths(spark: SparkSession, run_dir: str, name: str) -> list[str]:
    """``name_part<N>.parquet`` in part order, however many digits N has."""
    found = ((re.search(r"_part(\d+)\.parquet/?$", p), p) for p in glob_paths(spark, f"{run_dir}/{name}_part*.parquet"))
    return [p for _, p in sorted((int(m[1]), p) for m, p in found if m)]


def scan_run_table(spark: SparkSession, cfg: RunInput, name: str, schema=None,
                   with_run: bool = False) -> DataFrame | None:
    """A2: the table from a run input; ``with_run`` adds the run directory
    name taken from each row's file path (scan mode)."""
    paths = run_table_paths(spark, cfg, name)
    if not paths:
        log.warning("no %s input for %s", name, cfg)
        return None
    df = scan_parquet(spark, paths, schema)
    if df is not None and with_run:
        src = F.col("_metadata.file_path")
        df = df.withColumn("run", F.regexp_extract(src, r"/raw/([^/]+)/", 1))
    return df


# ------------------------------------------------------------ exclusive creation

def commit_file(spark: SparkSession, path: str, text: str) -> bool:
    """Create ``path`` with ``text``, whole or not at all; False if it exists.

    Of several writers exactly one succeeds. The text is written under another
    name first. It then gets its name by a hard link on a local disk and by a
    rename elsewhere, both of which fail where the name is taken; stores whose
    rename would replace a file create it conditionally instead.
    """
    fs, p = _fs(spark, path)
    jvm = spark.sparkContext._jvm
    fs.mkdirs(p.getParent())
    real = fs.resolvePath(p.getParent())  # what a mounted path leads to
    fs = real.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    target, scheme = jvm.org.apache.hadoop.fs.Path(real, p.getName()), fs.getUri().getScheme()

    def put(to) -> None:
        out = fs.create(to, False)
        try:
            out.write(bytearray(text.encode("utf-8")))
        finally:
            out.close()

    def taken(e: Exception) -> bool:
        if fs.exists(target):
            return True
        raise e

    if scheme not in ("file", "hdfs"):
        try:
            put(target)
            return True
        except Exception as e:  # noqa: BLE001 -- py4j wraps what the store throws
            return not taken(e)
    draft = jvm.org.apache.hadoop.fs.Path(real, f".{p.getName()}.{uuid.uuid4().hex}")
    put(draft)
    try:
        if scheme == "hdfs":
            return bool(fs.rename(draft, target))
        local = jvm.java.nio.file.Paths
        jvm.java.nio.file.Files.createLink(local.get(target.toUri()), local.get(draft.toUri()))
        return True
    except Exception as e:  # noqa: BLE001
        return not taken(e)
    finally:
        fs.delete(draft, False)


def read_text(spark: SparkSession, path: str) -> str:
    """A small text file (a commit, a claim)."""
    fs, p = _fs(spark, path)
    source = fs.open(p)
    try:
        return bytes(source.readAllBytes()).decode("utf-8")
    finally:
        source.close()


# ------------------------------------------------------------ A4 versioned sink

def unique_path(spark: SparkSession, path: str) -> str:
    """``x`` if free, else the first free of ``x_001``, ``x_002`` ... (an existing
    ``_NNN`` suffix is stripped first). One listing of the folder finds it."""
    return next(_free_paths(spark, path))


def _free_paths(spark: SparkSession, path: str):
    folder, _, name = path.rstrip("/").rpartition("/")
    folder = folder or "."
    used = {p.rstrip("/").rsplit("/", 1)[1] for p in list_dir(spark, folder)}
    if name not in used:
        yield f"{folder}/{name}"
    base, ext = (name[:-8], ".parquet") if name.endswith(".parquet") else (name, "")
    m = _VERSION_RE.match(base)
    stem = m.group("stem") if m else base
    for n in itertools.count(1):
        if (other := f"{stem}_{n:03d}{ext}") not in used:
            yield f"{folder}/{other}"


def claim_path(spark: SparkSession, path: str) -> str:
    """The first free version of ``path``, claimed for this writer: a racing
    writer gets the next one. A claim whose writer fails leaves a gap."""
    for target in _free_paths(spark, path):
        folder, name = target.rsplit("/", 1)
        if commit_file(spark, f"{folder}/_claims/{name}", ""):
            return target


def write_versioned(df: DataFrame, path: str, partition_by: list[str] | None = None,
                    max_records_per_file: int | None = None) -> str:
    """Write to the next free version of ``path``; never overwrites."""
    spark = df.sparkSession
    target = claim_path(spark, path)
    w = df.write.mode("errorifexists")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    w.parquet(target)
    return target


# ------------------------------------------------------------ A6 manifest

def write_with_manifest(df: DataFrame, name: str, path: str, manifest_path: str,
                        partition_by: list[str] | None = None) -> tuple[str, int]:
    """Write ``df`` (versioned) and append one manifest row. Manifest
    failures only warn.

    The row count is read back from the committed files' Parquet footers (a
    metadata-only job), so it is exact even when tasks or stages were re-run
    after an executor loss, which accumulator-based counts do not guarantee.
    """
    target = write_versioned(df, path, partition_by)
    rows = committed_rows(df.sparkSession, target)
    try:
        append_manifest(df.sparkSession, manifest_path, name, target, rows, df.schema)
    except Exception as e:  # noqa: BLE001
        log.warning("manifest append failed for %s: %s", name, e)
    return target, rows


def committed_rows(spark: SparkSession, path: str) -> int:
    """Row count of a written Parquet table from its footers."""
    return int(spark.read.parquet(path).count())


def append_manifest(spark: SparkSession, manifest_path: str, name: str, target: str, rows: int,
                    schema: T.StructType) -> None:
    now = _dt.datetime.now(_dt.timezone.utc).isoformat()
    row = [(name, target, now, rows, len(schema.fields), schema.json())]
    spark.createDataFrame(row, MANIFEST).coalesce(1).write.mode("append").parquet(manifest_path)


def read_manifest(spark: SparkSession, manifest_path: str) -> DataFrame:
    if not path_exists(spark, manifest_path):
        return spark.createDataFrame([], MANIFEST)
    return spark.read.schema(MANIFEST).parquet(manifest_path)


def manifest_rows(name: str, path: str, created_at: str, df: DataFrame) -> DataFrame:
    """A manifest row computed by Spark (rows by an aggregate) without writing."""
    return df.agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit(name).alias("dataset"), F.lit(path).alias("parquet_path"), F.lit(created_at).alias("created_at"),
        F.col("rows").cast("bigint"), F.lit(len(df.columns)).cast("bigint").alias("cols"),
        F.lit(df.schema.json()).alias("schema_json"))


# ------------------------------------------------------------ A11, A12 classify / validate

def classify_columns(cols) -> str:
    """markets > prices > trades > unknown, by column names only."""
    cs = set(cols)
    if set(REQUIRED_COLUMNS["markets"]) <= cs:
        return "markets"
    if set(REQUIRED_COLUMNS["prices"]) <= cs or set(REQUIRED_COLUMNS["prices_v2"]) <= cs:
        return "prices"
    if set(REQUIRED_COLUMNS["trades"]) <= cs:
        return "trades"
    return "unknown"


def _data_files(spark: SparkSession, directory: str) -> list[tuple[str, str | None]]:
    """(path, one data file) of every ``*.parquet`` of a directory, in name order. A table
    that is a folder shows the first data file found below it; None where it has none."""
    fs, p = _fs(spark, f"{directory}/*.parquet")
    out = []
    for st in fs.globStatus(p) or []:  # one listing; a further one per folder
        path, file = st.getPath().toString(), None
        if st.isDirectory():
            below = fs.listFiles(st.getPath(), True)
            while file is None and below.hasNext():
                name = below.next().getPath().toString()
                file = name if not any(x[:1] in "._" for x in name[len(path):].strip("/").split("/")) else None
        else:
            file = path
        out.append((path, file))
    return sorted(out)


def classify_files(spark: SparkSession, directory: str) -> DataFrame:
    """pos (in name order), path, kind and error of every Parquet file of a directory.

    The file list is a table and the footers are read in tasks, 64 files a task; the
    column names then decide the kind. A file that the workers cannot open by its
    path (a store that only Spark's readers know, a damaged file) has an ``error``
    and no kind.
    """
    def names(batches):
        import re

        import pandas as pd
        import pyarrow.parquet as pq
        from pyarrow.fs import FileSystem, LocalFileSystem

        for b in batches:
            rows = []
            for pos, path, file in zip(b["pos"], b["path"], b["file"], strict=True):
                found, error = None, None
                try:
                    local = file.startswith(("/", "file:"))
                    fs, name = (LocalFileSystem(), re.sub("^file:/+", "/", file)) if local else FileSystem.from_uri(file)
                    with fs.open_input_file(name) as f:
                        found = pq.read_schema(f).names
                    found += [x.split("=")[0] for x in file[len(path):].split("/")[:-1] if "=" in x]  # partition columns
                except Exception as e:  # noqa: BLE001
                    error = str(e)
                rows.append((pos, path, found, error))
            yield pd.DataFrame(rows, columns=["pos", "path", "columns", "error"])

    files = [(i, path, file or path) for i, (path, file) in enumerate(_data_files(spark, directory))]
    rows = spark.createDataFrame(files, "pos long, path string, file string").repartition(max(1, -(-len(files) // 64)))
    found = rows.mapInPandas(names, "pos long, path string, columns array<string>, error string")

    def has(kind):
        return F.size(F.array_except(F.array(*map(F.lit, REQUIRED_COLUMNS[kind])), "columns")) == 0

    kind = (F.when(has("markets"), "markets").when(has("prices") | has("prices_v2"), "prices")
            .when(has("trades"), "trades").otherwise("unknown"))
    return found.select("pos", "path", F.when(F.col("columns").isNotNull(), kind).alias("kind"), "error")


def discover_files(spark: SparkSession, directory: str) -> dict[str, list[str]]:
    """Files of a directory by kind: the first markets and the first trades file in
    name order, all prices files; every other one is 'unknown'. One job over the footers
    and one row of names a file; only files that the workers could not open are
    tried again through Spark's reader, one by one."""
    out: dict[str, list[str]] = {"markets": [], "prices": [], "trades": [], "unknown": []}
    for r in sorted(classify_files(spark, directory).collect(), key=lambda r: r["pos"]):
        kind = r["kind"]
        if kind is None:
            try:
                kind = classify_columns(spark.read.parquet(r["path"]).columns)
            except Exception as e:  # noqa: BLE001
                log.warning("%s: %s", r["path"], e)
                kind = "unknown"
        if kind in ("markets", "trades") and out[kind]:
            kind = "unknown"
        out[kind].append(r["path"])
    return out


def validate_columns(df: DataFrame, kind: str) -> None:
    need = REQUIRED_COLUMNS[kind]
    missing = [c for c in need if c not in df.columns]
    if missing:
        raise ValueError(f"{kind} data missing required columns: {missing}")


# ------------------------------------------------------------ A13 compaction

def compact_parts(spark: SparkSession, run_dir: str, prefix: str, out_dir: str,
                  target_file_bytes: int = 256 << 20) -> str | None:
    """Concatenate ``prefix_partNNNN.parquet`` parts (kept in place) into one
    table of files of about ``target_file_bytes``: scan splits of that size are
    one output file each, so nothing is shuffled."""
    parts = part_paths(spark, run_dir, prefix)
    if not parts:
        return None
    fs, _ = _fs(spark, run_dir)
    jvm = spark.sparkContext._jvm
    total = sum(fs.getContentSummary(jvm.org.apache.hadoop.fs.Path(p)).getLength() for p in parts)
    n = max(1, -(-int(total) // target_file_bytes))
    return write_versioned(spark.read.parquet(*parts).coalesce(n), f"{out_dir}/{prefix}.parquet")


# ------------------------------------------------------------ A15 provenance

def with_provenance(df: DataFrame, source_api: str, endpoint: str, fetch_ts: _dt.datetime | str) -> DataFrame:
    """Adds _source_api, _fetch_timestamp (UTC timestamp), _api_endpoint."""
    ts = F.lit(fetch_ts).cast("timestamp") if isinstance(fetch_ts, str) else F.lit(fetch_ts)
    return df.withColumns({"_source_api": F.lit(source_api), "_fetch_timestamp": ts,
                           "_api_endpoint": F.lit(endpoint)})


# ------------------------------------------------------------ A17 stage counts

def stage_counts(markets: DataFrame | None = None, prices: DataFrame | None = None,
                 levels: DataFrame | None = None, spreads: DataFrame | None = None,
                 trades: DataFrame | None = None) -> DataFrame:
    """One row of fetch-stage counters, each an aggregate over its table
    (absent tables count 0); the one-row results are stacked by a union and
    pivoted back with a single aggregate."""
    parts = []
    if markets is not None:
        parts.append(markets.agg(F.count(F.lit(1)).alias("v")).select(F.lit("markets").alias("k"), "v"))
        tok = markets.select(F.explode("token_ids").alias("t")).filter(F.col("t").isNotNull())
        parts.append(tok.agg(F.count_distinct("t").alias("v")).select(F.lit("tokens").alias("k"), "v"))
    for name, df in (("price_points", prices), ("levels", levels), ("spreads", spreads), ("trades", trades)):
        if df is not None:
            parts.append(df.agg(F.count(F.lit(1)).alias("v")).select(F.lit(name).alias("k"), "v"))
    if not parts:
        raise ValueError("no tables to count")
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    names = ["markets", "tokens", "price_points", "levels", "spreads", "trades"]
    return u.agg(*[F.coalesce(F.sum(F.when(F.col("k") == n, F.col("v"))), F.lit(0)).cast("bigint").alias(n)
                   for n in names])


# ------------------------------------------------------------ A16 promotion

def promote_run_tables(spark: SparkSession, run_dir: str, out_dir: str, names: list[str]) -> dict[str, str | None]:
    """Copy the single-file tables of a run (those without parts) into the
    processed area, each in isolation: a failing table is logged and left
    out, the others still go through."""
    done: dict[str, str | None] = {}
    for name in names:
        src = f"{run_dir}/{name}.parquet"
        if not path_exists(spark, src):
            continue
        try:
            done[name] = write_versioned(spark.read.parquet(src), f"{out_dir}/{name}.parquet")
        except Exception as e:  # noqa: BLE001
            log.warning("promotion of %s failed: %s", src, e)
            done[name] = None
    return done
