"""Session-level helpers: the shared folder, written tables that cut lineage, partition counts."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_OWN_DIRS: dict[str, str] = {}
_SHIPPED: set[str] = set()
_TABLES: dict[str, list[str]] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, as ``spark.checkpoint.dir`` names it.

    Only where the setting is missing and Spark runs on one machine (local tests) is a temporary folder made.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
    app = spark.sparkContext.applicationId
    if app not in _OWN_DIRS:
        _OWN_DIRS[app] = tempfile.mkdtemp(prefix="corpusloom-")
        atexit.register(shutil.rmtree, _OWN_DIRS[app], ignore_errors=True)
    return f"file://{_OWN_DIRS[app]}"


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder; ``cleanup`` removes it."""
    path = f"{shared_dir(spark)}/corpusloom-{label}-{uuid.uuid4().hex}"
    _TABLES.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def materialize(df: DataFrame, label: str = "table", drop_shuffles: bool = False) -> DataFrame:
    """Write ``df`` to the shared folder and return a scan of it.

    The plan above starts from files that survive a lost executor, and nothing below is computed twice. ``drop_shuffles`` deletes the shuffle files of the write as it ends, rather than when the driver happens to collect
    its garbage.
    """
    path = new_path(df.sparkSession, label)
    conf, key = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(key, None) if drop_shuffles else None
    try:
        if drop_shuffles:
            conf.set(key, "true")
        df.write.parquet(path)
    finally:
        if drop_shuffles:
            conf.set(key, before) if before is not None else conf.unset(key)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._corpusloom_path = path  # for discard()
    return out


def discard(df: DataFrame) -> None:
    """Delete the files behind a table made by ``materialize`` that no live plan reads any more."""
    path = getattr(df, "_corpusloom_path", None)
    if path:
        _delete(df.sparkSession, path)


def written(spark: SparkSession) -> list[str]:
    """The tables and files that this session has made in the shared folder and not deleted."""
    return list(_TABLES.get(spark.sparkContext.applicationId, []))


def discard_since(spark: SparkSession, before: list[str], keep: DataFrame) -> None:
    """Delete what was made since ``before`` (from ``written``) but the table ``keep``, on which alone what follows depends."""
    for path in set(written(spark)) - set(before) - {getattr(keep, "_corpusloom_path", None)}:
        _delete(spark, path)


def cleanup(spark: SparkSession) -> None:
    """Delete every table this session has written to the shared folder."""
    for path in written(spark):
        _delete(spark, path)


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    made = _TABLES.get(spark.sparkContext.applicationId, [])
    if path in made:
        made.remove(path)


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with the scheme that Spark would read it by."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(p).toString()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, written beside its place and moved into it, so that a reader sees the old one or the new one."""
    jvm = spark.sparkContext._jvm
    there, beside = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}")
    fs = there.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = fs.create(beside, True)
    out.write(bytearray(text.encode()))
    out.close()
    if not fs.rename(beside, there):  # some file systems don't rename over a file
        fs.delete(there, False)
        fs.rename(beside, there)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_bytes(df: DataFrame, *cols: str) -> tuple[int, int]:
    """(rows, UTF-8 bytes of ``cols``) in one column-pruned pass."""
    size = sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in cols), F.lit(0).cast("long"))
    row = df.agg(F.count(F.lit(1)).alias("n"), F.sum(size).alias("b")).first()
    return row["n"], row["b"] or 0


def without(df: DataFrame, *reserved: str) -> list[str]:
    """Columns of ``df`` that don't clash with the names an operator returns (names compare case-insensitively).

    Operators replace an input column of a reserved name; every other column passes through.
    """
    taken = {r.lower() for r in reserved}
    return [c for c in df.columns if c.lower() not in taken]


def ship(spark: SparkSession) -> None:
    """Give the executors' Python this package, once a session; operators that run Python there call it."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="corpusloom-code-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    with zipfile.ZipFile(f"{folder}/corpusloom_code.zip", "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    spark.sparkContext.addPyFile(f"{folder}/corpusloom_code.zip")
    _SHIPPED.add(app)


def frugal(run):
    """An Arrow function over a partition's batches that hands its worker's free memory back to the system at the end: workers live on between tasks."""

    def inner(batches):
        try:
            yield from run(batches)
        finally:
            give_back()

    return inner


def give_back() -> None:
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass
