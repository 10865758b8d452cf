"""State tables: insert-if-absent, keyed merges, cascading deletes, stored as Parquet versions."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.operators.topk import keep_first
from corpusloom.runtime import write_text

STATUSES = ("PENDING", "PROCESSED_PHASE1", "EMBEDDED", "PROCESSED_PHASE2", "ERROR", "SKIPPED")


def insert_if_absent(table: DataFrame, rows: DataFrame, key: list[str], order: list[str] | None = None) -> DataFrame:
    """``table`` and the rows of new keys; of new rows with one key the first (by ``order``) counts."""
    fresh = keep_first(rows, key, list(order or [c for c in rows.columns if c not in key] or key))
    return table.unionByName(fresh.join(table.select(*key), key, "left_anti"), allowMissingColumns=True)


def merge(table: DataFrame, updates: DataFrame, key: list[str], overwrite: tuple[str, ...] = ()) -> DataFrame:
    """Update or insert by key. A null leaves the old value, but in ``overwrite`` columns, where it clears it."""
    u = updates.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(key)], *[F.col(c).alias(f"_u_{c}") for c in updates.columns if c not in key], F.lit(True).alias("_u"))
    cond = F.lit(True)
    for i, c in enumerate(key):
        cond = cond & (table[c] == u[f"_k{i}"])
    both = table.join(u, cond, "full")
    out = [F.coalesce(table[c], F.col(f"_k{i}")).alias(c) for i, c in enumerate(key)]
    for c in table.columns:
        if c in key:
            continue
        if c not in updates.columns:
            out.append(table[c])
        elif c in overwrite:
            out.append(F.when(F.col("_u"), F.col(f"_u_{c}")).otherwise(table[c]).alias(c))
        else:
            out.append(F.coalesce(F.col(f"_u_{c}"), table[c]).alias(c))
    return both.select(*out)


def chunk_by_id(chunks: DataFrame, chunk: str) -> DataFrame:
    """One chunk; the condition reaches the scan."""
    return chunks.where(F.col("id") == chunk)


def embeddings_of(embeddings: DataFrame, model: str, ids: DataFrame | None = None) -> DataFrame:
    """Embeddings (chunk_id, model, vector) of one model, of the chunks in ``ids`` (id) alone if given."""
    e = embeddings.where(F.col("model") == model)
    return e if ids is None else e.join(ids.select(F.col("id").alias("chunk_id")), "chunk_id", "left_semi")


def upsert_embeddings(embeddings: DataFrame, new: DataFrame) -> DataFrame:
    """``new`` replaces what chunks have by the same model."""
    return embeddings.join(new.select("chunk_id", "model"), ["chunk_id", "model"], "left_anti").unionByName(new)


def set_progress(progress: DataFrame, rows: DataFrame) -> DataFrame:
    """Last locators (book_id, source_path, locator) of files; the newest counts."""
    return merge(progress, rows, ["book_id", "source_path"])


def start_job(jobs: DataFrame, job_id: str, kind: str, started: Column | None = None) -> DataFrame:
    """The job log (job_id, kind, started, finished, status, detail) with a new entry."""
    row = jobs.sparkSession.range(1).select(F.lit(job_id).alias("job_id"), F.lit(kind).alias("kind"), (F.current_timestamp() if started is None else started).alias("started"), F.lit(None).cast("timestamp").alias("finished"), F.lit("running").alias("status"), F.lit(None).cast("string").alias("detail"))
    return jobs.unionByName(row)


def finish_job(jobs: DataFrame, job_id: str, status: str, detail: str | None = None, finished: Column | None = None) -> DataFrame:
    mine = F.col("job_id") == job_id
    return jobs.withColumns({
        "finished": F.when(mine, F.current_timestamp() if finished is None else finished).otherwise(F.col("finished")),
        "status": F.when(mine, F.lit(status)).otherwise(F.col("status")),
        "detail": F.when(mine, F.lit(detail)).otherwise(F.col("detail")),
    })


def latest(log: DataFrame, key: list[str], order: list[Column | str]) -> DataFrame:
    """State of a change log: the last row of each key."""
    return keep_first(log, key, order)


def status_counts(chunks: DataFrame, status: str = "status", keep: Column | None = None) -> DataFrame:
    return (chunks.where(keep) if keep is not None else chunks).groupBy(status).agg(F.count(F.lit(1)).alias("n"))


def list_chunks(chunks: DataFrame, book: str | None = None, pipeline: str | None = None, statuses: tuple[str, ...] = (), limit: int | None = None) -> DataFrame:
    """Chunks in reading order; all conditions reach the scan."""
    c = chunks
    if book:
        c = c.where(F.col("book_id") == book)
    if pipeline:
        c = c.where(F.col("pipeline") == pipeline)
    if statuses:
        if bad := set(statuses) - set(STATUSES):
            raise ValueError(f"unknown status: {sorted(bad)}")
        c = c.where(F.col("status").isin(*statuses))
    c = c.orderBy("source_path", "unit_seq")
    return c.limit(limit) if limit else c


def reset_book(tables: dict[str, DataFrame], book: str) -> dict[str, DataFrame]:
    """All tables without a book: its chunks, their embeddings, edges that touch them at either end, its buffers and progress."""
    gone = tables["chunks"].where(F.col("book_id") == book).select(F.col("id").alias("gone"))
    out = dict(tables)
    out["chunks"] = tables["chunks"].where(F.col("book_id") != book)
    if "embeddings" in tables:
        out["embeddings"] = tables["embeddings"].join(gone, F.col("chunk_id") == F.col("gone"), "left_anti")
    if "edges" in tables:
        e = tables["edges"].join(gone, F.col("left_id") == F.col("gone"), "left_anti")
        out["edges"] = e.join(gone, F.col("right_id") == F.col("gone"), "left_anti")
    for name in ("buffers", "progress"):
        if name in tables:
            out[name] = tables[name].where(F.col("book_id") != book)
    return out


class TableStore:
    """Named tables as Parquet versions below a folder. A write makes a new version, then points to it; readers of the old one aren't disturbed."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _pointer(self, name: str) -> str:
        return f"{self.root}/{name}/CURRENT"

    def _fs(self, path: str):
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def exists(self, name: str) -> bool:
        p, fs = self._fs(self._pointer(name))
        return fs.exists(p)

    def read(self, name: str, schema: str | None = None) -> DataFrame:
        """The current version; an empty table of ``schema`` if there is none."""
        if not self.exists(name):
            if schema is None:
                raise FileNotFoundError(name)
            return self.spark.createDataFrame([], schema)
        return self.spark.read.parquet(f"{self.root}/{name}/{self._versions(name)[0]}")

    def write(self, name: str, df: DataFrame) -> DataFrame:
        """A new version, pointed to once it is whole. The version before the last is deleted: a reader of the last isn't disturbed."""
        kept = self._versions(name)
        version = f"v-{uuid.uuid4().hex}"
        df.write.parquet(f"{self.root}/{name}/{version}")
        write_text(self.spark, self._pointer(name), "\n".join([version, *kept[:1]]))
        for old in kept[1:]:
            p, fs = self._fs(f"{self.root}/{name}/{old}")
            fs.delete(p, True)
        return self.read(name)

    def append(self, name: str, rows: DataFrame) -> DataFrame:
        """More rows in the current version: a table that only grows isn't written again. What a table's keys allow is the caller's to see to."""
        kept = self._versions(name)
        if not kept:
            return self.write(name, rows)
        rows.write.mode("append").parquet(f"{self.root}/{name}/{kept[0]}")
        return self.read(name)

    def _versions(self, name: str) -> list[str]:
        """The current version and the one before."""
        return [r[0] for r in self.spark.read.text(self._pointer(name)).collect() if r[0]] if self.exists(name) else []
