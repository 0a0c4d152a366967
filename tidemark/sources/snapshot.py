"""Tables of immutable Parquet files with a log of manifests: versions, merge, delete, changes, compaction, purge."""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.functions import commits
from tidemark.functions.crash import barrier
from tidemark.operators.layout import clustered, file_stats
from tidemark.session import cut


class Conflict(Exception):
    """Another writer published the version first; read again and retry."""


class SnapshotTable:
    """A folder: data/<uuid>/ holds files, _log/<version>.json says which version they make up, and names its manifest.

    A manifest, _log/manifests/<uuid>/, is a Parquet table of files: path, bytes, rows and, for the columns named, minimum,
    maximum and number of nulls in the columns' own types; the driver sees only the paths of files that an operation
    reads. A version is published under a name that only one writer can have, so readers see all of it or nothing, and
    of two writers one gets Conflict. Statistics are kept only for the columns named, as they outlive deleted rows
    otherwise. Merges and deletes rewrite only the files that hold a matching key.
    """

    def __init__(self, spark: SparkSession, root: str, keys: list[str], stats: list[str] | None = None):
        self.spark, self.root, self.keys, self.stats = spark, root.rstrip("/"), keys, stats or []

    # --- log ---

    def versions(self) -> list[int]:
        return [int(n[:-5]) for n in commits.names(self.spark, f"{self.root}/_log")]

    def manifest(self, version: int | None = None) -> dict:
        """What the log says of a version (the newest by default): operation, schema, metrics, numbers of files and rows."""
        known = self.versions()
        if version is None:
            version = known[-1] if known else -1
        if version not in known:
            raise LookupError(f"no version {version} in {self.root}")
        return json.loads(commits.read_text(self.spark, f"{self.root}/_log/{version:010d}.json"))

    def files(self, version: int | None = None) -> DataFrame:
        """(path, bytes, rows, min_<c>, max_<c>, nulls_<c>...) of a version's files."""
        m = self.manifest(version)
        return self.spark.read.schema(self._files_schema(StructType.fromJson(m["schema"]))).parquet(f"{self.root}/_log/manifests/{m['manifest']}")

    def _files_schema(self, schema: StructType) -> str:
        of = {f.name: f.dataType.simpleString() for f in schema.fields}
        return ", ".join(["path string", "bytes bigint", "rows bigint", *[f"`{n}_{c}` {of[c]}" for c in self.stats for n in ("min", "max")], *[f"`nulls_{c}` bigint" for c in self.stats]])

    def _publish(self, base: int, operation: str, files: DataFrame, schema: StructType, metrics: dict) -> int:
        barrier("mid_merge")
        version, manifest = base + 1, uuid.uuid4().hex
        files.write.parquet(f"{self.root}/_log/manifests/{manifest}")
        written = self.spark.read.schema(self._files_schema(schema)).parquet(f"{self.root}/_log/manifests/{manifest}")
        n = written.agg(F.count("*").alias("files"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes")).first()
        content = {"version": version, "operation": operation, "at": time.time(), "manifest": manifest, "n_files": n["files"], "n_rows": n["rows"], "n_bytes": n["bytes"], "schema": json.loads(schema.json()), "metrics": metrics}
        try:
            commits.publish(self.spark, f"{self.root}/_log/{version:010d}.json", json.dumps(content).encode())
        except FileExistsError as e:
            raise Conflict(str(version)) from e
        return version

    def history(self) -> DataFrame:
        """(version, operation, n_files, n_rows, metrics) of all versions."""
        rows = []
        for v in self.versions():
            m = self.manifest(v)
            rows.append((v, m["operation"], m["n_files"], m["n_rows"], json.dumps(m["metrics"], sort_keys=True)))
        return self.spark.createDataFrame(rows, "version int, operation string, n_files int, n_rows bigint, metrics string")

    # --- files ---

    def _write(self, df: DataFrame) -> tuple[DataFrame, Row]:
        """Writes rows; gives the manifest of the files that hold any, and their number and rows."""
        for k in self.keys:
            df = df.withColumn(k, F.when(F.col(k).isNull(), F.raise_error(F.lit(f"null in key {k}"))).otherwise(F.col(k)))
        at = uuid.uuid4().hex
        df.write.parquet(f"{self.root}/data/{at}")
        written = self.spark.read.schema(df.schema).parquet(f"{self.root}/data/{at}")
        stats = file_stats(written, self.stats).withColumnsRenamed({"file": "path", "size": "bytes"})
        schema = self._files_schema(df.schema)
        stats.select(*[F.col(f"`{c.name}`") for c in self.spark.createDataFrame([], schema).schema]).write.parquet(f"{self.root}/_log/parts/{at}")
        part = self.spark.read.schema(schema).parquet(f"{self.root}/_log/parts/{at}")
        return part, part.agg(F.count("*").alias("files"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows")).first()

    def _load(self, files: DataFrame, schema: StructType) -> DataFrame:
        paths = [r["path"] for r in files.select("path").collect()]  # of the files an operation reads; never rows
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def _state(self) -> tuple[int, DataFrame, StructType]:
        m = self.manifest()
        return m["version"], self.files(m["version"]), StructType.fromJson(m["schema"])

    def _may_hold(self, column: str, low: object, high: object) -> Column:
        """Whether a file may hold a value in a range. One whose values are all null doesn't."""
        if column not in self.stats:
            return F.lit(True)
        lo, hi = F.col(f"min_{column}"), F.col(f"max_{column}")
        return (F.col(f"nulls_{column}") < F.col("rows")) & (lo <= F.lit(high)) & (hi >= F.lit(low))

    def read(self, version: int | None = None, only: tuple[str, object, object] | None = None) -> DataFrame:
        """A version (the newest by default); only = (column, low, high) leaves out files that hold no value from low to
        high, by their statistics. Rows of the other files all come."""
        files = self.files(version)
        return self._load(files.where(self._may_hold(*only)) if only else files, StructType.fromJson(self.manifest(version)["schema"]))

    # --- writes ---

    def create(self, df: DataFrame, cluster: list[str] | None = None, files: int = 16) -> int:
        """The first version; with cluster its rows lie in `files` files, near in all these columns where near in one."""
        if cluster:
            df = clustered(df, cluster, files)
        return self._publish(-1, "create", self._write(df)[0], df.schema, {})

    def append(self, df: DataFrame) -> int:
        v, files, schema = self._state()
        new, n = self._write(df.select(*schema.names))
        return self._publish(v, "append", files.unionByName(new), schema, {"rows": n["rows"]})

    def insert_only(self, df: DataFrame) -> int:
        """Appends the rows whose key the table doesn't have; nothing is published if there are none."""
        v, files, schema = self._state()
        new, n = self._write(df.select(*schema.names).dropDuplicates(self.keys).join(self._load(files, schema).select(*self.keys), self.keys, "left_anti"))
        return self._publish(v, "insert", files.unionByName(new), schema, {"rows": n["rows"]}) if n["rows"] else v

    def _touched(self, version: int, files: DataFrame, schema: StructType, keys: DataFrame | None, where: Column | None) -> tuple[DataFrame, DataFrame]:
        """The files that hold a matching row, and the others."""
        if not self.manifest(version)["n_files"]:
            return files, files
        rows = self._load(files, schema).withColumn("_file_path", F.col("_metadata.file_path"))
        hit = rows.join(keys, self.keys, "left_semi") if keys is not None else rows.where(where)
        names = cut(hit.select(F.col("_file_path").alias("path")).distinct())
        return files.join(names, "path", "left_semi"), files.join(names, "path", "left_anti")

    def upsert(self, df: DataFrame, obsolete: DataFrame | None = None) -> int:
        """Replaces rows of the same key, inserts the others and deletes obsolete keys, all in one version.

        Source rows that share a key are refused, as it can't be told which of them should stand.
        """
        v, files, schema = self._state()
        df = df.select(*schema.names)
        twice = df.groupBy(*self.keys).agg(F.count("*").alias("n")).where(F.col("n") > 1).limit(3).collect()
        if twice:
            raise ValueError(f"several source rows for one key: {twice}")
        gone = df.select(*self.keys) if obsolete is None else df.select(*self.keys).unionByName(obsolete.select(*self.keys))
        gone = gone.distinct()
        touched, kept = self._touched(v, files, schema, gone, None)
        new, _ = self._write(self._load(touched, schema).join(gone, self.keys, "left_anti").unionByName(df))
        return self._publish(v, "merge", kept.unionByName(new), schema, {"files_rewritten": touched.count()})

    def delete(self, where: Column) -> int:
        """Deletes rows; metrics tell how many rows of the files it touched were copied."""
        v, files, schema = self._state()
        touched, kept = self._touched(v, files, schema, None, where)
        before = touched.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("n")).first()["n"]
        new, n = self._write(self._load(touched, schema).where(~F.coalesce(where, F.lit(False))))
        return self._publish(v, "delete", kept.unionByName(new), schema, {"rows_deleted": before - n["rows"], "rows_copied": n["rows"]})

    def rewrite(self, arrange, operation: str) -> int:
        """Publishes the same rows in other files: arrange(df) compacts, clusters or partitions them."""
        v, files, schema = self._state()
        before = self.manifest(v)
        new, n = self._write(arrange(self._load(files, schema)).select(*schema.names))
        if n["rows"] != before["n_rows"]:
            raise ValueError("a rewrite must keep all rows")
        return self._publish(v, operation, new, schema, {"files_before": before["n_files"], "files_after": n["files"]})

    def replace(self, df: DataFrame) -> int:
        """Publishes df as the whole content, or creates the table: a stored view that is computed anew."""
        if not self.versions():
            return self.create(df)
        v, _, schema = self._state()
        return self._publish(v, "replace", self._write(df.select(*schema.names))[0], schema, {})

    def compact(self, target_bytes: int) -> int:
        n = max(1, -(-self.manifest()["n_bytes"] // target_bytes))
        return self.rewrite(lambda df: df.repartition(n), "compact")

    # --- reads over versions ---

    def changes(self, since: int, until: int | None = None) -> DataFrame:
        """(columns..., change) between two versions: insert, delete, update_before, update_after."""
        schema, before, after = StructType.fromJson(self.manifest(until)["schema"]), self.files(since), self.files(until)
        a = self._load(before.join(after.select("path"), "path", "left_anti"), schema)  # files in both hold no change
        b = self._load(after.join(before.select("path"), "path", "left_anti"), schema)
        whole = F.struct(*schema.names)
        both = a.select(*self.keys, whole.alias("_old")).join(b.select(*self.keys, whole.alias("_new")), self.keys, "full")
        changed = both.where(~F.col("_old").eqNullSafe(F.col("_new")))
        kinds = F.when(F.col("_old").isNull(), F.array(F.struct(F.col("_new").alias("r"), F.lit("insert").alias("change")))).when(F.col("_new").isNull(), F.array(F.struct(F.col("_old").alias("r"), F.lit("delete").alias("change"))))
        kinds = kinds.otherwise(F.array(F.struct(F.col("_old").alias("r"), F.lit("update_before").alias("change")), F.struct(F.col("_new").alias("r"), F.lit("update_after").alias("change"))))
        return changed.select(F.explode(kinds).alias("x")).select("x.r.*", "x.change")

    def purge(self, keep_versions: int = 1) -> int:
        """Removes manifests but the newest ones, and the files no remaining one names; returns how many files went."""
        known = self.versions()
        manifests = {v: self.manifest(v)["manifest"] for v in known}
        of = lambda vs: self.spark.read.parquet(*[f"{self.root}/_log/manifests/{manifests[v]}" for v in vs]).select("path")
        gone = 0
        if known[:-keep_versions]:
            old = cut(of(known[:-keep_versions]).join(of(known[-keep_versions:]), "path", "left_anti").distinct())
            for v in known[:-keep_versions]:
                for path in (f"{self.root}/_log/{v:010d}.json", f"{self.root}/_log/manifests/{manifests[v]}"):
                    fs, at = commits.filesystem(self.spark, path)
                    fs.delete(at, True)
            for r in old.toLocalIterator():  # a partition of names at a time
                fs, at = commits.filesystem(self.spark, r["path"])
                gone += bool(fs.delete(at, False))
        return gone

    def residual(self, column: str, value: object) -> list[int]:
        """Versions that still hold a value, which a purge has to remove too; only files that may hold it are read."""
        return [v for v in self.versions() if not self.read(v, (column, value, value)).where(F.col(column) == F.lit(value)).isEmpty()]
