"""The declared schema of the event log, its batch and streaming scans, and the cut by arrival."""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from typing import Protocol

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import commits
from tidemark.functions.times import instant

RESCUE = "_rescued_data"
#: Fixed values of the contract: the columns of the log in order; all may be null.
COLUMNS = "event_id event_type event_ts arrival_ts order_id customer_id sku qty new_qty unit_price_cents currency return_id reason segment country boundary".split()
LONG = {"qty", "new_qty", "unit_price_cents"}


def bronze_schema() -> T.StructType:
    kinds = {c: T.LongType() if c in LONG else T.StringType() for c in COLUMNS}
    return T.StructType([T.StructField(c, k) for c, k in kinds.items()] + [T.StructField(RESCUE, T.StringType())])


@dataclass(frozen=True)
class IngestSpec:
    """Where a drop lies and how a stream reads it."""

    path: str
    files_per_trigger: int = 40
    options: dict[str, str] = field(default_factory=dict)


class Ingestor(Protocol):
    """What every way to read a drop guarantees: declared columns only, no line lost, a line that can't be read kept in RESCUE."""

    def read(self, spark: SparkSession, spec: IngestSpec) -> DataFrame: ...

    def stream(self, spark: SparkSession, spec: IngestSpec) -> DataFrame: ...


class JsonLines:
    """Files of one JSON object a line, by Spark's file source. Fields are declared, never inferred."""

    def _options(self, spec: IngestSpec) -> dict[str, str]:
        return {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": RESCUE, "recursiveFileLookup": "true", **spec.options}

    def read(self, spark: SparkSession, spec: IngestSpec) -> DataFrame:
        df = spark.read.schema(bronze_schema()).options(**self._options(spec)).json(spec.path)
        return df.select(*COLUMNS, RESCUE, F.col("_metadata.file_path").alias("_ingest_file"))

    def stream(self, spark: SparkSession, spec: IngestSpec) -> DataFrame:
        df = spark.readStream.schema(bronze_schema()).options(**self._options(spec)).option("maxFilesPerTrigger", spec.files_per_trigger).json(spec.path)
        return df.select(*COLUMNS, RESCUE, F.col("_metadata.file_path").alias("_ingest_file"))


class ParquetDrop:
    """Files of Parquet with the same columns, added ones merged by name."""

    def read(self, spark: SparkSession, spec: IngestSpec) -> DataFrame:
        return spark.read.options(mergeSchema="true", recursiveFileLookup="true", **spec.options).parquet(spec.path)

    def stream(self, spark: SparkSession, spec: IngestSpec) -> DataFrame:
        schema = spark.read.parquet(spec.path).schema
        return spark.readStream.schema(schema).options(recursiveFileLookup="true", **spec.options).option("maxFilesPerTrigger", spec.files_per_trigger).parquet(spec.path)


class EvolvingJsonLines:
    """Files of JSON lines whose fields may grow. Fields beyond the declared ones are kept as text: those that the schema
    log knows as columns, the others in RESCUE as one JSON object, whole lines that can't be read in RESCUE as they are.

    spec.options: schema_log, the folder that holds the names known so far (one file for each time some were added), and
    hints, "name type, ..." for known fields that aren't text. evolve() adds what RESCUE holds; a stream uses the columns
    known when it starts. Rows also have _ingested_at.
    """

    def known(self, spark: SparkSession, spec: IngestSpec) -> list[str]:
        log = spec.options["schema_log"]
        found = [json.loads(commits.read_text(spark, f"{log}/{n}")) for n in commits.names(spark, log)]
        hinted = [h.split()[0] for h in spec.options.get("hints", "").split(",") if h.strip()]
        return list(dict.fromkeys([*hinted, *[c for part in found for c in part]]))

    def _parsed(self, spark: SparkSession, spec: IngestSpec, lines: DataFrame) -> DataFrame:
        extra = self.known(spark, spec)
        types = {c: "bigint" for c in LONG} | dict(h.split() for h in spec.options.get("hints", "").split(",") if h.strip())
        fields = F.from_json("value", "map<string,string>")
        rows = lines.where(F.trim("value") != "").select("value", F.col("_metadata.file_path").alias("_ingest_file"), fields.alias("_m"))
        names = [*COLUMNS, *extra]
        field = lambda c: F.col("_m")[c].alias(c) if types.get(c, "string") == "string" else F.col("_m")[c].try_cast(types[c]).alias(c)
        # A number that its column can't hold stays readable too.
        lost = lambda k, v: ~k.isin(*names) | F.coalesce(*[F.when((k == c) & v.isNotNull() & v.try_cast(t).isNull(), F.lit(True)) for c, t in types.items() if t != "string"], F.lit(False))
        rest = F.map_filter("_m", lost)
        broken = F.col("_m").isNull() | (F.size("_m") == 0)
        rescue = F.when(broken, F.col("value")).when(F.size(rest) > 0, F.to_json(rest))
        return rows.select(*[field(c) for c in names], rescue.alias(RESCUE), "_ingest_file", F.current_timestamp().alias("_ingested_at"))

    def read(self, spark: SparkSession, spec: IngestSpec) -> DataFrame:
        return self._parsed(spark, spec, spark.read.option("recursiveFileLookup", "true").text(spec.path))

    def stream(self, spark: SparkSession, spec: IngestSpec) -> DataFrame:
        lines = spark.readStream.option("recursiveFileLookup", "true").option("maxFilesPerTrigger", spec.files_per_trigger).text(spec.path)
        return self._parsed(spark, spec, lines)

    def evolve(self, spark: SparkSession, spec: IngestSpec, rows: DataFrame) -> list[str]:
        """Adds the names that RESCUE holds in rows taken in so far to the schema log; returns those that were new."""
        known = {*COLUMNS, *self.known(spark, spec)}
        names = rows.select(F.explode(F.map_keys(F.from_json(RESCUE, "map<string,string>"))).alias("k")).distinct().where(~F.col("k").isin(*known))
        new = sorted(r["k"] for r in names.limit(MOST_FIELDS).collect())
        if new:
            log = spec.options["schema_log"]
            commits.publish(spark, f"{log}/{len(commits.names(spark, log)):06d}.json", json.dumps(new).encode())
        return new


#: Names that one evolution adds at most, so that keys that are values don't become columns without end; they stay in RESCUE.
MOST_FIELDS = 200


class TableStream:
    """A table of the catalog, or a folder of Parquet that another stream writes, as the next stream's source."""

    def read(self, spark: SparkSession, spec: IngestSpec) -> DataFrame:
        return spark.read.parquet(spec.path) if "/" in spec.path else spark.read.table(spec.path)

    def stream(self, spark: SparkSession, spec: IngestSpec) -> DataFrame:
        reader = spark.readStream.option("maxFilesPerTrigger", spec.files_per_trigger)
        if "/" not in spec.path:
            return reader.table(spec.path)
        return reader.schema(spark.read.parquet(spec.path).schema).option("recursiveFileLookup", "true").parquet(spec.path)


INGESTORS: dict[str, Ingestor] = {"jsonl": JsonLines(), "parquet": ParquetDrop(), "evolving": EvolvingJsonLines(), "table": TableStream()}


def line_count(spark: SparkSession, path: str) -> int:
    """Lines of a drop that aren't blank, counted without any parser."""
    return spark.read.option("recursiveFileLookup", "true").text(path).where(F.trim("value") != "").count()


def as_of_cut(df: DataFrame, as_of: str | Column, arrival: str = "arrival_ts") -> DataFrame:
    """Rows that had arrived by an instant, that instant included; rows without a readable arrival are left out."""
    at = F.lit(as_of).cast("timestamp") if isinstance(as_of, str) else as_of
    return df.where(instant(F.col(arrival)) <= at)
