"""Session settings and the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Fixed values of the contract.
ACCOUNTING_ZONE = "Europe/Madrid"
FRESHNESS_SLA_MINUTES = 15
MAX_LINE_QUANTITY = 10_000
MAX_UNIT_PRICE_CENTS = 1_000_000
CURRENCY = "EUR"


def build_session(app: str = "tidemark", master: str = "local[8]", partitions: int = 8, **conf: str) -> SparkSession:
    """A local session as tests and the bench use it: UTC, AQE on, ANSI as it is by default."""
    b = SparkSession.builder.appName(app).master(master)
    own = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.showConsoleProgress": "false",
    }
    for k, v in (own | conf).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder: spark.checkpoint.dir; only where that is unset and Spark is local (tests) a temporary one."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        known = spark.sparkContext.getCheckpointDir()
        if known:
            return known
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        at = "file://" + tempfile.mkdtemp(prefix="tidemark-shared-")
        spark.sparkContext.setCheckpointDir(at)
    elif not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(at)
    return at.rstrip("/")


def scratch(spark: SparkSession, what: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_dir(spark)}/{what}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """df with its lineage cut by a reliable checkpoint in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)