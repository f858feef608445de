"""Session helpers: a local session for tests and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: The folder of a local session that names none.
_OWN: dict[str, str] = {}


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, memory: str = "20g") -> SparkSession:
    """A local[N] session as used by the tests and the bench, with a scratch folder of its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("siteplan")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.checkpoint.dir", "file://" + tempfile.mkdtemp(prefix="siteplan-"))
        .getOrCreate()
    )


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder below the shared folder named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder of this machine, one for the
    session; on a cluster the executors could not see it, so an unset folder is an error there.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        app = spark.sparkContext.applicationId
        base = _OWN.get(app) or _OWN.setdefault(app, "file://" + tempfile.mkdtemp(prefix="siteplan-"))
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"


def kept(df: DataFrame, label: str) -> DataFrame:
    """`df` written below the shared folder now and read back from there."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
