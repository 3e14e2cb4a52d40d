"""Session settings (S0): UTC everywhere, ANSI on, catalog and object store as plain dicts."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Mapping

from pyspark.sql import SparkSession

from tradeweir.errors import PipelineError

# Settings every session of this package needs. ANSI turns decimal overflow into a failure
# instead of a null; the zone makes timestamp text identical on every machine.
CORE_CONF = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}

# JVM-wide zone, for connectors that convert timestamps outside Spark SQL. Static settings,
# used only when a new session is started.
JVM_CONF = {
    "spark.driver.extraJavaOptions": "-Duser.timezone=UTC",
    "spark.executor.extraJavaOptions": "-Duser.timezone=UTC",
}


def catalog_conf(
    name: str,
    *,
    uri: str,
    warehouse: str,
    endpoint: str,
    region: str,
    access_key: str,
    secret_key: str,
    path_style: bool = True,
) -> dict[str, str]:
    """Eleven settings that attach an Iceberg REST catalog called ``name``."""
    at = f"spark.sql.catalog.{name}"
    return {
        "spark.sql.extensions": "org.apache.iceberg.spark.extensions.IcebergSparkSessionExtensions",
        at: "org.apache.iceberg.spark.SparkCatalog",
        f"{at}.type": "rest",
        f"{at}.uri": uri,
        f"{at}.warehouse": warehouse,
        f"{at}.io-impl": "org.apache.iceberg.aws.s3.S3FileIO",
        f"{at}.s3.endpoint": endpoint,
        f"{at}.s3.path-style-access": _flag(path_style),
        f"{at}.s3.access-key-id": access_key,
        f"{at}.s3.secret-access-key": secret_key,
        f"{at}.client.region": region,
    }


def object_store_conf(
    *,
    endpoint: str,
    region: str,
    access_key: str,
    secret_key: str,
    path_style: bool = True,
    ssl: bool = False,
) -> dict[str, str]:
    """Eight S3A settings for checkpoints and file sinks."""
    at = "spark.hadoop.fs.s3a"
    return {
        f"{at}.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
        f"{at}.endpoint": endpoint,
        f"{at}.endpoint.region": region,
        f"{at}.access.key": access_key,
        f"{at}.secret.key": secret_key,
        f"{at}.aws.credentials.provider": "org.apache.hadoop.fs.s3a.SimpleAWSCredentialsProvider",
        f"{at}.path.style.access": _flag(path_style),
        f"{at}.connection.ssl.enabled": _flag(ssl),
    }


def cluster_conf(cores: int) -> dict[str, str]:
    """Shuffle and scan sizes for a cluster of ``cores``; adaptive execution does the rest.

    Shuffles start with many small partitions, so that a partition of even a very large exchange fits
    in memory, and are merged at run time to about the advisory size.
    """
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(8 * cores),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
        "spark.sql.shuffle.partitions": str(3 * cores),
        "spark.sql.files.maxPartitionBytes": "256m",
    }


def credentials_from_env(
    environ: Mapping[str, str] | None = None,
    *,
    access_var: str = "AWS_ACCESS_KEY_ID",
    secret_var: str = "AWS_SECRET_ACCESS_KEY",
) -> dict[str, str]:
    """Keys for the two functions above; they are never taken from code or arguments."""
    env = os.environ if environ is None else environ
    absent = [v for v in (access_var, secret_var) if not env.get(v)]
    if absent:
        raise PipelineError(f"set {' and '.join(absent)} in the environment")
    return {"access_key": env[access_var], "secret_key": env[secret_var]}


def build_session(
    app_name: str,
    conf: Mapping[str, str] | None = None,
    *,
    master: str | None = None,
) -> SparkSession:
    """Start (or join) a session that honours the UTC and ANSI contract."""
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for key, value in {**JVM_CONF, **(conf or {}), **CORE_CONF}.items():
        builder = builder.config(key, value)
    return require_runtime(builder.getOrCreate())


def require_runtime(spark: SparkSession) -> SparkSession:
    """Give an existing session the settings the results depend on."""
    for key, value in CORE_CONF.items():
        spark.conf.set(key, value)
    return spark


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder below the shared one the cluster names in ``spark.checkpoint.dir``.

    A local folder is taken only where that setting is absent and the session runs on one machine;
    executors of a cluster would not see it.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise PipelineError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="tradeweir-")
    return f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def scratch_database(spark: SparkSession, label: str) -> str:
    """A fresh database whose tables live in :func:`scratch_folder`."""
    name = f"{label}_{uuid.uuid4().hex}"
    folder = scratch_folder(spark, label).replace("'", "\\'")
    spark.sql(f"CREATE DATABASE {name} LOCATION '{folder}'")
    return name


def _flag(value: bool) -> str:
    return "true" if value else "false"
