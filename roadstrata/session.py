"""Session settings. Secrets come from the caller's environment, never from code."""

from __future__ import annotations

import os
from collections.abc import Mapping

from pyspark.sql import SparkSession

# Shuffle partition counts are left to AQE, which sizes them from the data it sees.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.parquet.compression.codec": "snappy",
}


def object_store_conf(
    endpoint: str | None = None,
    access_key: str | None = None,
    secret_key: str | None = None,
    path_style: bool = True,
    ssl: bool = False,
    extra: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Hadoop S3A connector settings for an S3-compatible store; unset arguments are left out."""
    prefix = "spark.hadoop.fs.s3a."
    conf = {
        prefix + "impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
        prefix + "path.style.access": str(path_style).lower(),
        prefix + "connection.ssl.enabled": str(ssl).lower(),
    }
    for name, value in (
        ("endpoint", endpoint),
        ("access.key", access_key),
        ("secret.key", secret_key),
    ):
        if value is not None:
            conf[prefix + name] = value
    for name, value in (extra or {}).items():
        conf[name if name.startswith("spark.") else prefix + name] = value
    return conf


def object_store_from_env(environ: Mapping[str, str] = os.environ) -> dict[str, str]:
    """S3A settings from the usual AWS variables; empty when no endpoint or key is given."""
    endpoint = environ.get("AWS_ENDPOINT_URL_S3") or environ.get("AWS_ENDPOINT_URL")
    access = environ.get("AWS_ACCESS_KEY_ID")
    if not endpoint and not access:
        return {}
    return object_store_conf(
        endpoint=endpoint,
        access_key=access,
        secret_key=environ.get("AWS_SECRET_ACCESS_KEY"),
        ssl=bool(endpoint and endpoint.startswith("https")),
    )


def build_session(
    app_name: str = "roadstrata",
    master: str | None = None,
    conf: Mapping[str, str] | None = None,
) -> SparkSession:
    """Session with this library's defaults; `conf` wins over them and may hold any setting."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for name, value in {**DEFAULTS, **object_store_from_env(), **(conf or {})}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()
