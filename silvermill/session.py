"""Spark session for the bronze and silver folders.

Credentials never appear here. The S3A connector reads them itself from the
environment or from whichever Hadoop credential provider the cluster names.
"""

from __future__ import annotations

import importlib.util
import os
from collections.abc import Mapping

from pyspark.sql import SparkSession


def delta_available() -> bool:
    return importlib.util.find_spec("delta") is not None


def session_settings(
    env: Mapping[str, str] | None = None, use_delta: bool | None = None
) -> dict[str, str]:
    """Settings for an S3-compatible endpoint and, where installed, Delta."""
    env = os.environ if env is None else env
    use_delta = delta_available() if use_delta is None else use_delta
    settings = {"spark.sql.session.timeZone": "UTC"}
    endpoint = env.get("AWS_ENDPOINT_URL_S3") or env.get("AWS_ENDPOINT_URL")
    if endpoint:
        settings["spark.hadoop.fs.s3a.endpoint"] = endpoint
        settings["spark.hadoop.fs.s3a.path.style.access"] = "true"
    if use_delta:
        settings["spark.sql.extensions"] = "io.delta.sql.DeltaSparkSessionExtension"
        settings["spark.sql.catalog.spark_catalog"] = (
            "org.apache.spark.sql.delta.catalog.DeltaCatalog"
        )
    return settings


def build_session(
    app_name: str = "silvermill",
    master: str | None = None,
    env: Mapping[str, str] | None = None,
    extra: Mapping[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**session_settings(env), **(extra or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
