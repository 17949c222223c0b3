"""The session that the engine expects."""

from __future__ import annotations

import os
from collections.abc import Mapping

from pyspark.sql import SparkSession

#: UTC is part of the semantics (dates are cut in it); casts raise in staging; JSON keeps the last of equal keys.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def settle(spark: SparkSession) -> SparkSession:
    """Set what can be set on a running session."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def object_store(env: Mapping[str, str] = os.environ) -> dict[str, str]:
    """Settings of an S3-compatible store, from OBJECT_STORE_ENDPOINT, _KEY, _SECRET and _REGION; none if unset."""
    names = {"ENDPOINT": "endpoint", "KEY": "access.key", "SECRET": "secret.key", "REGION": "endpoint.region"}
    found = {f"spark.hadoop.fs.s3a.{conf}": env[f"OBJECT_STORE_{name}"] for name, conf in names.items() if env.get(f"OBJECT_STORE_{name}")}
    if found and not {"spark.hadoop.fs.s3a.access.key", "spark.hadoop.fs.s3a.secret.key"} <= set(found):
        raise ValueError("an object store needs a key and a secret")
    if "spark.hadoop.fs.s3a.endpoint" in found:
        secure = not found["spark.hadoop.fs.s3a.endpoint"].startswith("http://")
        found |= {"spark.hadoop.fs.s3a.path.style.access": "true", "spark.hadoop.fs.s3a.connection.ssl.enabled": str(secure).lower()}
    return found


def build(name: str = "weirgate", **settings: str) -> SparkSession:
    """A session with the engine's settings."""
    builder = SparkSession.builder.appName(name)
    for key, value in {**SETTINGS, **object_store(), **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
