"""Model versions and their stages, derived from an append-only log of (name, version, event).

Appending never rewrites what is there, so a crash cannot lose the registry. Stages follow from
the log: the version promoted last is in production, those promoted earlier are archived.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

REGISTERED, PROMOTED = "registered", "promoted"
PRODUCTION, ARCHIVED, NO_STAGE = "Production", "Archived", "None"


def current_model(log: DataFrame) -> DataFrame:
    """One row per model name: the version in production and where it is stored."""
    latest = F.struct("logged_at", "version", "path")
    return (
        log.filter(F.col("event") == PROMOTED)
        .groupBy("model_name").agg(F.max(latest).alias("latest"))
        .select("model_name", "latest.version", "latest.path", F.col("latest.logged_at").alias("promoted_at"))
    )


def model_versions(log: DataFrame) -> DataFrame:
    """One row per model version with its stage."""
    versions = log.groupBy("model_name", "version").agg(
        F.max("path").alias("path"),
        F.bool_or(F.col("event") == PROMOTED).alias("was_promoted"),
    )
    live = current_model(log).select("model_name", F.col("version").alias("live_version"))
    stage = (
        F.when(F.col("version") == F.col("live_version"), PRODUCTION)
        .when(F.col("was_promoted"), ARCHIVED)
        .otherwise(NO_STAGE)
    )
    return versions.join(live, "model_name", "left").select("model_name", "version", "path", stage.alias("stage"))


def next_version(log: DataFrame, model_name: str) -> int:
    last = log.filter(F.col("model_name") == model_name).agg(F.max("version").alias("v")).first().v
    return (last or 0) + 1
