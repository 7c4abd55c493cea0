"""Where sources come from: revisions of checkouts, and the table of chips."""

from __future__ import annotations

import subprocess
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

UNKNOWN = "unknown"
CHIP = "chip string, idf_docs boolean, trm_folder string, revisions array<string>"


@dataclass(frozen=True)
class Revision:
    version: str = UNKNOWN
    commit: str = UNKNOWN


def _git(folder: str | Path, *args: str) -> str:
    try:
        done = subprocess.run(["git", "-C", str(folder), *args], capture_output=True, text=True, timeout=10)
    except (OSError, subprocess.SubprocessError):
        return UNKNOWN
    return done.stdout.strip() or UNKNOWN if done.returncode == 0 else UNKNOWN


def revision_of(folder: str | Path) -> Revision:
    """Version and commit of a checkout; 'unknown' for anything else. Never raises."""
    return Revision(_git(folder, "describe", "--tags", "--always", "--dirty"), _git(folder, "rev-parse", "HEAD"))


def with_revision(rows: DataFrame, revision: Revision) -> DataFrame:
    """Adds source_version and source_commit."""
    return rows.withColumns({"source_version": F.lit(revision.version), "source_commit": F.lit(revision.commit)})


def chips_from_yaml(spark: SparkSession, text: str) -> DataFrame:
    """The chip table from YAML: ``chips: {name: {idf_docs, trm_folder, revisions}}``."""
    import yaml  # optional

    rows = []
    for name, about in (yaml.safe_load(text) or {}).get("chips", {}).items():
        if not about.get("revisions"):
            raise ValueError(f"{name} has no revisions")
        rows.append((name, bool(about.get("idf_docs")), about.get("trm_folder"), list(about["revisions"])))
    return spark.createDataFrame(rows, CHIP)


def first_existing(*folders: str | Path | None) -> Path:
    """The first folder that exists: an explicit one, one from the environment, the usual ones."""
    for f in folders:
        if f and Path(f).is_dir():
            return Path(f)
    raise FileNotFoundError(f"none of {', '.join(str(f) for f in folders if f)} is a folder")
