"""Versioned loads of the curated zone: written apart, then switched in one step.

A load is a folder of versions, ``load=<name>/version=<stamp>``; which of
them counts is said by an empty marker, ``_loads/<name>/<stamp>``, made once
the version is whole. Creating a file is one atomic step on every store, so
a reader sees the version before or the one after and never part of one, and
a run that fails leaves the earlier version in place. The version before the
current one stays until the next switch, for readers that already began.
One writer of a load at a time.
"""

from __future__ import annotations

import re
import time
import uuid

from pyspark.sql import SparkSession

from vigil.session import delete_path, list_files, list_folders, touch

MARKERS = "_loads"
_NAME = re.compile(r"[\w.-]+")


def version_path(root: str, load: str, version: str) -> str:
    return f"{root}/load={load}/version={version}"


def new_version(load: str) -> str:
    """A stamp that sorts after those of earlier versions."""
    if not _NAME.fullmatch(load):
        raise ValueError(f"load name {load!r}: letters, digits, '_', '.' and '-' only")
    return f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"


def committed(spark: SparkSession, root: str, load: str | None = None) -> dict[str, list[str]]:
    """Versions of each load (or one) that were made current, oldest first."""
    out: dict[str, list[str]] = {}
    for path in list_files(spark, f"{root}/{MARKERS}" + (f"/{load}" if load else "")):
        name, version = path.rsplit("/", 2)[-2:]
        out.setdefault(name, []).append(version)
    return {name: sorted(versions) for name, versions in sorted(out.items())}


def current_versions(spark: SparkSession, root: str) -> dict[str, str]:
    """The version of each load that counts."""
    return {name: versions[-1] for name, versions in committed(spark, root).items()}


def switch(spark: SparkSession, root: str, load: str, version: str) -> None:
    """Makes a whole version the current one; drops what came before the one it replaces, and leftovers of failed runs."""
    touch(spark, f"{root}/{MARKERS}/{load}/{version}")
    kept = committed(spark, root, load)[load][-2:]
    for folder in list_folders(spark, f"{root}/load={load}"):
        stamp = folder.rsplit("version=", 1)[-1]
        if stamp < kept[-1] and stamp not in kept:
            delete_path(spark, folder)
            delete_path(spark, f"{root}/{MARKERS}/{load}/{stamp}")
