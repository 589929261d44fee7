"""Versioned full runs: jobs work in a folder of their own, and readers see their tables only when all are done.

A base folder holds side inputs, `versions/<number>` with the tables of each published run, and the manifest `_current`, a
small file that names one of them and is replaced whole. A run that stops anywhere leaves the manifest, and with it every table that
readers see, as it was.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import SparkSession

from tidemark.plans import jobs
from tidemark.sources import tables

MANIFEST = "_current"
#: What jobs read besides events: copied to the working folder where it is there.
SIDE_INPUTS = tuple(jobs.NEEDS.values())
WORK = "_tmp-"


def versions(spark: SparkSession, base: str) -> list[int]:
    """Numbers of the versions that are there, oldest first."""
    return sorted(int(v) for v in tables.children(spark, f"{base}/versions") if v.isdigit())


def current(spark: SparkSession, base: str) -> int | None:
    """The version that readers see."""
    text = tables.read_file(spark, f"{base}/{MANIFEST}")
    return int(text) if text else None


def folder_of(spark: SparkSession, base: str) -> str:
    """The folder of the version that readers see."""
    number = current(spark, base)
    if number is None:
        raise FileNotFoundError(f"nothing is published in {base}")
    return f"{base}/versions/{number}"


def switch(spark: SparkSession, base: str, number: int) -> None:
    """Let readers see another version, a later one or, to roll back, an earlier one."""
    if number not in versions(spark, base):
        raise FileNotFoundError(f"{base} has no version {number}")
    tables.replace_file(spark, f"{base}/{MANIFEST}", str(number))


def working_copy(spark: SparkSession, base: str, with_events: bool) -> str:
    """A folder for a run, with the side inputs and, where no dump brings events, the event tables that readers see."""
    work = tables.make_temporary(spark, base)
    for name in SIDE_INPUTS:
        if tables.exists(spark, f"{base}/{name}"):
            tables.copy_to_temporary(spark, f"{base}/{name}", work)
    if with_events:
        seen = folder_of(spark, base)
        for name in set(tables.children(spark, seen)) & set(tables.EVENT_TABLES):
            tables.copy_to_temporary(spark, f"{seen}/{name}", work)
    return work


def publish(spark: SparkSession, base: str, work: str) -> int:
    """Make a finished working folder the next version, the one that readers see."""
    number = max([0, *versions(spark, base)]) + 1
    tables.make_folder(spark, f"{base}/versions")
    if not tables.move(spark, work, f"{base}/versions/{number}"):
        raise FileExistsError(f"{base}/versions/{number}")
    switch(spark, base, number)
    return number


def prune(spark: SparkSession, base: str, keep: int = 2) -> None:
    """Remove all but the last `keep` versions and the one that readers see, and what stopped runs have left."""
    seen = current(spark, base)
    for number in versions(spark, base)[:-keep] if keep else versions(spark, base):
        if number != seen:
            tables.remove(spark, f"{base}/versions/{number}")
    for name in tables.children(spark, base):
        if name.startswith(WORK):
            tables.remove(spark, f"{base}/{name}")


def full_run(spark: SparkSession, base: str, dump_path: str | None = None, *, keep: int = 2, run: Callable[[SparkSession, str, str | None], Iterable[str]] = jobs.run_all) -> int:
    """All jobs over a dump, or over the events that readers see, published as a new version; its number.

    One run of a base at a time: older versions beyond `keep` and the working folders of stopped runs are removed at the end.
    """
    work = working_copy(spark, base, with_events=dump_path is None)
    run(spark, work, dump_path)
    number = publish(spark, base, work)
    prune(spark, base, keep)
    return number
