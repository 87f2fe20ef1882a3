"""Scratch space for written tables, stream checkpoints and staged files.

A cluster names a folder every executor can reach in ``spark.checkpoint.dir``.
Where it names none, a local folder is made if driver and executors are one process, and the job
stops otherwise: executors would write to disks that nobody else reads.
"""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

_LOCAL_BASE: dict[str, str] = {}


def base_dir(spark: SparkSession) -> str:
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/millrace-{spark.sparkContext.applicationId}"
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_BASE:
        _LOCAL_BASE[app] = tempfile.mkdtemp(prefix="millrace-")
    return _LOCAL_BASE[app]


def fresh_path(spark: SparkSession, label: str) -> str:
    """A folder name nobody has used yet."""
    return f"{base_dir(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a folder or file is there, asked of the file system that the path belongs to."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def switch(spark: SparkSession, staged: str, path: str) -> None:
    """Put a finished folder in the place of another by two renames; the old one goes last.

    Between the renames a reader finds no folder, which is shorter than any write but not nothing; where even that
    matters, publish through a ledger (``plans.monthly.Published``).
    """
    place = lambda p: spark._jvm.org.apache.hadoop.fs.Path(p)
    fs, last = place(path).getFileSystem(spark._jsc.hadoopConfiguration()), f"{path.rstrip('/')}-last-{uuid.uuid4().hex[:8]}"
    if fs.exists(place(path)) and not fs.rename(place(path), place(last)):
        raise OSError(f"{path} cannot be moved away")
    if not fs.rename(place(staged), place(path)):
        fs.rename(place(last), place(path))
        raise OSError(f"{staged} cannot be moved to {path}")
    fs.delete(place(last), True)


def fresh_name(label: str) -> str:
    """A table, view or function name nobody has used yet."""
    return f"mr_{label}_{uuid.uuid4().hex[:12]}"


def settle(df: DataFrame, label: str = "stage") -> DataFrame:
    """Cut lineage by writing the rows to the shared folder and reading them back.

    Used where a result feeds several consumers or a job overwrites its own
    input; survives the loss of executors, unlike a cached copy.
    """
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def swept(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a query that runs inside go when it ends, and not when the driver happens to collect its garbage."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def settle_parts(parts: Sequence[DataFrame], label: str = "stage") -> DataFrame:
    """As ``settle``, for rows that come in parts of one shape: written one after the other, so that only one part's shuffles stand on the disks."""
    spark, path = parts[0].sparkSession, fresh_path(parts[0].sparkSession, label)
    for number, part in enumerate(parts):
        with swept(spark):
            part.write.option("compression", "zstd").parquet(f"{path}/part-{number}")
    return spark.read.schema(parts[0].schema).parquet(*[f"{path}/part-{number}" for number in range(len(parts))])


def settle_told(df: DataFrame, label: str = "stage", **told: Column) -> tuple[DataFrame, dict[str, int]]:
    """As ``settle``, with aggregates of the rows (``rows``, their number, is always one) observed while they are written.

    A repeated task may count twice: good for choosing a plan and for telling none from some, not for results.
    """
    seen = Observation(f"{label}-{uuid.uuid4().hex[:12]}")
    rows = settle(df.observe(seen, F.count(F.lit(1)).alias("rows"), *(c.alias(k) for k, c in told.items())), label)
    return rows, seen.get


#: By application, label and input: the columns of each table (None: all there are) and the table.
_STORED: dict[tuple, list[tuple[frozenset | None, DataFrame]]] = {}


def _files_state(spark: SparkSession, folder: str) -> tuple:
    """Number and digest of names, sizes and times of all files below a folder; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    return tuple(files.agg(F.count("*"), F.bit_xor(F.xxhash64("path", "length", "modificationTime"))).first())


def stored(df_of, spark: SparkSession, label: str, source: str, columns: Sequence[str] = (), written: bool = False) -> DataFrame:
    """A fact table that later reports read: written once per application and state of the input folder.

    A reader that names its ``columns`` gets those; only they are written, unless a stored table has them already. ``written`` says
    that ``df_of`` returns a table which it has written itself.
    """
    key = (spark.sparkContext.applicationId, label, source, _files_state(spark, source))
    tables = _STORED.setdefault(key, [])
    found = next((df for has, df in tables if has is None or (columns and has >= set(columns))), None)
    if found is None:
        found = df_of()
        found = found.select(*columns) if columns else found
        found = found if written else settle_parts([found], label)
        tables.append((frozenset(columns) or None, found))
    return found.select(*columns) if columns else found
