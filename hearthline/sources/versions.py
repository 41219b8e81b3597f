"""Blue/green tables: every build is a new directory, and numbered pointer files say which one is live.

A promotion creates the pointer file with the next number, which only one of several promoters can do; the others get ``Conflict``.
A pointer counts once it is complete (its last line is ``end``), so a promoter that is lost half way leaves the earlier version live
and the next one goes past its number. On HDFS and local disks creation is exclusive; a store without exclusive creation needs a
committer or lock of its own. In a catalog the live version is a view, which is replaced in one step.
"""

from __future__ import annotations

from dataclasses import dataclass
from uuid import uuid4

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, functions as F

from hearthline.schemas import ddl
from hearthline.sources.readers import table_exists

#: The earlier layout's pointer table, still read where no pointer file exists.
POINTER = ddl("seq BIGINT, version STRING, legacy STRING")


class Conflict(RuntimeError):
    """Another promotion came first; nothing was changed."""


@dataclass(frozen=True)
class Pointer:
    seq: int
    version: str
    legacy: str | None


def _fs(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def _text(spark: SparkSession, fs, path) -> str:
    stream = fs.open(path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _numbers(spark: SparkSession, base: str) -> list[int]:
    fs, folder = _fs(spark, f"{base}/_pointers")
    names = [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []
    return sorted((int(n) for n in names if n.isdigit()), reverse=True)


def latest(spark: SparkSession, base: str) -> Pointer | None:
    """The live pointer: the highest complete one."""
    for seq in _numbers(spark, base):
        fs, path = _fs(spark, f"{base}/_pointers/{seq:012d}")
        lines = _text(spark, fs, path).splitlines()
        if lines[-1:] == ["end"]:
            return Pointer(seq, lines[0], lines[1] or None)
    old = f"{base}/_pointer_log"
    row = spark.read.schema(POINTER).parquet(old).orderBy(F.desc("seq")).first() if table_exists(spark, old) else None
    return Pointer(row.seq, row.version, row.legacy) if row else None


def _create(spark: SparkSession, base: str, seq: int) -> None:
    """Takes the number, or raises: the one step in which only one promoter can succeed."""
    fs, path = _fs(spark, f"{base}/_pointers/{seq:012d}")
    fs.mkdirs(path.getParent())
    if fs.getScheme() == "file":
        taken = spark._jvm.java.io.File(path.toUri().getPath()).createNewFile()
    else:
        try:
            fs.create(path, False).close()
            taken = True
        except Py4JJavaError as e:
            if "AlreadyExists" not in e.java_exception.getClass().getName():
                raise
            taken = False
    if not taken:
        raise Conflict(f"promotion {seq} of {base} was made by another")


def _point(spark: SparkSession, base: str, last: Pointer | None, version: str, legacy: str | None) -> None:
    seq = max([last.seq if last else 0, *_numbers(spark, base)[:1]]) + 1
    if (now := latest(spark, base)) != last:
        raise Conflict(f"{base} is at {now}, no longer at {last}")
    _create(spark, base, seq)
    fs, path = _fs(spark, f"{base}/_pointers/{seq:012d}")
    stream = fs.create(path, True)
    try:
        stream.write(bytearray(f"{version}\n{legacy or ''}\nend\n".encode()))
    finally:
        stream.close()


def stage(df: DataFrame, base: str) -> str:
    """Write a side copy and return its version; readers still see the live one."""
    version = uuid4().hex
    df.write.parquet(f"{base}/v={version}")
    return version


_NOW = object()


def promote(spark: SparkSession, base: str, version: str, expected: Pointer | None | object = _NOW) -> None:
    """Make a staged version live and remember the present one as legacy. With ``expected``, the pointer that the version was built
    on (``latest`` at that time), a promotion in between is a ``Conflict``."""
    last = latest(spark, base) if expected is _NOW else expected
    _point(spark, base, last, version, None if last is None else last.version)


def rollback(spark: SparkSession, base: str) -> str:
    """Swap back to the legacy version."""
    last = latest(spark, base)
    if last is None or last.legacy is None:
        raise ValueError("no earlier version to return to")
    _point(spark, base, last, last.legacy, last.version)
    return last.legacy


def read_live(spark: SparkSession, base: str) -> DataFrame:
    last = latest(spark, base)
    if last is None:
        raise FileNotFoundError(f"nothing promoted under {base}")
    return spark.read.parquet(f"{base}/v={last.version}")


def stage_table(df: DataFrame, view: str) -> str:
    """Write a side table next to the view's name in its catalog schema and return the table's name."""
    name = f"{view}_v{uuid4().hex}"
    df.write.saveAsTable(name)
    return name


def promote_table(spark: SparkSession, view: str, table: str) -> None:
    """Point the view at a staged table. The catalog replaces a view in one step: readers see the old or the new one."""
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT * FROM {table}")
