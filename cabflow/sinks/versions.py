"""Publishing a run as one step: versions of day folders and a manifest that names the current ones.

A run writes its days below a new version folder; nothing that is read changes. Then one
file, the next manifest (day -> version), is renamed into place: that is the publication,
of all days written and all days that went, at once. Two runs cannot publish the same
manifest number; the later one starts over from the newer state.

The catalog follows the manifest: partitions whose version changed are pointed to their
new folder (``SET LOCATION``), new ones added, gone ones dropped. The table remembers the
number of the manifest that it shows, so a run that dies in between is made up for by the
next one (:func:`sync`), and until then the table shows whole old days.

Manifests grow with the days of the history, never with the trips. Versions that no
recent manifest names are deleted by :func:`vacuum`.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from cabflow import schema as S
from cabflow.sinks import catalog as K
from cabflow.sinks.parquet import WriteResult, write_day_partitioned

FOLDER = "_versions"
PROPERTY = "cabflow.manifest"
UNDATED = "undated"  # rows without a day
_NULL = "__HIVE_DEFAULT_PARTITION__"


class Conflict(RuntimeError):
    """Another run published first."""


def _fs(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def _manifests(spark: SparkSession, path: str) -> list[int]:
    fs, where = _fs(spark, f"{path}/{FOLDER}/manifests")
    names = [s.getPath().getName() for s in fs.listStatus(where)] if fs.exists(where) else []
    return sorted(int(n.removesuffix(".json")) for n in names if n[0].isdigit())


def manifest(spark: SparkSession, path: str, number: int | None = None) -> tuple[int, dict[str, str]]:
    """(number, day -> version) of a manifest, the current one by default; (0, {}) before the first."""
    numbers = _manifests(spark, path)
    if number is None:
        number = numbers[-1] if numbers else 0
    if number not in numbers:
        return number, {}
    file = f"{path}/{FOLDER}/manifests/{number:08d}.json"
    return number, json.loads(spark.read.option("wholetext", True).text(file).first()[0])


def commit(spark: SparkSession, path: str, number: int, days: dict[str, str]) -> None:
    """Put the manifest ``number`` in place, in one rename; raise if it is there."""
    fs, target = _fs(spark, f"{path}/{FOLDER}/manifests/{number:08d}.json")
    _, draft = _fs(spark, f"{path}/{FOLDER}/manifests/.{uuid.uuid4().hex}")
    out = fs.create(draft, False)
    out.write(bytearray(json.dumps(days, sort_keys=True).encode()))
    out.close()
    if fs.exists(target) or not fs.rename(draft, target):
        fs.delete(draft, False)
        raise Conflict(f"manifest {number} of {path} is there already")


def day_folder(path: str, day: str, version: str) -> str:
    year, month, dom = (_NULL,) * 3 if day == UNDATED else (int(x) for x in day.split("-"))
    names = "/".join(f"{c}={v}" for c, v in zip(S.DAY_PARTITION, (year, month, dom)))
    return f"{path}/{FOLDER}/{version}/{names}"


def _spec(day: str) -> str:
    values = ("null",) * 3 if day == UNDATED else tuple(str(int(x)) for x in day.split("-"))
    return "PARTITION (" + ", ".join(f"{c}={v}" for c, v in zip(S.DAY_PARTITION, values)) + ")"


def publish(
    spark: SparkSession,
    df: DataFrame,
    path: str,
    owned: Callable[[dt.date | None], bool],
    table: str | None = None,
    name: str = "write",
    attempts: int = 3,
    spread: bool = True,
) -> tuple[WriteResult, int]:
    """Write ``df`` and make it the content of all days that ``owned`` names (None: no day).

    Owned days that ``df`` does not hold go; other days stay. The rows are written once,
    whatever the attempts to publish; ``spread`` is that of the write. Returns the write's result and the number of days gone.
    """
    version = f"{dt.datetime.now(dt.timezone.utc):%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:8]}"
    written = write_day_partitioned(df, f"{path}/{FOLDER}/{version}", name, spread)
    new = {d.isoformat(): version for d in written.days} | ({UNDATED: version} if written.undated else {})
    for attempt in range(attempts):
        number, before = manifest(spark, path)
        own = {d for d in before if owned(None if d == UNDATED else dt.date.fromisoformat(d))}
        try:
            commit(spark, path, number + 1, {d: v for d, v in before.items() if d not in own} | new)
            break
        except Conflict:
            if attempt + 1 == attempts:
                raise
    if table:
        sync(spark, table, path, df)
    return written, len(own - set(new))


def shown(spark: SparkSession, table: str) -> int:
    """Number of the manifest that the table shows."""
    rows = spark.sql(f"SHOW TBLPROPERTIES {table}").collect()
    return int({r["key"]: r["value"] for r in rows}.get(PROPERTY, 0))


def sync(spark: SparkSession, table: str, path: str, like: DataFrame, batch: int = 200) -> int:
    """Point the table's partitions to the versions of the current manifest; returns its number.

    Only days that changed since the manifest it shows are touched. Done twice, or after
    a run that died in the middle, it ends the same.
    """
    K.create_table(spark, table, f"{path}/{FOLDER}/live", like)
    number, days = manifest(spark, path)
    at = shown(spark, table)
    if at == number:
        return number
    _, before = manifest(spark, path, at)
    if at and not before:  # vacuumed: every day is looked at
        before = {_day(s): "" for s in K.existing_partitions(spark, table)}
    fresh = sorted(d for d in days if d not in before)
    for i in range(0, len(fresh), batch):
        parts = " ".join(f"{_spec(d)} LOCATION '{day_folder(path, d, days[d])}'" for d in fresh[i : i + batch])
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {parts}")
    for d in sorted(d for d in days if d in before and before[d] != days[d]):
        spark.sql(f"ALTER TABLE {table} {_spec(d)} SET LOCATION '{day_folder(path, d, days[d])}'")
    gone = sorted(d for d in before if d not in days)
    if gone:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {', '.join(map(_spec, gone))}")
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{PROPERTY}' = '{number}')")
    spark.catalog.refreshTable(table)
    return number


def _day(spec: dict[str, int]) -> str:
    year, month, day = (spec[c] for c in S.DAY_PARTITION)
    return UNDATED if year is None else dt.date(year, month, day).isoformat()


def read_current(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """The rows of a manifest, the current one by default, without a catalog.

    Columns that older versions lack are NULL there.
    """
    _, days = manifest(spark, path, number)
    versions: dict[str, list[str]] = {}
    for d, v in sorted(days.items()):
        versions.setdefault(v, []).append(day_folder(path, d, v))
    if not versions:
        raise FileNotFoundError(f"nothing is published below {path}")
    frames = [
        spark.read.option("basePath", f"{path}/{FOLDER}/{v}").parquet(*folders) for v, folders in sorted(versions.items())
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def vacuum(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Delete day folders that none of the last ``keep`` manifests names, and older manifests.

    A version that was written but never published goes too, so no run may be writing.
    Returns the number of folders deleted.
    """
    numbers = _manifests(spark, path)
    named = {(v, d) for n in numbers[-keep:] for d, v in manifest(spark, path, n)[1].items()}
    versions = {v for v, _ in named}
    fs, root = _fs(spark, f"{path}/{FOLDER}")
    gone = 0
    for status in fs.listStatus(root) if fs.exists(root) else []:
        version = status.getPath().getName()
        if version in ("manifests", "live"):
            continue
        if version not in versions:
            fs.delete(status.getPath(), True)
            gone += 1
            continue
        days = spark._jvm.org.apache.hadoop.fs.Path(status.getPath(), "/".join(f"{c}=*" for c in S.DAY_PARTITION))
        for folder in fs.globStatus(days) or []:
            names = folder.getPath().toString().split("/")[-3:]
            values = [n.partition("=")[2] for n in names]
            day = UNDATED if values[0] == _NULL else dt.date(*map(int, values)).isoformat()
            if (version, day) not in named:
                fs.delete(folder.getPath(), True)
                gone += 1
    for n in numbers[:-keep]:
        fs.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{FOLDER}/manifests/{n:08d}.json"), False)
    return gone
