"""Stored state as Parquet parts under a log of versions: upserts without a row-level table format.

``<folder>/log/<n>~<batch>`` describes version n: the schema and, for every part of the key space, the generation that holds it. The
parts lie in ``<folder>/data/gen=<n>/_part=<p>``. A write puts the parts it touches into a new generation and then renames its log
entry into place; entries are never deleted or moved, and the highest one counts. Whatever step a writer dies at, readers see the old
state or the new one, and the next writer starts from there. The batch ids stand in the names of the log entries, all of them.
"""

from __future__ import annotations

import json
import uuid
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Parts of the key space of a new state.
PARTS = 64


def _files(spark: SparkSession, name: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def _log(spark: SparkSession, folder: str) -> list[tuple[int, str]]:
    """(version, batch) of every log entry."""
    files, path = _files(spark, f"{folder}/log")
    if not files.exists(path):
        return []
    names = [status.getPath().getName() for status in files.listStatus(path)]
    return sorted((int(n.partition("~")[0]), n.partition("~")[2]) for n in names if n[0].isdigit())


def _entry(spark: SparkSession, folder: str, version: int, batch: str) -> dict:
    return json.loads(spark.read.text(f"{folder}/log/{version:012d}~{batch}", wholetext=True).first()[0])


def _put(spark: SparkSession, folder: str, version: int, batch: str, entry: dict) -> None:
    files, draft = _files(spark, f"{folder}/log/.draft-{uuid.uuid4().hex}")
    out = files.create(draft, True)
    out.write(json.dumps(entry).encode())
    out.close()
    _, name = _files(spark, f"{folder}/log/{version:012d}~{batch}")
    if any(v == version for v, _ in _log(spark, folder)) or not files.rename(draft, name):
        raise OSError(f"another writer has stored version {version}")


def _read(spark: SparkSession, folder: str, entry: dict, parts: list[str]) -> DataFrame:
    schema = T.StructType.fromJson(entry["schema"])
    paths = [f"{folder}/data/gen={entry['held'][p]}/_part={p}" for p in parts if p in entry["held"]]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def current(spark: SparkSession, folder: str) -> DataFrame | None:
    """The stored state, null before the first write."""
    log = _log(spark, folder)
    if not log:
        return None
    entry = _entry(spark, folder, *log[-1])
    return _read(spark, folder, entry, list(entry["held"]))


def upsert(spark: SparkSession, folder: str, rows: DataFrame, keys: list[str], batch: str | None = None, parts: int = PARTS) -> bool:
    """Store ``rows`` over the state by ``keys``; whether anything was written.

    A batch that was applied already is left out, however long ago, so a replay changes nothing. ``rows`` must hold a key once.
    Only the parts of the key space that ``rows`` touch are written anew; the others stay where they are. Columns that are new
    are null in older rows. The number of parts is fixed by the first write.
    """
    log = _log(spark, folder)
    name = quote(batch, safe="") if batch is not None else ""
    if batch is not None and any(b == name for _, b in log):
        return False
    version = log[-1][0] + 1 if log else 1
    before = _entry(spark, folder, *log[-1]) if log else {"parts": parts, "keys": keys, "held": {}, "schema": rows.schema.jsonValue()}
    if before["keys"] != keys:
        raise ValueError(f"the state is kept by {before['keys']}")
    part = F.pmod(F.xxhash64(*keys), F.lit(before["parts"])).cast("int")
    touched = [str(r[0]) for r in rows.select(part.alias("p")).distinct().collect()]
    old = _read(spark, folder, before, touched)
    after = old.join(rows.select(*keys), keys, "left_anti").unionByName(rows, allowMissingColumns=True)
    held = dict(before["held"])
    if touched:
        after.withColumn("_part", part).repartition("_part").write.mode("overwrite").partitionBy("_part").parquet(f"{folder}/data/gen={version}")
        held |= {p: version for p in touched}
    known = {f.name for f in T.StructType.fromJson(before["schema"])}
    schema = T.StructType([*T.StructType.fromJson(before["schema"]), *[f for f in after.schema if f.name not in known]])
    _put(spark, folder, version, name, {**before, "held": held, "schema": schema.jsonValue()})
    return True


def batch_writer(folder: str, keys: list[str], run: str, order: str | None = None):
    """A ``foreachBatch`` function that stores each micro-batch once; of rows with the same key the one with the greatest ``order``
    counts, of those that tie one by a hash of the whole row."""

    def write(rows: DataFrame, batch_id: int) -> None:
        last = Window.partitionBy(*keys).orderBy(*([F.col(order).desc_nulls_last()] if order else []), F.xxhash64(*rows.columns).desc())
        once = rows.withColumn("_n", F.row_number().over(last)).where("_n = 1").drop("_n")
        upsert(rows.sparkSession, folder, once, keys, f"{run}-{batch_id}")

    return write


def conditional_update(stored: DataFrame, updates: DataFrame, keys: list[str], columns: list[str], unless: str | None = None) -> DataFrame:
    """``stored`` with ``columns`` taken from ``updates`` where they are known; an update that equals ``unless`` changes nothing."""
    new = updates.select(*keys, *[F.col(c).alias(f"_new_{c}") for c in columns])
    joined = stored.join(new, keys, "left")
    for c in columns:
        value = F.col(f"_new_{c}")
        joined = joined.withColumn(c, F.coalesce(F.when(value != unless, value) if unless is not None else value, F.col(c)))
    return joined.select(*stored.columns)
