"""Token totals by source, language and tokenizer version, kept up to date by signed batches.

A tokenizer version is a public vocabulary file, by its name. A batch says what changed: counted
documents that came (+), that went (-), or whose counts were revised (- the old, + the new). It is
reduced to a signed sum per key, written under a hidden name and then renamed to
``batch-<number>-<attempt>``, so a reader meets whole batches only. Batches are numbered from 1.
Committing a number again does nothing; should two writers of one number both get through, the
first name in order counts and the other is never read. What a failed attempt left stays hidden.

``fold`` adds the batches without a gap after the last snapshot to it, as
``snapshot-<last number>-<attempt>``. Totals are the latest snapshot and the batches after its
number: a batch is in the snapshot or after it, never both, whatever was renamed in between. So a
job may be run again at any point, no total is changed in place, and what is read does not grow
with the batches ever committed. ``vacuum`` deletes what a snapshot has replaced.

The state's folder must be on a store that renames a folder at once (HDFS, a shared disk). Attempts
at one number must say the same.

Defined results: a null text counts as empty; a null source or language is a key of its own; keys
whose documents and tokens both come to zero are left out; a batch without rows is committed as an
empty one; a document named twice counts twice; other columns are ignored; without batches there
are no totals.
"""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from riskloom.llm import tokens
from riskloom.llm.common import lean
from riskloom.session import store_of

KEY = ["source", "lang", "tokenizer"]
SCHEMA = "source string, lang string, tokenizer string, documents long, tokens long"
KNOWN_WORDS = 200_000
_NAME = re.compile(r"(batch|snapshot)-(\d+)-([0-9a-f]+)")


def version_of(vocabulary: str) -> str:
    """A tokenizer version's name: its file's, without the ending."""
    return os.path.basename(vocabulary).rsplit(".", 1)[0]


def with_counts(rows: DataFrame, texts: Sequence[str], vocabulary: str) -> DataFrame:
    """The table with each of these text columns replaced by its number of token ids, as long; the
    count of a missing text is missing."""
    fields = [f"`{f.name}` {'long' if f.name in texts else f.dataType.simpleString()}" for f in rows.schema.fields]

    def number(texts: pa.Array) -> pa.Array:
        filled = pc.fill_null(texts, "")
        sizes = [np.diff(tokens.encoder(vocabulary, KNOWN_WORDS).encode(filled[s])[1]) for s in tokens.slices(filled)]
        return pa.array(np.concatenate([np.zeros(0, np.int64), *sizes]), pa.int64(), mask=pc.is_null(texts).to_numpy(False))

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            columns = [number(c) if n in texts else c for n, c in zip(names, batch.columns)]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return rows.mapInArrow(lean(convert, tokens=True), ", ".join(fields))


def counted(rows: DataFrame, count: str, tokenizer: str) -> DataFrame:
    """``source, lang, tokenizer, tokens`` from a table with a column of counts."""
    return rows.select("source", "lang", F.lit(tokenizer).alias("tokenizer"), F.col(f"`{count}`").cast("long").alias("tokens"))


def inserted(rows: DataFrame) -> DataFrame:
    return rows.select(*KEY, F.lit(1).cast("long").alias("documents"), "tokens")


def deleted(rows: DataFrame) -> DataFrame:
    return rows.select(*KEY, F.lit(-1).cast("long").alias("documents"), (-F.col("tokens")).alias("tokens"))


def revised(before: DataFrame, after: DataFrame) -> DataFrame:
    return deleted(before).unionByName(inserted(after))


def _found(spark: SparkSession, state: str) -> list[tuple[str, int, str]]:
    """``(kind, number, path)`` of all that was published below the state's folder, by name."""
    store, place = store_of(spark, state)
    if not store.exists(place):
        return []
    names = sorted(f.getPath().getName() for f in store.listStatus(place) if f.isDirectory())
    return [(m[1], int(m[2]), f"{state.rstrip('/')}/{n}") for n in names if (m := _NAME.fullmatch(n))]


def _last_snapshot(found: list[tuple[str, int, str]]) -> tuple[int, str | None]:
    last = max((n for kind, n, _ in found if kind == "snapshot"), default=0)
    return last, next((path for kind, n, path in found if kind == "snapshot" and n == last), None)


def _batches_after(found: list[tuple[str, int, str]], last: int) -> dict[int, str]:
    """The batches after a number, one path each: the first by name."""
    later: dict[int, str] = {}
    for kind, number, path in found:
        if kind == "batch" and number > last:
            later.setdefault(number, path)
    return later


def committed(spark: SparkSession, state: str, batch: int) -> bool:
    found = _found(spark, state)
    last, _ = _last_snapshot(found)
    return batch <= last or batch in _batches_after(found, last)


def _summed(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*KEY).agg(F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens"))


def _publish(state: str, name: str, rows: DataFrame) -> None:
    """Writes a hidden folder and renames it, whole, to a name nobody else has."""
    attempt, base = uuid.uuid4().hex, state.rstrip("/")
    hidden = f"{base}/_attempt-{attempt}"
    rows.write.parquet(hidden)
    store, written = store_of(rows.sparkSession, hidden)
    _, place = store_of(rows.sparkSession, f"{base}/{name}-{attempt}")
    if not store.rename(written, place):
        raise OSError(f"{hidden} could not be renamed to {place}")


def commit(state: str, batch: int, changes: DataFrame) -> bool:
    """Writes a batch's signed sums unless its number is committed already; says whether it wrote."""
    if batch < 1:
        raise ValueError("batches are numbered from 1")
    if committed(changes.sparkSession, state, batch):
        return False
    _publish(state, f"batch-{batch}", _summed(changes))
    return True


def _read(spark: SparkSession, paths: list[str]) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(*paths) if paths else spark.createDataFrame([], SCHEMA)


def fold(spark: SparkSession, state: str) -> int:
    """Adds the batches that follow the last snapshot without a gap to it; the number it now holds."""
    found = _found(spark, state)
    last, snapshot = _last_snapshot(found)
    later, upto = _batches_after(found, last), last
    while upto + 1 in later:
        upto += 1
    if upto > last:
        paths = [later[n] for n in range(last + 1, upto + 1)] + ([snapshot] if snapshot else [])
        sums = _summed(_read(spark, paths)).filter("documents <> 0 or tokens <> 0")
        _publish(state, f"snapshot-{upto}", sums)
    return upto


def vacuum(spark: SparkSession, state: str) -> int:
    """Deletes the batches and snapshots that the latest snapshot replaces, and says how many;
    for times when nobody reads an older one."""
    found = _found(spark, state)
    last, snapshot = _last_snapshot(found)
    old = [path for _, number, path in found if number <= last and path != snapshot]
    for path in old:
        store, place = store_of(spark, path)
        store.delete(place, True)
    return len(old)


def totals(spark: SparkSession, state: str) -> DataFrame:
    """``source, lang, tokenizer, documents, tokens``: the latest snapshot and all batches after it."""
    found = _found(spark, state)
    last, snapshot = _last_snapshot(found)
    paths = [*_batches_after(found, last).values()] + ([snapshot] if snapshot else [])
    return _summed(_read(spark, paths)).filter("documents <> 0 or tokens <> 0")
