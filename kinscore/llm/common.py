"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
import zlib

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinscore.session import ensure_checkpoint_dir

#: one word, for Java, RE2 and Python alike; ``bytes.split()`` cuts at the same six characters
WORD = "[^\\x20\\x09-\\x0D]+"
#: Arrow rows handled together inside a task, in bytes of text
SLICE_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame) -> DataFrame:
    """Materialise in the shared checkpoint folder: cuts the lineage, survives lost executors."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder for a written table, beside the session's checkpoints."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def held_out(doc_id: Column, remainder: int = 1, folds: int = 3) -> Column:
    """True on the fold that no model learns from; a null id counts as the empty string."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % folds == remainder


def crc_fold(doc_id: int, folds: int = 3) -> int:
    return zlib.crc32(str(doc_id).encode()) % folds


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """The UTF-8 bytes of a string column; null becomes empty."""
    return [x or b"" for x in batch.column(column).cast(pa.binary()).to_pylist()]


def slices(batches, column: str = "text", limit: int = SLICE_BYTES):
    """Cut Arrow batches so that each piece holds about ``limit`` bytes of text at most (or a
    single longer row): memory in a task follows this limit, not the session's batch size."""
    import pyarrow.compute as pc

    for batch in batches:
        total, start = 0, 0
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        for i, n in enumerate(sizes.to_pylist()):
            if total and total + n > limit:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += n
        if batch.num_rows > start:
            yield batch.slice(start)


class SmallestText:
    """One text an id, where rows repeat it: says whether a row's text has a smaller hash than those
    of its key that a task has seen. Equal texts pass once. What passes is a few rows a key and task; the
    smallest of them is the key's text, wherever its rows lie."""

    def __init__(self):
        self.seen: dict = {}

    def passes(self, key, text: str | None) -> int | None:
        own = xxhash.xxh64_intdigest(text or "") - 2**63
        if own >= self.seen.get(key, 2**63):
            return None
        self.seen[key] = own
        return own


def worker_cache(name: str, make):
    """An object that outlives a task in a Python worker that Spark uses again."""
    import sys
    import types

    held = sys.modules.setdefault("_kinscore_worker_cache", types.ModuleType("_kinscore_worker_cache"))
    if name not in held.__dict__:
        held.__dict__[name] = make()
    return held.__dict__[name]


def named(column: str) -> Column:
    """A column by its exact name, which may hold dots and backquotes."""
    return F.col("`" + column.replace("`", "``") + "`")


def passed_columns(df: DataFrame, results: list[str]) -> list[str]:
    """The columns that no result column replaces; Spark tells names apart without their case."""
    taken = {r.lower() for r in results}
    return [c for c in df.columns if c.lower() not in taken]


class Shelter:
    """Plain names for the columns of a table on their way through Python: ``mapInArrow`` takes no name
    with a dot. ``passed`` are the columns that no result column replaces; ``needed`` come along."""

    def __init__(self, df: DataFrame, results: list[str], *needed: str):
        self.passed = passed_columns(df, results)
        self.names = {c: f"__in{i}" for i, c in enumerate(dict.fromkeys([*self.passed, *needed]))}
        self.source = df.select(*(named(c).alias(s) for c, s in self.names.items()))
        self.fields = [T.StructField(self.names[c], df.schema[c].dataType) for c in self.passed]

    def restored(self) -> list[Column]:
        return [F.col(self.names[c]).alias(c) for c in self.passed]


def require(df: DataFrame, *columns: str) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"columns missing: {missing}")


def with_text(df: DataFrame, like: DataFrame, new_text: Column, text: str = "text", *more: Column) -> DataFrame:
    """The columns of ``like`` out of ``df``, with a new text and an ``n_chars`` that follows it,
    and ``more`` behind them."""
    cols = []
    for f in like.schema.fields:
        if f.name == text:
            cols.append(new_text.alias(text))
        elif f.name == "n_chars":
            cols.append(F.length(new_text).cast(f.dataType).alias("n_chars"))
        else:
            cols.append(named(f.name))
    return df.select(*cols, *more)
