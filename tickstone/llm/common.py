"""Small helpers shared by the text operators."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Text bytes a Python worker takes in hand at once; one longer text goes alone.
CHUNK_BYTES = 4 << 20
#: White space between words: blank, tab, line feed, vertical tab, form feed, return.
BLANKS = "[\\x20\\x09-\\x0D]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A shared test table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: str | Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; a null id counts as empty text."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.pmod(F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")), F.lit(parts))


def lower_ascii(text: Column) -> Column:
    """The text with A-Z alone in lower case."""
    return F.translate(text, UPPER, LOWER)


def let(value: Column, body) -> Column:
    """``body`` of ``value``, with ``value`` computed once however often it is used."""
    return F.element_at(F.transform(F.array(value), body), 1)


def salted_lookup(
    rows: DataFrame, facts: DataFrame, on: Sequence[str], salt: Column, salts: int = 16
) -> DataFrame:
    """``rows`` left-joined to ``facts``, which has one row per key.

    Each fact is repeated for every salt, so that a key held by a third of all
    rows is met by ``salts`` tasks and not by one.  Null keys equal each other.
    """
    spread = facts.select(
        *(F.col(c).alias(f"_on_{c}") for c in on),
        *(c for c in facts.columns if c not in on),
        F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_on_salt"),
    )
    met = F.lit(True)
    for c in on:
        met = met & F.col(c).eqNullSafe(F.col(f"_on_{c}"))
    salted = rows.withColumn("_salt", F.pmod(salt, F.lit(salts)).cast("int"))
    joined = salted.join(spread, met & (F.col("_salt") == F.col("_on_salt")), "left")
    return joined.drop("_salt", "_on_salt", *(f"_on_{c}" for c in on))


#: Rows of a key above which its fact is repeated for salts.
HOT_ROWS = 10_000


def counted_lookup(
    rows: DataFrame, facts: DataFrame, on: Sequence[str], count: str, salt: Column, hot: int = HOT_ROWS
) -> DataFrame:
    """``rows`` inner-joined to ``facts``, which has one row per key without nulls, and in
    ``count`` the number of rows that hold it.

    Only keys of at least ``hot`` rows are repeated per salt, and these are few, whatever
    the number of keys; no other key can load a task.
    """
    many = facts.filter(F.col(count) >= hot).drop(count).withColumn("_hot", F.lit(True))
    few = facts.filter(F.col(count) < hot).drop(count)
    met = salted_lookup(rows, many, on, salt)
    rest = met.filter("_hot is null").select(*rows.columns).join(few, list(on))
    return met.filter("_hot").drop("_hot").unionByName(rest)


def carried(docs: DataFrame, made: Sequence[str], keep: Sequence[str] | None = None) -> list[str]:
    """The columns (all, or those named) that stay when the ``made`` ones are added; a
    column that goes by the name of one of these, in whatever case, is replaced by it."""
    taken = {m.lower() for m in made}
    return [c for c in (docs.columns if keep is None else keep) if c.lower() not in taken]


def beside(docs: DataFrame, kept: Sequence[str], **more: Column) -> DataFrame:
    """``row``, a struct of the kept columns, and what an operator needs beside them, so
    that no name of its own can meet one of the table's."""
    fields = [F.col(f"`{c}`").alias(c) for c in kept] or [F.lit(None).cast("int").alias("none")]
    return docs.select(F.struct(*fields).alias("row"), *(c.alias(n) for n, c in more.items()))


def unpacked(rows: DataFrame, kept: Sequence[str], *more: str) -> DataFrame:
    """The kept columns out of ``row``, and others after them."""
    return rows.select(*(F.col("row")[c].alias(c) for c in kept), *more)


def row_schema(rows: DataFrame, more: str) -> T.StructType:
    """The type of ``row``, and further fields in DDL."""
    return T.StructType([rows.schema["row"], *T.StructType.fromDDL(more).fields])


def released(work):
    """``work`` over Arrow batches, giving memory back to the system at its end, since
    the worker process lives on for tasks of other kinds."""

    def run(batches):
        try:
            yield from work(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
            if trim is not None:
                trim(0)

    return run


def text_chunks(
    batches: Iterator[pa.RecordBatch], column: str, limit: int = CHUNK_BYTES
) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of the batches of about ``limit`` text bytes, with the texts as
    UTF-8; a null text comes as empty bytes."""
    for batch in batches:
        texts = batch.column(batch.schema.get_field_index(column))
        sizes = np.cumsum(np.asarray(
            pc.fill_null(pc.binary_length(texts), 0), dtype=np.int64
        ))
        start = 0
        while start < batch.num_rows:
            done = sizes[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(sizes, done + limit, "right")))
            part = texts.slice(start, end - start).cast(pa.large_binary())
            yield batch.slice(start, end - start), [x or b"" for x in part.to_pylist()]
            start = end
