"""Column rules and batch helpers that several operators share."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterable, Iterator
from string import ascii_lowercase, ascii_uppercase

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: What separates words, as the body of a character class.
BLANKS = r"\x20\x09-\x0D"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def ascii_lower(c: Column) -> Column:
    """A-Z in lower case, all else unchanged (`lower` would change other letters too)."""
    return F.translate(c, ascii_uppercase, ascii_lowercase)


def remainder(column: str, modulus: int) -> Column:
    """crc32 of a value as text, modulo; a null value counts as the empty text."""
    as_text = F.coalesce(F.col(column).cast("string"), F.lit(""))
    return F.crc32(as_text.cast("binary")) % modulus


def words(text: str) -> list[bytes]:
    """The words of a text in UTF-8; bytes.split() knows exactly the blanks of BLANKS."""
    return text.encode("utf-8", "surrogatepass").split()


def lower_words(text: str) -> list[bytes]:
    """As `words`, A-Z in lower case; bytes.lower() leaves all other bytes alone."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def slices(batches: Iterable[pa.RecordBatch], column: str, most: int = 8_000_000) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut so that a slice holds about `most` bytes of a text column.

    A single longer text is a slice of its own, so memory follows the longest text.
    """
    for batch in batches:
        sizes = pa.compute.binary_length(batch.column(column)).fill_null(0).to_pylist()
        start = held = 0
        for i, size in enumerate(sizes):
            if held and held + size > most:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        if start < len(sizes):
            yield batch.slice(start)
    give_back()


def give_back() -> None:
    """Returns freed memory to the system: Python workers outlive their tasks."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    return [t or "" for t in batch.column(column).to_pylist()]
