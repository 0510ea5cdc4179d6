"""Shared pieces of the corpus operators: word rules, storage, small helpers."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.sources.scratch import Scratch, scratch_root  # noqa: F401

#: Fixed value of the word contracts: a word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def spaced(text: Column) -> Column:
    """The text with each ASCII white-space character as one blank (plain replacements, no regular expression)."""
    for ch in SPACE_CHARS[1:]:
        text = F.replace(text, F.lit(ch), F.lit(" "))
    return text


def words_of(text: Column) -> Column:
    """The words of a text as an array; splitting at a single blank avoids the regular-expression engine."""
    return F.filter(F.split(spaced(text), " ", -1), lambda w: w != "")


def without(text: Column, characters: str) -> Column:
    for ch in characters:
        text = F.replace(text, F.lit(ch), F.lit(""))
    return text


def word_count(column: str = "text") -> Column:
    """Number of words of a text; null counts as empty."""
    return F.size(words_of(text_or_empty(column))).cast("long")


def crc_mod(column: str, modulus: int) -> Column:
    """crc32 of an id written as text, modulo ``modulus`` (null id: as the empty text)."""
    return F.pmod(F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")), F.lit(modulus))


def let(value: Column, body) -> Column:
    """Bind ``value`` once and use it many times inside ``body``.

    Catalyst inlines repeated column expressions into lambdas, where they
    would be evaluated once per element; a one-element transform keeps the
    value evaluated once per row.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


#: Names of the two numbers that tell rows apart.
ROW_KEY = ("__row_file", "__row_index")


def with_row_key(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """``docs`` with :data:`ROW_KEY`, two numbers that no other row has, whatever ids and texts repeat.

    A row of a Parquet table is told apart by its file (a 64-bit hash of the
    path) and its place in the file, which stay the same however often the
    table is read.  Anything else is written once, with numbers.
    """
    if "_metadata" not in docs.columns:
        try:
            return docs.select("*", F.xxhash64("_metadata.file_path").alias(ROW_KEY[0]), F.col("_metadata.row_index").alias(ROW_KEY[1]))
        except AnalysisException:
            pass
    numbered = docs.select("*", F.lit(0).cast("long").alias(ROW_KEY[0]), F.monotonically_increasing_id().alias(ROW_KEY[1]))
    return scratch.put(numbered, "numbered")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores behind it until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


Batches = Iterator[pa.RecordBatch]


def tidy(run: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """A batch function that hands its memory back to the system when it ends, since workers live on and serve other stages."""

    def tidied(batches: Batches) -> Batches:
        yield from run(batches)
        release()

    return tidied


def release() -> None:
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        return
