"""Small helpers that several operators share."""

from __future__ import annotations

import os
import re
import shutil
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The white space that the result contracts name, [\x20\x09-\x0D].
BLANKS = " \t\n\x0b\x0c\r"

WORD = re.compile(r"[^\x20\x09-\x0D]+")
# lower-case A-Z only, as the contracts ask
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    """Place of a public vocabulary file; TOKENIZER_DIR names another folder."""
    folder = os.environ.get("TOKENIZER_DIR")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def without_blanks(text: Column) -> Column:
    """The text without white space; null counts as empty.

    Plain replacements, one per character: each is a byte search in the JVM.
    """
    out = F.coalesce(text, F.lit(""))
    for blank in BLANKS:
        out = F.replace(out, F.lit(blank), F.lit(""))
    return out


@lru_cache(maxsize=None)
def _package_archive() -> str:
    package = Path(__file__).resolve().parents[1]
    base = os.path.join(tempfile.mkdtemp(prefix="py-files-"), package.name)
    return shutil.make_archive(base, "zip", package.parent, package.name)


@lru_cache(maxsize=None)
def _ship(application: str, spark: SparkSession) -> None:
    spark.sparkContext.addPyFile(_package_archive())


def for_python(spark: SparkSession, rows: int = 512) -> None:
    """Make Python stages possible and bounded.

    The package goes to the executors as a py-file, by Spark's own file server. An
    Arrow batch brings ``rows`` rows at most into a worker: the default of 10,000 is
    meant for narrow rows, not for whole texts.
    """
    _ship(spark.sparkContext.applicationId, spark)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > rows:
        spark.conf.set(key, str(rows))


@contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """At most ``rows`` rows per Arrow batch for what is run inside, for rows that are blocks."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, old)


def byte_letters() -> list[str]:
    """The printable stand-in of each byte: itself if visible, else from U+0100 on."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = iter(range(256, 512))
    return [chr(b if b in visible else next(hidden)) for b in range(256)]
