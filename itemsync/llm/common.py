"""Word rules, row batches and shared folders the operators of this package have in common."""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

from itemsync.session import work_dir

#: Rows of one Arrow batch that a Python task holds at a time; long texts make wider rows.
ROWS_PER_BATCH = 256

#: White space of the word rule [^\x20\x09-\x0D]+, as a regular expression of Java and RE2.
BLANK = "[\\x20\\x09-\\x0D]"
BLANK_WORD = "[^\\x20\\x09-\\x0D]+"

_SPACE = ord(" ")
#: Bytes of the word rule [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after lower-casing A-Z; all others part words.
_ALNUM = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else _SPACE for b in range(256)
)


def utf8(text: str | None) -> bytes:
    return b"" if text is None else text.encode("utf-8", "surrogatepass")


def blank_words(text: str | None) -> list[bytes]:
    """Words between white space, unchanged. Bytes split on exactly \\x20 and \\x09-\\x0D."""
    return utf8(text).split()


def lower_blank_words(text: str | None) -> list[bytes]:
    """The same with A-Z lower-cased; bytes lower-case ASCII letters only."""
    return utf8(text).lower().split()


def alnum_words(text: str | None) -> list[bytes]:
    """Runs of digits, a-z (A-Z lower-cased) and characters beyond ASCII."""
    return utf8(text).translate(_ALNUM).split()


def alnum_blanked(data: bytes) -> bytes:
    """The text with every byte outside words made a space: byte offsets stay those of the original."""
    return data.translate(_ALNUM)


def prepared(spark: SparkSession) -> SparkSession:
    """Bound the rows of an Arrow batch, as single texts may be megabytes long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_PER_BATCH))
    return spark


def fold_of(doc_id: int | None, modulus: int) -> int:
    """crc32 of the id's decimal text, modulo ``modulus``; a null id counts as empty text."""
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % modulus


def fold(doc_id: Column, modulus: int) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus


_OWN: ContextVar[str | None] = ContextVar("own_folder", default=None)


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared folder that the cluster names, or in the ``own_folder`` that is open."""
    return f"{_OWN.get() or work_dir(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def own_folder(spark: SparkSession, name: str) -> Iterator[None]:
    """Intermediate tables written inside lie in one folder, which is removed at the end.

    Whatever reads them must have been written elsewhere by then.
    """
    folder = f"{work_dir(spark)}/{name}-{uuid.uuid4().hex}"
    before = _OWN.set(folder)
    try:
        yield
    finally:
        _OWN.reset(before)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def written(df: DataFrame, name: str, folder: str | None = None) -> DataFrame:
    """``df`` once written as Parquet in the shared folder and read again: cut lineage that outlives executors."""
    spark = df.sparkSession
    folder = folder or fresh_folder(spark, name)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def map_rows(df: DataFrame, function, schema: StructType | str) -> DataFrame:
    """``function`` takes an iterator of batches, each a dictionary of column lists, and yields such batches."""
    kind = _parse_datatype_string(schema) if isinstance(schema, str) else schema
    fields = to_arrow_schema(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = ({n: b.column(i).to_pylist() for i, n in enumerate(b.schema.names)} for b in batches)
        for out in function(columns):
            yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in fields], schema=fields)

    return df.mapInArrow(run, kind)
