"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterable, Iterator, Sequence
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from orderlens.session import run_dir

#: An id that is NULL sorts behind all others under this value.
LAST = np.iinfo(np.int64).max


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame as a table in the shared folder: computed once, and its lineage is cut."""
    path = run_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or a longer one where the frame already has that column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def without(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Drops input columns that carry the name of an output column (in any case)."""
    names = {n.lower() for n in names}
    return df.select([F.col(f"`{c}`") for c in df.columns if c.lower() not in names])


def adding(df: DataFrame, fields: str) -> StructType:
    """The frame's schema with ``fields`` (DDL) behind it."""
    out = StructType(list(df.schema.fields))
    for f in StructType.fromDDL(fields).fields:
        out = out.add(f)
    return out


def as_bytes(column: pa.ChunkedArray | pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; NULL is empty."""
    return [b if b is not None else b"" for b in column.cast(pa.binary()).to_pylist()]


def slices(batch: pa.RecordBatch, text_col: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows with about ``most`` bytes of text, or one longer text, each."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text_col)), 0).to_numpy(zero_copy_only=False)
    begin = total = 0
    for i, n in enumerate(sizes.tolist()):
        if total and total + n > most:
            yield batch.slice(begin, i - begin)
            begin, total = i, 0
        total += n
    if batch.num_rows > begin:
        yield batch.slice(begin)


def codes(words: Sequence[bytes]) -> np.ndarray:
    """XXH64 of each word."""
    return np.fromiter(map(xxhash.xxh64_intdigest, words), dtype=np.uint64, count=len(words))


def mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A 64-bit fingerprint of the pair (a, b), elementwise."""
    x = a * np.uint64(0x9E3779B97F4A7C15)
    x += b
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def shifted(a: np.ndarray, by: int) -> np.ndarray:
    """``a[i + by]`` at ``i``; zero beyond the end."""
    out = np.zeros_like(a)
    if by < len(a):
        out[: len(a) - by] = a[by:]
    return out


def pack(a: np.ndarray) -> bytes:
    """64-bit numbers with equal bytes side by side, which the shuffle's compression then shortens."""
    return np.ascontiguousarray(a).view(np.uint8).reshape(-1, 8).T.tobytes()


def unpack(b: bytes, dtype=np.uint64) -> np.ndarray:
    return np.frombuffer(b, np.uint8).reshape(8, -1).T.copy().view(dtype).ravel()


def chunked(docs: DataFrame, id_col: str, text_col: str, name: str, chunk_bytes: int) -> DataFrame:
    """Adds column ``name``: a chunk number, hashed from the id, so that a chunk holds about ``chunk_bytes`` of text.

    Rows of one id share a chunk; rows without an id are spread by their text.  Small
    inputs get chunks of a quarter of that, up to one for each shuffle partition.  The
    number of chunks follows the text and not the number of partitions, because each
    chunk sends a row to each group.
    """
    total = docs.agg(F.sum(F.octet_length(F.col(text_col))).alias("n")).first()["n"] or 0
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n = max(1, -(-total // chunk_bytes), min(parts, -(-4 * total // chunk_bytes)))
    key = F.when(F.col(id_col).isNull(), F.xxhash64(F.col(text_col))).otherwise(F.xxhash64(F.col(id_col)))
    return docs.withColumn(name, F.pmod(key, F.lit(n)))


def sorted_rows(table: pa.Table, id_col: str, text_col: str) -> tuple[pa.Table, np.ndarray, list[bytes]]:
    """A chunk's rows by (id, text), NULL ids last; the ids with ``LAST`` for NULL; the texts."""
    ids = table.column(id_col).cast(pa.int64()).fill_null(LAST).to_numpy()
    texts = as_bytes(table.column(text_col))
    order = sorted(range(len(texts)), key=lambda i: (ids[i], texts[i]))
    return table.take(pa.array(order, pa.int64())), ids[order], [texts[i] for i in order]


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Lets Python workers import this library, once per application, where it is not on their path.

    Nothing to do where PYTHONPATH names it; else the package goes out as a zip that
    Spark's own file server hands to every executor.
    """
    root = Path(__file__).resolve().parents[2]
    app = spark.sparkContext.applicationId
    if app in _SHIPPED or str(root) in os.environ.get("PYTHONPATH", "").split(os.pathsep):
        return
    name = Path(tempfile.mkdtemp(prefix="orderlens-")) / "orderlens.zip"
    with zipfile.ZipFile(name, "w") as z:
        for p in sorted((root / "orderlens").rglob("*.py")):
            z.write(p, p.relative_to(root))
    spark.sparkContext.addPyFile(str(name))
    _SHIPPED.add(app)
