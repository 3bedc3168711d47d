"""What the operators of this subpackage share: table access, stage tables, batches, hashes.

Column names that begin with two underscores are the operators' own.
"""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import gc
import os
import re
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from functools import wraps
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

PACKAGE_ROOT = Path(__file__).resolve().parents[2]
#: Texts are handed to vectorised code in slices of about this many bytes, so that a
#: worker's memory does not follow the size of a batch.
SLICE_BYTES = 4 << 20

#: Lower-cases A-Z and turns every byte that is no word byte into a space. Word bytes are
#: digits, letters and all bytes of characters beyond ASCII.
WORD_TABLE = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where it is unset a temporary folder is made and set on a single machine; on a cluster that is an error.
    """
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        jvm_dir = spark.sparkContext._jsc.sc().getCheckpointDir()
        where = jvm_dir.get() if jvm_dir.isDefined() else None
    if not where:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("spark.checkpoint.dir is not set: executors of a cluster share no other folder")
        where = tempfile.mkdtemp(prefix="voltweave-")
        spark.sparkContext.setCheckpointDir(where)
    return where.rstrip("/")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` to a new table in the shared folder and reads it back: lineage ends here."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if not _LEFT:
        atexit.register(_drop_all)
    _LEFT[path] = spark
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._voltweave_path = path
    return out


def drop_stage(df: DataFrame) -> None:
    """Deletes a table made by :func:`stage` that nothing reads any more."""
    _drop(df.sparkSession, df._voltweave_path)


def _drop(spark: SparkSession, path: str) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    _LEFT.pop(path, None)


#: Stage tables that are not deleted yet: those that a result still reads go when the driver ends.
_LEFT: dict[str, SparkSession] = {}


def _drop_all() -> None:
    for path, spark in list(_LEFT.items()):
        with contextlib.suppress(Exception):  # the session may have ended
            _drop(spark, path)


def ship(spark: SparkSession) -> None:
    """Makes this package importable on the workers where neither their path nor folder has it."""
    sc = spark.sparkContext
    here = {str(PACKAGE_ROOT), str(PACKAGE_ROOT.resolve())}
    known = set(os.environ.get("PYTHONPATH", "").split(os.pathsep))
    if here & known or os.path.isdir(os.path.join(os.getcwd(), "voltweave")) or getattr(sc, "_voltweave_shipped", False):
        return
    target = Path(tempfile.mkdtemp(prefix="voltweave-src-")) / "voltweave.zip"
    with zipfile.ZipFile(target, "w") as z:
        for p in sorted((PACKAGE_ROOT / "voltweave").rglob("*.py")):
            z.write(p, p.relative_to(PACKAGE_ROOT))
    sc.addPyFile(str(target))
    sc._voltweave_shipped = True


def quoted(name: str):
    """A column by its exact name, dots and quotes included."""
    return F.col("`" + name.replace("`", "``") + "`")


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` less the columns of these names (in any case): an operator's results replace them."""
    gone = {x.lower() for x in names}
    return df.select(*(quoted(x) for x in df.columns if x.lower() not in gone))


def with_plain_names(operator: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """Gives columns whose names hold dots or backticks, which Arrow functions can't take, other names while the operator works."""

    @wraps(operator)
    def work(df: DataFrame, *args, **kw) -> DataFrame:
        odd = {x: f"__plain_{i}" for i, x in enumerate(df.columns) if "." in x or "`" in x}
        if not odd:
            return operator(df, *args, **kw)
        out = operator(df.select(*(quoted(x).alias(odd.get(x, x)) for x in df.columns)), *args, **kw)
        back = {b: a for a, b in odd.items()}
        return out.select(*(quoted(x).alias(back.get(x, x)) for x in out.columns))

    return work


def schema_of(df: DataFrame, more: str, less: str = "") -> StructType:
    """The schema of ``df`` without column ``less``, followed by the columns that the DDL text ``more`` names."""
    return StructType([f for f in df.schema.fields if f.name != less] + StructType.fromDDL(more).fields)


def as_bytes(column: pa.Array) -> list[bytes]:
    """Values of a string column as UTF-8 bytes; null gives b""."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cuts batches into runs of rows with at most ``most`` bytes of text; a longer text comes alone."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        sizes = np.asarray(pc.binary_length(batch.column(text)).fill_null(0)).astype(np.int64)
        ends, start = np.cumsum(sizes), 0
        while start < n:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + most, side="right")))
            yield batch.slice(start, stop - start)
            start = stop
        del batch
    give_back()


def give_back() -> None:
    """Hands freed memory back to the system: workers are used again by later stages, next to the executor's heap."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser over unsigned 64-bit integers (the splitmix64 constants)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def words(text: bytes) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lower-cased."""
    return text.translate(WORD_TABLE).split()


def sql_string(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


CONTINUATION = re.compile(rb"[\x80-\xbf]")


def code_points(text: bytes) -> int:
    return len(text) - len(CONTINUATION.findall(text)) if not text.isascii() else len(text)
