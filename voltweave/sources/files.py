"""Files of any Hadoop file system: listing, existence, small documents."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _path(spark, path)
    return fs.exists(p)


def listed(spark: SparkSession, folder: str) -> list[str]:
    """Direct children of a folder that are files, by name; none where it is missing."""
    p, fs = _path(spark, folder)
    return sorted(s.getPath().toString() for s in fs.listStatus(p) if s.isFile()) if fs.exists(p) else []


def geojson_files(spark: SparkSession, folder: str, contains: str = "reseau_souterrain_hta") -> list[str]:
    return [x for x in listed(spark, folder) if contains in x and x.endswith(".geojson")]


def sample_files(spark: SparkSession, folder: str, most: int = 5) -> list[str]:
    """GeoJSON files among the first ``most`` files (the limit comes before the filter)."""
    return [x for x in listed(spark, folder)[:most] if x.endswith(".geojson")]


def delete(spark: SparkSession, path: str) -> bool:
    p, fs = _path(spark, path)
    return fs.delete(p, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small document; the folder is made."""
    p, fs = _path(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str:
    return "".join(r.value for r in spark.read.text(path, wholetext=True).collect())


def concat(spark: SparkSession, folder: str, target: str, head: str, tail: str, skip: int = 0) -> None:
    """head, the bytes of the folder's part files in order (but the first ``skip``), and tail, as one file: streamed, never held."""
    jvm = spark.sparkContext._jvm
    p, fs = _path(spark, target)
    out = fs.create(p, True)
    try:
        out.write(bytearray(head.encode()))
        for part in listed(spark, folder):
            if part.rsplit("/", 1)[-1].startswith("part-"):
                q, own = _path(spark, part)
                if not own.getFileStatus(q).getLen():
                    continue
                source = own.open(q)
                try:
                    source.seek(skip)
                    skip = 0
                    jvm.org.apache.hadoop.io.IOUtils.copyBytes(source, out, 1 << 20, False)
                finally:
                    source.close()
        out.write(bytearray(tail.encode()))
    finally:
        out.close()
