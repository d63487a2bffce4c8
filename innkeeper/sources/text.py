"""JSON-Lines files as the (file, ord, value) line contract, and file listings.

``spark.read.text`` splits large files across tasks; the default separator handles
``\\n``, ``\\r\\n`` and ``\\r``. Each row carries its split (``_split`` =
``_metadata.file_block_start``) and a row id ``_mid`` that is contiguous within the
split, so exact physical line numbers are recoverable (operators.ordinal) without
sorting the data.
"""

from __future__ import annotations

import itertools
import os
import re
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import staged

LOGICAL_FILE_DIR = r"/file=([^/]+)/[^/]*$"   # written feeds: <root>/file=<name>/part-*.txt


def uri_of(path: Column) -> Column:
    """A path as Spark reports it (percent-encoded URI) as the qualified, unencoded URI.

    "+" is not encoded in a URI's path, and url_decode reads it as a space.
    """
    return F.regexp_replace(F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))), "^file:/+", "file:/")


def norm_path(c: Column) -> Column:
    """``uri_of`` without the ``file:`` scheme."""
    return F.regexp_replace(uri_of(c), "^file:", "")


def qualified(spark: SparkSession, path: str) -> str:
    """The qualified URI of a path given as a relative or absolute path or as a URI, unencoded."""
    jvm = spark._jvm
    if path.startswith("file:"):
        path = "/" + path[len("file:"):].lstrip("/")
    p = jvm.org.apache.hadoop.fs.Path(path if "://" in path else os.path.abspath(path))
    p = p.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(p)
    return re.sub("^file:/+", "file:/", p.toString()).rstrip("/")


def read_lines(spark: SparkSession, paths: list[str], line_sep: str | None = None,
               glob: str | None = None, recursive: bool = False) -> DataFrame:
    """Lines of files and folders in one job: (file, ord, value, _split, _mid).

    Each physical file is read once, however often it is named. ``file`` is its
    qualified URI; ``ord`` = (file, split start, row id) is its physical order.
    ``line_sep="\\n"`` gives the object-store policy (split on LF only; a trailing
    CR is JSON white space). An empty list of paths gives no lines.
    """
    r = spark.read
    if line_sep:
        r = r.option("lineSep", line_sep)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if recursive:
        r = r.option("recursiveFileLookup", "true")
    raw = r.text(_roots(spark, paths))
    return raw.select(
        uri_of(F.col("_metadata.file_path")).alias("file"),
        F.col("_metadata.file_block_start").alias("_split"),
        F.monotonically_increasing_id().alias("_mid"),
        "value",
    ).select("file", F.struct("file", "_split", "_mid").alias("ord"), "value", "_split", "_mid")


def _roots(spark: SparkSession, paths: list[str]) -> list[str]:
    """Distinct qualified paths without those below another one, as globs that match themselves."""
    uris = sorted({qualified(spark, p) for p in paths})
    named = set(uris)
    roots = [u for u in uris if named.isdisjoint(_parents(u))]
    return [re.sub(r"([\\{}\[\]*?])", r"\\\1", r) for r in roots]


def _parents(uri: str) -> list[str]:
    parts = uri.split("/")
    return ["/".join(parts[:k]) for k in range(1, len(parts))]


def list_files(spark: SparkSession, paths: list[str], glob: str | None = None,
               recursive: bool = False) -> DataFrame:
    """(uri, length) of the non-empty files that ``read_lines`` reads; ``content`` is never selected, so never read."""
    r = spark.read.format("binaryFile")
    if glob:
        r = r.option("pathGlobFilter", glob)
    if recursive:
        r = r.option("recursiveFileLookup", "true")
    listed = r.load(_roots(spark, paths))
    return listed.select(F.regexp_replace("path", "^file:/+", "file:/").alias("uri"), "length")


STAT_THREADS = 16
REQUESTS_AT_ONCE = 10_000


def request_listing(spark: SparkSession, requests: DataFrame, glob: str | None = None) -> DataFrame:
    """(path, uri, length) per requested path that exists: a file, or a folder of files.

    One filesystem stat per requested path, many at a time (a Spark scan makes no split
    for a 0-byte file, so an empty file would be invisible to a binaryFile listing,
    while admission must see it). Paths pass through the driver in bounded pieces,
    each stored before the next.
    """
    conf = spark._jsc.hadoopConfiguration()

    def stat(path: str):
        uri = qualified(spark, path)
        p = spark._jvm.org.apache.hadoop.fs.Path(uri)
        fs = p.getFileSystem(conf)
        return (path, uri, int(fs.getContentSummary(p).getLength())) if fs.exists(p) else None

    schema, out = "path string, uri string, length bigint", None
    paths = (r["filepath"] for r in requests.where("trim(filepath) <> ''").select("filepath").distinct().toLocalIterator())
    while piece := list(itertools.islice(paths, REQUESTS_AT_ONCE)):
        with ThreadPoolExecutor(STAT_THREADS) as pool:
            rows = [r for r in pool.map(stat, piece) if r]
        part = spark.createDataFrame(rows, schema)
        if len(piece) == REQUESTS_AT_ONCE:
            part = staged(part, "listing")
        out = part if out is None else out.union(part)
    return out if out is not None else spark.createDataFrame([], schema)


def files_below(spark: SparkSession, folder: str, glob: str | None = None, recursive: bool = False) -> DataFrame:
    """(uri) of the files of a folder whose names match ``glob`` (all by default), empty ones too.

    Spark's own file index lists them (in parallel for many folders) and applies the
    pattern; names that begin with "_" or "." are hidden, as for every Spark source.
    """
    r = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    if glob:
        r = r.option("pathGlobFilter", glob)
    listed = r.load(_roots(spark, [folder])).inputFiles()
    return spark.createDataFrame([(f,) for f in listed], "path string").select(uri_of(F.col("path")).alias("uri"))


def logical_file(physical: Column) -> Column:
    """Logical file of a part file written under ``file=<name>/`` (else the path itself)."""
    m = F.regexp_extract(physical, LOGICAL_FILE_DIR, 1)
    return F.when(m != "", m).otherwise(physical)


def write_feed(lines: DataFrame, root: str, parts: int | None = None, compression: str | None = None, make=None) -> None:
    """Write (file, ord, value) lines as text under ``root/file=<name>/part-*``, packed if ``compression`` names a codec.

    Range partitioning on (file, ord) keeps each logical file's lines in order across
    consecutive part files and spreads a large file over many tasks. A packed part is read by
    one task, so let the parts' number follow the data with a ``compression``, or deal its lines
    once they are read. ``make(rows)``: makes the lines (file, value) of the partitioned and sorted
    rows by projections; then ``lines`` needs no value.
    """
    order = [F.col("file"), F.col("ord")]
    # Without a number, Spark's own partition count and coalescing follow the data.
    ranged = lines.repartitionByRange(parts, *order) if parts else lines.repartitionByRange(*order)
    ranged = ranged.sortWithinPartitions("file", "ord")
    (ranged.select("file", "value") if make is None else make(ranged)).write.mode("overwrite").partitionBy("file").text(
        root, compression=compression)
