"""CSV ingestion with drifting headers.

``spark.read.csv(dir, header=True)`` binds columns by position, so files
whose headers differ would silently swap values.  One task per group of files
reads their first lines; each file's layout says at which place of its lines the
canonical columns are.  All lines then come from one text scan, are joined with
the layout of their file and are parsed with ``from_csv``, so any number of
header variants is one scan, and the driver learns no path and no header.
"""

from __future__ import annotations

import csv
import functools
import hashlib
import io
import re

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from fleetlens.operators.canonical import canonicalize, drop_null_keys, resolve_aliases
from fleetlens.schema import CANONICAL_COLUMNS
from fleetlens.session import scratch_path

#: Files whose layouts are broadcast (some 200 bytes each); beyond, lines and layouts are joined by a shuffle.
BROADCAST_MAX_FILES = 200_000
LAYOUT_SCHEMA = "file string, header string, layout string, head_hash string"
BAD = "_bad_record"


def _open_first_line(path: str) -> bytes:
    import pyarrow.fs as pafs
    from urllib.parse import unquote
    if path.startswith("file:"):
        fs, p = pafs.LocalFileSystem(), unquote(path[len("file:"):])
    else:
        fs, p = pafs.FileSystem.from_uri(path)
    with fs.open_input_stream(p) as f:
        head = b""
        while not re.search(rb"[\r\n]", head):
            chunk = f.read(65536)
            if not chunk:
                break
            head += chunk
    return re.split(rb"[\r\n]", head, maxsplit=1)[0]


def parse_header(line: str) -> list[str]:
    return next(csv.reader(io.StringIO(line))) if line else []


def layout(header: str) -> str | None:
    """Number of columns, and the place of each canonical column among them (-1: none), as text; null without columns."""
    names = parse_header(header)
    if not names:
        return None
    places = {n: i for i, n in reversed(list(enumerate(names)))}
    source = resolve_aliases(names)
    return f"{len(names)}:" + ",".join(str(places.get(source[c], -1)) for c, _, _ in CANONICAL_COLUMNS)


def _layouts(batches):
    for pdf in batches:
        first = [_open_first_line(p) for p in pdf["path"]]
        headers = [line.decode("utf-8-sig") for line in first]
        yield pd.DataFrame({"file": pdf["file"], "header": headers, "layout": [layout(h) for h in headers],
                            "head_hash": [hashlib.sha256(h.encode()).hexdigest() for h in headers]})


def file_layouts(spark: SparkSession, paths: str | list[str], glob: str = "*.csv") -> DataFrame:
    """(file, header, layout, head_hash) for every CSV file; ``binaryFile`` without the content column
    lists the files and the first lines are read in the tasks.  ``head_hash`` is the SHA-256 of
    the header."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true")
             .load([paths] if isinstance(paths, str) else list(paths)).select("path", F.col("_metadata.file_path").alias("file")))
    return files.mapInPandas(_layouts, LAYOUT_SCHEMA)


def canonical_lines(lines: DataFrame, widths: list[int]) -> DataFrame:
    """Canonical rows of (line, layout); ``widths`` are the numbers of columns that the layouts have.

    A line with another number of fields than its header is dropped.
    """
    width = F.substring_index("layout", ":", 1).cast("int")
    fields = None
    for n in widths:
        ddl = ", ".join([*(f"c{i} string" for i in range(n)), f"{BAD} string"])
        # the parse itself says which records have another number of fields
        parsed = F.filter(F.array(F.from_csv("line", ddl, {"columnNameOfCorruptRecord": BAD})), lambda r: r[BAD].isNull())
        names = [f"c{i}" for i in range(n)]
        one = F.transform(parsed, lambda r: F.array(*[r[c] for c in names]))  # noqa: B023
        fields = F.when(width == n, one) if fields is None else fields.when(width == n, one)
    # a generator parses once, where a filter on the parsed line would parse again
    cells = lines.select(F.explode(fields).alias("v"), F.split(F.substring_index("layout", ":", -1), ",").cast("array<int>").alias("at"))
    text = [F.get("v", F.get("at", F.lit(i))).alias(c) for i, (c, _, _) in enumerate(CANONICAL_COLUMNS)]
    return canonicalize(cells.select(*text))


def layout_widths(layouts: DataFrame) -> list[int]:
    """The numbers of columns that the headers have, all that the driver learns of them."""
    return sorted(r[0] for r in layouts.select(F.substring_index("layout", ":", 1).cast("int")).distinct().collect())


def read_csv_text(spark: SparkSession, paths: list[str], columns: list[str], glob: str = "*") -> DataFrame:
    """Read CSV files sharing one header as all-text columns; rows with the wrong field count are dropped."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return (spark.read.schema(schema).option("header", True).option("mode", "DROPMALFORMED")
            .option("enforceSchema", True).option("pathGlobFilter", glob).option("recursiveFileLookup", "true").csv(paths))


def read_csv_drift(spark: SparkSession, paths: str | list[str], glob: str = "*.csv",
                   broadcast_files: int = BROADCAST_MAX_FILES) -> DataFrame:
    """All CSV files under ``paths`` in the canonical schema, whatever their header variant.

    Files of one header are read by the plain CSV scan, those of several by one text scan;
    both give the same rows.  Aliases are resolved per file, so one file's column never shadows another one's
    alias.  Lines with another number of fields than their header, blank lines and
    lines equal to their file's header are no rows; files without a header have none.
    Layouts of up to ``broadcast_files`` files are broadcast; those of more are joined by
    a shuffle, in which AQE splits a file that holds very many lines.
    """
    place = scratch_path(spark, "csv-layouts")
    file_layouts(spark, paths, glob).write.parquet(place)
    layouts = spark.read.schema(LAYOUT_SCHEMA).parquet(place)
    width = F.substring_index("layout", ":", 1).cast("int")
    files, least, most, widths = layouts.agg(F.count("*"), F.min("header"), F.max("header"), F.collect_set(width)).first()
    if not files:
        raise RuntimeError(f"no file under {paths} matches {glob}")
    if not widths:
        raise RuntimeError(f"the files under {paths} hold no header")
    ps = [paths] if isinstance(paths, str) else list(paths)
    names = parse_header(least)
    if least == most and all(names) and "`" not in least and len({n.lower() for n in names}) == len(names):
        again = functools.reduce(Column.__and__, [F.col(f"`{n}`").eqNullSafe(F.lit(n)) for n in names])
        return canonicalize(read_csv_text(spark, ps, names, glob).where(~again))
    scan = (spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", "true")
            .text(ps).select(F.col("value").alias("line"), F.col("_metadata.file_path").alias("file")))
    side = layouts.where("layout IS NOT NULL").select("file", "layout", "head_hash", F.octet_length("header").alias("head_bytes"))
    lines = scan.join(side.hint("broadcast" if files <= broadcast_files else "shuffle_merge"), "file")
    # the length tells nearly all lines from the header, the digest the rest; the text scan leaves out a byte order mark
    head = (F.octet_length("line") == F.col("head_bytes")) & (F.sha2("line", 256) == F.col("head_hash"))
    return canonical_lines(lines.where(~head & F.col("line").rlike("[^\\x00-\\x20]")).select("line", "layout"), sorted(widths))


def ingest_csv(spark: SparkSession, paths: str | list[str], glob: str = "*.csv") -> DataFrame:
    """Read by each file's own header -> canonical warehouse columns -> rows with a day and a serial."""
    return drop_null_keys(read_csv_drift(spark, paths, glob))


def write_csv_text(df: DataFrame, path: str) -> str:
    """Write text columns as CSV with a header (empty strings stay quoted)."""
    df.write.mode("errorifexists").option("header", True).csv(path)
    return path
