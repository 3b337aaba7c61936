"""CSV files inside ZIP archives.

The work is split per (archive, entry), not per archive, so one very large
archive does not become one task or one row:

1. ``binaryFile`` lists the archives (the content column is never read);
2. a ``mapInPandas`` pass opens each archive through the file system (a
   seekable handle), reads only the central directory and the first line of
   every CSV entry -> (archive, entry, header): file metadata;
3. the entries stay a table: each says at which place of its lines the canonical
   columns are (its layout), is streamed out by one task as lines in bounded batches,
   and the lines are parsed with ``from_csv`` (rows with the wrong field count are
   dropped) and read by their own layout.  One scan serves any number of header
   variants; the driver only learns how many columns the headers have.
"""

from __future__ import annotations

import io
import zipfile

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from fleetlens.operators.canonical import drop_null_keys
from fleetlens.session import scratch_path
from fleetlens.sources.csv import canonical_lines, layout, layout_widths

ENTRY_SCHEMA = "archive string, entry string, header string, layout string"
LINE_SCHEMA = "archive string, entry string, layout string, line_no long, line string"
BATCH_LINES = 50_000


def is_metadata_entry(name: str) -> bool:
    """macOS junk: '._*' files and anything under a '__MACOSX' folder."""
    parts = name.replace("\\", "/").split("/")
    return parts[-1].startswith("._") or "__MACOSX" in parts


def _file_system(path: str):
    import pyarrow.fs as pafs
    from urllib.parse import unquote
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + unquote(path[len("file:"):]).lstrip("/")
    return pafs.FileSystem.from_uri(path)


def _open(path: str):
    fs, p = _file_system(path)
    return fs.open_input_file(p)


def _entries(batches):
    for pdf in batches:
        rows = []
        for path in pdf["path"]:
            with _open(path) as fh, zipfile.ZipFile(fh) as zf:
                for name in sorted(zf.namelist()):
                    if not name.lower().endswith(".csv") or is_metadata_entry(name):
                        continue
                    with zf.open(name) as e:
                        first = io.TextIOWrapper(e, encoding="utf-8-sig", newline="").readline()
                    header = first.rstrip("\r\n")
                    rows.append((path, name, header, layout(header)))
        yield pd.DataFrame(rows, columns=["archive", "entry", "header", "layout"])


def _lines(batches):
    for pdf in batches:
        for path, name, kind in zip(pdf["archive"], pdf["entry"], pdf["layout"]):
            with _open(path) as fh, zipfile.ZipFile(fh) as zf, zf.open(name) as e:
                rows: list[tuple] = []
                held = ""
                for i, raw in enumerate(io.TextIOWrapper(e, encoding="utf-8-sig", newline="")):
                    if i == 0:
                        continue
                    held += raw
                    if held.count('"') % 2:
                        continue  # a line feed inside quotes
                    rows.append((path, name, kind, i, held.rstrip("\r\n")))
                    held = ""
                    if len(rows) >= BATCH_LINES:
                        yield pd.DataFrame(rows, columns=["archive", "entry", "layout", "line_no", "line"])
                        rows = []
                if held:
                    rows.append((path, name, kind, i, held.rstrip("\r\n")))
                if rows:
                    yield pd.DataFrame(rows, columns=["archive", "entry", "layout", "line_no", "line"])


def zip_entries(spark: SparkSession, path: str, glob: str = "*.zip") -> DataFrame:
    """(archive, entry, header) for every CSV entry of every archive (error if no archive)."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path).select("path")
    n = files.count()
    if n == 0:
        raise RuntimeError(f"no archive matches {glob} under {path}")
    return files.repartition(n).mapInPandas(_entries, ENTRY_SCHEMA)


def entry_lines(entries: DataFrame) -> DataFrame:
    """Data lines (after the header) of the given entries, one entry per task."""
    n = max(1, entries.count())
    return entries.select("archive", "entry", "layout").repartition(n, "archive", "entry").mapInPandas(_lines, LINE_SCHEMA)


def read_zip_csv(spark: SparkSession, path: str, max_files: int | None = None, glob: str = "*.zip") -> DataFrame:
    """Canonical warehouse rows from all CSV entries of all archives; optionally only the first
    ``max_files`` entries in (archive, entry) order."""
    found = zip_entries(spark, path, glob).where("layout IS NOT NULL")
    if max_files:
        found = found.orderBy("archive", "entry").limit(max_files)
    # one short row per entry, written once so that archives are opened once for it
    place = scratch_path(spark, "zip-entries")
    found.write.parquet(place)
    entries = spark.read.schema(ENTRY_SCHEMA).parquet(place)
    widths = layout_widths(entries)
    if not widths:
        raise RuntimeError(f"the archives under {path} hold no CSV file")
    return drop_null_keys(canonical_lines(entry_lines(entries).select("line", "layout"), widths))


def _write_zip_partition(out_dir: str, columns: list[str], extra_junk: bool):
    def run(batches):
        import uuid
        from pyspark import TaskContext
        frames = [pdf for pdf in batches if not pdf.empty]
        if not frames:
            return
        pid = TaskContext.get().partitionId()
        buf = io.BytesIO()
        with zipfile.ZipFile(buf, "w", compression=zipfile.ZIP_DEFLATED) as zf:
            with zf.open(f"data/day_{pid:05d}.csv", "w") as entry:
                for i, pdf in enumerate(frames):
                    entry.write(pdf[columns].to_csv(index=False, header=i == 0).encode())
            if extra_junk:
                zf.writestr(f"__MACOSX/data/._day_{pid:05d}.csv", "junk")
                zf.writestr(f"data/._day_{pid:05d}.csv", "junk")
        fs, folder = _file_system(out_dir)
        fs.create_dir(folder, recursive=True)
        name = f"part-{pid:05d}-{uuid.uuid4().hex[:8]}.zip"
        with fs.open_output_stream(f"{folder}/{name}") as out:
            out.write(buf.getvalue())
        yield pd.DataFrame({"archive": [f"{out_dir}/{name}"], "rows": [sum(map(len, frames))]})
    return run


def write_zip_csv(df: DataFrame, out_dir: str, extra_junk: bool = True) -> DataFrame:
    """Write each partition of a text DataFrame as one ZIP of one CSV (a fixture/landing writer).

    Tasks write through the file system of ``out_dir``.  Returns (archive, rows) per file.
    """
    target = out_dir if "://" in out_dir or out_dir.startswith("file:") else f"file:{out_dir}"
    return df.mapInPandas(_write_zip_partition(target, df.columns, extra_junk), "archive string, rows long")
