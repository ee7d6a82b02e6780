"""Raw CSV inputs: manifest check and header-based, inference-free scan.

Columns are read as text by header name (``inferSchema`` off: no extra
pass over the data, no type guessing), then the staging layer applies the
strict / ``try_cast`` casts. All files are read in parallel. Spark's ``multiLine`` would read a whole
file in one task, so inputs whose free text may hold quoted line breaks are read as lines, block by
block: a first pass tells for every block whether it ends within quotes (if it begins outside, and if
it begins inside), so the second one knows each block's beginning and joins lines to records.
Of a record over the end of a block, the parts are joined by a shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martwright.schemas import MULTILINE_INPUTS, RAW_COLUMNS, REQUIRED_FILES
from martwright.session import ship_package


def _exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the Hadoop file system of ``path`` (works for any scheme)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(hpath))


def assert_files(spark: SparkSession, raw_dir: str,
                 files: dict[str, str] = REQUIRED_FILES) -> dict[str, str]:
    """Map input name → path; if any file is missing, raise one error listing all of them."""
    paths, missing = {}, []
    for name, fname in files.items():
        p = f"{raw_dir.rstrip('/')}/{fname}"
        if _exists(spark, p):
            paths[name] = p
        else:
            missing.append(fname)
    if missing:
        raise FileNotFoundError(
            "Missing required dataset files in " + raw_dir + ":\n- " + "\n- ".join(missing))
    return paths


# A line, from the beginning of a field, that ends within quotes: whole fields, then an open one.
_OPEN = re.compile(rb'(?:(?:"[^"]*+(?:""[^"]*+)*+"[^,]*+|[^",][^,]*+|),)*+"[^"]*+(?:""[^"]*+)*+\Z')
_BREAK = b"\n"


def _ends_inside(line: bytes, inside: bool) -> bool:
    if b'"' not in line:
        return inside
    return _OPEN.match(b'"' + line if inside else line) is not None


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, line): lines of the file's blocks, those of a block in order in one task."""
    return (spark.read.option("lineSep", "\n").text(path)
            .select(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                    F.col("value").cast("binary").alias("line")))


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int], pa.Array]]:
    """(block, its lines in this batch)."""
    for batch in batches:
        file, block = (batch.column(c).to_numpy() for c in ("file", "block"))
        cuts = [0, *(((file[1:] != file[:-1]) | (block[1:] != block[:-1])).nonzero()[0] + 1).tolist(), len(batch)]
        for lo, hi in zip(cuts, cuts[1:], strict=False):
            if hi > lo:
                yield (int(file[lo]), int(block[lo])), batch.column("line").slice(lo, hi - lo)


def _block_ends(lines: DataFrame) -> list:
    """Does a block end within quotes, if it begins outside (``out``), if it begins ``inside``?

    A row comes back for each block with a quote; blocks have some 100 MB.
    """

    def task(batches):
        ends: dict[tuple[int, int], list[bool]] = {}
        for at, part in _runs(batches):
            end = ends.setdefault(at, [False, True])
            for line in part.to_pylist():
                end[0], end[1] = _ends_inside(line, end[0]), _ends_inside(line, end[1])
        yield pa.RecordBatch.from_pylist(
            [{"file": f, "block": b, "out": x, "inside": y} for (f, b), (x, y) in ends.items()],
            pa.schema([("file", pa.int64()), ("block", pa.int64()), ("out", pa.bool_()), ("inside", pa.bool_())]))

    return (lines.where(F.instr(F.col("line").cast("string"), '"') > 0)
            .mapInArrow(task, "file bigint, block bigint, out boolean, inside boolean")
            .orderBy("file", "block").collect())


def _state_after(ends: list) -> dict[int, tuple[list[int], list[bool]]]:
    """file -> (blocks with quotes, whether each ends within quotes)."""
    out: dict[int, tuple[list[int], list[bool]]] = {}
    for r in ends:
        blocks, after = out.setdefault(r["file"], ([], []))
        blocks.append(r["block"])
        after.append(r["inside"] if after and after[-1] else r["out"])
    return out


def _cut(lines: DataFrame, states: dict, crlf: bool, parts: bool) -> DataFrame:
    """(file, block, opens, header, record): the records within the blocks; or, with ``parts``, the parts
    of those over their ends, of which ``opens`` is the first."""
    schema = pa.schema([("file", pa.int64()), ("block", pa.int64()), ("opens", pa.bool_()),
                        ("header", pa.bool_()), ("record", pa.binary())])

    def begins_inside(at: tuple[int, int]) -> bool:
        from bisect import bisect_left
        blocks, after = states.get(at[0], ([], []))
        i = bisect_left(blocks, at[1])
        return i > 0 and after[i - 1]

    def task(batches):
        was, inside, foreign, header, held = None, False, False, False, []

        def rows(at, records, opens=None, first=False):
            n = len(records)
            return pa.RecordBatch.from_arrays(
                [pa.array([at[0]] * n, pa.int64()), pa.array([at[1]] * n, pa.int64()), pa.array([opens] * n, pa.bool_()),
                 pa.array([first] * n, pa.bool_()), pa.array(records, pa.binary())], schema=schema)

        def rest():
            # what the block leaves open: the beginning of a record, or a part from within
            if held and parts:
                yield rows(was, [_BREAK.join(held)], not foreign, header)

        for at, part in _runs(batches):
            if at != was:
                yield from rest()
                was, inside, held = at, begins_inside(at), []
                foreign, header = inside, at[1] == 0
            found = []
            if not (inside or held or header or pc.any(pc.match_substring(part, '"')).as_py()):
                found = part.to_pylist()
            else:
                for line in part.to_pylist():
                    inside = _ends_inside(line, inside)
                    held.append(line)
                    if inside:
                        continue
                    record, held = _BREAK.join(held), []
                    if foreign:  # the end of a record of blocks before
                        foreign = False
                        if parts:
                            yield rows(at, [record], False)
                    elif header and record not in (b"", b"\r"):
                        header = False
                    else:
                        found.append(record)
            if not parts:
                if crlf:
                    # as Spark's reader does, also within quotes
                    found = [x.replace(b"\r\n", b"\n").removesuffix(b"\r") for x in found]
                yield rows(at, [x for x in found if x])
        yield from rest()

    return lines.mapInArrow(task, "file bigint, block bigint, opens boolean, header boolean, record binary")


def _multiline_records(spark: SparkSession, path: str) -> DataFrame | None:
    """(record): the records of CSV files but their headers; None for old Macintosh line ends."""
    ship_package(spark)
    lines = _lines(spark, path)
    first = lines.where("block = 0").select("line").limit(1).collect()
    head = bytes(first[0]["line"]) if first else b""
    crlf = head.endswith(b"\r")
    if b"\r" in head.removesuffix(b"\r"):
        return None
    states = _state_after(_block_ends(lines))
    whole = _cut(lines, states, crlf, False).select(F.col("record").cast("string").alias("record"))
    if not any(any(after) for _, after in states.values()):
        return whole
    # at most two parts of a block
    nth = F.sum(F.col("opens").cast("int")).over(Window.partitionBy("file").orderBy("block", "opens"))
    joined = (_cut(lines, states, crlf, True).withColumn("nth", nth).groupBy("file", "nth")
              .agg(F.array_sort(F.collect_list(F.struct("block", "opens", F.col("record").cast("string").alias("text"))))
                   .alias("x"), F.max("header").alias("header"))
              .where("NOT header").select(F.array_join("x.text", "\n").alias("record")))
    if crlf:
        joined = joined.select(F.regexp_replace(F.regexp_replace("record", "\r\n", "\n"), "\r$", "").alias("record"))
    return whole.unionByName(joined)


def scan_csv(spark: SparkSession, path: str, name: str | None = None) -> DataFrame:
    """One CSV input (header row, comma) with every column as text."""
    # a row with too few or too many fields fails the load, also if only some columns are read
    options = {"escape": '"', "mode": "FAILFAST", "columnPruning": "false"}
    reader = spark.read.options(**options).option("header", True).option("inferSchema", False)
    if name in MULTILINE_INPUTS:
        reader = reader.option("multiLine", True)
    df = reader.csv(path)
    if name in MULTILINE_INPUTS and df.columns:
        records = _multiline_records(spark, path)
        if records is not None:
            fields = ", ".join(f"`{c.replace('`', '``')}` string" for c in df.columns)
            df = records.select(F.from_csv("record", fields, options).alias("x")).select("x.*")
    if name in RAW_COLUMNS:
        missing = [c for c in RAW_COLUMNS[name] if c not in df.columns]
        if missing:
            raise ValueError(f"{name}: missing columns {missing} in {path}")
        df = df.select(*RAW_COLUMNS[name])
    return df


def read_raw_dir(spark: SparkSession, raw_dir: str) -> dict[str, DataFrame]:
    """All nine inputs after the manifest check."""
    paths = assert_files(spark, raw_dir)
    return {name: scan_csv(spark, p, name) for name, p in paths.items()}
