"""Raw wide CSV exports."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..operators.cleaning import MALFORMED, ORIGIN
from .scratch import written


def find_input(spark: SparkSession, folder: str, explicit: str | None = None) -> str:
    """``explicit``, or a glob over all CSV files of ``folder``: an export may be many files.

    The listing reads file names only, never their content.
    """
    files = spark.read.format("binaryFile")
    path = explicit or f"{folder.rstrip('/')}/*.csv"
    try:
        found = files.load(path).select("path").first()
    except AnalysisException:
        found = None
    if found is None:
        raise FileNotFoundError(f"no CSV file in {explicit or folder}")
    return path


def read_raw(
    spark: SparkSession, path: str | list[str], multiline: bool, origin: bool = False
) -> DataFrame:
    """Export with every column as text, under the headers of the file.

    Quoted fields may hold commas, doubled quotes and line breaks. A row with
    too many or too few fields is kept, cut or NULL-padded, and marked in
    ``_malformed``. All files of one read must share their header.

    ``multiline`` says whether quoted fields may hold line breaks. Large files are split
    over tasks either way; with line breaks they are read twice, see ``records``. With
    ``origin`` each row names its file in ``_origin``, for ``cleaning.rejected``.
    """
    reader = spark.read.options(**_DIALECT, multiLine=multiline)
    header = reader.csv(path, header=False).first()
    if header is None:
        raise ValueError(f"{path} is empty")
    names = [name or f"unnamed_{i}" for i, name in enumerate(header)]
    repeated = sorted({n for n in names if names.count(n) > 1})
    if repeated:
        raise ValueError(f"header names {repeated} occur more than once in {path}")
    corrupt = "_corrupt_record"
    schema = StructType([StructField(n, StringType()) for n in [*names, corrupt]])
    marked = F.col(corrupt).isNotNull().alias(MALFORMED)
    if multiline:
        found = records(spark, path)
        options = {**_DIALECT, "multiLine": "true", "columnNameOfCorruptRecord": corrupt}
        # A header is a record like any other to the parser; one that differs ends the read.
        fields = ["" if name is None else name for name in header]
        parsed = F.from_csv("record", _ddl(schema), options)
        row = found.select(parsed.alias("row"), "first", F.col("file").alias(ORIGIN))
        same = F.lit(True)
        for name, field in zip(names, fields):
            same = same & F.coalesce(F.col("row")[name], F.lit("")).eqNullSafe(F.lit(field))
        same = same & F.col("row")[corrupt].isNull()
        other = F.raise_error(F.lit(f"a file of {path} has another header than {fields}"))
        shown = F.when(~F.col("first"), True).when(same, False).otherwise(other.cast("boolean"))
        own = [ORIGIN] if origin else []
        return row.filter(shown).select("row.*", *own).select(*(F.col(f"`{n}`") for n in names), marked, *own)
    rows = reader.options(header=True, enforceSchema=False, columnNameOfCorruptRecord=corrupt)
    own = [F.col("_metadata.file_path").alias(ORIGIN)] if origin else []
    return rows.schema(schema).csv(path).select(*(F.col(f"`{n}`") for n in names), marked, *own)


def _ddl(schema: StructType) -> str:
    return ", ".join("`" + f.name.replace("`", "``") + "` string" for f in schema)


_DIALECT = {"quote": '"', "escape": '"', "encoding": "UTF-8", "mode": "PERMISSIVE"}

# A field is quoted if it starts with a quote. What follows its closing quote, up to the
# comma, belongs to it; a quote inside an unquoted field is an ordinary character.
_INSIDE = r'(?:[^"]++|"")*+'
_OPENS = re.compile(rf'(?:(?:"{_INSIDE}"(?!")[^,]*+|[^",][^,]*+|),)*+"{_INSIDE}\Z', re.S)
_CLOSES = re.compile(rf'{_INSIDE}"(?!")[^,]*+', re.S)


def open_after(line: str, is_open: bool) -> bool:
    """Whether a quoted field is open at the end of a line, given whether one is at its start."""
    if '"' not in line:
        return is_open
    if is_open:
        closed = _CLOSES.match(line)
        if closed is None:
            return True
        line = "-" + line[closed.end() :]
    return _OPENS.match(line) is not None


def _split_states(lines: DataFrame) -> DataFrame:
    """(file, block, open): whether each input split starts inside a quoted field.

    One scan gives, per split, the state at its end for either state at its start. Such a
    step sets the state, keeps it or flips it; so the state is the one last set,
    turned by the flips since. The windows run over one row per split.
    """

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ends: dict[tuple, list[bool]] = {}
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("file", "block", "line"))
            for file, block, line in zip(*columns):
                state = ends.setdefault((file, block), [False, True])
                if '"' in line:
                    state[:] = [open_after(line, s) for s in state]
        rows = [(*key, *state) for key, state in ends.items()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows) if rows else ([],) * 4, _STEP_TYPES)],
            names=["file", "block", "from_out", "from_in"],
        )

    steps = lines.mapInArrow(step, "file string, block bigint, from_out boolean, from_in boolean")
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    here = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, 0)
    sets = F.col("from_out") == F.col("from_in")
    flips = F.sum(F.col("from_out").cast("int") * (~sets).cast("int")).over(here)
    steps = steps.withColumn("_flips", flips)
    last = F.last(F.when(sets, F.struct("from_out", "_flips")), ignorenulls=True).over(before)
    steps = steps.withColumn("_set", last)
    steps = steps.withColumn("_before", F.coalesce(F.last("_flips").over(before), F.lit(0)))
    turned = (F.col("_before") - F.coalesce("_set._flips", F.lit(0))) % 2 == 1
    return steps.select(
        "file",
        "block",
        "from_out",
        "from_in",
        (F.coalesce("_set.from_out", F.lit(False)) != turned).alias("open"),
    )


_STEP_TYPES = [pa.string(), pa.int64(), pa.bool_(), pa.bool_()]
_RECORD_DDL = "file string, block bigint, first boolean, part string, record string"


def _cut(lines: DataFrame, fragments: bool) -> DataFrame:
    """Records that lie within one split, or else the fragments at the ends of splits."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here = pending = None
        is_open = headless = first = False
        for batch in batches:
            rows: list[tuple] = []
            for file, block, line, starts_open in zip(*(c.to_pylist() for c in batch.columns)):
                if here != (file, block):
                    if pending:
                        rows.append((*here, first, "head" if headless else "tail", "\n".join(pending)))
                    here, pending = (file, block), []
                    is_open = headless = starts_open
                    first = block == 0
                still = open_after(line, is_open)
                if is_open or still:
                    pending.append(line)
                if still:
                    is_open = True
                    continue
                part = "head" if headless else None
                rows.append((*here, first, part, "\n".join(pending) if is_open else line))
                pending, is_open, headless, first = [], False, False, False
            yield batch_of(rows)
        if pending:
            yield batch_of([(*here, first, "head" if headless else "tail", "\n".join(pending))])

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        rows = [r for r in rows if (r[3] is not None) == fragments]
        types = [pa.string(), pa.int64(), pa.bool_(), pa.string(), pa.string()]
        columns = zip(*rows) if rows else ([],) * 5
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types)],
            names=["file", "block", "first", "part", "record"],
        )

    return lines.mapInArrow(cut, _RECORD_DDL)


def records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, record, first): the records of CSV files with line breaks in quotes, from splittable scans.

    ``first`` marks the first record of a file. One scan finds whether each split starts
    inside a quoted field; the other cuts splits into records. Only what a split leaves
    unfinished is joined across splits: at most two fragments of each. A record that spans
    many splits, as after a quote that is never closed, ends in one task, as it is one value.

    A split is known by its offset, so the two scans may be split differently only where the
    first has an answer; else the query fails instead of guessing. Empty lines are no records.
    Lines end in ``\\n`` or ``\\r\\n``.
    """
    lines = spark.read.text(path, lineSep="\n").select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.make_valid_utf8("value").alias("line"),
    )
    states = written(_split_states(lines), "split-states")
    # One row per input split, hence safe to broadcast.
    known = F.broadcast(states.withColumnsRenamed({"file": "_file", "block": "_block"}))
    placed = lines.join(
        known, (F.col("file") == F.col("_file")) & (F.col("block") == F.col("_block")), "left"
    )
    unknown = F.raise_error(F.lit("input splits changed between two scans: read again"))
    start = F.coalesce("open", unknown.cast("boolean"))
    whole = _cut(placed.select("file", "block", "line", start.alias("open")), fragments=False)
    ends_open = F.when(F.col("open"), F.col("from_in")).otherwise(F.col("from_out"))
    torn = placed.select("file", "block", "line", start.alias("open"), ends_open.alias("_ends"))
    torn = torn.filter(F.col("open") | F.col("_ends")).drop("_ends")
    parts = _cut(torn, fragments=True)
    # A tail begins a record, which the heads behind it go on.
    order = Window.partitionBy("file").orderBy("block", "part")
    numbered = parts.withColumn("_record", F.count_if(F.col("part") == "tail").over(order))
    piece = F.struct("block", "part", "record", "first")
    joined = (
        numbered.groupBy("file", "_record")
        .agg(F.array_sort(F.collect_list(piece)).alias("_pieces"))
        .select(
            "file",
            F.array_join("_pieces.record", "\n").alias("record"),
            F.element_at("_pieces.first", 1).alias("first"),
        )
    )
    found = whole.select("file", "record", "first").unionByName(joined)
    return found.withColumn("record", F.regexp_replace("record", r"\r\z", "")).filter("record <> ''")
