"""Tab-separated files with backslash escapes (the upstream export format).

Format: one header line per file; fields split on TAB and bound to the target
schema *by position*; a backslash escapes the next character (``\\\\``,
``\\<TAB>``, ``\\<LF>`` ...), so an escaped line feed continues the record on
the next physical line; ``\\N`` alone is NULL; an empty field is ``''`` for
text and NULL for other types; quotes are plain data. Files are normally
gzip-compressed, which makes each file one split.

Reading is two steps:

1. record assembly: drop the first line of every file, glue escaped-newline
   continuations;
2. field splitting, unescaping and typing as column expressions (JVM-side).
   A record with the wrong field count or a malformed number fails the job.

Files are read by ``sources.records``, each record once: plain files in byte
ranges that own the records beginning in them, any number of tasks to a file; a gzip
file (the upstream format) in one task. Only where tasks cannot open a
file by themselves (a scheme that only Spark's readers know), Spark reads the lines and
``mapInPandas`` assembles them per partition, in file order. Spark splits plain files
there, and a record may straddle a split boundary; each split
then also emits at most two boundary fragments (its leading lines up to the
first record end, its unfinished last record), glued per file in split
order by a small grouped step. That path evaluates the assembly twice (once
per branch of the union).
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rangewise.session import ship_package
from rangewise.sources.records import RANGE_BYTES, packed, read_records, readable

# --- fixed values -----------------------------------------------------------
NULL_MARKER = "\\N"        # a field holding exactly backslash-N is NULL
# While a record is split, U+0001 begins a two-character code: itself, an
# escaped backslash, an escaped TAB. Coding U+0001 too keeps data that holds it.
_MARK = "\u0001"
_CODES = [("\u0001", _MARK + "0"), ("\\\\", _MARK + "1"), ("\\\t", _MARK + "2")]
_MEANT = [(_MARK + "2", "\t"), (_MARK + "1", "\\"), (_MARK + "0", "\u0001")]


_FRAGMENTS = "kind string, file string, start long, text string, closed boolean"


def _odd_backslashes(values: pd.Series) -> pd.Series:
    return (values.str.len() - values.str.rstrip("\\").str.len()) % 2 == 1


def _assembler(splittable: bool):
    """Per partition, in file order: drop each file's header line, glue escaped
    line feeds. A later split of a splittable file may begin inside a record
    whose start lies in the previous split: its leading lines up to the first
    record end are emitted as a ``head`` fragment, an unfinished record at a
    split's end as a ``tail`` fragment; :func:`_glue` joins them per file.
    Without splittable files (gzip) a tail can only end its file: a record."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seg = None        # (file, block start) of the current split
        in_head = False   # inside the leading lines of a later split
        carry = None      # unfinished text

        def close():
            if carry is None:
                return []
            if in_head:
                return [("head", seg[0], seg[1], carry, False)]
            return [("tail" if splittable else "rec", seg[0], seg[1], carry, None)]

        for pdf in batches:
            files, starts = pdf["_file"].to_numpy(), pdf["_start"].to_numpy()
            values = pdf["value"]
            odd = _odd_backslashes(values).to_numpy()
            if (seg is not None and carry is None and not in_head and not odd.any()
                    and (files == seg[0]).all() and (starts == seg[1]).all()):
                # fast path: one split, nothing pending, no continuation
                yield pd.DataFrame({"kind": "rec", "file": seg[0], "start": seg[1],
                                    "text": values.to_numpy(), "closed": None})
                continue
            out = []
            for line, f, st, o in zip(values.tolist(), files, starts, odd):
                if seg is None or f != seg[0] or st != seg[1]:
                    out += close()
                    carry, seg = None, (f, int(st))
                    if st == 0:
                        in_head = False
                        continue  # the file's header line
                    in_head = splittable
                text = line if carry is None else carry + "\n" + line
                if o:
                    carry = text
                    continue
                carry = None
                if in_head:
                    out.append(("head", f, int(st), text, True))
                    in_head = False
                else:
                    out.append(("rec", f, int(st), text, None))
            yield pd.DataFrame(out, columns=["kind", "file", "start", "text", "closed"])
        tail = close()
        if tail:
            yield pd.DataFrame(tail, columns=["kind", "file", "start", "text", "closed"])

    return run


def _glue(pdf: pd.DataFrame) -> pd.DataFrame:
    """One file's boundary fragments (at most two per split), in split order:
    a split's head continues what is pending, its tail begins anew."""
    out, pending = [], None
    ordered = pdf.sort_values(["start", "kind"])  # "head" before "tail"
    for kind, text, closed in zip(ordered["kind"], ordered["text"], ordered["closed"]):
        if kind == "head":
            piece = text if pending is None else pending + "\n" + text
            # an open head: the whole split continues one record
            pending = None if closed else piece
            if closed:
                out.append(piece)
        else:
            if pending is not None:  # a record ended without its continuation
                out.append(pending)
            pending = text
    if pending is not None:
        out.append(pending)
    return pd.DataFrame({"text": out}, dtype=object)


def _protected(record: Column) -> Column:
    for text, code in _CODES:
        record = F.replace(record, F.lit(text), F.lit(code))
    return record


def _unescape(field: Column) -> Column:
    # no backslash stands beside another here: line feeds need no pattern
    out = F.replace(field, F.lit("\\\n"), F.lit("\n"))
    out = F.when(F.contains(out, F.lit("\\")), F.regexp_replace(out, r"(?s)\\(.)", "$1")).otherwise(out)
    for code, meant in _MEANT:
        out = F.replace(out, F.lit(code), F.lit(meant))
    return out


def _typed(raw: Column, dtype: T.DataType, name: str) -> Column:
    """Unescape and type one field. A non-empty value that does not parse as
    the column's type fails the job whatever the session's ANSI setting
    (fail fast, as a load error would)."""
    value = _unescape(raw)
    if isinstance(dtype, (T.StringType, T.VarcharType, T.CharType)):
        typed = value
    else:
        parsed = value.try_cast(dtype)
        typed = (F.when(value == "", F.lit(None).cast(dtype))
                 .when(parsed.isNull(), F.raise_error(
                     F.concat(F.lit(f"malformed {dtype.simpleString()} in column {name}: "),
                              value)).cast(dtype))
                 .otherwise(parsed))
    return F.when(raw == NULL_MARKER, F.lit(None).cast(dtype)).otherwise(typed)


def read_escaped_tsv(spark: SparkSession, path: str, schema: T.StructType,
                     range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Load escaped TSV file(s) (a path, directory or glob) into ``schema``.
    ``range_bytes``: what a task reads of a plain file."""
    ship_package(spark)
    reader = spark.read.option("lineSep", "\n").text(path)
    files = reader.inputFiles()
    if files and all(map(readable, files)):
        records = read_records(spark, files, range_bytes)
    else:
        records = _assembled(reader, splittable=not all(map(packed, files)))
    return _fields(records, schema)


def _assembled(reader: DataFrame, splittable: bool) -> DataFrame:
    """Records of text lines, assembled in file order."""
    lines = reader.select(
        "value", F.input_file_name().alias("_file"), F.input_file_block_start().alias("_start"))
    frags = lines.mapInPandas(_assembler(splittable), schema=_FRAGMENTS)
    records = frags.filter(F.col("kind") == "rec").select(F.col("text").alias("record"))
    if splittable:
        # boundary fragments: at most two rows per split, glued per file
        glued = frags.filter(F.col("kind") != "rec").groupBy("file").applyInPandas(
            _glue, schema="text string")
        records = records.unionByName(glued.select(F.col("text").alias("record")))
    return records


def _fields(records: DataFrame, schema: T.StructType) -> DataFrame:
    n = len(schema.fields)
    fields = records.select(F.split(_protected(F.col("record")), "\t", -1).alias("_f"))
    checked = fields.select(
        F.when(F.size("_f") == n, F.col("_f")).otherwise(
            F.raise_error(F.concat(F.lit(f"malformed record: expected {n} fields, got "),
                                   F.size("_f").cast("string")))
        ).alias("_f"))
    return checked.select(*[
        _typed(F.col("_f")[i], f.dataType, f.name).alias(f.name)
        for i, f in enumerate(schema.fields)
    ])


def read_prefix(spark: SparkSession, base: str, key: str, schema: T.StructType) -> DataFrame:
    """Object-prefix source: ``key`` names the files ``{base}/{key}*`` (e.g.
    ``observations`` -> ``observations.csv.gz``)."""
    return read_escaped_tsv(spark, f"{base.rstrip('/')}/{key}*", schema)


def explore_tsv(spark: SparkSession, path: str) -> DataFrame:
    """Exploration read: quotes honoured, types inferred (not for loads)."""
    return spark.read.csv(path, sep="\t", header=True, inferSchema=True, escape='"')


def _escape(c: Column) -> Column:
    s = c.cast("string")
    esc = F.replace(F.replace(F.replace(s, F.lit("\\"), F.lit("\\\\")), F.lit("\t"), F.lit("\\\t")),
                    F.lit("\n"), F.lit("\\\n"))
    return F.coalesce(esc, F.lit(NULL_MARKER))


def write_escaped_tsv(df: DataFrame, path: str, compression: str = "gzip") -> None:
    """Write ``df`` in the same format: one header per file, escaped fields."""
    ship_package(df.sparkSession)
    header = "\t".join(df.columns)
    lines = df.select(F.concat_ws("\t", *[_escape(F.col(c)) for c in df.columns]).alias("value"))

    def with_header(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_pydict({"value": [header]})
        for b in batches:
            yield pa.RecordBatch.from_arrays(b.columns, names=["value"])

    lines.mapInArrow(with_header, schema="value string").write.mode("overwrite") \
        .option("compression", compression).option("lineSep", "\n").text(path)
