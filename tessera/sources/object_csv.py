"""Object files: CSV with seven columns, taken by position."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera import config
from tessera.sources.records import Effect, read_records

_CORRUPT = "_corrupt_record"
_SCHEMA = T.StructType([*config.RAW_OBJECT_SCHEMA.fields, T.StructField(_CORRUPT, T.StringType())])
_DDL = ", ".join(f"`{name}` string" for name in _SCHEMA.names)


def csv_options(multiline: bool) -> dict[str, str]:
    return {
        "header": "true",
        "quote": '"',
        "escape": '"',
        "multiLine": str(multiline).lower(),
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": _CORRUPT,
    }


def read_object_csv(spark: SparkSession, path: str | list[str], multiline: bool = True) -> DataFrame:
    """Raw rows, all strings: the header is skipped, too long lines are dropped, short ones padded.

    Quoted cells may hold line breaks; ``read_records`` finds which breaks end rows, so a large file is split between tasks.
    That reads the file twice; ``multiline=False`` reads files without such cells once. Lines end with LF or CR LF.
    Only the empty cell is null; words such as ``NA`` are kept as text.
    """
    if not multiline:
        return drop_long_rows(spark.read.schema(_SCHEMA).options(**csv_options(multiline)).csv(path))
    records = read_records(spark, path, "\n", _quotes).filter(~F.col("leads"))
    # A file's first break tells what its rows end in, and that is a plain break inside of cells.
    text = F.when(F.col("stop") == "\r", F.replace(F.col("text"), F.lit("\r\n"), F.lit("\n"))).otherwise(F.col("text"))
    text = records.select(F.regexp_replace(text, r"\n\z", "").alias("text")).filter(F.col("text") != "")
    rows = text.select(F.from_csv("text", _DDL, csv_options(multiline)).alias("row")).select("row.*")
    return drop_long_rows(rows)


#: Rest of a cell that is in quotes, up to those that close it; a cell with what ends it; one whose quotes stay open.
_INSIDE = r'[^"]*+(?:""[^"]*+)*+'
_CELL = rf'(?:(?:"{_INSIDE}"[^,]*+|[^",][^,]*+|),)*+'
_OPEN = rf'"{_INSIDE}\z'


def _quotes(line: Column) -> Effect:
    """Only quotes at the start of a cell open it, and doubled ones stay inside."""
    stays = line.rlike(rf"^{_INSIDE}\z")
    return Effect(
        from_out=line.rlike(rf"^{_CELL}{_OPEN}"),
        from_in=stays | line.rlike(rf'^{_INSIDE}"[^,]*+,{_CELL}{_OPEN}'),
        rise_out=F.lit(0),
        rise_in=F.lit(0),
    )


def schema_with_corrupt() -> T.StructType:
    return _SCHEMA


def drop_long_rows(rows: DataFrame) -> DataFrame:
    """Both short and long rows arrive marked; count the cells of those to tell them apart.

    Removing each quoted stretch leaves only the commas that separate cells, also where a quote
    is doubled, as that reads as two stretches side by side.
    """
    bare = F.regexp_replace(_CORRUPT, r'"[^"]*"', "")
    cells = F.size(F.split(bare, ","))
    short = F.col(_CORRUPT).isNull() | (cells <= len(config.RAW_OBJECT_SCHEMA))
    return rows.filter(short).drop(_CORRUPT)
