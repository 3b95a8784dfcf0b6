"""The daily files.

The transactions file is ``;``-separated text with a header row; columns
are taken by name and reordered, a missing column becomes null.  The
terminals and blacklist sheets arrive as spreadsheets in the original.
Spark has no spreadsheet source: the sheets are read from CSV (or Parquet)
drops, or, where openpyxl is installed on the executors, from the xlsx
files themselves (``fmt="xlsx"``); terminals by position, the blacklist by
column name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as sch
from ..functions import parse_decimal_comma, parse_timestamp, strip_whitespace


def _by_name(df: DataFrame, names: list[str]) -> DataFrame:
    """Select ``names`` in this order; a column the file lacks is null."""
    have = set(df.columns)
    return df.select(*[F.col(n) if n in have else F.lit(None).cast("string").alias(n) for n in names])


def read_text_table(spark: SparkSession, path: str, sep: str = ";") -> DataFrame:
    """Header row gives the column names; every value stays a string (no
    type inference pass over the data)."""
    return (spark.read.option("header", True).option("sep", sep)
            .option("inferSchema", False).option("mode", "PERMISSIVE").csv(path))


def read_sheet(spark: SparkSession, path: str, *, by_name: list[str] | None = None,
               by_position: list[str] | None = None) -> DataFrame:
    """First sheet of each xlsx file under ``path`` as string columns:
    ``by_name`` picks header names (a missing one is null), ``by_position``
    names the first columns.  Files are read with Spark's ``binaryFile``
    source; each file is decoded by pandas in its task (a sheet is small).
    Needs openpyxl on the executors.
    """
    try:
        import openpyxl  # noqa: F401
    except ImportError as e:
        raise RuntimeError("reading xlsx needs openpyxl; drop the sheet as CSV or Parquet instead") from e
    names = by_name or by_position
    schema = ", ".join(f"`{n}` string" for n in names)

    def decode(batches):
        import io

        import pandas as pd
        for pdf in batches:
            for content in pdf["content"]:
                sheet = pd.read_excel(io.BytesIO(content), header=0, dtype=str)
                if by_name:
                    sheet = sheet.reindex(columns=by_name)
                else:
                    sheet = sheet.iloc[:, :len(by_position)]
                    sheet.columns = by_position
                yield sheet.astype(object).where(sheet.notna(), None)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.xlsx").load(path)
    return files.select("content").mapInPandas(decode, schema)


def parse_transactions(text: DataFrame, ts_format: str = "yyyy-MM-dd HH:mm:ss") -> DataFrame:
    """Raw file columns (strings) -> staging transactions.

    The amount is read with a decimal comma; text that does not parse stays
    null here and is reported by ``quality.bad_amounts``.
    """
    t = _by_name(text, sch.TRANSACTIONS_FILE_COLUMNS)
    return t.select(
        strip_whitespace("transaction_id").alias("trans_id"),
        parse_timestamp("transaction_date", ts_format).alias("trans_date"),
        strip_whitespace("card_num").alias("card_num"),
        F.col("oper_type"),
        parse_decimal_comma("amount").alias("amt"),
        F.col("oper_result"),
        strip_whitespace("terminal").alias("terminal"),
    )


def read_transactions_file(spark: SparkSession, path: str, sep: str = ";") -> DataFrame:
    """S2 + P1 + C10: the daily transactions text file to staging rows."""
    return parse_transactions(read_text_table(spark, path, sep))


def read_terminals_file(spark: SparkSession, path: str, fmt: str = "csv", sep: str = ";") -> DataFrame:
    """S3: terminals sheet, columns taken by position (header names are
    ignored): terminal_id, terminal_type, terminal_city, terminal_address."""
    if fmt == "csv":
        return (spark.read.schema(sch.STG_TERMINALS).option("header", True)
                .option("sep", sep).option("enforceSchema", True).csv(path))
    from .tables import stage_terminals
    if fmt == "xlsx":
        return stage_terminals(read_sheet(spark, path, by_position=sch.STG_TERMINALS.names))
    return stage_terminals(spark.read.format(fmt).load(path))


def parse_blacklist(sheet: DataFrame, ts_format: str = "yyyy-MM-dd HH:mm:ss") -> DataFrame:
    """Blacklist sheet columns (``passport``, ``date``) by name -> staging."""
    b = _by_name(sheet, sch.BLACKLIST_FILE_COLUMNS)
    entry = (parse_timestamp("date", ts_format) if dict(sheet.dtypes).get("date", "string") == "string"
             else F.col("date").cast("timestamp_ntz"))
    return b.select(strip_whitespace("passport").alias("passport_num"), entry.alias("entry_dt"))


def read_blacklist_file(spark: SparkSession, path: str, fmt: str = "csv", sep: str = ";") -> DataFrame:
    """Blacklist sheet to staging rows (passport_num, entry_dt)."""
    if fmt == "csv":
        sheet = read_text_table(spark, path, sep)
    elif fmt == "xlsx":
        sheet = read_sheet(spark, path, by_name=sch.BLACKLIST_FILE_COLUMNS)
    else:
        sheet = spark.read.format(fmt).load(path)
    return parse_blacklist(sheet)


def daily_paths(root: str, label: str, sheet_ext: str = "csv") -> dict[str, str]:
    """The three file paths of batch ``label`` (``ddMMyyyy``) under ``root``."""
    r = root.rstrip("/")
    return {
        "transactions": f"{r}/{sch.TRANSACTIONS_FILE.format(dt=label)}",
        "terminals": f"{r}/{sch.TERMINALS_FILE.format(dt=label)}.{sheet_ext}",
        "blacklist": f"{r}/{sch.BLACKLIST_FILE.format(dt=label)}.{sheet_ext}",
    }
