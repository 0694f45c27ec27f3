"""Tab-separated files, line files and Parquet tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions.scalars import date_in_name
from ..operators.dictionaries import Dictionaries, keyword_dictionary
from ..operators.parsing import drop_empty, parse_lines


def read_tsv(spark: SparkSession, path: str, schema: T.StructType | str, header: bool = False) -> DataFrame:
    """Typed scan of a tab-separated file or folder."""
    return spark.read.schema(schema).option("sep", "\t").option("header", str(header).lower()).csv(path)


def read_untyped_tsv(spark: SparkSession, path: str) -> DataFrame:
    """Scan without a schema: text columns _c0, _c1, ..."""
    return spark.read.option("sep", "\t").csv(path)


def read_labelled_csv(spark: SparkSession, path: str) -> DataFrame:
    """Training file: header line, column types found by looking at the data."""
    return spark.read.option("header", "true").option("inferSchema", "true").csv(path)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of all files below a folder, as column value."""
    return spark.read.option("recursiveFileLookup", "true").text(path)


def read_log_folder(
    spark: SparkSession, path: str, schema: T.StructType = schemas.BATCH_SCHEMA, day_folders: bool = False
) -> DataFrame:
    """All log files below a folder in one scan, each row with the date in its file's name.

    day_folders: the date stands in a folder name log_date=YYYYMMDD instead.
    """
    rows = (
        spark.read.schema(schema)
        .option("sep", "\t")
        .option("recursiveFileLookup", "true")
        .csv(path)
    )
    return rows.select("*", _file_date(day_folders).alias("log_date"))


def _file_date(day_folders: bool) -> Column:
    if day_folders:
        return date_in_name(F.col("_metadata.file_path"), r"log_date=(\d{8})")
    return date_in_name(F.col("_metadata.file_name"))


def read_log_lines(
    spark: SparkSession, path: str, schema: T.StructType = schemas.BATCH_SCHEMA, day_folders: bool = False
) -> DataFrame:
    """The same files line by line: typed rows with log_date, and reject_reason where a line is not as declared."""
    lines = spark.read.option("recursiveFileLookup", "true").text(path)
    return parse_lines(drop_empty(lines.select("value", _file_date(day_folders).alias("log_date"))), schema)


def read_dictionaries(spark: SparkSession, folder: str, header: bool = True) -> Dictionaries:
    """The six dictionary files of a folder.  Fixed values: the file names."""
    return Dictionaries(
        ad_exchange=read_tsv(spark, f"{folder}/ad.exchange.txt", schemas.AD_EXCHANGE_DDL, header),
        log_type=read_tsv(spark, f"{folder}/log.type.txt", schemas.LOG_TYPE_DDL, header),
        city=read_tsv(spark, f"{folder}/city.us.txt", schemas.CITY_DDL, header),
        state=read_tsv(spark, f"{folder}/states.us.txt", schemas.STATE_DDL, header),
        keyword=keyword_dictionary(
            read_tsv(spark, f"{folder}/site.pages.us.txt", schemas.SITE_PAGES_DDL, header),
            read_tsv(spark, f"{folder}/user.profile.tags.us.txt", schemas.PROFILE_TAGS_DDL, header),
        ),
    )
