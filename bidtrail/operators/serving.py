"""The keyed serving table and its document, text and cell forms.

The table is an append log: each batch is one folder batch_id=N, and of several rows with one key the last
to arrive counts.  Writing a batch never touches older data, writing it again replaces only its own folder,
and a reader keeps the last of each key.  A table may also be laid out by user: inside a batch, one folder per
bucket of users, so that what a batch needs of its users' past is read from their buckets alone.  `compact` folds
the batches into one.

Files carry Bloom filters of the user, so that a lookup of a few users opens only the row groups that may hold them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import event_time
from ..schemas import (
    FEATURE_COLUMNS,
    PREDICTION_COLUMNS,
    SERVED_BID_COLUMNS,
    SERVED_DICTIONARY_COLUMNS,
    SERVING_KEY,
    SERVING_REPORT_COLUMNS,
    UA_COLUMNS,
)

BATCH = "batch_id"
BUCKET = "user_bucket"
USER = "ipinyou_id"
# Hidden from readers of the table by their first letter.
DELETES = "_deletes"
LAYOUT = "_layout"
USER_BUCKETS = 64
# A bucket of a batch should be about this large; the number of buckets is set once, when a table is made.
BUCKET_BYTES = 256 << 20
MOST_BUCKETS = 16_384
# The longest list of users that Spark hands to the files' Bloom filters as it is.
USERS_A_LOOKUP = 10
# Batch of an empty or compacted table; streaming batches start at 0.
BASE = -1


def latest_per_key(df: DataFrame, keys: list[str], arrival: list[str]) -> DataFrame:
    """The last row of each key by the arrival columns; rows that arrived at one and the same place all stay.

    Spark keeps only the first rank per key and task before the shuffle, so a key with very many copies stays cheap.
    """
    newest = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in arrival])
    return df.withColumn("_rank", F.rank().over(newest)).where("_rank = 1").drop("_rank")


def overwrite_table(df: DataFrame, path: str) -> None:
    """Replace a table by all rows of one frame, in one write."""
    df.write.mode("overwrite").parquet(path)


def user_bucket(user: str = USER, buckets: int = USER_BUCKETS) -> Column:
    """Bucket of a user, for a table laid out by user."""
    return F.pmod(F.xxhash64(user), F.lit(buckets)).cast("int")


def bucket_count(table_bytes: int) -> int:
    """Buckets for a table that is to grow to so many bytes: the power of two from 64 on that keeps them near BUCKET_BYTES."""
    wanted = -(-table_bytes // BUCKET_BYTES)
    return min(MOST_BUCKETS, max(USER_BUCKETS, 1 << max(0, wanted - 1).bit_length()))


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a folder; 0 if there is none."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return files.getContentSummary(folder).getLength() if files.exists(folder) else 0


def table_buckets(spark: SparkSession, path: str) -> int:
    """Buckets of a table; USER_BUCKETS where none were set."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path, LAYOUT)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return spark.read.schema("buckets int").json(f"{path}/{LAYOUT}").first()["buckets"] if files.exists(folder) else USER_BUCKETS


def set_buckets(spark: SparkSession, path: str, buckets: int) -> None:
    """Fix the number of buckets of a table; one that holds batches keeps its number."""
    if batches(spark, path) and table_buckets(spark, path) != buckets:
        raise ValueError(f"{path} holds batches; compact it into a new table to change its buckets")
    spark.range(1).select(F.lit(buckets).alias("buckets")).write.mode("overwrite").json(f"{path}/{LAYOUT}")


def append_batch(df: DataFrame, path: str, batch_id: int, by_user: bool = False) -> None:
    """Add a batch; the same batch written again replaces itself."""
    if by_user:
        buckets = table_buckets(df.sparkSession, path)
        df = df.withColumn(BUCKET, user_bucket(buckets=buckets)).hint("rebalance", BUCKET)
    writer = df.write.mode("overwrite")
    if USER in df.columns:
        # The filter of a row group is sized by its own keys, up to a megabyte.
        writer = writer.option(f"parquet.bloom.filter.enabled#{USER}", "true").option("parquet.bloom.filter.adaptive.enabled", "true")
    (writer.partitionBy(BUCKET) if by_user else writer).parquet(f"{path}/{BATCH}={batch_id}")


def create_table(like: DataFrame, path: str, by_user: bool = False) -> None:
    """An empty table with the columns of a frame.  All batches of a table have one layout."""
    folder = f"{path}/{BATCH}={BASE}" + (f"/{BUCKET}={BASE}" if by_user else "")
    empty_like(like).write.mode("overwrite").parquet(folder)


def stored_rows(spark: SparkSession, path: str, before_batch: int | None = None, schema: T.StructType | None = None, buckets: list[int] | None = None) -> DataFrame:
    """All stored rows with their batch, of every batch or of those before one, in all buckets or in some.

    Other folders are not read.  With a schema (of a table laid out by user, without batch and bucket) no file is
    opened to find it out.
    """
    reader = spark.read.option("basePath", path)
    if schema is not None:
        reader = reader.schema(T.StructType([*schema.fields, T.StructField(BATCH, T.IntegerType()), T.StructField(BUCKET, T.IntegerType())]))
    rows = reader.parquet(path)
    if before_batch is not None:
        rows = rows.where(F.col(BATCH) < before_batch)
    if BUCKET in rows.columns:
        rows = (rows if buckets is None else rows.where(F.col(BUCKET).isin(buckets))).drop(BUCKET)
    return rows


def batches(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the batches that a table holds."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    found = files.globStatus(spark._jvm.org.apache.hadoop.fs.Path(folder, f"{BATCH}=*")) or []
    return sorted(int(f.getPath().getName().split("=")[1]) for f in found)


def current_rows(spark: SparkSession, path: str, order: list[str], keys: list[str] = SERVING_KEY) -> DataFrame:
    """The last row of each key: the last batch wins, inside a batch the last by `order`."""
    return latest_per_key(stored_rows(spark, path), keys, [BATCH, *order]).drop(BATCH)


def rows_of_users(spark: SparkSession, path: str, users: list[str], schema: T.StructType | None = None) -> DataFrame:
    """All stored rows of some users with their batch, of a table of either layout.

    Only the users' buckets are listed, and of their files only the row groups whose Bloom filter may hold one of the
    users.  Longer lists are looked up in parts of USERS_A_LOOKUP, beyond which Spark would hand over the range alone; for very
    many users join the table with a frame of them.  Null users are never found, a user named twice is found once.
    """
    known = sorted({u for u in users if u is not None})
    if not known:
        return stored_rows(spark, path, schema=schema).where(F.lit(False))
    parts = [known[i : i + USERS_A_LOOKUP] for i in range(0, len(known), USERS_A_LOOKUP)]
    hashed = spark.createDataFrame([(u,) for u in known], f"{USER} string").select(USER, user_bucket(buckets=table_buckets(spark, path)).alias("b"))
    bucket = {r[USER]: r["b"] for r in hashed.collect()}
    found = [stored_rows(spark, path, schema=schema, buckets=sorted({bucket[u] for u in part})).where(F.col(USER).isin(part)) for part in parts]
    return reduce(DataFrame.unionByName, found)


def current_rows_of_users(spark: SparkSession, path: str, users: list[str], order: list[str], keys: list[str] = SERVING_KEY) -> DataFrame:
    """The last row of each key of some users."""
    return latest_per_key(rows_of_users(spark, path, users), keys, [BATCH, *order]).drop(BATCH)


def history_snapshot(rows: DataFrame, path: str) -> None:
    """What the features of users are made of, from rows of the serving table, as files that a stream can begin with."""
    rows.select("ipinyou_id", "timestamp", "log_type_name", "keyword_name").write.mode("overwrite").parquet(path)


def compact(spark: SparkSession, path: str, new_path: str, order: list[str], keys: list[str] = SERVING_KEY, by_user: bool = False) -> None:
    """Write the current rows as the base of a new table.

    Laid out by user, each bucket is rewritten into few files of its own, and the number of buckets follows from the bytes of
    the old table; otherwise the rows are split by ranges of the whole key, so that key lookups skip row groups and
    one busy user spans several files.
    """
    rows = current_rows(spark, path, order, keys)
    if by_user:
        set_buckets(spark, new_path, max(table_buckets(spark, path), bucket_count(stored_bytes(spark, path))))
    append_batch(rows if by_user else rows.repartitionByRange(*keys), new_path, BASE, by_user)


def append_deletes(ids: DataFrame, path: str, batch_id: int, key: str) -> None:
    """Mark ids as deleted by a batch: rows of them that came with it or before are gone for readers of live_rows.

    Only the ids are written, into a folder that other readers of the table skip; the same batch again replaces itself.
    """
    ids.select(key).where(F.col(key).isNotNull()).distinct().write.mode("overwrite").parquet(f"{path}/{DELETES}/{BATCH}={batch_id}")


def live_rows(spark: SparkSession, path: str, order: list[str], key: str, keys: list[str] = SERVING_KEY) -> DataFrame:
    """The last row of each key without those that a delete of their batch or a later one names; a row written after
    the delete counts again."""
    rows = latest_per_key(stored_rows(spark, path), keys, [BATCH, *order])
    marks = f"{path}/{DELETES}"
    if not batches(spark, marks):
        return rows.drop(BATCH)
    deleted = spark.read.option("basePath", marks).parquet(marks).groupBy(key).agg(F.max(BATCH).alias("_deleted"))
    return rows.join(deleted, key, "left").where(F.col("_deleted").isNull() | (F.col(BATCH) > F.col("_deleted"))).select(*[c for c in rows.columns if c != BATCH])


def compact_live(spark: SparkSession, path: str, new_path: str, order: list[str], key: str, keys: list[str] = SERVING_KEY) -> None:
    """Write the live rows as the base of a new table, which needs the deletes no more."""
    append_batch(live_rows(spark, path, order, key, keys).repartitionByRange(*keys), new_path, BASE)


def delete_ids(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows whose id is not listed; write them to a new path with overwrite_table."""
    return df.join(ids.select(key).distinct(), key, "left_anti")


def empty_like(df: DataFrame) -> DataFrame:
    """The same columns without rows, to truncate a table."""
    return df.limit(0)


def serving_report(df: DataFrame) -> DataFrame:
    """The ten columns the table is usually read with."""
    return df.select(*SERVING_REPORT_COLUMNS)


def serving_schema(df: DataFrame) -> DataFrame:
    """Indexed form: event time as a timestamp, missing probabilities as 0.0."""
    zero = F.lit(0.0)
    return df.withColumns(
        {
            "event_time": event_time(F.col("timestamp")),
            "false_prob": F.coalesce("false_prob", zero),
            "true_prob": F.coalesce("true_prob", zero),
        }
    )


def serving_text_row(df: DataFrame) -> DataFrame:
    """The 52 text columns of the key-value table; the point becomes two columns."""
    names = [*SERVED_BID_COLUMNS, *SERVED_DICTIONARY_COLUMNS, *UA_COLUMNS, *PREDICTION_COLUMNS, *FEATURE_COLUMNS]
    columns = []
    for name in names:
        if name == "coordinates":
            columns += [F.get(name, F.lit(i)).cast("string").alias(f"{name}{i}") for i in (0, 1)]
        else:
            columns.append(F.col(name).cast("string").alias(name))
    return df.select(*columns)


def json_documents(df: DataFrame) -> DataFrame:
    """One JSON text per row; null fields are left out."""
    return df.select(F.to_json(F.struct(*df.columns)).alias("doc"))


def write_documents(df: DataFrame, path: str) -> None:
    json_documents(df).write.mode("overwrite").text(path)


def write_daily(df: DataFrame, path: str, day: str = "log_date") -> None:
    """One folder per day.  The rebalance hint merges small files and splits a day that is too large for one task."""
    df.hint("rebalance", day).write.mode("overwrite").partitionBy(day).parquet(path)


def landing_rows(messages: DataFrame) -> DataFrame:
    """Messages under a random key."""
    return messages.select(F.expr("uuid()").alias("key"), "value")


def write_tsv(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    """Tab-separated text without a header; nulls and empty texts both become empty fields."""
    writer = df.write.mode("overwrite").option("sep", "\t").option("emptyValue", "")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.csv(path)
