"""What a job leaves on disk."""

import time

import pytest
from pyspark.sql import functions as F

from bidtrail import session


def shuffle_files(spark):
    return sum(f.getName().startswith("shuffle_") for f in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(spark._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()))


def kept(spark, paths):
    return [i for i, p in enumerate(paths) if (f := spark._jvm.org.apache.hadoop.fs.Path(p)).getFileSystem(spark._jsc.hadoopConfiguration()).exists(f)]


def test_shuffle_files_go_with_their_query(spark):
    """They stayed until the driver collected its garbage."""
    session.configure(spark)
    before = shuffle_files(spark)
    df = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.count("*").alias("n"))
    assert session.stored(df).count() == 7 and df.count() == 7
    assert sorted(df.collect()) == sorted(df.collect())
    for _ in range(50):
        if shuffle_files(spark) <= before:
            break
        time.sleep(0.1)
    assert shuffle_files(spark) <= before


def test_passing_keeps_the_last_table(spark):
    with session.passing(spark) as outer:
        session.stored(spark.range(1))
        with session.passing(spark) as inner:
            for n in (2, 3, 4):
                df = session.stored(spark.range(n))
        assert kept(spark, inner) == [2] and df.count() == 4 and len(outer) == 2
        session.stored(spark.range(5))
    assert kept(spark, outer) == [2]
    with pytest.raises(ValueError), session.passing(spark) as failed:
        session.stored(spark.range(1))
        raise ValueError
    assert kept(spark, failed) == []
