import pytest
from pyspark.sql import functions as F

from bidtrail.operators.dictionaries import join_keyword
from bidtrail.operators.parsing import accepted, parse_lines
from bidtrail.operators.serving import serving_text_row
from bidtrail.plans import logview as view
from bidtrail.plans.enrichment import enrich_index_document, enrich_log, enrich_log_folder
from bidtrail.schemas import (
    BATCH_LAYOUT, BATCH_SCHEMA, FEATURE_COLUMNS, RAW_LAYOUT, SERVED_BID_COLUMNS, SERVED_DICTIONARY_COLUMNS, STREAM_SCHEMA, UA_COLUMNS,
)
from bidtrail.sources.files import read_dictionaries, read_labelled_csv, read_log_folder

FILES = {
    "ad.exchange.txt": "ad_exchange_id\tad_exchange_name\tad_exchange_desc\n1\tadx\tfirst\n",
    "log.type.txt": "log_type_id\tlog_type_name\n1\tbid-click\n",
    "city.us.txt": "city_id\tcity_name\tstate_id\tpopulation\tarea\tdensity\tlatitude\tlongitude\n"
    "1\tAda\t1\t100\t1.5\t2.5\t10.5\t-20.5\n2\tBix\t9\t200\t1.5\t2.5\t\t-20.5\n",
    "states.us.txt": "state_id\tstate_name\tstate_population\tstate_gsp\n1\tOhio\t1000\t2000\n",
    "site.pages.us.txt": "site_page_id\tsite_page_url\tsite_page_tag\n10\t/ten\tshoes\n11\t/eleven\thats\n",
    "user.profile.tags.us.txt": "user_profile_tag_id\tv\tp\tm\td\n10\tboots\tx\ty\tz\n",
}


@pytest.fixture()
def known(spark, tmp_path):
    folder = tmp_path / "dict"
    folder.mkdir()
    for name, text in FILES.items():
        (folder / name).write_text(text)
    return read_dictionaries(spark, str(folder))


def log(spark, *rows):
    base = dict.fromkeys(STREAM_SCHEMA.names) | {"city_id": 1, "ad_exchange_id": 1, "log_type_id": 1, "ipinyou_id": "u"}
    return spark.createDataFrame([tuple((base | r)[n] for n in STREAM_SCHEMA.names) for r in rows], STREAM_SCHEMA)


def test_columns(spark, known):
    served = enrich_log(log(spark, {}), known, slot_size=True)
    assert served.columns == [*SERVED_BID_COLUMNS, *SERVED_DICTIONARY_COLUMNS, "ad_slot_size", *UA_COLUMNS]
    assert len(SERVED_BID_COLUMNS) + len(SERVED_DICTIONARY_COLUMNS) == 30


def test_keywords(spark, known):
    tags = ["10", "010", "11", "1,2", "12", None]
    served = enrich_log(log(spark, *[{"bid_id": str(i), "user_tags": t} for i, t in enumerate(tags)]), known)
    got = sorted((r["bid_id"], r["keyword_name"]) for r in served.select("bid_id", F.coalesce("keyword_name", F.lit("-")).alias("keyword_name")).collect())
    assert got == [("0", "boots"), ("0", "shoes"), ("1", "boots"), ("1", "shoes"), ("2", "hats"), ("3", "1,2"), ("4", "12"), ("5", "-")]


def test_unknown_ids(spark, known):
    served = enrich_log(log(spark, {"bid_id": "a", "city_id": 7}, {"bid_id": "b", "ad_exchange_id": 9, "log_type_id": None}, {"bid_id": "c", "city_id": 2}), known)
    got = {r["bid_id"]: r for r in served.collect()}
    assert set(got) == {"b", "c"}
    assert got["b"]["ad_exchange_name"] is None and got["b"]["log_type_name"] is None and got["b"]["state_name"] == "Ohio"
    assert got["b"]["coordinates"] == [-20.5, 10.5] and got["c"]["coordinates"] == [0.0, 0.0]
    assert got["c"]["state_name"] is None and got["c"]["city_name"] == "Bix"


def test_null_user_option(spark, known):
    rows = log(spark, {"ipinyou_id": "null"}, {"ipinyou_id": "u"})
    assert enrich_log(rows, known).count() == 2
    assert enrich_log(rows, known, skip_null_users=True).count() == 1


def test_index_document(spark, known):
    values = dict.fromkeys(RAW_LAYOUT, "x") | {"city_id": "1", "ad_exchange_id": "1", "log_type_id": "bad", "user_tags": "a,b,"}
    raw = spark.createDataFrame([tuple(values[n] for n in RAW_LAYOUT)], ", ".join(f"{n} string" for n in RAW_LAYOUT))
    document = enrich_index_document(raw, known)
    assert len(document.columns) == len(set(document.columns)) and "region" not in document.columns
    row = document.first()
    assert row["user_tags_array"] == ["a", "b"] and row["ad_exchange_id"] == 1 and row["log_type_id"] is None


def test_log_folder_job(spark, known, tmp_path):
    values = {"bid_id": "b1", "city_id": "1", "ad_exchange_id": "1", "log_type_id": "1", "predict": "TRUE"}
    line = "\t".join(values.get(n, "") for n in BATCH_LAYOUT)
    logs = tmp_path / "logs"
    (logs / "deep").mkdir(parents=True)
    (logs / "site-click.20130606-aa.txt").write_text(line + "\n")
    (logs / "deep" / "site-open.20130607-aa.txt").write_text(line.replace("b1", "b2") + "\n")
    assert {(r["bid_id"], r["log_date"]) for r in read_log_folder(spark, str(logs), BATCH_SCHEMA).collect()} == {("b1", "20130606"), ("b2", "20130607")}
    (logs / "site-open.20130608-aa.txt").write_text(line + "\tignored\nonly\tthree\tfields\n")
    enrich_log_folder(spark, str(logs), known, str(tmp_path / "out"), str(tmp_path / "rejects"))
    bad = spark.read.parquet(str(tmp_path / "rejects")).collect()
    assert [(r["bid_id"], r["log_date"], r["reject_reason"]) for r in bad] == [("only", "20130608", "too few fields")]
    stored = spark.read.parquet(str(tmp_path / "out")).where("log_date < '20130608'")
    assert stored.count() == 2 and {"predict", "log_date"} <= set(stored.columns)


def test_text_row_has_52_columns(spark, known):
    served = enrich_log(log(spark, {}), known)
    for name in ["predict", "false_prob", "true_prob", *FEATURE_COLUMNS]:
        served = served.withColumn(name, F.lit(None).cast("string"))
    row = serving_text_row(served)
    assert len(row.columns) == 52 and set(t for _, t in row.dtypes) == {"string"}
    assert (row.first()["coordinates0"], row.first()["coordinates1"]) == ("-20.5", "10.5")


def test_labelled_csv(spark, tmp_path):
    (tmp_path / "train.csv").write_text("price,sitelead\n1.5,TRUE\n2,FALSE\n")
    assert dict(read_labelled_csv(spark, str(tmp_path / "train.csv")).dtypes) == {"price": "double", "sitelead": "boolean"}


def method_sizes(spark, df):
    """Largest compiled method of each stage of a frame."""
    names = ("spark.sql.adaptive.enabled", "spark.sql.codegen.hugeMethodLimit")
    before = {name: spark.conf.get(name) for name in names}
    for name, value in zip(names, ("false", "65535")):
        spark.conf.set(name, value)
    try:
        stages = df.select("*")._jdf.queryExecution().debug().codegenToSeq()
        return [stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size())]
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_no_method_is_too_long_to_compile(spark, tmp_path):
    """Stages of the enriching jobs: parsing, and enriching what was parsed and held."""
    folder = "/root/testdata/sf0.001"
    known = view.dictionaries(spark, folder)
    lines = view.log_messages(spark, folder, view.table(spark, folder, "events")).select("value")
    lines.write.parquet(str(tmp_path / "lines"))
    parsed = parse_lines(spark.read.parquet(str(tmp_path / "lines")), STREAM_SCHEMA)
    accepted(parsed).write.parquet(str(tmp_path / "parsed"))
    held = spark.read.parquet(str(tmp_path / "parsed"))
    log = view.bid_log(spark, folder, BATCH_LAYOUT)
    for job in (parsed, enrich_log(held, known, slot_size=True), enrich_log(log, known, extra=["predict"], slot_size=True)):
        assert max(method_sizes(spark, job)) < 8000


def test_rows_without_a_keyword_key_are_spread(spark):
    """Joined by shuffle, rows without a key do not meet in one partition, and match nothing."""
    log = spark.range(4000).select(F.col("id").cast("string").alias("bid_id"), F.when(F.col("id") % 2 == 0, "1,2").alias("user_tags"))
    keyword = spark.range(-50, 50).select(F.col("id").alias("keyword_id"), F.lit("k").alias("keyword_name")).hint("merge")
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = join_keyword(log, keyword)
        assert joined.where("keyword_name = 'k'").isEmpty() and joined.count() == 4000
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
        assert len(sizes) == 4 and max(sizes) < 1500
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
