from bidtrail.sources import messages


def test_kafka_options():
    options = messages.kafka_options("h:9092", "a,b", "smallest", group="g", min_partitions=10, max_per_trigger=1000)
    assert options == {
        "kafka.bootstrap.servers": "h:9092",
        "subscribe": "a,b",
        "startingOffsets": "earliest",
        "kafka.group.id": "g",
        "minPartitions": "10",
        "maxOffsetsPerTrigger": "1000",
    }
    assert messages.kafka_options("h", "t", "largest")["startingOffsets"] == "latest"


def test_binary_messages_become_text(spark):
    raw = spark.createDataFrame([(bytearray(b"k"), bytearray("é".encode()), "t", 0, 1)], "key binary, value binary, topic string, partition int, offset long")
    row = messages.as_messages(raw).first()
    assert (row["key"], row["value"], row["offset"]) == ("k", "é", 1)
