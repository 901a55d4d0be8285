from ledgerline.streaming.ingest import (
    ingest_available,
    kafka_sink_options,
    kafka_source_options,
    publish,
    read_kafka,
    to_kafka_records,
)

__all__ = ["ingest_available", "kafka_sink_options", "kafka_source_options", "publish", "read_kafka",
           "to_kafka_records"]
