from larderlake.sources.files import (
    decode_json_value,
    infer_csv_schema,
    pinned_csv_schema,
    read_csv_stream,
    read_table_stream,
    register_bronze,
    unwrap_json,
    with_lineage,
)
from larderlake.sources.kafka import kafka_options, read_kafka_stream
from larderlake.sources.scratch import scratch_dir
from larderlake.sources.tables import (
    append_table,
    layer_path,
    read_layer,
    replace_table,
    write_table,
)

__all__ = [
    "append_table",
    "decode_json_value",
    "infer_csv_schema",
    "kafka_options",
    "layer_path",
    "pinned_csv_schema",
    "read_csv_stream",
    "read_kafka_stream",
    "read_layer",
    "read_table_stream",
    "register_bronze",
    "replace_table",
    "scratch_dir",
    "unwrap_json",
    "with_lineage",
    "write_table",
]
