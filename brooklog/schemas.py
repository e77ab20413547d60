"""Column layouts shared by all modules, as Spark DDL.

``until_offset`` and ``latest`` are exclusive everywhere. Log timestamps are
zone-free; they become zoned only where a watermark needs them.
"""

LOG = (
    "topic STRING, partition INT, offset BIGINT, timestamp TIMESTAMP_NTZ, "
    "key STRING, value STRING"
)
CATALOG = "topic STRING, partition INT, earliest BIGINT, latest BIGINT"
CHANGES = (
    "change STRING, batch BIGINT, topic STRING, partition INT, file STRING, "
    "earliest BIGINT, latest BIGINT"
)
RANGES = "topic STRING, partition INT, from_offset BIGINT, until_offset BIGINT"
TAGGED = (
    "topic STRING, partition INT, offset BIGINT, time_partition STRING, message STRING"
)
LEDGER = (
    "pipeline STRING, cycle_id BIGINT, topic STRING, partition INT, "
    "from_offset BIGINT, until_offset BIGINT, committed_at TIMESTAMP"
)
STATUS = (
    "pipeline STRING, cycle_id BIGINT, module STRING, status STRING, "
    "message STRING, at TIMESTAMP"
)
METRIC = (
    "pipeline STRING, cycle_id BIGINT, module STRING, metric STRING, "
    "value BIGINT, at TIMESTAMP"
)

TOPIC_PARTITION = ["topic", "partition"]
