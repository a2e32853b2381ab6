"""Dataset and pipeline parameters, and the fixed values of the data contract."""

from __future__ import annotations

from dataclasses import dataclass, field

# --- Fixed values: they must be spelled exactly so, since stored data carries them. ---

# Intake outcomes
SUCCESS = "SUCCESS"
DUPLICATE = "DUPLICATE"
RETRY_ROUTED = "RETRY_ROUTED"
DLQ_ROUTED = "DLQ_ROUTED"

# Group states
GROUP_PENDING = "PENDING"
GROUP_SUCCESS = "SUCCESS"
GROUP_FAIL = "FAIL"

# Verdicts
PASSED = "PASSED"
QUARANTINED = "QUARANTINED"
REJECTED = "REJECTED"

# Kinds of drift, compatibility and recommended action
NEW_FIELD = "NEW_FIELD"
MISSING_FIELD = "MISSING_FIELD"
TYPE_CHANGE = "TYPE_CHANGE"
FULL = "FULL"
BACKWARD = "BACKWARD"
NONE = "NONE"
AUTO_EVOLVE = "AUTO_EVOLVE"
REJECT = "REJECT"

# Severities and their weights in the score
SEVERITY_WEIGHT = {"CRITICAL": 4, "HIGH": 3, "MEDIUM": 2, "LOW": 1}

# Failure reasons
FATAL_PARSE_ERROR = "FATAL_PARSE_ERROR"
FATAL_MISSING_FIELDS = "FATAL_MISSING_FIELDS"
NO_CONTROL_DOC = "NO_CONTROL_DOC"
RETRY_EXHAUSTED = "RETRY_EXHAUSTED"
BATCH_TIMEOUT = "BATCH_TIMEOUT"

# Envelope fields, in order
ENVELOPE_FIELDS = [
    "event_id", "event_version", "event_type", "trace_id", "idempotency_key",
    "timestamp", "source", "pipeline_version", "schema_id", "trade_group_id",
    "trade_id", "payload",
]

# Control document fields, in order
CONTROL_FIELDS = [
    "trade_group_id", "expected_count", "trade_ids", "timestamp", "source",
    "pipeline_version", "schema_id",
]

# Columns of an event once it is taken in (the envelope less its version and trace id)
EVENT_FIELDS = [
    "event_id", "trade_group_id", "trade_id", "idempotency_key", "event_type",
    "timestamp", "schema_id", "source", "pipeline_version", "payload",
]

# Columns of the stored record, in order
STORED_FIELDS = [
    "event_id", "trade_group_id", "trade_id", "idempotency_key", "event_type",
    "timestamp", "source", "pipeline_version", "schema_id", "payload_json",
    "validation_status", "schema_version", "schema_valid", "drift_detected",
    "drift_type", "breaking_change", "compatibility", "schema_violations_json",
    "quality_score", "quality_passed", "quality_threshold",
    "quality_rule_results_json", "ingestion_time", "source_topic",
]

# Partition columns of the lake, in order
PARTITION_FIELDS = ["year", "month", "day", "hour", "source"]

# Verdict scores: at least PASS_SCORE passes, at least QUARANTINE_SCORE is quarantined
PASS_SCORE = 0.7
QUARANTINE_SCORE = 0.5

# --- End of fixed values ---


@dataclass(frozen=True)
class Topics:
    control: str = "banking-control"
    primary: str = "banking-transactions"
    retry: str = "banking-transactions-retry"
    dlq: str = "banking-transactions-dlq"


@dataclass(frozen=True)
class DatasetSpec:
    """What the publisher must know about one dataset."""

    schema_id: str
    id_field: str
    event_type: str
    group_size: int = 500
    pipeline_version: str = "1.0.0"
    event_version: str = "1.0"
    source: str = "cloud"
    topics: Topics = field(default_factory=Topics)

    def __post_init__(self) -> None:
        if self.group_size < 1:
            raise ValueError("group_size must be >= 1")


BANKING = DatasetSpec("banking_transaction_v1", "transaction_id", "banking_transaction")
ORDERS = DatasetSpec("tpch_orders_v1", "o_orderkey", "tpch_order")
LINEITEM = DatasetSpec("tpch_lineitem_v1", "line_item_id", "tpch_lineitem")


@dataclass(frozen=True)
class PipelineConfig:
    """Tunable behaviour of intake, validation, storage and streaming."""

    quality_threshold: float = 0.7
    max_attempts: int = 3
    backoff_base_ms: int = 2000
    dedup_ttl_minutes: int = 60
    group_timeout_ms: int = 5 * 60 * 1000
    dedup_by_schema: bool = False
    target_file_mb: int = 32
    max_records_per_file: int = 200_000
    default_record_bytes: int = 200
    idle_flush: str = "5 seconds"
    salts: int = 16
    topics: Topics = field(default_factory=Topics)

    @property
    def control_wait_ms(self) -> int:
        """How long an event waits for its control document: all back-offs together."""
        return sum(self.backoff_base_ms * 2 ** n for n in range(self.max_attempts))
