"""Fixed values of the delivery contract.

Everything below has to equal the contract's values for results to be right;
nothing here is tunable logic.
"""

# Numeric severity of each level name.
LEVEL_RANK = {
    "debug": 100,
    "info": 200,
    "notice": 250,
    "warning": 300,
    "warn": 300,
    "error": 400,
    "critical": 500,
    "alert": 550,
    "emergency": 600,
}

# Discriminators accepted as contextType.
CONTEXT_TYPES = ["exception", "query", "job", "mail", "http", "scheduled"]

# Spellings of a switched-off flag.
FALSE_WORDS = ["false", "0", "off", "no", ""]

# Needles of a sensitive key.
SENSITIVE_KEYS = [
    "password", "passwd", "secret", "token", "authorization", "api_key",
    "apikey", "private_key", "cookie", "csrf", "otp",
]

# Masks for string values, in order of application.
MASKS = [
    (r"\beyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\b", "[JWT]"),
    (r"(?i)Bearer\s+[A-Za-z0-9._~+\/=-]{10,}", "Bearer [REDACTED]"),
    (r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\b", "[EMAIL]"),
    (r"\b\d(?:[ -]?\d){12,18}\b", "[CARD]"),
]
REDACTED = "[REDACTED]"
TOO_DEEP = "[MAX_DEPTH]"
MAX_DEPTH = 10

# Batch limits.
MAX_ENTRIES = 100
MAX_BYTES = 1_800_000
MIN_BYTES = 1024
TRACE_LINES = 30
REASON_CHARS = 500
MESSAGE_BYTES = 16_384

# Long-running commands whose records are never buffered.
UNBUFFERED_COMMANDS = [
    "horizon", "horizon:supervisor", "schedule:work", "queue:listen",
    "reverb:start", "pulse:check", "pulse:work", "octane:start",
]

# Retry and pacing rules (seconds unless named otherwise).
QUEUE_BACKOFF = [10, 30, 120, 300]
ATTEMPT_TIMEOUT = 30
MIN_RETRY_WINDOW = 60
WORKER_GRACE = 86_400
RETRY_AFTER_DEFAULT = 30
RETRY_AFTER_MIN = 1
RETRY_AFTER_MAX = 600
DRAIN_BACKOFF_CAP = 60
DRAIN_MAX_FAILURES = 5
STOP_STATUSES = [401, 403, 404, 405]
MAX_CHUNK = 5000

# Local defaults of the effective configuration.
CONFIG_DEFAULTS = {
    "enabled": "true",
    "heartbeat_interval_seconds": None,
    "capture_queries": "false",
    "capture_jobs": "true",
    "capture_mails": "true",
    "capture_scheduled": "true",
    "slow_query_ms": "1000",
    "timeout_ms": 5000,
    "flush_interval_sec": 10,
    "batch_size": 100,
}
MIN_REMOTE_BATCH = 10

# Class names under which the delivery job and its failures show up in data.
DELIVERY_JOB = "App\\Jobs\\DeliverLogBatch"
DELIVERY_FAILED = "DeliveryFailed"
GAVE_UP = ["MaxAttemptsExceeded", "TimeoutExceeded"]
