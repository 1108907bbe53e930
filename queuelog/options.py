"""Table options: the keys a topic table is declared with, and their checks.

Everything here runs on the driver before any job starts and raises ``ValueError``
naming the offending option.
"""

from __future__ import annotations

import logging
import re
import warnings
from dataclasses import dataclass, field

log = logging.getLogger(__name__)

# Option keys, enumerations and defaults of the table surface.
ADDRESS = "properties.nameserver.address"
TOPIC = "properties.topic"
GROUP = "properties.group.id"
FORMAT = "format"
TAG = "tag"
STARTUP_MODE = "scan.startup.mode"
SPECIFIC_OFFSETS = "scan.startup.specific-offsets"
TIMESTAMP_MILLIS = "scan.startup.timestamp-millis"
DISCOVERY_INTERVAL = "scan.topic-partition-discovery.interval-millis"
CONSUMER_TIMEOUT = "consumer.timeout"
PRODUCER_TIMEOUT = "producer.timeout"
PARTITIONER = "sink.partitioner"
KEY_FIELDS = "key.fields"
BUFFER_ROWS = "sink.buffer-flush.max-rows"
BUFFER_INTERVAL = "sink.buffer-flush.interval"
GUARANTEE = "sink.delivery-guarantee"
TXN_PREFIX = "sink.transactional-id-prefix"
PARALLELISM = "sink.parallelism"
SEMANTIC = "sink.semantic"
ACCESS_KEY = "access.key"
SECRET_KEY = "secret.key"
CONNECTOR = "connector"
PASS_THROUGH = "properties."

STARTUP_MODES = ("earliest-offset", "latest-offset", "group-offsets", "timestamp", "specific-offsets")
GUARANTEES = ("none", "at-least-once", "exactly-once")
REGISTRY_FORMATS = ("avro-confluent", "debezium-avro-confluent")
MAX_PREFIX_BYTES = 64_000

SOURCE_KEYS = {
    CONNECTOR, ADDRESS, TOPIC, GROUP, FORMAT, TAG, STARTUP_MODE, SPECIFIC_OFFSETS,
    TIMESTAMP_MILLIS, DISCOVERY_INTERVAL, CONSUMER_TIMEOUT, ACCESS_KEY, SECRET_KEY,
}
SINK_KEYS = {
    CONNECTOR, ADDRESS, TOPIC, GROUP, FORMAT, TAG, PRODUCER_TIMEOUT, PARTITIONER, KEY_FIELDS,
    BUFFER_ROWS, BUFFER_INTERVAL, GUARANTEE, TXN_PREFIX, PARALLELISM, SEMANTIC, ACCESS_KEY,
    SECRET_KEY,
}

# The format names, their own options, and which of them carry changes.
FORMAT_OPTIONS = {
    "json": {"ignore-parse-errors", "fail-on-missing-field", "timestamp-format.standard"},
    "csv": {"ignore-parse-errors", "field-delimiter", "quote-character", "null-literal"},
    "raw": {"charset"},
    "avro": set(),
    "avro-confluent": {"schema-registry.subject", "schema-registry.url"},
    "debezium-json": {"ignore-parse-errors", "schema-include", "timestamp-format.standard"},
    "debezium-avro-confluent": {"schema-registry.subject", "schema-registry.url"},
    "canal-json": {"ignore-parse-errors", "timestamp-format.standard"},
    "maxwell-json": {"ignore-parse-errors", "timestamp-format.standard"},
    "ogg-json": {"ignore-parse-errors", "timestamp-format.standard"},
}
CHANGELOG_FORMATS = {
    "debezium-json", "debezium-avro-confluent", "canal-json", "maxwell-json", "ogg-json",
}


@dataclass(frozen=True)
class SourceOptions:
    path: str
    topic: str
    group: str
    format: str
    tag: str | None
    startup_mode: str
    specific_offsets: dict[int, int]
    timestamp_millis: int | None
    discovery_interval_ms: int
    format_options: dict[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class SinkOptions:
    path: str
    topic: str
    group: str
    format: str
    tag: str | None
    partitioner: str
    key_fields: list[str]
    buffer_rows: int
    buffer_interval_ms: int
    guarantee: str
    txn_prefix: str | None
    parallelism: int | None
    format_options: dict[str, str] = field(default_factory=dict)


def changelog_mode(fmt: str) -> set[str]:
    """Row kinds a format can carry."""
    return {"+I", "-U", "+U", "-D"} if fmt in CHANGELOG_FORMATS else {"+I"}


def validate_primary_key(fmt: str, primary_key: list[str] | None) -> None:
    if primary_key and changelog_mode(fmt) == {"+I"}:
        raise ValueError(
            f"format '{fmt}' is insert-only, so a PRIMARY KEY ({', '.join(primary_key)}) "
            "cannot be guaranteed on this table"
        )


def parse_specific_offsets(text: str) -> dict[int, int]:
    """``partition:0,offset:1200;partition:5,offset:80`` as a dict; the last duplicate wins."""

    def bad() -> ValueError:
        return ValueError(
            f"'{SPECIFIC_OFFSETS}' should look like "
            f"'partition:0,offset:1200;partition:5,offset:80', but is '{text}'"
        )

    entries = re.sub(";+$", "", text).split(";")  # empty entries at the end do not count
    offsets = {}
    for entry in entries:
        # empty fields at the end of an entry do not count either
        match = re.fullmatch(r"partition:([+-]?\d+),offset:([+-]?\d+),*", entry, re.ASCII)
        if not match:
            raise bad()
        partition, offset = (int(number) for number in match.groups())
        if not (-(2**31) <= partition < 2**31 and -(2**63) <= offset < 2**63):
            raise bad()
        offsets[partition] = offset
    return offsets


# Unit labels of a duration and their length in milliseconds.
_DURATION_UNITS = {
    "ns": 1e-6, "nano": 1e-6, "nanosecond": 1e-6,
    "us": 1e-3, "µs": 1e-3, "micro": 1e-3, "microsecond": 1e-3,
    "": 1, "ms": 1, "milli": 1, "millisecond": 1,
    "s": 1000, "sec": 1000, "second": 1000,
    "m": 60_000, "min": 60_000, "minute": 60_000,
    "h": 3_600_000, "hour": 3_600_000,
    "d": 86_400_000, "day": 86_400_000,
}


def parse_duration_ms(text: str | int, key: str) -> int:
    """A duration such as ``5 s``, ``1min`` or a bare number of milliseconds."""
    match = re.fullmatch(r"\s*(\d+)\s*([a-zA-Zµ]*)\s*", str(text))
    if match:
        unit = match[2].lower()
        for label in (unit, unit.removesuffix("s")):
            if label in _DURATION_UNITS:
                return int(int(match[1]) * _DURATION_UNITS[label])
    raise ValueError(f"'{key}' should be a duration such as '5 s', but is '{text}'")


def _integer(options: dict, key: str, default):
    if options.get(key) is None:
        return default
    try:
        return int(options[key])
    except ValueError:
        raise ValueError(f"'{key}' should be an integer, but is '{options[key]}'") from None


def _required(options: dict, key: str) -> str:
    value = options.get(key)
    if value is None:
        raise ValueError(f"option '{key}' must be set")
    return str(value)


def _format(options: dict) -> tuple[str, dict[str, str]]:
    fmt = _required(options, FORMAT)
    if fmt not in FORMAT_OPTIONS:
        raise ValueError(f"unknown '{FORMAT}': '{fmt}', expected one of {sorted(FORMAT_OPTIONS)}")
    prefix = fmt + "."
    own = {k.removeprefix(prefix): str(v) for k, v in options.items() if k.startswith(prefix)}
    for key in own:
        if key not in FORMAT_OPTIONS[fmt]:
            raise ValueError(f"unknown option '{prefix}{key}'")
    return fmt, own


def _check_unknown(options: dict, fmt: str, strict: bool) -> None:
    """One declaration serves both directions, so either may carry the other's keys."""
    ignored = []
    for key in options:
        if key in SOURCE_KEYS | SINK_KEYS or key.startswith(fmt + "."):
            continue
        if strict and not key.startswith(PASS_THROUGH):
            raise ValueError(f"unknown option '{key}'")
        ignored.append(key)
    if ignored:
        log.info("options without effect here: %s", ", ".join(sorted(ignored)))


def redacted(options: dict) -> dict:
    """A copy that is safe to print."""
    return {k: "******" if k in (ACCESS_KEY, SECRET_KEY) else v for k, v in options.items()}


def source_options(options: dict, primary_key: list[str] | None = None) -> SourceOptions:
    fmt, own = _format(options)
    _check_unknown(options, fmt, strict=True)
    topic = _required(options, TOPIC)
    mode = options.get(STARTUP_MODE) or "group-offsets"
    if mode not in STARTUP_MODES:
        raise ValueError(f"unknown '{STARTUP_MODE}': '{mode}', expected one of {STARTUP_MODES}")
    for needed_by, key in (("timestamp", TIMESTAMP_MILLIS), ("specific-offsets", SPECIFIC_OFFSETS)):
        if mode == needed_by and options.get(key) is None:
            raise ValueError(f"to start at '{mode}', give '{key}' too")
    validate_primary_key(fmt, primary_key)
    _integer(options, CONSUMER_TIMEOUT, 30_000)
    return SourceOptions(
        path=_required(options, ADDRESS),
        topic=topic,
        group=_required(options, GROUP),
        format=fmt,
        tag=options.get(TAG),
        startup_mode=mode,
        specific_offsets=(
            parse_specific_offsets(str(options[SPECIFIC_OFFSETS]))
            if mode == "specific-offsets" else {}
        ),
        timestamp_millis=_integer(options, TIMESTAMP_MILLIS, None),
        discovery_interval_ms=_integer(options, DISCOVERY_INTERVAL, -1),
        format_options=own,
    )


def default_subject(options: dict) -> dict:
    """Fill in ``<format>.schema-registry.subject`` for the two registry formats."""
    topic, fmt = _required(options, TOPIC), options.get(FORMAT)
    if fmt not in REGISTRY_FORMATS:
        return dict(options)
    return {f"{fmt}.schema-registry.subject": f"{topic}-value", **options}


def check_txn_prefix(prefix: str | None) -> str | None:
    if prefix is not None and len(prefix.encode("utf-8")) > MAX_PREFIX_BYTES:
        raise ValueError(f"'{TXN_PREFIX}' is longer than {MAX_PREFIX_BYTES} bytes in UTF-8")
    return prefix


def delivery_guarantee(options: dict) -> str:
    """The guarantee, from its own key or from the deprecated one."""
    value = options.get(GUARANTEE) or "at-least-once"
    if options.get(SEMANTIC) is not None:
        warnings.warn(f"'{SEMANTIC}' is deprecated, use '{GUARANTEE}'", DeprecationWarning, stacklevel=3)
        value = options[SEMANTIC]
    name = str(value).lower().replace("_", "-")
    if name not in GUARANTEES:
        raise ValueError(f"unknown '{GUARANTEE}': '{value}', expected one of {GUARANTEES}")
    return name


def sink_options(options: dict, primary_key: list[str] | None = None) -> SinkOptions:
    options = default_subject(options)
    fmt, own = _format(options)
    _check_unknown(options, fmt, strict=False)
    keys = options.get(KEY_FIELDS)
    if isinstance(keys, str):
        keys = [k for k in keys.split(";") if k]
    partitioner = options.get(PARTITIONER)
    if partitioner == "":
        raise ValueError(f"'{PARTITIONER}' is empty; leave it out to take the default")
    if partitioner == "round-robin" and options.get(KEY_FIELDS) is not None:
        raise ValueError(f"round-robin does not look at '{KEY_FIELDS}': set that or '{PARTITIONER}', not both")
    guarantee = delivery_guarantee(options)
    prefix = check_txn_prefix(options.get(TXN_PREFIX))
    if guarantee == "exactly-once" and prefix is None:
        raise ValueError(f"'{TXN_PREFIX}' must be set with '{GUARANTEE}' 'exactly-once'")
    validate_primary_key(fmt, primary_key)
    _integer(options, PRODUCER_TIMEOUT, 30_000)
    return SinkOptions(
        path=_required(options, ADDRESS),
        topic=_required(options, TOPIC),
        group=_required(options, GROUP),
        format=fmt,
        tag=options.get(TAG),
        partitioner=partitioner or "default",
        key_fields=list(keys or primary_key or []),
        buffer_rows=_integer(options, BUFFER_ROWS, 0),
        buffer_interval_ms=parse_duration_ms(options.get(BUFFER_INTERVAL, 0), BUFFER_INTERVAL),
        guarantee=guarantee,
        txn_prefix=prefix,
        parallelism=_integer(options, PARALLELISM, None),
        format_options=own,
    )
