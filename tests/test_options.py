import warnings

import pytest

from queuelog import options as opt

BASE = {
    "properties.nameserver.address": "/log",
    "properties.topic": "t",
    "properties.group.id": "g",
    "format": "json",
}


def fails(match, call, options, **kw):
    with pytest.raises(ValueError, match=match):
        call(options, **kw)


def test_defaults():
    o = opt.source_options(BASE)
    assert (o.startup_mode, o.discovery_interval_ms, o.tag) == ("group-offsets", -1, None)
    s = opt.sink_options(BASE)
    assert (s.partitioner, s.buffer_rows, s.buffer_interval_ms, s.guarantee) == ("default", 0, 0, "at-least-once")
    assert s.parallelism is None and s.key_fields == []


@pytest.mark.parametrize("key", sorted(BASE))
def test_required(key):
    left = {k: v for k, v in BASE.items() if k != key}
    fails(key, opt.source_options, left)
    fails(key, opt.sink_options, left)


def test_startup_modes_need_their_companions():
    fails("timestamp-millis", opt.source_options, {**BASE, "scan.startup.mode": "timestamp"})
    fails("specific-offsets", opt.source_options, {**BASE, "scan.startup.mode": "specific-offsets"})
    fails("scan.startup.mode", opt.source_options, {**BASE, "scan.startup.mode": "sometime"})


@pytest.mark.parametrize(
    "text",
    ["", ";", "partition:0", "partition:a,offset:1", "offset:1,partition:0", "partition:0,offset:1,x:2",
     "partition:0,offset:1;;partition:1,offset:2", "partition:0:1,offset:1", "partition:99999999999,offset:1"],
)
def test_bad_specific_offsets(text):
    fails("specific-offsets", opt.source_options,
          {**BASE, "scan.startup.mode": "specific-offsets", "scan.startup.specific-offsets": text})


def test_specific_offsets():
    assert opt.parse_specific_offsets("partition:0,offset:42;partition:1,offset:300") == {0: 42, 1: 300}
    assert opt.parse_specific_offsets("partition:0,offset:1;partition:0,offset:-2;") == {0: -2}


def test_partitioner():
    fails("sink.partitioner", opt.sink_options, {**BASE, "sink.partitioner": ""})
    fails("round-robin", opt.sink_options, {**BASE, "sink.partitioner": "round-robin", "key.fields": "a"})


def test_delivery():
    fails("transactional-id-prefix", opt.sink_options, {**BASE, "sink.delivery-guarantee": "exactly-once"})
    fails("delivery-guarantee", opt.sink_options, {**BASE, "sink.delivery-guarantee": "maybe"})
    fails("transactional-id-prefix", opt.sink_options, {**BASE, "sink.transactional-id-prefix": "é" * 32_001})
    assert opt.sink_options({**BASE, "sink.transactional-id-prefix": "é" * 32_000}).txn_prefix


def test_deprecated_semantic():
    options = {**BASE, "sink.semantic": "Exactly_once", "sink.transactional-id-prefix": "p"}
    with pytest.warns(DeprecationWarning, match="sink.semantic"):
        assert opt.sink_options(options).guarantee == "exactly-once"
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        fails("transactional-id-prefix", opt.sink_options, {**BASE, "sink.semantic": "exactly-once"})


def test_unknown_options():
    fails("unknown option 'nonsense'", opt.source_options, {**BASE, "nonsense": "1"})
    opt.source_options({**BASE, "properties.anything": "1", "sink.parallelism": "2"})
    fails("unknown option 'json.nonsense'", opt.source_options, {**BASE, "json.nonsense": "1"})


def test_primary_key_needs_a_changelog_format():
    fails("PRIMARY KEY", opt.source_options, BASE, primary_key=["id"])
    fails("PRIMARY KEY", opt.sink_options, BASE, primary_key=["id"])
    opt.source_options({**BASE, "format": "debezium-json"}, primary_key=["id"])


def test_subject_default():
    o = opt.sink_options({**BASE, "format": "avro-confluent"})
    assert o.format_options == {"schema-registry.subject": "t-value"}
    o = opt.sink_options({**BASE, "format": "avro-confluent", "avro-confluent.schema-registry.subject": "s"})
    assert o.format_options == {"schema-registry.subject": "s"}
    assert opt.sink_options(BASE).format_options == {}


@pytest.mark.parametrize("text, ms", [("5 s", 5000), ("1min", 60_000), ("250", 250), (0, 0), ("2 hours", 7_200_000), ("3 ms", 3)])
def test_durations(text, ms):
    assert opt.parse_duration_ms(text, "k") == ms


def test_bad_duration():
    with pytest.raises(ValueError, match="k"):
        opt.parse_duration_ms("soon", "k")


def test_secrets_are_redacted():
    assert opt.redacted({"secret.key": "x", "access.key": "y", "tag": "z"}) == {
        "secret.key": "******", "access.key": "******", "tag": "z",
    }
