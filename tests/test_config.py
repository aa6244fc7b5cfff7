"""Kafka option maps (tested offline: no broker is available here)."""

from ordwave.config import IngestConfig, config_from_env, kafka_sink_options, kafka_source_options


def test_plaintext_source_options():
    o = kafka_source_options(IngestConfig(max_offsets_per_trigger=100), ["orders-topic", "pricing-topic"])
    assert o["subscribe"] == "orders-topic,pricing-topic"
    assert o["startingOffsets"] == "latest" and o["failOnDataLoss"] == "false"
    assert o["maxOffsetsPerTrigger"] == "100"
    assert not any(k.startswith("kafka.sasl") for k in o)


def test_sasl_options_shared_by_source_and_sink():
    cfg = config_from_env({"KAFKA_BOOTSTRAP_SERVER": "b:9092", "KAFKA_API_KEY": "KEY123", "KAFKA_API_SECRET": "SECRET456"})
    src, sink = kafka_source_options(cfg, "orders-topic"), kafka_sink_options(cfg, "orders-topic")
    for o in (src, sink):
        assert o["kafka.bootstrap.servers"] == "b:9092"
        assert o["kafka.security.protocol"] == "SASL_SSL" and o["kafka.sasl.mechanism"] == "PLAIN"
        assert 'username="KEY123"' in o["kafka.sasl.jaas.config"]
    assert "KEY123" not in repr(cfg) and "SECRET456" not in repr(cfg)


def test_env_overrides():
    cfg = config_from_env({"KAFKA_BOOTSTRAP": "x:1", "CHECKPOINT_DIR": "/c"}, starting_offsets="earliest")
    assert cfg.kafka_bootstrap == "x:1" and cfg.checkpoint_root == "/c" and cfg.starting_offsets == "earliest"


def test_config_rejects_bad_values():
    import pytest
    from ordwave.config import IngestConfig
    for kw in ({"validator": "loose"}, {"state_store": "memory"}, {"starting_offsets": "middle"},
               {"max_files_per_trigger": 0}, {"trigger_seconds": -1}):
        with pytest.raises(ValueError):
            IngestConfig(**kw)
    assert IngestConfig(starting_offsets='{"orders-topic":{"0":5}}').starting_offsets.startswith("{")
