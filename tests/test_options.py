import pickle
from datetime import timedelta

import pytest

from keylane.options import OPTIONS, PipelineOptions


@pytest.mark.parametrize("name", ["bootstrap_servers", "subscribed_topics", "allowed_events"])
def test_lists(name):
    assert getattr(PipelineOptions(**{name: "one"}), name) == ("one",)
    assert getattr(PipelineOptions(**{name: ["one", "two"]}), name) == ("one", "two")
    assert getattr(PipelineOptions(**{name: None}), name) is None
    with pytest.raises(ValueError):
        PipelineOptions(**{name: 7})


@pytest.mark.parametrize("name", [n for n, (kind, _) in OPTIONS.items() if kind == "seconds" and n != "idempotence_ttl"])
def test_seconds(name):
    assert getattr(PipelineOptions(**{name: 5}), name) == 5.0
    assert getattr(PipelineOptions(**{name: timedelta(minutes=1)}), name) == 60.0
    with pytest.raises(ValueError):
        PipelineOptions(**{name: "soon"})


@pytest.mark.parametrize("name", [n for n, (kind, _) in OPTIONS.items() if kind in ("int", "float")])
def test_numbers(name):
    assert getattr(PipelineOptions(**{name: "3"}), name) == 3
    with pytest.raises(ValueError):
        PipelineOptions(**{name: "many"})


@pytest.mark.parametrize("text, mode", [("pipeline", "pipeline"), ("PIPELINE", "pipeline"),
                                        ("Low_Latency", "low_latency"), ("best_effort", "best_effort")])
def test_mode(text, mode):
    assert PipelineOptions(mode=text).mode == mode
    with pytest.raises(ValueError):
        PipelineOptions(mode="invalid")


def test_span_relations():
    assert PipelineOptions().message_spans == "child"
    assert PipelineOptions().timer_spans == "follows_from"
    with pytest.raises(ValueError):
        PipelineOptions(message_spans="sibling")


def test_defaults():
    o = PipelineOptions()
    assert (o.max_concurrency, o.max_uncommitted, o.max_retries, o.idempotence_ttl) == (32, 64, 3, 604_800.0)
    assert o.handler_timeout == 240.0
    assert PipelineOptions(stall_threshold=60).handler_timeout == 48.0
    assert PipelineOptions(timeout=30, stall_threshold=60).handler_timeout == 30.0


def test_origin_falls_back_to_the_group():
    assert PipelineOptions(group_id="g").origin == "g"
    assert PipelineOptions(group_id="g", source_system="s").origin == "s"


@pytest.mark.parametrize("ttl", [float("nan"), float("inf"), -1.0])
def test_unusable_ttl_is_ignored(ttl):
    assert PipelineOptions(idempotence_ttl=ttl).idempotence_ttl == 604_800.0


def test_to_dict_has_only_what_was_set():
    assert PipelineOptions().to_dict() == {}
    assert PipelineOptions(mode="pipeline", mock=None).to_dict() == {"mode": "pipeline"}
    assert PipelineOptions(mode="pipeline").replace(mode=None).to_dict() == {}


def test_environment(monkeypatch):
    monkeypatch.setenv("KEYLANE_ALLOWED_EVENTS", "user.,account.")
    monkeypatch.setenv("KEYLANE_STALL_THRESHOLD", "15s")
    monkeypatch.setenv("KEYLANE_RETRY_BASE", "100ms")
    monkeypatch.setenv("KEYLANE_MOCK", "true")
    o = PipelineOptions()
    assert (o.allowed_events, o.stall_threshold, o.retry_base, o.mock) == (("user.", "account."), 15.0, 0.1, True)
    assert PipelineOptions(stall_threshold=1).stall_threshold == 1.0


def test_unknown_option():
    with pytest.raises(TypeError):
        PipelineOptions(speed=1)
    with pytest.raises(AttributeError):
        PipelineOptions().speed


def test_pickles():
    o = PipelineOptions(mode="best_effort")
    assert pickle.loads(pickle.dumps(o)) == o
