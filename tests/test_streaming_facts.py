"""Facts fed by a stream of raw rows: late, tied and re-delivered rows over restarts and crashes."""
import json

import pytest

from cellscope.plans import publish
from cellscope.plans.load import load_date
from cellscope.sources import lake
from cellscope.streaming import facts


def land(spark, root, day, *calls):
    lines = [(json.dumps({"event_id": i, "event_type": "voice_call", "event_time_raw": t, "subscriber_id": "s", "cell_id": "C",
                          "cell_region": "R", "call_result": "completed", "__source_ts_ms": 1}), day, "00") for i, t in calls]
    lake.write_ndjson(spark.createDataFrame(lines, "value string, dt string, hr string").coalesce(1), root)


def ids(spark, path):
    df = publish.read_table(spark, path)
    return [] if df is None else sorted(r.event_id for r in df.collect())


def drain(spark, wh, ck, **more):
    facts.stream_facts(spark, wh, ck, **more).awaitTermination()


def test_late_tied_and_redelivered_rows_over_a_restart(spark, tmp_path):
    root, wh, ck = (str(tmp_path / x) for x in ("lake", "wh", "ck"))
    fact, late = facts.fact_paths(wh, "fct_voice_call")
    drain(spark, wh, ck)                                     # starts before the first load
    assert ids(spark, fact) == []
    land(spark, root, "2024-01-10", ("a", "2024-01-10T10:00:00"), ("b", "2024-01-10T12:00:00"))
    load_date(spark, root, wh, "2024-01-10")
    drain(spark, wh, ck)
    assert (ids(spark, fact), ids(spark, late)) == (["a", "b"], [])      # no watermark yet
    land(spark, root, "2024-01-11", ("tie", "2024-01-10T12:00:00"), ("late", "2024-01-10T11:59:59"), ("b", "2024-01-10T12:00:00"),
         ("new", "2024-01-11T00:00:00"), ("older", "2024-01-02T00:00:00"))
    load_date(spark, root, wh, "2024-01-11")
    drain(spark, wh, ck)
    assert (ids(spark, fact), ids(spark, late)) == (["a", "b", "new", "tie"], ["late", "older"])
    drain(spark, wh, ck)
    drain(spark, wh, str(tmp_path / "lost-checkpoint"))      # everything again: nothing changes
    assert (ids(spark, fact), ids(spark, late)) == (["a", "b", "new", "tie"], ["late", "older"])
    assert facts.merge_late(spark, wh, "fct_voice_call") == 2
    assert (ids(spark, fact), ids(spark, late)) == (["a", "b", "late", "new", "older", "tie"], [])
    assert facts.merge_late(spark, wh, "fct_voice_call") == 0 and facts.merge_late(spark, wh, "fct_data_session") == 0


def test_allowed_delay(spark, tmp_path):
    root, wh, ck = (str(tmp_path / x) for x in ("lake", "wh", "ck"))
    fact, late = facts.fact_paths(wh, "fct_voice_call")
    for day, call in (("2024-01-10", ("a", "2024-01-10T10:00:00")), ("2024-01-11", ("b", "2024-01-10T09:00:00")),
                      ("2024-01-12", ("c", "2024-01-10T08:59:59"))):
        land(spark, root, day, call)
        load_date(spark, root, wh, day)
        drain(spark, wh, ck, delay_seconds=3600)
    assert (ids(spark, fact), ids(spark, late)) == (["a", "b"], ["c"])


@pytest.mark.parametrize("step", [1, 2])
def test_batch_repeated_after_a_crash(spark, tmp_path, monkeypatch, step):
    root, wh, ck = (str(tmp_path / x) for x in ("lake", "wh", "ck"))
    fact, late = facts.fact_paths(wh, "fct_voice_call")
    land(spark, root, "2024-01-10", ("a", "2024-01-10T10:00:00"))
    load_date(spark, root, wh, "2024-01-10")
    drain(spark, wh, ck)
    land(spark, root, "2024-01-11", ("b", "2024-01-11T10:00:00"), ("late", "2024-01-10T09:00:00"))
    load_date(spark, root, wh, "2024-01-11")
    calls, add = [], publish.add
    with monkeypatch.context() as m:
        def killed(*args):
            calls.append(args)
            if len(calls) == step:
                raise RuntimeError("killed")
            add(*args)
        m.setattr(publish, "add", killed)
        with pytest.raises(Exception, match="killed"):
            drain(spark, wh, ck)
    drain(spark, wh, ck)
    assert (ids(spark, fact), ids(spark, late)) == (["a", "b"], ["late"])


def test_commands(spark, tmp_path, capsys):
    from cellscope.__main__ import main

    root, wh = str(tmp_path / "lake"), str(tmp_path / "wh")
    for day, call in (("2024-01-10", ("a", "2024-01-10T10:00:00")), ("2024-01-11", ("b", "2024-01-10T09:00:00"))):
        land(spark, root, day, call)
        load_date(spark, root, wh, day)
        assert main(["stream-facts", "--warehouse", wh, "--checkpoint", str(tmp_path / "ck"), "--delay", "60"]) == 0
    assert main(["merge-late", "--warehouse", wh, "--fact", "fct_voice_call"]) == 0
    assert '"rows_added": 1' in capsys.readouterr().out
    assert ids(spark, facts.fact_paths(wh, "fct_voice_call")[0]) == ["a", "b"]
