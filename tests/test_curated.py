import datetime as dt
import random

from pyspark.sql import functions as F

from cellscope.operators import curated

VALID_SCHEMA = ("event_id string, event_type string, event_time timestamp, subscriber_id string, "
                "subscriber_msisdn_masked string, subscriber_plan string, subscriber_activation_date date, "
                "cell_id string, cell_region string, cell_radio_tech string, _loaded_at timestamp")
T0 = dt.datetime(2024, 1, 1)


def valid(spark, rows):
    full = []
    for r in rows:
        base = dict(event_type="voice_call", subscriber_msisdn_masked="+99450***0001",
                    subscriber_activation_date=dt.date(2020, 1, 1), cell_id="C1", cell_region="R1",
                    cell_radio_tech="4G", _loaded_at=T0)
        full.append({**base, **r})
    cols = [c.split()[0] for c in VALID_SCHEMA.split(", ")]
    return spark.createDataFrame([tuple(r.get(c) for c in cols) for r in full], VALID_SCHEMA)


def brute_force_scd2(events):
    """Row-by-row reference implementation of the plan history."""
    out = []
    by_sub = {}
    for e in events:
        by_sub.setdefault(e["subscriber_id"], []).append(e)
    for sub, evs in by_sub.items():
        evs.sort(key=lambda e: (e["event_time"], e["event_id"]))
        prev, version, groups = None, 0, {}
        first = True
        for e in evs:
            changed = (e["subscriber_plan"] != prev) if not first else (e["subscriber_plan"] is not None)
            version += 1 if changed else 0
            first = False
            prev = e["subscriber_plan"]
            g = groups.setdefault((e["subscriber_plan"], version), [])
            g.append(e)
        versions = sorted(((v, p, min(x["event_time"] for x in g)) for (p, v), g in groups.items()))
        for i, (v, p, start) in enumerate(versions):
            end = versions[i + 1][2] if i + 1 < len(versions) else None
            out.append((sub, p, start, end, end is None))
    return sorted(out, key=str)


def scd2_rows(df):
    return sorted(((r.subscriber_id, r.plan, r.valid_from, r.valid_to, r.is_current) for r in df.collect()), key=str)


def test_plan_history_a_a_b_a(spark):
    evs = [dict(event_id=str(i), subscriber_id="s", subscriber_plan=p, event_time=T0 + dt.timedelta(hours=i))
           for i, p in enumerate(["A", "A", "B", "A"])]
    got = scd2_rows(curated.dim_subscriber(valid(spark, evs)))
    assert [g[1] for g in got if True] and len(got) == 3
    assert got == brute_force_scd2(evs)


def test_first_plan_null_is_version_zero(spark):
    evs = [dict(event_id="1", subscriber_id="s", subscriber_plan=None, event_time=T0),
           dict(event_id="2", subscriber_id="s", subscriber_plan="A", event_time=T0 + dt.timedelta(hours=1))]
    got = scd2_rows(curated.dim_subscriber(valid(spark, evs)))
    assert got == brute_force_scd2(evs)
    assert [(g[1], g[4]) for g in sorted(got, key=lambda g: g[2])] == [(None, False), ("A", True)]


def test_same_time_ordered_by_event_id(spark):
    evs = [dict(event_id="b", subscriber_id="s", subscriber_plan="B", event_time=T0),
           dict(event_id="a", subscriber_id="s", subscriber_plan="A", event_time=T0)]
    got = scd2_rows(curated.dim_subscriber(valid(spark, evs)))
    assert got == brute_force_scd2(evs)
    assert len(got) == 2


def test_chunked_history_equals_brute_force(spark):
    """Random flip-flopping plans across many chunk borders (chunk = 1 minute here)."""
    rnd = random.Random(7)
    evs = []
    for i in range(600):
        evs.append(dict(event_id=f"{i:04d}", subscriber_id=f"s{rnd.randint(0, 3)}",
                        subscriber_plan=rnd.choice(["A", "A", "A", "B", None]),
                        event_time=T0 + dt.timedelta(seconds=rnd.randint(0, 3600))))
    got = scd2_rows(curated.dim_subscriber(valid(spark, evs), chunk_seconds=60))
    assert got == brute_force_scd2(evs)


def test_dim_cell_latest_with_tie_break(spark):
    evs = [dict(event_id="1", subscriber_id="s", subscriber_plan="A", event_time=T0, cell_region="OLD", _loaded_at=T0),
           dict(event_id="2", subscriber_id="s", subscriber_plan="A", event_time=T0 + dt.timedelta(1),
                cell_region="NEW", _loaded_at=T0),
           dict(event_id="3", subscriber_id="s", subscriber_plan="A", event_time=T0, cell_region="MID", _loaded_at=T0)]
    (row,) = curated.dim_cell_site(valid(spark, evs)).collect()
    assert row.cell_region == "NEW" and row.last_seen_at == T0


def test_plan_as_of_event(spark):
    evs = [dict(event_id=str(i), subscriber_id="s", subscriber_plan=p, event_time=T0 + dt.timedelta(days=i))
           for i, p in enumerate(["A", "B", "B", "A"])]
    v = valid(spark, evs)
    dim = curated.dim_subscriber(v)
    voice = v.select("event_id", "event_time", "subscriber_id", "cell_id", F.lit("completed").alias("call_result"))
    data = voice.select("event_id", "event_time", "subscriber_id", "cell_id",
                        F.lit(1.0).alias("latency_ms")).limit(0)
    got = {r.event_id: r.plan for r in curated.plan_as_of_event(voice, data, dim).collect()}
    assert got == {"0": "A", "1": "B", "2": "B", "3": "A"}


def test_hot_subscriber_split_equals_brute_force(spark):
    """One subscriber holds most events of one hour: its hour is cut into sub-slices."""
    rnd = random.Random(11)
    evs = []
    for i in range(800):
        sub = "hot" if i % 4 else f"s{i % 3}"
        evs.append(dict(event_id=f"{i:04d}", subscriber_id=sub,
                        subscriber_plan=rnd.choice(["A", "A", "B", None]),
                        event_time=T0 + dt.timedelta(seconds=rnd.randint(0, 3599))))
    got = scd2_rows(curated.dim_subscriber(valid(spark, evs), chunk_seconds=3600, max_rows_per_group=50))
    assert got == brute_force_scd2(evs)


def test_current_plans_equal_current_versions(spark):
    rnd = random.Random(3)
    evs = [dict(event_id=f"{i:04d}", subscriber_id=f"s{rnd.randint(0, 5)}", subscriber_plan=rnd.choice(["A", "B", None]),
                event_time=T0 + dt.timedelta(seconds=rnd.randint(0, 5000))) for i in range(300)]
    v = valid(spark, evs)
    full = curated.dim_subscriber(v).where("is_current").select("subscriber_id", "plan")
    got = curated.current_plans(v).select("subscriber_id", "plan")
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, full.collect()), key=str)


def test_history_without_hot_split_is_identical(spark):
    rnd = random.Random(5)
    evs = [dict(event_id=f"{i:04d}", subscriber_id=f"s{rnd.randint(0, 4)}", subscriber_plan=rnd.choice(["A", "B"]),
                event_time=T0 + dt.timedelta(seconds=rnd.randint(0, 9000))) for i in range(200)]
    v = valid(spark, evs)
    assert scd2_rows(curated.dim_subscriber(v, max_rows_per_group=None)) == brute_force_scd2(evs)


def versions_of(df):
    return sorted((tuple(r) for r in df.select(*curated._VERSION).collect()), key=str)


def random_events(rnd, n, hours, subs=4, start=0):
    return [dict(event_id=f"{start + i:05d}", subscriber_id=f"s{rnd.randint(0, subs - 1)}", subscriber_plan=rnd.choice(["A", "A", "A", "B", None]),
                 subscriber_msisdn_masked=f"+99450***{rnd.randint(0, 9999):04d}", event_time=T0 + dt.timedelta(seconds=rnd.randint(0, hours * 3600)))
            for i in range(n)]


def test_history_over_months_equals_brute_force(spark):
    """Slices of an hour, groups of 30 days and the history above them all take part."""
    rnd = random.Random(13)
    evs = random_events(rnd, 500, 24 * 200)
    for e in evs[:60]:      # bursts within one hour, so that inner runs are complete at the first level
        e["event_time"] = T0 + dt.timedelta(days=40, seconds=rnd.randint(0, 600))
    assert scd2_rows(curated.dim_subscriber(valid(spark, evs))) == brute_force_scd2(evs)


def test_incremental_history_equals_rebuild_with_late_and_repeated_events(spark):
    rnd = random.Random(17)
    evs = sorted(random_events(rnd, 360, 24 * 90), key=lambda e: e["event_time"])
    late = [evs.pop(rnd.randrange(50, 250)) for _ in range(25)]
    days = [evs[:150], evs[150:260] + late[:12], evs[260:] + late[12:], evs[300:] + late]      # the last: a re-run
    seen, state = [], curated.dim_subscriber(valid(spark, days[0]), keep_state=True)
    seen += days[0]
    for new in days[1:]:
        known = {e["event_id"] for e in seen}
        seen += [e for e in new if e["event_id"] not in known]
        state = curated.merge_dim_subscriber(state, valid(spark, seen), valid(spark, new))
        state = spark.createDataFrame(state.collect(), state.schema)
        assert versions_of(state) == versions_of(curated.dim_subscriber(valid(spark, seen)))
        assert scd2_rows(state) == brute_force_scd2(seen)


def test_incremental_history_reads_no_old_rows_unless_a_version_is_split(spark):
    day = dt.timedelta(days=1)
    ev = lambda i, plan, at: dict(event_id=str(i), subscriber_id="s", subscriber_plan=plan, event_time=T0 + at)
    old = [ev(1, "A", 0 * day), ev(2, "A", 4 * day), ev(3, "B", 9 * day)]
    state = curated.dim_subscriber(valid(spark, old), keep_state=True)
    state = spark.createDataFrame(state.collect(), state.schema)

    class Unread:
        def join(self, *a):
            raise AssertionError("read the history")

    for new in ([ev(4, "B", 10 * day)], [ev(4, "C", 10 * day)], [ev(4, "A", 2 * day)], [ev(4, "B", 6 * day)], [ev(4, "C", 6 * day)],
                [ev(0, "A", -1 * day)], [ev(0, "Z", -1 * day)], [ev(4, None, 9 * day)]):
        got = curated.merge_dim_subscriber(state, Unread(), valid(spark, new))
        assert scd2_rows(got) == brute_force_scd2(old + new)
    new = [ev(4, "B", 2 * day)]
    assert scd2_rows(curated.merge_dim_subscriber(state, valid(spark, old + new), valid(spark, new))) == brute_force_scd2(old + new)


def test_plan_as_of_event_equals_brute_force_for_a_hot_subscriber(spark):
    rnd = random.Random(23)
    evs = random_events(rnd, 500, 24 * 12, subs=3)
    for e in evs[:250]:
        e["subscriber_id"] = "hot"
    v = valid(spark, evs)
    dim = curated.dim_subscriber(valid(spark, evs[::3]))      # events before, at and between versions
    versions = scd2_rows(dim)
    voice = v.select("event_id", "event_time", "subscriber_id", "cell_id", F.lit("completed").alias("call_result"))
    data = voice.select("event_id", "event_time", "subscriber_id", "cell_id", F.lit(1.0).alias("latency_ms")).limit(0)
    got = {r.event_id: (r.plan, r.valid_from) for r in
           curated.plan_as_of_event(voice, data, dim, chunk_seconds=7200, max_rows_per_group=5).collect()}
    want = {}
    for e in evs:
        own = [(p, a) for s, p, a, b, _ in versions if s == e["subscriber_id"] and a <= e["event_time"] and (b is None or e["event_time"] < b)]
        want[e["event_id"]] = own[0] if own else (None, None)
    assert got == want
