import random

import duckdb
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from millrace.model import MAX_TS
from millrace.operators import diagnostics, frontier, ranges
from millrace.operators.sweep import cuts_of, prefix_max, running_max, running_max_by, stabbed
from millrace.plans import queries
from millrace.plans.oracles import ORACLES
from millrace.plans.queries import QUERIES
from millrace.sources import derived
from millrace.streaming.frontier import StandstillListener, stream_frontier

STEPS = [("d", "e", 100, "a5 d100 eMax"), ("g", "h", 200, "a5 d100 eMax g200 hMax"), ("a", "d", 1, "a1 d100 eMax g200 hMax"), ("a", "d", 2, "a2 d100 eMax g200 hMax"),
         ("a", "d", 1, "a1 d100 eMax g200 hMax"), ("b", "c", 3, "a1 b3 c1 d100 eMax g200 hMax"), ("b", "c", 4, "a1 b4 c1 d100 eMax g200 hMax"),
         ("a", "d", 3, "a3 d100 eMax g200 hMax"), ("a", "b", 5, "a5 b3 d100 eMax g200 hMax"), ("c", "d", 5, "a5 b3 c5 d100 eMax g200 hMax"),
         ("b", "c", 5, "a5 b5 c5 d100 eMax g200 hMax"), ("a", "d", 6, "a6 d100 eMax g200 hMax"), ("a", "c", 7, "a7 c6 d100 eMax g200 hMax"),
         ("b", "d", 8, "a7 b8 d100 eMax g200 hMax"), ("a", "b", 8, "a8 b8 d100 eMax g200 hMax"), ("1", "g", 9, "19 g200 hMax"), ("g", "i", 10, "19 g10 iMax")]


def segments(spark, rows):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "seq long, start_key string, end_key string, ts long")
    found = sorted(tuple(r) for r in frontier.segments(df).collect())
    return " ".join(f"{k}{'Max' if t == MAX_TS else t}" for k, t in found), min(t for _, t in found)


@pytest.mark.parametrize("n", [1, 3, 6, 9, 12, 14, 16, 17])
def test_assignments_in_order(spark, n):
    text, low = segments(spark, [("a", "d", 5)] + [s[:3] for s in STEPS[:n]])
    assert text == STEPS[n - 1][3]
    assert low == min(MAX_TS if x.endswith("Max") else int(x[1:]) for x in text.split())


def test_fall_back_and_advance(spark):
    first = [("a", "b", 20), ("b", "c", 20), ("c", "d", 10), ("d", "e", 20)]
    assert segments(spark, first) == ("a20 b20 c10 d20 eMax", 10)
    assert segments(spark, first + [("c", "d", 20)]) == ("a20 b20 c20 d20 eMax", 20)
    assert segments(spark, [("", "~", 0), ("a", "b", 10)])[1] == 0
    assert segments(spark, [("", "~", 0), ("", "~", 1), ("", "m", 2), ("m", "~", 2)])[1] == 2


def test_printed(spark):
    df = spark.createDataFrame([(0, "a", "d", 5)], "seq long, start_key string, end_key string, ts long")
    assert frontier.printed(frontier.segments(df)).first()[0] == "[a @ 5] [d @ Max] "


def test_accept_resolved(spark):
    regions = spark.createDataFrame([(1, True, False, 9), (2, True, False, 11), (3, False, False, 8)], "region_id long, initialized boolean, stopped boolean, last_ts long")
    messages = spark.createDataFrame([(i, 10) for i in (1, 2, 3)], "region_id long, resolved_ts long")
    found = {r.region_id: (r.resolved_ts, r.accepted) for r in frontier.accept_resolved(messages, regions).collect()}
    assert found == {1: (10, True), 2: (11, False), 3: (8, False)}


def test_range_comparison(spark):
    rows = [(None, None, 0, 0), (None, "", -1, 1), ("1", "2", -1, -1), ("2", "1", 1, 1)]
    df = spark.createDataFrame(rows, "a string, b string, s int, e int")
    for r in df.select("s", "e", ranges.compare_starts(df.a, df.b).alias("x"), ranges.compare_ends(df.a, df.b).alias("y")).collect():
        assert (r.x, r.y) == (r.s, r.e)


def test_division_meets_open_ends(spark):
    schema = "region_id long, start_key string, end_key string"
    regions = spark.createDataFrame([(1, None, "f"), (2, "f", "p"), (3, "p", "")], schema)
    spans = spark.createDataFrame([(9, "c", "p")], "span_id long, start_key string, end_key string")
    assert sorted((r.region_id, r.start_key, r.end_key) for r in ranges.divide(spans, regions).collect()) == [(1, "c", "f"), (2, "f", "p")]
    with pytest.raises(Exception, match="start before its end"):
        ranges.contained(spark.createDataFrame([(1, "c", "b")], "span_id long, start_key string, end_key string"), regions).collect()


def test_stream_equals_batch(spark, tmp_path):
    sf = "/root/testdata/sf0.01"
    rows = derived.resolved_log(spark, sf)
    rows.coalesce(1).write.parquet(str(tmp_path / "in"))
    n = derived.key_regions(spark, sf).count()
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    query = stream_frontier(stream, n).writeStream.format("memory").queryName("front").option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    query.awaitTermination()
    got = sorted(tuple(r) for r in spark.table("front").collect())
    assert got == sorted((r.tick, r.resolved_ts) for r in frontier.advances(frontier.region_frontier(rows)).collect())


@pytest.mark.parametrize("name", ["frontier_segments", "slowest_range"])
def test_whole_log_equals_unbounded_sql(spark, name):
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"create view events as select * from '{sf}/events.parquet'")
    assert "tick < 6" not in ORACLES[name]
    # The same without reducing the forwards to the last one of each range.
    plain = ORACLES[name].replace("from lasts", "from forwards").replace("join lasts f", "join forwards f")
    want = con.execute(plain).fetchall()
    assert plain != ORACLES[name] and sorted(want) == sorted(con.execute(ORACLES[name]).fetchall())
    assert sorted(map(tuple, QUERIES[name](spark, sf).collect())) == sorted(want)


def test_repeated_changes_keep_their_number(spark):
    changes = spark.createDataFrame([(n, "k") for n in (1, 5, 5, 9, 12, 12, 12)], "emit_seq long, key string")
    series = spark.createDataFrame([(4, 40), (9, 90)], "from_seq long, resolved_ts long")
    found = frontier.with_frontier(changes, series).collect()
    assert sorted(map(tuple, found)) == [(1, "k", -1), *[(5, "k", 40)] * 2, (9, "k", 90), *[(12, "k", 90)] * 3]


def test_standstill_is_reported():
    now, told = [0.0], []
    listener = StandstillListener(lambda name, s: told.append((name, s)), 60, lambda: now[0])
    for t, rows in ((0, 5), (50, 0), (61, 0), (62, 3), (100, 0)):
        now[0] = float(t)
        listener.observe("q", "feed", rows)
    assert told == [("feed", 61.0)]


def test_silent_regions_hold_the_frontier(spark):
    rows = [(1, 1, 10), (1, 2, 5), (2, 1, 20), (3, 1, 30), (3, 2, 6)]
    log = spark.createDataFrame(rows, "tick long, region_id long, resolved_ts long")
    found = frontier.region_frontier(log)
    assert sorted(map(tuple, found.collect())) == [(1, 5), (2, 5), (3, 6)]
    assert sorted(map(tuple, frontier.advances(found).collect())) == [(1, 5, None), (3, 6, 2)]


@pytest.mark.parametrize("seed", [1, 2])
def test_sparse_frontier_equals_a_plain_minimum(spark, seed):
    """Silent and late regions, falls, ties, gaps between ticks."""
    rng = random.Random(seed)
    ticks, regions = sorted(rng.sample(range(200_000), 60)), range(7)
    rows = [(t, r, 5 * i + rng.randrange(-40, 5)) for i, t in enumerate(ticks) for r in regions if rng.random() < (0.1 if r == 3 else 0.5) and not (r == 5 and i < 10)]
    want, last = [], {}
    for t in sorted({t for t, _, _ in rows}):
        for _, r, ts in (x for x in rows if x[0] == t):
            last[r] = max(ts, last.get(r, ts))
        if len(last) == len(regions):
            want.append((t, min(last.values())))
    found = frontier.region_frontier(spark.createDataFrame(rows, "tick long, region_id long, resolved_ts long"))
    assert sorted(map(tuple, found.collect())) == want
    rises = [(t, f) for i, (t, f) in enumerate(want) if f > 0 and (i == 0 or f > want[i - 1][1])]
    assert sorted((r.tick, r.resolved_ts, r.ticks_since) for r in frontier.advances(found).collect()) == [(t, f, t - rises[i - 1][0] if i else None) for i, (t, f) in enumerate(rises)]


def plain_map(rows):
    """The interval map by assignment, one forward after the other."""
    found = {}
    for start, end, ts in rows:
        below = [k for k in found if k <= end]
        kept = found[max(below)] if below else MAX_TS
        found = {k: v for k, v in found.items() if not start < k < end}
        found.setdefault(end, kept)
        found[start] = ts
    return sorted(found.items())


@pytest.mark.parametrize("blocks", [1, 4, 40])
def test_random_interval_maps(spark, blocks, monkeypatch):
    monkeypatch.setattr(frontier, "cuts_of", lambda keys: cuts_of(keys, blocks))
    rng = random.Random(blocks)
    keys = [f"{i:02}" for i in range(30)]
    rows = [("00", "29", 0)] + [(*sorted(rng.sample(keys, 2)), rng.randrange(100)) for _ in range(60)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "seq long, start_key string, end_key string, ts long")
    assert sorted(map(tuple, frontier.segments(df).collect())) == plain_map(rows)


@pytest.mark.parametrize("blocks", [1, 5])
def test_range_joins_equal_nested_loops(spark, blocks, monkeypatch):
    """Points, overlapping spans and open ends against regions with gaps."""
    monkeypatch.setattr(ranges, "cuts_of", lambda keys: cuts_of(keys, blocks))
    rng = random.Random(blocks)
    bounds = sorted(f"{i:03}" for i in rng.sample(range(1000), 41))
    regions = [(i, a if i else None, b) for i, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False)) if i % 7 != 3] + [(99, bounds[-1], "")]
    holds = lambda s, e, k: (s is None or s <= k) and (not e or k < e)
    points = [(i, f"{rng.randrange(1000):03}") for i in range(300)] + [(900, "500")] * 50 + [(1, ""), (2, None)]
    r = spark.createDataFrame(regions, "region_id long, start_key string, end_key string")
    found = ranges.locate(spark.createDataFrame(points, "n long, key string"), "key", r).collect()
    assert sorted(map(tuple, found)) == sorted((n, k, i) for n, k in points if k is not None for i, s, e in regions if holds(s, e, k))
    spans = [(i, *sorted(f"{x:03}" for x in rng.sample(range(1000), 2))) for i in range(40)] + [(50, None, "300"), (51, "300", None), (52, "", ""), (53, bounds[0], bounds[1]), (54, bounds[5], bounds[6])]
    cut = ranges.divide(spark.createDataFrame(spans, "span_id long, start_key string, end_key string"), r).collect()
    top = lambda e: e or "~"
    want = [(i, n, max(s or "", a or ""), min(top(e), top(b))) for i, s, e in spans for n, a, b in regions if max(s or "", a or "") < min(top(e), top(b))]
    assert sorted((c.span_id, c.region_id, c.start_key or "", top(c.end_key)) for c in cut) == sorted(want)
    parents = [(i, *sorted(f"{x:03}" for x in rng.sample(range(1000), 2))) for i in range(12)] + [(20, None, "050"), (21, "970", None)]
    kept = ranges.contained(spark.createDataFrame(spans, "span_id long, start_key string, end_key string"), spark.createDataFrame(parents, "p long, start_key string, end_key string")).collect()
    inside = lambda s, e: any((a or "") <= (s or "") and (not b or (e and e <= b)) for _, a, b in parents)
    assert sorted(k.span_id for k in kept) == sorted(i for i, s, e in spans if inside(s, e))


@pytest.mark.parametrize("width", [1, 7, 1 << 16])
def test_running_and_prefix_maxima(spark, width):
    rng = random.Random(width)
    points, marks = [(rng.randrange(400), i) for i in range(200)] + [(5, 1)] * 20, [(rng.randrange(50, 350), rng.randrange(1000)) for _ in range(30)]
    m = spark.createDataFrame(marks, "at long, v long")
    got = running_max(spark.createDataFrame(points, "p long, i long"), "p", m, "at", m.v, "top", width, 3).collect()
    assert sorted(map(str, got)) == sorted(str(Row(p=p, i=i, top=max((v for at, v in marks if at <= p), default=None))) for p, i in points)
    got = prefix_max(m, "at", m.v, "top", width).collect()
    assert sorted(map(str, got)) == sorted(str(Row(at=a, v=v, top=max((w for b, w in marks if b < a), default=None))) for a, v in marks)


@pytest.mark.parametrize("width", [1, 9, 1 << 16])
def test_running_maxima_of_a_hot_group(spark, width):
    rng = random.Random(width)
    rows = [(rng.choice([1, 1, 1, 2, None]), rng.randrange(200), rng.randrange(1000)) for _ in range(150)]
    df = spark.createDataFrame(rows, "region_id long, seq long, v long")
    got = running_max_by(df.where("region_id is not null"), "region_id", ["seq", "v"], df.v, "top", width).collect()
    assert sorted(map(tuple, got)) == sorted((r, s, v, max(w for q, t, w in rows if q == r and (t, w) <= (s, v))) for r, s, v in rows if r is not None)


PLANS = ["region_assign", "region_division", "range_contains", "restart_min_ts", "region_recovery", "frontier_segments", "slowest_range", "late_filter_asof", "commit_ts_violations", "changelog_ordered"]


@pytest.mark.parametrize("name", PLANS)
def test_plans_have_no_nested_loop(spark, name):
    plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    if name == "changelog_ordered":
        assert plan.count("Exchange hashpartitioning") <= 8


def test_messages_are_reduced_before_they_get_their_keys(spark):
    """The interval map joins a row a region, not a row a message, whose number Spark can't tell."""
    sf = "/root/testdata/sf0.01"
    assert queries.forwards(spark, sf).count() == derived.key_regions(spark, sf).count() + 1


def test_restart_keeps_regions_without_a_timestamp(spark):
    """Regions that have sent nothing yet are restarted with the others, and aren't the first known timestamp."""
    errors = spark.createDataFrame([(1, 9), (4, 6)], "error_id long, resolved_ts long")
    divided = spark.createDataFrame([(1, 1, None), (1, 2, 7), (1, 3, 5), (4, 4, None)], "error_id long, region_id long, resolved_ts long")
    assert sorted(map(tuple, ranges.restart_ts(errors, divided).collect())) == [(1, 1, 7), (1, 2, 7), (1, 3, 7), (4, 4, 6)]


def test_restart_equals_sql_where_a_region_is_silent(spark, tmp_path):
    """Region 83 sends nothing up to tick 2."""
    events = spark.range(2000).selectExpr("id as event_id", "id as user_id", "'view' as event_type", "1.0d as value")
    events.write.parquet(str(tmp_path / "events.parquet"))
    con = duckdb.connect()
    con.execute(f"create view events as select * from '{tmp_path}/events.parquet/*.parquet'")
    found = [(r.error_id, r.region_id, r.restart_ts) for r in QUERIES["restart_min_ts"](spark, str(tmp_path)).collect()]
    assert sorted(found) == sorted(con.execute(ORACLES["restart_min_ts"]).fetchall())
    assert any(r == 83 for _, r, _ in found)


def test_messages_are_made_where_their_region_lies(spark):
    """Windows by region need no shuffle of the messages, which aren't dealt to one task either."""
    rows = derived.resolved_log(spark, "/root/testdata/sf0.001")
    assert rows.rdd.getNumPartitions() >= 2 * spark.sparkContext.defaultParallelism
    for name in ("penalty_streak", "penalty_by_event_time"):
        plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        above = plan[: plan.index("Generate explode")]
        assert "Window" in above and "Exchange" not in above and above.count("Sort [") == 1


def test_equal_intervals_are_cut_once(spark):
    points = spark.createDataFrame([(i,) for i in range(8)], "at long")
    rows = spark.createDataFrame([(1, 3, v) for v in (5, 4, 9)] + [(3, 6, 2), (5, 4, 0)], "low long, high long, value long")
    found = stabbed(points, "at", rows, F.min)
    assert sorted(map(tuple, found.collect())) == [(1, 4), (2, 4), (3, 2), (4, 2), (5, 2), (6, 2)]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate [low" in plan[plan.index("Generate explode") :]


@pytest.mark.parametrize("seed", [1, 2])
def test_penalties_equal_a_plain_loop(spark, seed):
    rng = random.Random(seed)
    rows = [(r, t, 5 * t + rng.randrange(-30, 5) if rng.random() < 0.95 else None, rng.randrange(100) if rng.random() < 0.9 else None) for r in range(3) for t in range(80)]
    streaks, counted = [], []
    for r in range(3):
        top = last = None
        streak = penalty = 0
        for i, (_, t, ts, at) in enumerate(x for x in rows if x[0] == r):
            rise = top is None or (ts is not None and ts > top)
            streak = 0 if rise or i == 0 else streak + 1
            if rise:
                penalty, last = 0, at
            elif at is not None and last is not None and at > last:
                penalty += 1
            if not rise and at is not None:
                last = max(at, at if last is None else last)
            top = ts if top is None else max(top, top if ts is None else ts)
            streaks.append((r, t, streak))
            counted.append((r, t, penalty))
    df = spark.createDataFrame(rows, "region_id long, seq long, resolved_ts long, event_time long")
    assert sorted((r.region_id, r.seq, r.penalty) for r in diagnostics.penalties(df).collect()) == counted
    got = diagnostics.penalty_streaks(df.withColumnRenamed("seq", "tick")).collect()
    assert sorted((r.region_id, r.tick, r.penalty) for r in got) == streaks


def test_fan_out_covers_every_region_at_every_tick(spark):
    sf = "/root/testdata/sf0.01"
    found = {(r.tick, r.region_id) for r in QUERIES["resolved_fan_out"](spark, sf).collect()}
    assert found == {(t, r.region_id) for t in range(20) for r in derived.key_regions(spark, sf).collect()} and len(found) == 160


def test_the_frontier_reads_as_many_messages_as_ticks_ask_for(spark, tmp_path):
    """Of 1,500 regions and 8 ticks, 396 regions and those below zero can hold the frontier, and it is that of all."""
    events = spark.range(4000).selectExpr("id as event_id", "(id * 7 % 1500 - 20) * 20 as user_id", "'view' as event_type", "1.0d as value")
    events.write.parquet(str(tmp_path / "events.parquet"))
    lowest, all_ = derived.lowest_log(spark, str(tmp_path)), derived.resolved_log(spark, str(tmp_path))
    assert lowest.count() < 8 * (396 + 20) and all_.count() > 10_000
    want = sorted(map(tuple, frontier.region_frontier(all_).collect()))
    assert sorted(map(tuple, QUERIES["region_frontier"](spark, str(tmp_path)).collect())) == want and len(want) > 3
    for name in ("region_frontier", "frontier_advances", "stuck_gaps", "late_filter_asof", "commit_ts_violations"):
        con = duckdb.connect()
        con.execute(f"create view events as select * from '{tmp_path}/events.parquet/*.parquet'")
        assert sorted(map(str, map(tuple, QUERIES[name](spark, str(tmp_path)).collect()))) == sorted(map(str, con.execute(ORACLES[name]).fetchall()))


def test_totals_are_looked_up_once_a_block(spark):
    """Copied into each row, they made the work grow with the square of the order."""
    points = spark.range(0, 40_000).withColumnRenamed("id", "p")
    marks = spark.range(0, 40_000, 10).withColumnRenamed("id", "at")
    found = running_max(points, "p", marks, "at", marks.at, "top", 1, 1)
    assert found.where("top <> p - p % 10").isEmpty() and found.count() == 40_000
    plan = running_max(points, "p", marks, "at", marks.at, "top")._jdf.queryExecution().optimizedPlan().toString()
    assert "CASE WHEN _asking" in plan
