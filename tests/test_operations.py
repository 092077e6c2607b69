"""Alarms, health, membership and logs: hand cases, and hot keys against plain windows."""

import datetime as dt
import random

import pytest

from tesselar.operators.alarms import (
    AlarmRule,
    breach_counters,
    last_n_avg,
    metric_period_stats,
    threshold_label,
    tumbling_alarm,
)
from tesselar.operators.health import evict_first_failure, health_state
from tesselar.operators.livelist import live_member_list, live_members
from tesselar.operators.loadlog import first_reach, last_minute_rps, log_id_extract, text_contains_flag
from tesselar.operators.membership import (
    active_members,
    member_ip_check,
    member_list,
    member_names,
    round_robin_assign,
)

PLAIN = 10_000_000
SMALL = 12


def at(seconds):
    return dt.datetime(2024, 1, 1) + dt.timedelta(seconds=seconds)


def stats_of(spark, values, dim="a"):
    rows = [(dim, at(n * 5), value) for n, value in enumerate(values)]
    return spark.createDataFrame(rows, "dim STRING, t TIMESTAMP, average DOUBLE")


def column(df, name, *order):
    return [row[name] for row in df.orderBy(*order).collect()]


def test_period_stats_and_short_histories(spark):
    metrics = spark.createDataFrame(
        [(at(0), "a", 1.0), (at(4), "a", 3.0), (at(12), "a", 8.0)], "ts TIMESTAMP, dim STRING, value DOUBLE"
    )
    stats = metric_period_stats(metrics, 5)
    assert column(stats, "average", "t") == [2.0, 8.0]
    assert column(stats, "duration", "t") == [4.0, 0.0]
    assert column(last_n_avg(stats), "last_avg", "t") == [2.0, 5.0]


@pytest.mark.parametrize("rows_per_chunk", [3, PLAIN])
def test_last_three(spark, rows_per_chunk):
    averages = column(last_n_avg(stats_of(spark, [3.0, 6.0, 9.0, 12.0]), 3, rows_per_chunk), "last_avg", "t")
    assert averages == [3.0, 4.5, 6.0, 9.0]


def test_labels_at_the_limits(spark):
    values = [50.0, 49.9, 30.0, 30.1, float("nan"), None]
    labelled = threshold_label(stats_of(spark, values), 50, 30, "average")
    assert column(labelled, "label", "t") == ["up", "neutral", "down", "neutral", "neutral", "neutral"]


@pytest.mark.parametrize("rows_per_chunk", [2, 3, PLAIN])
def test_counters(spark, rows_per_chunk):
    values = [60.0, 60.0, 10.0, 60.0, 40.0, 10.0, 60.0]
    labelled = threshold_label(stats_of(spark, values), 50, 30, "average")
    counted = breach_counters(labelled, rows_per_chunk)
    assert column(counted, "up", "t") == [1, 2, 2, 3, 0, 0, 1]
    assert column(counted, "down", "t") == [0, 0, 1, 1, 0, 1, 1]


def test_alarm_is_strict_and_ignores_nan(spark):
    rules = (AlarmRule("high", ">", 65.0, 180, 1), AlarmRule("low", "<", 25.0, 240, -1))
    rows = [(at(0), "a", 65.0), (at(180), "a", 65.5), (at(400), "b", 25.0), (at(500), "b", 24.0)]
    rows += [(at(800), "c", float("nan"))]
    metrics = spark.createDataFrame(rows, "ts TIMESTAMP, dim STRING, value DOUBLE")
    found = tumbling_alarm(metrics, rules).orderBy("rule", "t").collect()
    assert [(row["rule"], row["dim"], row["t"]) for row in found] == [
        ("high", "a", at(180)), ("low", "b", at(480)),
    ]


def random_probes(n, seed=1):
    rng = random.Random(seed)
    rows = []
    for seq in range(n):
        instance = 0 if rng.random() < 0.6 else rng.randint(1, 9)
        rows.append((at(seq), seq, instance, rng.choice([200, 200, 500, None])))
    return rows


def health_by_hand(rows, up, down):
    run, state, result = {}, {}, []
    for ts, seq, instance, status in rows:
        ok = status == 200
        last, length = run.get(instance, (None, 0))
        length = length + 1 if last == ok else 1
        run[instance] = (ok, length)
        if ok and length >= up:
            state[instance] = "healthy"
        elif not ok and length >= down:
            state[instance] = "unhealthy"
        result.append(state.get(instance, "unknown"))
    return result


PROBE_SCHEMA = "ts TIMESTAMP, seq LONG, instance LONG, status INT"


@pytest.mark.parametrize("rows_per_chunk", [SMALL, 100, PLAIN])
@pytest.mark.parametrize("up, down", [(3, 5), (2, 2), (1, 1)])
def test_health(spark, rows_per_chunk, up, down):
    rows = random_probes(500)
    states = health_state(spark.createDataFrame(rows, PROBE_SCHEMA), up, down, rows_per_chunk)
    assert column(states, "state", "seq") == health_by_hand(rows, up, down)


@pytest.mark.parametrize("rows_per_chunk", [SMALL, PLAIN])
def test_eviction(spark, rows_per_chunk):
    rows = random_probes(400, seed=2)
    rng = random.Random(7)
    adds = [(at(s), rng.choice([0, 0, 1, 2])) for s in sorted(rng.sample(range(400), 60))]
    expected = {}
    for ts, instance in adds:
        number = 1 + sum(1 for key in expected if key[0] == instance)
        failures = [t for t, _, i, s in rows if i == instance and s != 200 and t >= ts]
        expected[instance, number] = (ts, min(failures, default=None))
    found = evict_first_failure(
        spark.createDataFrame(rows, PROBE_SCHEMA),
        spark.createDataFrame(adds, "ts TIMESTAMP, instance LONG"),
        rows_per_chunk,
    ).collect()
    assert {(r["instance"], r["episode"]): (r["added_at"], r["evicted_at"]) for r in found} == expected


def random_members(n, seed=3):
    rng = random.Random(seed)
    rows = []
    for seq in range(n):
        ip = "10.0.0.1" if rng.random() < 0.5 else f"10.0.0.{rng.randint(2, 6)}"
        rows.append((seq, 0 if rng.random() < 0.8 else 1, rng.choice(["add", "remove"]), ip))
    return rows


def members_by_hand(rows):
    lists = {}
    for seq, balancer, op, ip in rows:
        members = lists.setdefault(balancer, [])
        if op == "add":
            members.append((seq, ip))
        else:
            match = [member for member in members if member[1] == ip][:1]
            if match:
                members.remove(match[0])
    return lists


MEMBER_SCHEMA = "seq LONG, balancer LONG, op STRING, ip STRING"


@pytest.mark.parametrize("rows_per_chunk", [SMALL, 60, PLAIN])
def test_membership(spark, rows_per_chunk):
    rows = random_members(500)
    df = spark.createDataFrame(rows, MEMBER_SCHEMA)
    lists = members_by_hand(rows)
    active = active_members(df, rows_per_chunk)
    assert sorted((r["balancer"], r["seq"], r["ip"]) for r in active.collect()) == sorted(
        (balancer, seq, ip) for balancer, members in lists.items() for seq, ip in members
    )
    texts = {r["balancer"]: r["members"] for r in member_list(active, 2).collect()}
    assert texts == {
        balancer: ",".join(f"http://{ip}" for _, ip in members) + "\n"
        for balancer, members in lists.items()
        if members
    }
    asked = spark.createDataFrame([(0,), (1,), (7,), (None,)], "balancer LONG")
    answers = {r["balancer"]: r["members"] for r in member_list(active, 2, asked).collect()}
    assert answers == {0: "\n", 1: "\n", 7: "\n", None: "\n"} | texts
    names = member_names(df, rows_per_chunk).orderBy("balancer", "seq").collect()
    adds = {b: [seq for seq, balancer, op, _ in rows if balancer == b and op == "add"] for b in (0, 1)}
    assert [(r["balancer"], r["seq"], r["name"]) for r in names] == [
        (b, seq, f"DC-{n}") for b in (0, 1) for n, seq in enumerate(adds[b])
    ]


def test_remove_before_add_and_duplicate_adds(spark):
    ops = [("remove", "a"), ("add", "a"), ("add", "b"), ("add", "b"), ("remove", "b"), ("remove", "c")]
    df = spark.createDataFrame([(n, 0, op, ip) for n, (op, ip) in enumerate(ops)], MEMBER_SCHEMA)
    assert sorted((r["seq"], r["ip"]) for r in active_members(df).collect()) == [(1, "a"), (3, "b")]


@pytest.mark.parametrize("rows_per_chunk", [20, PLAIN])
def test_round_robin(spark, rows_per_chunk):
    rng = random.Random(4)
    asked = [(seq, rng.choice([0, 0, 0, 1, 2])) for seq in range(200)]
    members = [(5, 0, "x"), (2, 0, "y"), (9, 0, "z"), (1, 1, "v")]
    found = round_robin_assign(
        spark.createDataFrame(asked, "seq LONG, balancer LONG"),
        spark.createDataFrame(members, "seq LONG, balancer LONG, ip STRING"),
        rows_per_chunk,
    ).collect()
    order = {0: ["y", "x", "z"], 1: ["v"]}
    expected, taken = {}, {}
    for seq, balancer in asked:
        if balancer in order:
            k = taken[balancer] = taken.get(balancer, -1) + 1
            expected[seq] = order[balancer][k % len(order[balancer])]
    assert {row["seq"]: row["ip"] for row in found} == expected
    assert len(found) == len(expected)


def test_addresses(spark):
    good = ["1.2.3.4", "255.255.255.255", "::", "::1", "2001:db8::8:800:200c:417A", "1:2:3:4:5:6:7:8"]
    good += ["::ffff:10.0.0.1", "1:2:3:4:5:6:7::", "::2:3:4:5:6:7:8", "1:2:3:4:5:6:1.2.3.4"]
    bad = ["999.1.1.1", "1.2.3", "01.2.3.4", "host", "", "1::2::3", "1:2:3:4:5:6:7:8:9", "12345::", ":1"]
    bad += ["1.2.3.4\n", "::1\n", "fe80::1%eth0", "1:2:3:4:5:6:7:8::", "::1.2.3.256", "1.2.3.4::", ":::", "1:2:3:4:5:6:7:1.2.3.4"]
    df = spark.createDataFrame([(ip,) for ip in [*good, *bad, None]], "ip STRING")
    found = {row["ip"]: row["status"] for row in member_ip_check(df).collect()}
    assert found == {**{ip: 200 for ip in good}, **{ip: 400 for ip in bad}, None: 400}


@pytest.mark.parametrize("rows_per_task", [2, PLAIN])
def test_last_minute(spark, rows_per_task):
    logs = {
        "none": ["ec2-a=1.5", "ec2-b=2.5"],
        "two": ["[Minute 1]", "ec2-a=9", "", "[Minute 2]", "ec2-a=1", "other=4", "ec2-b=2"],
        "empty": ["[Minute 1]", "ec2-a=1", "[Minute 2]"],
        "blank": ["", ""],
    }
    rows = [(run, seq, line) for run, lines in logs.items() for seq, line in enumerate(lines)]
    df = spark.createDataFrame(rows, "run_id STRING, seq LONG, line STRING")
    found = {row["run_id"]: row["rps"] for row in last_minute_rps(df, rows_per_task).collect()}
    assert found == {"none": 4.0, "two": 3.0, "empty": 0.0, "blank": 0.0}


def test_responses_and_steps(spark):
    df = spark.createDataFrame(
        [(1, "see test.12.log and test.3.log, return to the homepage"), (2, "test.x.log")],
        "id LONG, text STRING",
    )
    assert column(log_id_extract(df), "log_name", "id") == ["test.12.log", ""]
    assert column(text_contains_flag(df), "found", "id") == [True, False]
    steps = spark.createDataFrame(
        [("a", 0, 100.0), ("a", 1, 4000.0), ("a", 2, 5000.0), ("b", 0, 3999.9)],
        "run_id STRING, step INT, load DOUBLE",
    )
    assert [tuple(row) for row in first_reach(steps).collect()] == [("a", 1, 2)]


def live_by_hand(rows):
    """The list as the balancer keeps it: entries in add order, and what became of each."""
    lists, told, names = {}, {}, {}
    for balancer, seq, op, ip, status in rows:
        members = lists.setdefault(balancer, [])
        if ip.startswith("host"):
            continue
        if op == "add":
            names[balancer] = names.get(balancer, -1) + 1
            told[balancer, seq] = [ip, f"DC-{names[balancer]}", None, None]
            members.append(seq)
        elif op == "remove":
            for entry in members:
                if told[balancer, entry][0] == ip:
                    told[balancer, entry][2:] = [seq, "removed"]
                    members.remove(entry)
                    break
        elif op == "probe" and status != 200:
            for entry in [m for m in members if told[balancer, m][0] == ip]:
                told[balancer, entry][2:] = [seq, "evicted"]
                members.remove(entry)
    return lists, told


LIVE_SCHEMA = "balancer LONG, seq LONG, op STRING, ip STRING, status INT"


@pytest.mark.parametrize("fail", [0.0, 0.02, 0.2])
@pytest.mark.parametrize("rows_per_chunk", [7, 60, PLAIN])
def test_live_members(spark, rows_per_chunk, fail):
    rng = random.Random(5)
    rows = []
    for seq in range(600):
        ip = "10.0.0.1" if rng.random() < 0.6 else rng.choice(["10.0.0.2", "::1", "host-1"])
        op = "probe" if rng.random() < max(fail, 0.1) else rng.choice(["add", "add", "remove"] if seq % 200 < 120 else ["add", "remove", "remove"])
        status = rng.choice([500, None]) if rng.random() < (fail / 0.1 if fail < 0.1 else 1.0) else 200
        rows.append((0 if rng.random() < 0.8 else 1, seq, op, ip, status))
    rows.append((9, 600, "remove", "10.0.0.1", None))
    lists, told = live_by_hand(rows)
    df = spark.createDataFrame(rows, LIVE_SCHEMA).repartition(3)
    found = {(r["balancer"], r["seq"]): [r["ip"], r["name"], r["left_at"], r["reason"]] for r in live_members(df, rows_per_chunk).collect()}
    assert found == told
    answers = {r["balancer"]: r["members"] for r in live_member_list(df, rows_per_chunk).collect()}
    assert answers == {b: ",".join(f"http://{told[b, seq][0]}" for seq in members) + "\n" for b, members in lists.items()}


def test_live_members_of_nothing(spark):
    empty = spark.createDataFrame([], LIVE_SCHEMA)
    assert live_members(empty).collect() == [] and live_member_list(empty).collect() == []
    rejected = spark.createDataFrame([(1, 1, "add", "host-1", None), (1, 2, None, "::1", None), (1, 3, "add", None, None)], LIVE_SCHEMA)
    assert live_members(rejected).collect() == []
    assert [tuple(r) for r in live_member_list(rejected).collect()] == [(1, "\n")]
