"""Joins, rules, links and statistics whose keys may hold most rows: against brute force, with nulls, ties and repeats."""

import random
from collections import Counter, defaultdict
from itertools import chain
from statistics import stdev

import numpy as np
import pytest
from pyspark.sql import functions as F

from concordia.operators import codes, corrections, fusion, joins, linkage, stats, windows
from concordia.sources import merge


def bag(df):
    return Counter(map(tuple, df.collect()))


def spans(rng, n, keys, longest):
    out = []
    for i in range(n):
        a = rng.choice([None, *range(100)])
        b = None if a is None or rng.random() < 0.2 else a + rng.choice([-1, 0, 1, 2, 5, 9, 60, longest])
        out.append((rng.choice(keys), a, b, i % 40))
    return out


@pytest.mark.parametrize("kind", ["int", "double", "timestamp"])
def test_interval_join(spark, kind):
    rng = random.Random(1)
    keys = ["hot"] * 5 + ["a", None]
    points = [(rng.choice(keys), rng.choice([None, *range(-5, 130)]), i % 150) for i in range(200)]
    inside = spans(rng, 120, keys, 10_000)
    fits = lambda p, s: p[0] is not None and p[0] == s[0] and p[1] is not None and s[1] is not None and s[1] <= p[1] and (s[2] is None or p[1] <= s[2])
    cast = lambda c: (F.timestamp_seconds(F.col(c) * 3600) if kind == "timestamp" else F.col(c) / 7 if kind == "double" else F.col(c)).alias(c)
    p = spark.createDataFrame(points, "k string, t int, p int").select("k", cast("t"), "p")
    s = spark.createDataFrame(inside, "k string, a int, b int, s int").select("k", cast("a"), cast("b"), "s")
    assert bag(joins.interval_join(p, s, ["k"], "t", "a", "b").select("k", "p", "s")) == Counter((x[0], x[2], y[3]) for x in points for y in inside if fits(x, y))
    met = [any(fits(x, y) for y in inside) for x in points]
    assert bag(joins.interval_join(p, s, ["k"], "t", "a", "b", "left_semi").select("k", "p")) == Counter((x[0], x[2]) for x, m in zip(points, met) if m)
    assert bag(joins.interval_join(p, s, ["k"], "t", "a", "b", "left_anti").select("k", "p")) == Counter((x[0], x[2]) for x, m in zip(points, met) if not m)
    assert joins.interval_join(p, s.limit(0), ["k"], "t", "a", "b").count() == joins.interval_join(p.limit(0), s, ["k"], "t", "a", "b").count() == 0


def test_interval_join_of_one_hot_key(spark):
    points = spark.range(100_000).select(F.lit(1).alias("k"), (F.col("id") * 10).alias("t"))
    s = spark.range(10_000).select(F.lit(1).alias("k"), (F.col("id") * 97).alias("a"), (F.col("id") * 97 + F.col("id") % 50).alias("b"))
    want = sum((97 * i + i % 50) // 10 - (97 * i + 9) // 10 + 1 for i in range(10_000) if (97 * i + i % 50) // 10 <= 99_999)
    assert joins.interval_join(points, s, ["k"], "t", "a", "b").count() == want
    cut = joins._with_bins(s, "a", "b")
    levels = [r[0] for r in cut.select("_level").distinct().collect()]
    most = cut.groupBy("_level", "_bin").count().agg(F.max("count")).first()[0]
    assert cut.count() < 10 * 10_000 and len(levels) <= 3 and most <= 10  # a bin of 10^9 pairs becomes many of a few


def test_asof_ties_do_not_depend_on_partitions(spark):
    right = [("a", 5, v) for v in (3, 9, None, 4)]
    left = spark.createDataFrame([("a", 7)], "k string, t int")
    for parts in (1, 2, 4):
        r = spark.createDataFrame(right, "k string, rt int, v int").repartition(parts)
        assert joins.asof_join(left, r, ["k"], "t", "rt", ["v"]).collect()[0].v == 9


def test_wildcard_rules(spark):
    rng = random.Random(3)
    rows = [(rng.choice(["hot"] * 4 + ["a", None]), rng.choice([1, 2, 3, None]), rng.choice(["x", "y", None]), i) for i in range(300)]
    rules = [(rng.choice(["hot", "a", None]), rng.choice([None, 1, 2, 3, 4]), rng.choice([None, "x", "y", "z"]), rng.choice([None, 1, 2, 3]), i) for i in range(80)]
    rules += [("hot", 1000 + i, None, 1, i) for i in range(10_000)]  # many rules of one key
    want = Counter()
    for k, n, t, i in rows:
        fits = [((p is None, p or 0, u), u) for rk, rn, rt, p, u in rules if k is not None and rk == k and (rn is None or rn == n) and (rt is None or rt == t)]
        want[k, n, t, i, min(fits)[1] if fits else None] += 1
    r = spark.createDataFrame(rows, "k string, n int, t string, i int")
    u = spark.createDataFrame(rules, "k string, rn int, rt string, p int, u int").select("k", "p", "u", "rn", "rt")
    got = joins.wildcard_rules(r, u, ["k"], {"rn": "n", "rt": "t"}, ["p", "u"])
    assert bag(got.select("k", "n", "t", "i", "u")) == want
    assert joins.wildcard_rules(r, u.limit(0), ["k"], {"rn": "n", "rt": "t"}, ["p"]).where("u is null").count() == 300
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert " OR " not in plan and "BroadcastNestedLoop" not in got._jdf.queryExecution().executedPlan().toString()


def linked(records, registry):
    out, bearers = [], defaultdict(set)
    for g, e, n, f, s in registry:
        bearers[g, s].add(e)
    for g, n, name in records:
        best = None
        for rg, e, rn, f, s in registry:
            if g is None or g != rg:
                continue
            number, full, last = n is not None and n == rn, name is not None and name == f, name is not None and s is not None and name.endswith(" " + s)
            level = 1 if number and full else 2 if number and last else 3 if full else 4 if last and len(bearers[g, s]) == 1 else 5 if number else None
            if level:
                best = min(best or (9,), (level, e, rn is None, rn or ""))
        out.append((g, n, name, best and best[1], best and best[0], best and (None if best[2] else best[3])))
    return Counter(out)


def test_link_records(spark):
    rng = random.Random(4)
    names = ["ana lopez", "ana de la rosa", "rosa", "max la rosa", "j lopez", "lopez", None]
    surname = lambda f: f and rng.choice([f.split(" ")[-1], " ".join(f.split(" ")[1:]) or f])
    registry = [(rng.choice(["g", "h", None]), rng.randrange(12), rng.choice(["1", "2", "3", None]), f := rng.choice(names[:-1]), surname(f)) for _ in range(40)]
    records = [(rng.choice(["g", "h", "i", None]), rng.choice(["1", "2", "4", None]), rng.choice(names)) for _ in range(120)]
    a, b = spark.createDataFrame(records, "g string, n string, name string"), spark.createDataFrame(registry, "g string, e int, rn string, f string, s string")
    got = linkage.link_records(a, b, ["g"], "n", "name", "e", "rn", "f", "s")
    assert bag(got) == linked(records, registry)


def test_link_records_of_one_large_group(spark):
    n = 10_000
    word = lambda c: F.concat(F.lit("b"), F.translate(c.cast("string"), "0123456789", "abcdefghij"))
    registry = spark.range(n).select(F.lit("g").alias("g"), F.col("id").alias("e"), (F.col("id") % 500).cast("string").alias("rn"), F.concat(F.lit("ann "), word(F.col("id"))).alias("f"), word(F.col("id")).alias("s"))
    records = spark.range(n).select(F.lit("g").alias("g"), ((F.col("id") * 7) % 600).cast("string").alias("n"), F.concat(F.lit("eve "), word(F.col("id") * 3)).alias("name"))
    got = linkage.link_records(records, registry, ["g"], "n", "name", "e", "rn", "f", "s")
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert " OR " not in plan.split("Join", 1)[1].split("\n", 1)[0]
    count = Counter(r.match_level for r in got.collect())
    def level(i):
        number, name = 7 * i % 600, 3 * i
        return (2 if name % 500 == number else 4) if name < n else 5 if number < 500 else None
    assert count == Counter(level(i) for i in range(n))


def test_exact_quantiles_and_box(spark):
    rng = random.Random(5)
    rows = [(rng.choice(["hot"] * 9 + ["a", "b", None]), rng.choice([None, *range(30), 7, 7, 7]), i) for i in range(900)] + [("one", 5, 0), ("none", None, 0)]
    df = spark.createDataFrame(rows, "k string, v int, i int")
    by = defaultdict(list)
    for k, v, _ in rows:
        if v is not None:
            by[k].append(v)
    shares = {"q0": 0.0, "q1": 0.25, "q5": 0.5, "q9": 0.9, "q10": 1.0}
    for parts in (1, 6):
        got = {r.k: r for r in stats.exact_quantiles(df, ["k"], "v", shares, parts).collect()}
        assert got.keys() == by.keys()
        for k, r in got.items():
            assert r.n == len(by[k]) and np.allclose([r[q] for q in shares], np.quantile(by[k], list(shares.values())))
    assert {r.k for r in stats.box(df, ["k"], "v", 5).collect()} == {k for k, v in by.items() if len(v) >= 5}


def test_density(spark):
    rng = random.Random(6)
    rows = [(rng.choice(["a", "a", None]), rng.choice([None, *range(40)])) for _ in range(300)] + [("b", 3), ("none", None)]
    by = defaultdict(list)
    for k, v in rows:
        if v is not None:
            by[k].append(v)
    got = stats.density(spark.createDataFrame(rows, "k string, v int"), ["k"], "v", 20, 2.0)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Generate") < plan.index("Aggregate")  # rows are made after the sums (a plan reads from its end)
    seen = defaultdict(dict)
    for r in got.collect():
        seen[r.k][r.point] = (r.x, r.density)
    assert seen.keys() == by.keys()
    for k, v in by.items():
        h = max(1.06 * (stdev(v) if len(v) > 1 else 0) * len(v) ** -0.2, 2.0)
        x = min(v) + np.arange(20) * (max(v) - min(v)) / 19
        want = np.exp(-0.5 * ((x[:, None] - np.array(v)) / h) ** 2).sum(axis=1) / (len(v) * h * np.sqrt(2 * np.pi))
        assert np.allclose([seen[k][i][0] for i in range(20)], x) and np.allclose([seen[k][i][1] for i in range(20)], want)


# Null keys

def test_null_keys_stay(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 1), ("a", None)], "k string, v int")
    assert bag(windows.distinct_count_over(df, ["k"], "v", "n")) == Counter([(None, 1, 2), (None, 2, 2), ("a", 1, 1), ("a", None, 1)])
    units = spark.createDataFrame([("g", None, "1"), (None, "e", "1"), (None, "e", "2"), ("g", "e", "1"), ("g", "f", None), ("g", "f", "3")], "g string, e string, u string")
    assert bag(codes.unit_keys(units, ["g"], "e", "u")) == Counter([("g", None, "1", None), (None, "e", "1", "e_1"), (None, "e", "2", "e_2"), ("g", "e", "1", "e"), ("g", "f", None, "f"), ("g", "f", "3", "f_3")])
    laps = spark.createDataFrame([("r", 1, 100.0, False), ("r", None, 10**6 + 0.0, False), (None, 1, 5.0, True)], "race_id string, lap_number int, lap_time_ms double, is_red_flag boolean").withColumn("corrections", F.array().cast("array<string>"))
    assert fusion.flag_suspensions(laps).count() == 3
    none = spark.createDataFrame([(None, 1), (None, 1), ("p", 2)], "part string, v int")
    expected = spark.createDataFrame([("p", 1), (None, 9)], "part string, expected int")
    got = merge.merge_by_coverage(none, none.union(none), expected, ["part"], "expected")
    assert bag(got) == Counter({(None, 1, "delta"): 4, ("p", 2, "bulk"): 1})


def test_unit_results(spark):
    rows = spark.createDataFrame([("g", "a", "1"), ("g", "a", "2"), ("g", "b", "7"), ("g", "c", None), ("g", "d", "9")], "g string, e string, u string")
    results = spark.createDataFrame([("g", "a", "1", 3), ("g", "b", "8", 5), ("g", "c", "4", 2), ("g", "c", "5", 1)], "g string, e string, u string, place int")
    got = codes.unit_results(rows, results, ["g"], "e", "u", ["place"], ["place"])
    assert bag(got) == Counter([("g", "a", "1", "a_1", 3), ("g", "a", "2", "a_2", None), ("g", "b", "7", "b", 5), ("g", "c", None, "c", 1), ("g", "d", "9", "d", None)])


def test_merge_log_and_new_members(spark):
    rows = lambda part, n: [(part, i) for i in range(n)]
    frame = lambda data: spark.createDataFrame(data, "part string, ref int")
    bulk, delta, previous = frame(rows("a", 10) + rows("b", 2) + rows(None, 1)), frame(rows("b", 9) + rows("c", 4)), frame(rows("b", 9) + rows("c", 5))
    expected = spark.createDataFrame([("a", 10), ("b", 9), ("c", 9), ("d", 3)], "part string, expected int")
    merged = merge.merge_by_coverage(bulk, delta, expected, ["part"], "expected", previous)
    log = {r.part: (r.rows, r.origin, r.action) for r in merge.merge_log(bulk, delta, expected, ["part"], "expected", previous, merged).collect()}
    assert log == {"a": (10, "bulk", "new"), "b": (9, "delta", "kept"), "c": (5, "previous", "gap"), "d": (0, None, "gap"), None: (1, "bulk", "new")}
    dim = spark.createDataFrame([(1, "x", "bulk")], "ref int, name string, origin string")
    feed = spark.createDataFrame([(1, "other"), (2, "z"), (2, "y"), (7, "unused"), (None, "n")], "ref int, name string")
    whole, unknown = merge.with_new_members(dim, [frame([("a", 1), ("a", 2), ("b", 3), ("b", None)])], feed, "ref")
    assert bag(whole) == Counter([(1, "x", "bulk"), (2, "y", None)]) and [r.ref for r in unknown.collect()] == [3]


def test_build_overrides_with_repeats(spark):
    base = spark.createDataFrame([(1, "p", "x"), (2, "q", "y"), (2, "r", "y"), (None, "s", "z")], "k int, loc string, v string")
    lines = [(1, "v", "x", "n", "d1"), (1, "v", "x", "n", "d1"), (1, "v", "old", "n", "d2"), (2, "v", "y", "n", "d3"), (3, "v", "y", "n", "d4"), (None, "v", "z", "n", "d5")]
    good, errors = corrections.build_overrides(spark.createDataFrame(lines, "k int, column_name string, old_value string, new_value string, decision string"), base, ["k"], ["loc"], ["v"])
    assert bag(good.select("k", "loc", "decision")) == Counter({(1, "p", "d1"): 2})
    assert {(r.decision, r.reason) for r in errors.collect()} == {("d2", "value changed"), ("d3", "several rows"), ("d4", "no row"), ("d5", "no row")}


def test_interval_join_with_equal_column_names(spark):
    p = spark.createDataFrame([(1, 5, "p")], "k int, t int, name string")
    s = spark.createDataFrame([(1, 0, 9, "s"), (1, 3, None, "open")], "k int, a int, b int, name string")
    got = joins.interval_join(p, s, ["k"], "t", "a", "b")
    assert got.columns == ["k", "t", "name", "a", "b", "name"] and bag(got) == Counter([(1, 5, "p", 0, 9, "s"), (1, 5, "p", 3, None, "open")])


def greedy_codes(members):
    """The rule of `unique_codes` one by one: id -> code, of members (id, code, initial, ran)."""
    bearers, ran = Counter(c for _, c, _, _ in members), Counter(c for _, c, _, r in members if r)
    out = {i: c for i, c, _, r in members if bearers[c] == 1 or (r and ran[c] == 1)}
    taken, last = set(out.values()), Counter()
    for i, c, initial, _ in sorted(members):
        if i not in out:
            wanted = chain([initial + c[:2], initial + c], (f"{c}{k}" for k in range(last[c] + 2, len(members) + 3)))
            out[i] = next(x for x in wanted if x not in taken)
            if out[i][len(c):].isdigit() and out[i].startswith(c):
                last[c] = int(out[i][len(c):]) - 1
            taken.add(out[i])
    return out


def test_unique_codes_of_groups_of_any_size(spark):
    rng = random.Random(5)
    groups = {g: [(i, rng.choice(["AAA", "AA", "A2", "A", "BA1", "AAA2"] if g % 2 else ["AAA", "AA", "ABA", "BAB", "A"]), rng.choice("AB"), rng.random() < 0.4) for i in range(rng.randint(1, 25))] for g in range(60)}
    groups[99] = [(i, rng.choice(["SUP", "SUP", "SAS"]), rng.choice("ABCDES"), True) for i in range(20_000)]
    rows = [(g, i, c, n, r) for g, members in groups.items() for i, c, n, r in members]
    df = spark.createDataFrame(rows, "g int, id long, code string, name string, ran boolean")
    got = {(r.g, r.id): r.unique_code for r in codes.unique_codes(df, ["g"], "id", "code", "name", "ran").collect()}
    assert got == {(g, i): c for g, members in groups.items() for i, c in greedy_codes(members).items()}
