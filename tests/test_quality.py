"""Orphan references and filled values against brute force, with nulls, ties, repeats, empty tables."""

import datetime as dt
import random

from pyspark.sql import functions as F

from lexigraph.functions.normalize import hebrew_letters, read_code
from lexigraph.operators.fill import Field, fill_from_groups, filled_values
from lexigraph.operators.orphans import by_table_and_month, intervals, orphans


def at(day, hour=0):
    return dt.datetime(2024, 1, day, hour)


def test_intervals_and_orphans(spark):
    rows = spark.createDataFrame([("A1", 0, at(3)), ("A1", 5, at(2)), ("A2", 1, at(9)), ("A3", 2, at(1)), (None, 3, at(1)), ("A4", 4, None)], "id string, seq long, loaded_at timestamp")
    gone = spark.createDataFrame([("A3", at(2)), ("A3", at(2)), ("A1", at(2, 1)), ("zz", at(1)), (None, at(1))], "rid string, removed_at timestamp")
    spans = intervals(rows.withColumn("x", F.array("seq")), gone, F.col("id"), F.col("rid"), "seq", "seq", "x")
    assert {(*tuple(r)[:4], *r.x) for r in spans.collect()} == {("A1", at(2), None, 5, 5), ("A2", at(9), None, 1, 1), ("A3", at(1), at(2), 2, 2), ("A4", None, None, 4, 4)}
    assert intervals(rows.limit(0), gone, F.col("id"), F.col("rid"), "seq").count() == 0
    spans = spans.drop("x")
    day = lambda n: dt.date(2024, 1, n)
    refs = spark.createDataFrame(
        [("n", "1", "e", "A1", day(1)), ("n", "2", "e", "A1", day(2)), ("n", "3", "e", "A3", day(5)), ("n", "4", "e", "A9", None), ("n", "5", "e", None, day(1)), ("n", "6", "e", "A2", None), ("n", "7", "e", "A2", day(8)), ("n", "7", "e", "A2", day(8)), ("n", "8", "s", "A1", day(9))],
        "src_table string, src_key string, target_table string, target_key string, ref_date date",
    )
    parents = spans.withColumn("table", F.lit("e"))
    found = orphans(refs, parents)
    assert sorted((r.src_key, r.reason) for r in found.collect()) == [("1", "late"), ("3", "deleted"), ("4", "missing"), ("7", "late"), ("7", "late"), ("8", "missing")]
    assert {tuple(r) for r in by_table_and_month(found).collect()} == {("n", day(1), "late", 3), ("n", day(1), "deleted", 1), ("n", None, "missing", 1), ("n", day(1), "missing", 1)}
    own = refs.withColumn("reason", F.lit("x")).withColumn("valid_from", F.lit(1)).withColumn("key", F.lit("k"))
    assert sorted(r.reason for r in orphans(own, parents).collect()) == ["deleted", "late", "late", "late", "missing", "missing"]
    assert orphans(refs, parents.limit(0)).count() == 8
    assert orphans(refs.limit(0), parents).count() == 0


def test_orphans_are_merged_not_broadcast(spark):
    refs = spark.createDataFrame([("n", "1", "e", "A1", None)], "src_table string, src_key string, target_table string, target_key string, ref_date date")
    parents = spark.createDataFrame([("e", "A1", at(1), None)], "table string, key string, valid_from timestamp, valid_to timestamp")
    plan = orphans(refs, parents)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def brute_fill(rows, levels, min_support):
    from collections import Counter

    out = {}
    for r in rows:
        value, level = r["v"], None
        if value is None:
            for i, key in enumerate(levels):
                near = Counter(x["v"] for x in rows if x[key] == r[key] and r[key] and x["v"] is not None)
                if sum(near.values()) >= min_support:
                    best = max(near.values())
                    value, level = min(v for v, n in near.items() if n == best), i
                    break
        out[r["id"]] = (value, level)
    return out


def test_fill_backs_off(spark):
    rng = random.Random(4)
    rows = [{"id": i, "a": rng.choice(["x", "y", "z", "", None]), "b": rng.choice(["p", "q", None]), "v": rng.choice(["m", "f", "n", None, None])} for i in range(200)]
    df = spark.createDataFrame(rows, "id long, a string, b string, v string")
    fine = F.concat("a", F.lit("|"), "b")
    for r in rows:
        r["fine"] = None if r["a"] is None or r["b"] is None else f"{r['a']}|{r['b']}"
    for support in (1, 5):
        got = {r.id: (r.v_value, r.v_level) for r in fill_from_groups(df, [fine, F.col("a")], [Field("v", F.col("v"))], support).collect()}
        assert got == brute_fill(rows, ["fine", "a"], support)


def test_fill_numeric_conditional_and_empty(spark):
    df = spark.createDataFrame([(1, "g", 1.0, "n"), (2, "g", 5.0, "v"), (3, "g", 9.0, None), (4, "g", None, None), (5, None, None, None), (6, "h", None, "n")], "id long, k string, x double, s string")
    fields = [Field("s", F.col("s")), Field("x", F.col("x"), numeric=True, when=lambda done: done["s"] == "n")]
    got = {r.id: (r.s_value, r.s_level, r.x_value, r.x_level) for r in fill_from_groups(df, [F.col("k")], fields).collect()}
    assert got == {1: ("n", None, 1.0, None), 2: ("v", None, 5.0, None), 3: ("n", 0, 9.0, None), 4: ("n", 0, 5.0, 0), 5: (None, None, None, None), 6: ("n", None, None, None)}
    assert fill_from_groups(df.limit(0), [F.col("k")], fields).count() == 0
    again = fill_from_groups(fill_from_groups(df, [F.col("k")], fields), [F.col("k")], fields)
    assert again.columns == ["id", "k", "x", "s", "s_value", "s_level", "x_value", "x_level"] and again.count() == 6


def test_median_is_exact(spark):
    """The lower median of groups of any size, also of one that holds most rows and has very many values."""
    rng = random.Random(6)
    rows = [("hot", rng.choice([rng.randint(-10**9, 10**9), None])) for _ in range(30_000)] + [("even", v) for v in (4, 1, 3, 2)] + [("ties", v) for v in (7, 7, 1, 9)] + [("even", None), ("ties", None), ("none", None)]
    df = spark.createDataFrame([(i, k, v) for i, (k, v) in enumerate(rows)], "id long, k string, v int").repartition(7)
    got = {r.k: r.value for r in filled_values(df, "id", [F.col("k")], [Field("v", F.col("v"), numeric=True)]).join(df, "id").collect()}
    hot = sorted(v for k, v in rows if k == "hot" and v is not None)
    assert got == {"hot": str(hot[(len(hot) - 1) // 2]), "even": "2", "ties": "7"}


def test_codes_and_letters(spark):
    df = spark.createDataFrame([(" N. ",), ("n",), (" v\t",), ("n/a",), ("",), (None,), ("n..",)], "x string")
    assert [r[0] for r in df.select(read_code(F.col("x"), "n", "v")).collect()] == ["n", "n", "v", None, None, None, None]
    words = ["אָבּך III", "ﬡדּ​ם", "ℵב", "ﭏ", "װ", "Kābir 1", None, ""]
    assert [r[0] for r in spark.createDataFrame([(w,) for w in words], "x string").select(hebrew_letters(F.col("x"))).collect()] == ["אבכ", "אדמ", "אב", "אל", "וו", "", "", ""]
