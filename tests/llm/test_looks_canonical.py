"""Look-alikes and mapped values: cases, brute force, SQL."""

import collections
import itertools
import random
import unicodedata

import pytest
from conftest import DATA, same_rows
from pyspark.sql import functions as F

from lexigraph.llm import queries
from lexigraph.llm.canonical import ambiguous_forms, candidates, edits_between, judged, list_forms, map_to_list
from lexigraph.llm.looks import look, look_alikes, look_form

ALIKE = [("אָּ", "אָּ"), ("ﬡב", "אב"), ("ℵ", "א"), ("א​ב", "אב"), ("א͏ָּ", "אָּ"), (" א ", "א"), ("a b", "a b"), ("Ⅳ", "IV"), ("Ｖ１", "V1"), ("é", "é"), ("І", "I"), ("ѴІІ", "VII"), ("Ḥ", "Ḥ"), ("א״ב", 'א"ב'), ("א″ב", "א”ב"), ("װ", "וו"), ("ׇ", "ָ"), ("ﭏ", "אל"), ("а̄", "ā"), ("ﬁ", "fi")]
APART = [("א", "אָ"), ("I", "II"), ("I", "i"), ("1", "²"), ("a b", "a  b"), ("אב", "א ב"), ("1", "①"), ("ם", "מ"), ("ָ", "ַ"), ("*א", "א"), ("Kābir", "Kabir")]


def test_looks():
    for a, b in ALIKE:
        assert look(a) == look(b) and look(look(a)) == look(a), (a, b)
    for a, b in APART:
        assert look(a) != look(b), (a, b)
    assert look(None) is None and look("​ ­") == "" and look("Ab", True) == look("aB", True)


def test_pairs_against_brute_force(spark):
    rng = random.Random(9)
    variants = [x for pair in ALIKE[:14] for x in pair]
    rows = [(i, rng.choice(variants)) for i in range(250)] + [(900, None), (901, ""), (902, "​"), (903, " "), (904, None)]
    df = spark.createDataFrame(rows, "seq long, hw string")
    want = {(a, b) for (a, x), (b, y) in itertools.combinations(rows, 2) if x and y and x != y and look(x) == look(y) and look(x)}
    got = [tuple(r) for r in look_alikes(df, "hw", "seq").collect()]
    assert len(got) == len(set(got)) and set(got) == want
    assert look_alikes(df.limit(0), "hw", "seq").count() == 0
    forms = dict(map(tuple, df.select("seq", look_form(F.col("hw"))).collect()))
    assert forms == {i: look(x) for i, x in rows}
    long = spark.createDataFrame([(1, "א" * 200_000 + "​"), (2, "א" * 200_000)], "seq long, hw string")
    assert [tuple(r) for r in look_alikes(long, "hw", "seq").collect()] == [(1, 2)]


def test_hot_spelling_is_not_squared(spark):
    """Twenty thousand rows of one spelling meet the three rows of another, never each other."""
    df = spark.range(20_003).select(F.col("id").alias("seq"), F.when(F.col("id") < 20_000, "א").otherwise("א​").alias("hw"))
    pairs = look_alikes(df, "hw", "seq")
    assert pairs.count() == 60_000 and "CartesianProduct" not in pairs._jdf.queryExecution().executedPlan().toString()


def test_each_spelling_is_looked_at_once(spark, tmp_path):
    """One Python node in the executed plan, above the distinct spellings; Python sees as many values as there are spellings."""
    spark.range(6_000).select(F.col("id").alias("seq"), F.concat(F.lit("א"), (F.col("id") % 300).cast("string"), F.when(F.col("id") % 7 == 0, "\u200b").otherwise("")).alias("hw")).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    pairs = look_alikes(df, "hw", "seq")
    assert pairs.count() == sum(len([i for i in range(k, 6_000, 300) if i % 7 == 0]) * len([i for i in range(k, 6_000, 300) if i % 7]) for k in range(300))
    pairs.collect()
    plan = pairs._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("ArrowEvalPython") == 1 and plan.index("ArrowEvalPython") < plan.rindex("HashAggregate")
    spellings = df.select("hw").distinct().count()
    graph = pairs._jdf.queryExecution().executedPlan().toString()
    assert spellings == 600 and "ReusedExchange" in graph


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_same_as_sql(spark, duck, name):
    same_rows(queries.QUERIES[name](spark, DATA), duck, queries.ORACLE[name])


LIST = [("Bava Kamrot", "B. Kam."), ("Orvaya", "Orv."), ("Orvaya Zakit", "Orv. Zak."), ("Hargilah", "Ḥarg."), ("Shefarot", "Shef."), ("Shevuttin", "Shebutt."), ("Pirkei Nahalat Gad", None)]
TYPED = {
    "B. Kam.": "Bava Kamrot", "b kam": "Bava Kamrot", "B.KAM": "Bava Kamrot", "Bava Kam.": "Bava Kamrot", "BavaKamrot": "Bava Kamrot", "Bava-Kamroth": "Bava Kamrot", "Baav Kamr0t": "Bava Kamrot", "<i>Orv.</i>": "Orvaya", "Orv. Zak.": "Orvaya Zakit", "orvaya zaikt": "Orvaya Zakit",
    "harg": "Hargilah", "Ḥărgilah": "Hargilah", "Shefa.": "Shefarot", "Pirkei Nahalat gda": "Pirkei Nahalat Gad", "X. Kam.": None, "Bava Dronesh": None, "She.": None, "?": None, "": None, "ib.": None, "l. c.": None, "Orvaya Zuta Rabbati Magna": None,
}


def test_mapping(spark):
    names = spark.createDataFrame(LIST, "value string, key string")
    typed = spark.createDataFrame([(t, i) for i, t in enumerate([*TYPED, *TYPED, None])], "t string, value int")
    got = {r.value: r.target for r in map_to_list(typed, "t", list_forms(names, "value", "key")).collect()}
    assert got == {t: v for t, v in TYPED.items() if v}
    assert map_to_list(typed, "t", list_forms(names.limit(0), "value", "key")).count() == 0
    assert map_to_list(typed.limit(0), "t", list_forms(names, "value", "key")).count() == 0
    assert not {"she"} & {r.form for r in list_forms(names, "value", "key").collect()}


def edits(a, b):
    """The mean of edit distance and letters not shared, by the textbook."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return (row[-1] + max(len(a), len(b)) - sum((collections.Counter(a) & collections.Counter(b)).values())) / 2


def decided(a, b):
    """The decision with the parameters of the query."""
    x, y, wa, wb = a.replace(" ", ""), b.replace(" ", ""), a.split(), b.split()
    n, e = max(len(x), len(y)), edits(x, y)
    if len(wa) != len(wb):
        return e <= n * 0.15
    return e <= max(1, int(n * 0.3 + 1e-9)) and all(edits(v, w) <= max(2, 0.5 * max(len(v), len(w))) for v, w in zip(wa, wb))


def test_join_finds_all_pairs_of_the_decision(spark):
    """Recall against all pairs under the decision rule, on typed errors of any kind, and how few pairs are compared."""
    rng = random.Random(11)
    base = ["abc", "kamrot", "orvaya zakit", "hargilah", "shefarot", "tzefonit", "galgalim", "mekhilat devarion", "pirkei nahalat gad", "toldaniah", "arkhei mayan", "seder tekufot zuta"]

    def typo(w):
        w = list(w)
        for _ in range(rng.randint(0, 4)):
            i = rng.randrange(len(w))
            w[i : i + 1] = rng.choice([[], [w[i], w[i]], [rng.choice("abkmrt ")], [w[i], rng.choice("ehiou")]])
            if rng.random() < 0.4 and len(w) > 1:
                i = rng.randrange(len(w) - 1)
                w[i], w[i + 1] = w[i + 1], w[i]
            w = w or ["a"]
        return " ".join("".join(w).split()) or "a"

    typed = sorted({typo(rng.choice(base)) for _ in range(600)})
    kind = F.lit("said").alias("kind")
    left, right = (spark.createDataFrame([(t,) for t in x], "text string").select(kind, "text") for x in (typed, base))
    want = {(a, b) for a in typed for b in base if decided(a, b)}
    pairs = candidates(left, right.withColumn("exact", F.lit(False)), 0.3)
    got = {(r.text_a, r.text_b) for r in judged(pairs, 0.3, 0.5).where("alike").collect()}
    assert got <= want and len(want) > 250 and len(got) >= 0.99 * len(want), want - got
    assert pairs.count() <= len(want) + 0.1 * len(typed) * len(base)
    every = left.withColumnRenamed("text", "text_a").join(right.withColumnRenamed("text", "text_b"), "kind")
    assert {(r.text_a, r.text_b) for r in judged(every, 0.3, 0.5).where("alike").collect()} == want


def test_short_names_with_swapped_letters(spark):
    names = spark.createDataFrame([("Abc",), ("Wxyz",), ("Qi",)], "value string")
    typed = spark.createDataFrame([("Acb",), ("bac",), ("wyxz",), ("xwyz",), ("wyx",), ("iq",), ("abcdef",), ("Abc" * 40_000,)], "t string")
    got = {r.value: r.target for r in map_to_list(typed, "t", list_forms(names, "value")).collect()}
    assert got == {"Acb": "Abc", "bac": "Abc", "wyxz": "Wxyz", "xwyz": "Wxyz", "iq": "Qi"} | ({"wyx": "Wxyz"} if decided("vyx", "vxyz") else {})


def test_ambiguous_forms_are_reported(spark):
    names = spark.createDataFrame([("Orvaya Magna", "O. M."), ("Orvaya Minor", "O. M."), ("Orvaya Magna", "O.M"), ("Hargil", None), (None, "x")], "value string, key string")
    assert {(r.form, *r.targets) for r in ambiguous_forms(names, "value", "key").collect()} == {("o. m.", "Orvaya Magna", "Orvaya Minor")}
    assert "om" not in {r.form.replace(".", "").replace(" ", "") for r in list_forms(names, "value", "key").collect()}
    assert ambiguous_forms(names.limit(0), "value").count() == 0


def test_edits(spark):
    rows = spark.createDataFrame([("abc", "abc"), ("abc", "acb"), ("abc", "abd"), ("abc", "abcd"), ("", "ab"), ("a", "")], "a string, b string")
    assert [r[0] for r in rows.select(edits_between(F.col("a"), F.col("b"))).collect()] == [0, 1, 1, 1, 2, 1]


def test_citations(spark, duck):
    got = queries.p4_found(spark, DATA).collect()
    assert got and len(got) == len({tuple(r) for r in got})
    values = {v for (v,) in duck.execute("SELECT value FROM lookup").fetchall()}
    assert {r.value for r in got} <= values
    missed = {r.work for r in queries.p4_unmatched(spark, DATA).collect()}
    assert {"ib", "l. c", "ib. l. c"} & missed and not {unicodedata.normalize("NFKD", v).lower() for v in values} & missed
