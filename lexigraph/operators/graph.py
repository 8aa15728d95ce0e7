"""The relationship graph: vertices, edges in both directions, neighbourhoods, visible parts, validation and statistics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Relationship types and their inverses; classes of types; valid eras and locations.
INVERSE = {"teacher": "student", "student": "teacher", "father": "son", "son": "father", "wife": "husband", "husband": "wife", "sibling": "sibling", "brother-in-law": "brother-in-law"}
CLASSES = {"teacher-student": ["teacher", "student"], "family": ["father", "son", "wife", "husband", "brother-in-law"], "sibling": ["sibling"]}
ERAS, LOCATIONS = ("tanna", "amorai"), ("israel", "bavel")


def vertices(sages: DataFrame) -> DataFrame:
    """One row of each id: the last one in file order. Null ids are none."""
    return sages.where("id is not null").groupBy("id").agg(F.max_by(F.struct(*[c for c in sages.columns if c != "id"]), "pos").alias("x")).select("id", "x.*")


def declared(sages: DataFrame) -> DataFrame:
    """All relationships as written: ``src, dst, type, note, pos, at`` (row and place within it). Null targets are kept."""
    each = sages.select(F.col("id").alias("src"), "pos", F.posexplode("relationships").alias("at", "r"))
    return each.where("r is not null").select("src", F.col("r.target").alias("dst"), F.col("r.type").alias("type"), F.col("r.note").alias("note"), "pos", "at")


def adjacency(sages: DataFrame) -> DataFrame:
    """Relationships in both directions: ``src, dst, type, pos, at, inverse``. Those written are all kept, dangling ones too;
    an inverse is added where the target exists and the type has one. Relationships written on both sides come twice."""
    direct = declared(sages).select("src", "dst", "type", "pos", "at", F.lit(False).alias("inverse"))
    known = sages.select(F.col("id").alias("dst")).where("dst is not null").distinct()
    other = F.create_map(*(F.lit(x) for pair in INVERSE.items() for x in pair))
    back = direct.join(known, "dst", "left_semi").select(F.col("dst").alias("src"), F.col("src").alias("dst"), F.try_element_at(other, F.col("type")).alias("type"), "pos", "at", F.lit(True).alias("inverse"))
    return direct.unionByName(back.where("type is not null"))


def grouped_neighbours(sages: DataFrame) -> DataFrame:
    """Neighbours that exist, by type: ``src, type, n, first_pos, first_at`` and their ids and names in the order written."""
    named = vertices(sages).select(F.col("id").alias("dst"), F.col("name.en").alias("name"))
    met = adjacency(sages).join(named, "dst")
    each = F.array_sort(F.collect_list(F.struct("pos", "at", "inverse", "dst", "name")))
    return met.groupBy("src", "type").agg(F.count("*").alias("n"), F.min(F.struct("pos", "at")).alias("f"), each.alias("x")).select("src", "type", "n", F.col("f.pos").alias("first_pos"), F.col("f.at").alias("first_at"), F.col("x.dst").alias("ids"), F.col("x.name").alias("names"))


def edges(sages: DataFrame) -> DataFrame:
    """Undirected edges: of each pair and type the first one written, in its direction; dangling ones are kept."""
    d = declared(sages).where("dst is not null and src is not null")
    first = d.groupBy(F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b"), "type").agg(F.min(F.struct("pos", "at", "src", "dst")).alias("x"))
    return first.select("x.src", "x.dst", "type", "x.pos", "x.at")


def search_names(sages: DataFrame, query: str) -> DataFrame:
    """The sages whose English name contains the query in any case, or whose Hebrew name contains it as it is."""
    q = F.lit(query)
    hit = F.contains(F.lower(F.col("name.en")), F.lower(q)) | F.contains(F.col("name.he"), q)
    return sages.where(F.coalesce(hit, F.lit(False)) & (q != "")).orderBy("pos")


def of_era(sages: DataFrame, era: str) -> DataFrame:
    return sages if era == "all" else sages.where(F.col("era") == era)


def group_of():
    """The group that filters go by: ``tanna``, or ``amorai-`` and the location."""
    return F.when(F.col("era") == "tanna", "tanna").otherwise(F.concat(F.lit("amorai-"), F.coalesce("location", F.lit("null"))))


def visible(sages: DataFrame, groups: Sequence[str] = ("tanna",)) -> DataFrame:
    return vertices(sages).where(group_of().isin(*groups))


def visible_edges(sages: DataFrame, groups: Sequence[str] = ("tanna",), classes: Sequence[str] = tuple(CLASSES), table: Mapping[str, Sequence[str]] = CLASSES) -> DataFrame:
    """The edges of the chosen classes between visible sages."""
    types = sorted({t for c in classes for t in table.get(c, ())})
    ids = visible(sages, groups).select("id")
    shown = edges(sages).where(F.col("type").isin(*types))
    return shown.join(ids.withColumnRenamed("id", "src"), "src", "left_semi").join(ids.withColumnRenamed("id", "dst"), "dst", "left_semi")


def neighbourhood(sages: DataFrame, chosen: DataFrame) -> DataFrame:
    """``id, near``: each chosen id with itself and all it is related to, each once."""
    near = adjacency(sages).join(chosen.select(F.col("id").alias("src")).distinct(), "src", "left_semi").select(F.col("src").alias("id"), F.col("dst").alias("near"))
    return near.where("near is not null").unionByName(chosen.select("id", F.col("id").alias("near"))).distinct()


def highlight_nodes(sages: DataFrame, chosen: DataFrame, groups: Sequence[str] = ("tanna",)) -> DataFrame:
    """For each chosen id, the visible nodes near it (all others are dimmed): ``chosen, id, selected``."""
    near = neighbourhood(sages, chosen).select(F.col("id").alias("chosen"), F.col("near").alias("id"))
    return near.join(visible(sages, groups).select("id"), "id", "left_semi").select("chosen", "id", (F.col("chosen") == F.col("id")).alias("selected"))


def highlight_edges(sages: DataFrame, chosen: DataFrame, groups: Sequence[str] = ("tanna",), classes: Sequence[str] = tuple(CLASSES)) -> DataFrame:
    """For each chosen id, the visible edges with both ends near it, those between two neighbours too."""
    near = neighbourhood(sages, chosen)
    shown = visible_edges(sages, groups, classes).select("src", "dst", "type")
    a = near.select(F.col("id").alias("chosen"), F.col("near").alias("src"))
    b = near.select(F.col("id").alias("chosen"), F.col("near").alias("dst"))
    return shown.join(a, "src").join(b, ["chosen", "dst"], "left_semi").select("chosen", "src", "dst", "type")


def statistics(sages: DataFrame) -> DataFrame:
    """Counts by era, location and relationship type: ``kind, value, n``; a missing value is null."""
    by = lambda df, kind, c: df.groupBy(F.col(c).alias("value")).agg(F.count("*").alias("n")).select(F.lit(kind).alias("kind"), "value", "n")
    return by(sages, "era", "era").unionByName(by(sages, "location", "location")).unionByName(by(declared(sages), "relationship", "type"))


def violations(sages: DataFrame) -> DataFrame:
    """``id, pos, rule, value``: required fields that are missing, values that are not allowed, targets that do not exist, ids
    on several rows (reported once, at the first)."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")) == ""
    rules = [F.when(blank(c), F.struct(F.lit(f"missing {c}").alias("rule"), F.lit(None).cast("string").alias("value"))) for c in ("id", "name.en", "name.he", "era", "generation", "location")]
    rules += [F.when(~blank(c) & ~F.col(c).isin(*ok), F.struct(F.lit(f"unknown {c}").alias("rule"), F.col(c).alias("value"))) for c, ok in (("era", ERAS), ("location", LOCATIONS))]
    fields = sages.select("id", "pos", F.explode(F.array_compact(F.array(*rules))).alias("x")).select("id", "pos", "x.rule", "x.value")
    known = sages.select(F.col("id").alias("dst")).distinct()
    dangling = declared(sages).join(known, "dst", "left_anti").select(F.col("src").alias("id"), "pos", F.lit("unknown target").alias("rule"), F.col("dst").alias("value"))
    twice = sages.where("id is not null").groupBy("id").agg(F.count("*").alias("n"), F.min("pos").alias("pos")).where("n > 1").select("id", "pos", F.lit("repeated id").alias("rule"), F.col("n").cast("string").alias("value"))
    return fields.unionByName(dangling).unionByName(twice)


def landmark_rows(spark: SparkSession, landmarks: list[tuple[int, str]]) -> DataFrame:
    """Landmarks as a table ``year, label``."""
    return spark.createDataFrame(landmarks, "year int, label string")
