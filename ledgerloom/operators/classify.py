"""Rule classes of titles, labels from them, document types, and nearest centroids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.rules import PARENTS, SUBCATEGORIES

#: Unicode classes and line ends as in the dialect that the rules are written for.
FLAGS = "(?Ud)"


def rule_hits(title: Column, rules: list[tuple[str, str, str]]) -> Column:
    """(sub, parent) of all rules whose pattern is found, in their order; no join and no Python."""
    hits = [F.when(title.rlike(FLAGS + pattern), F.struct(F.lit(sub).alias("sub"), F.lit(parent).alias("parent"))) for sub, parent, pattern in rules]
    return F.array_compact(F.array(*hits))


def classify_titles(df: DataFrame, title: str, subcategories=SUBCATEGORIES, parents=PARENTS, other: str = "OTHER") -> DataFrame:
    """Adds subs and parents (arrays) and their joined texts parent_text and sub_text.

    Parents are those of the subcategories found, then parents whose own pattern is
    found, each once; without any the parent is `other`. A null title finds nothing.
    """
    text = F.coalesce(F.col(title), F.lit(""))
    own = F.array_compact(F.array(*[F.when(text.rlike(FLAGS + p), F.lit(name)) for name, p in parents if p]))
    out = df.withColumn("_hits", rule_hits(text, subcategories))
    out = out.withColumn("subs", F.transform("_hits", lambda h: h["sub"]))
    out = out.withColumn("_parents", F.array_distinct(F.concat(F.transform("_hits", lambda h: h["parent"]), own)))
    out = out.withColumn("parents", F.when(F.size("_parents") == 0, F.array(F.lit(other))).otherwise(F.col("_parents")))
    return out.withColumns({"parent_text": F.array_join("parents", ", "), "sub_text": F.array_join("subs", ", ")}).drop("_parents")


def label_rows(classified: DataFrame, key: str) -> DataFrame:
    """(key, category, subcategory): one row per subcategory with its parent, else one per parent."""
    plain = F.transform("parents", lambda p: F.struct(F.lit(None).cast("string").alias("sub"), p.alias("parent")))
    rows = F.when(F.size("_hits") > 0, F.col("_hits")).otherwise(plain)
    return classified.select(key, F.explode(rows).alias("h")).select(key, F.col("h.parent").alias("category"), F.col("h.sub").alias("subcategory"))


def share_of_total(counts: DataFrame, count: str, places: int = 1) -> Column:
    from pyspark.sql import Window as W

    part = F.col(count).cast("decimal(18,0)") * 100 / F.sum(F.col(count)).over(W.partitionBy()).cast("decimal(18,0)")
    return F.round(part, places).cast("decimal(18,1)")


def batch_statistics(classified: DataFrame) -> DataFrame:
    """Totals and shares of rows with and without a class; shares are 0 without rows."""
    total, other = F.count(F.lit(1)), F.count_if(F.col("parent_text") == "OTHER")
    pct = lambda n: F.when(total > 0, F.round(n.cast("decimal(18,0)") * 100 / total, 1)).otherwise(0).cast("decimal(18,1)")
    return classified.agg(total.alias("total"), other.alias("other"), (total - other).alias("classified"), pct(other).alias("other_pct"), pct(total - other).alias("classified_pct"))


# Keywords of document types, first match first.
DOCUMENT_TYPES = [
    ("earnings_revision", ["業績予想", "業績見通し", "予想修正", "見通し修正"]),
    ("dividend_change", ["配当", "増配", "減配", "復配", "無配"]),
    ("share_buyback", ["自己株式", "株式買戻し", "自社株買い"]),
    ("ma_transaction", ["買収", "合併", "m&a", "統合", "子会社化"]),
    ("split_merger", ["株式分割", "株式併合", "分割"]),
]


def document_type(title: Column, ladder=DOCUMENT_TYPES, last: str = "guidance_update") -> Column:
    text = F.lower(F.coalesce(title, F.lit("")))
    out = F.when(F.lit(False), F.lit(last))
    for name, words in ladder:
        found = F.lit(False)
        for w in words:
            found = found | text.contains(w.lower())
        out = out.when(found, name)
    return out.otherwise(last)


def doubles(v: Column) -> Column:
    return v.cast("array<double>")


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two arrays of doubles; null if one has no length."""
    norm = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(norm > 0, dot(a, b) / norm)


def normalised(v: Column) -> Column:
    size = F.sqrt(dot(v, v))
    return F.when(size > 0, F.transform(v, lambda x: x / size)).otherwise(v)


def centroids(vectors: DataFrame, label: str, vector: str) -> DataFrame:
    """(label, centroid): the mean of each component, through partial sums by component."""
    parts = vectors.select(label, F.posexplode(doubles(F.col(vector))).alias("i", "x")).groupBy(label, "i").agg(F.avg("x").alias("x"))
    return parts.groupBy(label).agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda p: p["x"]).alias("centroid"))


def nearest_centroid(vectors: DataFrame, key: str, vector: str, classes: DataFrame, label: str, least: float = 0.3, other: str = "Other", most: int = 256) -> DataFrame:
    """The class of the most similar centroid, the first on a tie, or `other` below `least`.

    The classes of a scheme become rows with arrays of up to about `most` of them, so
    that each vector is scored in a projection: no pairs of rows are made. One such
    row is sent to all executors; of more, each meets all vectors in a shuffle, and the
    best is found by partial sums (keys are unique then).
    """
    blocks = max(1, -(-classes.count() // most))
    number = F.pmod(F.xxhash64(label), F.lit(blocks)).alias("_block")
    known = classes.groupBy(number).agg(F.array_sort(F.collect_list(F.struct(F.col(label).alias("label"), "centroid"))).alias("_classes"))
    v = doubles(F.col(vector))
    scored = F.transform("_classes", lambda c: F.struct(F.coalesce(cosine(v, c["centroid"]), F.lit(-2.0)).alias("similarity"), c["label"].alias("label")))
    best = F.aggregate(F.slice(scored, 2, F.greatest(F.size(scored) - 1, F.lit(0))), F.get(scored, F.lit(0)), lambda a, x: F.when(x["similarity"] > a["similarity"], x).otherwise(a))
    rows = vectors.select(key, vector, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("_block"))
    rows = rows.join(F.broadcast(known) if blocks == 1 else known, "_block", "left").withColumn("_best", F.explode(F.array(best)))
    if blocks > 1:
        rows = rows.groupBy(key).agg(F.min_by("_best", F.struct(-F.col("_best.similarity"), F.col("_best.label"))).alias("_best"))
    chosen = F.when(F.col("_best.similarity") < least, F.lit(other)).otherwise(F.col("_best.label").cast("string"))
    return rows.select(key, chosen.alias("category"), F.col("_best.similarity").alias("similarity"))


def chosen_titles(disclosures: DataFrame, labels: DataFrame | None = None, ids: DataFrame | None = None, first=None, last=None, key: str = "id", date: str = "disclosure_date") -> DataFrame:
    """Disclosures to classify: those without labels, of a list of ids or of a span of days, each if given."""
    out = disclosures
    if labels is not None:
        out = out.join(labels.select(F.col("disclosure_id").alias(key)).where(F.col(key).isNotNull()), key, "left_anti")
    if ids is not None:
        out = out.join(ids.select(key).distinct(), key, "left_semi")
    if first is not None:
        out = out.where(F.col(date) >= F.lit(first))
    if last is not None:
        out = out.where(F.col(date) <= F.lit(last))
    return out


def training_samples(classified: DataFrame, title: str, key: str) -> DataFrame:
    """(key, sample): JSON of a title and its classes, as models are trained on."""
    parts = lambda c: F.when(F.col(c) == "", F.array().cast("array<string>")).otherwise(F.split(c, ", "))
    labels = F.struct(parts("parent_text").alias("parent_categories"), parts("sub_text").alias("subcategories"))
    return classified.select(key, F.to_json(F.struct(F.col(title).alias("text"), labels.alias("labels"))).alias("sample"))


def in_both_languages(labels: DataFrame, english: str, names: list[tuple[str, str]], japanese: str) -> DataFrame:
    """Labels with the Japanese name of each class; one without is null."""
    return labels.withColumn(japanese, F.element_at(F.create_map(*[F.lit(x) for kv in names for x in kv]), F.col(english)))
