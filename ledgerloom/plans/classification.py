"""Queries over titles, classes, vectors and retrieval, with their oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.operators import classify, retrieval, views
from ledgerloom.plans.bind import BIND, Tables

QUERIES, ORACLES = {}, {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = f"WITH {BIND}{sql}" if sql.lstrip().startswith(",") else f"WITH {BIND}\n{sql}"
        return f

    return add


#: Rules in the shape of the real ones for the words of the test tables; no look-around, which the oracle's engine lacks.
SUBS = [("Alloy Parts", "METALS", "STEEL|BRASS"), ("Polished Finish", "FINISH", "POLISHED"), ("Economy Lines", "RANGE", "ECONOMY.*(BRASS|STEEL)|^ECONOMY"), ("Standard Lines", "RANGE", "STANDARD"), ("Promo", "SALES", "PROMO")]
TOPS = [("METALS", "COPPER|NICKEL|TIN"), ("FINISH", "ANODIZED|BURNISHED|PLATED"), ("RANGE", ""), ("SALES", "PROMO|SALE"), ("SIZE", "SMALL|MEDIUM|LARGE")]
SUB_SQL = ", ".join(f"CASE WHEN regexp_matches(ttl, '{p}') THEN {{'sub': '{s}', 'parent': '{c}'}} END" for s, c, p in SUBS)
TOP_SQL = ", ".join(f"CASE WHEN regexp_matches(ttl, '{p}') THEN '{c}' END" for c, p in TOPS if p)
CLASSED = f""", named AS (SELECT p_partkey, p_type || ' ' || p_name AS ttl FROM part), h AS (
  SELECT p_partkey, ttl, list_filter([{SUB_SQL}], lambda x: x IS NOT NULL) AS hits, list_filter([{TOP_SQL}], lambda x: x IS NOT NULL) AS tops FROM named), u AS (
  SELECT *, list_concat(list_transform(hits, lambda x: x.parent), tops) AS every FROM h), k AS (
  SELECT p_partkey, ttl, hits, list_filter(every, lambda x, i: list_position(every, x) = i) AS ps FROM u), classed AS (
  SELECT p_partkey, ttl, hits, CASE WHEN len(ps) = 0 THEN ['OTHER'] ELSE ps END AS parents FROM k)
"""
LABELLED = CLASSED.rstrip() + """, labelled AS (
  SELECT p_partkey, CASE WHEN len(hits) > 0 THEN r.parent ELSE r.p END AS category, r.sub AS subcategory FROM (
    SELECT p_partkey, hits, unnest(CASE WHEN len(hits) > 0 THEN list_transform(hits, lambda x: {'sub': x.sub, 'parent': x.parent, 'p': NULL::VARCHAR}) ELSE list_transform(parents, lambda x: {'sub': NULL::VARCHAR, 'parent': x, 'p': x}) END) AS r FROM classed))
"""


def classed(t: Tables):
    titles = t.raw("part").select("p_partkey", F.concat_ws(" ", "p_type", "p_name").alias("title"))
    return classify.classify_titles(titles, "title", SUBS, TOPS)


def labelled(t: Tables):
    return classify.label_rows(classed(t), "p_partkey")


@query("title_rules", CLASSED + "SELECT p_partkey, array_to_string(parents, ', ') AS parent_text, coalesce(array_to_string(list_transform(hits, lambda x: x.sub), ', '), '') AS sub_text FROM classed")
def title_rules(t):
    return classed(t).select("p_partkey", "parent_text", "sub_text")


@query("title_labels", LABELLED + "SELECT p_partkey, category, subcategory FROM labelled")
def title_labels(t):
    return labelled(t)


@query("label_summary", LABELLED + "SELECT category, subcategory, count(*) AS n FROM labelled GROUP BY 1, 2")
def label_summary(t):
    return labelled(t).groupBy("category", "subcategory").agg(F.count(F.lit(1)).alias("n"))


@query("label_pct", LABELLED + "SELECT category, n, CAST(round(CAST(n AS DECIMAL(18,0)) * 100 / sum(n) OVER (), 1) AS DOUBLE) AS pct FROM (SELECT category, count(*) AS n FROM labelled GROUP BY 1)")
def label_pct(t):
    counts = labelled(t).groupBy("category").agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("pct", classify.share_of_total(counts, "n").cast("double"))


@query("classification_stats", CLASSED + "SELECT count(*) AS total, o AS other, count(*) - o AS classified, CAST(round(o * 100.0 / count(*), 1) AS DOUBLE) AS other_pct, CAST(round((count(*) - o) * 100.0 / count(*), 1) AS DOUBLE) AS classified_pct FROM classed, (SELECT count(*) AS o FROM classed WHERE parents = ['OTHER']) GROUP BY o")
def classification_stats(t):
    out = classify.batch_statistics(classed(t))
    return out.withColumns({c: F.col(c).cast("double") for c in ("other_pct", "classified_pct")})


@query("disclosures_classified", LABELLED + """, lab AS (SELECT i.l_orderkey AS id, l.category, l.subcategory, i.l_shipdate AS told FROM lineitem i JOIN labelled l ON l.p_partkey = i.l_partkey)
SELECT d.id, d.title, c.categories, c.subcategories, c.last_labeled_at FROM disclosures d LEFT JOIN (
  SELECT id, '[' || string_agg(DISTINCT '{"en":"' || category || '","jp":' || CASE WHEN category = 'SIZE' THEN 'null' ELSE '"' || lower(category) || '"' END || '}', ',' ORDER BY '{"en":"' || category || '","jp":' || CASE WHEN category = 'SIZE' THEN 'null' ELSE '"' || lower(category) || '"' END || '}') || ']' AS categories,
    '[' || string_agg(DISTINCT '{"en":"' || subcategory || '","jp":"' || lower(subcategory) || '"}', ',' ORDER BY '{"en":"' || subcategory || '","jp":"' || lower(subcategory) || '"}') || ']' AS subcategories, CAST(max(told) AS VARCHAR) AS last_labeled_at FROM lab GROUP BY id) c USING (id)""")
def disclosures_classified(t):
    names = [c for c, _ in TOPS] + ["OTHER"]
    categories = t.literal([(i, c, None if c == "SIZE" else c.lower()) for i, c in enumerate(names)], "id INT, name STRING, name_jp STRING")
    subs = t.literal([(i, s, s.lower()) for i, (s, _, _) in enumerate(SUBS)], "id INT, name STRING, name_jp STRING")
    ids = lambda table, n, i: table.select(F.col("name").alias(n), F.col("id").alias(i))
    rows = labelled(t).join(ids(categories, "category", "category_id"), "category").join(ids(subs, "subcategory", "subcat_id"), "subcategory", "left")
    items = t.raw("lineitem").select(F.col("l_orderkey").alias("disclosure_id"), F.col("l_shipdate").alias("labeled_at"), F.col("l_partkey").alias("p_partkey"))
    labels = items.join(rows, "p_partkey").select("disclosure_id", "category_id", "subcat_id", "labeled_at")
    return views.disclosures_classified(t.disclosures(), labels, categories, subs).select("id", "title", "categories", "subcategories", F.col("last_labeled_at").cast("string").alias("last_labeled_at"))


LADDER = [("earnings_revision", ["blue", "polished"]), ("dividend_change", ["copper"]), ("share_buyback", ["steel"]), ("ma_transaction", ["brass"]), ("split_merger", ["tin"])]


@query("doctype_ladder", "SELECT p_partkey, CASE " + " ".join(f"WHEN {' OR '.join(f'contains(lower(ttl), {w!r})' for w in ws)} THEN '{k}'" for k, ws in LADDER) + " ELSE 'guidance_update' END AS doc_type FROM (SELECT p_partkey, p_type || ' ' || p_name AS ttl FROM part)")
def doctype_ladder(t):
    return t.raw("part").select("p_partkey", classify.document_type(F.concat_ws(" ", "p_type", "p_name"), LADDER).alias("doc_type"))


VEC = """, v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings), q AS (SELECT e AS q FROM v WHERE vec_id = 0), sim AS (
  SELECT vec_id, label, list_dot_product(e, q) / (sqrt(list_dot_product(e, e)) * sqrt(list_dot_product(q, q))) AS score FROM v, q)
"""


def first_vector(t: Tables) -> list[float]:
    return list(t.raw("embeddings").where("vec_id = 0").select("embedding").first()[0])


@query("vector_topk", VEC + "SELECT vec_id, label, round(score, 6) AS score FROM sim WHERE score > 0.01 ORDER BY sim.score DESC, vec_id LIMIT 150")
def vector_topk(t):
    return retrieval.vector_search(t.raw("embeddings"), "vec_id", "embedding", first_vector(t)).select("vec_id", "label", F.round("score", 6).alias("score"))


@query("vector_filtered", VEC + "SELECT vec_id, label, round(score, 6) AS score FROM sim WHERE score > 0.01 AND label IN (1, 3, 5) AND vec_id BETWEEN 10 AND 400 ORDER BY sim.score DESC, vec_id LIMIT 20")
def vector_filtered(t):
    where = retrieval.predicate({"labels": [1, 3, 5], "vec_id": (10, 400), "label": None}, {"labels": "label"})
    return retrieval.vector_search(t.raw("embeddings"), "vec_id", "embedding", first_vector(t), k=20, where=where).select("vec_id", "label", F.round("score", 6).alias("score"))


HITS = VEC + """, hits AS (SELECT vec_id AS id, score, DATE '2024-03-31' - CAST(vec_id % 120 AS INTEGER) AS date, 'title ' || label || CASE WHEN vec_id % 3 = 0 THEN ' revenue' ELSE '' END AS title, CAST(vec_id % 7 AS VARCHAR) AS code FROM sim WHERE score > 0.01 ORDER BY sim.score DESC, vec_id LIMIT 150), r AS (
  SELECT *, row_number() OVER (ORDER BY score DESC, id) AS stage_rank FROM hits), b AS (
  SELECT *, row_number() OVER (PARTITION BY code ORDER BY stage_rank) - 1 AS earlier,
    CASE WHEN DATE '2024-03-31' - date < 30 THEN 0.1::DOUBLE WHEN DATE '2024-03-31' - date < 90 THEN 0.05::DOUBLE ELSE 0::DOUBLE END + CASE WHEN contains(title, 'revenue') THEN 0.05::DOUBLE ELSE 0::DOUBLE END + CASE WHEN contains(title, 'revenue') THEN 0.05::DOUBLE ELSE 0::DOUBLE END AS boost FROM r)
"""


@query("rerank", HITS + "SELECT id, CAST(stage_rank AS INTEGER) AS stage_rank, round(score + boost - CASE WHEN earlier > 2 THEN 0.05::DOUBLE * (earlier - 2) ELSE 0::DOUBLE END, 6) AS final_score FROM b")
def rerank(t):
    hits = retrieval.vector_search(t.raw("embeddings"), "vec_id", "embedding", first_vector(t))
    key = F.col("vec_id")
    title = F.concat(F.lit("title "), F.col("label").cast("string"), F.when(key % 3 == 0, " revenue").otherwise(""))
    hits = hits.select(key.alias("id"), "score", F.date_sub(F.lit("2024-03-31").cast("date"), (key % 120).cast("int")).alias("date"), title.alias("title"), (key % 7).cast("string").alias("code"), F.lit("x").alias("category"))
    return retrieval.rerank(hits, query_type="temporal", terms=["revenue", "revenue"], as_of="2024-03-31").select("id", "stage_rank", F.round("final_score", 6).alias("final_score"))


@query("snippet", r"SELECT doc_id, coalesce(array_to_string(list_filter(list_transform(string_split(left(text, 2000), chr(10)), lambda x: trim(x, ' ' || chr(9) || chr(13))), lambda x: length(x) > 20)[1:3], ' '), '') AS snippet FROM documents")
def snippet(t):
    return t.raw("documents").select("doc_id", retrieval.snippet(F.col("text")).alias("snippet"))


@query("company_stats", "SELECT company_code, count(DISTINCT id) AS n_disclosures, CAST(min(disclosure_date) AS VARCHAR) AS first_date, CAST(max(disclosure_date) AS VARCHAR) AS last_date FROM disclosures GROUP BY 1")
def company_stats(t):
    out = retrieval.company_statistics(t.disclosures())
    return out.withColumns({c: F.col(c).cast("string") for c in ("first_date", "last_date")})


@query("company_breakdown", "SELECT company_code, title, count(*) AS n FROM disclosures WHERE disclosure_date >= DATE '2001-01-01' GROUP BY 1, 2")
def company_breakdown(t):
    return t.disclosures().where(F.col("disclosure_date") >= "2001-01-01").groupBy("company_code", "title").agg(F.count(F.lit(1)).alias("n"))


WORDS = {"finish": ["POLISHED", "PLATED"], "metal": ["STEEL", "BRASS", "TIN"]}


@query("query_terms", """SELECT p_partkey, CASE WHEN ttl LIKE '%compare%' THEN 'comparative' WHEN ttl LIKE '%trend%' THEN 'temporal' ELSE 'simple' END AS query_type,
  array_to_string(list_concat(CASE WHEN contains(lower(ttl), 'finish') THEN ['POLISHED', 'PLATED'] ELSE [] END, list_filter(['POLISHED', 'PLATED'], lambda w: contains(ttl, w) OR contains(lower(ttl), lower(w))), list_filter(['STEEL', 'BRASS', 'TIN'], lambda w: contains(ttl, w) OR contains(lower(ttl), lower(w)))), ',') AS terms
FROM (SELECT p_partkey, p_type || CASE p_partkey % 3 WHEN 0 THEN ' compare finish' WHEN 1 THEN ' trend' ELSE '' END AS ttl FROM part)""")
def query_terms(t):
    key = F.col("p_partkey")
    q = F.concat("p_type", F.when(key % 3 == 0, " compare finish").when(key % 3 == 1, " trend").otherwise(""))
    rows = t.raw("part").select("p_partkey", q.alias("q"))
    return rows.select("p_partkey", retrieval.query_type(F.col("q")).alias("query_type"), F.array_join(retrieval.query_terms(F.col("q"), WORDS), ",").alias("terms"))


CENTROIDS = """, x AS (SELECT label, unnest(range(len(e))) AS i, unnest(e) AS x FROM (SELECT label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings)), m AS (
  SELECT label, i, avg(x) AS x FROM x GROUP BY 1, 2), cen AS (SELECT label, list(x ORDER BY i) AS c FROM m GROUP BY 1), s AS (
  SELECT vec_id, cen.label, list_dot_product(CAST(embedding AS DOUBLE[]), c) / (sqrt(list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[]))) * sqrt(list_dot_product(c, c))) AS sim FROM embeddings, cen), best AS (
  SELECT vec_id, CASE WHEN sim < 0.3 THEN 'Other' ELSE CAST(label AS VARCHAR) END AS category, sim FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY sim DESC, label) AS rn FROM s) WHERE rn = 1)
"""


def nearest(t: Tables):
    vectors = t.raw("embeddings")
    return classify.nearest_centroid(vectors, "vec_id", "embedding", classify.centroids(vectors, "label", "embedding"), "label")


@query("centroid_classify", CENTROIDS + "SELECT vec_id, category, round(sim, 4) AS similarity FROM best")
def centroid_classify(t):
    return nearest(t).select("vec_id", "category", F.round("similarity", 4).alias("similarity"))


@query("centroid_stats", CENTROIDS + "SELECT count(*) AS total, count(*) FILTER (WHERE category = 'Other') AS other, round(avg(sim), 4) AS avg_similarity FROM best")
def centroid_stats(t):
    return nearest(t).agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("category") == "Other").alias("other"), F.round(F.avg("similarity"), 4).alias("avg_similarity"))
