"""Queries of nearest entries: every vector against the mean vector of each label."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestep.catalog.registry import Tables, query
from lodestep.operators import nearest, validation

SCORES = """
spread AS (SELECT label, unnest(generate_series(1, len(embedding))) AS i, unnest(embedding) AS v FROM embeddings),
means AS (SELECT label, i, avg(CAST(v AS double)) AS m FROM spread GROUP BY label, i),
centres AS (SELECT label AS entry_id, list(m ORDER BY i) AS centre FROM means GROUP BY label),
scores AS (SELECT vec_id, e.label, entry_id, list_cosine_similarity(CAST(embedding AS double[]), centre) AS sim FROM embeddings e, centres),
ranked AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY sim DESC, entry_id) AS place FROM scores),
best AS (SELECT vec_id, max(sim) FILTER (WHERE place = 1) AS first, max(sim) FILTER (WHERE place = 2) AS second,
  max(entry_id) FILTER (WHERE place = 1) AS entry_id FROM ranked GROUP BY vec_id)"""


def vectors(tables: Tables) -> DataFrame:
    return tables.embeddings.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector"), "label")


def centres(tables: Tables) -> DataFrame:
    """``entry_id, vector``: the mean vector of each label."""
    cells = tables.embeddings.select("label", F.posexplode("embedding").alias("i", "v"))
    means = cells.groupBy("label", "i").agg(F.avg(F.col("v").cast("double")).alias("m"))
    ordered = F.array_sort(F.collect_list(F.struct("i", "m")))
    return means.groupBy("label").agg(F.transform(ordered, lambda x: x["m"]).alias("vector")).select(
        F.col("label").cast("long").alias("entry_id"), "vector")


@query("nearest_with_margin", f"""WITH {SCORES}
SELECT vec_id, CAST(entry_id AS bigint) AS entry_id, round(first, 4) AS similarity FROM best WHERE first >= 0.35 AND first - second >= 0.02""")
def nearest_with_margin(tables: Tables) -> DataFrame:
    found = nearest.accepted(nearest.nearest_entries(vectors(tables), centres(tables)), threshold=0.35, margin=0.02)
    return found.select(F.col("query_id").alias("vec_id"), "entry_id", F.round("similarity", 4).alias("similarity"))


@query("best_entry", f"""WITH {SCORES}
SELECT vec_id, CAST(entry_id AS bigint) AS entry_id, round(first, 4) AS similarity FROM best WHERE first >= 0.3""")
def best_entry(tables: Tables) -> DataFrame:
    found = nearest.best_entry(vectors(tables), centres(tables), threshold=0.3)
    return found.select(F.col("query_id").alias("vec_id"), "entry_id", F.round("similarity", 4).alias("similarity"))


@query("top_n_accuracy", f"""WITH {SCORES}
SELECT count(*) AS n_items, round(avg(CAST(place <= 1 AS int)), 6) AS top_1, round(avg(CAST(place <= 3 AS int)), 6) AS top_3
FROM ranked WHERE entry_id = label""")
def top_n_accuracy(tables: Tables) -> DataFrame:
    hits = nearest.long_form(nearest.nearest_entries(vectors(tables), centres(tables), k=3)).select(
        F.col("query_id").alias("item_id"), "place", F.col("entry_id").alias("skill_id"))
    labels = vectors(tables).select(F.col("query_id").alias("item_id"), F.col("label").cast("long").alias("expected_skill_id"))
    return validation.top_n_accuracy(hits, labels).select(
        "n_items", F.round("top_1", 6).alias("top_1"), F.round("top_3", 6).alias("top_3"))
