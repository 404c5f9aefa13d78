"""Nearest dictionary entries by cosine similarity, exact.

Vectors are an input column; nothing is embedded here. Queries are multiplied with the dictionary
block by block, and only the best few of each query leave a task, never the pairs.

A dictionary larger than a block is dealt out by its nearest pivot and cut into rings of equal angle around it. The angle is a
metric, so an entry of a ring is no nearer to a query than the ring is, seen from the pivot. Each query meets its most promising
blocks first, as many as hold enough entries; of the others only those that may hold an entry as good as its worst so far.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestep.functions import fixed_values as fixed
from lodestep.operators.ordered import numbered
from lodestep.session import cut_lineage

_FOUND = "row long, entries array<long>, similarities array<double>"
MATRIX_BYTES = 128 << 20
SCORE_BYTES = 64 << 20
MOST_PIVOTS = 256
#: Similarities closer than this count as equal, so that block sizes do not decide between equal entries.
_DIGITS = 12


def _unit(vectors: pd.Series) -> np.ndarray:
    matrix = np.asarray(vectors.tolist(), dtype=np.float64).reshape(len(vectors), -1)
    length = np.linalg.norm(matrix, axis=1, keepdims=True)
    return matrix / np.where(length == 0, 1, length)


def _best(queries: pd.DataFrame, entry_ids: np.ndarray, matrix: np.ndarray, k: int) -> pd.DataFrame:
    """Best ``k`` entries of each query; of equal similarities the lowest entry id leads.

    ``entry_ids`` ascend, and argmax takes the first maximum. The scores held at once are bounded in bytes.
    """
    k = min(k, len(entry_ids))
    step = max(1, SCORE_BYTES // (8 * max(1, len(entry_ids))))
    ids, values = [], []
    for start in range(0, len(queries), step):
        unit = _unit(queries["vector"].iloc[start:start + step])
        scores = np.round(unit @ matrix.T, _DIGITS)
        rows = np.arange(len(scores))
        picked = np.empty((len(scores), k), np.int64)
        top = np.empty((len(scores), k))
        for j in range(k):
            place = scores.argmax(axis=1)
            picked[:, j], top[:, j] = entry_ids[place], scores[rows, place]
            scores[rows, place] = -np.inf
        ids += list(picked)
        values += list(top)
    return pd.DataFrame({"row": queries["row"].to_numpy(), "entries": ids, "similarities": values})


def nearest_entries(queries: DataFrame, dictionary: DataFrame, k: int = 2,
                    matrix_bytes: int = MATRIX_BYTES) -> DataFrame:
    """``query_id, entries, similarities`` with the best ``k`` entries in descending order, one row per query row.

    ``queries`` holds ``query_id, vector`` and ``dictionary`` ``entry_id, vector`` (ids once each). The rows are the same whatever
    ``matrix_bytes``, the size of a block. A query without a vector, with nulls in it or of another length has empty
    lists; such entries are left out.
    """
    return nearest_with_visits(queries, dictionary, k, matrix_bytes)[0]


def nearest_with_visits(queries: DataFrame, dictionary: DataFrame, k: int = 2,
                        matrix_bytes: int = MATRIX_BYTES) -> tuple[DataFrame, DataFrame]:
    """:func:`nearest_entries`, and one row ``n_blocks, possible, visited``: meetings of a query and a block that there may be, and that took place."""
    spark = queries.sparkSession
    whole = F.col("vector").isNotNull() & ~F.exists(F.coalesce("vector", F.array()), lambda x: x.isNull())
    entries = dictionary.select(F.col("entry_id").cast("long"), F.col("vector").cast("array<double>")).filter(whole)
    count, width = entries.agg(F.count("*"), F.coalesce(F.max(F.size("vector")), F.lit(0))).first()
    fits = whole & (F.size("vector") == width) & (F.lit(count) > 0)
    rows = cut_lineage(queries.select(F.col("query_id").cast("long"), F.col("vector").cast("array<double>")).withColumn(
        "row", F.monotonically_increasing_id()))
    asked = rows.filter(fits).select("row", "vector")
    entries = entries.filter(F.size("vector") == width)
    block_rows = max(1, matrix_bytes // (8 * max(1, width)))
    if count <= block_rows:
        found = _against_broadcast(asked, entries, k) if count else asked.select("row").limit(0).selectExpr(
            "row", "cast(null as array<long>) AS entries", "cast(null as array<double>) AS similarities")
        visits = asked.agg(F.lit(int(count > 0)).alias("n_blocks"), F.count("*").alias("possible"), F.count("*").alias("visited"))
    else:
        found, visits = _against_blocks(asked, entries, k, block_rows, count)
    none = {"entries": F.array().cast("array<long>"), "similarities": F.array().cast("array<double>")}
    return rows.select("query_id", "row").join(found, "row", "left").select(
        "query_id", *[F.coalesce(name, empty).alias(name) for name, empty in none.items()]), visits


def _against_broadcast(queries: DataFrame, dictionary: DataFrame, k: int) -> DataFrame:
    table = dictionary.toPandas().sort_values("entry_id")
    held = queries.sparkSession.sparkContext.broadcast(
        (table["entry_id"].to_numpy(), _unit(table["vector"])))

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        entry_ids, matrix = held.value
        for batch in batches:
            yield _best(batch, entry_ids, matrix, k)

    return queries.mapInPandas(search, _FOUND)


def _angles(vectors: pd.Series, pivots: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(_unit(vectors) @ pivots.T, -1, 1))


def _in_rings(entries: DataFrame, pivots, block_rows: int) -> DataFrame:
    """Entries with their ``block``: the nearest pivot, and a ring of ``block_rows`` entries by angle around it."""
    def dealt(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            angles = _angles(batch["vector"], pivots.value)
            yield batch.assign(pivot=angles.argmin(axis=1).astype(np.int32), angle=angles.min(axis=1))

    near = entries.mapInPandas(dealt, "entry_id long, vector array<double>, pivot int, angle double")
    ring = F.floor((F.col("place") - 1) / block_rows)
    return cut_lineage(numbered(near, "pivot", "angle", "entry_id").withColumn("block", F.concat_ws("/", "pivot", ring)).drop("place"))


def _against_blocks(queries: DataFrame, dictionary: DataFrame, k: int, block_rows: int, count: int) -> tuple[DataFrame, DataFrame]:
    context = queries.sparkSession.sparkContext
    n_pivots = min(MOST_PIVOTS, ceil(count / block_rows))
    chosen = dictionary.orderBy(F.xxhash64("entry_id"), "entry_id").limit(n_pivots).toPandas()
    pivots = context.broadcast(_unit(chosen["vector"]))
    blocks = _in_rings(dictionary, pivots, block_rows)
    rings = blocks.groupBy("block", "pivot").agg(F.min("angle").alias("low"), F.max("angle").alias("high"), F.count("*").alias("n")).orderBy("block").toPandas()
    table = context.broadcast([rings[name].to_numpy() for name in ("block", "pivot", "low", "high", "n")])

    def reach(vectors: pd.Series) -> np.ndarray:
        """The least angle at which an entry of each block can stand."""
        _, pivot, low, high, _ = table.value
        angles = _angles(vectors, pivots.value)[:, pivot]
        return np.maximum(0, np.maximum(angles - high, low - angles))

    def promising(angles: np.ndarray) -> np.ndarray:
        """Which blocks each query opens with: the nearest ones that hold ``k`` entries together."""
        order = np.argsort(angles, axis=1, kind="stable")
        held = np.cumsum(table.value[4][order], axis=1)
        opened = np.zeros(angles.shape, bool)
        np.put_along_axis(opened, order, np.column_stack([np.ones(len(order), bool), held[:, :-1] < k]), axis=1)
        return opened

    def meetings(part: pd.DataFrame, wanted: np.ndarray) -> pd.DataFrame:
        which, block = np.nonzero(wanted)
        return part[["row", "vector"]].iloc[which].assign(block=table.value[0][block])

    def first(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for start in range(0, len(batch), 1_000):
                part = batch.iloc[start:start + 1_000]
                yield meetings(part, promising(reach(part["vector"])))

    def others(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for start in range(0, len(batch), 1_000):
                part = batch.iloc[start:start + 1_000]
                angles = reach(part["vector"])
                yield meetings(part, (np.cos(angles) + 1e-9 >= part["worst"].to_numpy()[:, None]) & ~promising(angles))

    to_meet = "row long, vector array<double>, block string"
    opening = cut_lineage(queries.mapInPandas(first, to_meet))
    best = cut_lineage(_meet(opening, blocks, k, block_rows))
    so_far = F.sort_array(F.flatten(F.collect_list("similarities")), asc=False)
    worst = best.groupBy("row").agg(F.coalesce(F.get(so_far, F.lit(k - 1)), F.lit(-2.0)).alias("worst"))
    further = cut_lineage(queries.join(worst, "row").mapInPandas(others, to_meet))
    partial = best.unionByName(_meet(further, blocks, k, block_rows))
    ranked = partial.select("row", F.explode(F.arrays_zip("entries", "similarities")).alias("_hit")).select("row", "_hit.*").withColumn(
        "place", F.row_number().over(Window.partitionBy("row").orderBy(F.desc("similarities"), "entries"))).filter(F.col("place") <= k)
    listed = F.array_sort(F.collect_list(F.struct("place", "entries", "similarities")))
    found = ranked.groupBy("row").agg(listed.alias("_best")).select(
        "row", F.col("_best.entries").alias("entries"), F.col("_best.similarities").alias("similarities"))
    met = opening.select("row").unionByName(further.select("row")).agg(F.count("*").alias("visited"))
    visits = queries.agg(F.lit(len(rings)).alias("n_blocks"), (F.count("*") * len(rings)).alias("possible")).withColumn(
        "visited", met.scalar())
    return found, visits


def _meet(wanted: DataFrame, blocks: DataFrame, k: int, block_rows: int) -> DataFrame:
    """Best entries of each query in each block it asks for; a block that many ask for meets them in slices of bounded size."""
    asked = wanted.groupBy("block").agg(F.ceil(F.count("*") / block_rows).cast("int").alias("slices"))
    left = wanted.join(asked, "block").withColumn("slice", F.pmod(F.xxhash64("row"), F.col("slices")).cast("int")).drop("slices")
    right = blocks.select("entry_id", "vector", "block").join(asked, "block").withColumn(
        "slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1))).drop("slices")

    def meet(mine: pd.DataFrame, theirs: pd.DataFrame) -> pd.DataFrame:
        if mine.empty or theirs.empty:
            return pd.DataFrame({"row": [], "entries": [], "similarities": []})
        theirs = theirs.sort_values("entry_id")
        return _best(mine, theirs["entry_id"].to_numpy(), _unit(theirs["vector"]), k)

    return left.groupBy("block", "slice").cogroup(right.groupBy("block", "slice")).applyInPandas(meet, _FOUND)


def long_form(nearest: DataFrame) -> DataFrame:
    """``query_id, place, entry_id, similarity``, one row per entry found."""
    return nearest.select("query_id", F.posexplode(F.arrays_zip("entries", "similarities")).alias("_pos", "_hit")).select(
        "query_id", (F.col("_pos") + 1).alias("place"), F.col("_hit.entries").alias("entry_id"),
        F.col("_hit.similarities").alias("similarity"))


def accepted(nearest: DataFrame, threshold: float = fixed.NEAREST_LABEL_MIN,
             margin: float = fixed.NEAREST_LABEL_MARGIN) -> DataFrame:
    """``query_id, entry_id, similarity`` where the best is good enough and clear of the second.

    Without a second entry its similarity counts as -1.
    """
    best = F.get("similarities", F.lit(0))
    second = F.coalesce(F.get("similarities", F.lit(1)), F.lit(-1.0))
    return nearest.filter((best >= threshold) & (best - second >= margin)).select(
        "query_id", F.get("entries", F.lit(0)).alias("entry_id"), best.alias("similarity"))


def best_entry(queries: DataFrame, dictionary: DataFrame, threshold: float = fixed.SEMANTIC_MIN) -> DataFrame:
    """The single best entry of each query that reaches ``threshold``."""
    return accepted(nearest_entries(queries, dictionary, k=1), threshold, margin=0.0)
