"""URL filter: host and path rules, and a ratio of character Markov models where none applies."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestep.session import stored

# Verdict, host, path.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))

#: Characters before the one predicted, at most.
ORDER = 4
#: Characters of URLs that are scored together, about.
BUCKET_CHARS = 1 << 19
#: Weight of the shorter context's estimate, in observations.
PRIOR = 2.0
#: Scores are compared in steps of this size, from -SPAN to SPAN.
STEP, SPAN = 0.02, 6.0
#: One URL in so many is held out of the counts, to fit the threshold.
HOLD_OUT = 5
CLASSES = ("allow", "block")


def url_host(url) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty if there is none."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_path(url) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def matching_rule(host, path, rules=RULES) -> Column:
    """``struct(rule, verdict)`` of the longest rule that fits, by name if equally long; null if none does."""
    ordered = sorted(rules, key=lambda rule: (-len(rule[1] + rule[2]), rule[1] + rule[2]))
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, own_host, own_path in reversed(ordered):
        fits = ((host == own_host) | host.endswith("." + own_host)) & path.startswith(own_path)
        found = F.when(fits, F.struct(F.lit(own_host + own_path).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def grams(urls: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Each byte with the ``ORDER`` bytes before it as one number, the byte itself lowest; and the URL each belongs to.

    URLs are UTF-8 bytes after ``ORDER`` zero bytes, so a context never reaches into another URL.
    """
    raw = [bytes(ORDER) + url.encode("utf-8", "surrogatepass") for url in urls]
    data = np.frombuffer(b"".join(raw), np.uint8).astype(np.int64)
    lengths = np.array([len(x) for x in raw], np.int64)
    owner = np.repeat(np.arange(len(raw)), lengths)
    inside = np.arange(len(data)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    at = np.flatnonzero(inside >= ORDER)
    gram = np.zeros(len(at), np.int64)
    for back in range(ORDER, -1, -1):
        gram = gram << 8 | data[at - back]
    return gram, owner[at]


def count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``gram`` and how often it stands in URLs of each class, added up per batch."""
    for batch in batches:
        for i in range(0, batch.num_rows, 2_000):
            part = batch.slice(i, 2_000)
            gram, owner = grams(part.column("url").to_pylist())
            found, place = np.unique(gram, return_inverse=True)
            copies = part.column("copies").to_numpy()[owner]
            verdict = np.array(part.column("verdict").to_pylist(), object)[owner]
            counts = [np.bincount(place, copies * (verdict == name), len(found)).astype(np.int64) for name in CLASSES]
            yield pa.RecordBatch.from_arrays([pa.array(found), *map(pa.array, counts)], names=["gram", *CLASSES])


def bucket_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``bucket, gram``: the distinct grams of the URLs of a bucket, per batch."""
    for batch in batches:
        for i in range(0, batch.num_rows, 2_000):
            part = batch.slice(i, 2_000)
            gram, owner = grams(part.column("url").to_pylist())
            found = np.unique(np.stack([part.column("bucket").to_numpy()[owner], gram]), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(found[0]), pa.array(found[1])], names=["bucket", "gram"])


def fit_model(labelled: DataFrame) -> DataFrame:
    """``gram, allow, block``: how often each gram stands in the rows of ``url, verdict, copies``, exactly.

    A row per gram that occurs, so the model grows with the input; the counts of shorter contexts are sums of it.
    """
    return labelled.mapInArrow(count_grams, "gram long, allow long, block long").groupBy("gram").agg(
        *(F.sum(name).alias(name) for name in CLASSES))


def gram_ratios(wanted: DataFrame, model: DataFrame) -> DataFrame:
    """``gram, ratio`` for each of the distinct grams ``wanted``: the byte's log-likelihood after its context under the accepted URLs' model
    less that under the rejected ones'.

    The estimate of each order is its count ratio, smoothed by ``PRIOR`` observations of the next shorter context's.
    Tables keyed by up to two bytes have 65,536 rows at most and are broadcast; the others are joined as Catalyst decides, and one
    key of theirs has 65,536 distinct grams at most.
    """
    def counts(keys, size: int, name: str) -> DataFrame:
        found = model.groupBy(keys.alias(name)).agg(*(F.sum(c).alias(f"{name}_{c}") for c in CLASSES))
        return F.broadcast(found) if size <= 2 else found

    rows = wanted.withColumns({name: F.lit(1 / 256) for name in CLASSES})
    for order in range(ORDER + 1):
        joint = F.col("gram").bitwiseAND(F.lit((1 << 8 * (order + 1)) - 1))
        context = F.shiftright(joint, 8)
        rows = rows.withColumns({"joint": joint, "context": context}).join(counts(joint, order + 1, "joint"), "joint", "left").join(
            counts(context, order, "context"), "context", "left").select("gram", *(
                ((F.coalesce(f"joint_{c}", F.lit(0)) + PRIOR * F.col(c)) / (F.coalesce(f"context_{c}", F.lit(0)) + PRIOR)).alias(c)
                for c in CLASSES))
    return rows.select("gram", (F.log("allow") - F.log("block")).alias("ratio"))


def score_bucket(urls: pa.Table, ratios: pa.Table) -> pa.Table:
    """The rows of a bucket with the mean ratio of each URL's grams, 0 for an empty one."""
    gram, owner = grams(urls.column("url").to_pylist())
    total = np.zeros(urls.num_rows)
    if len(gram):
        known = ratios.column("gram").to_numpy()
        order = np.argsort(known)
        value = ratios.column("ratio").to_numpy()[order]
        total = np.bincount(owner, value[np.searchsorted(known[order], gram)], urls.num_rows)
    size = np.bincount(owner, minlength=urls.num_rows)
    return urls.drop_columns(["bucket"]).append_column("score", pa.array(total / np.maximum(size, 1)))


def scored_urls(rows: DataFrame, model: DataFrame, bucket_chars: int = BUCKET_CHARS) -> DataFrame:
    """``rows``, which have a ``url``, with ``score``.

    Rows are dealt into buckets by hash of all their columns, of some ``bucket_chars`` characters each. A bucket's distinct grams meet the model
    in a join and come back to the bucket, so a gram of every URL has one row per bucket there, and neither
    the model nor the URLs must fit in one task.
    """
    spark = rows.sparkSession
    chars = rows.agg(F.sum(F.length("url"))).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-chars // bucket_chars))
    dealt = rows.withColumn("bucket", F.pmod(F.xxhash64(*rows.columns), F.lit(buckets)))
    wanted = stored(dealt.select("bucket", "url").mapInArrow(bucket_grams, "bucket long, gram long").distinct(), "grams")
    ratios = wanted.join(gram_ratios(wanted.select("gram").distinct(), model), "gram").select("bucket", "gram", "ratio")
    return dealt.groupBy("bucket").cogroup(ratios.groupBy("bucket")).applyInArrow(
        score_bucket, rows.schema.add("score", "double"))


def calibrate(scored: DataFrame) -> float:
    """The score from which on URLs are accepted: the step that parts ``verdict`` best, by the mean of both classes' recall.

    Rows have ``verdict, score, copies``. Of equally good steps the middle one, or 0 without rows of both classes. Scores are counted in a histogram of fixed width.
    """
    bin_of = F.floor((F.greatest(F.lit(-SPAN), F.least(F.lit(SPAN), F.col("score"))) + SPAN) / STEP).cast("int")
    rows = scored.groupBy(bin_of.alias("bin"), "verdict").agg(F.sum("copies").alias("copies")).collect()
    hist = np.zeros((2, round(2 * SPAN / STEP) + 2))
    for row in rows:
        hist[CLASSES.index(row["verdict"]), row["bin"] + 1] += row["copies"]
    if not hist.sum(1).all():
        return 0.0
    allowed = 1 - np.cumsum(hist[0])[:-1] / hist[0].sum()
    blocked = np.cumsum(hist[1])[:-1] / hist[1].sum()
    best = np.flatnonzero(np.isclose(allowed + blocked, (allowed + blocked).max()))
    return float(best[len(best) // 2] * STEP - SPAN)


def judge_urls(pages: DataFrame, rules=RULES, bucket_chars: int = BUCKET_CHARS) -> DataFrame:
    """Per row ``page_id, host, path, rule, verdict, score``: the longest fitting rule's verdict, else the models'.

    URLs that a rule judges teach the models: four in five are counted, the fifth, by a hash of the URL, fits the
    threshold. ``score`` is null where a rule decides. A null or empty url has empty host and path, score 0 and is allowed;
    other columns are ignored. Rows of equal id and url are judged once and returned as often as they stand, null ids
    like any other. Without rules' examples of either kind, all else is allowed.
    """
    host, path = url_host(F.col("url")), url_path(F.col("url"))
    once = pages.select("page_id", F.coalesce("url", F.lit("")).alias("url")).groupBy("page_id", "url").agg(F.count("*").alias("copies"))
    found = matching_rule(F.col("host"), F.col("path"), rules)
    rows = stored(once.withColumns({"host": host, "path": path}).withColumn("found", found).select(
        "page_id", "url", "copies", "host", "path", "found.rule", F.col("found.verdict").alias("verdict")), "urls")
    kept_out = F.pmod(F.xxhash64("url"), F.lit(HOLD_OUT)) == 0
    labelled = F.col("verdict").isNotNull()
    model = stored(fit_model(rows.where(labelled & ~kept_out).select("url", "verdict", "copies")), "model")
    taught = model.agg(*(F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in CLASSES)).first()
    scored = stored(scored_urls(rows.where(~labelled | kept_out), model, bucket_chars), "scored")
    threshold = calibrate(scored.where(labelled))
    fine = F.lit(True) if not all(taught) else (F.col("url") == "") | (F.col("score") >= threshold)
    ruled = rows.where(labelled).withColumn("score", F.lit(None).cast("double"))
    opened = scored.where(~labelled).withColumn("verdict", F.when(fine, "allow").otherwise("block"))
    return ruled.unionByName(opened).select(
        "page_id", "host", "path", "rule", "verdict", "score", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")).drop("copy")
