"""Near-duplicate documents by a chosen-path set similarity join over minwise tokens."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestep.llm.components import components
from lodestep.session import stored

SHINGLE = 5
#: Minwise tokens per set; each is the smallest under a hash function of its own.
SKETCH = 96
#: Independent trees: the first level has one node per tree and minwise token.
TREES = 12
#: Branches of a large node, and the tokens that must agree along a branch.
BRANCHES = 8
PATH = 3
#: Nodes with up to so many members outside their most frequent component are compared exhaustively.
SMALL = 16
#: The smallest similarity that candidates are searched for.
LEAST_PERCENT = 75
#: Least estimated similarity of a pair worth an exact comparison: 5 standard deviations below 0.75.
ESTIMATE = 0.53
#: Marks by which those are chosen of which one leads a large node.
VOTES = 16
#: Set sizes in classes: the first size of each, some 5 % above the last one's.
SIZES = np.unique(np.ceil(1.05 ** np.arange(600)).astype(np.int64))

SKETCHES = "doc_id long, text_hash long, n long, digest string, roots array<int>, marks array<tinyint>"


def shingle_hashes(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word sequences of length five; all words as one if there are fewer."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < SHINGLE:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words))], np.uint64)
    line = b" ".join(words)
    ends = np.cumsum([len(word) + 1 for word in words])
    starts = (ends - [len(word) + 1 for word in words])[: len(words) - SHINGLE + 1].tolist()
    digest = xxhash.xxh3_64_intdigest
    return np.unique(np.fromiter((digest(line[i:j]) for i, j in zip(starts, (ends[SHINGLE - 1:] - 1).tolist())),
                                 np.uint64, len(starts)))


def multipliers() -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(20240501)
    return random.integers(1, 2**63, SKETCH, np.uint64) * np.uint64(2) + np.uint64(1), random.integers(0, 2**63, SKETCH, np.uint64)


def sketch(hashes: np.ndarray, factors: np.ndarray, terms: np.ndarray) -> np.ndarray:
    """The smallest value of a set under each hash function, as 32 bits that name the minwise token.

    Of the first ``TREES`` all bits are kept, the roots; of each the last byte, its mark: unlike tokens have the same mark once in
    256 cases, which raises an estimate a little and so loses nothing.
    """
    lowest = np.full(SKETCH, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(hashes), 4096):
        part = hashes[i:i + 4096, None] * factors + terms
        part ^= part >> np.uint64(32)
        part *= np.uint64(0x9E3779B97F4A7C15)
        lowest = np.minimum(lowest, part.min(0))
    return (lowest >> np.uint64(32)).astype(np.uint32).view(np.int32)


def sketch_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    factors, terms = multipliers()
    for batch in batches:
        for i in range(0, batch.num_rows, 256):
            part = batch.slice(i, 256)
            sets = [shingle_hashes(text) for text in part.column("text").to_pylist()]
            tokens = [sketch(x, factors, terms) if len(x) else np.empty(0, np.int32) for x in sets]
            yield pa.RecordBatch.from_arrays([
                part.column("doc_id"), part.column("text_hash"), pa.array([len(x) for x in sets], pa.int64()),
                pa.array([xxhash.xxh3_128_hexdigest(x.tobytes()) for x in sets]),
                pa.array([x[:TREES].tolist() for x in tokens], pa.list_(pa.int32())),
                pa.array([x.astype(np.int8).tolist() for x in tokens], pa.list_(pa.int8())),
            ], names=["doc_id", "text_hash", "n", "digest", "roots", "marks"])


def set_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The whole sets of ``member, text``."""
    for batch in batches:
        for i in range(0, batch.num_rows, 256):
            part = batch.slice(i, 256)
            sets = [shingle_hashes(text) for text in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([
                part.column("member"), pa.array([len(x) for x in sets], pa.int64()),
                pa.array([x.tobytes() for x in sets], pa.binary()),
            ], names=["member", "n", "shingles"])


def overlap_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pairs = zip(batch.column("left").to_pylist(), batch.column("right").to_pylist())
        shared = [len(np.intersect1d(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), True)) for x, y in pairs]
        yield pa.RecordBatch.from_arrays([
            batch.column("a"), batch.column("b"), batch.column("n_a"), batch.column("n_b"), pa.array(shared, pa.int64()),
        ], names=["a", "b", "n_a", "n_b", "shared"])


def token_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``member, label, n, shingles`` -> ``member, label, n, token``, a row per shingle."""
    for batch in batches:
        for i in range(0, batch.num_rows, 256):
            part = batch.slice(i, 256)
            n = part.column("n").to_numpy()
            yield pa.RecordBatch.from_arrays([
                *(pa.array(np.repeat(part.column(name).to_numpy(), n)) for name in ("member", "label", "n")),
                pa.array(np.frombuffer(b"".join(part.column("shingles").to_pylist()), np.int64)),
            ], names=["member", "label", "n", "token"])


def prefixes(n: int, tokens: np.ndarray, least: np.ndarray, most: np.ndarray, percent: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """For each class of partners' sizes: the class of ``n``, that class, and the tokens of the prefix.

    ``tokens`` are those of a set of ``n`` that others have as well, the rarest first, ``least`` and ``most`` the smallest and the
    largest of all sets that have them. A partner of a class shares ``percent / (100 + percent)`` of both sizes' sum or more, so
    it has one of all but so many of the rarest tokens, itself among all but so many of its own.
    """
    own = int(np.searchsorted(SIZES, n, "right")) - 1
    smallest, largest = -(-percent * n // 100), 100 * n // percent
    classes = np.searchsorted(SIZES, [smallest, largest], "right") - 1
    alone = n - len(tokens)
    for other in range(int(classes[0]), int(classes[1]) + 1):
        size = max(smallest, int(SIZES[other]))
        length = n + 1 + percent * (n + size) // -(100 + percent) - alone
        if length > 0:
            use = (least[:length] < SIZES[other + 1]) & (most[:length] >= size)
            if use.any():
                yield own, other, tokens[:length][use]


def prefix_nodes(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``node, member, label, side``: members of ``members`` (``member, label``) by the rarest shingles of their ``sets`` (``member, n, shingles``).

    A node is a shingle and two classes of sizes; ``side`` is 0 if they are the same, else it tells the smaller sets (1) from the
    greater (2), and only sets of unlike sides need to meet there. Any two that share ``percent`` of their union meet in a node, exactly: by the prefixes of their shingles, the
    rarest among these members first. Shingles that only one label has make none, so texts around a common core
    that are too far from it meet only where they have something else in common.
    """
    tokens = stored(sets.join(members, "member").select("member", "label", "n", "shingles").mapInArrow(
        token_batches, "member long, label long, n long, token long"), "tokens")
    common = tokens.groupBy("token").agg(
        F.count("*").alias("held"), F.min("n").alias("least"), F.max("n").alias("most"),
        (F.min("label") < F.max("label")).alias("several")).where("held > 1")
    listed = tokens.join(common, "token").groupBy("member", "label", "n").agg(
        F.array_sort(F.collect_list(F.struct("held", "token", "several", "least", "most"))).alias("tokens"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 64):
                part = batch.slice(i, 64)
                found: list[tuple] = []
                for member, label, n, all_tokens in zip(*(part.column(name) for name in ("member", "label", "n", "tokens"))):
                    held = all_tokens.values
                    token, several, least, most = (held.field(name).to_numpy(zero_copy_only=False) for name in ("token", "several", "least", "most"))
                    # A token of one label takes its place in the prefix but makes no node: no set is as large as it asks for.
                    most = np.where(several, most, 0)
                    for own, other, chosen in prefixes(n.as_py(), token, least, most, percent):
                        side = 0 if own == other else 1 if own < other else 2
                        found.append((member.as_py(), label.as_py(), min(own, other), max(own, other), side, chosen))
                if found:
                    counts = [len(x[5]) for x in found]
                    columns = [np.repeat(np.array([x[k] for x in found], np.int64), counts) for k in range(5)]
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns] + [pa.array(np.concatenate([x[5] for x in found]))],
                                                     names=["member", "label", "low", "high", "side", "token"])

    return listed.mapInArrow(run, "member long, label long, low long, high long, side long, token long").select(
        F.xxhash64("token", "low", "high").alias("node"), "member", "label", "side")


def across(rows: DataFrame, small: int) -> tuple[DataFrame, DataFrame]:
    """``a, b``: pairs of different components and unlike sides, and the ``node, member, label`` of nodes where they are too many.

    Those of a node are too many if they are more than ``small`` times its size; only there do members of one side meet as well.
    """
    counts = [F.count_if(F.col("side") == side).alias(f"on_{side}") for side in (1, 2)]
    nodes = rows.groupBy("node", "label").agg(F.count("*").alias("held"), *counts).groupBy("node").agg(
        F.max(F.struct("held", "label", "on_1", "on_2")).alias("most"), F.count("*").alias("labels"),
        *(F.sum(f"on_{side}").alias(f"on_{side}") for side in (1, 2))).where("labels > 1 and on_1 > 0 and on_2 > 0")
    met = nodes.selectExpr("node", "most.label common", f"(on_1 - most.on_1) * on_2 + (on_2 - most.on_2) * on_1 <= {small} * (on_1 + on_2) few")
    placed = stored(rows.join(met, "node"), "sides")
    few = placed.where("few")
    rare = few.where("label <> common").select("node", F.col("member").alias("one"), F.col("label").alias("rare_label"), F.col("side").alias("rare_side"))
    pairs = rare.join(few, "node").where("rare_side <> side and rare_label <> label").select(
        F.least("one", "member").alias("a"), F.greatest("one", "member").alias("b"))
    return pairs, placed.where("not few").select("node", "member", "label")


def agreement(left: str, right: str):
    """The share of marks two sketches have in common: an estimate of their Jaccard similarity."""
    return F.size(F.filter(F.zip_with(left, right, lambda x, y: x == y), lambda same: same)) / F.lit(SKETCH)


def agreeing(voters: DataFrame) -> DataFrame:
    """``node, member, agree``: how many of a member's ``head`` are the most frequent ones of their places in the node."""
    votes = voters.select("node", F.posexplode("head").alias("place", "mark")).groupBy("node", "place", "mark").count()
    winners = votes.groupBy("node", "place").agg(F.max(F.struct("count", "mark")).alias("most")).groupBy("node").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("place", "most.mark"))), lambda x: x["mark"]).alias("majority"))
    agree = F.size(F.filter(F.zip_with("head", "majority", lambda x, y: x == y), lambda same: same))
    return voters.join(winners, "node").select("node", "member", agree.alias("agree"))


def with_leaders(large: DataFrame, narrow: DataFrame) -> DataFrame:
    """``node, member, label, leader``: the leader agrees most with the most frequent marks of the node's members.

    So the text that others are copies of leads, if it is among them, and most copies are linked to it at once. The members
    that agree most in a few marks vote again, by all marks: many copies agree in a few, but a copy of the text
    leaves those unlinked that the text itself links.
    """
    voters = stored(large.join(narrow.select("member", F.slice("marks", 1, VOTES).alias("head")), "member"), "voters")
    first = stored(agreeing(voters), "agreed")
    best = first.join(first.groupBy("node").agg(F.max("agree").alias("most")), "node").where("agree = most").select("node", "member")
    finalists = stored(best.join(narrow.select("member", F.col("marks").alias("head")), "member"), "finalists")
    leaders = agreeing(finalists).groupBy("node").agg(
        F.max(F.struct("agree", F.xxhash64("node", "member").alias("tie"), "member")).alias("best"))
    return stored(voters.drop("head").join(leaders.select("node", F.col("best.member").alias("leader")), "node"), "led")


def several_components(rows: DataFrame) -> DataFrame:
    """``node, member, label, size, common, others``: nodes whose members lie in several components.

    ``label`` is a member's component as far as known, ``common`` the most frequent one in the node, ``others`` how many have another.
    """
    nodes = rows.groupBy("node", "label").count().groupBy("node").agg(
        F.sum("count").alias("size"), F.max(F.struct("count", "label")).alias("most"), F.count("*").alias("labels")).where("labels > 1")
    return stored(rows.join(nodes.select(
        "node", "size", F.col("most.label").alias("common"), (F.col("size") - F.col("most.count")).alias("others")), "node"), "placed")


def exhaustive(placed: DataFrame, small: int) -> DataFrame:
    """``a, b``: pairs of different components in nodes where at most ``small`` members are outside the most frequent one.

    At most ``small`` times a node's size, however many members the frequent component has.
    """
    few = placed.where(F.col("others") <= small)
    rare = few.where("label <> common").select("node", F.col("member").alias("one"), F.col("label").alias("rare_label"))
    return rare.join(few.select("node", "member", "label", "common"), "node").where(
        "rare_label <> label and (label = common or one < member)").select(
        F.least("one", "member").alias("a"), F.greatest("one", "member").alias("b"))


def hub_pairs(alike: DataFrame, least: float = 0.75) -> DataFrame:
    """``a, b``: each member with the best of its candidates, if that is better than itself: the one with most candidates.

    Only candidates estimated at ``least`` count. In a group of copies most choose one and the same, so as many
    comparisons as members put most groups together. Better is an order, so there are no cycles.
    """
    close = alike.where(F.col("estimate") >= least)
    ends = close.select("a", "b").union(close.select(F.col("b"), F.col("a")))
    rank = ends.groupBy(F.col("a").alias("member")).agg(F.struct(F.count("*").alias("links"), (-F.col("a")).alias("tie")).alias("rank"))
    other = rank.select(F.col("member").alias("b"), F.col("rank").alias("other_rank"))
    return ends.join(rank.withColumnRenamed("member", "a"), "a").join(other, "b").where("other_rank > rank").groupBy("a").agg(
        F.max(F.struct("other_rank", "b")).alias("best")).select("a", F.col("best.b").alias("b"))


def links_of(sets: DataFrame, confirm: Callable[[DataFrame], DataFrame], whole: Callable[[DataFrame], DataFrame],
             percent: int = LEAST_PERCENT, small: int = SMALL) -> list[DataFrame]:
    """Tables of links between rows of ``member, n, roots, marks`` that together have the components of all links.

    ``confirm`` compares pairs ``a, b``, ``whole`` gives the whole sets ``member, n, shingles`` of a table of ``member``.

    The root branches into a node per tree and minwise token. In each level ``confirm`` compares the candidates' whole sets, and
    the components of all links so far are found: pairs within one need no comparing, so a node whose members lie in
    one component is done. A node with up to ``small`` members outside its most frequent component compares
    those with all others. A larger one compares all with one member, its leader, the one most like the majority;
    the others meet again by the prefixes of their whole sets (:func:`prefix_nodes`), which parts the many texts around a common core
    that are not alike enough. What is still large then branches along ``BRANCHES`` paths, each of ``PATH`` further
    tokens chosen by the node's level (one more from the third level on), so unlike members that share a passage part, until no
    node is left. Of a level's candidates each member's best is compared first; then only those that this has not put together.

    A pair of similarity 0.75 meets in 9 of 12 nodes of the first level on average, and in none with probability 6e-8; in a
    node of a prefix always; branches part it with probability 0.01 in each large node.
    """
    narrow = sets.select("member", "n", "marks")
    level, found, tried, labels, more = 1, [], None, None, None
    rows = sets.select("member", F.posexplode("roots").alias("tree", "token")).select(
        F.xxhash64("tree", "token").alias("node"), "member", F.col("member").alias("label"))
    while True:
        left = narrow.select(F.col("member").alias("a"), F.col("n").alias("n_a"), F.col("marks").alias("left"))
        right = narrow.select(F.col("member").alias("b"), F.col("n").alias("n_b"), F.col("marks").alias("right"))
        placed = several_components(rows)
        large = with_leaders(placed.where(F.col("others") > small).select("node", "member", "label"), narrow)
        leaders = large.where("member = leader").select("node", F.col("label").alias("leader_label"))
        led = large.join(leaders, "node").where("label <> leader_label").select(
            F.least("member", "leader").alias("a"), F.greatest("member", "leader").alias("b"))
        pairs = exhaustive(placed, small).union(led)
        pairs = (pairs if more is None else pairs.union(more)).distinct()
        more = None
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        alike = stored(pairs.join(left, "a").join(right, "b").where(
            F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * 75).withColumn(
            "estimate", agreement("left", "right")).where(F.col("estimate") >= ESTIMATE).select("a", "b", "estimate"), "pairs")
        tried = alike.select("a", "b") if tried is None else tried.union(alike.select("a", "b"))
        fresh = []
        if not alike.isEmpty():
            hubs, others = stored(hub_pairs(alike), "hubs"), alike.select("a", "b")
            if not hubs.isEmpty():
                fresh.append(confirm(hubs))
                # Whom two confirmed steps lead to: members with the same one are in one component already.
                up = fresh[0].select(F.col("a").alias("member"), F.col("b").alias("hub"))
                top = up.join(up.select(F.col("member").alias("hub"), F.col("hub").alias("next")), "hub", "left").select(
                    "member", F.coalesce("next", "hub").alias("top"))
                through = [top.select(F.col("member").alias(end), F.col("top").alias(f"top_{end}")) for end in "ab"]
                met = hubs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                others = others.join(met, ["a", "b"], "left_anti").join(through[0], "a", "left").join(through[1], "b", "left")
                others = stored(others.where(F.coalesce("top_a", "a") != F.coalesce("top_b", "b")).select("a", "b"), "others")
            if not others.isEmpty():
                fresh.append(confirm(others))
            fresh = [more for more in fresh if not more.isEmpty()]
            found += fresh
        rest = large.where("member <> leader").select("node", "member", "label")
        if rest.isEmpty():
            break
        if fresh:
            # Stars of the components so far stand for the links they came from.
            joined = [links.select("a", "b") for links in fresh]
            if labels is not None:
                joined.append(labels.select(F.col("id").alias("a"), F.col("component").alias("b")))
            labels = stored(components(reduce(DataFrame.union, joined)), "labels")
            rest = rest.join(labels.withColumnRenamed("id", "member"), "member", "left").select(
                "node", "member", F.coalesce("component", "label").alias("label"))
        level += 1
        width = PATH + max(0, level - 3)

        def path(branch: int, at: int = level, tokens: int = width):
            picks = np.random.default_rng([at, branch]).choice(SKETCH, tokens, replace=False)
            return F.xxhash64("node", F.lit(branch), *(F.get("marks", F.lit(int(i))) for i in picks))

        # Nodes done by the new links do not branch.
        open_nodes = several_components(rest).select("node", "member", "label")
        # Only what is still open moves in the next level.
        narrow = stored(narrow.join(stored(open_nodes.select("member").distinct(), "open"), "member", "left_semi"), "sketches")
        if level == 2:
            members = stored(open_nodes.select("member", "label").distinct(), "members")
            sided = stored(prefix_nodes(members, whole(members.select("member")), percent), "prefixes")
            more, mixed = across(sided.where("side > 0"), small)
            rows = sided.where("side = 0").select("node", "member", "label").union(mixed)
            continue
        rows = stored(open_nodes.join(narrow.select("member", "marks"), "member").select(
            F.explode(F.array(*(path(i) for i in range(BRANCHES)))).alias("node"), "member", "label"), "branches")
    return found


def near_links(docs: DataFrame, percent: int = 75) -> tuple[DataFrame, DataFrame]:
    """Classes and links: ``doc_id, text_hash, n, member`` per row, and ``a, b, n_a, n_b, shared`` per confirmed link of unlike sets.

    Rows with equal shingle sets form a class, known by its smallest id; ``member`` is that id, null without
    shingles. Links are pairs of classes whose sets share ``percent`` of their union or more, confirmed on whole sets;
    pairs that others have put into one component before they met are left out. The trees and the estimate are laid out for 75 % and
    more; a smaller ``percent`` would lose links, so it is refused.
    """
    if percent < LEAST_PERCENT:
        raise ValueError(f"percent must be {LEAST_PERCENT} or more, not {percent}")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    sketched = stored(texts.mapInArrow(sketch_batches, SKETCHES), "sets")
    # An id may stand for several rows with several texts; the hash tells which is the class's.
    classes = stored(sketched.where("n > 0 and doc_id is not null").groupBy("digest", "n").agg(
        F.min(F.struct("doc_id", "text_hash")).alias("least"), F.first("roots").alias("roots"), F.first("marks").alias("marks")).select(
        "digest", "n", F.col("least.doc_id").alias("member"), F.col("least.text_hash").alias("text_hash"), "roots", "marks"), "classes")
    chosen = classes.select("member", "text_hash")
    known: list[DataFrame] = []

    def whole(members: DataFrame) -> DataFrame:
        """The whole sets of ``members``, made once for each class."""
        fresh = members.distinct()
        for earlier in known:
            fresh = fresh.join(earlier.select("member"), "member", "left_anti")
        fresh = stored(chosen.join(fresh, "member").withColumnsRenamed({"member": "doc_id"}), "fresh")
        if not fresh.isEmpty():
            rows = texts.join(fresh, ["doc_id", "text_hash"]).select(F.col("doc_id").alias("member"), "text")
            known.append(stored(rows.dropDuplicates(["member", "text"]).mapInArrow(
                set_batches, "member long, n long, shingles binary"), "shingles"))
        return reduce(DataFrame.union, known).join(members, "member", "left_semi")

    def confirm(pairs: DataFrame) -> DataFrame:
        """The links among ``a, b``."""
        sets = whole(pairs.select(F.explode(F.array("a", "b")).alias("member")))
        ones, others = (sets.join(pairs.select(F.col(end).alias("member")), "member", "left_semi") for end in "ab")
        both = pairs.select("a", "b").join(ones.select(F.col("member").alias("a"), F.col("n").alias("n_a"), F.col("shingles").alias("left")), "a")
        both = both.join(others.select(F.col("member").alias("b"), F.col("n").alias("n_b"), F.col("shingles").alias("right")), "b")
        shared = both.select("a", "b", "n_a", "n_b", "left", "right").mapInArrow(
            overlap_batches, "a long, b long, n_a long, n_b long, shared long")
        return stored(shared.where(100 * F.col("shared") >= percent * (F.col("n_a") + F.col("n_b") - F.col("shared"))), "links")

    found = links_of(classes, confirm, whole, percent)
    links = docs.sparkSession.createDataFrame([], "a long, b long, n_a long, n_b long, shared long")
    for more in found:
        links = links.union(more)
    rows = sketched.join(classes.select("digest", "n", "member"), ["digest", "n"], "left").select("doc_id", "text_hash", "n", "member")
    return rows, links


def near_duplicates(docs: DataFrame, percent: int = 75) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_shingles, component_id, kept``.

    A row's set holds its distinct five-word shingles, A-Z lower-cased; the whole sequence of fewer words; nothing
    without words or text. Sets that share ``percent`` of their union or more are linked; ``component_id`` is the smallest
    id reachable, ``kept`` tells whether that is the row's own. Empty sets are linked with nothing. Rows with
    a null id are linked with nothing and kept. Rows sharing an id are one document where their sets are equal; other
    columns are ignored; an empty table gives none.
    """
    return _judged(docs, percent).drop("text_hash")


def _judged(docs: DataFrame, percent: int) -> DataFrame:
    rows, links = near_links(docs, percent)
    found = components(links).select(F.col("id").alias("member"), "component")
    own = F.coalesce("component", "member", "doc_id")
    return rows.join(found, "member", "left").select(
        "doc_id", "text_hash", F.col("n").alias("n_shingles"), own.alias("component_id"),
        F.coalesce(F.col("doc_id") == own, F.lit(True)).alias("kept"))


def drop_near_duplicates(docs: DataFrame, percent: int = 75) -> DataFrame:
    """The rows of ``docs`` whose document represents its group; columns as they were.

    A row goes by its id and text: another text under the same id is judged by itself, rows alike in both stay or go together.
    """
    gone = stored(_judged(docs, percent).where("not kept").select(
        F.col("doc_id").alias("copy_id"), F.col("text_hash").alias("copy_hash")).distinct(), "copies")
    same = (docs["doc_id"].cast("long") == gone["copy_id"]) & (F.xxhash64(docs["text"]) == gone["copy_hash"])
    return docs.join(gone, same, "left_anti")
