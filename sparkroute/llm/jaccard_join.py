"""N-gram Jaccard join: links between documents whose shingle sets are nearly the same.

Size-aware heavy-light join. Every set is put in one global order of shingles, rare first, and
a pair at the threshold must share shingles among the first ones of both sets (its prefix). A
light (small) set enumerates all 2-element subsets of its prefix and meets others under equal
subsets; a heavy (large) set is found by scanning the inverted lists of its single prefix
shingles. The size that parts light from heavy is the one of least estimated cost.

* The order ranks shingles by the count of their hash bucket, so common shingles come last and
  the list of any shingle stays short; the table of buckets has a fixed size at any input.
* Equal sets are one node. A long list (a large group of near copies) first meets in a star
  around its smallest member. After that only pairs in different components are compared: links
  inside a component cannot change the answer. Every other pair of a list is counted and checked.
* Candidates are checked on their whole sets. Shingles are 64-bit hashes.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkroute.llm.common import discard, python_workers, sent_to_all, write_once
from sparkroute.llm.shingles import shingle_sets, slices, words

BUCKET_BITS = 17
STAR_FROM = 32
ROWS_AT_ONCE = 512
MIN_SHARED = 3


def _needed(n: int, percent: int) -> int:
    """Shingles that a set of ``n`` shares with any partner at least."""
    return -(-percent * n // 100)


def _bucket_ranks(texts: DataFrame, shingle: int) -> np.ndarray:
    """Rank of each hash bucket by the number of ``shingle``-word shingles in it, least first."""

    def count(batches):
        from sparkroute.llm.shingles import _PLACE, mixed

        total = np.zeros(1 << BUCKET_BITS, np.int64)
        for batch in batches:
            for _, offsets, data in slices(batch.column(0)):
                hashes, _ = words(offsets, data)
                m = max(len(hashes) - shingle + 1, 0)
                grams = mixed(sum((hashes[i : i + m] * _PLACE[i] for i in range(1, shingle)), hashes[:m] * _PLACE[0]))
                total += np.bincount((grams >> np.uint64(64 - BUCKET_BITS)).astype(np.int64), minlength=len(total))
        found = np.flatnonzero(total)
        for at in range(0, len(found), 20_000):
            part = found[at : at + 20_000]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(total[part])], ["bucket", "n"])

    counts = texts.mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    total = np.zeros(1 << BUCKET_BITS, np.int64)
    for row in counts:
        total[row[0]] = row[1]
    ranks = np.empty(len(total), np.uint64)
    ranks[np.argsort(total, kind="stable")] = np.arange(len(total), dtype=np.uint64)
    return ranks


def _ordered(ranks: np.ndarray, shingles: np.ndarray) -> np.ndarray:
    """The shingles renamed (one to one) so that their numbers follow the global order."""
    shift = np.uint64(64 - BUCKET_BITS)
    low = np.uint64((1 << (64 - BUCKET_BITS)) - 1)
    return np.sort((ranks[(shingles >> shift).astype(np.int64)] << shift) | (shingles & low))


def _parts(batches):
    """The rows in small batches, so that a task holds few sets at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS_AT_ONCE):
            yield batch.slice(at, ROWS_AT_ONCE)


def _lists(values: list[np.ndarray]) -> pa.Array:
    offsets = np.zeros(len(values) + 1, np.int32)
    np.cumsum([len(v) for v in values], out=offsets[1:])
    flat = np.concatenate(values) if values else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.view(np.int64)))


def shingle_sketches(docs: DataFrame, id_col: str, text_col: str, percent: int, shingle: int) -> DataFrame:
    """Per document row: id, n (set size), d1 and d2 (digest of the set), prefix in the global order.

    The prefix has one shingle more than a shared single one needs, for the subsets.
    """
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    ranks = _bucket_ranks(texts.select("text"), shingle)

    def sketch(batches):
        for batch in _parts(batches):
            sizes, d1, d2, prefixes = [], [], [], []
            for found in shingle_sets(batch.column(1), shingle):
                n = len(found)
                digest = np.frombuffer(hashlib.blake2b(found.tobytes(), digest_size=16).digest(), np.int64)
                sizes.append(n)
                d1.append(digest[0])
                d2.append(digest[1])
                prefixes.append(_ordered(ranks, found)[: n - _needed(n, percent) + 2])
            columns = [batch.column(0), pa.array(sizes, pa.int64()), pa.array(d1, pa.int64()), pa.array(d2, pa.int64())]
            yield pa.RecordBatch.from_arrays([*columns, _lists(prefixes)], ["id", "n", "d1", "d2", "prefix"])

    return texts.mapInArrow(sketch, "id long, n long, d1 long, d2 long, prefix array<long>")


def light_boundary(sets: DataFrame) -> int:
    """Largest size of a light set: the bound of least estimated records.

    Per size class: subsets that its sets would enumerate, against prefix shingles times the
    mean length of the lists they meet. At most 64 classes come to the driver.
    """
    classes = sets.select(F.floor(F.log2("n") * 2).cast("int").alias("size"), "prefix", F.size("prefix").alias("p"))
    singles = F.explode(F.slice("prefix", 1, F.col("p") - 1)).alias("token")
    lists = classes.select("size", singles).groupBy("size").agg(
        F.count("*").alias("postings"), F.approx_count_distinct("token", 0.05).alias("tokens")
    )
    subsets = classes.groupBy("size").agg(F.sum(F.expr("p * (p - 1) / 2")).alias("subsets"))
    rows = sorted(subsets.join(lists, "size").collect(), key=lambda r: r["size"])
    scan = [r["postings"] * r["postings"] / max(1, r["tokens"]) for r in rows]
    enum = [r["subsets"] for r in rows]
    best, bound = sum(scan), 0
    for i, row in enumerate(rows):
        cost = sum(enum[: i + 1]) + sum(scan[i + 1 :])
        if cost < best:
            best, bound = cost, int(np.ceil(2 ** ((row["size"] + 1) / 2))) - 1
    return bound


def _postings(sets: DataFrame, light: int, percent: int) -> DataFrame:
    """(key, single, id, n, pos): what each set is listed under; pos is a single shingle's place in the order."""
    subsets = F.expr(
        "flatten(transform(sequence(1, size(prefix) - 1), i -> transform(slice(prefix, i + 1, size(prefix)),"
        " x -> xxhash64(element_at(prefix, i), x))))"
    )
    by_subset = sets.where(F.col("n") <= light).select(
        F.explode(subsets).alias("key"), F.lit(False).alias("single"), "id", "n", F.lit(0).alias("pos")
    )
    # a light set near the boundary may also have heavy partners
    by_single = sets.where(100 * F.col("n") >= percent * light).select(
        F.posexplode(F.slice("prefix", 1, F.size("prefix") - 1)).alias("pos", "key"), F.lit(True).alias("single"), "id", "n"
    )
    return by_subset.unionByName(by_single)


def _sets_of(texts: DataFrame, nodes: DataFrame, shingle: int) -> DataFrame:
    """(id, items): whole sets of the documents in ``nodes``."""

    def whole(batches):
        for batch in _parts(batches):
            found = list(shingle_sets(batch.column(1), shingle))
            yield pa.RecordBatch.from_arrays([batch.column(0), _lists(found)], ["id", "items"])

    wanted = texts.join(sent_to_all(nodes, row_bytes=16), "id", "left_semi")
    return wanted.mapInArrow(whole, "id long, items array<long>")


def _checked(edges: DataFrame, texts: DataFrame, percent: int, shingle: int) -> tuple[DataFrame, list[DataFrame]]:
    """The pairs (a, b) of ``edges`` that link, compared on whole sets, and the written tables they come from."""
    edges = write_once(edges, "candidates")
    nodes = edges.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    sets = write_once(_sets_of(texts, nodes, shingle), "sets")
    pairs = edges.join(sets.toDF("a", "items_a"), "a").join(sets.toDF("b", "items_b"), "b")
    both = F.size(F.array_intersect("items_a", "items_b"))
    union = F.size("items_a") + F.size("items_b") - both
    return pairs.where(100 * both >= percent * union).select("a", "b"), [edges, sets]


def smallest_reachable(edges: DataFrame, spent: list[DataFrame] = ()) -> DataFrame:
    """(id, component) for each end of ``edges`` (a, b): the smallest id that links lead to.

    Minimum labels with pointer jumping; each round is written to the shared folder. ``spent`` are written
    tables that only ``edges`` is read from; they are removed once the edges are written.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = write_once(both.where("a <> b").distinct(), "links")
    discard(*spent)
    labels = write_once(both.groupBy("a").agg(F.min("b").alias("m")).select(
        F.col("a").alias("id"), F.least("a", "m").alias("component")), "labels")
    while True:
        near = both.join(labels.toDF("b", "near"), "b").groupBy("a").agg(F.min("near").alias("near"))
        step = labels.join(near.withColumnRenamed("a", "id"), "id").select(
            "id", F.col("component").alias("old"), F.least("component", "near").alias("via"))
        jump = labels.select(F.col("id").alias("via"), F.col("component").alias("far"))
        moved = write_once(step.join(jump, "via", "left").select(
            "id", "old", F.least("via", F.coalesce("far", "via")).alias("component")), "labels")
        labels = moved.select("id", "component")
        if moved.where("old <> component").isEmpty():
            return labels


def _overlap(few: str, many: str, percent: int) -> str:
    """SQL of the common shingles that sets of these sizes need at least."""
    return f"ceil({percent} * ({few} + {many}) / (100 + {percent}))"


def _early(few: str, many: str, percent: int, shared: str) -> str:
    """SQL of how far, from the end of a set, its ``shared``-th common shingle may lie."""
    return f"({_overlap(few, many, percent)} - {shared})"


def _shared(few: str, many: str, percent: int) -> str:
    """SQL of how many of the common shingles are asked for among the first ones of both sets."""
    return f"least({MIN_SHARED}, {_overlap(few, many, percent)} - ceil({percent} * {many} / 100) + 1)"


def _candidates(members: DataFrame, percent: int, light: int) -> DataFrame:
    """Pairs (a, b) of one list and different components that may still reach the threshold.

    With ``need`` common shingles the c-th rarest of them has at least need - c behind it in both
    sets; so a pair is met only in lists of its places up to there, and must be met c times.
    """
    first = members.groupBy("key").agg(
        F.min(F.struct("id", "component")).alias("m"), F.min("component").alias("lo"), F.max("component").alias("hi")
    ).where("lo <> hi").select("key", F.col("m.component").alias("main"))
    open_lists = members.join(first, "key")
    rest = open_lists.where("component <> main").select(
        "key", "single", F.col("id").alias("x"), F.col("n").alias("nx"), F.col("pos").alias("px"), F.col("component").alias("cx"))
    other = open_lists.select("key", F.col("id").alias("y"), F.col("n").alias("ny"), F.col("pos").alias("py"),
                              F.col("component").alias("cy"), "main")
    few, many = "least(nx, ny)", "greatest(nx, ny)"
    behind = _early(few, many, percent, _shared(few, many, percent))
    met = rest.join(other, "key").where(
        f"""cx <> cy and (cy = main or x < y) and 100 * {few} >= {percent} * {many}
        and (not single or ({many} > {light} and nx - 1 - px >= {behind} and ny - 1 - py >= {behind}))"""
    )
    pairs = met.groupBy(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), "single").agg(
        F.count("*").alias("shared"), F.min(F.least("nx", "ny")).alias("few"), F.max(F.greatest("nx", "ny")).alias("many"))
    return pairs.where(f"not single or shared >= {_shared('few', 'many', percent)}").select("a", "b").distinct()


def jaccard_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 85, shingle: int = 4
) -> DataFrame:
    """Per row of ``docs``: ``id_col``, ``n_shingles`` and ``component_id``.

    Documents link when 100 * intersection >= ``percent`` * union of their sets of distinct
    ``shingle``-word shingles (A-Z lower-cased; fewer words form one shingle together);
    ``component_id`` is the smallest id reachable by links. Defined results: a null, empty or
    blank text has no set, links with nothing and is its own component; a row whose id is null
    takes no part in links and has a null component; repeated rows come back each; other columns
    are not read; an empty table gives no rows.
    """
    if not 70 <= percent <= 100:
        raise ValueError("percent must be from 70 to 100: subsets of two need two common shingles")
    python_workers(docs.sparkSession)
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    texts = texts.where(F.col("id").isNotNull())
    sketches = write_once(shingle_sketches(docs, id_col, text_col, percent, shingle), "sketches")
    named = sketches.where("n > 0 and id is not null")
    nodes = write_once(named.groupBy("d1", "d2").agg(F.min("id").alias("id")), "nodes")
    # a set that no larger or equal partner can differ from links with its copies only
    may_differ = F.expr(f"ceil({percent} * (2 * n + 1) / (100 + {percent})) <= n")
    sets = named.where(may_differ).join(nodes.select("d1", "d2", "id"), ["d1", "d2", "id"], "left_semi")
    # three readers of the prefixes: written, they are shuffled once
    sets = write_once(sets.select("id", "n", "prefix"), "prefixes")
    light = light_boundary(sets)
    postings = _postings(sets, light, percent)
    # nearly all keys occur once: they are found by counts alone, before rows of full width meet
    repeated = postings.groupBy("key").agg(F.count("*").alias("times")).where("times > 1").select("key")
    met = write_once(postings.join(repeated, "key", "left_semi").select("key", "single", "id", "n", "pos"), "lists")
    discard(sets)
    long = met.groupBy("key", "single").agg(
        F.count("*").alias("length"), F.min(F.struct("id", "n", "pos")).alias("head")).where(f"length > {STAR_FROM}")
    starred = met.join(long, ["key", "single"]).select(
        "single", "id", "n", "pos", F.col("head.id").alias("head"), F.col("head.n").alias("head_n"), F.col("head.pos").alias("head_pos"))

    behind = _early("n", "head_n", percent, "1")
    stars = starred.where(
        f"""head <> id and 100 * least(n, head_n) >= {percent} * greatest(n, head_n)
        and (not single or (n - 1 - pos >= {behind} and head_n - 1 - head_pos >= {behind}))"""
    ).select(F.col("head").alias("a"), F.col("id").alias("b")).distinct()
    labels = smallest_reachable(*_checked(stars, texts, percent, shingle))
    members = met.join(labels, "id", "left").select(
        "key", "single", "id", "n", "pos", F.coalesce("component", "id").alias("component"))
    members = write_once(members, "members")
    discard(met)
    links, spent = _checked(_candidates(members, percent, light), texts, percent, shingle)
    discard(members)
    named_a = labels.toDF("a", "ca")
    named_b = labels.toDF("b", "cb")
    merged = links.join(named_a, "a", "left").join(named_b, "b", "left").select(
        F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b"))
    upper = smallest_reachable(merged, spent)
    both = labels.select(F.col("id"), F.col("component").alias("mid")).unionByName(
        upper.select("id", F.col("id").alias("mid"))).groupBy("id").agg(F.min("mid").alias("mid"))
    final = both.join(upper.toDF("mid", "top"), "mid", "left").select("id", F.coalesce("top", "mid").alias("component"))

    classes = nodes.join(final, "id", "left").select("d1", "d2", F.coalesce("component", "id").alias("component"))
    out = sketches.select("id", "n", "d1", "d2").join(classes, ["d1", "d2"], "left")
    own = F.when(F.col("id").isNull() | (F.col("n") == 0), F.col("id")).otherwise(F.col("component"))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), own.alias("component_id"))
