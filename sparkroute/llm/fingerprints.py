"""Document fingerprints by winnowing, in built-in functions only.

Tokens are words, long ones in pieces of at most 12 characters. Every run of ``K`` tokens has a
hash; from every window of ``W`` consecutive runs the least hash is chosen, of equal ones the
rightmost, and kept with its position. Two texts that share a run of W + K - 1 tokens share a
chosen hash at the matching place.

A chosen run is one long: the high 40 bits are the hash, the low 24 the position counted
backwards, so the least long is the least hash and among equals the rightmost.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkroute.functions.keys import ASC
from sparkroute.llm.common import fresh, let, text_of
from sparkroute.operators.routing import bisect

K, W = 4, 16
PIECE = r"[^\x20\x09-\x0D]{1,12}"
POSITION_BITS = 24
LAST = (1 << POSITION_BITS) - 1
INT64_MIN = -(1 << 63)
BUCKET_ROWS, MAX_BUCKETS = 4000, 1024


def winnowed(text: Column, k: int = K, w: int = W) -> Column:
    """The chosen runs of ``text`` in order of position; empty for a text without words.

    A text of fewer than ``k`` tokens is one run; positions count to 2^24 and begin again.
    """

    def run(t: Column, i: Column) -> Column:
        return F.xxhash64(*[F.get(t, i + j) for j in range(k)])

    def packed(h: Column, i: Column) -> Column:
        back = F.lit(LAST) - i.bitwiseAND(F.lit(LAST))
        return h.bitwiseAND(F.lit(~LAST)).bitwiseOR(back.cast("long"))

    def of_tokens(t: Column) -> Column:
        runs = F.transform(F.sequence(F.lit(0), F.greatest(F.size(t) - k, F.lit(0))), lambda i: packed(run(t, i), i))

        def of_runs(v: Column) -> Column:
            windows = F.sequence(F.lit(1), F.greatest(F.size(v) - w + 1, F.lit(1)))
            return F.array_distinct(F.transform(windows, lambda i: F.array_min(F.slice(v, i, w))))

        return F.when(F.size(t) == 0, F.array().cast("array<long>")).otherwise(let(runs, of_runs))

    return let(F.regexp_extract_all(text, F.lit(PIECE), F.lit(0)), of_tokens)


def as_text(chosen: Column) -> Column:
    """``hash@position`` of each chosen run, hashes as 10 hex digits."""
    digits = lambda x: F.lower(F.lpad(F.hex(F.shiftrightunsigned(x, POSITION_BITS)), 10, "0"))
    place = lambda x: (F.lit(LAST) - x.bitwiseAND(F.lit(LAST))).cast("string")
    return F.array_join(F.transform(chosen, lambda x: F.concat(digits(x), F.lit("@"), place(x))), " ")


def likeness(a: Column, b: Column) -> Column:
    """Share of the chosen hashes of either that are in both, 0 to 1; 1 for two empty ones."""
    hashes = lambda c: F.transform(c, lambda x: F.shiftrightunsigned(x, POSITION_BITS))

    def of_both(x: Column, y: Column) -> Column:
        return F.when((F.size(x) == 0) & (F.size(y) == 0), 1.0).otherwise(
            F.size(F.array_intersect(x, y)) / F.size(F.array_union(x, y)))

    return let(hashes(a), lambda x: let(hashes(b), lambda y: of_both(x, y)))


def with_next(docs: DataFrame, id_col: str, columns: list[str], ids: DataFrame | None = None) -> DataFrame:
    """``docs`` with ``next_<column>`` of the row that follows by descending id, the first after the last.

    Ids are cut in buckets at quantiles (at most 1024); the first row of each bucket is also put
    at the end of the bucket before it, so each bucket is a window of its own and no row is
    shuffled twice. Null ids come last, equal ids in order of a hash of ``columns``.
    ``ids`` may give the same ids from a cheaper scan; they are read to place the buckets.
    """
    key = F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(INT64_MIN))
    ids = (docs if ids is None else ids).select(key.alias("__k"))
    n = ids.count()
    wanted = min(max(n // BUCKET_ROWS, 1), MAX_BUCKETS)
    quantiles = [i / wanted for i in range(1, wanted)]
    cuts = sorted(set(ids.agg(F.percentile_approx("__k", quantiles, 10 * MAX_BUCKETS)).first()[0] or [])) if quantiles and n else []
    bounds = F.array(*[F.lit(c).cast("long") for c in cuts])
    bucket = bisect([bounds], len(cuts), [("__k", ASC)]) if cuts else F.lit(0)
    tops = {r["b"]: r["top"] for r in ids.groupBy(bucket.alias("b")).agg(F.max("__k").alias("top")).collect()}
    used = sorted(tops)
    above = {b: used[(i + 1) % len(used)] for i, b in enumerate(used)}
    top_of = F.array(*[F.lit(tops.get(b)).cast("long") for b in range(len(cuts) + 1)])
    ends = F.array(*[F.lit(above.get(b)).cast("int") for b in range(len(cuts) + 1)])
    rows = docs.withColumn("__k", key).withColumn("__b", bucket.cast("int"))
    here = F.struct(F.col("__b").alias("b"), F.lit(False).alias("copy"))
    there = F.struct(F.get(ends, F.col("__b")).alias("b"), F.lit(True).alias("copy"))
    both = F.when(F.col("__k") == F.get(top_of, F.col("__b")), F.array(here, there)).otherwise(F.array(here))
    dealt = rows.withColumn("__in", F.explode(both))
    order = Window.partitionBy("__in.b").orderBy("__in.copy", F.desc("__k"), F.xxhash64(*columns))
    out = dealt.select(*docs.columns, "__in", *[F.lead(c).over(order).alias(f"next_{c}") for c in columns])
    return out.where(~F.col("__in.copy")).drop("__in")


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the fingerprint of its text and of an edited text, and how alike they are.

    In the edited text the last floor(n / 3) of n code points are replaced by the first as many
    (or all) of the next document's. Defined results: a null text is empty; empty fingerprints
    are alike (1.0) only to empty ones; the only document is its own next one; repeated rows
    follow each other; other columns are not read; an empty table gives no rows.
    """
    text = docs.select(F.col(f"`{id_col}`").alias("id"), text_of(text_col).alias("text"))
    marked = text.withColumn("chosen", F.explode(F.array(winnowed(F.col("text")))))
    met = with_next(marked, "id", ["text", "chosen"], ids=text)
    n = F.length("text")
    cut = F.floor(n / 3).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - cut), F.substring(F.col("next_text"), F.lit(1), cut))
    made = F.struct(n.cast("long").alias("n_chars"), edited.alias("edited"))
    met = met.select("id", "chosen", "next_chosen", F.explode(F.array(made)).alias("m"))
    met = met.withColumn("edited_chosen", F.explode(F.array(winnowed(F.col("m.edited")))))
    return met.select(
        F.col("id").alias(id_col), F.col("m.n_chars").alias("n_chars"), F.sha2(F.col("m.edited"), 256).alias("edited_sha256"),
        as_text(F.col("chosen")).alias("fingerprint"), as_text(F.col("edited_chosen")).alias("edited_fingerprint"),
        likeness(F.col("chosen"), F.col("edited_chosen")).alias("near_edited"),
        likeness(F.col("chosen"), F.col("next_chosen")).alias("near_next"))
