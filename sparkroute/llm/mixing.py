"""Mixing sources to target weights by Sainte-Lague apportionment, in built-in functions only.

All words are dealt as blocks of equally many words. The blocks go to sources by the highest
quotients of their targets (target / 1, / 3, / 5, ...), and a source's blocks go to its shards in
the same way by the shards' sizes, so each shard gets an integer quota. A shard's documents stand
in a seeded order that makes one stream of words; the stream is cut in blocks and as many as the
quota are taken from its start, again from the start once it is used up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkroute.llm.common import WORD, fresh, sent_to_all, text_of, write_once

SEED = 20
BLOCK_WORDS = 16
SHARD_DOCS = 2000
MAX_REPEAT = 3
CYCLE = 3


def apportion(parties: DataFrame, votes: str, seats: Column, group: list[str], tie: list[str], out: str) -> DataFrame:
    """``parties`` with the seats ``out`` that each gets of its group's ``seats``.

    Sainte-Lague: the highest quotients votes / (2 k + 1) win, ties by ``tie``. Seats that every
    possible divisor gives are dealt at once; only the few next ones of each party are ranked.
    """
    whole = Window.partitionBy(*group)
    v = F.col(votes).cast("double")
    known = parties.withColumns({"__seats": seats.cast("double"), "__v": v})
    known = known.withColumns({"__all": F.sum("__v").over(whole), "__n": F.count("*").over(whole)})
    share = F.when(F.col("__all") > 0, F.col("__v") / F.col("__all")).otherwise(0.0)
    known = known.withColumns({
        "__low": F.greatest(F.lit(0.0), F.floor(share * (F.col("__seats") - F.col("__n") / 2) - 1.5)).cast("long"),
        "__high": F.ceil(share * (F.col("__seats") + F.col("__n") / 2) + 1.5).cast("long"),
    })
    known = known.withColumn("__open", F.col("__seats").cast("long") - F.sum("__low").over(whole))
    nexts = known.withColumn("__k", F.explode(F.sequence("__low", "__high")))
    best = Window.partitionBy(*group).orderBy(F.desc(F.col("__v") / (2 * F.col("__k") + 1)), *tie, "__k")
    ranked = nexts.withColumn("__won", (F.row_number().over(best) <= F.col("__open")) & (F.col("__v") > 0))
    won = F.sum(F.col("__won").cast("long"))
    return ranked.groupBy(*parties.columns).agg((F.first("__low") + won).alias(out))


def source_targets(sources: DataFrame, max_repeat: int = MAX_REPEAT) -> tuple[DataFrame, int]:
    """``sources`` (source, docs, source_size) with ``target``, and the sum of all sizes.

    Sources by code point, null last, weigh 1, 2, 3, 1, ... and share all words; a target stops
    at ``max_repeat`` sizes, and what is over is shared again by weight until none is above.
    """
    order = Window.orderBy(F.asc_nulls_last("source"))
    weighed = write_once(sources.withColumn("weight", ((F.row_number().over(order) - 1) % CYCLE + 1).cast("double")), "sources")
    total = weighed.agg(F.sum("source_size")).first()[0] or 0
    cap = F.col("source_size").cast("double") * max_repeat
    share, capped = float(total), -1
    level = None
    while True:
        over = F.lit(False) if level is None else F.col("weight") * level > cap
        row = weighed.agg(F.sum(F.when(over, cap).otherwise(0.0)), F.sum(F.when(over, 0.0).otherwise(F.col("weight"))),
                          F.sum(over.cast("long"))).first()
        if row[2] is None or not row[1] or row[2] == capped:
            break
        capped, level = row[2], (share - row[0]) / row[1]
    target = cap if level is None else F.least(F.col("weight") * level, cap)
    return weighed.withColumn("target", target), int(total)


def mix(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = SEED,
    block_words: int = BLOCK_WORDS, shard_docs: int = SHARD_DOCS, keep: list[str] | None = None,
) -> tuple[DataFrame, str]:
    """``docs`` (its columns ``keep`` if given) with one more struct column (size, source_size, target, shard, taken), and its name.

    ``size`` is the text's words and ``taken`` the words of it that the mix takes, repeats
    counted: whole copies, and for the rest its first words. A source's taken words differ from
    its target by about half a block; ``taken`` is at most three sizes. The block shrinks for
    tables whose smallest target holds fewer than 20 blocks. Reruns agree, since ids, texts and
    the seed alone decide.

    Defined results: null or blank texts have size 0 and are taken 0 times; null sources are one
    source, last in order; equal rows share their places in any order; an empty table stays empty.
    """
    name = fresh(docs, "mix")
    row = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in (keep or docs.columns)]).alias("row"),
        F.col(f"`{source_col}`").cast("string").alias("source"),
        F.regexp_count(text_of(text_col), F.lit(WORD)).cast("long").alias("size"),
        F.xxhash64(F.lit(seed), F.col(f"`{id_col}`"), F.col(f"`{text_col}`")).alias("place"),
    )
    sized = write_once(row, "sized")
    sources, total = source_targets(sized.groupBy("source").agg(
        F.count("*").alias("docs"), F.sum("size").alias("source_size")))
    least = sources.where("target > 0").agg(F.min("target")).first()[0] or 1.0
    block = int(min(max(least // 20, 1), block_words))
    quotas = apportion(sources, "target", F.lit(round(total / block)), [], ["source"], "quota")
    quotas = write_once(quotas.withColumn("shards", F.ceil(F.col("docs") / shard_docs)), "quotas")
    wide = quotas.select(F.col("source").alias("of"), "source_size", "target", "quota", "shards")
    dealt = sized.join(sent_to_all(wide), F.col("source").eqNullSafe(F.col("of")), "left")
    dealt = dealt.withColumn("shard", F.pmod(F.xxhash64("place"), F.col("shards")))
    shards = dealt.groupBy("of", "shard").agg(
        F.sum("size").alias("shard_size"), F.first("quota").alias("quota"))
    shares = apportion(shards, "shard_size", F.col("quota"), ["of"], ["shard"], "blocks")
    stock = F.least(F.col("blocks") * block, MAX_REPEAT * F.col("shard_size"))
    shares = shares.select(F.col("of").alias("in_source"), F.col("shard").alias("in_shard"), "shard_size", stock.alias("stock"))
    met = dealt.join(sent_to_all(shares), F.col("of").eqNullSafe(F.col("in_source")) & (F.col("shard") == F.col("in_shard")), "left")
    stream = Window.partitionBy("of", "shard").orderBy("place", "size").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("size").over(stream), F.lit(0))
    rest = F.expr("stock % shard_size") - F.col("before")
    whole = F.expr("stock div shard_size") * F.col("size")
    taken = F.when(F.col("size") == 0, F.lit(0)).otherwise(whole + F.least(F.greatest(rest, F.lit(0)), F.col("size")))
    out = met.withColumn("before", before)
    return out.select("row.*", F.struct(
        "size", "source_size", "target", F.col("shard").cast("int").alias("shard"), taken.cast("long").alias("taken")).alias(name)), name


def taken_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The rows of the mix with the columns of ``docs``: each whole copy, then the first words of a cut one."""
    mixed, name = mix(docs, id_col, text_col, source_col)
    size, taken = F.col(f"{name}.size"), F.col(f"{name}.taken")
    copies = F.when(size > 0, F.array_repeat(size, F.floor(taken / size).cast("int")))
    rest = F.when(size > 0, taken % size)
    pieces = F.when(rest > 0, F.concat(copies, F.array(rest))).otherwise(copies)
    piece = fresh(mixed, "piece")
    cut = mixed.select("*", F.explode(pieces).alias(piece))
    words = F.regexp_extract_all(F.col(f"`{text_col}`"), F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), F.lit(0))
    head = F.array_join(F.slice(words, F.lit(1), F.col(piece).cast("int")), "")
    text = F.when(F.col(piece) < size, head).otherwise(F.col(f"`{text_col}`"))
    return cut.select(*[text.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns])
