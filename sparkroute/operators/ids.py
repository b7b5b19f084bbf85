"""Generated ids for documents that have none."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ID = "_id"
BLOCK = 10_000


def content_id(content: list, ordinal) -> F.Column:
    """24 hex digits from the content and the ordinal among identical contents.

    Every value stands with its length in front and NULL has a mark of its own, so different
    contents are different texts.
    """
    texts = [F.col(c).cast("string") for c in content]
    parts = [F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.substring(F.sha2(F.concat(*parts, F.lit("#"), ordinal.cast("string")), 256), 1, 24)


def add_id(
    df: DataFrame, content: list[str], id_col: str = ID, block: int = BLOCK, derived: list[str] = ()
) -> DataFrame:
    """Fills ``id_col`` where it is NULL, from ``content`` (say the line and its file).

    Columns that are neither content nor ``derived`` from it count as content too, so no row
    takes over another one's values. Ids depend on the content alone, so a retried task makes the same ones; n identical
    documents get the ordinals 0 .. n-1. They are counted instead of numbered: copies
    combine on the map side to one row with their count, which is unfolded again. A count
    beyond ``block`` is unfolded in blocks spread over the cluster, so that no task makes
    more than ``block`` copies of one document at once.
    """
    dtype = df.schema[id_col].dataType
    have = df.where(F.col(id_col).isNotNull())
    content = [*content, *[c for c in df.columns if c not in {id_col, *content, *derived}]]
    rest = [c for c in df.columns if c != id_col and c not in content]
    counted = (
        df.where(F.col(id_col).isNull())
        .groupBy(*content)
        .agg(F.count("*").alias("__n"), *[F.first(c).alias(c) for c in rest])
    )
    end = F.least(F.col("__from") + block, F.col("__n")) - 1
    zero = F.lit(0).cast("bigint")
    few = counted.where(F.col("__n") <= block).withColumn("__from", zero)
    many = (
        counted.where(F.col("__n") > block)
        .withColumn("__from", F.explode(F.sequence(zero, F.col("__n") - 1, F.lit(block).cast("bigint"))))
        .repartition(*content, "__from")
    )
    unfolded = few.union(many).withColumn("__at", F.explode(F.sequence(F.col("__from"), end)))
    named = unfolded.withColumn(id_col, content_id(content, F.col("__at")).cast(dtype))
    return have.unionByName(named.select(*df.columns))
