"""Key and document queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkroute.functions.hashing import hash_column
from sparkroute.functions.keys import ShardKey, doc_bytes, split_by_key
from sparkroute.operators.ids import add_id
from sparkroute.queries.registry import digest_sql, hashed_sql, le_hex, query, table, unsigned_hex


@query(sql=f"SELECT o_orderkey, key_hash FROM {hashed_sql('orders', 'o_orderkey')}")
def hash64_key(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return orders.select("o_orderkey", hash_column(orders, "o_orderkey").alias("key_hash"))


@query(sql=f"SELECT c_custkey, key_hash FROM {hashed_sql('customer', 'trunc(c_acctbal)::BIGINT')}")
def hash64_double(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    return customer.select("c_custkey", hash_column(customer, "c_acctbal").alias("key_hash"))


TEXT_HEX = (
    f"('000000000f000000' || {le_hex('_d', 4)} || hex(text) || '00')"
)


@query(
    sql=f"""
SELECT doc_id, _hash AS key_hash FROM (
  SELECT *, lpad(hex(octet_length(encode(text)) + 1), 8, '0') AS _d, {digest_sql(TEXT_HEX)}
  FROM documents)
"""
)
def hash64_text(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    return documents.select("doc_id", hash_column(documents, "text").alias("key_hash"))


STRUCT_HEX = (
    "('0000000014000000' || '0a000000' || hex('o_custkey') || '00' || "
    + le_hex("_d")
    + " || '0f000000' || hex('o_orderpriority') || '00' || "
    + le_hex("_s", 4)
    + " || hex(o_orderpriority) || '00' || '00000000')"
)


@query(
    sql=f"""
SELECT o_orderkey, _hash AS key_hash FROM (
  SELECT *, {unsigned_hex('o_custkey')} AS _d,
    lpad(hex(length(o_orderpriority) + 1), 8, '0') AS _s, {digest_sql(STRUCT_HEX)}
  FROM orders)
"""
)
def hash64_struct(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    nested = orders.withColumn("sub", F.struct("o_custkey", "o_orderpriority"))
    return nested.select("o_orderkey", hash_column(nested, "sub").alias("key_hash"))


ARRAY_ITEM = (
    "'0a000000' || hex((i - 1)::VARCHAR) || '00' || "
    + le_hex(unsigned_hex("trunc(v::DOUBLE * 1000)::BIGINT"))
)


@query(
    sql=f"""
SELECT vec_id, _hash AS key_hash FROM (
  SELECT *, '0000000019000000' || array_to_string(
      list_transform(embedding, lambda v, i: {ARRAY_ITEM}), '') || '00000000' AS _d,
    {digest_sql('_d')}
  FROM embeddings)
"""
)
def hash64_array(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    scaled = F.transform("embedding", lambda v: v.cast("double") * 1000)
    vectors = vectors.withColumn("scaled", scaled)
    return vectors.select("vec_id", hash_column(vectors, "scaled").alias("key_hash"))


@query("doc_bytes", sql="SELECT doc_id, octet_length(encode(text))::BIGINT AS n_bytes FROM documents")
def doc_size(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    return documents.select("doc_id", doc_bytes(documents, ["text"]).alias("n_bytes"))


@query(
    sql="""
SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'no key field: o_custkey' END AS reason
FROM orders
"""
)
def key_complete(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    holes = orders.withColumn("o_custkey", F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")))
    key = ShardKey.parse({"o_custkey": 1, "o_orderkey": -1})
    good, bad = split_by_key(holes, key)
    good = good.withColumn("reason", F.lit(None).cast("string"))
    return good.select("o_orderkey", "reason").union(bad.select("o_orderkey", "reason"))


@query(
    "add_id",
    sql="""
SELECT substr(sha256(coalesce(length(text) || ':' || text, '-') || coalesce(length(source) || ':' || source, '-') ||
         coalesce(length(lang) || ':' || lang, '-') || '#' ||
         (row_number() OVER (PARTITION BY text, source, lang) - 1)::VARCHAR), 1, 24) AS _id,
       source, lang, octet_length(encode(text))::BIGINT AS n_bytes
FROM (SELECT text, source, lang FROM documents UNION ALL SELECT NULL, source, lang FROM documents WHERE doc_id % 7 = 0
      UNION ALL SELECT '', source, lang FROM documents WHERE doc_id % 5 = 0)
"""
)
def add_missing_id(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    odd = [documents.where(f"doc_id % {m} = 0").withColumn("text", F.lit(t)) for m, t in ((7, None), (5, ""))]
    documents = documents.unionByName(odd[0]).unionByName(odd[1]).select("text", "source", "lang")
    nameless = documents.withColumn("_id", F.lit(None).cast("string"))
    named = add_id(nameless, ["text", "source"], block=2)
    return named.select("_id", "source", "lang", F.octet_length("text").cast("bigint").alias("n_bytes"))


