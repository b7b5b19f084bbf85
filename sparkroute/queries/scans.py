"""Source queries. Each writes a table in the source's format by Spark, then scans that."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkroute.functions.extjson import TIMESTAMP, normalize_ext_json
from sparkroute.functions.hashing import le32_bytes, le64_bytes, millis
from sparkroute.operators.routing import CHUNK
from sparkroute.plans.chunks import chunk_ranges
from sparkroute.plans.splits import range_chunks
from sparkroute.queries.chunks import RANGE_BYTES, RANGE_CHUNKS_SQL, ROW_BYTES
from sparkroute.queries.registry import in_chunk_sql, names, query, table
from sparkroute.session import scratch_dir
from sparkroute.plans.jobs import read_documents
from sparkroute.sources.bson import read_bson
from sparkroute.sources.collection import read_chunks
from sparkroute.sources.json_lines import parse_documents, read_json_lines, read_lines

DOCUMENT_ROW = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@query(sql="SELECT doc_id, text, lang, source, n_chars FROM documents")
def json_scan(spark, sf_dir):
    folder = scratch_dir(spark, "json")
    table(spark, sf_dir, "documents").write.json(folder)
    schema = T.StructType.fromDDL(DOCUMENT_ROW)
    good, _ = read_json_lines(spark, folder, schema=schema)
    return good.drop("value", "file")


@query(sql="SELECT doc_id, octet_length(encode(text))::BIGINT AS n_bytes, lang FROM documents")
def json_scan_dynamic(spark, sf_dir):
    folder = scratch_dir(spark, "json")
    table(spark, sf_dir, "documents").write.json(folder)
    good, _ = read_json_lines(spark, folder)
    text = F.variant_get("doc", "$.text", "string")
    return good.select(
        F.variant_get("doc", "$.doc_id", "bigint").alias("doc_id"),
        F.octet_length(text).cast("bigint").alias("n_bytes"),
        F.variant_get("doc", "$.lang", "string").alias("lang"),
    )


@query(sql="SELECT doc_id, quality FROM labels")
def file_filter(spark, sf_dir):
    """A folder with files of two tables; the regular expression picks those of one."""
    folder = scratch_dir(spark, "mixed")
    table(spark, sf_dir, "documents").select("text").write.text(folder)
    table(spark, sf_dir, "labels").write.mode("append").json(folder)
    lines = read_lines(spark, folder, r".*/part-[^/]*[.]json")
    doc = F.from_json("value", "doc_id bigint, quality int")
    return lines.select(doc.alias("d")).select("d.doc_id", "d.quality")


EVENT_LINE = """'{"event_id": ' || event_id || ', "type": "' || event_type || '", "props": ' || props || '}'"""


def event_lines(spark, sf_dir):
    """Events as JSON lines; errors are cut short, and views become blank or bare numbers."""
    events = table(spark, sf_dir, "events")
    line = F.expr(EVENT_LINE)
    low = F.col("value") < 5
    view = F.when(low, F.lit("  ")).otherwise(F.col("event_id").cast("string"))
    broken = (
        F.when(F.col("event_type") == "error", F.substring(line, F.lit(1), F.length(line) - 1))
        .when(F.col("event_type") == "view", view)
        .otherwise(line)
    )
    return events.select(broken.alias("value"))


@query(
    sql=f"""
SELECT reason, value FROM (
  SELECT CASE event_type WHEN 'error' THEN left({EVENT_LINE}, -1)
      WHEN 'view' THEN CASE WHEN e.value < 5 THEN '  ' ELSE event_id::VARCHAR END
      ELSE {EVENT_LINE} END AS value,
    CASE event_type WHEN 'error' THEN 'malformed'
      WHEN 'view' THEN CASE WHEN e.value < 5 THEN 'blank' ELSE 'not a document' END
    END AS reason
  FROM events e)
"""
)
def json_quarantine(spark, sf_dir):
    folder = scratch_dir(spark, "lines")
    event_lines(spark, sf_dir).write.text(folder)
    good, bad = read_json_lines(spark, folder)
    kept = good.select(F.lit(None).cast("string").alias("reason"), "value")
    return kept.union(bad.select("reason", "value"))


EXT_SCHEMA = T.StructType(
    [
        T.StructField("_id", T.StringType()),
        T.StructField("user", T.LongType()),
        T.StructField("at", T.TimestampType()),
        T.StructField("clock", TIMESTAMP),
        T.StructField("value", T.DoubleType()),
        T.StructField("label", T.StringType()),
        T.StructField("pair", T.ArrayType(T.LongType())),
        T.StructField("props", T.StructType([T.StructField("k", T.LongType())])),
        T.StructField("none", T.DoubleType()),
    ]
)
OID_SQL = "lpad(hex(event_id), 24, '0')"
SECONDS_SQL = "(1700000000 + event_id)"
EXT_LINE = f"""'{{"_id": {{"$oid": "' || {OID_SQL} || '"}}'
  || ', "user": {{"$numberLong": "' || user_id || '"}}'
  || ', "at": {{"$date": ' || ({SECONDS_SQL} * 1000) || '}}'
  || ', "clock": {{"$timestamp": {{"t": ' || {SECONDS_SQL} || ', "i": ' || user_id || '}}}}'
  || ', "value": ' || CASE event_type WHEN 'error' THEN '"NaN"' WHEN 'view' THEN '"-Infinity"'
       ELSE user_id || '.5' END
  || ', "label": "' || CASE event_type WHEN 'error' THEN 'NaN' ELSE event_type END || '"'
  || ', "pair": [' || user_id || ', {{"$numberLong": "' || event_id || '"}}]'
  || ', "props": ' || props || ', "none": "undefined"}}'"""


@query(
    sql=f"""
SELECT lower({OID_SQL}) AS _id, user_id AS user, {SECONDS_SQL} AS at_seconds,
  {SECONDS_SQL} AS clock_seconds, user_id AS clock_i,
  CASE event_type WHEN 'error' THEN 'NaN' WHEN 'view' THEN '-Infinity' ELSE user_id || '.5' END AS value,
  CASE event_type WHEN 'error' THEN 'NaN' ELSE event_type END AS label,
  user_id AS pair_0, event_id AS pair_1,
  regexp_extract(props, '([0-9]+)', 1)::BIGINT AS k, true AS none_is_null, 0::BIGINT AS n_bad
FROM events
"""
)
def ext_json(spark, sf_dir):
    folder = scratch_dir(spark, "ext")
    table(spark, sf_dir, "events").select(F.expr(EXT_LINE).alias("value")).write.text(folder)
    docs = parse_documents(read_lines(spark, folder)).select("doc")
    typed = normalize_ext_json(docs, EXT_SCHEMA)
    return typed.select(
        "_id",
        "user",
        F.unix_seconds("at").alias("at_seconds"),
        F.unix_seconds("clock.t").alias("clock_seconds"),
        F.col("clock.i").cast("bigint").alias("clock_i"),
        F.col("value").cast("string").alias("value"),
        "label",
        F.col("pair")[0].alias("pair_0"),
        F.col("pair")[1].alias("pair_1"),
        F.col("props.k").alias("k"),
        F.col("none").isNull().alias("none_is_null"),
        F.size("bad_fields").cast("bigint").alias("n_bad"),
    )


NESTED_ROW = (
    "event_id bigint, box struct<n: bigint, tags: array<struct<k: bigint, on: boolean>>>, "
    "grid array<array<int>>, price decimal(38,4), count bigint"
)
NESTED_LINE = """'{"event_id": ' || event_id
  || ', "box": {"n": ' || CASE event_type WHEN 'error' THEN user_id || '.7' WHEN 'signup' THEN user_id || '.0' ELSE user_id::VARCHAR END
  || ', "tags": [{"k": ' || user_id || ', "on": true}, {"k": ' || CASE event_type WHEN 'view' THEN 'true' ELSE event_id::VARCHAR END
  || ', "on": ' || CASE event_type WHEN 'purchase' THEN '"true"' ELSE 'false' END || '}]}'
  || ', "grid": [[1, ' || user_id || '], [], [' || CASE event_type WHEN 'view' THEN '3000000000' ELSE '7' END || ']]'
  || ', "price": {"$numberDecimal": "1234567890123456789012345678.' || lpad((user_id % 1000)::VARCHAR, 4, '0') || '"}'
  || ', "count": "NumberLong(' || event_id || ')"}'"""
NESTED_SPARK_LINE = NESTED_LINE.replace("::VARCHAR", "::STRING")


@query(
    sql=f"""
SELECT CASE event_type WHEN 'error' THEN 'bad type: box.n' WHEN 'view' THEN 'bad type: box.tags[1].k,grid[2][0]'
    WHEN 'purchase' THEN 'bad type: box.tags[1].on' END AS reason,
  CASE WHEN reason IS NOT NULL THEN {NESTED_LINE} END AS line,
  CASE WHEN reason IS NULL THEN event_id END AS event_id, CASE WHEN reason IS NULL THEN user_id END AS n,
  CASE WHEN reason IS NULL THEN event_id END AS last_k, CASE WHEN reason IS NULL THEN user_id::INTEGER END AS cell,
  CASE WHEN reason IS NULL THEN '1234567890123456789012345678.' || lpad((user_id % 1000)::VARCHAR, 4, '0') END AS price,
  CASE WHEN reason IS NULL THEN event_id END AS count
FROM events
"""
)
def ext_json_nested(spark, sf_dir):
    """Structs and arrays at depth: a value that its column cannot hold exactly sends the line to quarantine, with its path."""
    folder = scratch_dir(spark, "nested")
    table(spark, sf_dir, "events").select(F.expr(NESTED_SPARK_LINE).alias("value")).write.text(folder)
    good, bad = read_documents(read_lines(spark, folder), T.StructType.fromDDL(NESTED_ROW), with_id=False)
    null = F.lit(None)
    kept = good.select(
        null.cast("string").alias("reason"), null.cast("string").alias("line"), "event_id", F.col("box.n").alias("n"),
        F.element_at("box.tags", -1)["k"].alias("last_k"), F.col("grid")[0][1].alias("cell"), F.col("price").cast("string").alias("price"), "count")
    aside = bad.select("reason", F.col("value").alias("line"), *[null.cast(kept.schema[c].dataType).alias(c) for c in kept.columns[2:]])
    return kept.unionByName(aside)


def bson_document():
    """Each order as a BSON document, without its closing zero byte."""

    def element(kind: int, name: str, data):
        return F.concat(F.lit(bytearray(bytes([kind]) + name.encode() + b"\0")), data)

    priority = F.encode("o_orderpriority", "UTF-8")
    size = le32_bytes(F.octet_length("o_orderpriority") + 1)
    ntz = T.TimestampNTZType()
    body = F.concat(
        element(0x12, "o_orderkey", le64_bytes(F.col("o_orderkey"))),
        element(0x12, "o_custkey", le64_bytes(F.col("o_custkey"))),
        element(0x09, "o_orderdate", le64_bytes(millis(F.col("o_orderdate"), ntz))),
        element(0x02, "o_orderpriority", F.concat(size, priority, F.lit(bytearray(b"\0")))),
    )
    return F.concat(le32_bytes(F.octet_length(body) + 5), body)


ORDER_ROW = "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp, o_orderpriority string"


@query(
    sql="""
SELECT o_orderkey, o_custkey, epoch_ms(o_orderdate)::BIGINT AS order_ms, o_orderpriority FROM orders
"""
)
def bson_scan(spark, sf_dir):
    """Orders written as BSON files: text lines that end in the zero byte of each document."""
    folder = scratch_dir(spark, "bson")
    documents = table(spark, sf_dir, "orders").select(bson_document().cast("string").alias("value"))
    documents.write.option("lineSep", "\0").text(folder)
    lines = read_bson(spark, folder, range_bytes=256 * 1024).select("value")
    schema = T.StructType.fromDDL(ORDER_ROW)
    typed = normalize_ext_json(parse_documents(lines).select("doc"), schema)
    return typed.select(
        "o_orderkey", "o_custkey", F.unix_millis("o_orderdate").alias("order_ms"), "o_orderpriority"
    )


@query(
    sql=f"""
SELECT o_orderkey, o_custkey, c.chunk_id
FROM orders JOIN {RANGE_CHUNKS_SQL} c ON {in_chunk_sql('o_custkey')}
"""
)
def chunk_scan(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    regions = names(table(spark, sf_dir, "region"), "r_name")
    size = F.lit(ROW_BYTES).cast("bigint")
    chunks = range_chunks(orders, [("o_custkey", "asc")], size, regions, RANGE_BYTES)
    return read_chunks(orders, chunks, "o_custkey").select("o_orderkey", "o_custkey", CHUNK)


SOME_STEP = 5


@query(
    sql=f"""
SELECT o_orderkey, k, chunk_id FROM (
  SELECT o_orderkey, k, CASE WHEN k IS NULL THEN 0 ELSE least(k // {SOME_STEP}, n) END::BIGINT AS chunk_id
  FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 11 <> 0 THEN o_custkey END AS k FROM orders),
       (SELECT max(o_custkey) // {SOME_STEP} AS n FROM orders))
WHERE chunk_id % 2 = 0
"""
)
def chunk_scan_some(spark, sf_dir):
    """Every second chunk of a table with null keys; they belong to the lowest chunk."""
    orders = table(spark, sf_dir, "orders")
    top = orders.agg(F.max("o_custkey")).first()[0]
    ends = spark.range(1, top // SOME_STEP + 1).select((F.col("id") * SOME_STEP).alias("max_key"))
    ends = ends.union(spark.range(1).select(F.lit(None).cast("bigint"))).withColumn("shard", F.lit("s"))
    keyed = orders.select("o_orderkey", F.when(F.col("o_orderkey") % 11 != 0, F.col("o_custkey")).alias("k"))
    return read_chunks(keyed, chunk_ranges(ends), "k", only=spark.range(0, top // SOME_STEP + 1, 2).select(F.col("id").alias(CHUNK)))
