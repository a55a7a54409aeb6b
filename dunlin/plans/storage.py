"""Plans for sources, sinks, layout and the catalog.

Each source plan first renders a table in the format under test into the
shared scratch folder and then reads it back.
"""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dunlin.operators import catalog as C
from dunlin.plans.registry import Tables, plan
from dunlin.session import materialize, scratch_path
from dunlin.sources import readers as R
from dunlin.sources import records as B
from dunlin.sources import writers as K


def rows(name: str = "n"):
    return F.count(F.lit(1)).alias(name)


def written(df: DataFrame, fmt: str, label: str, **options) -> str:
    path = scratch_path(df.sparkSession, label)
    K.write_table(df, path, fmt, **options)
    return path


# -------------------------------------------------------------------- sources

ORDERS_DDL = "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"


@plan("S01_delimited_declared_schema", """
    SELECT o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total, max(o_orderdate) AS last FROM orders GROUP BY 1""")
def _(t: Tables):
    path = written(t.orders, "csv", "s01", sep=";", header="true")
    back = R.read_delimited(t.spark, path, ORDERS_DDL, sep=";")
    return back.groupBy("o_orderstatus").agg(rows(), F.round(F.sum("o_totalprice"), 2).alias("total"),
                                             F.max("o_orderdate").alias("last"))


@plan("S02_delimited_inferred", """
    SELECT count(*) AS n, count(CASE WHEN p_partkey % 5 <> 0 THEN p_size END) AS sized,
      CAST(sum(CASE WHEN p_partkey % 5 <> 0 THEN p_size END) AS BIGINT) AS total, round(sum(p_retailprice), 2) AS price FROM part""")
def _(t: Tables):
    holed = t.part.withColumn("p_size", F.when(F.col("p_partkey") % 5 != 0, F.col("p_size").cast("string")).otherwise("NA"))
    back = R.read_delimited(t.spark, written(holed, "csv", "s02", header="true"), null_token="NA", infer=True)
    return back.agg(rows(), F.count("p_size").alias("sized"), F.sum("p_size").alias("total"),
                    F.round(F.sum("p_retailprice"), 2).alias("price"))


@plan("S03_all_strings", "SELECT c_nationkey, count(*) AS n, round(sum(c_acctbal), 2) AS bal FROM customer GROUP BY 1")
def _(t: Tables):
    back = R.read_delimited(t.spark, written(t.customer, "csv", "s03", header="true"))
    typed = back.select(F.col("c_nationkey").cast("int"), F.col("c_acctbal").cast("double"))
    return typed.groupBy("c_nationkey").agg(rows(), F.round(F.sum("c_acctbal"), 2).alias("bal"))


@plan("S04_lines_to_typed_rows", "SELECT doc_id, lang, n_chars FROM documents")
def _(t: Tables):
    header = "doc_id;lang;n_chars"
    lines = t.documents.select(F.concat_ws(";", "doc_id", F.concat(F.lit(" "), "lang"), "n_chars").alias("value"))
    headed = lines.union(t.documents.groupBy().agg(F.lit(header).alias("value")))
    path = written(headed, "text", "s04")
    return R.typed_fields(R.read_lines(t.spark, path), {"doc_id": "bigint", "lang": "string", "n_chars": "bigint"}, ";", header)


@plan("S05_minimum_partitions", "SELECT count(*) AS n, true AS enough_partitions FROM customer")
def _(t: Tables):
    path = written(t.customer.select("c_name"), "text", "s05")
    lines = R.read_lines(t.spark, path, partitions=4)
    per_task = lines.groupBy(F.spark_partition_id().alias("p")).agg(rows())
    return per_task.agg(F.sum("n").alias("n"), (F.count(F.lit(1)) >= 4).alias("enough_partitions"))


@plan("S06_whole_files", """
    SELECT count(*) AS sources, CAST(sum(n) AS BIGINT) AS lines FROM (SELECT source, count(*) AS n FROM documents GROUP BY 1)""")
def _(t: Tables):
    ids = t.documents.select("source", F.col("doc_id").cast("string").alias("value"))
    path = written(ids, "text", "s06", partition_by=["source"], max_records_per_file=100_000)
    whole = R.read_whole_files(t.spark, f"{path}/source=*")
    folder = F.regexp_extract("path", "source=([^/]*)/", 1)
    return whole.agg(F.countDistinct(folder).alias("sources"),
                     F.sum(F.regexp_count("content", F.lit("\n"))).alias("lines"))


@plan("S07_many_files_with_origin", "SELECT concat('event_type=', event_type) AS folder, count(*) AS lines FROM events GROUP BY 1")
def _(t: Tables):
    path = written(t.events.select("event_type", F.col("event_id").cast("string").alias("value")), "text", "s07",
                   partition_by=["event_type"])
    lines = R.read_with_origin(t.spark, path)
    return lines.groupBy(F.get(F.split("path", "/"), F.size(F.split("path", "/")) - 2).alias("folder")).agg(rows("lines"))


@plan("S08_json_lines", """
    SELECT CAST(props ->> 'k' AS BIGINT) AS k, count(*) AS n FROM events GROUP BY 1""")
def _(t: Tables):
    path = written(t.events.select(F.col("props").alias("value")), "text", "s08")
    return R.read_json(t.spark, path, "k BIGINT").groupBy("k").agg(rows())


@plan("S09_multi_line_json", "SELECT n_regionkey, count(*) AS n, CAST(sum(n_nationkey) AS BIGINT) AS keys FROM nation GROUP BY 1")
def _(t: Tables):
    body = F.concat(F.lit("[\n"), F.to_json(F.struct("n_nationkey", "n_regionkey")), F.lit("\n]"))
    pretty = F.regexp_replace(body, ",", ",\n")
    path = written(t.nation.select("n_regionkey", "n_nationkey", pretty.alias("value"))
                   .repartition("n_nationkey").select("n_nationkey", "value"), "text", "s09", partition_by=["n_nationkey"])
    back = R.read_json(t.spark, f"{path}/*", "n_nationkey INT, n_regionkey INT", multi_line=True)
    return back.groupBy("n_regionkey").agg(rows(), F.sum("n_nationkey").alias("keys"))


@plan("S09_multi_line_csv", "SELECT n_nationkey, concat(n_name, chr(10), n_regionkey, ', \"quoted\"') AS note FROM nation")
def _(t: Tables):
    # Line breaks, separators and quotes inside a field.
    note = F.concat("n_name", F.lit("\n"), F.col("n_regionkey").cast("string"), F.lit(', "quoted"'))
    path = written(t.nation.select("n_nationkey", note.alias("note")), "csv", "s09c", header="true", escape='"')
    return R.read_delimited(t.spark, path, "n_nationkey INT, note STRING", multiLine="true", escape='"')


@plan("S08_json_lines_inferred", """
    SELECT CAST(props ->> 'k' AS BIGINT) AS k, count(*) AS n, true AS typed FROM events GROUP BY 1""")
def _(t: Tables):
    path = written(t.events.select(F.col("props").alias("value")), "text", "s08i")
    found = R.read_json(t.spark, path)
    return found.groupBy("k").agg(rows(), F.lit(dict(found.dtypes)["k"] == "bigint").alias("typed"))


@plan("S10_bad_record_modes", """
    SELECT count(*) AS permissive, count(*) FILTER (event_id % 10 = 0) AS corrupt,
           count(*) FILTER (event_id % 10 <> 0) AS kept, true AS failfast_raised FROM events""")
def _(t: Tables):
    broken = F.when(F.col("event_id") % 10 == 0, F.lit('{"k": oops')).otherwise(F.col("props"))
    path = written(t.events.select(broken.alias("value")), "text", "s10")
    spark = t.spark
    loose = R.read_json(spark, path, "k INT", "PERMISSIVE", "_bad")
    dropped = R.read_json(spark, path, "k INT", "DROPMALFORMED")
    try:
        R.read_json(spark, path, "k INT", "FAILFAST").agg(F.sum("k")).first()
        raised = False
    except (PySparkException, Py4JJavaError) as error:
        raised = "MALFORMED_RECORD" in str(error)
    both = loose.agg(rows("permissive"), F.count_if(F.col("_bad").isNotNull() & F.col("k").isNull()).alias("corrupt"))
    kept = dropped.agg(F.count("k").alias("kept"))
    return both.select("*", kept.scalar().alias("kept"), F.lit(raised).alias("failfast_raised"))


@plan("S11_xml_rows", "SELECT page_id, url, CAST(length(html) AS INTEGER) AS chars, md5(html) AS digest FROM pages")
def _(t: Tables):
    # Raw markup: tags, entities and quotes have to be escaped and read back as text.
    path = written(t.pages.select("page_id", "url", F.col("html").alias("body")), "xml", "s11", rowTag="page", rootTag="pages")
    back = R.read_xml(t.spark, path, "page", "page_id BIGINT, url STRING, body STRING")
    return back.select("page_id", "url", F.length("body").alias("chars"), F.md5("body").alias("digest"))


@plan("S12_parquet", "SELECT l_linestatus, count(*) AS n, round(sum(l_extendedprice), 2) AS total FROM lineitem WHERE l_quantity >= 25 GROUP BY 1")
def _(t: Tables):
    return t.lineitem.where("l_quantity >= 25").groupBy("l_linestatus").agg(
        rows(), F.round(F.sum("l_extendedprice"), 2).alias("total"))


@plan("S14_inline_rows", """
    SELECT label, count(*) AS n FROM orders JOIN (VALUES ('F', 'finished'), ('O', 'open')) v(code, label) ON o_orderstatus = code GROUP BY 1""")
def _(t: Tables):
    codes = R.inline_rows(t.spark, [("F", "finished"), ("O", "open")], "code string, label string")
    return t.orders.join(F.broadcast(codes), F.col("o_orderstatus") == F.col("code")).groupBy("label").agg(rows())


@plan("S15_generated_rows", """
    SELECT count(*) AS n, CAST(sum(l_orderkey * 0 + 1) AS BIGINT) AS matched, true AS uniform_ok, true AS normal_ok FROM lineitem""")
def _(t: Tables):
    # As many rows are generated as the fact table holds.
    n = t.lineitem.count()
    made = R.generated_rows(t.spark, n, seed=10)
    return made.agg(
        rows(), F.countDistinct("id").alias("matched"),
        (F.abs(F.avg("uniform") - 0.5) < 0.02).alias("uniform_ok"), (F.abs(F.avg("normal")) < 0.05).alias("normal_ok"))


def _product_blocks(t: Tables) -> DataFrame:
    """Parts as record blocks; reviews are per-flag totals of their lines."""
    flags = (t.lineitem.groupBy("l_partkey", "l_returnflag")
             .agg(rows(), F.max("l_shipdate").alias("d"), F.max("l_linenumber").alias("v")))
    line = F.concat(F.lit("    "), F.date_format("d", "yyyy-M-d"), F.lit("  cutomer: C"), "l_returnflag", F.lit("  rating: "),
                    F.col("v").cast("string"), F.lit("  votes:   "), F.col("n").cast("string"), F.lit("  helpful:   "),
                    F.col("v").cast("string"))
    reviews = flags.groupBy("l_partkey").agg(F.sort_array(F.collect_list(line)).alias("lines"))
    joined = t.part.join(reviews, F.col("p_partkey") == F.col("l_partkey"), "left")
    n = F.coalesce(F.size("lines"), F.lit(0)).cast("string")
    head = F.concat(F.lit("Id:   "), F.col("p_partkey").cast("string"), F.lit("\nASIN: A"), F.col("p_partkey").cast("string"))
    full = F.concat(
        head, F.lit('\n  title: Id: "'), "p_name", F.lit('"\n  group: '), "p_type", F.lit("\n  salesrank: "),
        F.col("p_size").cast("string"), F.lit("\n  similar: 2  "), F.lit("A"), (F.col("p_partkey") + 1).cast("string"),
        F.lit("  A"), (F.col("p_partkey") + 2).cast("string"), F.lit("\n  categories: 1\n   |Parts["), "p_brand",
        F.lit("]\\X\n  reviews: total: "), n, F.lit("  downloaded: "), n, F.lit("  avg rating: 4.5"),
        F.when(F.size("lines") > 0, F.concat(F.lit("\n"), F.array_join("lines", "\n"))).otherwise(F.lit("")))
    gone = F.concat(head, F.lit("\n  discontinued product"))
    return joined.select(F.when(F.col("p_size") == 1, gone).otherwise(full).alias("value"))


_S16 = """
    WITH f AS (SELECT l_partkey, l_returnflag, count(*) AS n, max(l_linenumber) AS v FROM lineitem GROUP BY 1, 2),
         r AS (SELECT l_partkey, count(*) AS k, sum(n) AS votes, sum(v) AS rating FROM f GROUP BY 1)"""


@plan("S16_product_blocks", _S16 + """
    SELECT p_partkey AS id, concat('A', p_partkey) AS asin, CASE WHEN p_size <> 1 THEN concat('Id: "', p_name, '"') END AS title,
      CASE WHEN p_size <> 1 THEN p_type END AS kind, CASE WHEN p_size <> 1 THEN p_size END AS salerank,
      CASE WHEN p_size <> 1 THEN concat('A', p_partkey + 1, ',A', p_partkey + 2) END AS similar,
      CASE WHEN p_size <> 1 THEN concat('|Parts[', p_brand, ']', chr(92), 'X') END AS category,
      CASE WHEN p_size <> 1 THEN coalesce(k, 0)::INTEGER END AS downloaded, CASE WHEN p_size <> 1 THEN coalesce(votes, 0)::BIGINT END AS votes,
      CASE WHEN p_size <> 1 THEN coalesce(rating, 0)::BIGINT END AS rating FROM part LEFT JOIN r ON p_partkey = l_partkey""")
def _(t: Tables):
    path = written(_product_blocks(t), "text", "s16", lineSep="\n\n")
    products = B.parse_blocks(B.read_blocks(t.spark, path))

    def total(field):
        return F.aggregate("reviewLines", F.lit(0).cast("long"), lambda a, r: a + r["review"][field])

    return products.select(
        F.col("Id").alias("id"), F.col("ASIN").alias("asin"), "title", F.col("group").alias("kind"), "salerank",
        F.when(F.col("similars").isNotNull(), F.concat_ws(",", "similarLines.similar")).alias("similar"),
        F.get("categoryLines.category", F.lit(0)).alias("category"), F.col("ReviewMetaData.downloaded").alias("downloaded"),
        total("votes").alias("votes"), total("rating").alias("rating"))


@plan("S17_nested_rows_to_json", """
    SELECT p_partkey AS id, CASE WHEN p_size <> 1 THEN concat('Id:  ', p_name, ' ') END AS title,
      CASE WHEN p_size <> 1 THEN concat('|Parts[', p_brand, ']/X') END AS category FROM part""")
def _(t: Tables):
    products = B.parse_blocks(_product_blocks(t))
    path = written(B.to_json_lines(products), "text", "s17")
    back = R.read_json(t.spark, path, "Id BIGINT, title STRING, categoryLines ARRAY<STRUCT<category: STRING>>")
    return back.select(F.col("Id").alias("id"), "title", F.get("categoryLines.category", F.lit(0)).alias("category"))


@plan("S18_standardized_arrays", """
    WITH x AS (SELECT label, unnest(embedding)::DOUBLE AS v, unnest(range(64)) AS d FROM embeddings),
         m AS (SELECT avg(v) AS mean, stddev_pop(v) AS std FROM x)
    SELECT d::INTEGER AS d, round(avg((v - mean) / std), 6) AS mean, round(stddev_pop((v - mean) / std), 6) AS std,
           CAST(sum(label + 1) AS BIGINT) AS labels FROM x, m GROUP BY 1""")
def _(t: Tables):
    pixels = t.embeddings.select("embedding", (F.col("label") + 1).alias("label"))
    m = R.array_moments(pixels, "embedding")
    scaled = R.standardize_array(pixels, "embedding", m.select("mean").scalar(), m.select("std").scalar())
    return (scaled.select("label", F.posexplode("embedding").alias("d", "v")).groupBy("d")
            .agg(F.round(F.avg("v"), 6).alias("mean"), F.round(F.stddev_pop("v"), 6).alias("std"),
                 F.sum("label").alias("labels")))


@plan("S19_wide_numeric_rows", """
    SELECT (d + 1)::INTEGER AS d, round(sum(v), 4) AS total FROM (SELECT unnest(embedding)::DOUBLE AS v, unnest(range(64)) AS d FROM embeddings) GROUP BY 1""")
def _(t: Tables):
    line = F.concat_ws(",", F.col("label").cast("string"), F.transform("embedding", lambda x: x.cast("double").cast("string")))
    path = written(t.embeddings.select(line.alias("value")), "text", "s19")
    wide = R.name_features(R.read_wide(t.spark, path), [f"c{i}" for i in range(64)])
    sums = wide.agg(*[F.sum(f"c{i}").alias(f"c{i}") for i in range(64)])
    return sums.select(F.posexplode(F.array(*sums.columns)).alias("d", "v")).select(
        (F.col("d") + 1).alias("d"), F.round("v", 4).alias("total"))


# ------------------------------------------------------------ sinks and layout


@plan("K01_csv_overwrite_append", "SELECT c_mktsegment, 2 * count(*) AS n FROM customer GROUP BY 1")
def _(t: Tables):
    path = scratch_path(t.spark, "k01")
    for mode in ("overwrite", "append"):
        K.write_table(t.customer, path, "csv", mode, header="true")
    return R.read_delimited(t.spark, path).groupBy("c_mktsegment").agg(rows())


@plan("K02_json", "SELECT o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1")
def _(t: Tables):
    path = written(t.orders, "json", "k02")
    back = R.read_json(t.spark, path, "o_orderstatus STRING, o_totalprice DOUBLE")
    return back.groupBy("o_orderstatus").agg(rows(), F.round(F.sum("o_totalprice"), 2).alias("total"))


@plan("K03_parquet", "SELECT * FROM orders")
def _(t: Tables):
    return materialize(t.orders, "k03")


@plan("K04_partitioned_write", """
    SELECT l_returnflag, count(*) AS n, round(sum(l_quantity), 2) AS qty FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1""")
def _(t: Tables):
    path = written(t.lineitem, "parquet", "k04", partition_by=["l_returnflag"], max_records_per_file=5_000_000, rebalance=True)
    return (t.spark.read.parquet(path).where("l_returnflag = 'R'").groupBy("l_returnflag")
            .agg(rows(), F.round(F.sum("l_quantity"), 2).alias("qty")))


_CODECS = ("snappy", "gzip", "zstd")


@plan("K05_compression_codecs", " UNION ALL ".join(
    f"SELECT '{c}' AS codec, count(*) AS n, CAST(sum(p_size) AS BIGINT) AS total FROM part" for c in _CODECS))
def _(t: Tables):
    out = None
    for codec in _CODECS:
        path = written(t.part, "parquet", "k05", compression=codec)
        one = t.spark.read.parquet(path).agg(rows(), F.sum("p_size").alias("total")).select(F.lit(codec).alias("codec"), "n", "total")
        out = one if out is None else out.union(one)
    return out


@plan("K06_reshape_before_write", "SELECT s_nationkey AS nation, s_suppkey AS id, s_name AS name FROM supplier")
def _(t: Tables):
    shaped = t.supplier.withColumnRenamed("s_suppkey", "id").withColumnRenamed("s_nationkey", "nation")
    return materialize(shaped.withColumnRenamed("s_name", "name").select("nation", "id", "name"), "k06")


@plan("K07_repartition_by_key", "SELECT count(DISTINCT p_type) AS keys, 1::BIGINT AS most_partitions_per_key FROM part")
def _(t: Tables):
    tasks = int(t.spark.conf.get("spark.sql.shuffle.partitions"))
    placed = t.part.repartition(tasks, "p_type").select("p_type", F.spark_partition_id().alias("p"))
    per_key = placed.groupBy("p_type").agg(F.countDistinct("p").alias("parts"))
    return per_key.agg(rows("keys"), F.max("parts").alias("most_partitions_per_key"))


@plan("K08_coalesce", "SELECT count(*) AS n, true AS few_partitions FROM orders")
def _(t: Tables):
    cores = t.spark.sparkContext.defaultParallelism
    narrowed = t.orders.select("o_orderkey").repartition(2 * cores).coalesce(cores)
    return narrowed.groupBy(F.spark_partition_id().alias("p")).agg(rows()).agg(
        F.sum("n").alias("n"), (F.count(F.lit(1)) <= cores).alias("few_partitions"))


def _database(t: Tables):
    name = f"dunlin_{uuid.uuid4().hex[:12]}"
    return C.scratch_database(t.spark, name, scratch_path(t.spark, "db"))


@plan("K09_insert_into_table", "SELECT n_regionkey AS region, count(*) AS n FROM nation GROUP BY 1")
def _(t: Tables):
    with _database(t) as db:
        C.create_table(t.spark, f"{db}.nations", t.nation.select("n_nationkey", "n_regionkey").schema)
        for _ in range(2):
            K.insert_into(t.nation.select("n_nationkey", "n_regionkey"), f"{db}.nations")
        stored = t.spark.table(f"{db}.nations").groupBy(F.col("n_regionkey").alias("region")).agg(rows())
        return materialize(stored, "k09")


# -------------------------------------------------------------------- catalog


@plan("C01_view_and_sql_text", """
    SELECT o_orderpriority, count(*) AS n FROM orders WHERE o_totalprice > 100000 GROUP BY 1""")
def _(t: Tables):
    return C.query_view(t.orders, "dunlin_orders", "SELECT o_orderpriority, count(*) AS n FROM dunlin_orders "
                        "WHERE o_totalprice > 100000 GROUP BY o_orderpriority")


@plan("C02_catalog_listing", """
    SELECT true AS has_database, true AS listed, false AS listed_after_drop, count(*) AS n FROM region""")
def _(t: Tables):
    catalog, view = t.spark.catalog, f"dunlin_v{uuid.uuid4().hex[:8]}"
    t.region.createOrReplaceTempView(view)
    before = view in C.list_views(t.spark)
    has = catalog.currentDatabase() in {d.name for d in catalog.listDatabases()}
    catalog.dropTempView(view)
    after = view in C.list_views(t.spark)
    return t.region.agg(F.lit(has).alias("has_database"), F.lit(before).alias("listed"),
                        F.lit(after).alias("listed_after_drop"), rows())


@plan("C03_cache", "SELECT p_type, count(*) AS n, true AS was_cached, count(*) AS n_cached FROM part GROUP BY 1")
def _(t: Tables):
    plain = t.part.groupBy("p_type").agg(rows())
    with C.persisted(t.part.select("p_type")) as kept:
        cached = materialize(kept.groupBy("p_type").agg(rows("n_cached")), "c03")
        flag = kept.is_cached
    return plain.join(cached, "p_type").select("p_type", "n", F.lit(flag).alias("was_cached"), "n_cached")


@plan("C04_managed_table", """
    SELECT 'r_regionkey' AS col_name, 'int' AS data_type, count(*) AS n FROM region
    UNION ALL SELECT 'r_name', 'string', count(*) FROM region""")
def _(t: Tables):
    with _database(t) as db:
        C.create_table(t.spark, f"{db}.regions", t.region.schema)
        K.insert_into(t.region, f"{db}.regions")
        described = (t.spark.sql(f"DESCRIBE EXTENDED {db}.regions").where(F.col("col_name").isin(t.region.columns))
                     .select("col_name", "data_type"))
        count = t.spark.table(f"{db}.regions").agg(rows()).scalar()
        return materialize(described.select("*", count.alias("n")), "c04")


@plan("C05_table_statistics", """
    SELECT 'o_orderkey' AS "column", count(*) AS rows, 0::BIGINT AS nulls, min(o_orderkey)::VARCHAR AS min, max(o_orderkey)::VARCHAR AS max FROM orders
    UNION ALL SELECT 'o_custkey', count(*), 0, min(o_custkey)::VARCHAR, max(o_custkey)::VARCHAR FROM orders""")
def _(t: Tables):
    with _database(t) as db:
        C.create_table(t.spark, f"{db}.o", t.orders.select("o_orderkey", "o_custkey").schema)
        K.insert_into(t.orders.select("o_orderkey", "o_custkey"), f"{db}.o")
        return C.table_statistics(t.spark, f"{db}.o", ["o_orderkey", "o_custkey"])


@plan("C06_schema_rows", """
    SELECT pos, name, type, (SELECT count(*) FROM customer) AS rows, 5 AS columns FROM (VALUES (0, 'c_custkey', 'bigint'), (1, 'c_name', 'string'),
      (2, 'c_nationkey', 'int'), (3, 'c_acctbal', 'double'), (4, 'c_mktsegment', 'string')) v(pos, name, type)""")
def _(t: Tables):
    dim = C.dimensions(t.customer)
    return C.schema_rows(t.customer).drop("nullable").select(
        "*", dim.select("rows").scalar().alias("rows"), dim.select("columns").scalar().alias("columns"))


@plan("C07_schema_json", "SELECT true AS equal, count(*) AS n FROM events")
def _(t: Tables):
    schema = t.events.schema
    again = C.schema_from_json(C.schema_to_json(schema))
    return t.spark.read.schema(again).parquet(t.path("events")).agg(F.lit(again == schema).alias("equal"), rows())
