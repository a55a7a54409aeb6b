"""Plans for scalar functions, cleaning and missing data."""

from __future__ import annotations

from pyspark.sql import functions as F

from dunlin.functions import dates as D
from dunlin.functions import recode as C
from dunlin.functions import strings as S
from dunlin.operators import cleaning as M
from dunlin.operators.relational import join_on_expression
from dunlin.plans.registry import Tables, plan

# ----------------------------------------------------------- scalar functions


@plan("F01_trim", "SELECT c_custkey, trim(concat('  ', c_name, ' ')) AS name FROM customer")
def _(t: Tables):
    return t.customer.select("c_custkey", F.trim(F.concat(F.lit("  "), "c_name", F.lit(" "))).alias("name"))


@plan("F02_lower", "SELECT lower(c_mktsegment) AS segment, count(*) AS n FROM customer GROUP BY 1")
def _(t: Tables):
    return t.customer.groupBy(F.lower("c_mktsegment").alias("segment")).agg(F.count(F.lit(1)).alias("n"))


@plan("F03_split", """
    SELECT o_orderkey, CAST(len(string_split(o_orderpriority, '-')) AS INTEGER) AS parts,
           string_split(o_orderpriority, '-')[1] AS level FROM orders""")
def _(t: Tables):
    parts = F.split("o_orderpriority", "-")
    return t.orders.select("o_orderkey", F.size(parts).alias("parts"), F.get(parts, F.lit(0)).alias("level"))


@plan("F04_regex_replace_all", "SELECT doc_id, md5(regexp_replace(text, '[0-9]+', '#', 'g')) AS digest FROM documents")
def _(t: Tables):
    return t.documents.select("doc_id", F.md5(F.regexp_replace("text", "[0-9]+", "#")).alias("digest"))


@plan("F05_regex_replace_first", "SELECT doc_id, md5(regexp_replace(text, '[aeiou]+', '_')) AS digest FROM documents")
def _(t: Tables):
    return t.documents.select("doc_id", F.md5(S.replace_first(F.col("text"), "[aeiou]+", "_")).alias("digest"))


@plan("F06_regex_full_match", "SELECT p_partkey, regexp_full_match(p_name, '[a-m]+ [a-z]+') AS hit FROM part")
def _(t: Tables):
    return t.part.select("p_partkey", S.matches_fully(F.col("p_name"), "[a-m]+ [a-z]+").alias("hit"))


@plan("F07_count_matches", """
    SELECT doc_id, CAST(length(text) - length(replace(text, ',', '')) AS INTEGER) AS commas FROM documents""")
def _(t: Tables):
    return t.documents.select("doc_id", S.count_matches(F.col("text"), ",").alias("commas"))


@plan("F08_pad_after_last", """
    SELECT p_partkey, concat(p_name, ',', p_brand, repeat(',', 5), ',', p_type) AS record FROM part""")
def _(t: Tables):
    record = F.concat_ws(",", "p_name", "p_brand", "p_type")
    return t.part.select("p_partkey", S.pad_after_last(record, ",", 7).alias("record"))


@plan("F09_up_to_second_mark", """
    SELECT page_id, array_to_string(string_split(url, '/')[1:2], '/') AS head FROM pages""")
def _(t: Tables):
    return t.pages.select("page_id", S.up_to_second(F.col("url"), "/").alias("head"))


@plan("F10_contains_flag", "SELECT p_partkey, CASE WHEN contains(p_name, 'ring') THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS flag FROM part")
def _(t: Tables):
    return t.part.select("p_partkey", S.holds(F.col("p_name"), "ring").alias("flag"))


@plan("F11_standard_phone", """
    WITH p AS (SELECT s_suppkey, CASE WHEN s_suppkey % 2 = 0 THEN concat('310/', s_suppkey, '- ', s_nationkey)
                 ELSE concat('310-', s_suppkey, '- ', s_nationkey) END AS phone FROM supplier)
    SELECT s_suppkey, CASE WHEN contains(phone, '/') THEN
      replace(replace(replace(phone, '/', '-'), '- ', '-'), '--', '-') ELSE phone END AS phone FROM p""")
def _(t: Tables):
    mark = F.when(F.col("s_suppkey") % 2 == 0, "310/").otherwise("310-")
    raw = F.concat(mark, "s_suppkey", F.lit("- "), "s_nationkey")
    return t.supplier.select("s_suppkey", S.standard_phone(raw).alias("phone"))


@plan("F12_concat", """
    SELECT n_nationkey, concat(n_name, '/', n_regionkey) AS a, concat_ws('|', n_name, n_nationkey, n_regionkey) AS b FROM nation""")
def _(t: Tables):
    return t.nation.select(
        "n_nationkey", F.concat("n_name", F.lit("/"), "n_regionkey").alias("a"),
        F.concat_ws("|", F.array("n_name", F.col("n_nationkey").cast("string"),
                                 F.col("n_regionkey").cast("string"))).alias("b"))


@plan("F13_byte_length", "SELECT doc_id, CAST(strlen(text) AS INTEGER) AS bytes FROM documents")
def _(t: Tables):
    return t.documents.select("doc_id", F.octet_length("text").alias("bytes"))


@plan("F14_last_path_segment", "SELECT page_id, string_split(url, '/')[-1] AS leaf FROM pages")
def _(t: Tables):
    return t.pages.select("page_id", S.last_segment(F.col("url")).alias("leaf"))


@plan("F15_parse_timestamp", """
    SELECT event_id, date_trunc('minute', ts) AS minute, date_trunc('millisecond', ts) AS milli,
           date_trunc('second', ts) AS logged, CAST(NULL AS TIMESTAMP) AS bad FROM events""")
def _(t: Tables):
    ts = F.col("ts")
    minute = D.parse_timestamp(F.date_format(ts, "dd/MM/yyHH:mm"), "dd/MM/yyHH:mm")
    milli = D.parse_compact_millis(F.date_format(ts, "yyyyMMddHHmmssSSS"))
    logged = D.parse_timestamp(
        F.concat(F.lit("["), F.date_format(ts, "dd/MMM/yyyy:HH:mm:ss"), F.lit(" +0000]")), D.LOG_FORMAT)
    bad = D.parse_timestamp(F.col("event_type"), "yyyy-MM-dd")
    return t.events.select("event_id", *[c.cast("timestamp_ntz").alias(n) for c, n in
                                         ((minute, "minute"), (milli, "milli"), (logged, "logged"), (bad, "bad"))])


@plan("F16_date_parts", """
    SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, CAST(day(o_orderdate) AS INTEGER) AS dd,
           CAST(month(o_orderdate) AS INTEGER) AS mm, CAST(year(o_orderdate) AS INTEGER) AS yy FROM orders""")
def _(t: Tables):
    d = F.to_date("o_orderdate")
    return t.orders.select("o_orderkey", d.alias("d"), F.dayofmonth(d).alias("dd"),
                           F.month(d).alias("mm"), F.year(d).alias("yy"))


@plan("F17_day_name", "SELECT dayname(l_shipdate) AS day, count(*) AS n FROM lineitem GROUP BY 1")
def _(t: Tables):
    return t.lineitem.groupBy(D.day_name(F.col("l_shipdate")).alias("day")).agg(F.count(F.lit(1)).alias("n"))


@plan("F18_iso_day_number", "SELECT CAST(isodow(l_shipdate) AS INTEGER) AS day, count(*) AS n FROM lineitem GROUP BY 1")
def _(t: Tables):
    return t.lineitem.groupBy(D.iso_day_number(F.col("l_shipdate")).alias("day")).agg(F.count(F.lit(1)).alias("n"))


@plan("F19_timestamp_from_parts", """
    SELECT o_orderkey, make_timestamp(year(o_orderdate), month(o_orderdate), day(o_orderdate), 0, 0, 0) AS ts FROM orders""")
def _(t: Tables):
    d = F.col("o_orderdate")
    return t.orders.select("o_orderkey", D.from_parts(F.year(d), F.month(d), F.dayofmonth(d)).alias("ts"))


@plan("F20_round", "SELECT l_orderkey, l_linenumber, l_partkey, round(l_extendedprice, 1) AS price, round(l_quantity / 60, 3) AS mins FROM lineitem")
def _(t: Tables):
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", F.round("l_extendedprice", 1).alias("price"),
                             F.round(F.col("l_quantity") / 60, 3).alias("mins"))


@plan("F21_arithmetic", """
    SELECT c_custkey, abs(c_acctbal) AS a, round(ln(abs(c_acctbal) + 1), 6) AS l, c_custkey % 13 AS m,
           round(c_acctbal * 3 / 7 + 2, 4) AS x FROM customer""")
def _(t: Tables):
    bal = F.col("c_acctbal")
    return t.customer.select("c_custkey", F.abs(bal).alias("a"), F.round(F.log(F.abs(bal) + 1), 6).alias("l"),
                             (F.col("c_custkey") % 13).alias("m"), F.round(bal * 3 / 7 + 2, 4).alias("x"))


@plan("F22_bitwise_and", "SELECT o_orderkey, o_orderkey & 1023 AS low FROM orders")
def _(t: Tables):
    return t.orders.select("o_orderkey", F.col("o_orderkey").bitwiseAND(1023).alias("low"))


@plan("F23_integer_division", "SELECT o_orderkey, o_orderkey // 10 AS tens FROM orders")
def _(t: Tables):
    return t.orders.select("o_orderkey", (F.col("o_orderkey") / 10).cast("long").alias("tens"))


@plan("F24_seeded_random", "SELECT count(*) AS n, true AS uniform_ok, true AS normal_ok FROM lineitem")
def _(t: Tables):
    noisy = t.lineitem.select(F.rand(7).alias("u"), F.randn(7).alias("z"))
    return noisy.agg(
        F.count(F.lit(1)).alias("n"),
        ((F.min("u") >= 0) & (F.max("u") < 1) & (F.abs(F.avg("u") - 0.5) < 0.02)).alias("uniform_ok"),
        ((F.abs(F.avg("z")) < 0.05) & (F.abs(F.stddev("z") - 1) < 0.05)).alias("normal_ok"))


@plan("F25_unique_row_id", "SELECT count(*) AS n, count(*) AS ids FROM documents")
def _(t: Tables):
    ids = t.documents.select(F.monotonically_increasing_id().alias("id"))
    return ids.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("id").alias("ids"))


@plan("F26_array_element", """
    SELECT vec_id, embedding[1] AS first, embedding[64] AS last, CAST(NULL AS FLOAT) AS beyond FROM embeddings""")
def _(t: Tables):
    return t.embeddings.select("vec_id", *[F.get("embedding", F.lit(i)).alias(n)
                                           for i, n in ((0, "first"), (63, "last"), (64, "beyond"))])


@plan("F27_explode", """
    SELECT label, d, round(sum(v), 3) AS total FROM (SELECT label, unnest(embedding)::DOUBLE AS v,
      unnest(range(64))::INTEGER AS d FROM embeddings) GROUP BY 1, 2""")
def _(t: Tables):
    exploded = t.embeddings.select("label", F.posexplode("embedding").alias("d", "v"))
    return exploded.groupBy("label", "d").agg(F.round(F.sum(F.col("v").cast("double")), 3).alias("total"))


@plan("F28_field_of_struct_array", """
    SELECT c_custkey, concat(c_name, ',', c_mktsegment) AS names FROM customer""")
def _(t: Tables):
    lines = F.array(F.struct(F.col("c_name").alias("similar")), F.struct(F.col("c_mktsegment").alias("similar")))
    return (t.customer.select("c_custkey", lines.alias("lines"))
            .select("c_custkey", F.concat_ws(",", "lines.similar").alias("names")))


@plan("F29_struct_rename", "SELECT c_nationkey AS code, c_name AS name FROM customer WHERE c_nationkey IS NOT NULL")
def _(t: Tables):
    packed = t.customer.select(F.struct(F.col("c_nationkey").alias("code"), F.col("c_name").alias("name")).alias("info"))
    return packed.where(F.col("info.code").isNotNull()).select("info.*")


@plan("F30_from_json", "SELECT event_id, CAST(props ->> 'k' AS INTEGER) AS k FROM events")
def _(t: Tables):
    return t.events.select("event_id", F.from_json("props", "k INT").getField("k").alias("k"))


@plan("F31_to_json", """
    SELECT n_nationkey, concat('{"name":"', n_name, '","region":', n_regionkey, '}') AS doc FROM nation""")
def _(t: Tables):
    return t.nation.select("n_nationkey", F.to_json(F.struct(
        F.col("n_name").alias("name"), F.col("n_regionkey").alias("region"))).alias("doc"))


@plan("F32_value_bins", """
    SELECT p_partkey, CASE WHEN p_size < 10 THEN 'small' WHEN p_size < 30 THEN 'medium' ELSE 'large' END AS size_bin,
           CASE p_type WHEN 'ECONOMY' THEN 1 WHEN 'PROMO' THEN 2 WHEN 'MEDIUM' THEN 3 ELSE 0 END AS type_code FROM part""")
def _(t: Tables):
    return t.part.select(
        "p_partkey", C.bin_by_bounds(F.col("p_size"), [10, 30], ["small", "medium", "large"]).alias("size_bin"),
        C.recode(F.col("p_type"), {"ECONOMY": 1, "PROMO": 2, "MEDIUM": 3}, default=0).alias("type_code"))


@plan("F33_binarise_codes", """
    SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 0 END AS done FROM orders""")
def _(t: Tables):
    return t.orders.select("o_orderkey", C.recode(F.col("o_orderstatus"), {"F": 1, "O": 0}).alias("done"))


@plan("F34_factor_labels", """
    SELECT s_suppkey, s_nationkey, lower(n_name) AS nation FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey""")
def _(t: Tables):
    levels = t.nation.select("n_nationkey", F.lower("n_name").alias("label"))
    return C.factor(t.supplier.select("s_suppkey", "s_nationkey"), "s_nationkey", levels, "n_nationkey", "label", "nation")


@plan("F35_sum_over_columns", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_quantity + l_discount + l_tax AS total FROM lineitem""")
def _(t: Tables):
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey",
                             C.sum_of(["l_quantity", "l_discount", "l_tax"]).alias("total"))


# ----------------------------------------------- missing values and reshaping

GAPS = """
    SELECT event_id, CASE WHEN event_id % 7 = 0 THEN '?' ELSE event_type END AS kind,
           CASE WHEN event_id % 5 = 0 THEN '' ELSE CAST(user_id AS VARCHAR) END AS who,
           CASE WHEN event_id % 3 <> 0 THEN value END AS value FROM events"""


def gaps(t: Tables):
    """Events in which some cells are ``?``, empty or null."""
    key = F.col("event_id")
    return t.events.select(
        "event_id",
        F.when(key % 7 == 0, "?").otherwise(F.col("event_type")).alias("kind"),
        F.when(key % 5 == 0, "").otherwise(F.col("user_id").cast("string")).alias("who"),
        F.when(key % 3 != 0, F.col("value")).alias("value"))


@plan("M01_drop_token_rows", f"SELECT * FROM ({GAPS}) WHERE kind <> '?' AND who <> '?'")
def _(t: Tables):
    return M.drop_rows_with_token(gaps(t), "?")


@plan("M02_drop_empty_fields", f"SELECT * FROM ({GAPS}) WHERE who <> '' AND kind <> ''")
def _(t: Tables):
    return M.drop_empty(gaps(t), ["who", "kind"])


@plan("M03_empty_to_default", f"""
    SELECT event_id, kind, CASE WHEN who IN ('', '0') THEN 'NA' ELSE who END AS who, value FROM ({GAPS})""")
def _(t: Tables):
    return M.empty_to_default(gaps(t), "0", ["who"])


@plan("M04_replace_values", f"""
    SELECT event_id, CASE kind WHEN '?' THEN 'Missing' ELSE kind END AS kind, who, value FROM ({GAPS})""")
def _(t: Tables):
    return M.replace_values(gaps(t), {"?": "Missing"}, ["kind"])


@plan("M05_fill_nulls", f"SELECT event_id, kind, who, coalesce(value, -1) AS value FROM ({GAPS})")
def _(t: Tables):
    return gaps(t).na.fill({"value": -1.0, "kind": "unknown"})


@plan("M06_drop_null_rows", f"SELECT * FROM ({GAPS}) WHERE value IS NOT NULL")
def _(t: Tables):
    return gaps(t).dropna(subset=["value"])


@plan("M07_missing_profile", f"""
    WITH g AS ({GAPS}), c AS (SELECT count(*) AS total, count(*) FILTER (kind = '?') AS kind,
      count(*) FILTER (who = '?') AS who, count(*) FILTER (value IS NULL) AS value, 0 AS event_id FROM g)
    SELECT "column", missing, round(100.0::DOUBLE * missing / total, 4) AS pct FROM
      (SELECT 'kind' AS "column", kind::BIGINT AS missing, total FROM c UNION ALL SELECT 'who', who, total FROM c
       UNION ALL SELECT 'value', value, total FROM c UNION ALL SELECT 'event_id', event_id, total FROM c)""")
def _(t: Tables):
    return M.missing_profile(gaps(t), "?")


RAGGED = """
    SELECT CASE p_size % 3 WHEN 0 THEN concat_ws(',', p_partkey, p_type, p_name, p_brand, p_size)
      WHEN 1 THEN concat_ws(',', p_partkey, p_type, p_name, p_size) ELSE concat_ws(',', p_partkey, p_type, p_size) END AS line,
      p_partkey, p_type, p_name, p_brand, p_size FROM part"""


def ragged(t: Tables):
    """Parts as delimited lines with three to five fields, the size always last."""
    kind = F.col("p_size") % 3
    return t.part.select(
        F.when(kind == 0, F.concat_ws(",", "p_partkey", "p_type", "p_name", "p_brand", "p_size"))
        .when(kind == 1, F.concat_ws(",", "p_partkey", "p_type", "p_name", "p_size"))
        .otherwise(F.concat_ws(",", "p_partkey", "p_type", "p_size")).alias("line"))


@plan("M08_ragged_to_fixed", f"""
    SELECT CAST(p_partkey AS VARCHAR) AS id, p_type AS kind, CASE WHEN p_size % 3 < 2 THEN p_name ELSE '' END AS name,
      CASE WHEN p_size % 3 = 0 THEN p_brand ELSE '' END AS brand, '' AS spare, CAST(p_size AS VARCHAR) AS size FROM ({RAGGED})""")
def _(t: Tables):
    return M.fixed_length_records(ragged(t), "line", ["id", "kind", "name", "brand", "spare", "size"])


@plan("M09_separator_profile", f"""
    SELECT count(*) AS records, CAST(max(length(line) - length(replace(line, ',', ''))) AS INTEGER) AS max_separators FROM ({RAGGED})""")
def _(t: Tables):
    return M.separator_profile(ragged(t), "line", ",")


@plan("M10_split_compound", """
    SELECT o_orderkey, CAST(split_part(o_orderpriority, '-', 1) AS INTEGER) AS level, split_part(o_orderpriority, '-', 2) AS name,
           strftime(o_orderdate, '%b') AS month, CAST(day(o_orderdate) AS INTEGER) AS dom, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders""")
def _(t: Tables):
    raw = t.orders.select("o_orderkey", "o_orderpriority", F.date_format("o_orderdate", "MMM_dd yyyy").alias("stamp"))
    clean = raw.withColumn("stamp", S.replace_first(F.col("stamp"), "_", " "))
    parts = M.split_compound(clean, "o_orderpriority", "-", {"level": (0, "int"), "name": (1, "string")})
    parts = M.split_compound(parts, "stamp", " ", {"month": (0, "string"), "dom": (1, "int"), "year": (2, "int")})
    return parts.drop("o_orderpriority", "stamp")


@plan("M11_date_aligned_tables", """
    WITH s AS (SELECT CAST(l_shipdate AS DATE) AS d, round(sum(l_quantity), 2) AS qty FROM lineitem GROUP BY 1),
         o AS (SELECT CAST(o_orderdate AS DATE) AS d, round(sum(o_totalprice), 2) AS price FROM orders GROUP BY 1)
    SELECT d, qty, price FROM s JOIN o USING (d)""")
def _(t: Tables):
    shipped = (t.lineitem.groupBy(F.date_format("l_shipdate", "dd/MM/yyyy").alias("date"))
               .agg(F.round(F.sum("l_quantity"), 2).alias("qty")))
    ordered = (t.orders.groupBy(F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"))
               .agg(F.round(F.sum("o_totalprice"), 2).alias("price")))
    joined = join_on_expression(shipped, ordered, F.to_date("date", "dd/MM/yyyy"), F.to_date("day"), "d")
    return joined.select("d", "qty", "price")
