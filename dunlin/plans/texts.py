"""Plans for text analytics and user-defined functions."""

from __future__ import annotations

import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import RegexTokenizer, StopWordsRemover
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from dunlin.functions import recode as C
from dunlin.functions.strings import count_matches
from dunlin.ml.stages import text_cleaning_stages
from dunlin.operators import text as E
from dunlin.operators import udfs as U
from dunlin.operators.windows import train_test_per_stratum
from dunlin.plans.registry import Tables, plan
from dunlin.session import scratch_path


def rows(name: str = "n"):
    return F.count(F.lit(1)).alias(name)


def _sql_clean(column: str) -> str:
    """The cleaning steps as nested SQL calls."""
    def rep(text, pattern, to=" "):
        return f"regexp_replace({text}, '{pattern.replace(chr(39), chr(39) * 2)}', '{to.replace(chr(39), chr(39) * 2)}', 'g')"

    out = rep(column, E.ABBREVIATION)
    out = rep(out, rf"(?s)<TYPE>({'|'.join(E.EMBEDDED_TYPES)}).*?</TEXT>")
    out = rep(rep(out, E.HEAD), E.META)
    out = rep(rep(out, E.TABLE), E.TAG)
    for pattern, to in E.ENTITIES:
        out = rep(out, pattern, to)
    out = rep(out, r"\s+")
    for pattern in E.BOILERPLATE:
        out = rep(out, pattern)
    return rep(rep(rep(out, E.URL, ""), E.FILE_NAME), E.NOT_LETTER_OR_PERIOD)


@plan("E01_clean_filing", f"SELECT page_id, {_sql_clean('html')} AS cleaned FROM pages")
def _(t: Tables):
    return E.clean_filing(t.spread("pages").select("page_id", "html"), "html", "cleaned").drop("html")


@plan("E02_letters_only", r"""
    SELECT doc_id, md5(regexp_replace(regexp_replace(text, '[^a-zA-Z]', ' ', 'g'), '\s+', ' ', 'g')) AS digest FROM documents""")
def _(t: Tables):
    return t.spread("documents").select("doc_id", F.md5(E.letters_only(F.col("text"))).alias("digest"))


_DICT = """d AS MATERIALIZED (SELECT DISTINCT w AS word, CASE WHEN starts_with(w, 'th') THEN 1 ELSE 0 END AS negative,
    CASE WHEN starts_with(w, 'er') THEN 1 WHEN starts_with(w, 'on') THEN 2 ELSE 0 END AS modal FROM
    (SELECT unnest(regexp_extract_all(lower(text), '[a-z]+')) AS w FROM benchmark)),
    k AS MATERIALIZED (SELECT doc_id, w AS word, count(*) AS n FROM (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[a-z]+')) AS w FROM documents) GROUP BY 1, 2)"""


def _dictionary(t: Tables):
    """Word list from the benchmark texts with two marks per word."""
    word = F.col("word")
    entries = t.benchmark.select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0))).alias("word")).distinct()
    return entries.select(
        F.upper("word").alias("word"), F.when(F.startswith(word, F.lit("th")), 1).otherwise(0).alias("negative"),
        F.when(F.startswith(word, F.lit("er")), 1).when(F.startswith(word, F.lit("on")), 2).otherwise(0).alias("modal"))


def _matched(t: Tables):
    return E.match_dictionary(t.spread("documents", "doc_id"), ["doc_id"], "text", _dictionary(t))


@plan("E03_dictionary_match", f"WITH {_DICT} SELECT doc_id, CAST(sum(n) AS BIGINT) AS words, count(*) AS kinds FROM k JOIN d USING (word) GROUP BY 1")
def _(t: Tables):
    return _matched(t).groupBy("doc_id").agg(F.sum("n").alias("words"), F.countDistinct("word").alias("kinds"))


@plan("E04_fog_index", """
    WITH w AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[a-z]+')) w FROM documents),
         s AS (SELECT doc_id, length(text) - length(replace(text, '.', '')) AS p FROM documents)
    SELECT doc_id, round(0.4::DOUBLE * (count(*)::DOUBLE / any_value(p) + 100.0::DOUBLE * count(*) FILTER (len(regexp_extract_all(w, '[aeiouy]+')) > 2) / count(*)), 4) AS fog
    FROM w JOIN s USING (doc_id) WHERE p > 0 GROUP BY doc_id""")
def _(t: Tables):
    return E.fog_index(t.spread("documents"), "doc_id", "text")


@plan("E05_sentiment", f"""WITH {_DICT} SELECT doc_id, CAST(sum(n) AS BIGINT) AS words, CAST(sum(CASE WHEN negative > 0 THEN n ELSE 0 END) AS BIGINT) AS negative,
    round(sum(CASE WHEN negative > 0 THEN n ELSE 0 END)::DOUBLE / sum(n), 6) AS sentiment FROM k JOIN d USING (word) GROUP BY 1""")
def _(t: Tables):
    return E.dictionary_measures(_matched(t), ["doc_id"])


@plan("E06_modal_counts", f"WITH {_DICT} SELECT modal, CAST(sum(n) AS BIGINT) AS n FROM k JOIN d USING (word) WHERE modal > 0 GROUP BY 1")
def _(t: Tables):
    return E.modal_counts(_matched(t))


def _sql_stages(column: str) -> str:
    out = column
    for pattern, to in ((E.TABLE, " "), (E.TAG, " "), (E.URL, ""), (E.FILE_NAME, " "), (E.NOT_LETTER_OR_PERIOD, " "),
                        (E.NOT_LETTER, " "), (r"\s+", " ")):
        out = f"regexp_replace({out}, '{pattern}', '{to}', 'g')"
    return out


@plan("E07_saved_text_stages", f"SELECT conv_id, turn, md5({_sql_stages('text')}) AS digest FROM conversations WHERE trim({_sql_stages('text')}) <> ''")
def _(t: Tables):
    path = scratch_path(t.spark, "e07")
    Pipeline(stages=text_cleaning_stages("text")).fit(t.documents).write().overwrite().save(path)
    cleaned = PipelineModel.load(path).transform(t.conversations)
    return cleaned.where(F.trim("cleaned") != "").select("conv_id", "turn", F.md5("cleaned").alias("digest"))


_STOPS = ["the", "and", "of", "la", "le", "de", "der", "die"]


@plan("E08_stop_word_rows", f"""
    SELECT source, lower(w) AS word, CAST(sum(n) AS BIGINT) AS n FROM (SELECT source, w, count(*) AS n FROM (SELECT source, unnest(string_split(text, ' ')) AS w FROM documents) GROUP BY 1, 2)
    WHERE regexp_full_match(w, '[A-Za-z]+') AND lower(w) NOT IN ({", ".join(f"'{w}'" for w in _STOPS)}) GROUP BY 1, 2""")
def _(t: Tables):
    counts = (t.spread("documents").select("source", F.explode(F.split("text", " ")).alias("word"))
              .groupBy("source", "word").agg(rows()))
    stops = t.spark.createDataFrame([(w,) for w in _STOPS], "word string")
    return E.without_stop_words(counts, stops).groupBy("source", "word").agg(F.sum("n").alias("n"))


@plan("E08_word_set_minus_stops", f"""
    SELECT DISTINCT w AS word FROM (SELECT unnest(regexp_extract_all(lower(text), '[a-z]+')) AS w FROM documents) WHERE w NOT IN ({", ".join(f"'{w}'" for w in _STOPS)})""")
def _(t: Tables):
    words = t.spread("documents").select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0))).alias("word"))
    return words.subtract(t.spark.createDataFrame([(w,) for w in _STOPS], "word string"))


@plan("E09_balanced_label_corpus", """
    SELECT rating, least(count(*), 60) AS train, greatest(least(count(*), 80) - 60, 0) AS test FROM
      (SELECT CASE quality * 2 + toxic WHEN 0 THEN 1 WHEN 1 THEN 1 WHEN 2 THEN 2 ELSE 3 END AS rating FROM labels JOIN documents USING (doc_id)) GROUP BY 1""")
def _(t: Tables):
    rated = t.documents.select("doc_id", "text").join(t.labels, "doc_id").withColumn(
        "rating", C.recode(F.col("quality") * 2 + F.col("toxic"), {0: 1, 1: 1, 2: 2}, default=3))
    parts = train_test_per_stratum(rated.select("doc_id", "rating"), ["rating"], ["doc_id"], 60, 80, seed=2)
    return parts.groupBy("rating").agg(F.count_if(F.col("part") == "train").alias("train"),
                                       F.count_if(F.col("part") == "test").alias("test"))


@plan("E10_document_from_sentences", """
    SELECT doc_id, md5(array_to_string(string_split(text, '. '), ',')) AS digest FROM documents""")
def _(t: Tables):
    sentences = t.documents.select("doc_id", F.split("text", r"\. ").alias("sentence"))
    return E.document_from_sentences(sentences, "sentence", "body").select("doc_id", F.md5("body").alias("digest"))


# ------------------------------------------------------ user-defined functions


@plan("X01_sql_registered_udf", "SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS done FROM orders")
def _(t: Tables):
    def done(status: pd.Series) -> pd.Series:
        return (status == "F").astype("int32")

    U.register_scalar(t.spark, "dunlin_done", done, "int")
    return t.spark.sql("SELECT o_orderkey, dunlin_done(o_orderstatus) AS done FROM {orders}", orders=t.orders)


@plan("X02_parameterised_column_function", """
    SELECT doc_id, CAST(length(text) - length(replace(text, '.', '')) AS INTEGER) AS periods,
           CAST(length(text) - length(replace(text, ',', '')) AS INTEGER) AS commas FROM documents""")
def _(t: Tables):
    def counter(pattern):
        return lambda column: count_matches(column, pattern)

    text = F.col("text")
    return t.documents.select("doc_id", counter(r"\.")(text).alias("periods"), counter(",")(text).alias("commas"))


@plan("X03_vector_from_columns", """
    SELECT l_returnflag, round(sum(isodow(l_shipdate) + month(l_shipdate) + l_quantity), 2) AS total FROM lineitem GROUP BY 1""")
def _(t: Tables):
    parts = F.array(F.weekday("l_shipdate") + F.lit(1.0), F.month("l_shipdate").cast("double"), F.col("l_quantity"))
    vectors = t.lineitem.select("l_returnflag", array_to_vector(parts).alias("features"))
    spread = vectors.select("l_returnflag", vector_to_array("features").alias("f"))
    return spread.groupBy("l_returnflag").agg(
        F.round(F.sum(F.aggregate("f", F.lit(0.0), lambda a, x: a + x)), 2).alias("total"))


@plan("X04_grouped_apply", "SELECT user_id, max(value) AS top, count(*) AS n FROM events GROUP BY 1")
def _(t: Tables):
    def reduce(frame: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"user_id": frame["user_id"].iloc[:1], "top": [frame["value"].max()], "n": [len(frame)]})

    def merge(frame: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"user_id": frame["user_id"].iloc[:1], "top": [frame["top"].max()], "n": [frame["n"].sum()]})

    return U.grouped_apply(t.events.select("user_id", "value"), ["user_id"], reduce,
                           "user_id long, top double, n long", merge)


@plan("X05_typed_aggregator", """
    SELECT event_type, count(value) AS n, round(avg(value), 4) AS mean, round(sum(value), 2) AS total FROM events GROUP BY 1""")
def _(t: Tables):
    def partial(frame: pd.DataFrame) -> pd.DataFrame:
        got = frame.groupby("event_type")["value"].agg(["count", "sum"]).reset_index()
        return got.rename(columns={"count": "n", "sum": "s"})

    return U.mergeable_aggregate(
        t.events.select("event_type", "value"), ["event_type"], partial, "event_type string, n long, s double",
        [F.sum("n").alias("n"), F.round(F.sum("s") / F.sum("n"), 4).alias("mean"), F.round(F.sum("s"), 2).alias("total")])


@plan("X06_literal_set_filter", f"""
    SELECT lang, count(*) AS n FROM (SELECT lang, unnest(regexp_extract_all(lower(text), '[a-z]+')) AS w FROM documents)
    WHERE w NOT IN ({", ".join(f"'{w}'" for w in _STOPS)}) GROUP BY 1""")
def _(t: Tables):
    words = t.documents.select("lang", F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0))).alias("w"))
    return words.where(U.not_in_set(F.col("w"), _STOPS)).groupBy("lang").agg(rows())


@plan("X08_custom_text_stages", f"SELECT page_id, md5({_sql_stages('html')}) AS digest FROM pages")
def _(t: Tables):
    model = Pipeline(stages=text_cleaning_stages("html")).fit(t.pages)
    return model.transform(t.pages).select("page_id", F.md5("cleaned").alias("digest"))


@plan("X08_stages_with_tokenizer", f"""
    SELECT page_id, CAST(len(list_filter(regexp_extract_all(lower({_sql_stages('html')}), '[a-z]+'), lambda w: w NOT IN ({", ".join(f"'{w}'" for w in _STOPS)}))) AS INTEGER) AS kept FROM pages""")
def _(t: Tables):
    stages = text_cleaning_stages("html") + [
        RegexTokenizer(inputCol="cleaned", outputCol="words", pattern=r"\W"),
        StopWordsRemover(inputCol="words", outputCol="kept", stopWords=_STOPS, caseSensitive=False)]
    return Pipeline(stages=stages).fit(t.pages).transform(t.pages).select("page_id", F.size("kept").alias("kept"))
