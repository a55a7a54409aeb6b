import time

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from dunlin.ml.stages import text_cleaning_stages
from dunlin.operators import text as E
from dunlin.session import broadcast_if_bounded
from tests.conftest import values

FILING = """<HEAD>title</HEAD><TYPE>10-K<SEQUENCE>1<FILENAME>a.htm<DESCRIPTION>X
The U.S.A. firm&nbsp;grew&#146;s 12% &amp; more.<TABLE><tr><td>1<table>2</table></TABLE>
<TYPE>GRAPHIC<FILENAME>g.jpg begin 644</TEXT> See http://a.example/x?y=1 and file report.xml now."""


def clean(spark, text, step):
    return spark.createDataFrame([(text,)], "t string").select(step(F.col("t")).alias("o")).first()["o"]


def test_filing_cleaner(spark):
    out = E.clean_filing(spark.createDataFrame([(FILING,), (None,), ("",)], "t string"), "t", "c").collect()
    words = out[0]["c"].split()
    assert words == ["X", "The", "firm", "grew", "s", "more.", "See", "and", "file", "now."]
    assert out[1]["c"] is None and out[2]["c"] == ""


def test_single_steps(spark):
    assert clean(spark, "in the U.S.A. today", E.drop_abbreviations) == "in the   today"
    assert clean(spark, "a<Table x>\n1</Table>b<i>c", E.drop_tables_and_tags) == "a b c"
    assert clean(spark, "&#147;q&#148; a&#8260;b &reg;", E.replace_entities) == '"q" a/b  '
    assert clean(spark, "v2.4.0.8 IDEA: XBRL DOCUMENT", E.drop_boilerplate) == "   "
    assert clean(spark, "a1|b^c.d", E.keep_letters_and_periods) == "a  b c.d"
    assert clean(spark, "a.b  9 c", E.letters_only) == "a b c"


def test_fog_and_dictionary(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "Readability matters. It does."), (2, "no period"), (3, "...")], "id int, t string")
    assert values(E.fog_index(docs, "id", "t")) == [(1, round(0.4 * (4 / 2 + 100.0 * 1 / 4), 4))]
    words = spark.createDataFrame([("BAD", 1, 0), ("May", 0, 2)], "word string, negative int, modal int")
    texts = spark.createDataFrame([(1, "bad bad may other")], "id int, t string")
    for limit in (1 << 20, 1):
        # Broadcast or not, one row per key and word.
        monkeypatch.setattr(E, "broadcast_if_bounded", lambda df: broadcast_if_bounded(df, limit))
        matched = E.match_dictionary(texts, ["id"], "t", words)
        assert values(matched, "id", "word", "n") == [(1, "bad", 2), (1, "may", 1)]
        assert values(E.dictionary_measures(matched, ["id"])) == [(1, 3, 2, 0.666667)]
        assert values(E.modal_counts(matched)) == [(2, 1)]


def test_cleaner_is_linear(spark):
    """A long run of name letters, and many tags that are never closed."""
    run = "a" * 200_000
    tags = "<table>x</table>" + "<table " * 10_000 + "y"
    began = time.time()
    assert clean(spark, run + " b.txt c", E.keep_letters_and_periods) == run + "   c"
    assert clean(spark, tags, E.drop_tables_and_tags).startswith(" <table ")
    assert clean(spark, "p <TABLE>1</Table>q<table>2</TABLE> r <table> s", E.drop_tables_and_tags) == "p  q  r   s"
    assert time.time() - began < 20


def test_stop_words(spark):
    counts = spark.createDataFrame([("f", "The", 3), ("f", "cat", 1), ("f", "x1", 2)], "file string, word string, n long")
    stops = spark.createDataFrame([("the",)], "word string")
    assert values(E.without_stop_words(counts, stops), "word", "n") == [("cat", 1)]


def test_saved_stages(spark, tmp_path):
    docs = spark.createDataFrame([("<b>Hi</b> a.txt there, 42 times",)], "text string")
    Pipeline(stages=text_cleaning_stages("text")).fit(docs).save(str(tmp_path / "m"))
    out = PipelineModel.load(str(tmp_path / "m")).transform(docs).first()["cleaned"]
    assert out.split() == ["Hi", "there", "times"]
