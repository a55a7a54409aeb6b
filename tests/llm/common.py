"""Small tables shared by the tests of this folder."""

import random

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, i int, pos int, line string, bits string, word string"


def docs_of(spark, texts, ids=None):
    """Documents with columns whose names the operators use inside."""
    ids = range(len(texts)) if ids is None else ids
    rows = [(i, t, "en", "s", None if t is None else len(t), 1, 2, "x", "y", "z") for i, t in zip(ids, texts)]
    return spark.createDataFrame(rows, DOC_SCHEMA)


def prose(seed, words, vocabulary=400):
    draw = random.Random(seed)
    return " ".join(f"w{draw.randrange(vocabulary)}" for _ in range(words))


#: Nulls, empty and blank texts, ties, repeats, one very long word and one long text.
ODD = [None, "", " \n\t\n ", "one", "a b c d e f g h i j k", "a b c d e f g h i j k", "x" * 50_000, prose(1, 4000), prose(2, 60) + "\n" + prose(2, 60), "é ß 漢字   word # * $", "\\ [INST]"]
