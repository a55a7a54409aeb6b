import hashlib
import re

from dunlin.llm.decontamination import covered, cut_spans, drop_contaminated, find_windows
from tests.llm.common import ODD, docs_of, prose


def words_of(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def brute(texts, items):
    out = []
    for text in texts:
        words, hit, found = words_of(text), set(), set()
        for key, item in items:
            iw = words_of(item)
            m = min(10, len(iw))
            for s in range(len(iw) - m + 1 if m else 0):
                for p in range(len(words) - m + 1):
                    if words[p:p + m] == iw[s:s + m]:
                        hit |= set(range(p, p + m))
                        found.add(str(key))
        out.append((len(words), len(hit), sorted(found)))
    return out


def bench(spark, items):
    return spark.createDataFrame([(k, t, "x") for k, t in items], "item_id long, text string, doc_id string")


def test_hits_match_brute_force(spark):
    long = prose(20, 40)
    items = [(1, long), (2, prose(21, 10)), (10, long), (3, "short one"), (4, "unique"), (5, prose(22, 9)), (6, prose(23, 7)), (7, prose(24, 6)), (8, None), (9, "?!"), (11, "a b c")]
    w = long.split()
    texts = [*ODD, prose(30, 13) + " " + " ".join(w[3:20]).upper() + "," + prose(31, 8), " ".join(w[:9]), " ".join(w[:10]), "it is UNIQUE; a Short,one", long + " " + long,
             prose(32, 2) + " " + prose(22, 9), prose(23, 7) + "!" + prose(24, 6), prose(33, 1) + " " + prose(21, 10) + " " + prose(34, 3), "a b c a b c", "A  B-C"]
    docs = docs_of(spark, texts)
    found = find_windows(docs, bench(spark, items)).withColumn("n_hit", covered()).collect()
    want = brute(texts, items)
    assert len(found) == len(texts)
    for r in found:
        assert (r.n_words, r.n_hit, r["items"]) == want[r.doc_id]
    kept = {r.doc_id for r in drop_contaminated(docs, bench(spark, items)).collect()}
    assert kept == {i for i, x in enumerate(want) if not x[1]}
    cut = {r.doc_id: r.text for r in cut_spans(docs, bench(spark, items)).collect()}
    for i, x in enumerate(want):
        assert len(words_of(cut[i])) == x[0] - x[1]
        if not x[1]:
            assert cut[i] == texts[i]


def test_without_benchmark_or_documents(spark):
    assert all(not r.spans for r in find_windows(docs_of(spark, ODD), bench(spark, [])).collect())
    assert find_windows(docs_of(spark, []), bench(spark, [(1, prose(1, 12))])).count() == 0


def test_repeated_rows_are_one_document(spark):
    text = prose(40, 12)
    got = find_windows(docs_of(spark, [text, text, "other words here"], [5, 5, 5]), bench(spark, [(1, text)])).withColumn("n_hit", covered()).collect()
    assert [(r.doc_id, r.n_words, r.n_hit) for r in got] == [(5, 12, 12)]


def test_digest_of_no_item():
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0c442")


def test_rows_without_an_id_are_judged_by_their_text(spark):
    bad = prose(60, 12)
    texts = [prose(61, 5) + " " + bad, prose(62, 20), None, bad, prose(62, 20), prose(63, 20), bad]
    docs = docs_of(spark, texts, [None, None, None, None, None, 1, 2])
    kept = drop_contaminated(docs, bench(spark, [(1, bad)]))
    assert kept.columns == docs.columns
    assert sorted((str(r.doc_id), r.text or "") for r in kept.collect()) == sorted([("None", texts[1])] * 2 + [("None", ""), ("1", texts[5])])
    cleaned = cut_spans(docs, bench(spark, [(1, bad)]))
    assert cleaned.columns == docs.columns
    texts = sorted((str(r.doc_id), " ".join(words_of(r.text))) for r in cleaned.collect())
    assert texts == sorted([("None", prose(61, 5)), ("None", ""), ("None", ""), ("None", prose(62, 20)), ("None", prose(62, 20)), ("1", prose(63, 20)), ("2", "")])


def test_large_benchmarks_do_not_shuffle_the_documents(spark):
    def shuffles(items):
        found = find_windows(docs_of(spark, [prose(1, 40)]), bench(spark, items))
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert plan.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in plan, plan
        return plan.count("Exchange hashpartitioning")

    small, large = shuffles([(1, prose(1, 40))]), shuffles([(i, prose(1000 + i, 1000, 10**6)) for i in range(60)])
    assert small == large == 1
