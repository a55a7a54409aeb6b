import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from dunlin.llm.packing import Units, binary_lengths, pack, write_buckets
from dunlin.llm.queries import op3_packing
from tests.llm.common import ODD, docs_of, prose

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_ids_are_those_of_the_tokenizer(spark, data_dir):
    whole, units = Tokenizer.from_file(PATH), Units(PATH)
    texts = [t or "" for t in ODD] + ["a  b", "a   b", " a", "a ", "  ", "a\n b", "a\n\n b", "a\n  b", "x \n y", "it's 'll 12 3", "a  b", "a  b", "  b ", "<|endoftext|> x", "a\t b", "a \t b", "  a", "a  "]
    texts += [r.text for r in spark.read.parquet(f"{data_dir}/documents.parquet").limit(150).collect()]
    for text in texts:
        assert units.encode(text).tolist() == whole.encode(text, add_special_tokens=False).ids, repr(text[:40])


def test_lengths():
    for n in [1, 2, 3, 2047, 2048, 2049, 5000, 10_000]:
        got = binary_lengths(n)
        assert sum(got) == n and got == sorted(got, reverse=True) and all(x & (x - 1) == 0 and x <= 2048 for x in got)
        assert len([x for x in got if x < 2048]) == len({x for x in got if x < 2048})


def test_pieces_cover_documents(spark, tmp_path):
    texts = [*ODD, prose(50, 3000)]
    rows = pack(docs_of(spark, texts).repartition(3), PATH).collect()
    whole = Tokenizer.from_file(PATH)
    assert len({r.sequence_id for r in rows}) == len(rows) and {r.offset for r in rows} == {0}
    for i, text in enumerate(texts):
        mine = sorted((r for r in rows if r.doc_id == i), key=lambda r: r.start)
        want = whole.encode(text or "", add_special_tokens=False).ids + [1]
        assert [x for r in mine for x in r.ids] == want
        assert [r.start for r in mine] == [0, *np.cumsum([r.length for r in mine])[:-1]]
        for r in mine:
            assert r.doc_tokens == len(want) and r.length == len(r.ids) == 1 << r.bucket
            assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
    write_buckets(pack(docs_of(spark, texts), PATH), f"{tmp_path}/packed")
    again = spark.read.parquet(f"{tmp_path}/packed")
    assert again.count() == len(rows)
    assert pack(docs_of(spark, []), PATH).count() == 0


def test_repeated_rows_are_packed_each(spark):
    rows = pack(docs_of(spark, ["a b", "a b"], [1, 1]), PATH, with_ids=False).collect()
    assert len(rows) == 4 and len({r.sequence_id for r in rows}) == 4


def test_query_and_pipeline_stage_return_the_ids(spark, tmp_path):
    texts = [*ODD, prose(51, 100)]
    docs_of(spark, texts).write.parquet(f"{tmp_path}/documents.parquet")
    docs, whole = spark.read.parquet(f"{tmp_path}/documents.parquet"), Tokenizer.from_file(PATH)
    for packed in (op3_packing(spark, str(tmp_path)), corpus_pipeline.packing(spark, docs, str(tmp_path))):
        rows = packed.collect()
        for i, text in enumerate(texts):
            mine = sorted((r for r in rows if r.doc_id == i), key=lambda r: r.start)
            assert [x for r in mine for x in r.ids] == whole.encode(text or "", add_special_tokens=False).ids + [1]
        assert all(r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in rows)
