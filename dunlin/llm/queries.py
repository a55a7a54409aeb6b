"""The registered queries of this folder, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dunlin.llm import oracles
from dunlin.llm.chat import INSTRUCT, format_chats, read_chats, unescape
from dunlin.llm.common import SHIPPED_IDS, read
from dunlin.llm.decontamination import covered, find_windows
from dunlin.llm.licenses import known_digests, scan_licenses
from dunlin.llm.linededup import line_report
from dunlin.llm.packing import pack
from dunlin.llm.periods import periodic_runs
from dunlin.llm.repetition import repetition
from dunlin.llm.sharding import assign_shards
from dunlin.llm.simhash import near_duplicates
from dunlin.llm.spelling import count_words, variant_groups
from dunlin.llm.substrings import drop_repeated_passages
from dunlin.llm.toxicity import fit_toxicity, score_toxicity
from dunlin.llm.warc import page_of, read_warc, records_of, write_warc
from dunlin.session import scratch_path

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def op1_quality_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition(read(spark, sf_dir, "documents")).drop("spans", "longest_repeat")


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_windows(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", covered().alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pieces with their ids; the sums are worked out from the ids that are returned, where they are made."""
    return pack(read(spark, sf_dir, "documents"), TOKENIZER)


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one that speaks the template's own marks; every column is read back from the output."""
    given = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    own = given.limit(0).unionByName(spark.sql(
        "SELECT -1L AS conv_id, t AS turn, r AS role, '</s>[INST] ok [/INST]' AS text FROM VALUES (0L, 'user'), (1L, 'assistant') AS v(t, r)"))
    chats = format_chats(given.unionByName(own), INSTRUCT)
    loss = unescape(F.array_join(F.transform(F.filter("segments", lambda s: s.loss), lambda s: s.text), ""))
    held = chats.withColumn("turns", read_chats(F.col("formatted"), INSTRUCT)).withColumn("loss_text", loss)
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), "")
    return held.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(turns, 256).alias("turns_sha256"), F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"), "valid")


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_report(read(spark, sf_dir, "documents"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(read(spark, sf_dir, "documents"), known_digests(spark))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the archives, then read them back: responses with their payload, revisits by their headers."""
    path = scratch_path(spark, "warc")
    write_warc(records_of(read(spark, sf_dir, "pages"), SHIPPED_IDS), path)
    kept = read_warc(spark, path, "warc_type string, record_id string, payload_digest string, payload binary").where("warc_type = 'response'").select(
        page_of("record_id").cast("long").alias("page_id"), F.octet_length("payload").cast("long").alias("payload_bytes"), "payload_digest",
        F.col("warc_type").alias("record_type"), F.lit(None).cast("long").alias("refers_to"))
    again = read_warc(spark, path, "warc_type string, record_id string, refers_to string, payload_digest string, payload_bytes long").where(
        "warc_type = 'revisit'").select(
        page_of("record_id").cast("long").alias("page_id"), "payload_bytes", "payload_digest",
        F.col("warc_type").alias("record_type"), page_of("refers_to").cast("long").alias("refers_to"))
    return kept.union(again).withColumn("payload_digest", F.regexp_replace("payload_digest", "^sha1:", ""))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign_shards(read(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return score_toxicity(docs, fit_toxicity(docs, read(spark, sf_dir, "labels")))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variant_groups(count_words(read(spark, sf_dir, "documents"), noise=199))


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """The documents, those with a checksum of the id that ten divides made periodic from some word on; a null id changes nothing."""
    words, hashed = F.expr("regexp_extract_all(text, '[^\\\\x20\\\\x09-\\\\x0D]+', 0)"), F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(hashed / 10)

    def periodic(held):
        n = F.size(held)
        start = F.try_mod(g, n)
        period = F.floor((n - start) / (F.lit(3) + g % 8)) + 1
        at = F.array(F.struct(start.alias("a"), period.alias("p")))
        changed = F.transform(at, lambda r: F.transform(held, lambda w, i: F.when(i < r["a"], w).otherwise(
            F.get(held, (r["a"] + (i - r["a"]) % r["p"]).cast("int")))))
        return F.array_join(F.get(changed, F.lit(0)), " ")

    # The words are bound once: as a column they would be worked out again for every word.
    once = F.get(F.transform(F.array(words), periodic), F.lit(0))
    return docs.select("doc_id", F.when(hashed % 10 == 0, once).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(with_planted_runs(read(spark, sf_dir, "documents")))
    # Of two fractions the greater is found by cross products; ties go to the first run, which starts first and has the smaller period.
    best = F.aggregate("runs", F.get("runs", F.lit(0)), lambda b, r: F.when(r["length"] * b["period"] > b["length"] * r["period"], r).otherwise(b))
    listed = F.concat_ws("", F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n"))))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"), F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"), "n_words")


def op13_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = drop_repeated_passages(read(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["length"])
    return found.select("doc_id", "n_words", removed.alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_quality_repetition, op2_decontamination, op3_packing, op4_chat_format, op5_simhash, op6_line_dedup, op7_license_scan, op8_warc, op9_sharding, op10_toxicity,
        op11_spelling_variants, op12_periodic_runs, op13_substring_dedup)
}

SQL: dict[str, str] = oracles.SQL
