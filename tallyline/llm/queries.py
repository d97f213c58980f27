"""The registered queries of the corpus operators, each over its whole table, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.llm import sql
from tallyline.llm.bpe import encode_and_decode
from tallyline.llm.chat import format_chats, loss_text, parse
from tallyline.llm.common import table
from tallyline.llm.decontaminate import leaks
from tallyline.llm.fim import fill_in_middle, restored
from tallyline.llm.hnsw import neighbours
from tallyline.llm.html_text import main_text
from tallyline.llm.line_dedup import dedup_lines
from tallyline.llm.minhash import minhash_groups
from tallyline.llm.periodic import periodic_runs
from tallyline.llm.pii import KINDS, digest, personal_data
from tallyline.llm.simhash import simhash_groups
from tallyline.llm.token_files import read_token_files, write_texts
from tallyline.llm.toxicity import score_toxicity
from tallyline.session import new_run_dir


def op1_hnsw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score_toxicity(docs, table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted")


def op3_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = main_text(table(spark, sf_dir, "pages"))
    return pages.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = dedup_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_run_dir(spark, "token-files")
    write_texts(table(spark, sf_dir, "documents"), folder)
    return read_token_files(spark, folder, with_ids=False).select("doc_id", "start", "n_tokens", "ids_crc32")


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = encode_and_decode(table(spark, sf_dir, "documents"))
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    role = F.when(F.col("id") == 0, "user").otherwise("assistant")
    extra = spark.range(2).select(F.lit(-1), "id", role, F.lit("</s>[INST] ok [/INST]"))
    chats = format_chats(rows.union(extra))
    turns = chats.withColumn("turns", parse(F.col("formatted"))).withColumn("loss", loss_text(F.col("formatted"), F.col("loss_spans")))
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return turns.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(lines, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal_data(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "spans")
    base = [k.name for k in KINDS if k.base]
    kinds = F.transform("spans", lambda x: x["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k in base]
    of_base = F.filter("spans", lambda x: x["kind"].isin(base))
    return found.select("doc_id", *counts, F.sha2(digest(of_base), 256).alias("base_sha256"), digest(F.col("spans")).alias("spans"))


def _planted(docs: DataFrame) -> DataFrame:
    """Documents of which a tenth, chosen by id, repeat some of their words with a period to their end."""
    words = F.filter(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    named = docs.select("doc_id", "text", words.alias("words"), F.crc32(F.col("doc_id").cast("string")).alias("h"))
    sized = named.withColumns({"n": F.size("words").cast("long"), "g": F.expr("h div 10")})
    cut = sized.withColumn("a", F.when((F.col("h") % 10 == 0) & (F.col("n") > 0), F.expr("g % n")))
    timed = cut.withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    made = F.expr("array_join(transform(words, (w, i) -> if(i < a, w, element_at(words, cast(a + (i - a) % p as int) + 1))), ' ')")
    return timed.select("doc_id", F.when(F.col("a").isNull(), F.col("text")).otherwise(made).alias("text"))


def op11_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(_planted(table(spark, sf_dir, "documents")))
    lines = F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    ranked = F.transform("runs", lambda r: F.struct(r["length"].alias("length"), -r["start"], -r["period"]))
    top = F.array_max(ranked)
    return found.withColumn("top", top).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("top.col2")).alias("start"),
        F.col("top.length").alias("length"),
        (-F.col("top.col3")).alias("period"),
        F.expr("1000 * top.length div -top.col3").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return made.select(
        "doc_id",
        F.col("n_units").alias("n"),
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


def op13_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_groups(table(spark, sf_dir, "documents").select("doc_id", "text"), size=4)


QUERIES = {
    "op1_hnsw": op1_hnsw,
    "op2_toxicity": op2_toxicity,
    "op3_html": op3_html,
    "op4_line_dedup": op4_line_dedup,
    "op5_token_files": op5_token_files,
    "op6_bpe": op6_bpe,
    "op7_decontaminate": op7_decontaminate,
    "op8_simhash": op8_simhash,
    "op9_chat": op9_chat,
    "op10_pii": op10_pii,
    "op11_periodic": op11_periodic,
    "op12_fim": op12_fim,
    "op13_minhash": op13_minhash,
}
SQL = {
    "op4_line_dedup": sql.LINE_DEDUP,
    "op9_chat": sql.CHAT,
    "op11_periodic": sql.PERIODIC,
    "op12_fim": sql.FIM,
    "op13_minhash": sql.MINHASH,
}
