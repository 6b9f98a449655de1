"""Registered queries of the training-text operators, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from raresift.llm._tokens import default_tokenizer
from raresift.llm.decontaminate import find_contamination
from raresift.llm.embeddings import near_duplicate_vectors
from raresift.llm.exact_dedup import exact_duplicates
from raresift.llm.near_duplicates import near_duplicates
from raresift.llm.oracles import ORACLE
from raresift.llm.packing import pack
from raresift.llm.quality import fit_quality, score_quality
from raresift.llm.repeats import remove_repeated
from raresift.llm.runs import find_runs
from raresift.llm.suffix_dedup import remove_repeated_strings
from raresift.llm.token_files import token_files_round_trip
from raresift.llm.toxicity import fit_toxicity, score_toxicity
from raresift.llm.variants import spelling_variants
from raresift.llm.warc import derivatives, responses_of_pages, serialized


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors linked within their label at a cosine of 0.98."""
    return near_duplicate_vectors(table(spark, sf_dir, "embeddings"))


def op2_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the windows of 35 words that occur more than once."""
    kept = remove_repeated(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 1024 ids."""
    return pack(table(spark, sf_dir, "documents"), default_tokenizer())


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents linked at 85 percent of equal 3-word shingles."""
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=3, percent=85)


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata and conversion records of all pages' responses."""
    records = derivatives(responses_of_pages(table(spark, sf_dir, "pages")))
    return records.withColumn("record_sha256", F.sha2(serialized(records), 256)).drop("block")


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents against all windows of ten words of the benchmark."""
    return find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents scored for quality by a rule ensemble of the labelled ones."""
    docs = table(spark, sf_dir, "documents")
    return score_quality(docs, fit_quality(docs, table(spark, sf_dir, "labels")))


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' ids, written as bit planes and read back."""
    return token_files_round_trip(table(spark, sf_dir, "documents"), default_tokenizer())


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents scored for toxicity by a model of the labelled ones."""
    docs = table(spark, sf_dir, "documents")
    return score_toxicity(docs, fit_toxicity(docs, table(spark, sf_dir, "labels")))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the 100-byte strings that start earlier."""
    kept = remove_repeated_strings(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def altered_words(docs: DataFrame) -> DataFrame:
    """(word, n) of the words of five letters or more that occur three times or more.

    Of every 97th (document, word) the word loses one letter.  A null id has no digits.
    """
    az = "abcdefghijklmnopqrstuvwxyz"
    lowered = F.translate("text", az.upper(), az)
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all(lowered, F.lit("[a-z\u00c0-\u00ff]+"), F.lit(0))).alias("run"))
    drawn = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("run")))
    runs = runs.withColumn("h", drawn)
    place = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), place), F.substring("run", place + 2, F.length("run")))
    words = runs.select(F.when(F.col("h") % 97 == 0, cut).otherwise(F.col("run")).alias("word"))
    return words.groupBy("word").agg(F.count("*").alias("n")).filter("length(word) >= 5 AND n >= 3")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All words of the documents with the more frequent word that each may be a variant of."""
    return spelling_variants(altered_words(table(spark, sf_dir, "documents")))


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with the equal document that stays for them."""
    return exact_duplicates(table(spark, sf_dir, "documents"))


def repeated_tails(docs: DataFrame) -> DataFrame:
    """doc_id and text; documents whose id's crc32 is divisible by 10 repeat a stretch of their words up to their end."""
    drawn = F.crc32(F.col("doc_id").cast("string"))
    split = F.when(drawn % 10 == 0, F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
    rows = docs.select("doc_id", "text", F.floor(drawn / 10).alias("g"), split.alias("words")).withColumn("n", F.size("words"))
    rows = rows.withColumn("a", F.pmod("g", F.when(F.col("n") > 0, F.col("n"))).cast("int"))
    rows = rows.withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    times = F.ceil((F.col("n") - F.col("a")) / F.col("p")).cast("int")
    tail = F.flatten(F.array_repeat(F.slice("words", F.col("a") + 1, F.col("p")), times))
    changed = F.concat(F.slice("words", F.lit(1), F.col("a")), F.slice(tail, F.lit(1), F.col("n") - F.col("a")))
    return rows.select("doc_id", F.when(F.col("n") > 0, F.array_join(changed, " ")).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' periodic runs, after a tenth of them got a repeated tail."""
    found = find_runs(repeated_tails(table(spark, sf_dir, "documents")))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    # the longest run comes last by length, then by the smaller start, then by the smaller period
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    rows = found.withColumn("longest", longest)
    start, length, period = -F.col("longest.start"), F.col("longest.length"), -F.col("longest.period")
    return rows.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        start.alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.floor(1000 * length / period).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_embeddings": op1_embeddings,
    "op2_repeats": op2_repeats,
    "op3_packing": op3_packing,
    "op4_near_duplicates": op4_near_duplicates,
    "op5_warc": op5_warc,
    "op6_decontamination": op6_decontamination,
    "op7_quality": op7_quality,
    "op8_token_files": op8_token_files,
    "op9_toxicity": op9_toxicity,
    "op10_suffix_dedup": op10_suffix_dedup,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_exact_dedup": op12_exact_dedup,
    "op13_periodic_runs": op13_periodic_runs,
}
