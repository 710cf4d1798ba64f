"""The registered queries of the training-data operators, and their SQL where there is one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm import langid, leaks, licences, mixing, periods, phrases, pseudolm, quality, repeats, sharding, similar, surrogates, toxicity
from plumbline.llm.sql import ORACLE_SQL as ORACLE_SQL


#: The key of the registered query; a real one is a secret of the deployment.
SURROGATE_KEY = "surrogate-key"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "source", "text")
    return mixing.mixed(docs).select("doc_id", "source", "size", "source_size", "target", "taken", "copies")


def op2_similar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar.linked(documents(spark, sf_dir).select("doc_id", "text")).select("doc_id", "class_id", "n_links")


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return sharding.sharded(docs).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op4_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return surrogates.replaced(documents(spark, sf_dir).select("doc_id", "text"), SURROGATE_KEY).select("doc_id", "text", "n_entities")


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return quality.judged(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                                       "base_failed", "kept")


def op6_pseudolm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return pseudolm.scored(docs, pseudolm.trained(docs)).select("doc_id", "n_tokens", "log_likelihood", "mean_log_likelihood")


def op7_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return licences.scanned(docs).select("doc_id", "licence_digest", "licence_id")


def op8_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    per_text = repeats.cut_texts(docs).select(
        "text_key", "n_bytes", F.expr("aggregate(spans, 0L, (n, s) -> n + s.stop - s.start)").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
        F.make_valid_utf8(F.col("kept").cast("string")).alias("text"))  # a cut may leave half a character
    return repeats.of_rows(docs, per_text).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "text")


def op9_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return leaks.leaks(documents(spark, sf_dir).select("doc_id", "text"), items).select("doc_id", "item_id", "score", "last_word")


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def op10_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    learn = docs.filter(F.crc32(F.col("doc_id").cast("string")) % 5 != 0)
    model = langid.trained(learn)
    return langid.predicted(docs.select("doc_id", "text", held_out().alias("held_out")), model) \
        .select("doc_id", "held_out", "lang_pred", "score", "ambiguous")


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(documents(spark, sf_dir).select("text", "lang"))


def planted(docs: DataFrame) -> DataFrame:
    """(doc_id, text); a tenth of the texts, chosen by doc_id, repeat a stretch of their words up to the end."""
    code = F.crc32(F.col("doc_id").cast("string"))
    salt = F.floor(code / 10)

    def cycled(words):
        n = F.size(words)
        at = F.pmod(salt, n).cast("int")
        period = (F.lit(1) + F.floor((n - at) / (F.lit(3) + salt % 8))).cast("int")
        times = (F.floor((n - at) / period) + 1).cast("int")
        tail = F.flatten(F.array_repeat(F.slice(words, at + 1, period), times))
        return F.when(n > 0, F.array_join(F.slice(F.concat(F.slice(words, F.lit(1), at), tail), F.lit(1), n), " "))

    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    changed = F.transform(F.array(words), cycled)[0]  # the lambda evaluates the words once
    return docs.select("doc_id", F.when(code % 10 == 0, changed).otherwise(F.col("text")).alias("text"))


def op12_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periods.periodic(planted(documents(spark, sf_dir)))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r.length.alias("length"), (-r.start).alias("before"), (-r.period).alias("finer"))))
    lines = F.transform("runs", lambda r: F.concat(r.start, F.lit(","), r.length, F.lit(","), r.period, F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.before")).alias("start"), F.col("best.length").alias("length"),
        (-F.col("best.finer")).alias("period"), F.expr("1000 * best.length div -best.finer").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    learn = docs.filter(F.crc32(F.col("doc_id").cast("string")) % 5 != 0)
    marks = labels.filter(F.crc32(F.col("doc_id").cast("string")) % 5 != 0)
    model = toxicity.trained(learn, marks, toxicity.letters(docs))
    return toxicity.scored(docs.select("doc_id", "text", held_out().alias("held_out")), model) \
        .select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


QUERIES = {
    "op1_mixing": op1_mixing,
    "op2_similar": op2_similar,
    "op3_sharding": op3_sharding,
    "op4_surrogates": op4_surrogates,
    "op5_quality": op5_quality,
    "op6_pseudolm": op6_pseudolm,
    "op7_licences": op7_licences,
    "op8_repeats": op8_repeats,
    "op9_leaks": op9_leaks,
    "op10_langid": op10_langid,
    "op11_phrases": op11_phrases,
    "op12_periods": op12_periods,
    "op13_toxicity": op13_toxicity,
}
