"""Registered queries of the corpus operators, and their SQL counterparts where SQL can say it."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyloom.llm.bpe import encode_texts
from tallyloom.llm.common import bound, crc_remainder, read_table
from tallyloom.llm.exact_dedup import exact_groups, text_digest
from tallyloom.llm.lm import score_texts, train_model
from tallyloom.llm.mixing import mix_sources
from tallyloom.llm.near_dedup import near_groups
from tallyloom.llm.quality import THRESHOLD as QUALITY_THRESHOLD, quality_scores
from tallyloom.llm.periodic_runs import find_runs
from tallyloom.llm.quality_rules import judge_quality, words_of
from tallyloom.llm.suffix_dedup import remove_repeats
from tallyloom.llm.topk import top_k
from tallyloom.llm.toxicity import THRESHOLD as TOXIC_THRESHOLD, toxicity_scores
from tallyloom.llm.url_filter import judge_urls
from tallyloom.llm.vector_codes import compress, with_group_error


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the one of its group of equal texts that stays."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return exact_groups(docs).select(
        "row.doc_id", "keep_id", "group_size", "kept", text_digest(F.col("row.text")).alias("text_sha256")
    )


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the smallest id among its near duplicates."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_groups(docs).select("doc_id", "n_shingles", "component_id", "kept")


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of each document the mix takes, and the output shard of each copy."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    shards = F.array_join("shards", ",").alias("shards")
    return mix_sources(docs).select("row.doc_id", "size", "source_size", "target", "taken", shards)


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's URL."""
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    return judge_urls(pages).select("row.page_id", "host", "path", "rule", "verdict")


def tokenizer_path() -> str:
    """Place of the vocabulary file; it is read there and never copied."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every text's ids and of what they decode to."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return encode_texts(docs, tokenizer_path()).select(
        "row.doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join("ids", " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log10 probability of every text under a model that a seventh of the ids does not shape."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(crc_remainder(F.col("doc_id"), 7) == 2, F.lit(False))
    model = train_model(docs.filter(~held_out))
    return score_texts(docs.withColumn("held_out", held_out), model).select(
        "row.doc_id",
        "row.held_out",
        "n_tokens",
        "n_known",
        F.lit(model.n_tokens).cast("bigint").alias("train_tokens"),
        "base_score",
        "score",
    )


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document; a fifth of the ids is held out from learning."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read_table(spark, sf_dir, "labels").select("doc_id", "quality")
    scored = quality_scores(docs, labels, crc_remainder(F.col("doc_id"), 5) != 0)
    return scored.select(
        "row.doc_id",
        F.coalesce(crc_remainder(F.col("row.doc_id"), 5) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= QUALITY_THRESHOLD).cast("int").alias("predicted"),
    )


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every text without the 400-byte strings that occur again."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda total, s: total + s["to"] - s["from"])
    return remove_repeats(docs).select(
        "row.doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("bigint").alias("n_spans"),
        F.sha2(F.col("kept"), 256).alias("kept_sha256"),
    )


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected severity of every document; a fifth of the ids is held out from learning."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read_table(spark, sf_dir, "labels").select("doc_id", "toxic")
    scored = toxicity_scores(docs, labels, crc_remainder(F.col("doc_id"), 5) != 0)
    return scored.select(
        "row.doc_id",
        F.coalesce(crc_remainder(F.col("row.doc_id"), 5) == 0, F.lit(False)).alias("held_out"),
        "score",
        "severity",
        (F.col("score") >= TOXIC_THRESHOLD).cast("int").alias("predicted"),
    )


def op10_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best other vectors of every fiftieth vector."""
    return top_k(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of the quality rules for every document."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return judge_quality(docs).select(
        "row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def planted_repeats(doc_id: Column, text: Column) -> Column:
    """The text; for ids whose crc32 ends in 0, with its words from some place on repeated periodically."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)

    def repeated(words: Column) -> Column:
        n = F.size(words)
        first = (g % n).cast("int")
        period = 1 + F.floor((n - first) / (3 + g % 8)).cast("int")
        places = F.transform(
            F.sequence(F.lit(0), n - 1), lambda i: F.when(i < first, i).otherwise(first + (i - first) % period)
        )
        joined = F.array_join(F.transform(places, lambda i: F.get(words, i)), " ")
        return F.when(n > 0, joined).otherwise(text)

    return F.when(h % 10 == 0, bound(words_of(text), repeated)).otherwise(text)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's periodic runs: the longest one, digests of all and of what is left without repeats."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_runs(docs.withColumn("text", planted_repeats(F.col("doc_id"), F.col("text"))))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    ranked = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"], r.alias("run"))))
    longest = ranked["run"]
    return found.select(
        "row.doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        longest["start"].alias("start"),
        longest["length"].alias("length"),
        longest["period"].alias("period"),
        F.floor(1000 * longest["length"] / longest["period"]).alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product code of every vector, its error, and that of all vectors of its label."""
    vectors = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    coded, books = compress(vectors)
    coded = coded.select("row.vec_id", "row.label", "code", "error")
    return with_group_error(coded, F.col("label")).select(
        "vec_id", "code", "error", F.col("group_error").alias("label_error"), F.lit(books.sha256).alias("codebooks_sha256")
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_near_dedup": op2_near_dedup,
    "op3_mix_sources": op3_mix_sources,
    "op4_url_filter": op4_url_filter,
    "op5_bpe": op5_bpe,
    "op6_lm_scoring": op6_lm_scoring,
    "op7_quality": op7_quality,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_toxicity": op9_toxicity,
    "op10_exact_topk": op10_exact_topk,
    "op11_quality_rules": op11_quality_rules,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_vector_codes": op13_vector_codes,
}
