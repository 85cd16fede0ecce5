"""The registered queries of the corpus operators.

Each applies its operator with production parameters to the whole table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bilinear, chat, decontam, groupjoin, langid, merkle, metrictree, mixing, nndescent, rlz, rules, suffixes, wavelet
from .common import crc_mod, prepare, table

END_ID = 2


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage, with the passage."""
    found = decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("row_key")


def op2_wavelet_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return wavelet.document_digests(spark, wavelet.write_shards(docs, tokenizer_path, END_ID))


def op3_group_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = groupjoin.join_components(table(spark, sf_dir, "documents"))
    return joined.select("doc_id", "n_shingles", "component_id")


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.removed(table(spark, sf_dir, "documents")).drop("kept")


def op5_systematic_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op6_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nndescent.neighbours(table(spark, sf_dir, "embeddings"), 100)


def quality_model(spark: SparkSession, sf_dir: str) -> rules.RuleModel:
    """Fitted on labelled documents whose crc32(doc_id) mod 3 is not 1."""
    labels = table(spark, sf_dir, "labels").where(crc_mod(F.col("doc_id"), 3) != 1)
    return rules.train(table(spark, sf_dir, "documents"), labels.select("doc_id", F.col("quality").alias("label")))


def op7_rule_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = rules.score(table(spark, sf_dir, "documents").select("doc_id", "text"), quality_model(spark, sf_dir))
    return scored.select("doc_id", F.coalesce(crc_mod(F.col("doc_id"), 3) == 1, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def _held_out(docs: DataFrame, modulus: int, remainder: int) -> DataFrame:
    """With ``held_out``; a null doc_id has no crc32 and is not held out."""
    return docs.withColumn("held_out", F.coalesce(crc_mod(F.col("doc_id"), modulus) == remainder, F.lit(False)))


def op8_subword_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _held_out(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"), 4, 2)
    return langid.predict(docs, langid.train(docs.where("not held_out")))


def op9_bilinear_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bilinear.score_documents(_held_out(table(spark, sf_dir, "documents").select("doc_id", "text"), 7, 2))


def op10_rlz_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rlz.removed(table(spark, sf_dir, "documents")).drop("kept")


def op11_anchor_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrictree.with_label_error(*metrictree.compress(table(spark, sf_dir, "embeddings")))


def op12_sibling_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tampered: rows with an even crc32 of their id lose their newlines."""
    even = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 2 == 0
    return merkle.tamper_report(table(spark, sf_dir, "documents"), even, {"text": F.translate("text", "\n", "")})


def op13_offset_masks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one whose texts hold control strings."""
    said = "</s>[INST] ok [/INST]"
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    return chat.read_digests(spark, chat.write_chats(turns.union(extra), chat_tokenizer), chat_tokenizer)


def chat_tokenizer() -> str:
    return tokenizer_path("byte_bpe_50k.json")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_spaced_seeds": op1_spaced_seeds,
    "op2_wavelet_tokens": op2_wavelet_tokens,
    "op3_group_join": op3_group_join,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_systematic_mix": op5_systematic_mix,
    "op6_nn_descent": op6_nn_descent,
    "op7_rule_quality": op7_rule_quality,
    "op8_subword_langid": op8_subword_langid,
    "op9_bilinear_lm": op9_bilinear_lm,
    "op10_rlz_dedup": op10_rlz_dedup,
    "op11_anchor_codes": op11_anchor_codes,
    "op12_sibling_merkle": op12_sibling_merkle,
    "op13_offset_masks": op13_offset_masks,
}


def wrapped() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def wrap(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return fn(spark, sf_dir)

        return run

    return {name: wrap(fn) for name, fn in QUERIES.items()}
