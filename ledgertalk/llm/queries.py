"""The operators as queries over whole tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgertalk.llm import (
    ann,
    bpe,
    conversation_trie,
    html_extract,
    jaccard,
    packing,
    piece_bpe,
    pii,
    quality_lm,
    quality_rules,
    sharding,
    spelling,
    sql,
    url_rules,
)
from ledgertalk.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]

# The vocabulary is installed on every machine; it is a parameter of the operators.
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = bpe.encode(table(spark, sf_dir, "documents"), TOKENIZER, back=True)
    return encoded.select(
        "doc_id",
        (F.octet_length("ids") / packing.ID_BYTES).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_lm.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", "lang", "grams", "perplexity", "threshold", "kept")


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), TOKENIZER)


def op5_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    is_query = F.col("id") % ann.QUERY_EVERY == 0
    return ann.neighbours(table(spark, sf_dir, "embeddings"), is_query)


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    labelled = url_rules.labelled_pages(pages, table(spark, sf_dir, "labels"))
    return url_rules.judged(pages, labelled)


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sharding.shard_rows(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = pii.spans(docs, pii.fit(docs))

    def written(spans: Column) -> Column:
        """Spans as text, by start, then kind in the order of the list of kinds."""
        kinds = F.array(*[F.lit(k) for k in pii.KINDS])
        ordered = F.sort_array(
            F.transform(
                spans,
                lambda s: F.struct(
                    s["start"].alias("start"),
                    F.array_position(kinds, s["kind"]).alias("nth"),
                    s["end"].alias("end"),
                    s["kind"].alias("kind"),
                ),
            )
        )
        return F.array_join(
            F.transform(
                ordered,
                lambda s: F.concat_ws(
                    ":", s["kind"], s["start"].cast("string"), s["end"].cast("string")
                ),
            ),
            ",",
        )

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in pii.KINDS],
        F.sha2(written(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        written(F.concat("base", "added")).alias("spans"),
        F.size("added").cast("long").alias("n_added"),
    )


def op9_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.linked(table(spark, sf_dir, "documents")).drop("text_hash")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judged(table(spark, sf_dir, "documents"))


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.trie(table(spark, sf_dir, "conversations"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def op13_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = piece_bpe.encode(table(spark, sf_dir, "documents"), PIECES)
    return piece_bpe.decode(encoded, PIECES).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias(
            "ids_sha256"
        ),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def llm_queries() -> dict[str, Query]:
    return {
        "op1_html_extraction": op1_html_extraction,
        "op2_bpe": op2_bpe,
        "op3_quality_classifier": op3_quality_classifier,
        "op4_best_fit_packing": op4_best_fit_packing,
        "op5_nearest_neighbours": op5_nearest_neighbours,
        "op6_url_filters": op6_url_filters,
        "op7_sharding": op7_sharding,
        "op8_pii": op8_pii,
        "op9_ngram_jaccard_join": op9_ngram_jaccard_join,
        "op10_quality_rules": op10_quality_rules,
        "op11_conversation_trie": op11_conversation_trie,
        "op12_spelling_variants": op12_spelling_variants,
        "op13_sentencepiece": op13_sentencepiece,
        "pipeline": corpus_pipeline.run,
    }


def llm_sql() -> dict[str, str]:
    return {
        "op9_ngram_jaccard_join": sql.NGRAM_JACCARD_JOIN,
        "op10_quality_rules": quality_rules.SQL,
        "op11_conversation_trie": sql.CONVERSATION_TRIE,
        "op12_spelling_variants": sql.SPELLING_VARIANTS,
    }
