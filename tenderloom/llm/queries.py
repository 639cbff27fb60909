"""The registered queries of this subpackage; each takes (spark, sf_dir)."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from fractions import Fraction
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenderloom.llm import (
    bottom_k,
    byte_bpe,
    chat_format,
    fill_middle,
    huffman,
    language_codes,
    ordinal_toxicity,
    packing,
    reversed_search,
    separator_scan,
    topk,
    url_markov,
    weighted_sampling,
)
from tenderloom.llm.common import table
from tenderloom.llm.tokens import public_path
from tenderloom.session import work_folder

Query = Callable[[SparkSession, str], DataFrame]


def op1_weighted_sampling(spark, sf_dir):
    return weighted_sampling.fingerprint(table(spark, sf_dir, "documents"))


def op2_best_two_fit_packing(spark, sf_dir):
    pieces = packing.token_pieces(table(spark, sf_dir, "documents"), public_path("word_bpe_49k.json"))
    return packing.pack(pieces)


def op3_output_codes(spark, sf_dir):
    return language_codes.identify(table(spark, sf_dir, "documents"))


def op4_ordinal_toxicity(spark, sf_dir):
    return ordinal_toxicity.assess(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_separator_scan(spark, sf_dir):
    path = work_folder(spark, "token-files")
    separator_scan.write_tokens(table(spark, sf_dir, "documents"), path, public_path("byte_bpe_50k.json"))
    return separator_scan.count_tokens(spark, path).select("doc_id", "n_tokens", "closed")


def op6_huffman_token_files(spark, sf_dir):
    def digest(batches) -> Iterator:
        for batch in batches:
            yield batch.assign(ids_crc32=[huffman.ids_crc32(ids) for ids in batch.pop("ids")])

    rows = huffman.round_trip(table(spark, sf_dir, "documents"), public_path("byte_bpe_50k.json"))
    return rows.mapInPandas(digest, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op7_url_markov(spark, sf_dir):
    return url_markov.judge(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op8_bottom_k_near_duplicates(spark, sf_dir):
    return bottom_k.near_duplicates(table(spark, sf_dir, "documents"), Fraction(85, 100))


def op9_byte_bpe(spark, sf_dir):
    import public_tokenizers

    path, pattern = public_path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    return byte_bpe.decode_ids(byte_bpe.encode_texts(table(spark, sf_dir, "documents"), path, pattern), path, pattern)


def op10_exact_top_k(spark, sf_dir):
    return topk.top_k(table(spark, sf_dir, "embeddings"))


def op11_template_compiler(spark, sf_dir):
    said = r"\### Assistant: </turn> ok"
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    more = [(-7, 0, "user", said), (-7, 1, "assistant", said)]
    more = spark.createDataFrame(more, "conv_id long, turn long, role string, text string")
    return chat_format.digests(chat_format.format_conversations(rows.unionByName(more)))


def op12_displacement_scatter(spark, sf_dir):
    return fill_middle.round_trip(table(spark, sf_dir, "documents"))


def op13_reversed_search(spark, sf_dir):
    return reversed_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_weighted_sampling,
        op2_best_two_fit_packing,
        op3_output_codes,
        op4_ordinal_toxicity,
        op5_separator_scan,
        op6_huffman_token_files,
        op7_url_markov,
        op8_bottom_k_near_duplicates,
        op9_byte_bpe,
        op10_exact_top_k,
        op11_template_compiler,
        op12_displacement_scatter,
        op13_reversed_search,
    )
}
