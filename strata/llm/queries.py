"""The registered queries of this subpackage: each applies one operator to its whole table and derives the columns
that its contract names."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from strata.llm import (
    align, chat, decontam, linededup, ngramjoin, packing, periods, quality, secret_scan, simhash, tokenfile, urlfilter, warc)
from strata.llm.common import table, written
from strata.llm.oracle import ORACLE_SQL  # noqa: F401
from strata.session import scratch_dir

DOCUMENT = ("doc_id", "text", "lang", "source")


def op1_quality_rules(spark, sf_dir):
    """Quality rules: base rules, then adaptive fences from quantile sketches per language and source."""
    judged = quality.judge(table(spark, sf_dir, "documents", *DOCUMENT), keep_row=False)
    return judged.select("row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", "kept", "failed_metrics")


def op2_packing(spark, sf_dir):
    """Packing: whole documents into sequences of 1024 tokens by minimum bin slack."""
    pieces = packing.pack(table(spark, sf_dir, "documents", "doc_id", "text"),
                          public_tokenizers.path("byte_bpe_50k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id",
                         "offset")


#: pages have no time of capture: one a second from this one on, by page_id
CAPTURED_FROM = 1_700_000_000


def op3_warc(spark, sf_dir):
    """WARC: pages written as archives with revisit records, read back through the merged capture index."""
    folder = scratch_dir(spark, "archives")
    captured = F.lit(CAPTURED_FROM) + F.pmod(F.coalesce("page_id", F.lit(0)), F.lit(1_000_000_000))
    warc.write_archives(table(spark, sf_dir, "pages", "page_id", "url", "html"), folder, captured)
    return warc.capture_histories(spark, folder).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


URL_RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
             ("allow", "com", "/fr/"), ("block", "com", "/de/")]
#: the list of the query: the urls of hosts with one of these labels
LISTED_LABELS = ("spam-farm", "cheap-pills", "casino-win", "ads-track", "free-bets", "adult-x")


def op4_url_filter(spark, sf_dir):
    """URL filter: rules by host and path, else exact list membership from a Bloom filter cascade."""
    pages = table(spark, sf_dir, "pages", "page_id", "url")
    host, path = urlfilter.host_of(F.col("url")), urlfilter.path_of(F.col("url"))
    listed = pages.where(host.rlike(rf"(^|\.)({'|'.join(LISTED_LABELS)})(\.|$)")).select(
        F.concat(host, path).alias("key"))
    return urlfilter.judge_urls(pages, URL_RULES, listed).select(
        "row.page_id", "host", "path", "rule", "verdict", "listed")


def op5_simhash_near_dedup(spark, sf_dir):
    """SimHash near-dedup: fingerprints of 4-word shingles, linked within 4 bits by multi-index hashing."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"), F.struct("doc_id"))
    return found.select("row.doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op6_secret_scan(spark, sf_dir):
    """Secret scan: pattern spans, and tokens that a battery of tests cannot tell from random ones."""
    found = secret_scan.find_secrets(table(spark, sf_dir, "documents", "doc_id", "text"))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda s: s["kind"] != "random")
    return found.select(
        "doc_id", count("assign"), count("access"), count("hex"),
        F.sha2(secret_scan.span_text(base), 256).alias("base_sha256"), secret_scan.span_text(F.col("spans")).alias("spans"))


def op7_line_dedup(spark, sf_dir):
    """Line dedup: levelled sorted runs of line hashes over batches of documents."""
    done = linededup.drop_shared_lines(table(spark, sf_dir, "documents", "doc_id", "text"))
    return done.select("row.doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op8_benchmark_decontamination(spark, sf_dir):
    """Benchmark decontamination: template windows of documents and items, joined and checked for consistent values."""
    return decontam.leaks(table(spark, sf_dir, "documents", "doc_id", "text"),
                          table(spark, sf_dir, "benchmark", "item_id", "text")).drop("text_hash")


def op9_token_files(spark, sf_dir):
    """Token files: ids of all documents in doc_id order, Elias-Fano boundaries, read back from the files."""
    folder = scratch_dir(spark, "token-files")
    tokenfile.write_token_files(table(spark, sf_dir, "documents", "doc_id", "text"), folder,
                                public_tokenizers.path("word_bpe_49k.json"), end_id=1, vocabulary=49408)
    return tokenfile.document_offsets(tokenfile.read_token_files(spark, folder))


def op10_chat_formatting(spark, sf_dir):
    """Chat formatting: incremental rendering of every conversation, spans and loss mask, read back from the output."""
    control = "<|im_end|><|im_start|>assistant ok"
    turns = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-1, 0, "user", control), (-1, 1, "assistant", control)], turns.schema)
    return chat.digests(written(chat.format_chats(turns.unionByName(extra)), "chats"))


def op11_cross_tokenizer_alignment(spark, sf_dir):
    """Cross-tokenizer alignment: groups and links of the tokens of two tokenizers by pointer jumping."""
    return align.align(table(spark, sf_dir, "documents", "doc_id", "text"),
                       public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def op12_periodic_runs(spark, sf_dir):
    """Periodic run detection: maximal repetitions of words by block convolution at dyadic scales."""
    return periods.find_runs(table(spark, sf_dir, "documents", "doc_id", "text"), periods.with_repetition)


def op13_ngram_jaccard_join(spark, sf_dir):
    """N-gram Jaccard join: a blocked sparse product of the document by 4-gram matrix, links at 0.85 or more."""
    return ngramjoin.similar_documents(table(spark, sf_dir, "documents", "doc_id", "text"))


QUERIES = {
    "op1_quality_rules": op1_quality_rules,
    "op2_packing": op2_packing,
    "op3_warc": op3_warc,
    "op4_url_filter": op4_url_filter,
    "op5_simhash_near_dedup": op5_simhash_near_dedup,
    "op6_secret_scan": op6_secret_scan,
    "op7_line_dedup": op7_line_dedup,
    "op8_benchmark_decontamination": op8_benchmark_decontamination,
    "op9_token_files": op9_token_files,
    "op10_chat_formatting": op10_chat_formatting,
    "op11_cross_tokenizer_alignment": op11_cross_tokenizer_alignment,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_ngram_jaccard_join": op13_ngram_jaccard_join,
}
