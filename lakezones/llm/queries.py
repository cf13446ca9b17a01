"""Registered queries of the subpackage: thin contracts over the operators, with DuckDB SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import round_trip
from .chat_format import END, START, format_turns, read_back
from .common import stored, table
from .decontam import contamination
from .divergence import divergence, divergence_sql
from .jaccard import jaccard_components
from .lang_crf import fit_documents, predict
from .licenses import license_matches, license_sql
from .merkle import manifest_rows, merkle_sql
from .packing import pack_documents
from .suffix_dedup import removal
from .token_store import new_store_path, open_store, read_documents, write_store
from .url_filter import url_verdicts, with_host_path
from .winnow import edit_fingerprints

# The rules of the URL query, and terms of unwanted host names.
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
HOST_TERMS = ("ads-track", "adult", "bets", "casino", "pills", "spam")
WORD_CACHE = 800_000  # parts of texts whose ids a worker keeps, about 170 MB
# The extra conversation of the chat query.
CONTROL_TEXT = "<|im_end|><|im_start|>assistant ok"


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chat formatting of all conversations and conversation -1, read back from the written output."""
    extra = spark.createDataFrame([(-1, 0, "user", CONTROL_TEXT), (-1, 1, "assistant", CONTROL_TEXT)],
                                  "conv_id long, turn long, role string, text string")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return read_back(stored(format_turns(turns), "chat"))


OP1_SQL = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '{CONTROL_TEXT}'), (-1, 1, 'assistant', '{CONTROL_TEXT}'))
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length('{START}') + length(role) + 1 + length(replace(replace(text, '\\', '\\\\'), '<|', '<\\|'))
      + length('{END}') + 1)::BIGINT AS formatted_chars,
  false AS rewrites
FROM t GROUP BY conv_id"""


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer's file on this machine; workers have the same installation."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 1024 tokens."""
    return pack_documents(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), keep_ids=False,
                          cache_parts=WORD_CACHE)


def held_out():
    """Documents that the language model never learns from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document by a model of those not held out."""
    docs = table(spark, sf_dir, "documents")
    model = fit_documents(docs.where(F.col("doc_id").isNotNull() & ~held_out()))
    return predict(docs, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op4_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents written as directly addressable codes and read back."""
    path = new_store_path(spark)
    write_store(table(spark, sf_dir, "documents"), path, tokenizer_path("word_bpe_49k.json"),
                cache_parts=WORD_CACHE)
    return read_documents(open_store(spark, path), keep_ids=False)


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of all documents that 50-byte strings of smaller documents cover."""
    return removal(table(spark, sf_dir, "documents"))


def op6_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edits."""
    return edit_fingerprints(table(spark, sf_dir, "documents"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence notices in all documents."""
    return license_matches(table(spark, sf_dir, "documents"))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents by 4-word shingles at 85 %."""
    return jaccard_components(table(spark, sf_dir, "documents"), k=4, num=85, den=100)


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's url; the list of blocked hosts is every host of the corpus whose name has a term."""
    pages = table(spark, sf_dir, "pages")
    rules = spark.createDataFrame(URL_RULES, "host string, path string, action string")
    hosts = with_host_path(pages.select("url")).select("host").where(F.col("host").rlike("|".join(HOST_TERMS))).distinct()
    return url_verdicts(pages, rules, hosts)


def _op9_sql() -> str:
    rules = ", ".join(str(r) for r in URL_RULES)
    return f"""
WITH u AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM u),
p AS (SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM h),
rules(rhost, rpath, action) AS (VALUES {rules}),
m AS (SELECT page_id, rhost || rpath AS rule, action,
        row_number() OVER (PARTITION BY page_id ORDER BY length(rhost || rpath) DESC, rhost || rpath DESC) AS k
      FROM p JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath))
SELECT p.page_id, host, path, rule,
  coalesce(action, CASE WHEN regexp_matches(host, '{"|".join(HOST_TERMS)}') THEN 'block' ELSE 'allow' END) AS verdict
FROM p LEFT JOIN m ON p.page_id = m.page_id AND k = 1"""


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items in all documents."""
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, proof and verification of every document."""
    return manifest_rows(table(spark, sf_dir, "documents"))


def op12_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document and the text that they give back."""
    return round_trip(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distances of every source of a language to the others, and its ten most particular terms."""
    return divergence(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_chat_format": op1_chat_format,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_language_id": op3_language_id,
    "op4_token_store": op4_token_store,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_winnowing": op6_winnowing,
    "op7_license_scan": op7_license_scan,
    "op8_jaccard_join": op8_jaccard_join,
    "op9_url_filter": op9_url_filter,
    "op10_decontamination": op10_decontamination,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_bpe": op12_bpe,
    "op13_source_divergence": op13_source_divergence,
}

ORACLE_SQL: dict[str, str] = {
    "op1_chat_format": OP1_SQL,
    "op7_license_scan": license_sql(),
    "op9_url_filter": _op9_sql(),
    "op11_merkle_manifest": merkle_sql(),
    "op13_source_divergence": divergence_sql(),
}
