"""The queries of the training-data operators, with production parameters, and their oracles."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import ball_tree, bpe, conversation_repair, conversation_sql, embedding_dedup, exact_dedup, lexical, line_dedup, minhash, mixing, ngram_lm, quality, toxicity, warc
from .common import table

RANKS = "byte_bpe_multi_50k.tiktoken"

OP4_SQL = r"""
with n as (
  select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as t from documents
)
select doc_id, min(doc_id) over (partition by t) as keep_id, count(*) over (partition by t) as group_size,
       doc_id = min(doc_id) over (partition by t) as kept, sha256(t) as text_sha256
from n
"""


OP1_SQL = r"""
with lines as (
  select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as pos
  from documents
), keyed as (
  select *, translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
  from lines
), counted as (
  select key, count(distinct doc_id) as n from keyed where length(key) >= 1 group by key
)
select doc_id, count(*) as n_lines, count(*) filter (where coalesce(n, 0) >= 10) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where coalesce(n, 0) < 10), '')) as kept_sha256
from keyed left join counted using (key) group by doc_id
"""


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.report(table(spark, sf_dir, "documents"))


def op2_ngram_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_lm.held_out_scores(table(spark, sf_dir, "documents"))


def op3_dart_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.classes(table(spark, sf_dir, "documents"))


def op4_block_naming(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


OP5_SQL = """
with p as (
  select page_id, coalesce(html, '') as t, strlen(coalesce(html, '')) as n from pages
), f as (
  select *, min(page_id) over (partition by t) as first_id from p
)
select page_id, n as payload_bytes, sha256(t) as payload_digest,
       case when n >= 100 and first_id < page_id then 'revisit' else 'response' end as record_type,
       case when n >= 100 and first_id < page_id then first_id end as refers_to
from f
"""


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages")).drop("problem")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(table(spark, sf_dir, "documents"))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = bpe.round_trip(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)
    return done.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


OP11_SQL = r"""
with docs as (
  select row_number() over () as row, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as terms from documents
), held as (
  select row, doc_id, len(terms)::bigint as n, terms from docs where len(terms)>0
), whole as (
  select count(*) as n_docs, sum(n)::bigint as n_terms from held
), tfs as (
  select row, doc_id, n, term, count(*) as tf from (select row, doc_id, n, unnest(terms) as term from held) group by all
), dfs as (
  select term, floor(1000*ln((2*n_docs+2)::double/(2*count(*)+1)))::bigint as w from tfs, whole group by term, n_docs
), items as (
  select item, item_id, term, count(*) as times from (select row_number() over () as item, item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from benchmark) group by all
), scored as (
  select item, item_id, row, doc_id, sum(times*w*((1000000000*tf)//(1000*tf+12*(100-25+(25*n*n_docs)//n_terms))))::bigint as score
  from items join dfs using (term) join tfs using (term), whole group by all
)
select item_id, rank::int as rank, doc_id, score from (select *, row_number() over (partition by item order by score desc, doc_id nulls last, row) as rank from scored where score>0) where rank<=20
"""


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP12_SQL = """
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(1024*x::double)::bigint) as e from embeddings
  where vec_id is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x)))=0
), s as (
  select q.vec_id as query_id, c.vec_id, coalesce(list_sum(list_transform(range(1, len(c.e)+1), lambda i: q.e[i]*c.e[i])), 0)::bigint as score
  from (select distinct * from v where vec_id%100=0) q join v c on c.vec_id<>q.vec_id and len(c.e)=len(q.e)
)
select query_id, rank::int as rank, vec_id, score from (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s) where rank<=10
"""


def op12_ball_tree_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ball_tree.top_k(table(spark, sf_dir, "embeddings"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.report(table(spark, sf_dir, "conversations"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_line_dedup, op2_ngram_lm, op3_dart_minhash, op4_block_naming, op5_warc, op6_toxicity, op7_embedding_dedup, op8_quality, op9_mixing, op10_bpe, op11_lexical_search, op12_ball_tree_search, op13_conversation_repair)}


def oracle_sql() -> dict[str, str]:
    return {"op1_line_dedup": OP1_SQL, "op4_block_naming": OP4_SQL, "op5_warc": OP5_SQL, "op11_lexical_search": OP11_SQL, "op12_ball_tree_search": OP12_SQL, "op13_conversation_repair": conversation_sql.SQL}
