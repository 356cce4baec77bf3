"""Queries of the text operators over the given tables, with SQL where DuckDB can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from genespark.llm import hard_negatives, language, packing, pieces, pii, pipeline, prefix_trie, quality, secrets, sharding, simhash, substrings, token_counts, topk

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@query("op1_token_counts")
def op1(spark, sf_dir):
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query("op2_language")
def op2(spark, sf_dir):
    return language.identify(table(spark, sf_dir, "documents"))


@query("op3_packing")
def op3(spark, sf_dir):
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query("op4_quality_rules")
def op4(spark, sf_dir):
    return quality.quality_documents(table(spark, sf_dir, "documents"))


@query("op5_substrings")
def op5(spark, sf_dir):
    return substrings.repeated_passages(table(spark, sf_dir, "documents"))


@query("op6_sharding")
def op6(spark, sf_dir):
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


@query("op7_simhash")
def op7(spark, sf_dir):
    return simhash.simhash_documents(table(spark, sf_dir, "documents"))


@query("op10_pieces")
def op10(spark, sf_dir):
    return pieces.encode_and_decode(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


TOP_SQL = """
    with v as (
        select vec_id, list_transform(embedding, lambda x: floor(64 * cast(x as double))) as e
        from embeddings
        where embedding is not null
          and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
    s as (
        select q.vec_id as query_id, c.vec_id, cast(list_inner_product(q.e, c.e) as bigint) as score
        from v q join v c on q.vec_id <> c.vec_id
        where q.vec_id % 20 = 0)
    select query_id, cast(rank as integer) as rank, vec_id, score
    from (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s)
    where rank <= 20"""


@query("op8_topk", TOP_SQL)
def op8(spark, sf_dir):
    vectors = topk.whole_numbers(table(spark, sf_dir, "embeddings"))
    return topk.nearest(vectors, vectors.where(F.col("vec_id") % 20 == 0))


@query("op9_pii")
def op9(spark, sf_dir):
    return pii.pii_documents(table(spark, sf_dir, "documents"))


# crc32 of the decimal conv_id, bit by bit; then nodes as distinct beginnings, and each node's figures handed to its ancestors.
TRIE_SQL = """
    with t as (
        select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text,
            row_number() over (partition by conv_id order by turn nulls first, role nulls first, text nulls first) as pos
        from conversations where conv_id is not null),
    c as (
        select conv_id, list(struct_pack(r := role, x := text) order by pos) as own,
            list_reduce(list_concat([4294967295::ubigint], list_transform(string_split(conv_id::varchar, ''), lambda d: ascii(d)::ubigint)),
                lambda c, b: list_reduce(list_concat([xor(c, b)], [0::ubigint, 0, 0, 0, 0, 0, 0, 0]),
                    lambda v, z: xor(v >> 1, 3988292384::ubigint * (v & 1::ubigint)))) as reg
        from t group by conv_id),
    h as (select *, (xor(reg, 4294967295::ubigint) % 4)::int as h from c),
    b as (
        select h.conv_id, list_concat(coalesce(base.own[1:h.h], []), h.own[h.h + 1:]) as p
        from h left join h base on base.conv_id = h.conv_id - h.conv_id % 20),
    m as (select conv_id, p, len(p)::bigint as n, unnest(range(0, len(p)::bigint + 1)) as depth from b),
    k as (select conv_id, n, depth, p[1:depth] as node, case when depth > 0 then p[depth].x else '' end as last from m),
    n as (
        select node, depth, min(conv_id) as id, count(*) as n_convs,
            (count(*) - 1) * len(regexp_extract_all(any_value(last), '[^\\x20\\x09-\\x0D]+')) as saved,
            sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (n = depth), '')) as ends_sha256
        from k group by node, depth),
    f as (select n.*, up.id as parent, (select count(*) from n d where d.depth = n.depth + 1 and d.node[1:n.depth] = n.node) as n_children
        from n left join n up on up.depth = n.depth - 1 and up.node = n.node[1:n.depth - 1]),
    s as (
        select a.node, sum((d.n_children = 0)::bigint) as n_leaves, sum(d.saved) as saved_tokens
        from n a join f d on d.depth >= a.depth and d.node[1:a.depth] = a.node group by a.node)
    select id as conv_id, depth, parent as parent_conv_id, n_convs, n_children, n_leaves::bigint as n_leaves, saved_tokens::bigint as saved_tokens, ends_sha256
    from f join s using (node)"""


@query("op11_prefix_trie", TRIE_SQL)
def op11(spark, sf_dir):
    return prefix_trie.conversation_trie(table(spark, sf_dir, "conversations"))


@query("op12_secrets")
def op12(spark, sf_dir):
    return secrets.secret_documents(table(spark, sf_dir, "documents"))


NEGATIVES_SQL = """
    with v as (
        select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
            list_transform(embedding, lambda x: floor(256 * cast(x as double))) as e
        from embeddings
        where label is not null and embedding is not null
          and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
    s as (
        select a.vec_id as anchor_id, c.vec_id, a.label = c.label as same, cast(list_inner_product(a.e, c.e) as bigint) as score
        from v a join v c on a.vec_id <> c.vec_id
        where a.vec_id % 100 = 0),
    p as (
        select * from (select *, row_number() over (partition by anchor_id order by score desc, vec_id) as place from s where same)
        where place <= 5),
    n as (
        select p.anchor_id, p.vec_id as positive_id, s.vec_id as negative_id, p.score as positive_score, s.score as negative_score,
            row_number() over (partition by p.anchor_id, p.vec_id order by s.score desc, s.vec_id) as rank
        from p join s on s.anchor_id = p.anchor_id and not s.same
            and 80 * p.score <= 100 * s.score and 100 * s.score <= 100 * p.score)
    select anchor_id, positive_id, cast(rank as integer) as rank, negative_id, positive_score, negative_score from n where rank <= 5"""


@query("op13_hard_negatives", NEGATIVES_SQL)
def op13(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine_hard_negatives(vectors.withColumn("label", label))


QUERIES["pipeline"] = pipeline.run
if pipeline.ORACLE_SQL:
    ORACLES["pipeline"] = pipeline.ORACLE_SQL
