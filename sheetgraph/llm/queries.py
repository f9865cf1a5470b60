"""One query per operator: each applies it with its production parameters to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheetgraph.llm.common import fold, table


def vocabulary(name: str) -> str:
    """Place of a public tokenizer's file; the package is installed on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_bfd_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sheetgraph.llm import bfd_packing

    return bfd_packing.pack(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def op2_vamana(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sheetgraph.llm import vamana

    return vamana.nearest(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", F.col("vec_id") % 100 == 0, k=10)


def op3_lbl_nce(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sheetgraph.llm import lbl

    return lbl.score(table(spark, sf_dir, "documents"), fold("doc_id", 5, 1))


def op4_mil_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sheetgraph.llm import mil_quality

    docs = table(spark, sf_dir, "documents")
    model = mil_quality.train(docs, table(spark, sf_dir, "labels"), fold("_id", 4, 2))
    scored = mil_quality.score(docs, model, threshold=0.7)
    return scored.select("doc_id", fold("doc_id", 4, 2).alias("held_out"), "score", "predicted")


def op5_nnls_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sheetgraph.llm import nnls_packing

    return nnls_packing.pack(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def op6_collision_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sheetgraph.llm import collision_join

    return collision_join.near_duplicates(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", threshold=0.9)


def op7_toxic_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sheetgraph.llm import toxic_grammar

    docs = table(spark, sf_dir, "documents")
    model = toxic_grammar.train(docs, table(spark, sf_dir, "labels"), fold("_id", 5, 0))
    scored = toxic_grammar.score(docs, model, threshold=0.5)
    return scored.select("doc_id", fold("doc_id", 5, 0).alias("held_out"), "score", "predicted", "matched_clauses")


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sheetgraph.llm import simhash

    found = simhash.cluster(table(spark, sf_dir, "documents"), words=3, radius=2)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op9_rendezvous(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sheetgraph.llm import rendezvous

    docs = table(spark, sf_dir, "documents").select("doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1).alias("size"), F.crc32(F.coalesce(F.col("text"), F.lit(""))).alias("text_crc32"))
    dealt = rendezvous.number(rendezvous.assign(docs, "doc_id", [1.0] * 8, [1.0] * 9), "doc_id")
    return dealt.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from sheetgraph.llm import byte_bpe

    return byte_bpe.encode(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, digests=True)


def op11_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sheetgraph.llm import pii

    return pii.digest(pii.find(table(spark, sf_dir, "documents").select("doc_id", "text")))


def op12_pca_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sheetgraph.llm import pca_negatives

    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return pca_negatives.mine(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", label, lambda k: k % 100 == 0)


def op13_token_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sheetgraph.llm import token_align

    return token_align.align(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"), digests=True)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_bfd_packing, op2_vamana, op3_lbl_nce, op4_mil_quality, op5_nnls_packing, op6_collision_join, op7_toxic_grammar, op8_simhash, op9_rendezvous, op10_byte_bpe, op11_pii, op12_pca_negatives, op13_token_align, pipeline)}


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL of op6 and op12, by comparing all pairs, and of op11; the others need hashes, tokenizers or models that SQL lacks, or are approximate."""
    from sheetgraph.llm import pii_sql

    return {
        "op11_pii": pii_sql.sql(),
        "op12_pca_negatives": """with v as (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label, list_transform(embedding, lambda x: floor(256 * cast(x as double))) as e from embeddings where vec_id is not null and label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select a.vec_id as anchor_id, b.vec_id, a.label = b.label as same, cast(list_inner_product(a.e, b.e) as bigint) as score from v a join v b on a.vec_id <> b.vec_id and len(a.e) = len(b.e) where a.vec_id % 100 = 0),
p as (select * from s where same qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5),
n as (select p.anchor_id, p.vec_id as positive_id, cast(row_number() over (partition by p.anchor_id, p.vec_id order by s.score desc, s.vec_id) as integer) as rank, s.vec_id as negative_id, p.score as positive_score, s.score as negative_score from p join s on p.anchor_id = s.anchor_id where not s.same and 80 * p.score <= 100 * s.score and s.score <= p.score)
select * from n where rank <= 5""",
        "op6_collision_join": """with recursive v as (select vec_id, cast(embedding as double[]) as e from embeddings where embedding is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0),
l as (select a.vec_id as a, b.vec_id as b from v a join v b on a.vec_id <> b.vec_id and len(a.e) = len(b.e) where list_cosine_similarity(a.e, b.e) >= 0.9),
r(n, m) as (select vec_id, vec_id from embeddings union select l.b, r.m from r join l on r.n = l.a where r.m < l.b),
c as (select n, min(m) as component_id from r group by n), k as (select a, count(*) as n from l group by a)
select e.vec_id, coalesce(k.n, 0) as n_links, c.component_id, e.vec_id = c.component_id as kept from embeddings e join c on c.n = e.vec_id left join k on k.a = e.vec_id"""
    }
