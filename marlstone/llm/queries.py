"""One registered query per operator, over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.llm.alignment import alignment_scores
from marlstone.llm.bpe_frames import round_trip
from marlstone.llm.centroids import CLUSTERS, DIMS, ROUNDS, cluster_vectors
from marlstone.llm.exact import mark_copies
from marlstone.llm.gam import fit_quality, score_quality
from marlstone.llm.language import fit_languages, identify
from marlstone.llm.minhash import near_components
from marlstone.llm.ordered import pack_in_order
from marlstone.llm.packing import cut_pieces, pack
from marlstone.llm.paragraphs import repeated_paragraphs
from marlstone.llm.quality_rules import judge
from marlstone.llm.samples import id_part
from marlstone.llm.token_files import read_token_files, write_token_files
from marlstone.llm.toxicity import fit_grammar, score_toxicity
from marlstone.session import shared_dir
from marlstone.sources.tables import read_table

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
QUALITY_FROM = 0.7
TOXIC_FROM = 0.3
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_PIECES = public_tokenizers.path("piece_bpe_32k.model")


def op1_rank_array_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return round_trip(read_table(spark, folder, "documents", ["doc_id", "text"]), WORD_BPE)


def op2_ppm_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents", ["doc_id", "text", "lang"])
    trees = fit_languages(docs.where(id_part("doc_id", 5) != 0))
    found = identify(docs.select("doc_id", "text"), trees)
    return found.select("doc_id", (id_part("doc_id", 5) == 0).alias("held_out"), "language.*")


def op3_mcd_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = judge(read_table(spark, folder, "documents", ["doc_id", "lang", "source", "text"]))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return docs.select("doc_id", *[f"verdict.{c}" for c in [*counts, "base_failed", "kept", "distance"]])


def op4_patched_token_files(spark: SparkSession, folder: str) -> DataFrame:
    path = shared_dir(spark, "token-files")
    write_token_files(read_table(spark, folder, "documents", ["doc_id", "text"]), BYTE_BPE, path)
    return read_token_files(spark, path, digest=True).withColumnRenamed("id", "doc_id")


def op10_msd_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents", ["doc_id", "text"])
    return mark_copies(docs).select("doc_id", "copies.*")


def op5_hyperminhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = near_components(read_table(spark, folder, "documents", ["doc_id", "text"]))
    return docs.select("doc_id", "near.n_shingles", "near.component_id", "near.kept")


def op6_clause_grammar_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents", ["doc_id", "text"])
    labels = read_table(spark, folder, "labels", ["doc_id", "toxic"])
    grammar = fit_grammar(docs, labels.where(id_part("doc_id", 4) != 2))
    held_out = (id_part("doc_id", 4) == 2).alias("held_out")
    predicted = (F.col("toxicity.score") >= TOXIC_FROM).cast("int").alias("predicted")
    return score_toxicity(docs, grammar).select("doc_id", held_out, "toxicity.score", predicted)


def op7_additive_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents", ["doc_id", "text"])
    labels = read_table(spark, folder, "labels", ["doc_id", "quality"])
    model = fit_quality(docs, labels.where(id_part("doc_id", 4) != 2))
    held_out = (id_part("doc_id", 4) == 2).alias("held_out")
    predicted = (F.col("quality.score") >= QUALITY_FROM).cast("int").alias("predicted")
    return score_quality(docs, model).select("doc_id", held_out, "quality.score", predicted)


def op8_paragraph_minhash(spark: SparkSession, folder: str) -> DataFrame:
    """One row per paragraph of a repeated passage; documents without one do not appear."""
    found = repeated_paragraphs(read_table(spark, folder, "documents", ["doc_id", "text"]))
    return found.select(
        F.col("doc.id").alias("doc_id"), F.col("number").alias("paragraph"), "start", F.col("size").alias("length"), "n_words",
        F.col("group").alias("component"), F.col("first.id").alias("keep_id"), "kept",
    )


def op9_genetic_packing(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents", ["doc_id", "text"])
    return pack(cut_pieces(docs, BYTE_BPE))


def op11_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents", ["doc_id", "text"])
    return alignment_scores(docs, BYTE_BPE, WORD_PIECES).withColumnRenamed("id", "doc_id")


def op12_ordered_packing(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents", ["doc_id", "text"])
    found = pack_in_order(docs, BYTE_BPE, digest=True).withColumnRenamed("id", "doc_id")
    return found.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op13_walsh_centroids(spark: SparkSession, folder: str) -> DataFrame:
    found = cluster_vectors(read_table(spark, folder, "embeddings", ["vec_id", "embedding"]))
    digest = F.sha2(F.array_join(F.col("centroid").cast("array<string>"), ","), 256)
    return found.select(F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", digest.alias("centroid_sha256"))


def _centroid_sql() -> str:
    """The rounds written out: assign by plain distances, then replace by floored means."""
    parts = [
        f"""v as materialized (
            select vec_id, list_transform(embedding, lambda x: floor(1024 * x::double)::bigint) as v from embeddings
            where len(embedding) = {DIMS} and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = {DIMS}
        )""",
        f"""c0 as materialized (
            select (row_number() over (order by sha256('3:' || vec_id::varchar)) - 1)::int as cluster, v as c from v
            qualify row_number() over (order by sha256('3:' || vec_id::varchar)) <= {CLUSTERS}
        )""",
    ]
    for r in range(ROUNDS + 1):
        parts.append(f"""a{r} as materialized (
            select vec_id, v, cluster, d from (
                select vec_id, v, cluster, list_sum(list_transform(range(1, {DIMS} + 1), lambda i: (v[i] - c[i]) * (v[i] - c[i])))::bigint as d from v, c{r}
            ) qualify row_number() over (partition by vec_id order by d, cluster) = 1
        )""")
        if r < ROUNDS:
            parts.append(f"""m{r} as materialized (
            select cluster, list(m order by i) as c from (
                select cluster, i, ((s - ((s % n) + n) % n) // n)::bigint as m from (
                    select cluster, i, sum(x)::bigint as s, count(*) as n
                    from (select cluster, unnest(v) as x, unnest(range(1, {DIMS} + 1)) as i from a{r}) group by cluster, i
                )
            ) group by cluster
        ), c{r + 1} as materialized (select cluster, coalesce(m{r}.c, c{r}.c) as c from c{r} left join m{r} using (cluster))""")
    return "with " + ",\n".join(parts) + f"""
        select vec_id, cluster, d as distance, (sum(d) over (partition by cluster))::bigint as cluster_inertia, (sum(d) over ())::bigint as inertia,
               sha256(array_to_string(c{ROUNDS}.c, ',')) as centroid_sha256
        from a{ROUNDS} join c{ROUNDS} using (cluster)"""


_ALL = (
    op1_rank_array_bpe,
    op2_ppm_language,
    op3_mcd_quality_rules,
    op4_patched_token_files,
    op5_hyperminhash_near_dedup,
    op6_clause_grammar_toxicity,
    op7_additive_quality,
    op8_paragraph_minhash,
    op9_genetic_packing,
    op10_msd_exact_dedup,
    op11_token_alignment,
    op12_ordered_packing,
    op13_walsh_centroids,
)
QUERIES = {q.__name__: q for q in _ALL}

SQL = {
    "op10_msd_exact_dedup": r"""
        with plain as (
            select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as text from documents
        )
        select doc_id, min(doc_id) over same as keep_id, count(*) over same as group_size,
               doc_id = min(doc_id) over same as kept, sha256(text) as text_sha256
        from plain window same as (partition by text)
    """,
    "op13_walsh_centroids": _centroid_sql(),
}
