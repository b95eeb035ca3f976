"""The operators as registered queries over whole tables, with the parameters used in production."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topicwake.llm import sql
from topicwake.llm.decontaminate import benchmark_passages
from topicwake.llm.merkle import folded, merkle_manifest, proof_hash, record_hash
from topicwake.llm.minhash import near_duplicates
from topicwake.llm.packing import pack
from topicwake.llm.quality import quality
from topicwake.llm.resampling import importance_resample
from topicwake.llm.substring_dedup import substring_dedup
from topicwake.llm.suffix_dedup import suffix_array_dedup
from topicwake.llm.token_counts import token_counts
from topicwake.llm.token_file import read_token_files, write_token_files
from topicwake.llm.topk import exact_top_k
from topicwake.llm.toxicity import toxicity
from topicwake.llm.warc import read_archives, write_archives
from topicwake.session import new_table_path


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_suffix_array_dedup(spark: SparkSession, sf: str) -> DataFrame:
    found = suffix_array_dedup(_table(spark, sf, "documents"), depth=200)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["start"])
    return found.select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op2_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    found = substring_dedup(_table(spark, sf, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["start"])
    return found.select(
        "doc_id",
        "n_words",
        F.size("spans").cast("long").alias("n_spans"),
        removed.alias("n_removed"),
        F.transform("spans", lambda s: s["start"]).alias("starts"),
        F.transform("spans", lambda s: s["end"]).alias("ends"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op3_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    return toxicity(_table(spark, sf, "documents"), _table(spark, sf, "labels"))


def op4_benchmark_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    return benchmark_passages(_table(spark, sf, "documents"), _table(spark, sf, "benchmark"))


def op5_minhash_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return near_duplicates(_table(spark, sf, "documents"), shingle=4, percent=80)


def op6_quality(spark: SparkSession, sf: str) -> DataFrame:
    return quality(_table(spark, sf, "documents"), _table(spark, sf, "labels"))


def op7_best_fit_packing(spark: SparkSession, sf: str) -> DataFrame:
    return pack(_table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=2)


def op8_token_files(spark: SparkSession, sf: str) -> DataFrame:
    docs, path = _table(spark, sf, "documents"), public_tokenizers.path("word_bpe_49k.json")
    return read_token_files(write_token_files(docs, path, end_id=1, folder=new_table_path(spark, "ids")))


def op9_exact_top_k(spark: SparkSession, sf: str) -> DataFrame:
    return exact_top_k(_table(spark, sf, "embeddings"))


def op10_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    return token_counts(_table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op11_warc_archives(spark: SparkSession, sf: str) -> DataFrame:
    archives = write_archives(_table(spark, sf, "pages"), new_table_path(spark, "warc"))
    chunks = read_archives(archives, data=False)
    return chunks.where("last").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op12_importance_resampling(spark: SparkSession, sf: str) -> DataFrame:
    found = importance_resample(_table(spark, sf, "documents"), _table(spark, sf, "benchmark"), percent=5, min_words=20)
    return found.select("doc_id", "n_features", "weight", "score", "rank")


def op13_merkle_manifest(spark: SparkSession, sf: str) -> DataFrame:
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    changed = [F.col(c) + 1 if c == "n_chars" else F.col(c) for c in fields]
    tampered = F.when(chosen, record_hash(*changed))
    found = merkle_manifest(_table(spark, sf, "documents"), fields, carry={"tampered": tampered})
    found = found.withColumn("folded_root", folded(F.coalesce("tampered", "leaf"), F.col("path")))
    return found.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        proof_hash(F.col("path")).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


QUERIES = {
    f.__name__: f
    for f in (
        op1_suffix_array_dedup,
        op2_substring_dedup,
        op3_toxicity,
        op4_benchmark_decontamination,
        op5_minhash_near_dedup,
        op6_quality,
        op7_best_fit_packing,
        op8_token_files,
        op9_exact_top_k,
        op10_token_counts,
        op11_warc_archives,
        op12_importance_resampling,
        op13_merkle_manifest,
    )
}
def _sized(*fields: str) -> str:
    return "sha256(concat(" + ", ".join(f"case when {c} is null then '-' else octet_length(encode({c}::varchar)) || ':' || {c} end" for c in fields) + "))"


_LETTERS = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_GRAMS = """list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]),
    list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))"""


def _words_of(table: str, key: str) -> str:
    words = rf"regexp_extract_all(translate(coalesce(text, ''), {_LETTERS}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    return f"select {key}, {words} as w from {table}"


ORACLES: dict[str, str] = {
    "op11_warc_archives": """
        with p as (select page_id, coalesce(html, '') as html from pages),
        q as (select page_id, octet_length(encode(html)) as payload_bytes, sha1(html) as payload_digest,
            max(page_id) over (partition by html) as first from p)
        select page_id, payload_bytes, payload_digest,
            case when payload_bytes >= 1000 and page_id is distinct from first then 'revisit' else 'response' end as record_type,
            case when payload_bytes >= 1000 and page_id is distinct from first then first end as refers_to from q
    """,
    "op12_importance_resampling": f"""
        with words as ({_words_of("documents", "doc_id")}),
        tally as (select doc_id, g, count(*) as c from (select doc_id, unnest({_GRAMS}) as g from words) group by all),
        target as (select g, count(*) as c from (select unnest({_GRAMS}) as g from ({_words_of("benchmark", "item_id")})) group by all),
        hashed as (select g, {sql.crc32("g")} % 10000 as b from (select g from tally union select g from target)),
        s as (select b, sum(c) as n from tally join hashed using (g) group by b),
        t as (select b, sum(c) as n from target join hashed using (g) group by b),
        totals as (select coalesce((select sum(n) from s), 0)::double as s_all, coalesce((select sum(n) from t), 0)::double as t_all),
        gains as (select s.b, floor(1000 * ln((coalesce(t.n, 0)::double + 1) * (s_all + 10000) / ((s.n::double + 1) * (t_all + 10000))))::bigint as gain
            from s left join t using (b), totals),
        weights as (select doc_id, sum(c)::bigint as n_features, sum(c * gain)::bigint as weight
            from tally join hashed using (g) join gains using (b) group by doc_id),
        drawn as (select doc_id, len(w) as n_words, coalesce(n_features, 0) as n_features, coalesce(weight, 0) as weight,
            coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || doc_id), 1, 8))::bigint::double + 0.5) / 4294967296)))::bigint as score
            from words left join weights using (doc_id)),
        ranked as (select *, row_number() over (order by n_words < 20, score desc, doc_id) as place,
            5 * count(*) filter (where n_words >= 20) over () // 100 as many from drawn)
        select doc_id, n_features, weight, score, case when place <= many then place end as rank from ranked
    """,
    "op13_merkle_manifest": f"""
        with recursive rows as (
            select doc_id, lang, {_sized("doc_id", "source", "lang", "n_chars", "text")} as node,
                case when {sql.crc32("doc_id::varchar")} % 7 = 0 then {_sized("doc_id", "source", "lang", "(n_chars + 1)", "text")} end as changed
            from documents
        ), docs as (
            select doc_id, lang as grp, row_number() over (partition by lang order by doc_id nulls first, node) - 1 as idx, node,
                count(*) over (partition by lang) as cnt, coalesce(changed, node) as changed from rows
        ), {sql.merkle("low", "docs")},
        tops as (
            select 0 as grp, grp as lang, row_number() over (order by encode(grp) nulls first) - 1 as idx, node, count(*) over () as cnt, node as changed
            from low_lv where cnt = 1
        ), {sql.merkle("high", "tops")},
        ends(doc_id, leaf, subroot, grp, idx, level, spot, cnt, changed, siblings) as (
            select d.doc_id, d.node, t.node, 0, t.idx, cast(0 as bigint), t.idx, t.cnt, p.folded, p.siblings || q.siblings
            from docs d join low_proof p on p.grp is not distinct from d.grp and p.idx = d.idx
            join tops t on t.lang is not distinct from d.grp join high_proof q on q.idx = t.idx
            union all
            select e.doc_id, e.leaf, e.subroot, e.grp, e.idx, e.level + 1, e.spot // 2, (e.cnt + 1) // 2,
                case when s.node is null then sha256(e.changed) when e.spot % 2 = 0 then sha256(e.changed || s.node)
                    else sha256(s.node || e.changed) end, e.siblings
            from ends e left join high_lv s on s.level = e.level and s.idx = xor(e.spot, 1) where e.cnt > 1
        )
        select doc_id, leaf, subroot, root, sha256(siblings) as proof_sha256, changed as folded_root, changed = root as verified
        from ends, (select node as root from high_lv where cnt = 1) where cnt = 1
    """,
    "op9_exact_top_k": """
        with v as (
            select vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as v
            from embeddings
            where vec_id is not null and embedding is not null
              and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
        ), scored as (
            select q.vec_id as query_id, c.vec_id,
                cast(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) as bigint) as score
            from v q join v c on q.vec_id % 50 = 0 and q.vec_id <> c.vec_id
        ), ranked as (
            select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank,
                vec_id, score
            from scored
        )
        select * from ranked where rank <= 5
    """,
}
