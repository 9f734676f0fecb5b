"""One query for each operator, over its whole table, with the SQL that gives the same rows where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evenkeel.llm import (
    centroids, collocations, cosine_links, divergence, exact_dedup, language_id, license_scan, line_dedup, packing, perplexity, pieces, simhash_dedup, warc,
)
from evenkeel.llm.common import light_batches, reachable_by_workers
from evenkeel.sources.workspace import new_table_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")
WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def query(sql: str | None = None):
    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            reachable_by_workers(spark)
            return fn(spark, sf_dir)

        QUERIES[fn.__name__] = run
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query()
def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded, and decoded again."""
    docs = table(spark, sf_dir, "documents")
    encoded = pieces.encode(docs.withColumn("text", F.coalesce("text", F.lit(""))), PIECE_MODEL, decoded=True)
    return encoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_ids"), "ids", F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256")
    )


@query("""
    with t as (select doc_id, coalesce(text, '') as text from documents)
    select doc_id, max(doc_id) over same as keep_id, count(*) over same as group_size,
           doc_id = max(doc_id) over same as kept, sha256(text) as text_sha256
    from t window same as (partition by text)""")
def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"), every_digest=True)


@query()
def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_scan(table(spark, sf_dir, "documents"))


@query()
def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learned from documents that the contract lets it learn from, and applied to all."""
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))
    model = language_id.train(docs.filter(~held_out))
    found = language_id.identify(docs.select("doc_id", "text"), model, out="language")
    return found.select("doc_id", held_out.alias("held_out"), "language.lang_pred", "language.score")


@query()
def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.line_dedup(docs, similarity=line_dedup.ALIKE).select("doc_id", "n_lines", "n_dropped", "text")


@query()
def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), WORD_TOKENIZER)


@query()
def op7_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.simhash_dedup(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


@query("""
    with p as (
        select page_id, encode(coalesce(html, '')) as payload, sha1(coalesce(html, '')) as payload_digest from pages
    ), same as (
        select *, octet_length(payload) as payload_bytes, max(page_id) over (partition by payload) as last_id from p
    )
    select page_id, payload_bytes, payload_digest,
           case when payload_bytes >= 1000 and page_id <> last_id then 'revisit' else 'response' end as record_type,
           case when payload_bytes >= 1000 and page_id <> last_id then last_id end as refers_to
    from same""")
def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An archive of all pages, written and read back."""
    path = new_table_path(spark, "archive")
    warc.write_archive(table(spark, sf_dir, "pages"), path)
    return warc.read_archive(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query()
def op9_perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents by their perplexity; ``kept`` also asks for the limit of letters that share a symbol."""
    light_batches(spark)
    trusted = perplexity.trusted_ids(table(spark, sf_dir, "labels"))
    judged = perplexity.quality_by_perplexity(table(spark, sf_dir, "documents"), trusted)
    return judged.select("doc_id", "perplexity", "most", "kept")


@query()
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = divergence.judge(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"), out="quality")
    names = (*divergence.COUNTS, "base_failed", "kept", "class_distance", "word_distance")
    return found.select("doc_id", *(F.col("quality")[n].alias(n) for n in names))


@query("""
    with v as (
        select vec_id, embedding as e from embeddings
        where len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
          and len(list_filter(embedding, lambda x: x <> 0)) > 0
    ), links as materialized (
        select a.vec_id as a, b.vec_id as b from v a join v b
            on a.vec_id <> b.vec_id and len(a.e) = len(b.e)
               and list_cosine_similarity(cast(a.e as double[]), cast(b.e as double[])) >= 0.9
    ), reached as (
        with recursive r(a, b) as (select a, b from links union select r.a, l.b from r join links l on l.a = r.b) select a, min(b) as b from r group by a
    )
    select vec_id, coalesce(n, 0) as n_links, least(vec_id, coalesce(b, vec_id)) as component_id, vec_id <= coalesce(b, vec_id) as kept
    from embeddings left join (select a as vec_id, count(*) as n from links group by a) using (vec_id)
        left join (select a as vec_id, b from reached) using (vec_id)""")
def op11_cosine_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cosine_links.cosine_links(table(spark, sf_dir, "embeddings"))


def _lloyd_sql(k: int = 16, rounds: int = 3) -> str:
    """The rounds of centroid clustering, one after the other."""
    steps = [f"""
    with x as materialized (
        select vec_id, cast(unnest(range(64)) as integer) as i,
               cast(floor(64 * cast(unnest(embedding) as double)) as hugeint) as v
        from embeddings
        where len(embedding) = 64 and len(list_filter(embedding, lambda e: e is not null and isfinite(e))) = 64
    ), ids as (
        select vec_id, row_number() over (order by sha256('1:' || vec_id)) - 1 as c from (select distinct vec_id from x)
    ), c0 as materialized (select c, i, v from x join ids using (vec_id) where c < {k})"""]
    for n in range(rounds + 1):
        steps.append(f"""a{n} as materialized (
        select vec_id, c, d from (
            select x.vec_id, o.c, sum((x.v - o.v) * (x.v - o.v)) as d from x join c{n} o using (i) group by x.vec_id, o.c
        ) qualify row_number() over (partition by vec_id order by d, c) = 1
    )""")
        if n < rounds:
            steps.append(f"""m{n} as (
        select c, i, sum(v) as s, count(*) as n from x join a{n} using (vec_id) group by c, i
    ), c{n + 1} as materialized (
        select o.c, o.i, case when n is null then o.v else cast((s - ((s % n) + n) % n) // n as hugeint) end as v
        from c{n} o left join m{n} m on m.c = o.c and m.i = o.i
    )""")
    return ", ".join(steps) + f"""
    select vec_id, cast(c as integer) as cluster, cast(d as bigint) as distance,
           cast(sum(d) over (partition by c) as bigint) as cluster_inertia, cast(sum(d) over () as bigint) as inertia, centroid_sha256
    from a{rounds} join (
        select c, sha256(string_agg(cast(v as varchar), ',' order by i)) as centroid_sha256 from c{rounds} group by c
    ) using (c)"""


@query(_lloyd_sql())
def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(table(spark, sf_dir, "embeddings"))


@query("""
    with pieces as (
        select lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) as piece from (
            select coalesce(lang, 'und') as lang,
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as text
            from documents
        )
    ), words as materialized (
        select lang, w from (
            select lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda e: e <> '') as w from pieces
        ) where len(w) > 0
    ), total as (
        select lang, cast(sum(len(w)) as bigint) as n from words group by lang
    ), grams as materialized (
        select lang, size, phrase, count(*) as f from (
            select lang, 1 as size, unnest(w) as phrase from words
            union all
            select lang, 2, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) from words
            union all
            select lang, 3, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) from words
        ) group by lang, size, phrase
    ), candidates as materialized (
        select lang, phrase, f as a, string_split(phrase, ' ') as w from grams where size > 1 and f >= 10
    ), cuts as (
        select lang, phrase, a, 1 as k, w[1] as left_part, array_to_string(w[2:], ' ') as right_part from candidates
        union all
        select lang, phrase, a, 2, w[1] || ' ' || w[2], w[3] from candidates where len(w) = 3
    ), scores as (
        select c.lang, c.phrase, c.a, k, l.f as l, r.f as r,
               (cast(1000000 as hugeint) * c.a * c.a) // (cast(l.f as hugeint) * r.f) as score
        from cuts c join grams l on l.lang = c.lang and l.phrase = left_part join grams r on r.lang = c.lang and r.phrase = right_part
        qualify row_number() over (partition by c.lang, c.phrase order by score, k) = 1
    ), inside as (
        select lang, phrase, max(a) as around from (
            select lang, w[1] || ' ' || w[2] as phrase, a from candidates where len(w) = 3
            union all
            select lang, w[2] || ' ' || w[3], a from candidates where len(w) = 3
        ) group by lang, phrase
    )
    select s.lang, row_number() over (partition by s.lang order by score desc, s.a desc, s.phrase) as rank,
           s.phrase, s.a, s.l, s.r, n, cast(score as bigint) as score
    from scores s join total using (lang) left join inside i on i.lang = s.lang and i.phrase = s.phrase
    where around is null or 100 * around < 50 * s.a
    qualify rank <= 2000""")
def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))
