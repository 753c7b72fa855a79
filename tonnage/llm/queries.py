"""The registered queries of this package: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tonnage.llm.decontaminate import find_leaks
from tonnage.llm.lexical import ranked_search
from tonnage.llm.licences import scan_licences
from tonnage.llm.minhash import near_duplicates
from tonnage.llm.mixing import mixture
from tonnage.llm.negatives import mine_negatives
from tonnage.llm.quality import judge_quality, train
from tonnage.llm.secret_scan import scan_secrets
from tonnage.llm.ship import workers_find_library
from tonnage.llm.substring import remove_repeats
from tonnage.llm.tokens import read_documents, write_tokens
from tonnage.llm.topk import top_k
from tonnage.llm.toxicity import learn, score_toxicity
from tonnage.llm.url_filter import SITE_RULES, WORD_RULES, judge_urls, rule_table

TOKENIZER = "byte_bpe_50k.json"
END_OF_TEXT = 2

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function of a session and a folder of tables under name."""

    def register(build: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            workers_find_library(spark)
            return build(spark, folder)

        QUERIES[name] = run
        if sql:
            SQL[name] = sql
        return run

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query(
    "op2_substring_dedup",
    r"""
    with texts as (
      select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words from documents
    ), windows as (
      select doc_id, place, array_to_string(words[place:place + 12], ' ') as content
      from (select doc_id, words, unnest(range(1, len(words) - 11)) as place from texts)
    ), first as (
      select content, min(doc_id) as least from windows group by content
    ), gone as (
      select distinct w.doc_id, unnest(range(w.place, w.place + 13)) as place
      from windows w join first f on w.content = f.content where f.least < w.doc_id
    ), single as (
      select doc_id, unnest(words) as word, generate_subscripts(words, 1) as place from texts
    ), kept as (
      select s.doc_id, count(g.place) as n_removed,
        coalesce(string_agg(s.word, ' ' order by s.place) filter (where g.place is null), '') as kept
      from single s left join gone g on s.doc_id = g.doc_id and s.place = g.place
      group by s.doc_id
    )
    select t.doc_id, cast(len(t.words) as bigint) as n_words,
      cast(coalesce(k.n_removed, 0) as bigint) as n_removed, sha256(coalesce(k.kept, '')) as kept_sha256
    from texts t left join kept k on t.doc_id = k.doc_id
    """,
)
def op2(spark: SparkSession, folder: str) -> DataFrame:
    return remove_repeats(table(spark, folder, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )


@query(
    "op5_minhash_near_dedup",
    r"""
    with recursive texts as (
      select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') as words from documents
    ), shingles as (
      select distinct doc_id, array_to_string(words[place:place + 4], ' ') as shingle
      from (select doc_id, words, unnest(range(1, greatest(len(words) - 3, least(len(words) + 1, 2)))) as place from texts)
    ), sizes as (
      select t.doc_id, count(s.shingle) as n from texts t left join shingles s on t.doc_id = s.doc_id group by t.doc_id
    ), common as (
      select a.doc_id as a, b.doc_id as b, count(*) as n
      from shingles a join shingles b on a.shingle = b.shingle and a.doc_id < b.doc_id group by 1, 2
    ), links as (
      select c.a, c.b from common c join sizes x on c.a = x.doc_id join sizes y on c.b = y.doc_id
      where 100 * c.n >= 75 * (x.n + y.n - c.n)
    ), edges as (
      select a, b from links union all select b, a from links
    ), reach as (
      select doc_id as a, doc_id as b from documents
      union
      select r.a, e.b from reach r join edges e on r.b = e.a
    ), label as (
      select a as doc_id, min(b) as component_id from reach group by a
    )
    select s.doc_id, cast(s.n as bigint) as n_shingles, l.component_id, s.doc_id = l.component_id as kept
    from sizes s join label l on s.doc_id = l.doc_id
    """,
)
def op5(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents"))


@query(
    "op1_url_filters",
    r"""
    with parts as (
      select page_id, translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
        regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) as path
      from pages
    ), rules(of_host, of_path, verdict) as (
      values ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
        ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
    ), judged as (
      select p.page_id, p.host, p.path, arg_max(r.of_host || r.of_path, length(r.of_host || r.of_path)) as rule,
        arg_max(r.verdict, length(r.of_host || r.of_path)) as of_rule
      from parts p left join rules r
        on (p.host = r.of_host or ends_with(p.host, '.' || r.of_host)) and starts_with(p.path, r.of_path)
      group by p.page_id, p.host, p.path
    )
    select page_id, host, path, rule, coalesce(of_rule, case when list_has_any(regexp_split_to_array(host, '[^a-z0-9]'),
      ['bet', 'betting', 'bets', 'casino', 'escort', 'gambling', 'jackpot', 'loan', 'loans', 'lottery', 'pharmacy', 'pill', 'pills', 'poker',
       'porn', 'sex', 'slots', 'torrent', 'viagra', 'warez', 'xxx']) then 'block' else 'allow' end) as verdict
    from judged
    """,
)
def op1(spark: SparkSession, folder: str) -> DataFrame:
    rules = rule_table(spark, SITE_RULES + WORD_RULES)
    judged = judge_urls(table(spark, folder, "pages").select("page_id", "url"), rules)
    return judged.select("page_id", "host", "path", "rule", "verdict")


@query(
    "op10_mixing",
    r"""
    with sized as (
      select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as size from documents
    ), totals as (
      select source, sum(size) as source_size, row_number() over (order by source nulls last) - 1 as number from sized group by source
    ), placed as (
      select *, [5, 2, 1][number % 3 + 1] as weight, 2 * source_size / [5, 2, 1][number % 3 + 1] as per_weight from totals
    ), levels as (
      select *, (sum(source_size) over () * 1.5 - coalesce(sum(2 * source_size) over before, 0))
        / (sum(weight) over () - coalesce(sum(weight) over before, 0)) as level
      from placed window before as (order by per_weight, number rows between unbounded preceding and 1 preceding)
    ), goals as (
      select source, source_size, round(least((max(level) over ()) * weight, 2 * source_size), 6) as target from levels
    ), lined as (
      select s.doc_id, s.size, cast(g.source_size as bigint) as source_size, g.target,
        case when g.source_size > 0 then g.target / g.source_size else 0 end as rate,
        cast(('0x' || substr(md5('mix-1:' || coalesce(s.source, '')), 1, 8)) as bigint) / 4294967296.0 as start, s.source,
        row_number() over (partition by s.source order by s.size, s.doc_id) as place
      from sized s join goals g on s.source is not distinct from g.source
    ), moved as (
      select l.*, t.turn, l.start + t.turn / 16.0 - floor(l.start + t.turn / 16.0) as moved
      from lined l, (select unnest(range(16)) as turn) t
    ), counted as (
      select *, cast(size * (floor(place * rate + moved) - floor((place - 1) * rate + moved)) as bigint) as taken from moved
    ), best as (
      select source, arg_min(turn, (error, turn)) as turn
      from (select source, turn, abs(sum(taken) - first(target)) as error from counted group by source, turn) group by source
    )
    select doc_id, cast(size as bigint) as size, source_size, target, taken
    from counted c join best b on c.source is not distinct from b.source and c.turn = b.turn
    """,
)
def op10(spark: SparkSession, folder: str) -> DataFrame:
    return mixture(table(spark, folder, "documents")).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken")
    )


@query("op3_token_output")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    shards = write_tokens(table(spark, folder, "documents"), public_tokenizers.path(TOKENIZER), END_OF_TEXT)
    return read_documents(spark, shards)


@query("op4_quality_rules")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    judged = judge_quality(docs, train(docs, table(spark, folder, "labels")))
    return judged.drop("text")


@query("op6_toxicity")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return score_toxicity(docs, learn(docs, table(spark, folder, "labels")))


@query("op9_benchmark_decontamination")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    return find_leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op7_license_scans")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    return scan_licences(table(spark, folder, "documents")).drop("spans")


@query("op8_secret_scans")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    return scan_secrets(table(spark, folder, "documents"))


@query(
    "op11_ranked_search",
    r"""
    with places as (
      select d.rowid as place, d.doc_id, unnest(regexp_extract_all(translate(d.text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
      from (select row_number() over () as rowid, doc_id, text from documents) d
    ), sizes as (
      select place, doc_id, count(*) as n from places group by place, doc_id
    ), whole as (
      select cast(count(*) as bigint) as documents, cast(sum(n) as bigint) as occurrences from sizes
    ), asked as (
      select distinct item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
      from benchmark
    ), held as (
      select place, term, count(*) as tf from places where term in (select term from asked) group by place, term
    ), weights as (
      select term, cast(floor(1000 * ln((2.0::double * max(documents) + 2) / (2 * count(*) + 1))) as bigint) as weight
      from held, whole group by term
    ), scores as (
      select a.item_id, h.place, s.doc_id,
        sum(w.weight * ((1000000000 * h.tf) // (1000 * h.tf + 8 * (10 + (90 * s.n * documents) // occurrences)))) as score
      from asked a join weights w on a.term = w.term join held h on a.term = h.term
        join sizes s on h.place = s.place, whole
      group by a.item_id, h.place, s.doc_id
    )
    select item_id, cast(row_number() over (partition by item_id order by score desc, doc_id) as integer) as rank, doc_id, cast(score as bigint) as score
    from scores where score > 0
    qualify row_number() over (partition by item_id order by score desc, doc_id) <= 10
    """,
)
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return ranked_search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query(
    "op12_exact_top_k",
    """
    with rows as (
      select vec_id, list_transform(embedding, lambda x: floor(1024 * cast(x as double))) as x from embeddings
      where embedding is not null
        and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0
    ), scored as (
      select q.vec_id as query_id, r.vec_id, cast(list_inner_product(q.x, r.x) as bigint) as score
      from rows q join rows r on q.vec_id % 100 = 0 and q.vec_id <> r.vec_id
    )
    select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank, vec_id, score
    from scored qualify row_number() over (partition by query_id order by score desc, vec_id) <= 10
    """,
)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return top_k(table(spark, folder, "embeddings"))


@query(
    "op13_hard_negatives",
    """
    with rows as (
      select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
        list_transform(embedding, lambda x: floor(256 * cast(x as double))) as x from embeddings
      where label is not null and embedding is not null
        and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0
    ), scored as (
      select a.vec_id as anchor_id, r.vec_id, a.label = r.label as same, cast(list_inner_product(a.x, r.x) as bigint) as score
      from rows a join rows r on a.vec_id % 50 = 0 and a.vec_id <> r.vec_id
    ), positives as (
      select anchor_id, vec_id as positive_id, score as positive_score from scored where same
      qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5
    ), negatives as (
      select p.*, s.vec_id as negative_id, s.score as negative_score,
        cast(row_number() over (partition by p.anchor_id, positive_id order by s.score desc, s.vec_id) as integer) as rank
      from positives p join scored s on p.anchor_id = s.anchor_id and not s.same
        and 50 * positive_score <= 100 * s.score and 100 * s.score <= 95 * positive_score
    )
    select anchor_id, positive_id, rank, negative_id, positive_score, negative_score from negatives where rank <= 3
    """,
)
def op13(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine_negatives(vectors.withColumn("label", moved))
