"""The registered queries ``opN_<name>``: each applies an operator to a whole table and returns its digest."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    chunk_bpe, harmonic_packing, language_id, line_dedup, near_dups, packing, page_text, quality, sharding, source_audit,
    vector_codes, vector_search, warc,
)
from .common import byte_tokenizer_file, table, tokenizer_file

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        @wraps(fn)
        def on_utc(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            spark.conf.set("spark.sql.caseSensitive", "false")
            return fn(spark, sf_dir)

        QUERIES[fn.__name__] = on_utc
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return on_utc

    return register


@query(r"""
with d as (select doc_id, lang, coalesce(text, '') as t from documents),
w as (
    select *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') as ws,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as ls
    from d),
windows as (select doc_id, unnest(generate_series(1, len(ws) - 2)) as i, ws from w),
tripled as (select doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] as tri from windows),
again as (select doc_id, i from (select *, count(*) over (partition by doc_id, tri) as c from tripled) where c > 1),
covered as (
    select doc_id, count(distinct p) as n_repeat from (select doc_id, unnest([i, i + 1, i + 2]) as p from again) group by 1),
base as (
    select doc_id, lang, len(ws) as n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) as word_chars,
        length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) as n_symbols, len(ls) - len(list_distinct(ls)) as n_dup_lines,
        coalesce(n_repeat, 0) as n_repeat_words, length(t) as chars, strlen(t) - length(t) as wide,
        length(t) - length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) as blank,
        length(t) - length(regexp_replace(t, '[a-z]', '', 'g')) as low, length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) as up,
        length(t) - length(regexp_replace(t, '[0-9]', '', 'g')) as digit,
        length(t) - length(regexp_replace(t, '[.,;:!?''"()-]', '', 'g')) as mark
    from w left join covered using (doc_id)),
shares as (
    select doc_id, unnest(['blank', 'low', 'up', 'digit', 'mark', 'other', 'wide']) as class,
        unnest([blank, low, up, digit, mark, chars - blank - low - up - digit - mark, wide]) as n from base),
classes as (select doc_id, class, n, sum(n) over (partition by doc_id) as total from shares),
class_refs as (
    select lang, class, sum(n) as n, sum(sum(n)) over (partition by lang) as total
    from shares join d using (doc_id) where lang is not null group by 1, 2),
short as (
    select doc_id, lang, translate(rtrim(x, '.,;:!?'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as word
    from (select doc_id, lang, unnest(ws) as x from w) where length(x) <= 6 and length(rtrim(x, '.,;:!?')) between 1 and 5),
lengths as (select lang, sum(n_words) as r_words from base where lang is not null group by 1),
word_refs as (
    select lang, word, c / r_words::double as q
    from (select lang, word, count(*) as c, row_number() over (partition by lang order by count(*) desc, word) as rn
        from short where lang is not null group by 1, 2) join lengths using (lang) where rn <= 50),
common as (select lang, coalesce(sum(q), 0) as q_common from lengths left join word_refs using (lang) group by 1),
held as (select doc_id, word, count(*) as c from short group by 1, 2),
met as (
    select doc_id, r.lang, sum(c) as c,
        sum((c / n_words::double * log2(2 * c / n_words / (c / n_words::double + q)) + q * log2(2 * q / (c / n_words::double + q)) - q) / 2) as d
    from held join base using (doc_id) join word_refs r using (word) group by 1, 2),
word_ends as (
    select b.doc_id, k.lang, coalesce(d, 0) + q_common / 2 as d, 1 - coalesce(c, 0) / n_words::double as p, 1 - q_common as q
    from base b cross join common k left join met m on m.doc_id = b.doc_id and m.lang = k.lang where n_words > 0),
by_word as (
    select doc_id, lang, sqrt(greatest(0, d + case when p > 0 then p * log2(2 * p / (p + q)) / 2 else 0 end
        + case when q > 0 then q * log2(2 * q / (p + q)) / 2 else 0 end)) as word_distance from word_ends),
by_class as (
    select doc_id, r.lang, sqrt(greatest(0, sum(
        case when c.n > 0 then c.n / c.total::double * log2(2 * (c.n / c.total::double) / (c.n / c.total::double + r.n / r.total::double)) / 2 else 0 end
        + case when r.n > 0 then r.n / r.total::double * log2(2 * (r.n / r.total::double) / (c.n / c.total::double + r.n / r.total::double)) / 2 else 0 end
        ))) as class_distance
    from classes c join class_refs r using (class) where c.total > 0 group by 1, 2),
nearest as (
    select doc_id, min({'w': word_distance, 'c': class_distance, 'l': lang}) as near
    from by_word join by_class using (doc_id, lang) group by 1),
judged as (
    select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from base left join nearest using (doc_id))
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    not base_failed and not coalesce(near.c > 0.15 + 1.0 / sqrt(n_words) or near.w > 0.22 + 1.75 / sqrt(n_words), false) as kept,
    near.l as nearest_lang
from judged
""")
def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.verdicts(table(spark, sf_dir, "documents"))
    return judged.select(
        F.col("_id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        "kept", "nearest_lang", F.explode(F.sequence(F.lit(1).cast("long"), "_times")).alias("_copy"),
    ).drop("_copy")


@query(r"""
with valid as (
    select vec_id, list_transform(embedding, lambda x: floor(x::double * 1024)::bigint) as v
    from embeddings
    where embedding is not null and len(embedding) > 0
        and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
    select q.vec_id as query_id, c.vec_id,
        list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::bigint as score
    from valid q join valid c on q.vec_id <> c.vec_id and len(q.v) = len(c.v)
    where q.vec_id % 100 = 0),
ranked as (
    select query_id, vec_id, score, row_number() over (partition by query_id order by score desc, vec_id)::int as rank
    from scored)
select query_id, rank, vec_id, score from ranked where rank <= 10
""")
def op2_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_search.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


@query(r"""
with payloads as (select page_id, coalesce(html, '') as payload from pages),
hashed as (select page_id, payload, sha1(payload) as hex, max(page_id) over (partition by payload) as last from payloads),
digits as (
    select *, list_transform(generate_series(0, 7), lambda i: ('0x' || substr(hex, (5 * i + 1)::int, 5))::int) as twenty
    from hashed)
select page_id, strlen(payload) as payload_bytes,
    list_aggregate(list_transform(generate_series(0, 31), lambda i:
        substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (((twenty[(i // 4 + 1)::int] >> (15 - 5 * (i % 4))::int) & 31) + 1)::int, 1)),
        'string_agg', '') as payload_digest,
    case when page_id = last then 'response' else 'revisit' end as record_type,
    case when page_id = last then null else last end as refers_to
from digits
""")
def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"), min_bytes=0)


@query()
def op8_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dups.near_duplicates(table(spark, sf_dir, "documents"), n=4, percent=80)


@query()
def op4_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_text.extract(table(spark, sf_dir, "pages"))


@query()
def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_file(), 4096, with_ids=False)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@query()
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return language_id.identify(docs).select(
        "doc_id", language_id.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score"
    )


@query()
def op7_chunk_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_bpe.encode_documents(table(spark, sf_dir, "documents"), tokenizer_file(), with_ids=False)


@query(r"""
with lines as (
    select doc_id, pos, lines[pos] as line,
        translate(trim(lines[pos], chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
    from (
        select doc_id, string_split(coalesce(text, ''), chr(10)) as lines,
            unnest(generate_series(1, len(string_split(coalesce(text, ''), chr(10))))) as pos
        from documents)),
shared as (select key from lines where length(key) >= 1 group by key having count(distinct doc_id) >= 10),
marked as (select l.doc_id, l.pos, l.line, s.key is not null as gone from lines l left join shared s on l.key = s.key)
select doc_id, count(*) as n_lines, count(*) filter (gone) as n_dropped,
    sha256(coalesce(string_agg(line, chr(10) order by pos) filter (not gone), '')) as kept_sha256
from marked group by doc_id
""")
def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.drop_common_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), min_docs=10, min_chars=1)
    return kept.select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256")
    )


@query()
def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    dealt = sharding.shard_by_bytes(table(spark, sf_dir, "documents"), shards=8)
    return dealt.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@query(r"""
with d as (
    select row_number() over () as row, coalesce(lang, '') as lang, coalesce(source, '') as source, coalesce(text, '') as t
    from documents),
w as (
    select row, lang, source, unnest(regexp_extract_all(
        translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as term
    from d),
kept as (select lang, term from w group by 1, 2 having count(distinct row) >= 10),
counted as (select lang, source, term, count(*) as c from w join kept using (lang, term) group by 1, 2, 3),
of_term as (select lang, term, sum(c) as c from counted group by 1, 2),
langs as (select lang, count(*) as v, sum(c) as n from of_term group by 1),
groups as (select lang, source, coalesce(sum(c), 0) as n from (select distinct lang, source from d) left join counted using (lang, source) group by 1, 2),
chances as (
    select g.lang, g.source, k.term, coalesce(c.c, 0) as c, 1 + 1000000000::hugeint * (coalesce(c.c, 0) + 2) // (g.n + 2 * v) as p,
        1 + 1000000000::hugeint * (k.c + 2) // (l.n + 2 * v) as q
    from groups g join of_term k using (lang) join langs l using (lang)
        left join counted c on c.lang = g.lang and c.source = g.source and c.term = k.term),
sums as (
    select a.lang, a.source, b.source as item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) as value
    from chances a join chances b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by 1, 2, 3),
parts as (
    select a.lang, a.source, 'pair' as part, b.source as item, coalesce(value, 0)::bigint as value
    from groups a join groups b on a.lang = b.lang and a.source <> b.source
        left join sums s on s.lang = a.lang and s.source = a.source and s.item = b.source
    union all
    select lang, source, 'term', term, ((p - q) * (p - q) // (p + q))::bigint from chances where c > 0 and p > q),
ranked as (select *, row_number() over (partition by lang, source, part order by value desc, item)::int as rank from parts)
select lang, source, part, item, value, rank from ranked where part = 'pair' or rank <= 10
""")
def op11_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_audit.audit(table(spark, sf_dir, "documents"), min_docs=10, top=10)


@query()
def op12_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return harmonic_packing.pack_documents(table(spark, sf_dir, "documents"), byte_tokenizer_file(), 1024, with_ids=False)


def _lloyd_sql(rounds: int) -> str:
    """Every part compared with every entry, in each round."""
    steps = [
        f"""
near{r} as materialized (
    select row, part, min({{'d': list_sum(list_transform(list_zip(x.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), 'e': e}}) as near
    from x join book{r} b using (part) group by 1, 2),
book{r + 1} as materialized (
    select b.part, b.e, coalesce(m.v, b.v) as v
    from book{r} b left join (
        select part, e, list(((s - (s % n + n) % n) // n)::bigint order by i) as v
        from (
            select part, near.e as e, i, sum(c) as s, count(*) as n
            from (select part, near, unnest(v) as c, generate_subscripts(v, 1) as i from near{r} join x using (row, part))
            group by 1, 2, 3)
        group by 1, 2) m using (part, e))"""
        for r in range(rounds + 1)
    ]
    return f"""
with kept as materialized (
    select row_number() over (order by vec_id, embedding) as row, vec_id, label,
        list_transform(embedding, lambda c: floor(c::double * 4096)::bigint) as v
    from embeddings
    where embedding is not null and len(embedding) > 0 and len(list_filter(embedding, lambda c: c is null or not isfinite(c))) = 0),
x as materialized (
    select row, part, v[(part * len(v) // 8 + 1):((part + 1) * len(v) // 8)] as v from kept, range(8) as parts(part)),
book0 as materialized (select part, row - 1 as e, v from x where row <= 16),
{",".join(steps)},
coded as (
    select row, string_agg(printf('%02x', near.e), '' order by part) as code, sum(near.d)::bigint as error
    from near{rounds} group by 1),
books as (
    select sha256(string_agg(c::varchar, ',' order by part, e, i)) as codebooks_sha256
    from (select part, e, unnest(v) as c, generate_subscripts(v, 1) as i from book{rounds}))
select vec_id, code, error, (sum(error) over (partition by label))::bigint as label_error, codebooks_sha256
from kept join coded using (row), books
"""


@query(_lloyd_sql(vector_codes.ROUNDS))
def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, fitted = vector_codes.compress(table(spark, sf_dir, "embeddings"))
    digest = F.lit(fitted.digest() if fitted else "")
    return coded.select("vec_id", "code", "error", "label_error", digest.alias("codebooks_sha256"))
