"""One query per operator over its whole table, and SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnstile.llm import (
    block_join,
    crf_quality,
    decontaminate,
    line_dedup,
    packing,
    periodic_runs,
    quality_rules,
    rtree_negatives,
    secret_scan,
    simhash,
    token_orc,
    warc,
    wordpiece_counts,
)
from turnstile.llm.common import shared_path, table


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_warc_segments(spark: SparkSession, d: str) -> DataFrame:
    path = shared_path(spark, "warc")
    warc.write_archives(table(spark, d, "pages"), path)
    back = warc.read_archives(spark, path, with_payload=False)
    return back.select(
        warc.page_number(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest",
        F.col("type").alias("record_type"), warc.page_number(F.col("refers_to")).alias("refers_to"))


def op2_wordpiece_counts(spark: SparkSession, d: str) -> DataFrame:
    return wordpiece_counts.wordpiece_counts(table(spark, d, "documents"),
                                             tokenizer_path("piece_bpe_32k.model"))


def op3_concat_and_cut(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack(table(spark, d, "documents"), tokenizer_path("word_bpe_49k.json"),
                        with_ids=False)


def op4_simhash_pigeonring(spark: SparkSession, d: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, d, "documents")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("least.doc_id").alias("component_id"))


def op5_host_rules(spark: SparkSession, d: str) -> DataFrame:
    return quality_rules.quality_report(table(spark, d, "documents"))


def op6_fuzzy_lines(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    lines = line_dedup.line_report(docs).select(
        "doc_id", "text_hash", "n_lines", F.size("dropped").cast("bigint").alias("n_dropped"),
        F.array_join(F.col("dropped").cast("array<string>"), ",").alias("dropped_lines"))
    return lines


def op7_secret_layers(spark: SparkSession, d: str) -> DataFrame:
    return secret_scan.secret_digests(table(spark, d, "documents"))


def op8_crf_quality(spark: SparkSession, d: str) -> DataFrame:
    return crf_quality.quality(table(spark, d, "documents"), table(spark, d, "labels"))


def op9_containment(spark: SparkSession, d: str) -> DataFrame:
    found = decontaminate.contaminated_items(table(spark, d, "documents"), table(spark, d, "benchmark"))
    return found.select("doc_id", "item_id", "n_shingles", "n_found")


def op10_token_orc(spark: SparkSession, d: str) -> DataFrame:
    path = shared_path(spark, "token-orc")
    token_orc.write_token_orc(table(spark, d, "documents"), path, tokenizer_path("byte_bpe_50k.json"))
    return token_orc.checksums(token_orc.read_token_orc(spark, path))


def op11_block_join(spark: SparkSession, d: str) -> DataFrame:
    vectors = table(spark, d, "embeddings")
    return block_join.nearest(vectors.where("vec_id % 20 = 0"), vectors)


def op12_periodic_runs(spark: SparkSession, d: str) -> DataFrame:
    docs = periodic_runs.with_periodic_tails(table(spark, d, "documents"))
    return periodic_runs.run_digests(periodic_runs.periodic_runs(docs))


def op13_rtree_negatives(spark: SparkSession, d: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return rtree_negatives.hard_negatives(table(spark, d, "embeddings"), F.col("id") % 100 == 0, moved)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_warc_segments, op2_wordpiece_counts, op3_concat_and_cut, op4_simhash_pigeonring,
        op5_host_rules, op6_fuzzy_lines, op7_secret_layers, op8_crf_quality, op9_containment,
        op10_token_orc, op11_block_join, op12_periodic_runs, op13_rtree_negatives)
}

_SHA1 = "sha1(coalesce(html, ''))"
# Five bits at a time of each group of ten hex digits.
_BASE32 = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', "
    f"1 + ((('0x' || substr(h, {10 * g + 1}, 10))::bigint >> {35 - 5 * i}) & 31)::int, 1)"
    for g in range(4) for i in range(8))

OP1_SQL = f"""
with p as (select page_id, coalesce(html, '') as html, {_SHA1} as h from pages),
     f as (select h, min(page_id) as first from p group by h)
select page_id, octet_length(encode(html))::bigint as payload_bytes, {_BASE32.replace("substr(h,", "substr(p.h,")} as payload_digest,
       case when page_id is not distinct from first then 'response' else 'revisit' end as record_type,
       case when page_id is distinct from first then first end as refers_to
from p join f using (h)
"""

_S = quality_rules
_MEAN = "(sum({r}) / sum(n))"
_BETWEEN = ("(sum(n * ({r} / n) * ({r} / n)) / sum(n) - {m} * {m} - {m} * (1 - {m}) * count(*) / sum(n))")


def _prior(rule: str) -> str:
    m = _MEAN.format(r=rule)
    b = _BETWEEN.format(r=rule, m=m)
    return (f"{m} as m_{rule}, case when {b} <= 0 then {_S.PRIOR_MAX} else "
            f"least(greatest({m} * (1 - {m}) / nullif({b}, 0) - 1, {_S.PRIOR_MIN}), {_S.PRIOR_MAX}) end as k_{rule}")


OP5_SQL = rf"""
with w as (
  select rowid as r, doc_id, source, coalesce(text, '') as text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words
  from (select row_number() over () as rowid, * from documents)),
grams as (
  select r, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] as g
  from (select r, words, unnest(range(1, len(words) - 1)) as i from w where len(words) >= 3)),
again as (select r, i from grams qualify count(*) over (partition by r, g) > 1),
covered as (
  select r, count(distinct i + k) as n_repeat_words
  from again, (values (0), (1), (2)) as s(k) group by r),
lines as (
  select r, count(*) as n_lines, count(*) - count(distinct line) as n_dup_lines
  from (select r, unnest(string_split(text, chr(10))) as line from w)
  where regexp_matches(line, '[^\x20\x09-\x0D]') group by r),
m as (
  select w.r, doc_id, source, len(words)::bigint as n_words,
         length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))::bigint as word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]'))::bigint as n_symbols,
         coalesce(n_dup_lines, 0)::bigint as n_dup_lines,
         coalesce(n_repeat_words, 0)::bigint as n_repeat_words, coalesce(n_lines, 0) as n_lines
  from w left join covered using (r) left join lines using (r)),
t as (
  select *, (n_words < {_S.MIN_WORDS} or 100 * n_repeat_words > {_S.MAX_REPEAT_PERCENT} * n_words) as base_failed,
         10 * n_symbols > {_S.HOST_SYMBOLS_PER_10_WORDS} * n_words as symbols_failed,
         10 * n_dup_lines > {_S.HOST_DUP_LINES_PER_10} * n_lines as lines_failed
  from m),
hosts as (
  select source, count(*)::double as n, sum(base_failed::int)::double as base,
         sum(symbols_failed::int)::double as symbols, sum(lines_failed::int)::double as lines
  from t group by source),
prior as (select {", ".join(_prior(r) for r in _S.RULES)} from hosts),
verdict as (
  select source, greatest({", ".join(f"({r} + m_{r} * k_{r}) / (n + k_{r})" for r in _S.RULES)})
         > {_S.HOST_MAX_RATE} as rejected
  from hosts, prior)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not base_failed and not rejected as kept
from t join verdict on t.source is not distinct from verdict.source
"""

_SHINGLES = rf"""(
  select distinct id, w[i:i + 4] as g from (
    select id, w, unnest(range(1, len(w) - 3)) as i from (
      select {{id}} as id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') as w from {{t}}) where len(w) >= 5))"""

OP9_SQL = f"""
with d as {_SHINGLES.format(id="doc_id", t="documents")},
     b as {_SHINGLES.format(id="item_id", t="benchmark")},
     s as (select id, count(*) as n_shingles from b group by id),
     f as (select d.id as doc_id, b.id as item_id, count(*) as n_found from d join b using (g) group by all)
select doc_id, item_id, n_shingles, n_found from f join s on s.id = item_id
where 10 * n_found >= 8 * n_shingles
"""

_USABLE = ("{x} is not null and len({x}) > 0 and "
           "len(list_filter({x}, lambda v: v is not null and isfinite(v))) = len({x})")

OP11_SQL = f"""
with v as (
  select vec_id, embedding::double[] as x from embeddings
  where vec_id is not null and {_USABLE.format(x="embedding")}
    and len(list_filter(embedding, lambda v: v <> 0)) > 0),
s as (
  select q.vec_id as query_id, c.vec_id, list_reduce(
      list_transform(range(1, len(q.x) + 1), lambda i: q.x[i] * c.x[i]), lambda a, b: a + b) as score
  from v as q join v as c on q.vec_id % 20 = 0 and q.vec_id <> c.vec_id and len(q.x) = len(c.x))
select query_id, cast(row_number() over w as integer) as rank, vec_id, score from s
window w as (partition by query_id order by score desc, vec_id)
qualify rank <= {block_join.K}
"""

OP13_SQL = f"""
with v as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
         list_transform(embedding, lambda c: floor(256 * c::double)::bigint) as x
  from embeddings
  where vec_id is not null and label is not null and {_USABLE.format(x="embedding")}),
s as (
  select a.vec_id as anchor_id, c.vec_id, a.label = c.label as same, list_reduce(
      list_transform(range(1, len(a.x) + 1), lambda i: a.x[i] * c.x[i]), lambda p, q: p + q) as score
  from v as a join v as c on a.vec_id % 100 = 0 and a.vec_id <> c.vec_id and len(a.x) = len(c.x)),
p as (
  select anchor_id, vec_id as positive_id, score as positive_score from s where same
  qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= {rtree_negatives.POSITIVES}),
n as (
  select p.*, s.vec_id as negative_id, s.score as negative_score from p join s using (anchor_id)
  where not same and {rtree_negatives.WINDOW[0]} * positive_score <= 100 * s.score
    and 100 * s.score <= {rtree_negatives.WINDOW[1]} * positive_score)
select anchor_id, positive_id, cast(row_number() over w as integer) as rank, negative_id,
       positive_score::bigint as positive_score, negative_score::bigint as negative_score
from n
window w as (partition by anchor_id, positive_id order by negative_score desc, negative_id)
qualify rank <= {rtree_negatives.NEGATIVES}
"""

ORACLE_SQL: dict[str, str] = {
    "op1_warc_segments": OP1_SQL,
    "op5_host_rules": OP5_SQL,
    "op9_containment": OP9_SQL,
    "op11_block_join": OP11_SQL,
    "op13_rtree_negatives": OP13_SQL,
}
