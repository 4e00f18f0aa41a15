"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framegrid.llm import (
    byte_bpe, common, decontaminate, fill_in_middle, html_extract, language_id, lm_scoring, mixing, near_dups, quality, sharding, substring_dedup,
    token_alignment, url_filters,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    common.tune(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_compression_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(_table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "quality.*")


def _held_out(modulus: int, remainder: int):
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % modulus == remainder


def op2_segment_unigrams(spark: SparkSession, sf_dir: str, vocabulary: str = language_id.VOCABULARY) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").withColumn("held_out", _held_out(3, 1))
    model = language_id.learn(docs.where("not held_out"), vocabulary=vocabulary)
    found = language_id.identify(docs.select("doc_id", "held_out", "text"), model)
    return found.select("doc_id", "held_out", F.col("language.lang").alias("lang_pred"), "language.score")


def op3_karmarkar_karp(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shards(_table(spark, sf_dir, "documents"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("long"), F.lit(None).cast("int").alias("grown_shard")
    )


def op4_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").withColumn("held_out", _held_out(7, 2))
    return lm_scoring.scores(docs)


def op5_fair_queueing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("times")).cast("long").alias("taken"))


OP5_SQL = f"""
with sized as (
  select doc_id, coalesce('s' || source, 't') as name, md5('{mixing.SEED}:' || coalesce(cast(doc_id as varchar), '')) as spot,
         case when text is null then 0 else len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) end as size
  from documents),
total as (
  select name, cast(sum(size) as bigint) as source_size, row_number() over (order by name) - 1 as rank from sized group by name),
weighed as (select *, case rank % 3 when 0 then 5 when 1 then 2 else 1 end as weight from total),
filled as (
  select *, (select sum(source_size) from total) - coalesce(sum(3 * source_size) over before, 0) as left_over,
         (select sum(weight) from weighed) - coalesce(sum(weight) over before, 0) as weight_over
  from weighed window before as (order by 3 * source_size / weight, rank rows between unbounded preceding and 1 preceding)),
capped as (
  select *, not bool_or(3 * source_size * weight_over > weight * left_over) over (order by 3 * source_size / weight, rank) as is_capped from filled),
share as (
  select cast(arg_min(left_over, rank_in) as double) / cast(arg_min(weight_over, rank_in) as double) as share
  from (select *, row_number() over (order by 3 * source_size / weight, rank) as rank_in from capped) where not is_capped),
goal as (
  select name, source_size, case when is_capped then cast(3 * source_size as double) else weight * (select share from share) end as target from capped),
queued as (
  select doc_id, size, source_size, target,
         sum(size) over (partition by name order by spot, doc_id, size rows between unbounded preceding and current row) as upto
  from sized join goal using (name)),
sent as (
  select doc_id, size, cast(upto + e * source_size as double) / target as finish
  from queued, (select unnest([0, 1, 2]) as e) where target > 0),
grouped as (select finish, sum(size) as size from sent group by finish),
running as (select finish, sum(size) over (order by finish rows between unbounded preceding and current row) as upto from grouped),
cut as (select max(finish) as cut from running where upto <= (select sum(size) from sized))
select doc_id, size, source_size, target,
       cast(case when target > 0 then size * (
         (case when cast(upto as double) / target <= (select cut from cut) then 1 else 0 end)
         + (case when cast(upto + source_size as double) / target <= (select cut from cut) then 1 else 0 end)
         + (case when cast(upto + 2 * source_size as double) / target <= (select cut from cut) then 1 else 0 end)) else 0 end as bigint) as taken
from queued"""


def op6_suffix_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    removed = substring_dedup.removals(_table(spark, sf_dir, "documents"))
    return removed.select("doc_id", "n_words", "n_removed", "kept_sha256")


OP6_SQL = """
with texts as (select doc_id, coalesce(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'), []) as words from documents),
windows as (
  select doc_id, i, sha256(array_to_string(words[i : i + 49], ' ')) as w
  from (select doc_id, words, unnest(range(1, len(words) - 48)) as i from texts where len(words) >= 50)),
first as (select w, min(doc_id) as first_id from windows group by w),
hit as (select doc_id, i from windows join first using (w) where first_id < doc_id),
gone as (select doc_id, list(distinct k) as gone from (select doc_id, unnest(range(i, i + 50)) as k from hit) group by doc_id),
kept as (
  select t.doc_id, words, coalesce(gone, []) as gone from texts t left join gone g on g.doc_id = t.doc_id)
select doc_id, cast(len(words) as bigint) as n_words, cast(len(gone) as bigint) as n_removed,
       sha256(coalesce((select string_agg(word, ' ' order by k) from (select unnest(words) as word, unnest(range(1, len(words) + 1)) as k)
                        where not list_contains(gone, k)), '')) as kept_sha256
from kept"""


#: The rules of the contract.
URL_RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
#: Labels of the listed domains, each under all suffixes.
LISTED_LABELS = (
    "ad-server ads-track adult-x banner-farm bet-now casino-win cheap-pills click-bait coupon-spam crypto-double free-bets free-money "
    "link-farm malware-drop phish-login pop-under scam-shop spam-farm tracker-pixel warez-zone"
).split()
LISTED_SUFFIXES = ["biz", "com", "example.com", "example.net", "example.org", "info", "net", "org"]
LISTED = [f"{label}.{suffix}" for label in LISTED_LABELS for suffix in LISTED_SUFFIXES]


def op7_url_filter(spark: SparkSession, sf_dir: str, listed_table: str | None = None) -> DataFrame:
    """``listed_table`` is the path of a table with the listed domains as ``key``; without one, ``LISTED`` are."""
    listed = spark.read.parquet(listed_table).select("key") if listed_table else spark.createDataFrame([(x,) for x in LISTED], "key string")
    return url_filters.judge(_table(spark, sf_dir, "pages"), listed, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def _op7_sql() -> str:
    listed = ", ".join(f"'{x}'" for x in LISTED)
    fits = lambda host, path: f"(host = '{host}' or ends_with(host, '.{host}')) and starts_with(path, '{path}')"
    rules = sorted(URL_RULES, key=lambda r: -len(r[1] + r[2]))
    rule = " ".join(f"when {fits(h, p)} then '{h}{p}'" for _, h, p in rules)
    say = " ".join(f"when {fits(h, p)} then '{v}'" for v, h, p in rules)
    return f"""
with rest as (select page_id, case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as rest from pages),
hosts as (select page_id, rest, regexp_extract(rest, '^[^/?#]*') as raw from rest),
split as (select page_id, translate(raw, '{url_filters.UPPER}', '{url_filters.LOWER}') as host,
                 regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') as path from hosts)
select page_id, host, path, case {rule} else null end as rule,
       case {say} when exists (select 1 from (select unnest([{listed}]) as d) where host = d or ends_with(host, '.' || d))
            then 'block' else 'allow' end as verdict
from split"""


def op8_dart_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dups.classes(_table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links")


def op9_scoring_subsequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = html_extract.extract(_table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return pages.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op10_qgram_lemma(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    leak = decontaminate.flag(docs, _table(spark, sf_dir, "benchmark"))
    return leak.select("doc_id", (F.size("leak.items") > 0).alias("contaminated"), F.col("leak.items").alias("item_ids"), F.col("leak.edits").alias("edits"))


def op11_run_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = fill_in_middle.transform(_table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "fim.*")
    back = fill_in_middle.restored(F.col("form"), F.col("output"))
    return cut.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(back, 256).alias("restored_sha256")
    )


OP11_SQL = """
with drawn as (select doc_id, coalesce(text, '') as t, length(coalesce(text, '')) as n, sha256('1:' || coalesce(cast(doc_id as varchar), '')) as d from documents),
numbers as (
  select doc_id, t, n, cast('0x' || substr(d, 1, 8) as bigint) % (n + 1) as x, cast('0x' || substr(d, 9, 8) as bigint) % (n + 1) as y,
         cast('0x' || substr(d, 17, 8) as bigint) % 100 as c, cast('0x' || substr(d, 25, 8) as bigint) % 100 as f from drawn),
formed as (
  select *, least(x, y) as a, greatest(x, y) as b,
         case when n = 0 or c >= 90 or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') then 'plain' when f < 20 then 'spm' else 'psm' end as form
  from numbers),
parts as (select *, substr(t, 1, a) as prefix, substr(t, a + 1, b - a) as middle, substr(t, b + 1) as suffix from formed)
select doc_id, n, form, case when form <> 'plain' then a end as prefix_chars, case when form <> 'plain' then b - a end as middle_chars,
       sha256(case form when 'plain' then t when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end) as output_sha256,
       sha256(t) as restored_sha256
from parts"""

#: Places of the public tokenizers' files; parameters of the queries.
TOKENIZERS = "/opt/tokenizers"
#: The pattern by which the public byte-level vocabularies split texts; a fixed value.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def op12_elementary_intervals(spark: SparkSession, sf_dir: str, tokenizers: str = TOKENIZERS) -> DataFrame:
    a = token_alignment.ByteLevel.read(f"{tokenizers}/byte_bpe_50k.json", PATTERN)
    b = token_alignment.Pieces.read(f"{tokenizers}/piece_bpe_32k.model")
    return token_alignment.links(_table(spark, sf_dir, "documents"), a, b)


def op13_two_tier_bpe(spark: SparkSession, sf_dir: str, tokenizers: str = TOKENIZERS) -> DataFrame:
    model = byte_bpe.read_vocabulary(f"{tokenizers}/byte_bpe_multi_50k.tiktoken", PATTERN)
    encoded = byte_bpe.encode(_table(spark, sf_dir, "documents").select("doc_id", "text"), model, packed=True).drop("text")
    return byte_bpe.decode(encoded, model).select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        op1_compression_bands, op2_segment_unigrams, op3_karmarkar_karp, op4_context_mixing, op5_fair_queueing, op6_suffix_trees, op7_url_filter,
        op8_dart_minhash, op9_scoring_subsequence, op10_qgram_lemma, op11_run_lengths, op12_elementary_intervals, op13_two_tier_bpe,
    )
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {"op5_fair_queueing": OP5_SQL, "op6_suffix_trees": OP6_SQL, "op7_url_filter": _op7_sql(), "op11_run_lengths": OP11_SQL}
