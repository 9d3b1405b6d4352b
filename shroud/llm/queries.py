"""The registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from . import (chat, decontaminate, langid, licenses, mixing, negatives, phrases, secrets, sharding, simhash,
               topk, toxicity, warc)
from .common import table

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"
SHARDS = 8
WORDS_SQL = (r"regexp_extract_all(translate(coalesce({c}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
             r"'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")


def bucket_of(id_col: str, n: int):
    """crc32 of the id as text, mod n."""
    return F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(n))


def op1_topk(spark: SparkSession, sf: str) -> DataFrame:
    return topk.exact_top_k(spark, table(spark, sf, "embeddings"), F.pmod("vec_id", F.lit(50)) == 0)


OP1_SQL = """
with v as (select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) q from embeddings
           where vec_id is not null and embedding is not null and len(embedding) > 0
             and list_bool_and(list_transform(embedding, lambda x: x is not null and isfinite(x)))),
s as (select a.vec_id query_id, b.vec_id, list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2]))::bigint score
      from v a join v b on a.vec_id <> b.vec_id where a.vec_id % 50 = 0),
r as (select *, row_number() over (partition by query_id order by score desc, vec_id) rank from s)
select query_id, rank::int rank, vec_id, score from r where rank <= 5"""


def old_shard():
    """The layout before: documents by source, so of very unequal sizes."""
    return F.pmod(F.xxhash64("source"), F.lit(SHARDS))


def op2_reshard(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text", "source")
    out, _ = sharding.reshard(spark, docs, old_shard(), SHARDS)
    return out.select("doc_id", "size", F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
                      F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


def op3_secrets(spark: SparkSession, sf: str) -> DataFrame:
    return secrets.scan_secrets(table(spark, sf, "documents"))


def op4_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    index = toxicity.train(docs, table(spark, sf, "labels"), bucket_of("doc_id", 3) != 1)
    held_out = F.coalesce(bucket_of("doc_id", 3) == 1, F.lit(False)).alias("held_out")
    return toxicity.score(docs, index, ["doc_id", held_out]).select(
        "doc_id", "held_out", "score", (F.col("score") >= 0.7).cast("int").alias("predicted"),
        "evidence", "cosines")


def op5_decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    found = decontaminate.find_leaks(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    length = lambda s: s[1] - s[0]
    hits = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + length(s))
    return found.select(
        "doc_id", "n_words", hits.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ",").cast("binary"), 256).alias("items_sha256"),
        (hits > 0).alias("contaminated"))


OP5_SQL = f"""
with d as materialized (select row_number() over () r, doc_id, {WORDS_SQL.format(c='text')} w from documents),
b as (select item_id, {WORDS_SQL.format(c='text')} w from benchmark where item_id is not null),
bw as (select distinct item_id, least(len(w), 10) n, array_to_string(w[i : i + 9], ' ') p
       from (select *, unnest(range(1, greatest(len(w) - 9, 1) + 1)) i from b where len(w) > 0)),
sizes as (select distinct n from bw),
dw as (select r, n, i, array_to_string(w[i : i + n - 1], ' ') p
       from (select r, w, unnest(range(1, len(w) + 1)) i from d) x, sizes where i + n - 1 <= len(w)),
hits as materialized (select r, i, dw.n, item_id from dw join bw using (n, p)),
pos as (select r, count(distinct k) n_hit from (select r, unnest(range(i, i + n)) k from hits) group by r),
its as (select r, count(distinct item_id) n_items, string_agg(x, ',' order by x) ids
        from (select distinct r, item_id, item_id::varchar x from hits) group by r)
select doc_id, len(w)::bigint n_words, coalesce(n_hit, 0)::bigint n_hit, coalesce(n_items, 0)::bigint n_items,
       sha256(coalesce(ids, '')) items_sha256, coalesce(n_hit, 0) > 0 contaminated
from d left join pos using (r) left join its using (r)"""


def op6_simhash(spark: SparkSession, sf: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op7_mix(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mix(table(spark, sf, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken")


# Repeated rows are alike, so any order of them gives the same rows.  Sources by cap / weight: the clamped ones come first, so the level follows from running sums.
OP7_SQL = r"""
with d as materialized (select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint size,
  md5(concat('7|', coalesce(doc_id::varchar, 'null'), '|', coalesce(md5(text), 'null'))) k from documents),
s as (select source, sum(size)::bigint s, ([5, 2, 1])[((row_number() over (order by source nulls last) - 1) % 3) + 1] w
      from d group by source),
o as (select *, sum(2 * s) over before caps, sum(w) over rest ws, sum(s) over () total from s where s > 0
      window before as (order by 2 * s / w, source nulls last rows between unbounded preceding and 1 preceding),
             rest as (order by 2 * s / w, source nulls last rows between current row and unbounded following)),
l as (select coalesce(max((1.5 * total - coalesce(caps, 0)) / ws) filter (where (1.5 * total - coalesce(caps, 0)) / ws * w < 2 * s), 0) v,
             max(2 * s / w) top from o),
t as (select source, s, case when v = 0 then 2.0 * s else least(2.0 * s, w * v) end target from s, l),
c as (select d.*, s, target, case when s > 0 then floor(target / s) else 0 end whole,
             sum(size) over (partition by d.source order by k rows between unbounded preceding and current row) upto,
             size own
      from d join t on d.source is not distinct from t.source)
select doc_id, size, s source_size, target::double target,
  (size * (whole + case when size > 0 and 2 * upto - own <= 2 * (target - whole * s) then 1 else 0 end))::bigint taken
from c"""


def op8_langid(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    held_out = F.coalesce(bucket_of("doc_id", 4) == 2, F.lit(False)).alias("held_out")
    model = langid.train(docs, bucket_of("doc_id", 4) != 2)
    return langid.identify(docs, model, ["doc_id", held_out])


def op9_chat(spark: SparkSession, sf: str) -> DataFrame:
    said = "<|im_end|><|im_start|>assistant ok"
    more = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)],
                                 "conv_id long, turn long, role string, text string")
    rows = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text").unionByName(more)
    return chat.digests(chat.format_chats(rows, TOKENIZER))


OP9_SQL = r"""
with c as (select conv_id, turn, coalesce(role, '') role, coalesce(text, '') text from conversations
  union all select -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  union all select -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok')
select conv_id, count(*)::bigint n_turns,
  sha256(string_agg(concat(role, chr(10), text, chr(10)), '' order by turn, role, text)) turns_sha256,
  coalesce(sum(length(text)) filter (where role = 'assistant'), 0)::bigint loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (where role = 'assistant'), '')) loss_sha256,
  sum(32 + length(regexp_replace(role, '<(\\*)\|', '<\1\\|', 'g'))
         + length(regexp_replace(text, '<(\\*)\|', '<\1\\|', 'g')))::bigint formatted_chars
from c group by conv_id"""


def op10_licenses(spark: SparkSession, sf: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf, "documents"))


def op11_warc(spark: SparkSession, sf: str) -> DataFrame:
    pages, root = table(spark, sf, "pages"), scratch_path(spark, "warc")
    index = warc.build_index(spark, warc.write_archives(spark, pages, root), root)
    found = warc.lookup(spark, root, index, pages)
    return warc.read_records(spark, root, found, with_payload=False).select(
        F.col("id").cast("long").alias("page_id"), "payload_bytes", "payload_digest",
        F.col("type").alias("record_type"), F.col("refers_to").cast("long").alias("refers_to"))


OP11_SQL = """
with p as (select page_id, encode(coalesce(html, '')) b, sha1(coalesce(html, '')) h from pages),
f as (select h, max(page_id) top from p group by h),
bits as (select p.*, array_to_string(list_transform(range(1, 41), lambda i:
           ['0000', '0001', '0010', '0011', '0100', '0101', '0110', '0111', '1000', '1001', '1010', '1011',
            '1100', '1101', '1110', '1111'][strpos('0123456789abcdef', substr(h, i, 1))]), '') s from p)
select page_id, octet_length(b)::bigint payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda j: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    (1 + 16 * substr(s, 5 * j + 1, 1)::int + 8 * substr(s, 5 * j + 2, 1)::int + 4 * substr(s, 5 * j + 3, 1)::int
     + 2 * substr(s, 5 * j + 4, 1)::int + substr(s, 5 * j + 5, 1)::int)::int, 1)), '') payload_digest,
  case when page_id = top then 'response' else 'revisit' end record_type,
  case when page_id <> top then top end refers_to
from bits join f using (h)"""


def op12_phrases(spark: SparkSession, sf: str) -> DataFrame:
    return phrases.mine_collocations(spark, table(spark, sf, "documents"))


OP12_SQL = r"""
with d as (select coalesce(lang, 'und') lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz') t from documents),
p as (select lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) p from d),
w as materialized (select lang, regexp_extract_all(p, '[^\x20\x09]+') w from p),
wk as (select lang, w, unnest([1, 2, 3, 4]) k from w),
g as (select lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i : i + k - 1], ' '))) phrase
      from wk where len(w) >= k),
f as materialized (select lang, phrase, k, count(*) a from g group by all),
n as (select lang, sum(a)::bigint n from f where k = 1 group by lang),
c as materialized (select lang, phrase, k, a, string_split(phrase, ' ') w from f where k > 1 and a >= 30),
halves as materialized (select lang, phrase, a, h, array_to_string(w[1 : h], ' ') first_part, array_to_string(w[h + 1 : k], ' ') rest
         from (select *, unnest(range(1, k)) h from c)),
lefts as materialized (select halves.*, f.a l from halves join f on f.lang = halves.lang and f.phrase = first_part),
cuts as (select lefts.*, f.a r, ((2000000::hugeint * lefts.a) // (l + f.a))::bigint score
         from lefts join f on f.lang = lefts.lang and f.phrase = rest),
best as (select * from (select *, row_number() over (partition by lang, phrase order by score, h) o from cuts) where o = 1),
cz as (select *, unnest(range(2, k)) z from c),
parts as (select lang, array_to_string(w[i : i + z - 1], ' ') phrase, max(a) longer
          from (select *, unnest(range(1, k - z + 2)) i from cz) group by 1, 2),
kept as (select best.* from best left join parts using (lang, phrase)
         where longer is null or 100 * longer::hugeint < 80 * a::hugeint),
ranked as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) rank from kept)
select lang, rank, phrase, a, l, r, n, score from ranked join n using (lang) where rank <= 2000"""


def op13_negatives(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "embeddings").withColumn("label", F.when(
        F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return negatives.mine_hard_negatives(spark, rows, F.pmod("vec_id", F.lit(100)) == 0)


OP13_SQL = """
with v as (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end label,
             list_transform(embedding, lambda x: floor(256 * x::double)::bigint) q from embeddings
           where vec_id is not null and label is not null and embedding is not null and len(embedding) > 0
             and list_bool_and(list_transform(embedding, lambda x: x is not null and isfinite(x)))),
s as materialized (select a.vec_id anchor_id, b.vec_id, a.label = b.label same,
        list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2]))::bigint score
      from v a join v b on a.vec_id <> b.vec_id where a.vec_id % 100 = 0),
p as (select anchor_id, vec_id positive_id, score positive_score from
        (select *, row_number() over (partition by anchor_id order by score desc, vec_id) n from s where same)
      where n <= 5),
c as (select p.*, vec_id negative_id, score negative_score,
        row_number() over (partition by anchor_id, positive_id order by score desc, vec_id) rank
      from p join s using (anchor_id)
      where not same and 80 * positive_score <= 100 * score and score <= positive_score)
select anchor_id, positive_id, rank::int rank, negative_id, positive_score, negative_score from c where rank <= 5"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_topk, op2_reshard, op3_secrets, op4_toxicity, op5_decontaminate,
                            op6_simhash, op7_mix, op8_langid, op9_chat, op10_licenses,
                            op11_warc, op12_phrases, op13_negatives)}
ORACLES: dict[str, str] = {
    "op1_topk": OP1_SQL, "op5_decontaminate": OP5_SQL, "op7_mix": OP7_SQL, "op9_chat": OP9_SQL,
    "op10_licenses": licenses.oracle(), "op11_warc": OP11_SQL, "op12_phrases": OP12_SQL,
    "op13_negatives": OP13_SQL}
