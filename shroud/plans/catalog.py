"""Registry of named queries (Spark) and their DuckDB oracle SQL.

Every query reads the supplied tables (or data Spark derives from them) in
full.  ``QUERIES[name](spark, sf_dir)`` returns a DataFrame;
``ORACLES[name]`` is the equivalent SQL over the same parquet tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixtures as fx
from ..functions import text as T
from ..operators import deletion, identity
from ..schemas import CUSTOMER_COLUMNS, PII_COLUMNS
from .. import schemas as SC
from ..operators import audit as AU
from ..operators import flatten as FL
from ..operators import redact as RD
from ..session import scratch_path
from ..sinks import files as K
from ..sinks import manifest as MF
from ..sinks import objects as KO
from ..sources import identity_service as IS
from ..sources import objects as SO
from ..sources import tables as ST
from ..streaming import redact_stream as RS
from . import jobs as J

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


_BLANKED = ", ".join(f"'' {c}" if c in PII_COLUMNS else c for c in CUSTOMER_COLUMNS)
_ON = f"trim(concat('{fx.SOURCE}-', a.id)) = trim(b.sourceSystemId)"

# ------------------------------------------------------------ identity joins


@register("deidentify_customers", fx.with_ctes(f"""
select distinct {_BLANKED}, uuid gid, '{fx.DTC}' dtc
from src a join idsvc b on {_ON}"""))
def q_deidentify(spark, sf):
    return identity.deidentify(fx.customers(spark, sf), fx.identity_service(spark, sf),
                               fx.SOURCE, fx.AS_OF)


@register("secured_customers", fx.with_ctes(f"""
select distinct a.*, b.uuid gid, '{fx.DTC}' dtc
from src a left join idsvc b on {_ON}"""))
def q_secured(spark, sf):
    return identity.secure(fx.customers(spark, sf), fx.identity_service(spark, sf),
                           fx.SOURCE, fx.AS_OF)


@register("audit_missing_ids", fx.with_ctes(f"""
select distinct '{fx.SOURCE}' source, concat('{fx.SOURCE}-', a.id) source_id, a.email,
       a.created_at, '{fx.DTC}' dtc
from src a where not exists (select 1 from idsvc b where {_ON})"""))
def q_audit(spark, sf):
    return identity.missing_identities(fx.customers(spark, sf), fx.identity_service(spark, sf),
                                       fx.SOURCE, fx.AS_OF)


@register("new_identity_pairs", fx.with_ctes("""
select distinct a.sourceSystemId, a.uuid from pairs a
where not exists (select 1 from idsvc b where trim(a.sourceSystemId) = trim(b.sourceSystemId))"""))
def q_new_pairs(spark, sf):
    return identity.new_identity_pairs(fx.identity_pairs(spark, sf),
                                       fx.identity_service(spark, sf))


@register("blank_pii", fx.with_ctes(f"select {_BLANKED} from src"))
def q_blank(spark, sf):
    return identity.blank_pii(fx.customers(spark, sf))


@register("distinct_customers", fx.with_ctes("select distinct * from src"))
def q_distinct(spark, sf):
    return fx.customers(spark, sf).distinct()


@register("id_service_unique", fx.with_ctes("""
select sourceSystemId, min(uuid) uuid from pairs group by sourceSystemId"""))
def q_unique(spark, sf):
    return identity.unique_identities(fx.identity_pairs(spark, sf))


@register("id_service_upsert", fx.with_ctes("""
, incoming as (
  select a.sourceSystemId, min(a.uuid) uuid from pairs a
  where a.sourceSystemId is not null
    and not exists (select 1 from idsvc b where trim(a.sourceSystemId) = trim(b.sourceSystemId))
  group by a.sourceSystemId)
select sourceSystemId, uuid from idsvc
where sourceSystemId not in (select sourceSystemId from incoming)
union all select sourceSystemId, uuid from incoming"""))
def q_upsert(spark, sf):
    idsvc = fx.identity_service(spark, sf)
    return identity.upsert_identities(
        idsvc, identity.new_identity_pairs(fx.identity_pairs(spark, sf), idsvc))


@register("lookup_gid", fx.with_ctes(f"""
select k.source_id, b.uuid gid
from (select distinct concat('{fx.SOURCE}-', id) source_id from src) k
left join idsvc b on trim(k.source_id) = trim(b.sourceSystemId)"""))
def q_lookup(spark, sf):
    keys = fx.customers(spark, sf).select(T.source_id("id", fx.SOURCE).alias("source_id"))
    return identity.lookup_gids(keys, fx.identity_service(spark, sf))


@register("lookup_gid_indexed", ORACLES["lookup_gid"])
def q_lookup_indexed(spark, sf):
    path = scratch_path(spark, "idsvc-index")
    identity.write_lookup_index(fx.identity_service(spark, sf), path)
    keys = fx.customers(spark, sf).select(T.source_id("id", fx.SOURCE).alias("source_id"))
    return identity.lookup_gids_indexed(keys, path)


@register("id_service_count", fx.with_ctes("select count(*) as n_rows from idsvc"))
def q_idsvc_count(spark, sf):
    return fx.identity_service(spark, sf).agg(F.count(F.lit(1)).alias("n_rows"))


@register("scan_id_service", fx.with_ctes("select sourceSystemId, uuid from idsvc"))
def q_scan_idsvc(spark, sf):
    # The service snapshot is a table of many files (segments); each is read
    # by its own task and nothing is gathered on the driver.
    p = scratch_path(spark, "idsvc")
    fx.identity_service(spark, sf).repartition(8).write.parquet(p)
    return IS.read_identity_table(spark, p)


# ------------------------------------------------------------------ deletion


@register("delete_requested", fx.with_ctes("""
select distinct a.* from src a left join (select distinct email from dels) b
  on trim(a.email) = lower(trim(b.email))
where lower(trim(b.email)) is null"""))
def q_delete(spark, sf):
    return deletion.apply_deletions(fx.customers(spark, sf), fx.deletion_requests(spark, sf))


@register("delete_requested_strict", fx.with_ctes("""
select distinct a.* from src a left join
  (select distinct lower(trim(email)) e from dels where lower(trim(email)) <> '') b
  on lower(trim(a.email)) = b.e
where b.e is null"""))
def q_delete_strict(spark, sf):
    return deletion.apply_deletions(fx.customers(spark, sf), fx.deletion_requests(spark, sf),
                                    strict=True)


# ------------------------------------------------------------- text masking
def _rx(col: str, pattern: str) -> str:
    return f"regexp_replace({col}, '{pattern}', '{T.TEXT_TOKEN}', 'g')"


def _mask_sql(col: str) -> str:
    return _rx(_rx(_rx(col, T.EMAIL_PATTERN), T.PHONE_PATTERN), T.NAME_PATTERN)


@register("mask_email", f"select doc_id, {_rx('text', T.EMAIL_PATTERN)} masked from documents")
def q_mask_email(spark, sf):
    return fx.table(spark, sf, "documents").select("doc_id", T.mask_email("text").alias("masked"))


@register("mask_phone", f"select doc_id, {_rx('text', T.PHONE_PATTERN)} masked from documents")
def q_mask_phone(spark, sf):
    return fx.table(spark, sf, "documents").select("doc_id", T.mask_phone("text").alias("masked"))


@register("mask_name", f"""
select conv_id, turn, {_rx('text', T.NAME_PATTERN)} masked from conversations""")
def q_mask_name(spark, sf):
    return fx.table(spark, sf, "conversations").select(
        "conv_id", "turn", T.mask_name("text").alias("masked"))


@register("mask_text_documents", f"select doc_id, {_mask_sql('text')} masked from documents")
def q_mask_docs(spark, sf):
    return fx.table(spark, sf, "documents").select("doc_id", T.mask_text("text").alias("masked"))


@register("mask_text_conversations", f"""
select conv_id, turn, role, {_mask_sql('text')} masked from conversations""")
def q_mask_convs(spark, sf):
    return fx.table(spark, sf, "conversations").select(
        "conv_id", "turn", "role", T.mask_text("text").alias("masked"))


@register("flatten_lines", f"""
select doc_id, regexp_replace(regexp_replace(text, '{T.EDGE_CONTROL_PATTERN}', '', 'g'),
                              '{T.LINE_BREAK_PATTERN}', ' ', 'g') flat from documents""")
def q_flatten(spark, sf):
    return fx.table(spark, sf, "documents").select("doc_id", T.flatten_lines("text").alias("flat"))


@register("normalize_keys", fx.with_ctes(f"""
select id, trim(concat('{fx.SOURCE}-', id)) source_key, lower(trim(email)) email_key from src"""))
def q_normalize(spark, sf):
    return fx.customers(spark, sf).select(
        "id", T.source_key("id", fx.SOURCE).alias("source_key"),
        T.normalize_email("email").alias("email_key"))


@register("run_stamp", """
select o_orderkey, strftime(cast(o_orderdate as date), '%Y-%m-%d %I:%M:%S') dtc from orders""")
def q_run_stamp(spark, sf):
    return fx.table(spark, sf, "orders").select(
        "o_orderkey", T.stamp_of(F.to_date("o_orderdate")).alias("dtc"))


_PATH_SQL = ("concat('s3://', source, '-bucket/', lang, '/docs/', cast(doc_id as varchar), "
             "'/part.tsv.gz')")


@register("path_parts", f"""
select doc_id, split_part(p, '/', 3) bucket, split_part(p, '/', 4) prefix_a,
       split_part(p, '/', 5) prefix_b, split_part(p, '/', 6) prefix_c
from (select doc_id, {_PATH_SQL} p from documents)""")
def q_path_parts(spark, sf):
    d = fx.table(spark, sf, "documents")
    p = F.concat(F.lit("s3://"), "source", F.lit("-bucket/"), "lang", F.lit("/docs/"),
                 F.col("doc_id").cast("string"), F.lit("/part.tsv.gz"))
    d = d.select("doc_id", p.alias("p"))
    return d.select("doc_id", T.path_part("p", 2).alias("bucket"),
                    T.path_part("p", 3).alias("prefix_a"), T.path_part("p", 4).alias("prefix_b"),
                    T.path_part("p", 5).alias("prefix_c"))


# ---------------------------------------------------------------- JSON redaction

CLICK_KEYS = ["email", "phone"]
CHAT_KEYS = ["name", "email"]
ORDER_PII = ["customername", "tablename", "server", "ignored"]
SERVICE_KEYS = ["emails", "preview", "name", "phone"]
_TOK = T.KEY_TOKEN

_CLICK_ORACLE = "select event_id, event_type event, '' email, '' phone, value, props from events"
_CHAT_ORACLE = f"""
select conv_id, '{_TOK}' guest_name, '{_TOK}' guest_email, conv_id % 2 = 0 vip, turn, role,
       {_mask_sql('text')} body from conversations"""
_ORDERS_ORACLE = f"""
select o_orderkey orderkey,
  case when o_orderkey % 5 <> 0 then '{_TOK}' end customername,
  case when o_orderkey % 5 <> 0 and o_orderkey % 3 = 0 then '{_TOK}' end tablename,
  case when o_orderkey % 5 <> 0 then o_orderkey % 100 end server_id,
  case when o_orderkey % 5 <> 0 then '{_TOK}' end server_name,
  case when o_orderkey % 5 <> 0 then o_totalprice end total
from orders join customer on o_custkey = c_custkey"""


def _service_oracle(preview_sql: str, email: str, name: str, keys: str) -> str:
    n = "cast(null as varchar)"
    return f"""
select doc_id, 0 pos, 'STRING' kind, cast(null as bigint) data_id, {n} email,
       cast(null as boolean) verified, {n} preview, {n} name, {n} lang, {n} attr_keys from documents
union all
select doc_id, 1, 'OBJECT', null, {n}, null, {n}, {n}, {n}, {n} from documents
union all
select doc_id, 2, 'OBJECT', doc_id, {email}, true, {preview_sql}, {name}, lang, '{keys}'
from documents
union all
select doc_id, 3, 'OBJECT', -1, {n}, null, {n}, {n}, 'xx', 'lang,name' from documents"""


@register("json_redact_clickstream", _CLICK_ORACLE)
def q_json_click(spark, sf):
    docs = RD.redact(fx.clickstream_docs(spark, sf), "clickstream", CLICK_KEYS)
    return FL.clickstream_rows(RD.redacted_only(docs), "redacted", [])


@register("json_redact_chat", _CHAT_ORACLE)
def q_json_chat(spark, sf):
    docs = RD.redact(fx.chat_docs(spark, sf), "chat", CHAT_KEYS)
    return FL.chat_rows(RD.redacted_only(docs), "redacted", [])


@register("json_redact_orders", _ORDERS_ORACLE)
def q_json_orders(spark, sf):
    docs = RD.redact(fx.order_docs(spark, sf), "orders", ORDER_PII)
    return FL.order_rows(RD.redacted_only(docs), "redacted", [])


@register("json_redact_service", _service_oracle(
    _mask_sql("cast(to_json(text) as varchar)"), f"'{_TOK}'", f"'{_TOK}'",
    "emails,lang,name,preview"))
def q_json_service(spark, sf):
    docs = RD.redact(fx.service_docs(spark, sf), "service", SERVICE_KEYS)
    return FL.service_rows(RD.redacted_only(docs), "redacted", ["doc_id"])


@register("json_redact_service_strict", _service_oracle(
    _mask_sql("text"), f"'{_TOK}'", f"'{_TOK}'", "emails,lang,name,preview"))
def q_json_service_strict(spark, sf):
    docs = RD.redact(fx.service_docs(spark, sf), "service", SERVICE_KEYS, strict=True)
    return FL.service_rows(RD.redacted_only(docs), "redacted", ["doc_id"])


@register("json_valid_elements", """
select doc_id, pos, 'OBJECT' kind from documents, (values (1), (2), (3)) t(pos)""")
def q_json_valid(spark, sf):
    rows = FL.service_rows(fx.service_docs(spark, sf), "payload", ["doc_id"])
    return rows.where(F.col("kind") != "STRING").select("doc_id", "pos", "kind")


@register("json_explode_messages", """
select conv_id, concat('Guest ', cast(conv_id as varchar)) guest_name,
       cast(null as varchar) guest_email, conv_id % 2 = 0 vip, turn, role, text body
from conversations""")
def q_json_explode(spark, sf):
    return FL.chat_rows(fx.chat_docs(spark, sf), "payload", [])


@register("json_roundtrip", """
select event_id, event_type event,
       case when event_id % 2 = 0 then concat('user.', cast(user_id as varchar), '@example.com') end email,
       cast(null as varchar) phone, value, props
from events""")
def q_json_roundtrip(spark, sf):
    docs = fx.clickstream_docs(spark, sf)
    again = docs.select(F.to_json(F.try_parse_json("payload")).alias("json"))
    return FL.clickstream_rows(again, "json", [])


# ------------------------------------------------------- quarantine / routing
def _keys_sql(kind: str, table: str, prefix: str = "") -> str:
    k = fx.ORACLE_DOC_KEYS[kind]
    return f"select distinct concat('{prefix}', {k}) object_key from {table}"


def _with_key_prefix(df: DataFrame, prefix: str) -> DataFrame:
    return df.withColumn("object_key", F.concat(F.lit(prefix), "object_key"))


def _constant_docs(spark, sf, table_name: str, key_col: str, prefix: str, payload: str):
    t = fx.table(spark, sf, table_name)
    return t.select(F.concat(F.lit(prefix), F.col(key_col).cast("string")).alias("object_key"),
                    F.lit(payload).alias("payload"))


@register("json_quarantine", f"""
select object_key, preset, status, reason from (
  select object_key, 'clickstream' preset, 'redacted' status, cast(null as varchar) reason
    from ({_keys_sql('clickstream', 'events')})
  union all select object_key, 'clickstream', 'quarantined', 'missing_properties'
    from ({_keys_sql('clickstream', 'events', 'noprops/')})
  union all select concat('pages/page=', cast(page_id as varchar)), 'clickstream', 'quarantined',
    'unparseable_json' from pages
  union all select concat('empty-array/region=', cast(r_regionkey as varchar)), 'clickstream',
    'quarantined', 'missing_root_array' from region
  union all select object_key, 'chat', 'quarantined', 'bad_conversation'
    from ({_keys_sql('chat', 'conversations', 'noguest/')})
  union all select object_key, 'chat', 'quarantined', 'bad_message_body'
    from ({_keys_sql('chat', 'conversations', 'nullbody/')})
  union all select object_key, 'orders', 'quarantined', 'bad_course'
    from (select distinct concat('nullserver/', {fx.ORACLE_DOC_KEYS['orders']}) object_key
          from orders join customer on o_custkey = c_custkey)
  union all select concat('empty-object/nation=', cast(n_nationkey as varchar)), 'orders',
    'quarantined', 'missing_root_array' from nation)""")
def q_json_quarantine(spark, sf):
    click_in = (fx.clickstream_docs(spark, sf).select("object_key", "payload")
                .unionByName(_with_key_prefix(
                    fx.clickstream_docs(spark, sf, props_name="props_").select(
                        "object_key", "payload"), "noprops/"))
                .unionByName(fx.page_objects(spark, sf))
                .unionByName(_constant_docs(spark, sf, "region", "r_regionkey",
                                            "empty-array/region=", "[]")))
    chat_in = (_with_key_prefix(fx.chat_docs(spark, sf, with_guest=False), "noguest/")
               .select("object_key", "payload")
               .unionByName(_with_key_prefix(fx.chat_docs(spark, sf, null_body=True),
                                             "nullbody/").select("object_key", "payload")))
    orders_in = (_with_key_prefix(fx.order_docs(spark, sf, null_server=True), "nullserver/")
                 .select("object_key", "payload")
                 .unionByName(_constant_docs(spark, sf, "nation", "n_nationkey",
                                             "empty-object/nation=", "{}")))
    parts = [RD.redact(click_in, "clickstream", CLICK_KEYS).withColumn("preset", F.lit("clickstream")),
             RD.redact(chat_in, "chat", CHAT_KEYS).withColumn("preset", F.lit("chat")),
             RD.redact(orders_in, "orders", ORDER_PII).withColumn("preset", F.lit("orders"))]
    out = parts[0].select("object_key", "preset", "status", "reason")
    for p in parts[1:]:
        out = out.unionByName(p.select("object_key", "preset", "status", "reason"))
    return out


ROUTED_SOURCES = {"source1": ("clickstream", CLICK_KEYS), "source2": ("chat", CHAT_KEYS),
                  "service": ("service", SERVICE_KEYS), "source3": ("orders", ORDER_PII)}


@register("json_redact_all_sources", f"""
select 'source1' source_type, 'clickstream' preset, object_key, 'redacted' status
  from ({_keys_sql('clickstream', 'events')})
union all select 'source2', 'chat', object_key, 'redacted' from ({_keys_sql('chat', 'conversations')})
union all select 'service', 'service', object_key, 'redacted' from ({_keys_sql('service', 'documents')})
union all select 'source3', 'orders', object_key, 'redacted'
  from (select distinct {fx.ORACLE_DOC_KEYS['orders']} object_key
        from orders join customer on o_custkey = c_custkey)""")
def q_json_all(spark, sf):
    builders = {"clickstream": fx.clickstream_docs, "chat": fx.chat_docs,
                "service": fx.service_docs, "orders": fx.order_docs}
    out = None
    for source_type, (_, keys) in ROUTED_SOURCES.items():
        preset = RD.route(source_type)
        docs = builders[preset](spark, sf).select("object_key", "payload")
        r = RD.redact(docs, preset, keys).select(
            F.lit(source_type).alias("source_type"), F.lit(preset).alias("preset"),
            "object_key", "status")
        out = r if out is None else out.unionByName(r)
    return out


# ------------------------------------------------------------ object I/O



# Half of the objects have names that Spark's file sources pass over: odd ids get a folder with _
# and a name with a dot.
_ODD = r"^(chat/|noguest/chat/|click/)(conv|user)=([0-9]*[13579])/batch="


def _odd_names(df: DataFrame) -> DataFrame:
    return df.withColumn("object_key", F.regexp_replace("object_key", _ODD, "$1_$2=$3/.batch="))


def _odd_sql(kind: str) -> str:
    return f"regexp_replace({fx.ORACLE_DOC_KEYS[kind]}, '{_ODD}', '\\1_\\2=\\3/.batch=')"


@register("scan_json_objects", f"""
select {_odd_sql('chat')} object_key, conv_id, turn, text body from conversations""")
def q_scan_objects(spark, sf):
    root = scratch_path(spark, "objects-in")
    KO.put_objects(_odd_names(fx.chat_docs(spark, sf)), root, gzip=True)
    docs = SO.scan_objects(spark, root, gzip_any_name=True)
    return FL.chat_rows(docs, "payload", ["object_key"]).select("object_key", "conv_id", "turn",
                                                                "body")


@register("scan_json_objects_keyed", f"""
select {fx.ORACLE_DOC_KEYS['chat']} object_key, conv_id, turn, text body from conversations""")
def q_scan_keyed(spark, sf):
    root = scratch_path(spark, "objects-keyed")
    KO.write_objects(fx.chat_docs(spark, sf), root, gzip=True)
    docs = SO.scan_objects(spark, root, layout="keyed")
    return FL.chat_rows(docs, "payload", ["object_key"]).select("object_key", "conv_id", "turn",
                                                                "body")


@register("json_emit_keys", f"""
select concat('anonymized/', {_odd_sql('chat')}) object_key, conv_id, turn,
       {_mask_sql('text')} body from conversations""")
def q_emit_keys(spark, sf):
    base = scratch_path(spark, "emit")
    KO.put_objects(_odd_names(fx.chat_docs(spark, sf)), f"{base}/in", gzip=True)
    J.json_anonymize_job(spark, f"{base}/in", f"{base}/out", f"{base}/quarantine", "source2",
                         CHAT_KEYS)
    docs = SO.scan_objects(spark, f"{base}/out", gzip_any_name=True)
    return FL.chat_rows(docs, "payload", ["object_key"]).select("object_key", "conv_id", "turn",
                                                                "body")


@register("stream_redact_clickstream", _CLICK_ORACLE)
def q_stream(spark, sf):
    base = scratch_path(spark, "stream")
    KO.put_objects(_odd_names(fx.clickstream_docs(spark, sf, every_key=True)), f"{base}/in")
    q = RS.start_redact_stream(spark, f"{base}/in", f"{base}/out", f"{base}/checkpoint",
                               "source1", CLICK_KEYS)
    q.awaitTermination()
    out = spark.read.parquet(f"{base}/out").where(F.col("status") == "redacted")
    return FL.clickstream_rows(out, "redacted", [])


@register("stream_emit_objects", f"""
select concat('anonymized/', {_odd_sql('chat')}) object_key, conv_id, turn,
       {_mask_sql('text')} body from conversations""")
def q_stream_objects(spark, sf):
    base = scratch_path(spark, "stream-objects")
    KO.put_objects(_odd_names(fx.chat_docs(spark, sf)), f"{base}/in", gzip=True)
    q = RS.start_redact_stream_to_objects(spark, f"{base}/in", f"{base}/out", f"{base}/quarantine",
                                          f"{base}/checkpoint", "source2", CHAT_KEYS)
    q.awaitTermination()
    docs = SO.scan_objects(spark, f"{base}/out", gzip_any_name=True)
    return FL.chat_rows(docs, "payload", ["object_key"]).select("object_key", "conv_id", "turn",
                                                                "body")


# Of listed objects, those of one nation go before the purge, and those of suppliers in debt are
# put again with another content: they are not what was listed and stay.
@register("purge_run", """
select concat('staging/supplier=', s_suppkey) object_key,
       case when s_nationkey = 1 then 'gone' when s_acctbal < 0 then 'replaced' else 'deleted' end status,
       s_nationkey <> 1 and s_acctbal < 0 still_there
from supplier""")
def q_purge_run(spark, sf):
    root = scratch_path(spark, "purge-run")
    s = fx.table(spark, sf, "supplier").select(
        F.concat(F.lit("staging/supplier="), "s_suppkey").alias("object_key"),
        F.col("s_name").alias("payload"), "s_nationkey", "s_acctbal")
    KO.put_objects(s, root)
    listed = scratch_path(spark, "purge-run-manifest")
    MF.purge_manifest(spark, root, ["staging"]).write.parquet(listed)
    listed = spark.read.parquet(listed)
    first = listed.join(s.where("s_nationkey = 1"), F.col("relative_path") == F.col("object_key"), "left_semi")
    MF.purge(spark, first)
    newer = s.where("s_nationkey <> 1 and s_acctbal < 0").withColumn("payload", F.concat("payload", F.lit(" (new)")))
    KO.put_objects(newer, root)
    log = scratch_path(spark, "purge-run-log")
    MF.purge(spark, listed, log)
    left = SO.list_objects(spark, root).select("object_key", F.lit(True).alias("there"))
    key = SO.relative_path(F.col("path"), root)
    return (MF.purge_status(spark, log).select(key.alias("object_key"), "status").join(left, "object_key", "left")
            .select("object_key", "status", F.coalesce("there", F.lit(False)).alias("still_there")))


# ------------------------------------------------------ table round trips
@register("scan_customers_csv", fx.with_ctes("select * from src"))
def q_scan_csv(spark, sf):
    p = scratch_path(spark, "customers-csv")
    K.write_csv(fx.customers(spark, sf), p, sep=",")
    return ST.read_customers_csv(spark, p)


@register("scan_customers_tsv", fx.with_ctes("select * from src"))
def q_scan_tsv(spark, sf):
    p = scratch_path(spark, "customers-tsv")
    K.write_tsv_gzip(fx.customers(spark, sf), p)
    return ST.read_customers_tsv(spark, p)


# A request file has one e-mail per line; a NULL request is a blank line,
# which carries no request and is not read back.
@register("scan_delete_requests", fx.with_ctes("select * from dels where email is not null"))
def q_scan_dels(spark, sf):
    p = scratch_path(spark, "deletion-requests")
    K.write_csv(fx.deletion_requests(spark, sf).repartition(3), p, sep="\t")
    return ST.read_deletion_requests(spark, f"{p}/*")


@register("scan_id_pairs", fx.with_ctes("select * from pairs"))
def q_scan_pairs(spark, sf):
    p = scratch_path(spark, "id-pairs")
    K.write_csv(fx.identity_pairs(spark, sf), p, sep="\t")
    return ST.read_identity_pairs(spark, p)


@register("sink_orc_roundtrip", ORACLES["deidentify_customers"])
def q_orc(spark, sf):
    p = scratch_path(spark, "orc")
    K.write_orc(q_deidentify(spark, sf), p)
    return spark.read.schema(SC.DEIDENTIFIED).orc(p)


_NULLED = ", ".join(f"cast(null as varchar) {c}" if c in PII_COLUMNS else c
                    for c in CUSTOMER_COLUMNS)


@register("sink_tsv_roundtrip", fx.with_ctes(f"""
select distinct {_NULLED}, uuid gid, '{fx.DTC}' dtc from src a join idsvc b on {_ON}"""))
def q_tsv(spark, sf):
    p = scratch_path(spark, "tsv")
    K.write_tsv_gzip(q_deidentify(spark, sf), p)
    return K.read_by_format(spark, p, "gzip", SC.DEIDENTIFIED)


@register("audit_refresh", fx.with_ctes(f"""
select distinct '{fx.SOURCE}' source, concat('{fx.SOURCE}-', a.id) source_id, a.email,
       a.created_at, '{fx.DTC}' dtc
from src a where not exists (select 1 from idsvc b where {_ON})
union all
select 'legacy' source, concat('legacy-', id) source_id, email, created_at, '{fx.DTC}' dtc
from src"""))
def q_audit_refresh(spark, sf):
    root = scratch_path(spark, "audit")
    src = fx.customers(spark, sf)

    def as_audit(source: str) -> DataFrame:
        return src.select(F.lit(source).alias("source"), T.source_id("id", source).alias("source_id"),
                          "email", "created_at", T.run_stamp(fx.AS_OF).alias("dtc"))

    AU.refresh_audit(as_audit(fx.SOURCE), root, fx.SOURCE)      # stale rows of this source
    AU.refresh_audit(as_audit("legacy"), root, "legacy")        # another source, kept
    AU.refresh_audit(q_audit(spark, sf), root, fx.SOURCE)       # the refresh itself
    return AU.read_audit(spark, root)


# The files' names are derived from the tables: one folder a nation or segment.
@register("purge_manifest", """
select concat('customers/nation=', n_nationkey) folder from (select distinct c_nationkey n_nationkey from customer)
union all select distinct concat('addresses/segment=', c_mktsegment) from customer
  where c_mktsegment <> 'BUILDING'""")
def q_purge(spark, sf):
    root = scratch_path(spark, "staging")
    c = fx.table(spark, sf, "customer")
    rows = c.select(F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment"),
                    F.col("c_name").alias("value"))
    for name, part, kept in (("customers", "nation", rows), ("keep", "nation", rows),
                             ("addresses", "segment", rows.where("segment <> 'BUILDING'"))):
        kept.select(part, "value").repartition(part).write.partitionBy(part).text(f"{root}/{name}")
    m = MF.purge_manifest(spark, root, ["customers", "addresses"])
    return MF.manifest_folders(m, 2).select("folder")


@register("purge_manifest_keep_version", f"""
select distinct concat('orc/deleteOverwrite_', 2020 + cast(c_nationkey % 3 as integer), '-01-01') folder
from customer where 2020 + c_nationkey % 3 <> {fx.AS_OF[:4]}""")
def q_purge_version(spark, sf):
    root = scratch_path(spark, "versions")
    K.write_orc(q_delete(spark, sf), f"{root}/orc/deleteOverwrite_{fx.AS_OF}")
    older = fx.table(spark, sf, "customer").withColumn("year", F.lit(2020) + F.col("c_nationkey") % 3)
    for year in (2020, 2021, 2022):  # a version exists only where the table has its customers
        v = older.where(F.col("year") == year)
        if v.head(1):
            K.write_orc(v, f"{root}/orc/deleteOverwrite_{year}-01-01")
    m = MF.purge_manifest_keep_version(spark, root, "orc", f"deleteOverwrite_{fx.AS_OF}")
    return MF.manifest_folders(m, 2).select("folder")


# ------------------------------------------------------------- metrics / runs
def _metric_sql(job: str, pairs: list[tuple[str, str]]) -> str:
    parts = [f"select '{job}' job, '{m}' metric, cast(({q}) as bigint) value" for m, q in pairs]
    body = "\nunion all ".join(parts)
    return fx.with_ctes(f"""
select job, metric, value, format('{{:,}}', value) value_text from (
{body})""")


def _lazy_metrics(job: str, frames: dict[str, DataFrame]) -> DataFrame:
    out = None
    for name, df in frames.items():
        one = df.agg(F.count(F.lit(1)).alias("value")).select(
            F.lit(job).alias("job"), F.lit(name).alias("metric"), "value")
        out = one if out is None else out.unionByName(one)
    return out.withColumn("value_text", T.format_count("value"))


_DEID_COUNTS = [
    ("source_rows", "select count(*) from src"),
    ("distinct_source_rows", "select count(*) from (select distinct * from src)"),
    ("public_rows", f"select count(*) from (select distinct {_BLANKED}, uuid from src a join idsvc b on {_ON})"),
    ("secured_rows", f"select count(*) from (select distinct a.*, b.uuid from src a left join idsvc b on {_ON})"),
    ("missing_identities", f"select count(*) from (select distinct a.id, a.email, a.created_at from src a where not exists (select 1 from idsvc b where {_ON}))"),
]


@register("run_metrics", _metric_sql("deidentify", _DEID_COUNTS + [
    ("request_rows", "select count(*) from dels"),
    ("lookup_rows", "select count(*) from idsvc")]))
def q_metrics(spark, sf):
    src, idsvc = fx.customers(spark, sf), fx.identity_service(spark, sf)
    return _lazy_metrics("deidentify", {
        "source_rows": src, "distinct_source_rows": src.distinct(),
        "public_rows": identity.deidentify(src, idsvc, fx.SOURCE, fx.AS_OF),
        "secured_rows": identity.secure(src, idsvc, fx.SOURCE, fx.AS_OF),
        "missing_identities": identity.missing_identities(src, idsvc, fx.SOURCE, fx.AS_OF),
        "request_rows": fx.deletion_requests(spark, sf), "lookup_rows": idsvc})


# The expected number comes from the customers, not from the table that is checked; the
# second snapshot lacks the keys of one nation.
@register("id_service_completeness", fx.with_ctes("""
select 'whole' snapshot, count(*) rows_read, count(distinct sourceSystemId) distinct_keys,
       (select count(*) from customer where c_acctbal >= 0) expected_rows, true complete from idsvc
union all
select 'part', count(*), count(distinct c_custkey), (select count(*) from customer where c_acctbal >= 0),
       count(*) >= (select count(*) from customer where c_acctbal >= 0)
from customer where c_acctbal >= 0 and c_nationkey <> 1"""))
def q_completeness(spark, sf):
    c = fx.table(spark, sf, "customer")
    expected = J.count_rows({"n": c.where(F.col("c_acctbal") >= 0)})["n"]
    root = scratch_path(spark, "idsvc")
    fx.identity_service(spark, sf).write.parquet(root)
    whole = spark.read.parquet(root)
    gone = c.where(F.col("c_nationkey") == 1).select(
        F.concat(F.lit(f"{fx.SOURCE}-"), F.col("c_custkey").cast("string")).alias("k"))
    part = whole.join(gone, F.trim("sourceSystemId") == F.col("k"), "left_anti")
    return (identity.completeness(whole, expected).withColumn("snapshot", F.lit("whole"))
            .unionByName(identity.completeness(part, expected).withColumn("snapshot", F.lit("part"))))


def _deidentify_run(spark, sf):
    base = scratch_path(spark, "deidentify-run")
    K.write_csv(fx.customers(spark, sf), f"{base}/staging/customers", sep=",")
    fx.identity_service(spark, sf).write.parquet(f"{base}/idsvc")
    res = J.deidentify_job(
        spark, ST.read_customers_csv(spark, f"{base}/staging/customers"),
        spark.read.parquet(f"{base}/idsvc"), public_root=f"{base}/public",
        secured_root=f"{base}/secured", audit_root=f"{base}/audit", fmt="orc",
        dataset="customers", source=fx.SOURCE, as_of=fx.AS_OF,
        staging_root=f"{base}/staging", staging_prefixes=["customers"])
    return res


@register("deidentify_run", _metric_sql("deidentify", _DEID_COUNTS))
def q_deidentify_run(spark, sf):
    return _deidentify_run(spark, sf).metrics


# The files that the jobs leave behind, against the same SQL as the operators.
@register("deidentify_run_public", ORACLES["deidentify_customers"])
def q_deidentify_public(spark, sf):
    out = _deidentify_run(spark, sf).outputs["public"]
    return K.read_by_format(spark, out, "orc", SC.DEIDENTIFIED)


@register("deidentify_run_secured", ORACLES["secured_customers"])
def q_deidentify_secured(spark, sf):
    out = _deidentify_run(spark, sf).outputs["secured"]
    return K.read_by_format(spark, out, "orc", SC.SECURED)


@register("deidentify_run_audit", ORACLES["audit_missing_ids"])
def q_deidentify_audit(spark, sf):
    return AU.read_audit(spark, _deidentify_run(spark, sf).outputs["audit"])


def _deletion_run(spark, sf):
    base = scratch_path(spark, "deletion-run")
    K.write_tsv_gzip(fx.customers(spark, sf), f"{base}/customers")
    K.write_csv(fx.deletion_requests(spark, sf), f"{base}/requests", sep="\t")
    return J.deletion_job(spark, ST.read_customers_tsv(spark, f"{base}/customers"),
                          ST.read_deletion_requests(spark, f"{base}/requests/*"),
                          out_root=f"{base}/lake", fmt="gzip", as_of=fx.AS_OF)


@register("deletion_run_kept", ORACLES["delete_requested"])
def q_deletion_kept(spark, sf):
    return K.read_by_format(spark, _deletion_run(spark, sf).outputs["kept"], "gzip", SC.CUSTOMERS)


@register("deletion_by_file_kept", ORACLES["delete_requested"])
def q_deletion_by_file(spark, sf):
    base = scratch_path(spark, "deletion-by-file")
    first = f"{base}/lake/orc/{J.VERSION_PREFIX}2020-01-01"
    # files by e-mail, so that a request hits few of them
    K.write_orc(fx.customers(spark, sf).distinct().repartitionByRange(16, "email"), first)
    res = J.deletion_by_file_job(spark, first, fx.deletion_requests(spark, sf), out_root=f"{base}/lake",
                                 fmt="orc", as_of=fx.AS_OF)
    return J.read_version(spark, res.outputs["kept"], "orc")


@register("deletion_run", _metric_sql("deletion", [
    ("source_rows", "select count(*) from src"),
    ("request_rows", "select count(*) from (select distinct email from dels where email is not null)"),
    ("kept_rows", "select count(*) from (select distinct a.* from src a left join dels b on trim(a.email) = lower(trim(b.email)) where b.email is null)"),
    ("deleted_rows", "select count(*) from (select distinct a.* from src a where exists (select 1 from dels b where trim(a.email) = lower(trim(b.email))))"),
]))
def q_deletion_run(spark, sf):
    return _deletion_run(spark, sf).metrics


@register("identity_load_run", _metric_sql("identity_load", [
    ("source_rows", "select count(*) from pairs"),
    ("lookup_rows", "select count(*) from idsvc"),
    ("new_pairs", "select count(*) from (select distinct a.* from pairs a where not exists (select 1 from idsvc b where trim(a.sourceSystemId) = trim(b.sourceSystemId)))"),
    ("identity_rows_after", "select (select count(*) from idsvc) + (select count(distinct a.sourceSystemId) from pairs a where not exists (select 1 from idsvc b where trim(a.sourceSystemId) = trim(b.sourceSystemId)))"),
]))
def q_identity_run(spark, sf):
    base = scratch_path(spark, "identity-run")
    K.write_csv(fx.identity_pairs(spark, sf), f"{base}/pairs", sep="\t")
    fx.identity_service(spark, sf).write.parquet(f"{base}/idsvc")
    res = J.identity_load_job(spark, ST.read_identity_pairs(spark, f"{base}/pairs"),
                              spark.read.parquet(f"{base}/idsvc"),
                              out_path=f"{base}/idsvc-next")
    return res.metrics


_FRESH = """
select sourceSystemId, min(uuid) uuid from pairs a where sourceSystemId is not null
  and not exists (select 1 from idsvc b where trim(a.sourceSystemId) = trim(b.sourceSystemId))
group by sourceSystemId"""


@register("identity_load_append", fx.with_ctes(f"select * from idsvc union all ({_FRESH})"))
def q_identity_append(spark, sf):
    base = scratch_path(spark, "identity-append")
    K.write_csv(fx.identity_pairs(spark, sf), f"{base}/pairs", sep="\t")
    fx.identity_service(spark, sf).write.parquet(f"{base}/idsvc")
    J.identity_load_job(spark, ST.read_identity_pairs(spark, f"{base}/pairs"),
                        spark.read.parquet(f"{base}/idsvc"), append_to=f"{base}/idsvc")
    return spark.read.parquet(f"{base}/idsvc")


# The first load of all: the store is empty.
@register("identity_load_first_run", fx.with_ctes("""
select sourceSystemId, min(uuid) uuid from pairs group by sourceSystemId"""))
def q_identity_first(spark, sf):
    base = scratch_path(spark, "identity-first")
    K.write_csv(fx.identity_pairs(spark, sf), f"{base}/pairs", sep="\t")
    fx.identity_service(spark, sf).where(F.lit(False)).write.parquet(f"{base}/idsvc")
    J.identity_load_job(spark, ST.read_identity_pairs(spark, f"{base}/pairs"),
                        spark.read.schema(SC.IDENTITY).parquet(f"{base}/idsvc"),
                        append_to=f"{base}/idsvc")
    return spark.read.schema(SC.IDENTITY).parquet(f"{base}/idsvc")


_N_CHAT = f"select count(*) from ({_keys_sql('chat', 'conversations')})"


@register("json_anonymize_run", f"""
select 'json_anonymize' job, metric, value, format('{{:,}}', value) value_text from (
  select 'listed_objects' metric, 2 * ({_N_CHAT}) value
  union all select 'redacted_objects', ({_N_CHAT})
  union all select 'quarantined_objects', ({_N_CHAT})
  union all select 'written_objects', ({_N_CHAT}))""")
def q_json_run(spark, sf):
    return _json_run(spark, sf).metrics


def _json_run(spark, sf):
    base = scratch_path(spark, "json-run")
    docs = fx.chat_docs(spark, sf).select("object_key", "payload").unionByName(
        _with_key_prefix(fx.chat_docs(spark, sf, with_guest=False), "noguest/")
        .select("object_key", "payload"))
    KO.put_objects(_odd_names(docs), f"{base}/in", gzip=True)
    return J.json_anonymize_job(spark, f"{base}/in", f"{base}/out", f"{base}/quarantine",
                                "source2", CHAT_KEYS)


# The objects that the job leaves behind, at their exact keys.
@register("json_anonymize_objects", ORACLES["json_emit_keys"])
def q_json_objects(spark, sf):
    docs = SO.scan_objects(spark, _json_run(spark, sf).outputs["objects"], gzip_any_name=True)
    return FL.chat_rows(docs, "payload", ["object_key"]).select("object_key", "conv_id", "turn",
                                                                "body")
