"""Input recipes built from the supplied test tables.

The privacy data model (customer exports, identity service, deletion
requests, JSON objects) is derived from the TPC-H-style tables so that every
query's work grows with them.  Each recipe exists twice: as a DataFrame
builder used by the Spark queries and as portable SQL text used by the
DuckDB oracles.  Which customers lack an identity or ask for deletion
follows their data (negative balance, market segment, nation); arithmetic on
keys only picks the *form* of a value (padded key, mixed-case e-mail, ...).
No recipe samples or caps its input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import redact as L  # document layout key names (fixed values)

SOURCE = "app"
AS_OF = "2024-01-01"
DTC = "2024-01-01 12:00:00"

# Width of the key ranges that bound one JSON object: a user, conversation
# or customer with many rows yields several bounded objects, never one
# unbounded document.  Even if one key owned every row of a range, a
# document stays bounded: at most ~11 MB of events (~110 bytes each) or
# ~50 MB of orders (~200 bytes each), inside the 128 MiB a VARIANT value may
# hold.
EVENT_BATCH = 100000
ORDER_BATCH = 250000
TURN_BATCH = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


# ----------------------------------------------------------------- relational
def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    dotted = F.replace(F.col("c_name"), F.lit("#"), F.lit("."))
    email = (F.when(k % 17 == 0, F.lit(None).cast("string"))
             .when(k % 13 == 0, F.concat(F.lit(" "), F.lower(dotted), F.lit("@example.com ")))
             .when(k % 11 == 0, F.concat(dotted, F.lit("@Example.com")))
             .otherwise(F.concat(F.lower(dotted), F.lit("@example.com"))))
    return c.select(
        _s(k).alias("id"), email.alias("email"),
        F.lit("2020-01-01 00:00:00").alias("created_at"),
        F.lit("2020-06-01 00:00:00").alias("updated_at"),
        F.lit("Customer").alias("first_name"),
        F.substring("c_name", 10, 1 << 30).alias("last_name"),
        F.concat(F.lit("415"), F.lpad(_s(k), 7, "0")).alias("contact_number"),
        F.col("c_mktsegment").alias("reference"),
        F.when(F.col("c_acctbal") > 0, "t").otherwise("f").alias("is_rewards_user"),
        F.lit("f").alias("has_sent_feedback"), F.lit("t").alias("has_opted_in"),
        _s("c_nationkey").alias("level_up_id"), F.lit("1990-01-01").alias("birthday"),
        F.lit("f").alias("has_sent_support"),
        F.lit(None).cast("string").alias("rewards_started_at"),
        F.lit("{}").alias("settings"), F.lit("t").alias("use_credit"),
        F.md5("c_name").alias("tracking_uuid"))


def identity_service(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    key = (F.when(k % 5 == 0, F.concat(F.lit(f" {SOURCE}-"), _s(k), F.lit(" ")))
           .otherwise(F.concat(F.lit(f"{SOURCE}-"), _s(k))))
    # customers with a negative balance have no identity yet
    return (table(spark, sf_dir, "customer").where(F.col("c_acctbal") >= 0)
            .select(key.alias("sourceSystemId"),
                    F.md5(F.concat(F.lit("gid-"), _s(k))).alias("uuid")))


def deletion_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = customers(spark, sf_dir)
    upper = src.where(F.col("reference") == "BUILDING").select(
        F.upper(F.trim("email")).alias("email"))
    padded = src.where(F.col("level_up_id").isin("1", "2")).select(
        F.concat(F.trim("email"), F.lit(" ")).alias("email"))
    return upper.unionByName(padded)


def identity_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")

    def new(cond: Column) -> DataFrame:
        return c.where(cond).select(
            F.concat(F.lit(f"{SOURCE}-"), _s(k)).alias("sourceSystemId"),
            F.md5(F.concat(F.lit("new-"), _s(k))).alias("uuid"))

    bal = F.col("c_acctbal")
    return (identity_service(spark, sf_dir)
            .unionByName(new(bal < 0)).unionByName(new(bal < -500)))


ORACLE_RELATIONAL_CTES = f"""
src as (
 select cast(c_custkey as varchar) id,
  case when c_custkey % 17 = 0 then null
       when c_custkey % 13 = 0 then concat(' ', lower(replace(c_name, '#', '.')), '@example.com ')
       when c_custkey % 11 = 0 then concat(replace(c_name, '#', '.'), '@Example.com')
       else concat(lower(replace(c_name, '#', '.')), '@example.com') end email,
  '2020-01-01 00:00:00' created_at, '2020-06-01 00:00:00' updated_at,
  'Customer' first_name, substr(c_name, 10) last_name,
  concat('415', lpad(cast(c_custkey as varchar), 7, '0')) contact_number,
  c_mktsegment reference, case when c_acctbal > 0 then 't' else 'f' end is_rewards_user,
  'f' has_sent_feedback, 't' has_opted_in, cast(c_nationkey as varchar) level_up_id,
  '1990-01-01' birthday, 'f' has_sent_support, cast(null as varchar) rewards_started_at,
  '{{}}' settings, 't' use_credit, md5(c_name) tracking_uuid
 from customer),
idsvc as (
 select case when c_custkey % 5 = 0 then concat(' {SOURCE}-', cast(c_custkey as varchar), ' ')
             else concat('{SOURCE}-', cast(c_custkey as varchar)) end sourceSystemId,
        md5(concat('gid-', cast(c_custkey as varchar))) uuid
 from customer where c_acctbal >= 0),
dels as (
 select upper(trim(email)) email from src where reference = 'BUILDING'
 union all
 select trim(email) || ' ' email from src where level_up_id in ('1', '2')),
pairs as (
 select sourceSystemId, uuid from idsvc
 union all select concat('{SOURCE}-', cast(c_custkey as varchar)), md5(concat('new-', cast(c_custkey as varchar)))
           from customer where c_acctbal < 0
 union all select concat('{SOURCE}-', cast(c_custkey as varchar)), md5(concat('new-', cast(c_custkey as varchar)))
           from customer where c_acctbal < -500)
"""


def with_ctes(body: str) -> str:
    return f"with {ORACLE_RELATIONAL_CTES.strip()}\n{body}"


# ------------------------------------------------------------------ documents
# Documents are built from bounded key ranges (``*_BATCH``), so even a user
# or customer holding a third of all rows yields many bounded objects.
def _json(struct: Column, keep_nulls: bool = False) -> Column:
    return F.to_json(struct, {"ignoreNullFields": "false"} if keep_nulls else {})


def clickstream_docs(spark: SparkSession, sf_dir: str, props_name: str = L.PROPERTIES,
                     every_key: bool = False) -> DataFrame:
    """``every_key``: documents of a null user or event id have a key too (the id is ``''`` there, as in
    the oracles' keys), so that they can be stored."""
    e = table(spark, sf_dir, "events")

    def part(c: str) -> Column:
        return F.coalesce(_s(c), F.lit("")) if every_key else _s(c)

    batch = F.floor(F.col("event_id") / EVENT_BATCH)
    email = F.when(F.col("event_id") % 2 == 0,
                   F.concat(F.lit("user."), _s("user_id"), F.lit("@example.com")))
    item = F.struct(F.col("event_type").alias("event"),
                    F.struct("event_id", "value", "props", email.alias("email")).alias(props_name))
    return (e.groupBy("user_id", batch.alias("batch"))
            .agg(_json(F.struct(F.collect_list(item).alias(L.RESULTS))).alias("payload"))
            .select(F.concat(F.lit("click/user="), part("user_id"), F.lit("/batch="), part("batch"))
                    .alias("object_key"), "user_id", "batch", "payload"))


def chat_docs(spark: SparkSession, sf_dir: str, with_guest: bool = True,
              null_body: bool = False) -> DataFrame:
    c = table(spark, sf_dir, "conversations")
    batch = F.floor(F.col("turn") / TURN_BATCH)
    body = F.lit(None).cast("string") if null_body else F.col("text")
    msg = F.struct("turn", "role", body.alias(L.BODY))
    guest = F.struct(F.concat(F.lit("Guest "), _s("conv_id")).alias("name"),
                     (F.col("conv_id") % 2 == 0).alias("vip"))
    conv_fields = [F.col("conv_id")]
    if with_guest:
        conv_fields.append(guest.alias(L.GUEST))
    conv_fields.append(F.array_sort(F.collect_list(msg)).alias(L.MESSAGES))
    doc = F.struct(F.array(F.struct(F.struct(F.array(F.struct(*conv_fields)).alias(L.CONVERSATIONS))
                                    .alias(L.PAYLOAD))).alias(L.CHAT_ROOT))
    return (c.groupBy("conv_id", batch.alias("batch"))
            .agg(_json(doc, keep_nulls=null_body).alias("payload"))
            .select(F.concat(F.lit("chat/conv="), _s("conv_id"), F.lit("/batch="), _s("batch"))
                    .alias("object_key"), "conv_id", "batch", "payload"))


def order_docs(spark: SparkSession, sf_dir: str, null_server: bool = False) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer")
    k = F.col("o_orderkey")
    customername, tablename, _ = L.ORDER_KEYS
    server = (F.lit(None).cast(f"struct<id:bigint,{L.SERVER_NAME}:string>") if null_server else
              F.struct((k % 100).alias("id"),
                       F.concat(F.lit("Supplier#"), _s(k % 100)).alias(L.SERVER_NAME)))
    course = F.struct(F.col("c_name").alias(customername),
                      F.when(k % 3 == 0, F.col("o_orderpriority")).alias(tablename),
                      server.alias(L.SERVER), F.col("o_totalprice").alias("total"))
    entry = F.struct(k.alias("orderkey"),
                     F.when(k % 5 != 0, F.array(course)).alias(L.COURSES))
    batch = F.floor(k / ORDER_BATCH)
    joined = o.join(c, o["o_custkey"] == c["c_custkey"])
    docs = joined.groupBy("o_custkey", batch.alias("batch")).agg(
        F.collect_list(entry).alias(L.ORDERS_ROOT))
    # The null-server variant keeps explicit JSON nulls; it exists to be quarantined.
    payload = _json(F.struct(L.ORDERS_ROOT), keep_nulls=null_server)
    return docs.select(
        F.concat(F.lit("orders/cust="), _s("o_custkey"), F.lit("/batch="), _s("batch"))
        .alias("object_key"), "o_custkey", "batch", payload.alias("payload"))


def service_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    attrs = F.struct(
        F.array(F.struct(F.concat(F.lit("doc."), _s("doc_id"), F.lit("@example.com")).alias(L.EMAIL),
                         F.lit(True).alias("verified"))).alias(L.EMAILS),
        F.col("text").alias(L.PREVIEW),
        F.concat(F.lit("Author "), _s("doc_id")).alias("name"),
        F.col("lang").alias("lang"))
    full = F.to_json(F.struct(F.struct(F.col("doc_id").alias("id"), attrs.alias(L.ATTRIBUTES))
                              .alias(L.DATA)))
    head = f'{{"{L.SERVICE_ROOT}":["skipped string",{{"nodata":1}},'
    tail = f',{{"{L.DATA}":{{"id":-1,"{L.ATTRIBUTES}":{{"name":null,"lang":"xx"}}}}}}]}}'
    payload = F.concat(F.lit(head), full, F.lit(tail))
    return d.select(F.concat(F.lit("svc/doc="), _s("doc_id")).alias("object_key"),
                    "doc_id", payload.alias("payload"))


def page_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw web pages dropped into a JSON prefix: not JSON at all."""
    p = table(spark, sf_dir, "pages")
    return p.select(F.concat(F.lit("pages/page="), _s("page_id")).alias("object_key"),
                    F.col("html").alias("payload"))


ORACLE_DOC_KEYS = {
    "clickstream": f"concat('click/user=', cast(user_id as varchar), '/batch=', "
                   f"cast(event_id // {EVENT_BATCH} as varchar))",
    "chat": f"concat('chat/conv=', cast(conv_id as varchar), '/batch=', "
            f"cast(turn // {TURN_BATCH} as varchar))",
    "orders": f"concat('orders/cust=', cast(o_custkey as varchar), '/batch=', "
              f"cast(o_orderkey // {ORDER_BATCH} as varchar))",
    "service": "concat('svc/doc=', cast(doc_id as varchar))",
    "pages": "concat('pages/page=', cast(page_id as varchar))",
}
