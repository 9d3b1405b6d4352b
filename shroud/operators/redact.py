"""Redaction of PII inside nested JSON documents, one document per row.

Each preset compiles to native expressions (variant parsing, ``transform``,
``map_filter``/``map_concat``, ``transform_values``, ``regexp_replace``) and
runs inside the executors' JVM (higher-order functions are interpreted
there); there is no Python UDF.  A document that cannot be parsed, or whose addressed parts do not have the
required shape, is never dropped: it goes to the quarantine output with a
reason, and ``in = redacted + quarantined`` holds row for row.

Presets (paths are relative to the document root; ``[*]`` is every element):

* ``clickstream``: ``results[*].$properties``: each PII key is set to ``""``,
  added when absent.
* ``chat``: ``yepchat[*].payload.conversations[*]``: ``guest.<key>`` is set
  to the key token (added when absent); every ``messages[*].body`` is masked
  as free text.
* ``service``: ``kustomer[*]``: JSON strings are skipped, objects without
  ``data`` are kept; in ``data.attributes`` each PII key that is present and
  not null is replaced: ``emails[*].email`` with the token, ``preview``
  masked as free text, any other key with the token.
* ``orders``: ``qsr[*].courses[*]``: ``customername`` and ``tablename`` are
  replaced when present (null included), ``server.name`` is set when
  ``server`` is present; other PII keys are ignored.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import variant as V
from ..functions.text import KEY_TOKEN, mask_text

# ---------------------------------------------------------------------------
# The document layouts of the four sources (paths and key names
# exactly as the producing systems write them), the keys the order-events
# layout can redact, and the source-type markers of the legacy routing.
RESULTS, PROPERTIES = "results", "$properties"
CHAT_ROOT, PAYLOAD, CONVERSATIONS, GUEST, MESSAGES, BODY = (
    "yepchat", "payload", "conversations", "guest", "messages", "body")
SERVICE_ROOT, DATA, ATTRIBUTES, EMAILS, EMAIL, PREVIEW = (
    "kustomer", "data", "attributes", "emails", "email", "preview")
ORDERS_ROOT, COURSES, SERVER, SERVER_NAME = "qsr", "courses", "server", "name"
ORDER_KEYS = ("customername", "tablename", "server")
SOURCE_MARKERS = (("source1", "clickstream"), ("source2", "chat"), ("source3", "orders"))
# ---------------------------------------------------------------------------

# Checks are (reason, condition that must hold); the first failing one names
# the quarantine reason.
Check = tuple[str, Column]
Compiled = tuple[Column, list[Check]]


def _all(arr: Column, pred: Callable[[Column], Column]) -> Column:
    return F.coalesce(F.forall(arr, pred), F.lit(False))


# --------------------------------------------------------------- clickstream
def clickstream(doc: Column, keys: list[str], strict: bool = False,
                root_key: str = RESULTS) -> Compiled:
    root = V.as_object(doc)
    results = V.as_array(V.field(root, root_key))
    checks: list[Check] = [("missing_root_array", results.isNotNull())]
    if not keys:
        return V.pack(root), checks

    def props(e: Column) -> Column:
        return V.as_object(V.field(V.as_object(e), PROPERTIES))

    def fix(e: Column) -> Column:
        blanked = V.put_many(props(e), [(k, V.text("")) for k in keys])
        return V.pack(V.put(V.as_object(e), PROPERTIES, V.pack(blanked)))

    checks.append(("missing_properties", _all(results, lambda e: props(e).isNotNull())))
    return V.pack(V.put(root, root_key, V.pack(F.transform(results, fix)))), checks


# ---------------------------------------------------------------------- chat
def chat(doc: Column, keys: list[str], strict: bool = False,
         root_key: str = CHAT_ROOT) -> Compiled:
    root = V.as_object(doc)
    top = V.as_array(V.field(root, root_key))

    def convs(m: Column) -> Column:
        return V.as_array(V.field(V.as_object(V.field(V.as_object(m), PAYLOAD)), CONVERSATIONS))

    def guest(c: Column) -> Column:
        return V.as_object(V.field(V.as_object(c), GUEST))

    def messages(c: Column) -> Column:
        return V.as_array(V.field(V.as_object(c), MESSAGES))

    def body(msg: Column) -> Column:
        return V.field(V.as_object(msg), BODY)

    def conv_ok(c: Column) -> Column:
        ok = V.as_object(c).isNotNull() & messages(c).isNotNull()
        if keys:
            ok = ok & guest(c).isNotNull()
        return ok

    checks: list[Check] = [
        ("missing_root_array", top.isNotNull()),
        ("missing_conversations", _all(top, lambda m: convs(m).isNotNull())),
        ("bad_conversation", _all(top, lambda m: _all(convs(m), conv_ok))),
        ("bad_message_body", _all(top, lambda m: _all(
            convs(m), lambda c: _all(messages(c), lambda msg: V.is_scalar(body(msg)))))),
    ]

    def fix_msg(msg: Column) -> Column:
        return V.pack(V.put(V.as_object(msg), BODY, V.text(mask_text(V.as_string(body(msg))))))

    def fix_conv(c: Column) -> Column:
        updates = [(MESSAGES, V.pack(F.transform(messages(c), fix_msg)))]
        if keys:
            updates.insert(0, (GUEST, V.pack(V.put_many(
                guest(c), [(k, V.text(KEY_TOKEN)) for k in keys]))))
        return V.pack(V.put_many(V.as_object(c), updates))

    def fix_top(m: Column) -> Column:
        mo = V.as_object(m)
        payload = V.as_object(V.field(mo, PAYLOAD))
        new_payload = V.put(payload, CONVERSATIONS, V.pack(F.transform(convs(m), fix_conv)))
        return V.pack(V.put(mo, PAYLOAD, V.pack(new_payload)))

    return V.pack(V.put(root, root_key, V.pack(F.transform(top, fix_top)))), checks


# ------------------------------------------------------------------- service
def service(doc: Column, keys: list[str], strict: bool = False,
            root_key: str = SERVICE_ROOT) -> Compiled:
    root = V.as_object(doc)
    items = V.as_array(V.field(root, root_key))

    def is_text(y: Column) -> Column:
        return V.kind(y) == "STRING"

    def data(y: Column) -> Column:
        return V.as_object(V.field(V.as_object(y), DATA))

    def attributes(y: Column) -> Column:
        return V.as_object(V.field(data(y), ATTRIBUTES))

    def has_data(y: Column) -> Column:
        return V.has(V.as_object(y), DATA)

    def emails_ok(y: Column) -> Column:
        em = V.field(attributes(y), EMAILS)
        present = em.isNotNull() & ~F.is_variant_null(em)
        return ~present | _all(V.as_array(em), lambda e: V.as_object(e).isNotNull())

    def item_ok(y: Column) -> Column:
        shaped = ~has_data(y) | attributes(y).isNotNull()
        if EMAILS in keys:
            shaped = shaped & (~has_data(y) | emails_ok(y))
        # only what is no object is asked for its type, which spells out a whole schema
        return F.when(V.as_object(y).isNotNull(), shaped).otherwise(is_text(y))

    checks: list[Check] = [("missing_root_array", items.isNotNull())]
    if not keys:
        return V.pack(root), checks
    checks.append(("bad_item", _all(items, item_ok)))

    def new_value(k: Column, v: Column) -> Column:
        live = ~F.is_variant_null(v)
        preview_src = V.as_string(v) if strict else F.to_json(v)
        out = F.when(live & (k == EMAILS) & F.lit(EMAILS in keys), V.pack(F.transform(
            V.as_array(v), lambda e: V.pack(V.put(V.as_object(e), EMAIL, V.text(KEY_TOKEN))))))
        out = out.when(live & (k == PREVIEW) & F.lit(PREVIEW in keys),
                       V.text(mask_text(preview_src)))
        others = [x for x in keys if x not in (EMAILS, PREVIEW)]
        if others:
            out = out.when(live & k.isin(others), V.text(KEY_TOKEN))
        return out.otherwise(v)

    def fix(y: Column) -> Column:
        yo = V.as_object(y)
        d = data(y)
        new_attrs = F.transform_values(attributes(y), new_value)
        rewritten = V.pack(V.put(yo, DATA, V.pack(V.put(d, ATTRIBUTES, V.pack(new_attrs)))))
        # a text has no ``data`` either
        return F.when(has_data(y), rewritten).otherwise(y)

    return V.pack(V.put(root, root_key, V.pack(F.transform(items, fix)))), checks


# -------------------------------------------------------------------- orders


def orders(doc: Column, keys: list[str], strict: bool = False,
           root_key: str = ORDERS_ROOT) -> Compiled:
    root = V.as_object(doc)
    qsr = V.as_array(V.field(root, root_key))
    used = [k for k in keys if k in ORDER_KEYS]
    plain = [k for k in used if k != SERVER]

    def has_courses(p: Column) -> Column:
        return V.has(V.as_object(p), COURSES)

    def courses(p: Column) -> Column:
        return V.as_array(V.field(V.as_object(p), COURSES))

    def course_ok(x: Column) -> Column:
        xo = V.as_object(x)
        ok = xo.isNotNull()
        if SERVER in used:
            ok = ok & (~V.has(xo, SERVER) | V.as_object(V.field(xo, SERVER)).isNotNull())
        return ok

    def entry_ok(p: Column) -> Column:
        return V.as_object(p).isNotNull() & (
            ~has_courses(p) | (courses(p).isNotNull() & _all(courses(p), course_ok)))

    checks: list[Check] = [("missing_root_array", qsr.isNotNull()),
                           ("bad_course", _all(qsr, entry_ok))]

    def new_value(k: Column, v: Column) -> Column:
        out = None
        if plain:
            out = F.when(k.isin(plain), V.text(KEY_TOKEN))
        if SERVER in used:
            srv = V.pack(V.put(V.as_object(v), SERVER_NAME, V.text(KEY_TOKEN)))
            out = F.when(k == SERVER, srv) if out is None else out.when(k == SERVER, srv)
        return v if out is None else out.otherwise(v)

    def fix_course(x: Column) -> Column:
        return V.pack(F.transform_values(V.as_object(x), new_value))

    def fix_entry(p: Column) -> Column:
        po = V.as_object(p)
        rewritten = V.pack(V.put(po, COURSES, V.pack(F.transform(courses(p), fix_course))))
        return F.when(has_courses(p), rewritten).otherwise(p)

    if not used:
        return V.pack(root), checks
    return V.pack(V.put(root, root_key, V.pack(F.transform(qsr, fix_entry)))), checks


# ------------------------------------------------------------------- presets
@dataclass(frozen=True)
class Preset:
    name: str
    compile: Callable[..., Compiled]
    gzip: bool


PRESETS: dict[str, Preset] = {
    "clickstream": Preset("clickstream", clickstream, gzip=False),
    "chat": Preset("chat", chat, gzip=True),
    "service": Preset("service", service, gzip=True),
    "orders": Preset("orders", orders, gzip=True),
}


#: Bytes of a document beyond which Spark has no VARIANT of it (fixed value of Spark 4.1).
LARGEST = 128 << 20


def redact(df: DataFrame, preset: str, pii_keys: list[str] | str,
           payload_col: str = "payload", strict: bool = False,
           root_key: str | None = None) -> DataFrame:
    """Add ``status`` ('redacted' / 'quarantined'), ``reason`` and
    ``redacted`` (JSON text, NULL when quarantined) to every row of ``df``.

    ``root_key`` overrides the preset's root array key for a source that
    exports the same layout under another name."""
    if isinstance(pii_keys, str):
        pii_keys = pii_keys.split(",")
    keys = V.unique(pii_keys)
    p = PRESETS[preset]
    V.last_key_wins(df.sparkSession)
    parsed = df.withColumn("__doc", V.parse(payload_col))
    doc = F.col("__doc")
    if root_key:
        out_doc, checks = p.compile(doc, keys, strict, root_key=root_key)
    else:
        out_doc, checks = p.compile(doc, keys, strict)
    reason = F.when(doc.isNull() & (F.octet_length(payload_col) > LARGEST), F.lit("document_too_large"))
    reason = reason.when(doc.isNull(), F.lit("unparseable_json"))
    for name, ok in checks:
        reason = reason.when(~ok, F.lit(name))
    reason = reason.otherwise(F.lit(None).cast("string"))
    # The one-element generator keeps the optimiser from pushing a filter on
    # ``reason`` or ``status`` below it, which would parse and check every
    # document a second time; the filter meets a finished value instead, and
    # only documents that pass are written out.
    return (parsed.withColumn("reason", F.explode(F.array(reason)))
            .withColumn("status", F.when(F.col("reason").isNull(), "redacted")
                        .otherwise("quarantined"))
            .withColumn("redacted", F.when(F.col("reason").isNull(), F.to_json(out_doc)))
            .drop("__doc"))


def redacted_only(df: DataFrame) -> DataFrame:
    return df.where(F.col("status") == "redacted")


def quarantined_only(df: DataFrame) -> DataFrame:
    return df.where(F.col("status") == "quarantined")


def route(source_type: str) -> str:
    """Preset for a source-type name: an exact preset name, or the legacy
    numbered names where 'source1' is clickstream, 'source2' chat and
    'source3' order events.  Unknown names raise instead of doing nothing."""
    if source_type in PRESETS:
        return source_type
    for marker, preset in SOURCE_MARKERS:
        if marker in source_type:
            return preset
    raise ValueError(f"unknown source type {source_type!r}; known: {sorted(PRESETS)}")
