"""Randomised check of the four redaction presets against a plain-Python model.

Documents follow each source layout with random perturbations: missing
keys, JSON nulls, wrong types, strings inside arrays, extra keys.  The model
states the documented semantics directly and raises ``Lost`` wherever a
document cannot be processed (it must then be quarantined).  Spark's output
must be JSON-equal to the model's for every other document.
"""

import copy
import json
import os
import random
import re
import zlib

import pytest

from shroud.functions import text as T
from shroud.operators import redact as RD

KEY_TOKEN = T.KEY_TOKEN
_EMAIL = re.compile(T.EMAIL_PATTERN, re.ASCII)
_PHONE = re.compile(T.PHONE_PATTERN, re.ASCII)
_NAME = re.compile(T.NAME_PATTERN, re.ASCII)


class Lost(Exception):
    pass


def mask(s: str) -> str:
    return _NAME.sub(T.TEXT_TOKEN, _PHONE.sub(T.TEXT_TOKEN, _EMAIL.sub(T.TEXT_TOKEN, s)))


def obj(v):
    if not isinstance(v, dict):
        raise Lost("not an object")
    return v


def arr(v):
    if not isinstance(v, list):
        raise Lost("not an array")
    return v


def as_text(v):
    if v is None or isinstance(v, (dict, list)):
        raise Lost("not a scalar")
    if isinstance(v, bool):
        return "true" if v else "false"
    return v if isinstance(v, str) else json.dumps(v)


def model(preset, doc, keys):
    d = copy.deepcopy(doc)
    root = obj(d)
    if preset == "clickstream":
        for e in arr(root.get("results")):
            if keys:
                props = obj(obj(e).get("$properties"))
                for k in keys:
                    props[k] = ""
    elif preset == "chat":
        for m in arr(root.get("yepchat")):
            for c in arr(obj(obj(m).get("payload")).get("conversations")):
                c = obj(c)
                if keys:
                    g = obj(c.get("guest"))
                    for k in keys:
                        g[k] = KEY_TOKEN
                for msg in arr(c.get("messages")):
                    msg = obj(msg)
                    msg["body"] = mask(as_text(msg.get("body")))
    elif preset == "service":
        for y in arr(root.get("kustomer")):
            if isinstance(y, str):
                continue
            y = obj(y)
            if "data" not in y:
                continue
            att = obj(obj(y["data"]).get("attributes"))
            for k in keys:
                if k in att and att[k] is not None:
                    if k == "emails":
                        for e in arr(att[k]):
                            obj(e)["email"] = KEY_TOKEN
                    elif k == "preview":
                        att[k] = mask(json.dumps(att[k], ensure_ascii=False))
                    else:
                        att[k] = KEY_TOKEN
    elif preset == "orders":
        for p in arr(root.get("qsr")):
            p = obj(p)
            if "courses" not in p:
                continue
            for x in arr(p["courses"]):
                x = obj(x)
                for k in keys:
                    if k in ("customername", "tablename") and k in x:
                        x[k] = KEY_TOKEN
                    elif k == "server" and k in x:
                        obj(x["server"])["name"] = KEY_TOKEN
    return d


# ------------------------------------------------------------------ generator
TEXTS = ["hello there", "mail a.b@c.io now", "call 415-555-1234", "x", "", "é ok!", 'say "hi"',
         "tab\there", "line\nbreak", "(415)555-1234", "order 123456789012"]


def maybe(rng, value, p=0.08):
    """The value, or a perturbation of it."""
    r = rng.random()
    if r < p:
        return rng.choice([None, 1, "s", [], {}, True])
    return value


def extra(rng, d):
    if rng.random() < 0.3:
        d["extra_" + str(rng.randint(0, 9))] = rng.choice([1, 2.5, "v", None, [1, {"a": None}]])
    return d


def drop(rng, d, key, p=0.06):
    if rng.random() < p:
        d.pop(key, None)
    return d


def gen(rng, preset):
    n = rng.randint(0, 3)
    if preset == "clickstream":
        items = [maybe(rng, extra(rng, drop(rng, {"event": "e", "$properties": maybe(rng, extra(
            rng, {"email": rng.choice(["a@b.c", None]), "v": rng.randint(0, 9)}))}, "$properties")))
                 for _ in range(n)]
        return extra(rng, drop(rng, {"results": maybe(rng, items)}, "results"))
    if preset == "chat":
        def conv():
            c = {"guest": maybe(rng, extra(rng, {"name": "G", "vip": rng.random() < 0.5})),
                 "messages": maybe(rng, [maybe(rng, drop(rng, extra(rng, {"body": maybe(
                     rng, rng.choice(TEXTS), 0.1), "turn": i}), "body"))
                     for i in range(rng.randint(0, 3))])}
            return maybe(rng, extra(rng, drop(rng, drop(rng, c, "guest"), "messages")))
        top = [maybe(rng, drop(rng, {"payload": maybe(rng, drop(rng, {"conversations": maybe(
            rng, [conv() for _ in range(rng.randint(0, 2))])}, "conversations"))}, "payload"))
               for _ in range(n)]
        return extra(rng, drop(rng, {"yepchat": maybe(rng, top)}, "yepchat"))
    if preset == "service":
        def item():
            r = rng.random()
            if r < 0.15:
                return "a string"
            if r < 0.25:
                return {"nodata": 1}
            attrs = {"emails": maybe(rng, [maybe(rng, {"email": "a@b.c", "v": True})
                                           for _ in range(rng.randint(0, 2))]),
                     "preview": maybe(rng, rng.choice(TEXTS)),
                     "name": rng.choice(["Ann", None, 7]), "lang": "en"}
            for k in ("emails", "preview", "name"):
                drop(rng, attrs, k, 0.2)
            return maybe(rng, {"data": maybe(rng, drop(rng, {"id": 1, "attributes": maybe(
                rng, extra(rng, attrs))}, "attributes"))})
        return extra(rng, drop(rng, {"kustomer": maybe(rng, [item() for _ in range(n)])},
                               "kustomer"))
    if preset == "orders":
        def course():
            c = {"customername": rng.choice(["C", None]), "tablename": "T",
                 "server": maybe(rng, {"id": 1, "name": "S"}), "total": 1.5}
            for k in ("customername", "tablename", "server"):
                drop(rng, c, k, 0.25)
            return maybe(rng, extra(rng, c))
        entries = [maybe(rng, drop(rng, {"orderkey": i, "courses": maybe(
            rng, [course() for _ in range(rng.randint(0, 2))])}, "courses", 0.3))
                   for i in range(n)]
        return extra(rng, drop(rng, {"qsr": maybe(rng, entries)}, "qsr"))
    raise ValueError(preset)


KEYS = {"clickstream": ["email", "phone"], "chat": ["name", "email"],
        "service": ["emails", "preview", "name", "phone"],
        "orders": ["customername", "tablename", "server", "ignored"]}


SEED = int(os.environ.get("SHROUD_MODEL_SEED", "0"))


@pytest.mark.parametrize("preset", sorted(KEYS))
def test_presets_match_model(spark, preset):
    rng = random.Random(zlib.crc32(preset.encode()) + SEED)
    docs = [gen(rng, preset) for _ in range(400)]
    df = spark.createDataFrame([(str(i), json.dumps(d, ensure_ascii=False))
                                for i, d in enumerate(docs)], "object_key string, payload string")
    got = {r["object_key"]: r for r in RD.redact(df, preset, KEYS[preset]).collect()}
    kept = lost = 0
    for i, d in enumerate(docs):
        r = got[str(i)]
        try:
            want = model(preset, d, KEYS[preset])
        except Lost:
            lost += 1
            assert r["status"] == "quarantined", (d, r["redacted"])
            continue
        kept += 1
        assert r["status"] == "redacted", (d, r["reason"])
        assert json.loads(r["redacted"]) == want, (d, r["redacted"], want)
    assert kept > 50 and lost > 20
