import json

from shroud.operators import redact as RD

TOKEN = "(anonymized PII)"


def _run(spark, preset, docs, keys, strict=False):
    df = spark.createDataFrame([(str(i), d) for i, d in enumerate(docs)], "object_key string, payload string")
    out = RD.redact(df, preset, keys, strict=strict).orderBy("object_key").collect()
    return [(r["status"], r["reason"], json.loads(r["redacted"]) if r["redacted"] else None)
            for r in out]


def test_clickstream_sets_and_adds_keys_and_keeps_unknown(spark):
    doc = {"meta": {"v": [1, 2, {"z": None}]},
           "results": [{"event": "a", "$properties": {"email": "x@y.z", "k": 1.5}},
                       {"event": "b", "$properties": {}}]}
    [(status, reason, out)] = _run(spark, "clickstream", [json.dumps(doc)], "email,phone")
    assert status == "redacted" and reason is None
    assert out["meta"] == doc["meta"]
    assert out["results"][0]["$properties"] == {"email": "", "phone": "", "k": 1.5}
    assert out["results"][1]["$properties"] == {"email": "", "phone": ""}
    assert out["results"][0]["event"] == "a"


def test_repeated_key_keeps_its_last_value_in_any_session(spark):
    other = spark.newSession()
    other.conf.unset("spark.sql.variant.allowDuplicateKeys")
    doc = '{"results": [{"$properties": {"k": 1, "k": 2, "email": "x@y.z"}}], "a": 1, "a": 3}'
    [(status, reason, out)] = _run(other, "clickstream", [doc], "email")
    assert (status, reason) == ("redacted", None)
    assert out == {"results": [{"$properties": {"k": 2, "email": ""}}], "a": 3}


def test_chat_guest_and_bodies(spark):
    doc = {"yepchat": [{"payload": {"conversations": [
        {"guest": {"name": "Ann", "id": 7}, "messages": [{"body": "mail me at a@b.co", "t": 1},
                                                          {"body": "hello there"}]}]}, "x": 1}]}
    [(status, _, out)] = _run(spark, "chat", [json.dumps(doc)], ["name", "email"])
    assert status == "redacted"
    conv = out["yepchat"][0]["payload"]["conversations"][0]
    assert conv["guest"] == {"name": TOKEN, "email": TOKEN, "id": 7}
    assert [m["body"] for m in conv["messages"]] == ["mail me at (Anonymized PII)", "(Anonymized PII)"]
    assert conv["messages"][0]["t"] == 1 and out["yepchat"][0]["x"] == 1


def test_chat_quarantine_reasons(spark):
    no_guest = {"yepchat": [{"payload": {"conversations": [{"messages": []}]}}]}
    null_body = {"yepchat": [{"payload": {"conversations": [{"guest": {}, "messages": [{"body": None}]}]}}]}
    obj_body = {"yepchat": [{"payload": {"conversations": [{"guest": {}, "messages": [{"body": {"a": 1}}]}]}}]}
    res = _run(spark, "chat", [json.dumps(no_guest), json.dumps(null_body), json.dumps(obj_body),
                               "{oops", "[]", "{}"], ["name"])
    assert [r[1] for r in res] == ["bad_conversation", "bad_message_body", "bad_message_body",
                                   "unparseable_json", "missing_root_array", "missing_root_array"]
    assert all(r[0] == "quarantined" and r[2] is None for r in res)


def test_service_heterogeneous_array_and_null_keys(spark):
    doc = {"kustomer": ["a string", {"nodata": 1},
                        {"data": {"id": 1, "attributes": {"emails": [{"email": "a@b.c", "v": True}],
                                                          "preview": "hello there", "name": "Ann",
                                                          "other": 2}}},
                        {"data": {"attributes": {"name": None}}}]}
    [(status, _, out)] = _run(spark, "service", [json.dumps(doc)], "emails,preview,name,phone")
    assert status == "redacted"
    items = out["kustomer"]
    assert items[0] == "a string" and items[1] == {"nodata": 1}
    attrs = items[2]["data"]["attributes"]
    assert attrs["emails"] == [{"email": TOKEN, "v": True}]
    # parity: the JSON encoding (with quotes) is masked, so the name rule cannot fire
    assert attrs["preview"] == '"hello there"'
    assert attrs["name"] == TOKEN and attrs["other"] == 2 and "phone" not in attrs
    assert items[3]["data"]["attributes"] == {"name": None}
    [(_, _, strict)] = _run(spark, "service", [json.dumps(doc)], "preview", strict=True)
    assert strict["kustomer"][2]["data"]["attributes"]["preview"] == "(Anonymized PII)"


def test_service_bad_items(spark):
    bad = [{"kustomer": [1]}, {"kustomer": [{"data": None}]}, {"kustomer": [{"data": {}}]}]
    res = _run(spark, "service", [json.dumps(d) for d in bad], ["name"])
    assert [r[1] for r in res] == ["bad_item"] * 3


def test_orders_present_keys_only(spark):
    doc = {"qsr": [{"n": 1}, {"courses": [{"customername": None, "server": {"id": 3},
                                            "tablename": "T1", "x": "keep"},
                                           {"other": 1}]}]}
    [(status, _, out)] = _run(spark, "orders", [json.dumps(doc)],
                              "customername,tablename,server,ignored")
    assert status == "redacted"
    assert out["qsr"][0] == {"n": 1}
    c0, c1 = out["qsr"][1]["courses"]
    assert c0 == {"customername": TOKEN, "server": {"id": 3, "name": TOKEN},
                  "tablename": TOKEN, "x": "keep"}
    assert c1 == {"other": 1}


def test_orders_null_server_quarantined(spark):
    doc = {"qsr": [{"courses": [{"server": None}]}]}
    [(status, reason, _)] = _run(spark, "orders", [json.dumps(doc)], ["server"])
    assert (status, reason) == ("quarantined", "bad_course")


def test_in_equals_out_plus_quarantine(spark):
    docs = ['{"results":[]}', "nope", '{"results":[{"$properties":{}}]}', '{"results":[1]}']
    res = _run(spark, "clickstream", docs, ["email"])
    assert len(res) == 4
    assert sum(r[0] == "redacted" for r in res) + sum(r[0] == "quarantined" for r in res) == 4


def test_route():
    assert RD.route("adhoc_source1") == "clickstream"
    assert RD.route("source2") == "chat"
    assert RD.route("service") == "service"
    assert RD.route("x_source3") == "orders"
    import pytest
    with pytest.raises(ValueError):
        RD.route("nothing")


def test_repeated_key_keeps_last_value(spark):
    doc = '{"results":[{"$properties":{"n":1,"n":2,"email":"x"}}],"results_meta":1}'
    [(status, _, out)] = _run(spark, "clickstream", [doc], ["email"])
    assert status == "redacted"
    assert out["results"][0]["$properties"] == {"n": 2, "email": ""}


def test_root_key_override(spark):
    doc = {"chats": [{"payload": {"conversations": [{"guest": {"name": "A"},
                                                     "messages": [{"body": "hello there"}]}]}}]}
    df = spark.createDataFrame([("k", json.dumps(doc))], "object_key string, payload string")
    default = RD.redact(df, "chat", ["name"]).first()
    assert default["status"] == "quarantined" and default["reason"] == "missing_root_array"
    r = RD.redact(df, "chat", ["name"], root_key="chats").first()
    out = json.loads(r["redacted"])
    conv = out["chats"][0]["payload"]["conversations"][0]
    assert conv["guest"]["name"] == TOKEN and conv["messages"][0]["body"] == "(Anonymized PII)"


def test_a_document_over_the_limit_has_its_own_reason(spark, monkeypatch):
    from shroud.operators import redact as R

    monkeypatch.setattr(R, "LARGEST", 20)
    df = spark.createDataFrame([("{x" + "y" * 30,), ("{x",), ('{"results": []}' + " " * 30,)], "payload string")
    assert [r.reason for r in R.redact(df, "clickstream", ["email"]).collect()] == [
        "document_too_large", "unparseable_json", None]


def test_service_elements_are_typed_only_where_they_are_no_object(spark):
    """Texts stay, other scalars, arrays and nulls are refused, objects are never spelled out."""
    import json

    from shroud.operators import redact as R

    rows = [([{"data": {"attributes": {"name": "n", "deep": {"a": [1]}}}}, "text"], None), (["a"], None),
            ([1], "bad_item"), ([None], "bad_item"), ([[1]], "bad_item"), ([True], "bad_item"),
            ([{"data": 1}], "bad_item"), ([{"other": 1}], None), ([], None)]
    df = spark.createDataFrame([(json.dumps({R.SERVICE_ROOT: items}), i) for i, (items, _) in enumerate(rows)],
                               "payload string, n int")
    got = {r.n: r.reason for r in R.redact(df, "service", ["name"]).collect()}
    assert got == {i: want for i, (_, want) in enumerate(rows)}
