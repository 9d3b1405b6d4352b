"""The command line drives the same jobs (run in-process against the test session)."""

from shroud import cli
from shroud import fixtures as fx
from shroud.sinks import files as K
from shroud.sinks import objects as KO

SF = "/root/testdata/sf0.001"


def test_cli_deidentify_and_anonymize(spark, scratch, monkeypatch, capsys):
    base = scratch("cli")
    K.write_csv(fx.customers(spark, SF), f"{base}/staging/customers", sep=",")
    fx.identity_service(spark, SF).write.parquet(f"{base}/idsvc")
    KO.write_objects(fx.chat_docs(spark, SF), f"{base}/chat", gzip=True)
    # keep the shared test session alive
    monkeypatch.setattr(type(spark), "stop", lambda self: None)
    cli.main(["deidentify", "--customers", f"{base}/staging/customers", "--identity",
              f"{base}/idsvc", "--public-root", f"{base}/pub", "--secured-root", f"{base}/sec",
              "--audit-root", f"{base}/audit", "--format", "orc", "--dataset", "customers",
              "--as-of", "2024-01-01"])
    out = capsys.readouterr().out
    assert "public_rows" in out and "missing_identities" in out
    cli.main(["anonymize", "--in-root", f"{base}/chat", "--out-root", f"{base}/chat-out",
              "--quarantine", f"{base}/chat-q", "--source-type", "source2",
              "--pii-keys", "name,email", "--layout", "keyed"])
    out = capsys.readouterr().out
    assert "redacted_objects" in out


def test_cli_stream_once(spark, scratch, monkeypatch, capsys):
    from shroud.sources import objects as SO

    base = scratch("cli-stream")
    KO.write_objects(fx.chat_docs(spark, SF), f"{base}/in", gzip=True)
    monkeypatch.setattr(type(spark), "stop", lambda self: None)
    cli.main(["stream", "--in-root", f"{base}/in", "--out-root", f"{base}/out",
              "--quarantine", f"{base}/q", "--checkpoint", f"{base}/ck",
              "--source-type", "source2", "--pii-keys", "name,email", "--layout", "keyed"])
    n_in = SO.list_objects(spark, f"{base}/in", "keyed").count()
    assert SO.list_objects(spark, f"{base}/out").count() == n_in > 0
    assert "unaccounted objects (unreadable, skipped): 0" in capsys.readouterr().out


def test_cli_delete_and_append_identities(spark, scratch, monkeypatch, capsys):
    base = scratch("cli-del")
    K.write_tsv_gzip(fx.customers(spark, SF), f"{base}/customers")
    K.write_csv(fx.deletion_requests(spark, SF), f"{base}/requests", sep="\t")
    K.write_csv(fx.identity_pairs(spark, SF), f"{base}/pairs", sep="\t")
    fx.identity_service(spark, SF).write.parquet(f"{base}/idsvc")
    monkeypatch.setattr(type(spark), "stop", lambda self: None)
    cli.main(["delete", "--customers", f"{base}/customers", "--requests", f"{base}/requests/*",
              "--out-root", f"{base}/lake", "--format", "orc", "--as-of", "2024-01-01"])
    out = capsys.readouterr().out
    assert "kept_rows" in out and "deleted_rows" in out
    before = spark.read.parquet(f"{base}/idsvc").count()
    cli.main(["load-identities", "--pairs", f"{base}/pairs", "--identity", f"{base}/idsvc",
              "--append"])
    assert "appended_rows" in capsys.readouterr().out
    assert spark.read.parquet(f"{base}/idsvc").count() > before
