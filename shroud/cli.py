"""Command line: the four jobs and the incremental stream, with the arguments their operators know.

    python -m shroud deidentify --customers s3a://.../customers/ --identity s3a://.../idsvc/ \
        --public-root ... --secured-root ... --audit-root ... --format orc --dataset customers
    python -m shroud delete --customers ... --requests '.../requests/*' --out-root ... --format gzip
    python -m shroud load-identities --pairs ... --identity ... (--append | --out ...)
    python -m shroud stream --in-root ... --out-root ... --quarantine ... --checkpoint ... \
        --source-type source2 --pii-keys name,email [--every "5 minutes"]
    python -m shroud anonymize --in-root ... --out-root ... --quarantine ... \
        --source-type source2 --pii-keys name,email

Each prints the job's metrics table; purge manifests are printed as a
summary and applied only with ``--apply-purge``.
"""

from __future__ import annotations

import argparse
import datetime as dt

from .plans import jobs
from .session import build_session
from .sinks import manifest
from .sources import identity_service, tables


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="shroud")
    p.add_argument("--master", default=None)
    sub = p.add_subparsers(dest="cmd", required=True)

    d = sub.add_parser("deidentify", help="de-identified and secured copies plus audit")
    d.add_argument("--customers", required=True)
    d.add_argument("--customers-kind", default="csv", choices=["csv", "tsv"])
    d.add_argument("--identity", required=True)
    d.add_argument("--identity-format", default="parquet")
    d.add_argument("--public-root", required=True)
    d.add_argument("--secured-root", required=True)
    d.add_argument("--audit-root", required=True)
    d.add_argument("--format", required=True, choices=["orc", "gzip"])
    d.add_argument("--dataset", required=True)
    d.add_argument("--source", default="app")
    d.add_argument("--as-of", default=None)
    d.add_argument("--staging-root", default=None)
    d.add_argument("--staging-prefixes", default="")
    d.add_argument("--expected-identity-rows", type=int, default=None)
    d.add_argument("--multiline", action="store_true",
                   help="the export has line breaks inside quotes")
    d.add_argument("--apply-purge", action="store_true",
                   help="delete the staging files that this run has read")

    x = sub.add_parser("delete", help="new version without the requested customers")
    x.add_argument("--customers", required=True)
    x.add_argument("--requests", required=True)
    x.add_argument("--out-root", required=True)
    x.add_argument("--format", required=True, choices=["orc", "gzip"])
    x.add_argument("--as-of", default=dt.date.today().isoformat())
    x.add_argument("--strict", action="store_true")
    x.add_argument("--input-is-distinct", action="store_true",
                   help="skip the DISTINCT for inputs without duplicate rows")
    x.add_argument("--single-line", action="store_true",
                   help="the customers have no line break inside quotes, so files can be split")
    x.add_argument("--apply-purge", action="store_true")

    w = sub.add_parser("load-identities", help="add new identity pairs")
    w.add_argument("--pairs", required=True)
    w.add_argument("--sep", default="\t")
    w.add_argument("--identity", required=True)
    w.add_argument("--identity-format", default="parquet")
    w.add_argument("--out", default=None, help="write the upserted table as a new version")
    w.add_argument("--append", action="store_true",
                   help="append only the new pairs to the --identity table")

    a = sub.add_parser("anonymize", help="redact every JSON object under a prefix")
    a.add_argument("--in-root", required=True)
    a.add_argument("--out-root", required=True)
    a.add_argument("--quarantine", required=True)
    a.add_argument("--source-type", required=True)
    a.add_argument("--pii-keys", required=True)
    a.add_argument("--layout", default="files", choices=["files", "keyed"])
    a.add_argument("--strict", action="store_true")
    a.add_argument("--run-id", default=None, help="names this run's quarantine folder")
    a.add_argument("--root-key", default=None,
                   help="root array key when a source uses another name than the preset")

    a.add_argument("--apply-purge", action="store_true",
                   help="delete the input objects whose redacted copy is on storage")

    st = sub.add_parser("stream", help="incremental redaction of new objects into objects")
    st.add_argument("--in-root", required=True)
    st.add_argument("--out-root", required=True)
    st.add_argument("--quarantine", required=True)
    st.add_argument("--checkpoint", required=True)
    st.add_argument("--source-type", required=True)
    st.add_argument("--pii-keys", required=True)
    st.add_argument("--layout", default="files", choices=["files", "keyed"])
    st.add_argument("--strict", action="store_true")
    st.add_argument("--root-key", default=None)
    for x in (d, x, a):
        x.add_argument("--purge-log", default=None,
                       help="folder of the purge's log; the same folder resumes a purge that was cut off")
    for x in (a, st):
        x.add_argument("--out-layout", default="files", choices=["files", "keyed"],
                       help="files: each object at its exact key, put by the executors")
    a.add_argument("--refuse-hidden", action="store_true",
                   help="stop where names begin with _ or . instead of reading such objects")
    st.add_argument("--max-files-per-trigger", type=int, default=None,
                    help="at most so many new objects in a micro-batch")
    st.add_argument("--every", default=None,
                    help="keep running with this trigger interval (e.g. '5 minutes'); "
                         "default: process what is there and stop")
    return p


def main(argv: list[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    spark = build_session(args.master)
    if args.cmd == "deidentify":
        res = jobs.deidentify_job(
            spark, jobs.read_customers(spark, args.customers, args.customers_kind, args.multiline),
            lambda: identity_service.read_identity_table(spark, args.identity,
                                                         args.identity_format),
            public_root=args.public_root, secured_root=args.secured_root,
            audit_root=args.audit_root, fmt=args.format, dataset=args.dataset,
            source=args.source, as_of=args.as_of, staging_root=args.staging_root,
            staging_prefixes=[s for s in args.staging_prefixes.split(",") if s],
            expected_identity_rows=args.expected_identity_rows)
    elif args.cmd == "delete":
        res = jobs.deletion_job(spark, tables.read_customers_tsv(spark, args.customers,
                                                                 multiline=not args.single_line),
                                tables.read_deletion_requests(spark, args.requests),
                                out_root=args.out_root, fmt=args.format, as_of=args.as_of,
                                strict=args.strict, input_is_distinct=args.input_is_distinct)
    elif args.cmd == "load-identities":
        res = jobs.identity_load_job(
            spark, tables.read_identity_pairs(spark, args.pairs, args.sep),
            identity_service.read_identity_table(spark, args.identity, args.identity_format),
            out_path=None if args.append else args.out,
            append_to=args.identity if args.append else None, fmt=args.identity_format)
    elif args.cmd == "stream":
        from .streaming.redact_stream import start_redact_stream_to_objects
        q = start_redact_stream_to_objects(
            spark, args.in_root, args.out_root, args.quarantine, args.checkpoint,
            args.source_type, args.pii_keys, layout=args.layout, strict=args.strict,
            available_now=args.every is None, processing_time=args.every,
            root_key=args.root_key, max_files_per_trigger=args.max_files_per_trigger,
            out_layout=args.out_layout)
        q.awaitTermination()
        print(q.lastProgress)
        if args.every is None:
            from .streaming.redact_stream import accounted_for_objects, unaccounted_objects
            acc = accounted_for_objects(spark, args.out_root, args.quarantine, args.out_layout)
            missing = unaccounted_objects(spark, args.in_root, acc, args.layout)
            print(f"unaccounted objects (unreadable, skipped): {missing.count()}")
            missing.show(20, truncate=False)
        spark.stop()
        return
    else:
        res = jobs.json_anonymize_job(spark, args.in_root, args.out_root, args.quarantine,
                                      args.source_type, args.pii_keys, layout=args.layout,
                                      strict=args.strict, run_id=args.run_id,
                                      root_key=args.root_key, out_layout=args.out_layout,
                                      refuse_hidden=args.refuse_hidden)
    res.metrics.show(truncate=False)
    if res.manifest is not None and "relative_path" in res.manifest.columns:
        manifest.manifest_folders(res.manifest, 2).show(truncate=False)
        if args.apply_purge:
            for status, n in manifest.purge(spark, res.manifest, args.purge_log).items():
                print(f"{status} files: {n}")
    spark.stop()


if __name__ == "__main__":
    main()
