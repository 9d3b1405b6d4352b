"""End-to-end jobs: de-identify, apply deletions, load identities, anonymise JSON.

Every job writes its outputs, reads back what it wrote and compares row
counts before it produces a purge manifest.  Errors propagate; nothing is
deleted implicitly (``sinks.manifest.apply_purge`` is a separate call).

Counts come from ``DataFrame.observe`` on the frames being written (result
stages, counted once per successful task) or from metadata listings; input
counts observed before a shuffle are reported but never used to gate a purge.
Very large object prefixes are best processed in slices (one sub-prefix per
run, or the streaming job with ``maxFilesPerTrigger``), because a file
source plans all of its files on the driver.
"""

from __future__ import annotations

import re
import time
import uuid
from dataclasses import dataclass, field
from urllib.parse import unquote

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..operators import audit, deletion, identity, redact
from ..operators.metrics import content, count_rows, counted, marked, metrics_frame, observed, seen
from ..session import path_exists, remove_path, scratch_path
from ..sinks import files, manifest, objects
from ..sources import objects as obj_src
from ..sources import tables
from ..sources.object_store import found as found_objects


# Fixed value: folder-name prefix of a deletion run's new version.
VERSION_PREFIX = "deleteOverwrite_"


class VerificationError(RuntimeError):
    """Output does not reconcile with its input; nothing may be purged."""


@dataclass
class JobResult:
    metrics: DataFrame
    values: dict[str, int]
    manifest: DataFrame | None = None
    outputs: dict[str, str] = field(default_factory=dict)


def _check(cond: bool, msg: str) -> None:
    if not cond:
        raise VerificationError(msg)


def _written(spark: SparkSession, path: str, fmt: str, schema, whole: bool) -> tuple:
    """Rows found in a written output, for comparison with those observed while writing it, and with
    ``whole`` the checksums of their content (else ORC tells the number from file metadata)."""
    out = files.read_by_format(spark, path, fmt, schema)
    return content(out, blank_is_null=fmt == "gzip") if whole else (count_rows({"n": out})["n"],)


def _read_files(spark: SparkSession, listing: DataFrame, read: DataFrame) -> DataFrame:
    """The rows of a listing whose file ``read`` scans: a file that arrived
    after the read was planned is in no output and must not be purged."""
    names = spark.createDataFrame([(f,) for f in read.inputFiles()], "uri string")
    plain = lambda c: F.regexp_replace(c, r"^file:/+", "file:/")
    names = names.select(plain(obj_src.decode_uri(F.col("uri"))).alias("__file"))
    return listing.join(names, plain(F.col("path")) == F.col("__file"), "left_semi")


def wait_for_complete_lookup(read_lookup, expected_rows: int, attempts: int = 3,
                             wait_seconds: float = 5.0) -> DataFrame:
    """Re-read the identity service until it holds ``expected_rows`` rows,
    a bounded number of times, then fail (instead of looping forever)."""
    for i in range(attempts):
        df = read_lookup()
        got = count_rows({"n": df})["n"]
        if got >= expected_rows:
            return df
        if i + 1 < attempts:
            time.sleep(wait_seconds)
    raise VerificationError(f"identity service incomplete: {got} of {expected_rows} rows")


# ---------------------------------------------------------------- de-identify
def deidentify_job(spark: SparkSession, customers: DataFrame, idsvc, *,
                   public_root: str, secured_root: str, audit_root: str, fmt: str,
                   dataset: str, source: str, as_of: str | None = None,
                   staging_root: str | None = None,
                   staging_prefixes: list[str] | None = None,
                   expected_identity_rows: int | None = None, verify_content: bool = True) -> JobResult:
    """Public (de-identified) and secured copies, audit refresh, staging manifest.

    What was written is read back and compared by number of rows and by an order-free checksum of
    their content (``verify_content=False``: by their number only).

    ``idsvc`` is the identity table, or a function that reads it; with
    ``expected_identity_rows`` the function is called until the snapshot is
    complete (a bounded number of times, then the job fails)."""
    if callable(idsvc):
        idsvc = (wait_for_complete_lookup(idsvc, expected_identity_rows)
                 if expected_identity_rows is not None else idsvc())
    public_path = f"{public_root}/{fmt}/{dataset}"
    secured_path = f"{secured_root}/{fmt}/{dataset}"
    # One join serves all three outputs.  Its result is written as a table in
    # the shared checkpoint folder: that cuts the lineage (a lost executor
    # re-reads it instead of re-running the join) and lets each output read
    # only its own columns.
    joined_path = scratch_path(spark, f"deidentify-{dataset}")
    try:
        src, src_obs = counted(customers, "source")
        distinct_obs = Observation("distinct_source")
        joined, joined_obs = marked(
            identity.join_identities(src, idsvc, source, distinct_rows=distinct_obs), "joined")
        joined.write.mode("overwrite").parquet(joined_path)
        # written rows against the rows on storage: a scratch folder that
        # executors do not share, or a lost part, must not pass unnoticed
        wrote = seen(joined_obs, joined)
        joined = spark.read.schema(joined.schema).parquet(joined_path)
        found = count_rows({"n": joined})["n"]
        _check(found == wrote[0], f"scratch table: {found} rows of {wrote[0]}")
        if verify_content:
            found = content(joined)
            _check(found == wrote, f"scratch table: {found} of {wrote}")
        blank = fmt == "gzip"  # reads '' back as NULL
        public, pub_obs = marked(identity.deidentified_from(joined, as_of), "public", blank)
        secured, sec_obs = marked(identity.secured_from(joined, as_of), "secured", blank)
        missing, aud_obs = counted(identity.missing_from(joined, source, as_of), "audit")
        files.write_by_format(public, public_path, fmt)
        files.write_by_format(secured, secured_path, fmt)
        audit.refresh_audit(missing, audit_root, source)
        made = {"public": seen(pub_obs, public, blank), "secured": seen(sec_obs, secured, blank)}
        values = {"source_rows": observed(src_obs, "source", customers),
                  "distinct_source_rows": observed(distinct_obs, "rows", customers.distinct()),
                  "public_rows": made["public"][0],
                  "secured_rows": made["secured"][0],
                  "missing_identities": observed(aud_obs, "audit", missing)}
    finally:
        # the joined table holds raw PII: it must not outlive the job
        remove_path(spark, joined_path)
    back = {"public": _written(spark, public_path, fmt, schemas.DEIDENTIFIED, verify_content),
            "secured": _written(spark, secured_path, fmt, schemas.SECURED, verify_content),
            "audit": count_rows({"n": audit.read_audit(spark, audit_root)
                                 .where(F.col("source") == source)})["n"]}
    for copy in ("public", "secured"):
        _check(back[copy] == made[copy][:len(back[copy])], f"{copy} copy: {back[copy]} vs {made[copy]}")
    _check(back["audit"] == values["missing_identities"], f"audit: {back} vs {values}")
    # source_rows / distinct_source_rows are informational: they are observed
    # before a shuffle, where a stage re-run after a lost executor may count
    # twice.  The checks above compare result-stage counts (rows written)
    # with what is on storage, and only they gate the purge manifest.
    man = None
    if staging_root and staging_prefixes:
        man = _read_files(spark, manifest.purge_manifest(spark, staging_root, staging_prefixes),
                          customers)
    return JobResult(metrics_frame(spark, "deidentify", values), values, man,
                     {"public": public_path, "secured": secured_path, "audit": audit_root})


# ------------------------------------------------------------------- deletion
def deletion_job(spark: SparkSession, customers: DataFrame, requests: DataFrame, *,
                 out_root: str, fmt: str, as_of: str, strict: bool = False,
                 input_is_distinct: bool = False, verify_content: bool = True) -> JobResult:
    """Write the customers minus the requested e-mails as a new dated version
    and list the older versions (as they stood when the job began) for purging."""
    marker = f"{VERSION_PREFIX}{as_of}"
    path = f"{out_root}/{fmt}/{marker}"
    older = scratch_path(spark, "older-versions")
    first = not path_exists(spark, out_root)
    if not first:
        manifest.purge_manifest_keep_version(spark, out_root, fmt, marker).write.parquet(older)
    # Every count of the big side is observed inside the one write plan.
    source, src_obs = counted(customers, "source")
    distinct_obs = Observation("distinct_source")
    blank = fmt == "gzip"
    kept, obs = marked(deletion.apply_deletions(source, requests, strict,
                                                distinct_rows=distinct_obs,
                                                input_is_distinct=input_is_distinct), "kept", blank)
    files.write_by_format(kept, path, fmt)
    made = seen(obs, kept, blank)
    values = {"source_rows": observed(src_obs, "source", customers),
              "request_rows": count_rows({"n": requests.distinct()})["n"],
              "kept_rows": made[0]}
    distinct = customers if input_is_distinct else customers.distinct()
    values["deleted_rows"] = observed(distinct_obs, "rows", distinct) - values["kept_rows"]
    back = _written(spark, path, fmt, schemas.CUSTOMERS, verify_content)
    _check(back == made[:len(back)], f"new version: {back} vs {made}")
    man = (manifest.purge_manifest_keep_version(spark, out_root, fmt, marker).where(F.lit(False))
           if first else spark.read.parquet(older))
    return JobResult(metrics_frame(spark, "deletion", values), values, man, {"kept": path})


#: Folder of a version with the list of the files that it takes over from older versions.
CARRIED = "_carried"


def _plain_name(uri: str) -> str:
    """A file as a path: without percent-escapes, with one slash after ``file:``."""
    return re.sub(r"^file:/+", "file:/", unquote(uri))


def _version_files(spark: SparkSession, version: str, fmt: str) -> list[str]:
    """The data files of a version: its own, and those it carries."""
    own = [_plain_name(f) for f in files.read_by_format(spark, version, fmt, schemas.CUSTOMERS).inputFiles()]
    if path_exists(spark, f"{version}/{CARRIED}"):
        own += [r.path for r in spark.read.parquet(f"{version}/{CARRIED}").collect()]
    return own


def read_version(spark: SparkSession, version: str, fmt: str) -> DataFrame:
    """The customers of a version, whether it was written whole or by file."""
    own = _version_files(spark, version, fmt)
    if not own:
        return spark.createDataFrame([], schemas.CUSTOMERS)
    return files.read_by_format(spark, own, fmt, schemas.CUSTOMERS)


def deletion_by_file_job(spark: SparkSession, previous: str, requests: DataFrame, *, out_root: str, fmt: str,
                         as_of: str, strict: bool = False, verify_content: bool = True) -> JobResult:
    """The deletion job on a version that this library wrote (so without repeated rows): only files that
    hold a requested customer are rewritten, the others are carried over by name.

    One semi-join reads the e-mail column and finds those files; their rows are read, filtered and written
    as the new version, with the list of carried files beside them (a line a file, as long as the listing
    that Spark plans a scan from).  The purge manifest names every file of older versions but the carried
    ones.  Bytes read in full and written follow the files that were hit, not the table."""
    marker = f"{VERSION_PREFIX}{as_of}"
    path = f"{out_root}/{fmt}/{marker}"
    if path.rstrip("/") == previous.rstrip("/"):
        raise ValueError("a version cannot replace itself")
    every = _version_files(spark, previous, fmt)
    older = scratch_path(spark, "older-versions")
    manifest.purge_manifest_keep_version(spark, out_root, fmt, marker).write.parquet(older)
    hit: list[str] = []
    if every:
        rows = (files.read_by_format(spark, every, fmt, schemas.CUSTOMERS)
                .select("email", F.col("_metadata.file_path").alias("__file")))
        hit = [_plain_name(r[0]) for r in deletion.requested(rows, requests, strict).select("__file").distinct().collect()]
    carried = sorted(set(every) - set(hit))
    source = files.read_by_format(spark, hit, fmt, schemas.CUSTOMERS) if hit else spark.createDataFrame([], schemas.CUSTOMERS)
    blank = fmt == "gzip"
    source, src_obs = counted(source, "source")
    kept, obs = marked(deletion.apply_deletions(source, requests, strict, input_is_distinct=True), "kept", blank)
    files.write_by_format(kept, path, fmt)
    made = seen(obs, kept, blank)
    spark.createDataFrame([(c,) for c in carried], "path string").coalesce(1).write.mode("overwrite").parquet(f"{path}/{CARRIED}")
    back = _written(spark, path, fmt, schemas.CUSTOMERS, verify_content)
    _check(back == made[:len(back)], f"new version: {back} vs {made}")
    values = {"files": len(every), "rewritten_files": len(hit), "carried_files": len(carried),
              "request_rows": count_rows({"n": requests.distinct()})["n"],
              "rewritten_rows": made[0], "deleted_rows": observed(src_obs, "source", source) - made[0]}
    own = spark.read.parquet(f"{path}/{CARRIED}").withColumnRenamed("path", "__carried")
    man = spark.read.parquet(older).join(own, F.regexp_replace("path", r"^file:/+", "file:/") == F.col("__carried"),
                                         "left_anti")
    return JobResult(metrics_frame(spark, "deletion_by_file", values), values, man, {"kept": path})


# ------------------------------------------------------------- identity load
def identity_load_job(spark: SparkSession, pairs: DataFrame, idsvc: DataFrame, *,
                      out_path: str | None = None, append_to: str | None = None,
                      fmt: str = "parquet") -> JobResult:
    """Load the pairs whose key the identity table does not know yet.

    ``append_to``: append only the new pairs to the identity table at that
    path.  New pairs never collide with a stored key (their trimmed key is
    absent), so appending is exactly the upsert, and the table is never
    rewritten.  The new pairs are staged in the shared checkpoint folder
    first, so the append does not re-read the table it is adding to.
    ``out_path``: write the complete upserted table as a new version instead.
    """
    if (out_path is None) == (append_to is None):
        raise ValueError("give exactly one of out_path and append_to")
    # Counted before anything is written: it gates the result, and a count
    # observed ahead of a shuffle may be doubled by a stage that runs again.
    known = count_rows({"n": idsvc})["n"]
    src, src_obs = counted(pairs, "pairs")
    new, obs = counted(identity.new_identity_pairs(src, idsvc), "new_pairs")
    if append_to is not None:
        staged = scratch_path(spark, "identity-load")
        try:
            new.write.mode("overwrite").parquet(staged)
            on_storage = spark.read.schema(new.schema).parquet(staged)
            found = count_rows({"n": on_storage})["n"]
            _check(found == observed(obs, "new_pairs", new), f"staged pairs: {found} found")
            incoming, in_obs = counted(
                identity.unique_identities(on_storage.where(F.col("sourceSystemId").isNotNull())),
                "appended")
            incoming.write.mode("append").format(fmt).save(append_to)
            values = {"source_rows": observed(src_obs, "pairs", pairs), "lookup_rows": known,
                      "new_pairs": found, "appended_rows": observed(in_obs, "appended", incoming)}
        finally:
            remove_path(spark, staged)
        after = count_rows({"n": spark.read.format(fmt).load(append_to)})["n"]
        values["identity_rows_after"] = after
        _check(after >= values["lookup_rows"] + values["appended_rows"], "identity rows lost")
        return JobResult(metrics_frame(spark, "identity_load", values), values, None,
                         {"identity": append_to})
    new = new.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        upserted = identity.upsert_identities(idsvc, new)
        upserted.write.mode("overwrite").format(fmt).save(out_path)
        values = {"source_rows": observed(src_obs, "pairs", pairs), "lookup_rows": known,
                  "new_pairs": observed(obs, "new_pairs", new)}
    finally:
        new.unpersist()
    back = spark.read.format(fmt).load(out_path)
    values["identity_rows_after"] = count_rows({"n": back})["n"]
    _check(values["identity_rows_after"] >= values["lookup_rows"], "identity rows lost")
    return JobResult(metrics_frame(spark, "identity_load", values), values, None,
                     {"identity": out_path})


# --------------------------------------------------------------- JSON objects
def json_anonymize_job(spark: SparkSession, in_root: str, out_root: str,
                       quarantine_root: str, source_type: str, pii_keys, *,
                       layout: str = "files", strict: bool = False,
                       run_id: str | None = None, root_key: str | None = None,
                       out_layout: str = "files", refuse_hidden: bool = False) -> JobResult:
    """Redact every object under ``in_root``; write redacted objects under
    ``out_root`` with key ``anonymized/<key>``, quarantine the rest with a
    reason, reconcile ``listed = redacted + quarantined`` and only then list
    for purging the input objects whose redacted copy is on storage.

    Runs accumulate: a run replaces only its own keys under ``out_root``
    (objects of earlier runs stay) and writes its quarantine rows to
    ``quarantine_root/run=<run_id>``.

    Objects are read in the ``files`` layout by the executors, whatever their
    names, and the manifest holds length and time of what was read.  With
    ``refuse_hidden``, in the keyed layout or where the file system has no Arrow
    client, names that Spark's file sources pass over stop the job before anything
    is processed.  ``out_layout``: ``files`` puts each object at its exact key from
    the executors, ``keyed`` publishes through Spark's writer (a folder an object)."""
    run_id = run_id or uuid.uuid4().hex
    if out_layout not in ("files", "keyed"):
        raise ValueError(f"unknown object layout {out_layout!r}")
    whole = layout == "files" and obj_src.reachable(in_root)  # every object, as it was read
    if refuse_hidden or not whole:
        obj_src.require_visible_names(spark, in_root)
    preset = redact.PRESETS[redact.route(source_type)]
    # gzip sources compress every object, whatever its name; objects in the
    # keyed layout were written by Spark, which always names them *.gz
    scanned = obj_src.scan_objects(spark, in_root, layout,
                                   gzip_any_name=preset.gzip and layout == "files")
    red = redact.redact(scanned, preset.name, pii_keys, strict=strict, root_key=root_key)
    if whole:
        red = red.withColumn("reason", F.when(F.col("payload").isNull(), "unreadable_object")
                             .otherwise(F.col("reason")))
    red = red.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        # what was read is what may be purged: an object that comes meanwhile is in neither
        listing = red if whole else obj_src.list_objects(spark, in_root, layout)
        listing = listing.select("object_key", "path", "length", "modificationTime")
        ok = redact.redacted_only(red).withColumn("target_key", objects.target_key())
        # such a key ends the folder name there, and Spark would not see the copy
        if out_layout == "keyed" and ok.where(F.col("object_key").endswith("._COPYING_")).head(1):
            raise obj_src.HiddenNamesError("keys ending in ._COPYING_ need out_layout='files'")
        ok_obs = Observation("redacted")
        put = None
        if out_layout == "files":
            put = objects.put_totals(ok, out_root, key_col="target_key", body_col="redacted",
                                     gzip=preset.gzip)
        else:
            objects.write_objects(ok, out_root, key_col="target_key", body_col="redacted",
                                  gzip=preset.gzip, written=ok_obs, dynamic=True)
        run_keys = ok.select(F.col("target_key").alias("object_key"))
        size = F.col("length") if whole else F.length("payload").cast("long")
        bad = redact.quarantined_only(red).select("object_key", "path", size.alias("length"), "reason", "payload")
        if not whole:
            # reconcile against the persisted rows: the objects are not read twice
            bad = bad.unionByName(obj_src.unread_objects(listing, red)
                                  .withColumn("payload", F.lit(None).cast("string")))
        bad, bad_obs = counted(bad, "quarantined")
        bad.write.mode("overwrite").parquet(f"{quarantine_root}/run={run_id}")
        values = {"listed_objects": count_rows({"n": listing})["n"],
                  "redacted_objects": observed(ok_obs, "rows", ok) if put is None else put["objects"],
                  "quarantined_objects": observed(bad_obs, "quarantined", bad)}
        # this run's objects on storage (earlier runs' objects are not counted)
        if out_layout == "files":
            stored = found_objects(run_keys, out_root)
        else:
            stored = (obj_src.list_objects(spark, out_root, out_layout)
                      .join(run_keys, "object_key", "left_semi"))
        at = scratch_path(spark, "stored-objects")
        stored.select("object_key", "length").write.parquet(at)
        stored = spark.read.parquet(at)
        # a key and what became of its object, kept for the manifest
        kept = scratch_path(spark, "read-objects")
        listing.write.parquet(kept)
        listing = spark.read.parquet(kept)
    finally:
        red.unpersist()
    on_storage = stored.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes")).head()
    values["written_objects"] = on_storage.n
    _check(on_storage.n == values["redacted_objects"], f"emitted objects: {values}")
    _check(put is None or on_storage.bytes == put["bytes"], f"emitted bytes: {on_storage.bytes} of {put}")
    _check(values["listed_objects"] == on_storage.n + values["quarantined_objects"],
           f"objects do not reconcile: {values}")
    # Only objects whose redacted copy is on storage may be purged; quarantined
    # ones stay (an unreadable object has no other copy).
    prefix_len = len(objects.TARGET_PREFIX)
    done = stored.select(
        F.expr(f"substring(object_key, {prefix_len + 1})").alias("object_key"))
    # A key quarantined in this run is never purged, even if an earlier run left
    # a redacted copy of an older version under out_root.
    held = spark.read.parquet(f"{quarantine_root}/run={run_id}").select("object_key")
    man = (listing.select("object_key", obj_src.relative_path(F.col("path"), in_root)
                          .alias("relative_path"), "path", "length", "modificationTime")
           .join(done, "object_key", "left_semi")
           .join(held, "object_key", "left_anti"))
    return JobResult(metrics_frame(spark, "json_anonymize", values), values, man,
                     {"objects": out_root, "quarantine": f"{quarantine_root}/run={run_id}"})


def read_customers(spark: SparkSession, path: str, kind: str,
                   multiline: bool = False) -> DataFrame:
    """Customer export reader by kind: 'csv' (comma) or 'tsv' (tab)."""
    if kind == "csv":
        return tables.read_customers_csv(spark, path, multiline=multiline)
    if kind == "tsv":
        return tables.read_customers_tsv(spark, path, multiline=multiline)
    raise ValueError(f"unknown customer export kind {kind!r}")
