"""Request intake: a folder of JSON params files as a stream of file versions (SRC4, PRJ11, PRJ12, SNK5).

Each file is one request. A file version is its path, modification time and content. The ledger is a folder:

* ``versions``, the offset log: an append-only table of every version that was ever listed, with its content and the time it was
  taken up. :func:`drain_queue` lists the folder as it is (files of any age, of no bytes, and of bytes that are no text) and
  appends what the log does not hold.
* ``stream``, the checkpoint of a streaming query over that log. It runs until everything available is served, a micro-batch of
  versions at a time; a batch that dies is served again with the same versions, ids and stamps.
* ``served``, the versions whose batch was handled.
* ``removals``, the intents of removing served files, written before a file is touched and dropped when all is settled.

A file that is put back with other content, or touched, is a new version.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The params keys read as typed request columns, and the run-stamp format.
STAMP_FORMAT = "yyyyMMdd_HHmmss"
REQUEST_FIELDS = {
    "app_version": "string",
    "dataset": "string",
    "scenario": "string",
    "seed": "bigint",
}
# Inpatient sample rate of national runs when neither the caller nor the params give one.
DEFAULT_NATIONAL_SAMPLE_RATE = 0.01
# Key holding the model's start (financial) year; an assumption of this library, configurable.
DEFAULT_YEAR_FIELD = "start_year"


VERSION_SCHEMA = "request_id string, params_path string, params_modified timestamp, content binary, taken_at timestamp"
LEDGER_SCHEMA = "request_id string, params_path string"
# File operations of the driver that are under way together.
PARALLEL_FILES = 16


def _versions(spark: SparkSession, folder: str) -> DataFrame:
    """``params_path``, ``params_modified`` and ``content`` of the files in ``folder``; sub-folders and names that begin with
    ``_`` or ``.`` are left out. Spark's file sources skip files without bytes, so those come from the listing."""
    at, files = _files(spark, folder)
    listed = files.listStatus(at) if files.exists(at) else []
    empty = [(f.getPath().toUri().toString(), f.getModificationTime()) for f in listed
             if f.isFile() and not f.getLen() and not f.getPath().getName().startswith(("_", "."))]
    rows = spark.createDataFrame(empty, "params_path string, ms long").select(
        "params_path", F.timestamp_millis("ms").alias("params_modified"), F.lit(b"").alias("content"))
    if any(f.isFile() and f.getLen() for f in listed):
        rows = rows.union(spark.read.format("binaryFile").load(folder.rstrip("/")).select(
            F.col("_metadata.file_path"), F.col("modificationTime"), "content"))
    return rows


def _version_id(path: Column) -> Column:
    """The id of the version that a file of this path, and the row's time and content, is."""
    return F.sha2(F.concat_ws("\n", path, F.unix_micros("params_modified").cast("string"), F.sha2("content", 256)), 256)


def _parsed(versions: DataFrame) -> DataFrame:
    """Versions with ``params_text`` (bytes that are no UTF-8 replaced) and ``params`` (VARIANT; NULL if it is not valid JSON)."""
    text = F.make_valid_utf8(F.col("content").cast("string"))
    parsed = versions.withColumn("params_text", text).withColumn("valid_text", F.is_valid_utf8(F.col("content").cast("string")))
    return parsed.withColumn("params", F.when(F.col("valid_text"), F.try_parse_json("params_text"))).drop("content")


def read_requests(spark: SparkSession, queue_path: str) -> DataFrame:
    """The params files in ``queue_path``: ``params_path``, ``params_modified``, ``params_text``, ``valid_text`` (whether it is UTF-8),
    ``params`` (VARIANT; NULL when the text is not valid JSON) and ``request_id``, a hash of the file version.
    """
    return _parsed(_versions(spark, queue_path).withColumn("request_id", _version_id(F.col("params_path"))))


def stamp(ts: Column) -> Column:
    """Run stamp ``YYYYmmdd_HHMMSS`` of a timestamp."""
    return F.date_format(ts, STAMP_FORMAT)


def request_metadata(params_text: Column) -> Column:
    """``map<string,string>`` of the scalar params; objects and arrays are left out.

    The choice is made on the JSON type of each value (so a string ``"{x}"`` is kept); booleans
    read ``true``/``false`` and JSON nulls NULL.
    """
    as_map = F.from_json(params_text, "map<string,variant>")
    scalars = F.map_filter(
        as_map,
        lambda _k, v: ~(F.schema_of_variant(v).startswith("OBJECT") | F.schema_of_variant(v).startswith("ARRAY")),
    )
    return F.transform_values(scalars, lambda _k, v: v.cast("string"))


def request_table(
    raw: DataFrame,
    *,
    level: str | None = None,
    year_field: str = DEFAULT_YEAR_FIELD,
    sample_rate: float | None = None,
    stamp_from: Column | None = None,
) -> DataFrame:
    """Typed request rows from parsed params files (valid JSON only).

    ``request_id`` names the file version; ``code`` is the params ``dataset`` (provider or region
    code); ``create_datetime`` is stamped from ``stamp_from`` (by default the file's modification time; the queue
    job gives the time the version was taken up, which a retried batch keeps) and is part of the metadata. ``sample_rate`` (national
    runs) is the argument, else the params' ``sample_rate``, else 0.01. With ``level``, rows missing
    a field that level needs are left out (see :func:`quarantined`).
    """
    p = F.col("params")
    fields = {name: F.try_variant_get(p, f"$.{name}", kind).alias(name) for name, kind in REQUEST_FIELDS.items()}
    rate = (F.lit(float(sample_rate)) if sample_rate is not None
            else F.coalesce(F.try_variant_get(p, "$.sample_rate", "double"), F.lit(DEFAULT_NATIONAL_SAMPLE_RATE)))
    created = stamp(stamp_from if stamp_from is not None else F.col("params_modified"))
    metadata = F.map_concat(F.map_filter(request_metadata(F.col("params_text")), lambda k, _v: k != "create_datetime"),
                            F.create_map(F.lit("create_datetime"), created))
    return raw.where(request_problem(level, year_field).isNull()).select(
        "request_id",
        "params_path",
        *fields.values(),
        F.try_variant_get(p, "$.dataset", "string").alias("code"),
        F.try_variant_get(p, f"$.{year_field}", "int").alias("fyear"),
        rate.alias("sample_rate"),
        created.alias("create_datetime"),
        metadata.alias("metadata"),
        "params",
    )


def request_problem(level: str | None = None, year_field: str = DEFAULT_YEAR_FIELD) -> Column:
    """Why a params row cannot be served (NULL when it can): not JSON, or a needed field missing or of the
    wrong type. Needed are the labels of the run (version, dataset, scenario), the year, and for a
    national run the seed."""
    p = F.col("params")
    problem = F.when(F.length("params_text") == 0, F.lit("empty file")).when(p.isNull(), F.lit("not valid JSON"))
    if level is None:
        return problem
    needed = {"app_version": "string", "dataset": "string", "scenario": "string", year_field: "int",
              **({"seed": "bigint"} if level == "national" else {})}
    for name, kind in needed.items():
        problem = problem.when(F.try_variant_get(p, f"$.{name}", kind).isNull(), F.lit(f"missing or invalid {name}"))
    return problem


def quarantined(raw: DataFrame, level: str | None = None, year_field: str = DEFAULT_YEAR_FIELD) -> DataFrame:
    """Params rows that cannot be served, with the reason."""
    return (raw.withColumn("reason", request_problem(level, year_field))
            .where(F.col("reason").isNotNull())
            .select("request_id", "params_path", "params_modified", "params_text", "reason"))


def _table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A table of the ledger; without rows while it does not exist."""
    return spark.read.schema(schema).parquet(path) if _exists(spark, path) else spark.createDataFrame([], schema)


def served(spark: SparkSession, ledger: str) -> DataFrame:
    """The file versions that were served."""
    return _table(spark, f"{ledger.rstrip('/')}/served", LEDGER_SCHEMA)


def drain_queue(
    spark: SparkSession,
    queue_path: str,
    ledger: str,
    handle: Callable[[DataFrame], None],
    *,
    clean_source: str | None = None,
    archive_dir: str | None = None,
) -> int:
    """Serve every file version in the queue that was not served yet; returns how many.

    ``handle(raw)`` receives the params rows of a micro-batch; when it returns, they count as served.
    ``clean_source="delete"`` or ``"archive"`` (to ``archive_dir``) then removes the served files, also
    those left by a run that died in between. A file that changed in the meantime stays in the queue.
    """
    if clean_source not in (None, "delete", "archive") or (clean_source == "archive") != bool(archive_dir):
        raise ValueError("clean_source is 'delete', or 'archive' with an archive_dir")
    ledger = ledger.rstrip("/")
    _settle_removals(spark, ledger)
    # Fixed once: a file that changes meanwhile must not be read again under the id of what it was.
    queue = _versions(spark, queue_path).withColumn("request_id", _version_id(F.col("params_path"))).checkpoint(eager=True)
    known = _table(spark, f"{ledger}/versions", VERSION_SCHEMA).select("request_id")
    new = queue.join(known, "request_id", "left_anti").withColumn("taken_at", F.current_timestamp())
    new = new.select("request_id", "params_path", "params_modified", "content", "taken_at").checkpoint(eager=True)
    if not new.isEmpty():
        new.write.mode("append").parquet(f"{ledger}/versions")
    count = _serve(spark, ledger, handle) if _exists(spark, f"{ledger}/versions") else 0
    if clean_source:
        done = queue.join(served(spark, ledger).select("request_id").distinct(), "request_id", "left_semi")
        _remove(spark, ledger, queue_path.rstrip("/"), done.select("request_id", "params_path"), archive_dir)
    return count


def _serve(spark: SparkSession, ledger: str, handle: Callable[[DataFrame], None]) -> int:
    """Stream the versions that the log holds and no batch has handled; returns how many."""
    counts: list[int] = []
    failures: list[BaseException] = []

    def each(batch: DataFrame, number: int) -> None:
        try:
            # Its own rows alone, off the stream: the handler may use them many times.
            versions = batch.checkpoint(eager=True)
            if not versions.isEmpty():
                handle(_parsed(versions))
                # A batch that is served again writes the same rows to the same place.
                versions.select("request_id", "params_path").write.mode("overwrite").parquet(f"{ledger}/served/batch={number}")
                counts.append(versions.count())
        except BaseException as failure:
            failures.append(failure)
            raise

    log = spark.readStream.schema(VERSION_SCHEMA).option("maxFileAge", "36500d").parquet(f"{ledger}/versions")
    query = (log.writeStream.foreachBatch(each).option("checkpointLocation", f"{ledger}/stream")
             .trigger(availableNow=True).start())
    try:
        query.awaitTermination()
    except StreamingQueryException:
        if failures:
            raise failures[0] from None
        raise
    return sum(counts)


def _files(spark: SparkSession, path: str):
    """A Hadoop path and its file system."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _exists(spark: SparkSession, path: str) -> bool:
    at, files = _files(spark, path)
    return files.exists(at)


def _in_parallel(work: Callable, items: Iterable) -> None:
    """``work`` on every item, some at a time; waits for all and raises the first failure."""
    with ThreadPoolExecutor(PARALLEL_FILES) as pool:
        for _ in pool.map(work, items):
            pass


def _listed(spark: SparkSession, uri: str):
    """The Hadoop path of a listed file (an encoded URI)."""
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(spark.sparkContext._jvm.java.net.URI(uri))


def _remove(spark: SparkSession, ledger: str, queue: str, done: DataFrame, archive_dir: str | None) -> None:
    """Take served file versions out of the queue.

    What is to go is noted first. The files are then renamed into a folder that the queue does not list, under their version's id:
    what is looked at there cannot change any more. :func:`_settle` looks at all of them in one job."""
    if done.isEmpty():
        return
    name = uuid.uuid4().hex
    aside = f"{queue}/_taken-{name}"
    (done.withColumns({"aside": F.lit(aside), "archive_dir": F.lit(archive_dir).cast("string")})
     .write.parquet(f"{ledger}/removals/{name}"))
    _set_aside(spark, ledger, name)
    _settle(spark, ledger, name)


REMOVAL_SCHEMA = LEDGER_SCHEMA + ", aside string, archive_dir string"


def _set_aside(spark: SparkSession, ledger: str, name: str) -> None:
    removal = spark.read.schema(REMOVAL_SCHEMA).parquet(f"{ledger}/removals/{name}")
    folder, files = _files(spark, removal.first()["aside"])
    files.mkdirs(folder)

    def rename(row) -> None:
        source = _listed(spark, row["params_path"])
        if files.exists(source):
            files.rename(source, _files(spark, f"{row['aside']}/{row['request_id']}")[0])

    _in_parallel(rename, removal.toLocalIterator())


def _settle(spark: SparkSession, ledger: str, name: str) -> None:
    """Finish a noted removal: files set aside that are the versions they were taken for go, others return to the queue."""
    note = f"{ledger}/removals/{name}"
    removal = spark.read.schema(REMOVAL_SCHEMA).parquet(note)
    first = removal.first()
    if first is not None and _exists(spark, first["aside"]):
        there = _versions(spark, first["aside"]).withColumn("request_id", F.regexp_extract("params_path", "[^/]+$", 0))
        looked_at = (there.withColumnRenamed("params_path", "aside_path").join(removal, "request_id")
                     .select("request_id", "params_path", "aside_path", (_version_id(F.col("params_path")) == F.col("request_id")).alias("same")))
        folder, files = _files(spark, first["aside"])
        kept = _files(spark, first["archive_dir"])[0] if first["archive_dir"] else None
        if kept is not None:
            files.mkdirs(kept)
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path

        def settle(row) -> None:
            at, source = _listed(spark, row["aside_path"]), _listed(spark, row["params_path"])
            if not row["same"]:
                # A newer file may have taken its place: this one, unserved, comes back beside it.
                back = path(source.getParent(), f"{uuid.uuid4().hex[:8]}-{source.getName()}") if files.exists(source) else source
                files.rename(at, back)
            elif kept is not None:
                files.rename(at, path(kept, f"{row['request_id'][:16]}-{source.getName()}"))
            else:
                files.delete(at, False)

        _in_parallel(settle, looked_at.toLocalIterator())
        files.delete(folder, True)
    at, files = _files(spark, note)
    files.delete(at, True)


def _settle_removals(spark: SparkSession, ledger: str) -> None:
    """Finish what runs that died had noted. A note that was not written whole has moved no file."""
    at, files = _files(spark, f"{ledger}/removals")
    for note in files.listStatus(at) if files.exists(at) else []:
        name = note.getPath().getName()
        if _exists(spark, f"{ledger}/removals/{name}/_SUCCESS"):
            _settle(spark, ledger, name)
        else:
            files.delete(note.getPath(), True)
