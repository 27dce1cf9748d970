"""Bronze landing: scans, payload flattening, partitioned appends, keyed upserts
(SRC-1, SRC-2, SRC-4, SNK-1..5, JON-8)."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playlake.functions import to_json_list
from playlake.operators.silver import latest
from playlake.schemas import CATALOG_PAGE, SOURCE_TAG
from playlake.session import scratch_path


def read(spark: SparkSession, location: str, name: str | None = None, schema: T.StructType | None = None,
         since: str | None = None) -> DataFrame:
    """SRC-1 / SRC-2: a bronze dataset by path root or by catalog table name.

    Reading the dataset root (not a glob) makes ``ingest_date`` a partition
    column, so ``since`` prunes whole directories.
    """
    if "/" not in location and name is None:
        df = spark.table(location)
    else:
        path = location if name is None else f"{location.rstrip('/')}/{name}"
        reader = spark.read if schema is None else spark.read.schema(
            T.StructType(schema.fields + [T.StructField("ingest_date", T.DateType())])
            if "ingest_date" not in schema.fieldNames() else schema)
        df = reader.parquet(path)
    if since is not None:
        df = df.filter(F.col("ingest_date") >= F.lit(since).cast("date"))
    return df


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """Landed API page documents (one JSON document per file)."""
    return spark.read.schema(CATALOG_PAGE).option("multiLine", True).json(path)


def flatten_payloads(pages: DataFrame, ingested_at, source: str = SOURCE_TAG) -> DataFrame:
    """SRC-4 / JSN-3: ``data.Page.media[]`` to flat bronze rows by struct paths.

    An absent ``title`` gives NULL titles; ``genres``/``tags`` become JSON text
    with ``[]`` for NULL; one ingest timestamp for the whole run.
    """
    media = pages.select(F.explode_outer("data.Page.media").alias("m")).filter(F.col("m").isNotNull())
    tags = F.to_json(F.coalesce(F.col("m.tags"), F.array().cast("array<struct<name:string,rank:int>>")))
    return media.select(
        F.col("m.id").alias("media_id"),
        F.col("m.title.romaji").alias("title_romaji"),
        F.col("m.title.english").alias("title_english"),
        to_json_list(F.col("m.genres")).alias("genres"),
        tags.alias("tags"),
        F.col("m.description").alias("description_html"),
        F.col("m.averageScore").alias("average_score"),
        F.col("m.popularity").alias("popularity"),
        F.col("m.episodes").alias("episodes"),
        F.col("m.season").alias("season"),
        F.col("m.seasonYear").alias("season_year"),
        F.col("m.format").alias("format"),
        F.col("m.status").alias("status"),
        F.lit(ingested_at).cast("timestamp").alias("_ingested_at"),
        F.lit(source).alias("_source"),
    )


def append_partitioned(df: DataFrame, path: str, ts_col: str = "_ingested_at") -> None:
    """SNK-2: append under ``ingest_date=YYYY-MM-DD`` (UTC date of the ingest time)."""
    (df.withColumn("ingest_date", F.to_date(F.col(ts_col)))
       .write.mode("append").partitionBy("ingest_date").parquet(path))


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """SNK-1."""
    df.write.mode(mode).parquet(path)


def upsert(target: DataFrame, incoming: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """SNK-3 / JON-8: MERGE semantics as a plan.

    Incoming rows are reduced to one per key (first under ``order``, e.g. the
    newest), matched target rows are replaced whole, new keys inserted.
    Rerunning with the same input gives the same table. The anti join and the
    dedupe shuffle on the key, so the plan scales with the data.
    """
    newest = latest(incoming, list(keys), list(order))
    kept = target.join(newest.select(*keys), list(keys), "left_anti")
    return kept.unionByName(newest.select(*target.columns))


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _children(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    return [st.getPath().getName() for st in fs.listStatus(p)] if fs.exists(p) else []


def current_version(spark: SparkSession, base: str) -> int | None:
    """The number of the newest manifest under ``base``."""
    found = [int(n.removesuffix(".json")) for n in _children(spark, f"{base.rstrip('/')}/_manifest")
             if n.endswith(".json") and n[:-5].isdigit()]
    return max(found, default=None)


def _manifest(spark: SparkSession, base: str, version: int | None) -> dict | None:
    """What a version consists of: schema, keys, number of buckets, folder of each bucket, last batch of each stream."""
    if version is None:
        return None
    fs, p = _fs(spark, f"{base.rstrip('/')}/_manifest/{version}.json")
    stream = fs.open(p)
    try:
        return json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def _commit(spark: SparkSession, base: str, version: int, manifest: dict) -> None:
    """Write the manifest beside its place and rename it there: readers see the old version or the new one."""
    base = base.rstrip("/")
    fs, place = _fs(spark, f"{base}/_manifest/{version}.json")
    _, draft = _fs(spark, f"{base}/_manifest/.draft-{uuid.uuid4().hex}")
    stream = fs.create(draft, False)
    try:
        stream.write(bytearray(json.dumps(manifest).encode()))
    finally:
        stream.close()
    if fs.exists(place) or not fs.rename(draft, place):
        fs.delete(draft, False)
        raise RuntimeError(f"another writer has committed version {version} of {base}; run the upsert again")


def _read_buckets(spark: SparkSession, base: str, manifest: dict, buckets: Sequence[int] | None = None) -> DataFrame:
    """The rows of some buckets, or of all; no file of another bucket is opened."""
    schema = T.StructType.fromJson(manifest["schema"])
    parts = manifest["parts"] if buckets is None else {str(b): manifest["parts"][str(b)] for b in buckets if str(b) in manifest["parts"]}
    if not parts:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{base.rstrip('/')}/data/{folder}/_bucket={b}" for b, folder in sorted(parts.items())])


def read_versioned(spark: SparkSession, base: str, version: int | None = None) -> DataFrame | None:
    """The table that ``upsert_path`` keeps under ``base``, at its newest version or an older one that is still there."""
    manifest = _manifest(spark, base, current_version(spark, base) if version is None else version)
    return None if manifest is None else _read_buckets(spark, base, manifest)


def applied_batch(spark: SparkSession, base: str, query: str) -> int | None:
    """The last batch id of the stream ``query`` that the current version holds, if any."""
    return ((_manifest(spark, base, current_version(spark, base)) or {}).get("applied") or {}).get(query)


def upsert_path(spark: SparkSession, base: str, incoming: DataFrame, keys: Sequence[str], order: Sequence[Column],
                batch: tuple[str, int] | None = None, buckets: int = 64) -> int:
    """SNK-3 on plain parquet: rewrite only the buckets that hold incoming keys.

    Rows are dealt to ``buckets`` by the hash of their keys (fixed by the first upsert; choose it so that a
    bucket is worth rewriting, say 100 MB to 1 GB). A manifest names the folder of each
    bucket's current rows. An upsert reads the incoming keys' buckets, writes them merged into a new
    folder, and commits by renaming one file, so a lost writer leaves the old manifest and a folder that
    nothing names. Buckets without incoming keys stay where they are. Incoming rows are staged once in the
    shared scratch folder. Returns the new version's number. ``batch`` = (query id, batch id) records
    in the same manifest which micro-batch of a stream the version holds. A version committed by another
    writer meanwhile raises an error. ``vacuum`` deletes folders that no kept version names.
    """
    base, keys = base.rstrip("/"), list(keys)
    v = current_version(spark, base)
    held = _manifest(spark, base, v) or {"keys": keys, "buckets": buckets, "parts": {}, "applied": {}}
    if held["keys"] != keys:
        raise ValueError(f"{base} is keyed by {held['keys']}, not by {keys}")
    bucket = F.pmod(F.xxhash64(*keys), F.lit(held["buckets"])).cast("int").alias("_bucket")
    staged = scratch_path(spark, f"upsert-{uuid.uuid4().hex}")
    newest = latest(incoming, keys, list(order))
    newest.select("*", bucket).write.parquet(staged)
    try:
        new = spark.read.schema(T.StructType([*newest.schema.fields, T.StructField("_bucket", T.IntegerType())])).parquet(staged)
        touched = sorted(r[0] for r in new.select("_bucket").distinct().collect())  # at most the number of buckets
        parts = dict(held["parts"])
        if touched:
            merged = new.drop("_bucket")
            if "schema" in held:
                target = _read_buckets(spark, base, held, touched)
                merged = target.join(merged.select(*keys), keys, "left_anti").unionByName(merged.select(*target.columns))
            folder = f"{0 if v is None else v + 1:08d}-{uuid.uuid4().hex[:12]}"
            # one bucket may take several files; Spark splits and joins them by size
            merged.select("*", bucket).hint("rebalance", "_bucket").write.partitionBy("_bucket").parquet(f"{base}/data/{folder}")
            parts |= {str(b): folder for b in touched}
    finally:
        fs, p = _fs(spark, staged)
        fs.delete(p, True)
    applied = dict(held["applied"])
    if batch is not None:
        applied[batch[0]] = batch[1]
    schema = held.get("schema") or json.loads(newest.schema.json())
    nxt = 0 if v is None else v + 1
    _commit(spark, base, nxt, {"schema": schema, "keys": keys, "buckets": held["buckets"], "parts": parts, "applied": applied})
    return nxt


def vacuum(spark: SparkSession, base: str, keep: int = 2) -> list[str]:
    """Delete the manifests before the last ``keep`` versions and the folders that none of those names.

    Not while an upsert runs: the folder it writes has no manifest yet.
    """
    base = base.rstrip("/")
    last = current_version(spark, base)
    if last is None:
        return []
    versions = sorted(int(n[:-5]) for n in _children(spark, f"{base}/_manifest") if n.endswith(".json") and n[:-5].isdigit())
    kept = versions[-keep:]
    named = {folder for v in kept for folder in _manifest(spark, base, v)["parts"].values()}
    gone = [f"{base}/_manifest/{v}.json" for v in versions if v not in kept]
    gone += [f"{base}/data/{n}" for n in _children(spark, f"{base}/data") if n not in named]
    for path in gone:
        fs, p = _fs(spark, path)
        fs.delete(p, True)
    return gone


def ensure_schema(spark: SparkSession, schema_name: str) -> None:
    """SNK-4: CREATE SCHEMA IF NOT EXISTS."""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema_name}")


# Table formats whose Spark connectors implement MERGE INTO.
MERGE_PROVIDERS = ("delta", "iceberg", "hudi")


def table_provider(spark: SparkSession, table: str) -> str:
    """The lower-cased format of a catalog table."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("lower(col_name) = 'provider'").collect()
    return (rows[0]["data_type"] if rows else "").lower()


def upsert_table(spark: SparkSession, table: str, incoming: DataFrame, keys: Sequence[str],
                 order: Sequence[Column]) -> None:
    """SNK-4 + SNK-3 on catalog tables: create when absent, else merge.

    The table's format decides how: ``MERGE INTO`` where it is supported (an
    error there is raised, never answered by a rewrite), else the merged rows
    are staged in the shared checkpoint folder and written over the table with
    INSERT OVERWRITE. The catalog entry, its properties and its format stay.
    """
    newest = latest(incoming, list(keys), list(order))
    if not spark.catalog.tableExists(table):
        newest.write.saveAsTable(table)
        return
    if table_provider(spark, table) in MERGE_PROVIDERS:
        cond = " AND ".join(f"t.{k} = s.{k}" for k in keys)
        view = f"_playlake_incoming_{uuid.uuid4().hex}"
        newest.createOrReplaceTempView(view)
        try:
            spark.sql(f"MERGE INTO {table} t USING {view} s ON {cond} "
                      "WHEN MATCHED THEN UPDATE SET * WHEN NOT MATCHED THEN INSERT *")
        finally:
            spark.catalog.dropTempView(view)
        return
    target = spark.table(table)
    staged = scratch_path(spark, f"upsert-{uuid.uuid4().hex}")
    upsert(target, newest, keys, order).write.parquet(staged)
    spark.read.schema(target.schema).parquet(staged).write.insertInto(table, overwrite=True)
    fs, p = _fs(spark, staged)
    fs.delete(p, True)


def materialize(df: DataFrame, name: str, kind: str = "view") -> DataFrame:
    """SNK-5: staging models as temp views, marts as fully rebuilt tables."""
    if kind == "view":
        df.createOrReplaceTempView(name)
        return df.sparkSession.table(name)
    df.write.mode("overwrite").saveAsTable(name)
    return df.sparkSession.table(name)
