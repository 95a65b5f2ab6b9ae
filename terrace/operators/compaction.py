"""Small files packed into files of a target size."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from terrace.operators.tables import (
    MAX_PARTITIONS, commit_moves, is_native, location, partition_columns, quoted, restore, stored_buckets, url_path)
from terrace.workspace import materialise

# Fixed value: bytes a file should have.
TARGET = 134217728

#: Files of a partition that are packed together, and files of one commit: their list passes through the driver.
CHUNK, PER_COMMIT = 10_000, MAX_PARTITIONS


def packed(files: DataFrame, target: int) -> DataFrame:
    """First fit, descending: ``folder, path, bin`` of the files (``folder, path, size``) that share a bin of ``target`` bytes.

    A partition's files are packed in chunks of about ``CHUNK``. Bins of one file are left out.
    """
    counts = files.groupBy("folder").agg(F.ceil(F.count("*") / CHUNK).alias("_chunks"))
    chunked = files.join(counts, "folder").withColumn("_chunk", F.pmod(F.xxhash64("path"), F.col("_chunks")))

    def pack(frame):
        frame = frame.sort_values(["size", "path"], ascending=[False, True])
        room, bins = [], []
        for size in frame["size"]:
            fit = next((i for i, free in enumerate(room) if free >= size), None)
            if fit is None:
                fit = len(room)
                room.append(target)
            room[fit] -= size
            bins.append(fit)
        frame["bin"] = bins
        shared = frame.groupby("bin")["bin"].transform("size") > 1
        return frame.loc[shared, ["folder", "path", "_chunk", "bin"]]

    found = chunked.select("folder", "path", "size", "_chunk").groupBy("folder", "_chunk").applyInPandas(
        pack, "folder string, path string, _chunk long, bin long")
    return found.select("folder", "path", F.sha2(F.concat_ws("\n", "folder", "_chunk", "bin"), 256).substr(1, 24).alias("bin"))


def compact(spark: SparkSession, fqn: str, target: int = TARGET) -> int:
    """Rewrite files smaller than ``target`` as fewer files of up to that size; says how many went.

    Files of the target size and above stay as they are, name included; no file leaves its partition. The new
    files are written aside, then the intent is recorded, then they are moved in and the old ones removed;
    ``restore`` completes what stopped in between. A reader that lists the folder during the moves can meet
    rows twice, so compact when nobody reads.
    """
    if is_native(spark, fqn) or stored_buckets(spark, fqn):
        raise ValueError(f"{fqn}: only plain tables without buckets are compacted here")
    restore(spark, fqn)
    gone = 0
    while True:
        done, more = _once(spark, fqn, target)
        gone += done
        if not more:
            return gone


def _once(spark, fqn, target):
    table, keys = spark.table(fqn), partition_columns(spark, fqn)
    meta = table.metadataColumn("_metadata")
    paths = table.select(meta.getField("file_path").alias("path"), meta.getField("file_size").alias("size"))
    files = paths.groupBy("path").agg(F.max("size").alias("size")).where(F.col("size") < target)
    files = files.withColumn("folder", F.regexp_replace("path", "/[^/]*$", ""))
    bins = materialise(packed(files, target), "bins")
    chosen = bins.select("bin").distinct().orderBy("bin").limit(max(1, PER_COMMIT // 64))
    part = materialise(bins.join(chosen, "bin"), "bins")
    listed = part.groupBy("bin").agg(F.first("folder").alias("folder"), F.collect_list("path").alias("paths")).collect()
    if not listed:
        return 0, False
    fresh = f"{location(spark, fqn)}/_compact-{listed[0]['bin']}"
    rows = table.select(*[quoted(c) for c in table.columns if c not in keys], meta.getField("file_path").alias("_path"))
    rows = rows.join(part.select(F.col("path").alias("_path"), F.col("bin").alias("_bin")), "_path").drop("_path")
    rows.repartition("_bin").write.mode("overwrite").option("compression", "zstd").partitionBy("_bin").parquet(fresh)
    written = spark.read.parquet(fresh)
    new = written.select(written.metadataColumn("_metadata").getField("file_path").alias("path"), F.col("_bin").cast("string").alias("bin"))
    folders = {r["bin"]: url_path(r["folder"]) for r in listed}
    moves = []
    for path, name in new.distinct().collect():
        path = url_path(path)
        moves.append((path, f"{folders[name]}/{name}-{path.rsplit('/', 1)[1]}"))
    old = [url_path(p) for r in listed for p in r["paths"]]
    commit_moves(spark, fqn, moves, [*old, fresh])
    return len(old), bins.count() > part.count()
