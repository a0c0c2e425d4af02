"""WARC replicas and their Merkle fixity audit.

``write_warc`` writes records (page_id, url, html) as WARC 1.0 resource records into one file per shard, in order of
page_id, with Spark's own writer (gzip files by default). ``fixity`` reads a replica's files back, cuts them into records by their headers and
hashes each record and its offset range. ``audit`` compares two replicas: each replica's leaves are hashed into trees
of ``fan`` children a node, level by level over ordered ranges, each level written once; the descent starts at the shard roots and opens only
branches whose hashes differ (or that one replica lacks), down to the damaged offset ranges.

Only files in the layout of ``write_warc`` are read (``shard=<n>/file=<k>/part-*``). Defined results: null urls and texts are
written as empty; a null page_id is written as an empty id and read as null, its records are spread over
``null_shards`` shards of their own, numbered from -1 down;
repeated rows are records of their own; a file whose header is broken is picked up again at the next record, a gzip file that is broken ends there; an empty
table gives an empty replica and an audit without rows. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialise

# Fixed value: the date of the records, so that equal pages make equal bytes.
DATE = "2024-01-01T00:00:00Z"
HEAD = b"WARC/1.0\r\n"
TAIL = "\r\n\r"  # the writer adds the last newline


@dataclass(frozen=True)
class MerkleConfig:
    shard_ids: int = 1000  #: consecutive page_ids of a shard
    shard_bytes: int = 64 << 20  #: a file is rolled when its records hold so many bytes
    null_shards: int = 64
    task_bytes: int = 8 << 20  #: pages that one writing task holds, about
    fan: int = 16
    compression: str = "gzip"  #: of the files; offsets and hashes are of the records' own bytes


def head(page_id: Column, url: Column, payload: Column) -> Column:
    """The record's text up to its payload."""
    return F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:"), F.coalesce(page_id.cast("string"), F.lit("")),
        F.lit(f">\r\nWARC-Date: {DATE}\r\nWARC-Target-URI: "), F.regexp_replace(F.coalesce(url, F.lit("")), r"[\r\n]", ""),
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "), F.octet_length(payload).cast("string"), F.lit("\r\n\r\n"),
    )


def record(page_id: Column, url: Column, payload: Column) -> Column:
    """The record's text without its last newline, which the writer adds."""
    return F.concat(head(page_id, url, payload), payload, F.lit(TAIL))


def rolled(pages: DataFrame, cfg: MerkleConfig, payloads: dict[str, Column]) -> DataFrame:
    """(replica, shard, file, value): the records of every replica, each file's rows together and in order of page_id."""
    nameless = -1 - F.pmod(F.xxhash64("url", "html"), F.lit(cfg.null_shards))
    shard = F.coalesce(F.floor(F.col("page_id") / cfg.shard_ids), nameless).cast("long")
    total = pages.agg(F.sum(F.octet_length("html"))).first()[0] or 0
    # The pages are shuffled once, before their records are made, to as many tasks as their bytes need.
    rows = pages.withColumn("__shard", shard).repartition(max(8, -(-total // cfg.task_bytes)), "__shard")
    filled = [F.coalesce(p, F.lit("")) for p in payloads.values()]
    heads = [head(F.col("page_id"), F.col("url"), p) for p in filled]
    # One file number for all replicas of a record, by the bytes of the longest ones before it in its shard. Equal ids
    # stand in order of the first replica's records, that is of their heads and payloads. Sort and window hold each
    # page once; the records are made after them, and the sort by file holds each record once, beside its place.
    sizes = [F.octet_length(h).cast("long") + F.octet_length(p) + len(TAIL) + 1 for h, p in zip(heads, filled)]
    sized = rows.withColumn("__size", F.greatest(*sizes) if len(sizes) > 1 else sizes[0])
    order = Window.partitionBy("__shard").orderBy("page_id", heads[0], next(iter(payloads.values())))
    placed = sized.withColumn("__end", F.sum("__size").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    copies = F.array(*(F.struct(F.lit(n).alias("replica"), record(F.col("page_id"), F.col("url"), p).alias("value"))
                       for n, p in zip(payloads, filled)))
    file = F.floor((F.col("__end") - F.col("__size")) / cfg.shard_bytes).cast("int")
    each = placed.select(F.col("__shard").alias("shard"), file.alias("file"), "__end", F.explode(copies).alias("copy"))
    ordered = each.select(F.col("copy.replica").alias("replica"), "shard", "file", "__end", F.col("copy.value").alias("value"))
    return ordered.sortWithinPartitions("replica", "shard", "file", "__end").select("replica", "shard", "file", "value")


def write_warc(pages: DataFrame, path: str, cfg: MerkleConfig = MerkleConfig(), replicas: dict[str, Column] | None = None) -> None:
    """One folder per shard; inside a shard, records stand in order of page_id.

    ``replicas`` names several replicas and the payload of each (an expression over the columns of ``pages``); they are
    written together, under ``path/replica=<name>``, so that the pages are shuffled once.
    """
    records = rolled(pages, cfg, replicas or {"": F.col("html")})
    folders = ["replica", "shard", "file"] if replicas else ["shard", "file"]
    writer = records.select(*folders, "value").write.partitionBy(*folders)
    writer.option("compression", cfg.compression).text(path)


def unpacked(content: bytes) -> bytes:
    """A file's records: all gzip members, one after the other (a file may have one for each record); of a damaged or
    cut off file, what stands before the damage."""
    if content[:2] != b"\x1f\x8b":
        return content
    out, rest = [], content
    while rest[:2] == b"\x1f\x8b":
        reader = zlib.decompressobj(31)
        try:
            for at in range(0, len(rest), 1 << 16):
                out.append(reader.decompress(rest[at : at + (1 << 16)]))
                if reader.eof:
                    break
        except zlib.error:
            break
        if not reader.eof:  # cut off
            break
        rest = reader.unused_data + rest[at + (1 << 16) :]
    return b"".join(out)


def parse(content: bytes) -> Iterator[tuple[int, int, str | None]]:
    """(offset, length, page_id) of the records of a file."""
    at = 0
    while at < len(content):
        head_end = content.find(b"\r\n\r\n", at)
        size = re.search(rb"\r\nContent-Length: (\d+)\r\n", content[at : head_end + 2]) if head_end >= 0 else None
        end = head_end + 4 + int(size[1]) + 4 if size else -1
        if not size or content[at : at + len(HEAD)] != HEAD or content[end - 4 : end] != b"\r\n\r\n":
            after = content.find(b"\n" + HEAD, at + 1)
            end = after + 1 if after >= 0 else len(content)
        name = re.search(rb"WARC-Record-ID: <urn:page:(-?\d+)>", content[at:end])
        yield at, end - at, name[1].decode() if name else None
        at = end


def fixity(spark: SparkSession, path: str) -> DataFrame:
    """(shard, file, seq, offset, length, page_id, sha256, leaf): a row per record of the replica at ``path``.

    ``leaf`` hashes the record's place and its bytes.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, part, raw in zip(batch.column("shard").to_pylist(), batch.column("file").to_pylist(), batch.column("content")):
                content = unpacked(raw.as_py())
                rows = []
                for seq, (offset, length, page) in enumerate(parse(content)):
                    sha = hashlib.sha256(content[offset : offset + length]).hexdigest()
                    leaf = hashlib.sha256(f"{offset}:{length}:{sha}".encode()).hexdigest()
                    rows.append((shard, part, seq, offset, length, None if page is None else int(page), sha, leaf))
                cols = list(zip(*rows)) if rows else [[]] * 8
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
                names = ["shard", "file", "seq", "offset", "length", "page_id", "sha256", "leaf"]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").option("recursiveFileLookup", "true").load(path)
    shard = F.regexp_extract("path", r"/shard=(-?\d+)/", 1).cast("long")
    part = F.regexp_extract("path", r"/file=(\d+)/", 1).cast("int")
    schema = "shard long, file int, seq long, offset long, length long, page_id long, sha256 string, leaf string"
    return files.select(shard.alias("shard"), part.alias("file"), "content").mapInArrow(run, schema)


def tree(spark: SparkSession, leaves: DataFrame, levels: int, cfg: MerkleConfig) -> list[DataFrame]:
    """Nodes (shard, file, node, hash) of each level, leaves first; a parent hashes its children in order. A level is
    written before the next one reads it: it has one row for ``fan`` of the level below."""
    out = [leaves.select("shard", "file", F.col("seq").alias("node"), F.col("leaf").alias("hash"))]
    for _ in range(levels):
        up = out[-1].groupBy("shard", "file", F.expr(f"node div {cfg.fan}").alias("up")).agg(
            F.sort_array(F.collect_list(F.struct("node", "hash"))).alias("children")
        )
        nodes = up.select("shard", "file", F.col("up").alias("node"), F.sha2(F.concat_ws("|", "children.hash"), 256).alias("hash"))
        out.append(materialise(spark, nodes, "merkle-level"))
    return out


def audit(spark: SparkSession, ours: DataFrame, theirs: DataFrame, cfg: MerkleConfig = MerkleConfig()) -> DataFrame:
    """(shard, file, seq): the leaves at which the replicas differ, found by descending mismatching branches only. Each
    step reads one written level of both trees and the branches that are open, so its plan does not grow."""
    most = ours.select("seq").unionByName(theirs.select("seq")).agg(F.max("seq")).first()[0]
    if most is None:
        return ours.select("shard", "file", "seq").where("false")
    levels = 0
    while cfg.fan**levels <= most:
        levels += 1
    a, b = tree(spark, ours, levels, cfg), tree(spark, theirs, levels, cfg)
    keys = ["shard", "file", "node"]
    open_nodes = None
    for level in range(levels, -1, -1):
        x, y = a[level], b[level].withColumnRenamed("hash", "other")
        if open_nodes is not None:
            child = F.expr(f"node div {cfg.fan}").alias("up")
            up = open_nodes.withColumnRenamed("node", "up")
            x = x.select("*", child).join(up, ["shard", "file", "up"], "left_semi").drop("up")
            y = y.select("*", child).join(up, ["shard", "file", "up"], "left_semi").drop("up")
        open_nodes = materialise(spark, x.join(y, keys, "full_outer").where("not (hash <=> other)").select(*keys), "merkle-open")
    return open_nodes.withColumnRenamed("node", "seq")


def audited(spark: SparkSession, ours_path: str, theirs_path: str, cfg: MerkleConfig = MerkleConfig()) -> DataFrame:
    """(page_id, shard, file, seq, offset, length, sha256, damaged) of every record of either replica.

    A record is described as in our replica, one that only the other replica has as there; both kinds of loss are damage.
    """
    ours = materialise(spark, fixity(spark, ours_path), "fixity")
    theirs = materialise(spark, fixity(spark, theirs_path), "fixity")
    keys = ["shard", "file", "seq"]
    bad = audit(spark, ours, theirs, cfg).withColumn("damaged", F.lit(True))
    here = ours.drop("leaf").join(bad, keys, "left").withColumn("damaged", F.coalesce("damaged", F.lit(False)))
    lost = bad.join(ours.select(*keys), keys, "left_anti")
    return here.unionByName(theirs.drop("leaf").join(lost, keys))
