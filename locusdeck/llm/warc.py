"""WARC archives from page tables: range-sorted shards, files rolled by compressed size, manifests.

Rows are dealt to shards by exact byte counts over ranges of ``page_id`` (of their digests and urls within an id that is larger
than a shard), sorted within their shard, and written as one gzip member per record. A file is closed when its compressed size
reaches ``file_bytes``. Headers and digests are made anew from the payload and depend on nothing
else, so equal input gives equal files whatever tasks are retried.

Tasks write below ``tmp`` under names of their own. The manifest, which Spark commits, lists the files
of the tasks that counted; a second job renames just those to their final names, which may be repeated.

Defined results: a NULL payload is empty; rows without ``page_id`` come first; rows that tie on the
largest id of equal payloads are all responses, as are rows without an id; a NULL url has no target header;
control characters in a url are percent-encoded; an empty table gives an archive without files; other columns are
ignored, whatever their names.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from locusdeck.llm.shared import attach, cut, fits
from locusdeck.session import settings

SHARD_BYTES = 64 * 1024 * 1024
FILE_BYTES = 16 * 1024 * 1024
MIN_BYTES = 0
BINS = 1 << 16
#: About what a record takes besides its payload and url.
HEADER_BYTES = 700
ROWS_AT_ONCE = 500

# --- fixed values of the archive format ---
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"
# --- end of fixed values ---

MANIFEST = "shard int, seq int, path string, final string, bytes long, records long, sha256 string"
RECORDS = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload string"


def _fs(path: str) -> tuple[pafs.FileSystem, str]:
    if "://" not in path and not path.startswith("file:"):
        return pafs.LocalFileSystem(), path
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return pafs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _id(page: int | None, digest: str, url: str | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page}|{digest}|{url}')}>"


def _header_text(url: str) -> str:
    return "".join(f"%{ord(c):02X}" if ord(c) < 33 or ord(c) == 127 else c for c in url)


def record(page: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One record, uncompressed. A revisit holds the response's HTTP header, not its payload."""
    digest = sha1_base32(payload)
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    lines = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", _id(page, digest, url)),
        ("WARC-Date", DATE),
    ]
    if url is not None:
        lines.append(("WARC-Target-URI", _header_text(url)))
    if page is not None:
        lines.append(("X-Page-Id", str(page)))
    if refers_to is not None:
        lines += [("WARC-Profile", PROFILE), ("X-Refers-To-Page-Id", str(refers_to))]
    lines += [
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Block-Digest", f"sha1:{sha1_base32(block)}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    head = "".join(f"{k}: {v}\r\n" for k, v in lines).encode("utf-8", "surrogatepass")
    return VERSION + b"\r\n" + head + b"\r\n" + block + b"\r\n\r\n"


def _member(data: bytes) -> bytes:
    """A gzip member without a time stamp."""
    tool = zlib.compressobj(6, zlib.DEFLATED, 31)
    return tool.compress(data) + tool.flush()


@dataclass
class _File:
    shard: int
    seq: int
    path: str
    stream: pa.NativeFile
    sha: object
    size: int = 0
    records: int = 0


def _writer(folder: str, prefix: str, file_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _fs(folder)
        held: _File | None = None

        def close(f: _File) -> pa.RecordBatch:
            f.stream.close()
            final = f"{prefix}-{f.shard:06d}-{f.seq:05d}.warc.gz"
            row = (f.shard, f.seq, f.path, final, f.size, f.records, f.sha.hexdigest())
            kinds = (pa.int32(), pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string())
            names = [c.split()[0] for c in MANIFEST.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], names)

        for batch in batches:
            for shard, page, url, payload, refers in zip(*(c.to_pylist() for c in batch.columns)):
                if held and (held.shard != shard or held.size >= file_bytes):
                    seq = held.seq + 1 if held.shard == shard else 0
                    yield close(held)
                    held = None
                elif not held:
                    seq = 0
                if not held:
                    name = f"tmp/{shard:06d}-{seq:05d}-{uuid.uuid4().hex}"
                    held = _File(shard, seq, name, fs.open_output_stream(f"{root}/{name}"), hashlib.sha256())
                data = _member(record(page, url, payload.encode("utf-8", "surrogatepass"), refers))
                held.stream.write(data)
                held.sha.update(data)
                held.size += len(data)
                held.records += 1
        if held:
            yield close(held)

    return run


def _renamer(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _fs(folder)
        for batch in batches:
            for path, final, size in zip(*(batch.column(c).to_pylist() for c in ("path", "final", "bytes"))):
                there = fs.get_file_info(f"{root}/{final}")
                if there.type != pafs.FileType.File or there.size != size:
                    fs.move(f"{root}/{path}", f"{root}/{final}")
            yield batch

    return run


def _spread(low: Column, high: Column, value: Column) -> Column:
    """The bin of a value among BINS equal ranges."""
    # Differences of 64-bit numbers are taken exactly; only then do they become fractions.
    exact = lambda c: c.cast("decimal(20,0)")
    share = (exact(value) - exact(low)).cast("double") / ((exact(high) - exact(low)).cast("double") + 1.0)
    return F.least(F.lit(BINS - 1), F.floor(share * BINS)).cast("int")


def sharded(records: DataFrame, shard_bytes: int) -> tuple[DataFrame, int]:
    """``records`` with their shard, and the number of shards: runs of records in the order of ORDER.

    The bytes (``size``) of BINS equal ranges of ids are counted exactly. A range that is larger than a shard is cut into ranges
    of its own, again and again; ids that are large by themselves by their payloads' digest, then by a hash of the url. Records that
    tie in all of these are equal, and are dealt out by count.
    """
    spark = records.sparkSession
    keys = [F.col("page_id"), F.conv(F.substring("sha1", 1, 15), 16, 10).cast("long"), F.xxhash64("url")]
    placed = records.withColumn("place", F.array().cast("array<int>"))
    # What is to be cut next: places with the number of their key and its least and largest value.
    cuts = [((), 0, *records.agg(F.min("page_id"), F.max("page_id")).first())]
    done: list[tuple[tuple, int, bool]] = []
    while cuts:
        kind = "_place array<int>, _key int, _low long, _high long"
        table = F.broadcast(spark.createDataFrame([(list(p), *rest) for p, *rest in cuts], kind))
        value = F.coalesce(*[F.when(F.col("_key") == i, k) for i, k in enumerate(keys)])
        bin_ = F.when(value.isNull(), -1).otherwise(_spread(F.col("_low"), F.col("_high"), value))
        joined = placed.join(table, F.col("place") == F.col("_place"), "left")
        deeper = F.when(F.col("_key").isNull(), F.col("place")).otherwise(F.concat("place", F.array(bin_)))
        placed = joined.withColumn("place", deeper)
        fresh = placed.filter("_key IS NOT NULL")
        sizes = {tuple(r["place"]): (r["size"], r["_key"]) for r in fresh.groupBy("place", "_key").agg(F.sum("size").alias("size")).collect()}
        large = {place for place, (size, _) in sizes.items() if size > shard_bytes}
        done += [(place, size, False) for place, (size, _) in sizes.items() if place not in large]
        cuts = []
        if large:
            wanted = F.broadcast(spark.createDataFrame([(list(p),) for p in large], "_large array<int>"))
            ends = [f(k).alias(f"{n}{i}") for i, k in enumerate(keys) for n, f in (("low", F.min), ("high", F.max))]
            for r in fresh.join(wanted, F.col("place") == F.col("_large")).groupBy("place").agg(*ends).collect():
                place = tuple(r["place"])
                # The first key, from the last one on, by which the place can be cut at all.
                able = [i for i in range(sizes[place][1], len(keys)) if r[f"low{i}"] != r[f"high{i}"]]
                if able:
                    cuts.append((place, able[0], r[f"low{able[0]}"], r[f"high{able[0]}"]))
                else:
                    done.append((place, sizes[place][0], True))
        placed = placed.drop("_place", "_key", "_low", "_high")
    rows, shard, held = [], 0, 0
    for place, size, tied in sorted(done):
        if held and held + size > shard_bytes:
            shard, held = shard + 1, 0
        parts = -(-size // shard_bytes) if tied else 1
        rows.append((list(place), shard, parts))
        held += size
        if parts > 1:
            shard, held = shard + parts, 0
    if not rows:
        return records.withColumn("shard", F.lit(0)), 1
    shards = rows[-1][1] + rows[-1][2]
    table = F.broadcast(spark.createDataFrame(rows, "_place array<int>, _first int, _parts int"))
    dealt = placed.join(table, F.col("place") == F.col("_place")).drop("place", "_place")
    alone = dealt.filter("_parts = 1").withColumn("shard", F.col("_first")).drop("_first", "_parts")
    if all(parts == 1 for _, _, parts in rows):
        return alone, shards
    # Equal records: counted, and dealt out again by their number.
    equal = dealt.filter("_parts > 1").groupBy(*dealt.columns).agg(F.count("*").alias("_k"))
    each = equal.withColumn("_i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_k") - 1)))
    part = F.floor(F.col("_i") * F.col("_parts") / F.col("_k")).cast("int")
    return alone.unionByName(each.withColumn("shard", F.col("_first") + part).select(*alone.columns)), shards


def write(
    pages: DataFrame, folder: str, prefix: str = "pages", shard_bytes: int = SHARD_BYTES,
    file_bytes: int = FILE_BYTES, min_bytes: int = MIN_BYTES,
) -> DataFrame:
    """Write ``page_id``, ``url`` and ``html`` to a new archive folder; returns its manifest.

    Of equal payloads of at least ``min_bytes`` that with the largest id is a response, others revisit it.
    """
    spark = pages.sparkSession
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("payload")
    ).withColumns({"n": F.octet_length("payload"), "sha1": F.sha1(F.col("payload").cast("binary"))})
    same = rows.filter(F.col("n") >= min_bytes).groupBy("sha1").agg(F.max("page_id").alias("first_id"), F.count("*").alias("k"))
    same = cut(same.filter("k > 1 AND first_id IS NOT NULL"))
    if fits(same, 96):
        found = F.broadcast(same.select(F.col("sha1").alias("_sha1"), "first_id"))
        rows = rows.join(found, rows["sha1"] == found["_sha1"], "left").drop("_sha1")
    else:
        rows = attach(rows, same, "sha1", "k")
    revisit = (F.col("n") >= min_bytes) & (F.col("page_id") != F.col("first_id"))
    rows = rows.withColumn("refers_to", F.when(revisit, F.col("first_id"))).drop("first_id")
    payload = F.when(F.col("refers_to").isNull(), F.col("n")).otherwise(0)
    size = payload + HEADER_BYTES + F.coalesce(F.octet_length("url"), F.lit(0))
    dealt, shards = sharded(rows.withColumn("size", size.cast("long")), shard_bytes)
    ordered = (
        dealt.repartitionById(shards, F.col("shard"))
        .sortWithinPartitions("shard", F.col("page_id").asc_nulls_first(), "sha1", F.xxhash64("url"), "url")
        .select("shard", "page_id", "url", "payload", "refers_to")
    )
    fs, root = _fs(folder)
    fs.create_dir(f"{root}/tmp", recursive=True)
    with settings(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": str(ROWS_AT_ONCE)}):
        ordered.mapInArrow(_writer(folder, prefix, file_bytes), MANIFEST).write.parquet(f"{folder}/_manifest")
    manifest = spark.read.schema(MANIFEST).parquet(f"{folder}/_manifest")
    manifest.mapInArrow(_renamer(folder), MANIFEST).write.parquet(f"{folder}/_committed")
    fs.delete_dir(f"{root}/tmp")  # what is left there belongs to attempts that did not count
    return spark.read.schema(MANIFEST).parquet(f"{folder}/_committed")


def _headers(stream) -> dict[str, str]:
    out = {}
    while (line := stream.readline().rstrip(b"\r\n")):
        name, _, value = line.partition(b":")
        out[name.decode("utf-8", "surrogatepass").lower()] = value.strip().decode("utf-8", "surrogatepass")
    return out


def records_of(stream) -> Iterator[tuple]:
    """The records of an uncompressed archive stream, with checked lengths and digests."""
    while line := stream.readline():
        if line.rstrip(b"\r\n") != VERSION:
            raise ValueError("not the beginning of a record")
        head = _headers(stream)
        block = stream.read(int(head["content-length"]))
        if stream.read(4) != b"\r\n\r\n" or head["warc-block-digest"] != f"sha1:{sha1_base32(block)}":
            raise ValueError(f"damaged record {head.get('warc-record-id')}")
        http, _, payload = block.partition(b"\r\n\r\n")
        size = int(http.lower().partition(b"content-length:")[2].split()[0])
        digest = head["warc-payload-digest"].removeprefix("sha1:")
        kind = head["warc-type"]
        if kind == "response" and (len(payload) != size or sha1_base32(payload) != digest):
            raise ValueError(f"damaged payload {head.get('warc-record-id')}")
        page, refers = head.get("x-page-id"), head.get("x-refers-to-page-id")
        yield (
            page and int(page), head.get("warc-target-uri"), size, digest, kind, refers and int(refers),
            payload.decode("utf-8", "surrogatepass") if kind == "response" else None,
        )


class _Checked(io.RawIOBase):
    """A file as it is read, with the size and digest of what has been read."""

    def __init__(self, raw: pa.NativeFile):
        self.raw, self.sha, self.size = raw, hashlib.sha256(), 0

    def readable(self) -> bool:
        return True

    def readinto(self, buffer) -> int:
        data = self.raw.read(len(buffer))
        buffer[: len(data)] = data
        self.sha.update(data)
        self.size += len(data)
        return len(data)


def read(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """The records of a committed archive; ``payload`` is NULL for revisits and if not asked for.

    A file that differs from the manifest in size, digest or number of records is an error.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _fs(folder)
        names = [c.split()[0] for c in RECORDS.split(", ")]
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string())
        for batch in batches:
            for name, size, count, sha in zip(*(c.to_pylist() for c in batch.columns)):
                with fs.open_input_file(f"{root}/{name}") as raw:
                    checked, seen = _Checked(raw), 0
                    held: list[tuple] = []
                    with gzip.GzipFile(fileobj=io.BufferedReader(checked, 1 << 18)) as stream:
                        for row in records_of(stream):
                            seen += 1
                            held.append(row if payloads else (*row[:-1], None))
                            if len(held) == ROWS_AT_ONCE:
                                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names)
                                held = []
                    if (checked.size, seen, checked.sha.hexdigest()) != (size, count, sha):
                        raise ValueError(f"{name} is not the file of the manifest")
                    if held:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names)

    manifest = spark.read.schema(MANIFEST).parquet(f"{folder}/_committed")
    files = manifest.count()
    spread = manifest.select("final", "bytes", "records", "sha256").repartition(max(1, min(files, 4096)))
    return spread.mapInArrow(run, RECORDS)
