"""Web archives: a deterministic, sharded writer and a reader.

Rows are put in order of page id (then payload digest, then url) and cut into shards of about
``shard_bytes`` payload bytes, by exact running sums over the sorted rows. One task writes a shard, record
by record, each its own gzip member, and begins a new file before the compressed size would pass
``file_bytes``; a shard is meant to be several files. A file is written under a temporary name, moved to
its final one, and listed in the manifest, which Spark commits last: a retried task replaces its files
with the same bytes, and files that the manifest does not list do not count. The same rows and parameters
give the same files, however the rows were dealt out before.

Of records with equal payloads of at least ``least`` bytes, that with the largest page id is the
response and the others are revisits of it. Rows that repeat id, url and payload are counted before
anything is dealt out, and come as pieces of at most ``copies`` records, so that neither a page id nor a
page that a large part of all rows repeats makes a large shard.

Defined results: a NULL html is an empty payload; a NULL page id sorts first, and may be revisited or
revisit like any other (``refers_to`` is then NULL); a NULL url leaves its header out; of rows that repeat
the largest page id one is the response and the others revisit it; every record has an id of its own;
a payload is read whole, whatever its length (one at a time is held); an empty table gives an empty
manifest. Extra columns are not read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from freshet.session import frozen, working_dir

#: The driver holds one key of 36 bytes a shard.
SHARD_BYTES = 64 << 20
FILE_BYTES = 8 << 20
#: Records of one page, url and payload that come as one piece.
COPIES = 10_000
#: Keys whose payloads a task knows to have sent; a payload sent twice is written once all the same.
REMEMBERED = 50_000
LEAST = 0
#: All records carry one date, a parameter, so that files do not depend on the clock.
DATE = "2024-01-01T00:00:00Z"
LEVEL = 6

MANIFEST = "file string, shard int, records bigint, bytes bigint, sha256 string"
RECORDS = "page_id bigint, url string, record_type string, payload_bytes bigint, payload_digest string, refers_to bigint, payload binary, file string, at bigint"
_FIRST = -(1 << 63)


def _qualified(spark: SparkSession, path: str) -> str:
    """The path with the scheme that Spark itself reads and writes it by."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(place).toString()


def _place(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a qualified path and the path within it, in a driver or a task."""
    if path.startswith("file:"):
        path = "file:///" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path)


def sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(*parts: object) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, ':'.join(map(repr, parts)))}>"


def _record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in [*fields, ("Content-Length", str(len(block)))])
    return gzip.compress(b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n", LEVEL, mtime=0)


def page_record(page_id: int | None, url: str | None, digest: str, size: int, payload: bytes | None, owner: int | None, copy: int | None = None) -> bytes:
    """A response with this payload, or without one a revisit of ``owner``'s. ``copy`` numbers records that
    may have others of the same page and payload beside them."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    revisit = payload is None
    block = http if revisit else http + payload
    own = record_id(page_id, digest) if copy is None else record_id(page_id, digest, url, copy)
    fields = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", own), ("WARC-Date", DATE)]
    if url is not None:
        fields.append(("WARC-Target-URI", quote(url, safe="!#$%&'()*+,/:;=?@[]~")))
    if page_id is not None:
        fields.append(("X-Page-ID", str(page_id)))
    if revisit:
        fields += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("WARC-Refers-To", record_id(owner, digest))]
        if owner is not None:
            fields.append(("X-Refers-To-Page-ID", str(owner)))
    fields += [("WARC-Payload-Digest", f"sha1:{digest}"), ("WARC-Block-Digest", f"sha1:{sha1(block)}"), ("Content-Type", "application/http; msgtype=response")]
    return _record(fields, block)


class _Files:
    """The files of one shard, each moved into place when it is full."""

    def __init__(self, root: str, shard: int, limit: int):
        self.fs, self.root = _place(root)
        self.shard, self.limit, self.number, self.out = shard, limit, 0, None

    def add(self, record: bytes) -> tuple | None:
        done = self.close() if self.out and self.size + len(record) > self.limit and self.records else None
        if not self.out:
            self.name = f"shard-{self.shard:05d}-{self.number:04d}.warc.gz"
            self.temporary = f"{self.root}/.{self.name}.{uuid.uuid4().hex}.tmp"
            self.out = self.fs.open_output_stream(self.temporary, compression=None)
            self.size, self.records, self.sha = 0, 0, hashlib.sha256()
            self._put(_record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", record_id(self.name)), ("WARC-Date", DATE), ("WARC-Filename", self.name), ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n"))
        self._put(record)
        self.records += 1
        return done

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.sha.update(data)
        self.size += len(data)

    def close(self) -> tuple:
        self.out.close()
        self.out = None
        final = f"{self.root}/{self.name}"
        try:
            self.fs.move(self.temporary, final)
        except OSError:
            # Some stores do not replace; another attempt's file has the same bytes.
            if self.fs.get_file_info(final).size != self.size:
                raise
            self.fs.delete_file(self.temporary)
        self.number += 1
        return self.name, self.shard, self.records, self.size, self.sha.hexdigest()


def shard_starts(pieces: DataFrame, shard_bytes: int = SHARD_BYTES) -> np.ndarray:
    """The first key of every shard but the first, from frozen ``part, key, bytes`` rows, whose parts are
    ranges of keys: sums within a part, on top of what stands before it."""
    totals = pieces.groupBy("part").agg(F.sum("bytes").alias("bytes")).orderBy("part").collect()
    before, at = [], 0
    for r in totals:
        before.append((r["part"], at))
        at += r["bytes"]
    offsets = pieces.sparkSession.createDataFrame(before, "part int, offset bigint")
    ahead = Window.partitionBy("part").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    sums = pieces.groupBy("part", "key").agg(F.sum("bytes").alias("bytes"))
    running = sums.withColumn("ahead", F.coalesce(F.sum("bytes").over(ahead), F.lit(0))).join(F.broadcast(offsets), "part")
    starts = running.groupBy(F.floor((F.col("ahead") + F.col("offset")) / F.lit(shard_bytes)).alias("shard")).agg(F.min("key").alias("first"))
    return np.array(sorted(bytes(r["first"]) for r in starts.collect())[1:], "S40")


def _key(piece: Column) -> Column:
    """Page id, payload, url and piece as 36 bytes that sort in this order."""
    whole = lambda c, n: F.lpad(F.hex(c), n, "0")
    return F.unhex(F.concat(whole(F.col("id").bitwiseXOR(F.lit(_FIRST)), 16), "digest", whole(F.xxhash64("url"), 16), whole(piece, 8)))


def _pieces(rows: DataFrame, least: int, copies: int) -> DataFrame:
    """What is to be written, without the payloads: a row per page, url, payload and run of copies, in
    ranges of keys. The payloads below ``least`` bytes, of which nothing is revisited, are carried along."""
    heads = rows.select("id", "url", F.octet_length("html").cast("bigint").alias("size"), F.sha1("html").alias("digest"), "html")
    small = F.first(F.when(F.col("size") < least, F.col("html"))) if least > 0 else F.lit(None).cast("string")
    units = frozen(heads.groupBy("id", "url", "size", "digest").agg(F.count("*").alias("n"), small.alias("small")), "page-units")
    # Written, so that the join reads both sides by plain exchanges and can split a hot payload.
    mark = F.struct("id", F.xxhash64("url").alias("h"), "url")
    owners = units.where(F.col("size") >= least).groupBy("digest", "size").agg(F.max(mark).alias("owner"), F.min(mark).alias("other")).where("owner != other")
    owned = units.join(frozen(owners.select("digest", "size", "owner"), "page-owners"), ["digest", "size"], "left")
    response = (F.col("size") >= least) & (F.col("owner").isNull() | ((F.col("owner.id") == F.col("id")) & F.col("owner.url").eqNullSafe(F.col("url"))))
    cut = owned.select("*", response.alias("leads"), F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / copies).cast("int"))).alias("piece"))
    many = F.least(F.col("n") - F.col("piece") * F.lit(copies).cast("bigint"), F.lit(copies).cast("bigint"))
    leads = F.col("leads") & (F.col("piece") == 0)
    size = F.when(F.col("size") < least, F.col("size") * many).when(leads, F.col("size")).otherwise(0) + 512 * many
    owner = F.when(F.col("size") >= least, F.coalesce("owner.id", "id"))
    named = cut.select(_key(F.col("piece")).alias("key"), "id", "url", "size", "digest", "small", leads.alias("leads"), owner.alias("owner"), (F.col("piece") * F.lit(copies).cast("bigint")).alias("begin"), many.alias("many"), size.alias("bytes"))
    return frozen(frozen(named, "page-pieces").repartitionByRange("key").withColumn("part", F.spark_partition_id()), "page-order")


def write_archives(pages: DataFrame, root: str, file_bytes: int = FILE_BYTES, shard_bytes: int = SHARD_BYTES, least: int = LEAST, copies: int = COPIES) -> DataFrame:
    """Write ``page_id, url, html`` rows below ``root`` and return the committed manifest."""
    spark = pages.sparkSession
    root = _qualified(spark, root)
    files, path = _place(root)
    files.create_dir(path, recursive=True)
    rows = pages.select(F.coalesce(F.col("page_id").cast("bigint"), F.lit(_FIRST)).alias("id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    pieces = _pieces(rows, least, copies)
    starts = shard_starts(pieces, shard_bytes)

    @F.pandas_udf("int")
    def shard_of(keys: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(starts, keys.to_numpy().astype("S40"), "right").astype(np.int32))

    @F.pandas_udf("int")
    def shard_once(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        """As above, and nothing for most of the rows whose payload this task has sent there already."""
        sent: set[bytes] = set()
        for keys in batches:
            new = np.array([not (k in sent or sent.add(k)) for k in keys], bool)
            yield pd.Series(np.searchsorted(starts, keys.to_numpy().astype("S40"), "right")).where(new).astype("Int32")
            if len(sent) > REMEMBERED:
                sent = set()

    html = rows.withColumn("digest", F.sha1("html")).select(_key(F.lit(0)).alias("key"), "html").withColumn("shard", shard_once.asNondeterministic()("key")).where("shard is not null")
    both = pieces.select(shard_of("key").alias("shard"), "key", F.lit(0).alias("kind"), "id", "url", "size", "digest", "leads", "owner", "begin", "many", F.col("small").alias("html")).unionByName(
        html.withColumn("kind", F.lit(1)), allowMissingColumns=True
    )
    tasks = min(len(starts) + 1, 2 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = both.repartitionById(tasks, F.col("shard") % tasks).sortWithinPartitions("shard", "key", "kind", "url")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def listed(entries: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_pandas(pd.DataFrame(entries, columns=["file", "shard", "records", "bytes", "sha256"]).astype({"shard": "int32"}), preserve_index=False)

        def records(row: dict, payload: bytes | None) -> Iterator[bytes]:
            page, owner = (None if row[c] in (None, _FIRST) else row[c] for c in ("id", "owner"))
            digest = base64.b32encode(bytes.fromhex(row["digest"])).decode()
            for copy in range(row["begin"], row["begin"] + row["many"]):
                if row["html"] is not None:
                    yield page_record(page, row["url"], digest, row["size"], row["html"].encode(), None, copy)
                elif row["leads"] and copy == 0:
                    yield page_record(page, row["url"], digest, row["size"], payload, None)
                else:
                    yield page_record(page, row["url"], digest, row["size"], None, owner, copy)

        out, waiting = None, None
        for batch in batches:
            # Payloads become Python objects one at a time.
            for row, payload in zip(batch.drop_columns(["html"]).to_pylist(), batch.column("html"), strict=True):
                shard, key = row["shard"], row["key"]
                if row["kind"] == 0:
                    row["html"] = payload.as_py()
                    if row["leads"]:
                        waiting = row
                        continue
                    ready = records(row, None)
                elif waiting and waiting["key"] == key:
                    ready, waiting = records(waiting, payload.as_buffer().to_pybytes()), None
                else:
                    continue
                if out is None or out.shard != shard:
                    if out is not None and out.out:
                        yield listed([out.close()])
                    out = _Files(root, shard, file_bytes)
                for record in ready:
                    done = out.add(record)
                    if done:
                        yield listed([done])
        if waiting:
            raise ValueError(f"no payload came for page {waiting['id']}")
        if out is not None and out.out:
            yield listed([out.close()])

    # A row per file: the list itself needs few files.
    dealt.mapInArrow(run, MANIFEST).repartition(1 + len(starts) // 1000).write.mode("overwrite").parquet(f"{root}/manifest")
    return spark.read.schema(MANIFEST).parquet(f"{root}/manifest")


class _Hashed:
    """A stream that knows the digest of what was read from it."""

    def __init__(self, stream):
        self.stream, self.sha = stream, hashlib.sha256()

    def read(self, size: int) -> bytes:
        data = self.stream.read(size)
        self.sha.update(data)
        return data


def _members(stream, size: int = 1 << 15) -> Iterator[tuple[int, bytes]]:
    """Offset and content of each gzip member, read as a stream."""
    rest, at, start, inflate, parts = b"", 0, 0, zlib.decompressobj(31), []
    while data := rest or stream.read(size):
        parts.append(inflate.decompress(data))
        rest = inflate.unused_data
        at += len(data) - len(rest)
        if inflate.eof:
            yield start, b"".join(parts)
            start, inflate, parts = at, zlib.decompressobj(31), []
        else:
            rest = b""
    if parts:
        raise ValueError("the archive ends within a record")


def parse(record: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = record.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {k.lower(): v for k, _, v in (line.partition(": ") for line in lines)}
    return fields, rest[: int(fields["content-length"])]


def read_archives(spark: SparkSession, root: str, payloads: bool = True) -> DataFrame:
    """Every page record of the files that the manifest lists; digests and lengths are checked.

    ``payload_bytes`` and ``payload_digest`` are those of the full payload, also for revisits, which
    carry none themselves.
    """
    root = _qualified(spark, root)
    manifest = spark.read.schema(MANIFEST).parquet(f"{root}/manifest")
    tasks = max(1, min(manifest.count(), 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = _place(root)
        for batch in batches:
            for name, sha in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows, size = [], 0
                archive = _Hashed(files.open_input_stream(f"{path}/{name}", compression=None))
                for at, record in _members(archive):
                    fields, block = parse(record)
                    if fields["warc-type"] not in ("response", "revisit"):
                        continue
                    http, _, payload = block.partition(b"\r\n\r\n")
                    length = int(http.rpartition(b"Content-Length: ")[2])
                    digest = fields["warc-payload-digest"].removeprefix("sha1:")
                    response = fields["warc-type"] == "response"
                    if f"sha1:{sha1(block)}" != fields["warc-block-digest"] or (response and (sha1(payload) != digest or len(payload) != length)):
                        raise ValueError(f"{name} at {at}: the digest is wrong")
                    number = lambda key: int(fields[key]) if key in fields else None  # noqa: B023, E731
                    rows.append((number("x-page-id"), fields.get("warc-target-uri"), fields["warc-type"], length, digest, number("x-refers-to-page-id"), payload if payloads and response else None, name, at))
                    size += len(payload)
                    if len(rows) == 5000 or size > 8 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)
                        rows, size = [], 0
                # Also an archive that ends between two records.
                if archive.sha.hexdigest() != sha:
                    raise ValueError(f"{name} is not the file that the manifest lists")
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    names = [f.split(" ")[0] for f in RECORDS.split(", ")]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary(), pa.string(), pa.int64()]
    return manifest.select("file", "sha256").repartition(tasks, "file").mapInArrow(run, RECORDS)


def archive_report(pages: DataFrame, root: str | None = None) -> DataFrame:
    """Write the pages, read the archives back, and tell what each record is."""
    spark = pages.sparkSession
    root = root or working_dir(spark, "warc")
    write_archives(pages, root)
    return read_archives(spark, root, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
