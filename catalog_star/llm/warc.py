"""WARC archives: a sharded writer whose files depend on nothing but the records, and a reader.

Records are sorted by address and page. Where shards begin follows from a sample of keys
that is itself a function of the keys (those of smallest hash), so neither partitioning nor
retries change a file. A shard is one task's stream; a file is closed before the record that would take it above
``roll_bytes`` of compressed length. Each record is a gzip member of its own. Tasks write under temporary names
and report them; Spark keeps one report per task as the manifest; files in the manifest get their
final names, and a marker tells readers that the archive is whole.
"""

from __future__ import annotations

import base64
import bisect
import gzip
import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog_star.llm.files import exists, open_store
from catalog_star.llm.sampling import smallest_hashes

#: The profile of revisits by payload, and the marker of a whole archive.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MARKER = "_COMMITTED"
_IDS = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
_MANIFEST = "shard long, part long, name string, temporary string, records long, bytes long, sha256 string"
_KEY = ["__url", "__page", "__digest"]


def _record_id(page: int | None, url: str | None, digest: str, copy: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(_IDS, f'{page}|{copy}|{digest}|{url}')}>"


def _uri(page: int | None, url: str | None) -> str:
    """An address that fits a header line; a page without one gets a name."""
    return quote(url, safe="".join(map(chr, range(33, 127)))) if url else f"urn:page:{page}"


def _head(first: str, fields: list[tuple[str, object]]) -> bytes:
    return (first + "\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n").encode()


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _record(kind: str, fields: list[tuple[str, object]], block: bytes) -> bytes:
    head = _head("WARC/1.1", [("WARC-Type", kind), *fields, ("WARC-Block-Digest", f"sha1:{base32_sha1(block)}"), ("Content-Length", len(block))])
    return head + block + b"\r\n\r\n"


def page_record(page, url, payload: bytes, digest: str, size: int, copy: int, refers: tuple | None, date: str) -> bytes:
    """The bytes of a response, or of a revisit if ``refers`` names the page, address and copy it refers to."""
    http = _head("HTTP/1.1 200 OK", [("Content-Type", "text/html; charset=utf-8"), ("Content-Length", size)])
    fields = [
        ("WARC-Record-ID", _record_id(page, url, digest, copy)),
        ("WARC-Date", date),
        ("WARC-Target-URI", _uri(page, url)),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("Content-Type", "application/http; msgtype=response"),
        *([] if page is None else [("Page-ID", page)]),
    ]
    if refers is None:
        return _record("response", fields, http + payload)
    ref_page, ref_url, ref_copy = refers
    fields += [
        ("WARC-Profile", REVISIT_PROFILE),
        ("WARC-Refers-To", _record_id(ref_page, ref_url, digest, ref_copy)),
        ("WARC-Refers-To-Target-URI", _uri(ref_page, ref_url)),
        *([] if ref_page is None else [("Refers-To-Page-ID", ref_page)]),
    ]
    return _record("revisit", fields, http)


class _Shard:
    """The files of one shard, as they are written."""

    def __init__(self, folder: str, shard: int, roll_bytes: int, level: int, date: str):
        self._store, self._path = open_store(folder)
        self._shard, self._roll, self._level, self._date = shard, roll_bytes, level, date
        self._part, self._out = 0, None

    def _packed(self, record: bytes) -> bytes:
        packer = zlib.compressobj(self._level, zlib.DEFLATED, 31)
        return packer.compress(record) + packer.flush()

    def add(self, record: bytes) -> Iterator[dict]:
        packed = self._packed(record)
        if self._out is not None and self._bytes + len(packed) > self._roll:
            yield from self.close()
        if self._out is None:
            self._name = f"shard-{self._shard:06d}-{self._part:06d}.warc.gz"
            self._temporary = f"_temporary/{self._name}.{uuid.uuid4().hex}"
            self._store.create_dir(f"{self._path}/_temporary", recursive=True)
            self._out = self._store.open_output_stream(f"{self._path}/{self._temporary}", compression=None)
            self._hash, self._bytes, self._records = hashlib.sha256(), 0, 0
            info = _record(
                "warcinfo",
                [("WARC-Record-ID", _record_id(None, self._name, "", 0)), ("WARC-Date", self._date), ("WARC-Filename", self._name), ("Content-Type", "application/warc-fields")],
                b"format: WARC File Format 1.1\r\n",
            )
            self._put(self._packed(info))
        self._put(packed)
        self._records += 1

    def _put(self, packed: bytes) -> None:
        self._out.write(packed)
        self._hash.update(packed)
        self._bytes += len(packed)

    def close(self) -> Iterator[dict]:
        if self._out is not None:
            self._out.close()
            self._out = None
            yield dict(shard=self._shard, part=self._part, name=self._name, temporary=self._temporary, records=self._records, bytes=self._bytes, sha256=self._hash.hexdigest())
            self._part += 1


def shard_bounds(keys: DataFrame, shards: int, most_keys: int) -> list[tuple]:
    """First keys of all shards but the first: quantiles of the ``most_keys`` keys of smallest hash, whatever the partitioning."""
    if shards < 2:
        return []
    drawn = smallest_hashes(keys.distinct(), keys.columns, most_keys).collect()
    ranked = sorted(tuple(_sortable(x) for x in row) for row in drawn)
    cuts = {ranked[len(ranked) * i // shards] for i in range(1, shards)} if ranked else set()
    return sorted(cuts - {ranked[0]}) if ranked else []


def _sortable(value) -> tuple:
    """Nulls first; text by code point, as Spark sorts its bytes."""
    return (value is not None, value if value is not None else 0)


def write_archives(
    pages: DataFrame,
    folder: str,
    id: str = "page_id",
    url: str = "url",
    payload: str = "html",
    least_bytes: int = 0,
    shard_bytes: int = 32 << 20,
    roll_bytes: int = 16 << 20,
    sample_keys: int = 20_000,
    level: int = 6,
    date: str = "2024-01-01T00:00:00Z",
) -> DataFrame:
    """Write a record per row below ``folder`` and return the manifest: shard, part, name, temporary, records, bytes, sha256.

    Of records whose payloads of ``least_bytes`` or more are equal, that of the largest (id, url)
    is the response and the others are revisits; of rows equal in all three the first written is it. A null payload
    is empty, a null id or url is left out of the headers. Other columns are not read. An empty table
    makes an archive without files. Payloads cross the network once; who refers to whom is found on digests.
    """
    spark = pages.sparkSession
    rows = pages.select(
        F.col(f"`{url}`").cast("string").alias("__url"),
        F.col(f"`{id}`").cast("long").alias("__page"),
        F.coalesce(F.encode(F.col(f"`{payload}`").cast("string"), "UTF-8"), F.lit(b"")).alias("__payload"),
    ).withColumn("__digest", F.sha1("__payload"))
    total = rows.agg(F.sum(F.octet_length("__payload"))).first()[0] or 0
    bounds = shard_bounds(rows.select("__url", "__page"), -(-total // shard_bytes), sample_keys)
    shards = len(bounds) + 1

    @F.pandas_udf("long")
    def shard_of(urls, pages_):
        keys = zip(urls, pages_)  # pages as text: nulls would turn numbers into floats
        return pd.Series([bisect.bisect_right(bounds, (_sortable(u), _sortable(None if p is None else int(p)))) for u, p in keys], dtype="int64")

    thin = rows.where(F.octet_length("__payload") >= least_bytes).select(*_KEY)
    latest = thin.groupBy("__digest").agg(F.max(F.struct(F.col("__page").alias("page"), F.col("__url").alias("url"))).alias("__latest"), F.count("*").alias("__n"))
    roles = thin.join(latest.where("__n > 1"), "__digest").select(
        *_KEY, F.lit(None).cast("binary").alias("__payload"), F.struct("__latest.page", "__latest.url").alias("__refers")
    )
    both = rows.select(*_KEY, "__payload", F.lit(None).cast(roles.schema["__refers"].dataType).alias("__refers")).unionByName(roles)
    dealt = (
        both.withColumn("__shard", shard_of("__url", F.col("__page").cast("string")))
        .repartitionByRange(shards, "__shard")  # which tasks write a shard has no influence on it
        .sortWithinPartitions("__shard", *_KEY, F.col("__payload").isNotNull())
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, at, copy, refers = None, None, 0, None
        out: _Shard | None = None
        for batch in batches:
            done = []
            for row in range(batch.num_rows):
                url_, page, digest, payload_, refers_, shard_ = (batch.column(i)[row].as_py() for i in range(6))
                if shard_ != shard:
                    done += out.close() if out else []
                    shard, at, out = shard_, None, _Shard(folder, shard_, roll_bytes, level, date)
                if (url_, page, digest) != at:
                    at, copy, refers = (url_, page, digest), 0, None
                if payload_ is None:  # the role of the rows that follow
                    refers = refers_
                    continue
                itself = refers is None or (refers["page"], refers["url"]) == (page, url_) and copy == 0
                sha1 = base64.b32encode(bytes.fromhex(digest)).decode()
                record = page_record(page, url_, payload_, sha1, len(payload_), copy, None if itself else (refers["page"], refers["url"], 0), date)
                copy += 1
                done += out.add(record)
            if done:
                yield pa.RecordBatch.from_pylist(done, schema=_manifest_schema())
        if out and (done := list(out.close())):
            yield pa.RecordBatch.from_pylist(done, schema=_manifest_schema())

    dealt.mapInArrow(write, _MANIFEST).write.mode("overwrite").parquet(f"{folder}/manifest")
    return commit(spark, folder)


def _manifest_schema() -> pa.Schema:
    kinds = {"long": pa.int64(), "string": pa.string()}
    return pa.schema([(x.split()[0], kinds[x.split()[1]]) for x in _MANIFEST.split(", ")])


def commit(spark: SparkSession, folder: str) -> DataFrame:
    """Give the files of the manifest their names, drop what lost attempts left, and mark the archive. May be repeated."""
    manifest = spark.read.schema(_MANIFEST).parquet(f"{folder}/manifest")

    def rename(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = open_store(folder)
        for batch in batches:
            for name, temporary in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if not exists(store, f"{path}/{name}"):
                    store.move(f"{path}/{temporary}", f"{path}/{name}")
            yield batch.select([0])

    named = manifest.select("name", "temporary").repartition(16, "name").mapInArrow(rename, "name string").count()
    store, path = open_store(folder)
    if exists(store, f"{path}/_temporary"):
        store.delete_dir(f"{path}/_temporary")
    with store.open_output_stream(f"{path}/{MARKER}") as out:
        out.write(str(named).encode())
    return manifest


class _Reader:
    """Records of a stream, one after the other."""

    def __init__(self, stream):
        self._stream = stream

    def head(self) -> dict[str, str] | None:
        first = self._stream.readline()
        if not first:
            return None
        fields = {"": first.decode().strip()}
        while line := self._stream.readline().strip():
            name, _, value = line.decode().partition(":")
            fields[name.lower()] = value.strip()
        return fields

    def __iter__(self) -> Iterator[tuple[dict[str, str], bytes]]:
        while (fields := self.head()) is not None:
            block = self._stream.read(int(fields["content-length"]))
            if self._stream.read(4) != b"\r\n\r\n":
                raise ValueError("a record's length is wrong")
            yield fields, block


def _parsed(fields: dict[str, str], block: bytes, with_payload: bool) -> dict:
    http, _, body = block.partition(b"\r\n\r\n")
    response = fields["warc-type"] == "response"
    size = int(_Reader(io.BytesIO(http + b"\r\n\r\n")).head()["content-length"])
    digest = fields["warc-payload-digest"].removeprefix("sha1:")
    if f"sha1:{base32_sha1(block)}" != fields["warc-block-digest"]:
        raise ValueError(f"block of {fields['warc-record-id']} was altered")
    if response and (len(body) != size or base32_sha1(body) != digest):
        raise ValueError(f"payload of {fields['warc-record-id']} was altered")
    number = lambda name: int(fields[name]) if name in fields else None
    return {
        "page_id": number("page-id"),
        "url": fields["warc-target-uri"],
        "record_id": fields["warc-record-id"],
        "record_type": fields["warc-type"],
        "payload_bytes": size,
        "payload_digest": digest,
        "refers_to": number("refers-to-page-id"),
        "payload": body if response and with_payload else None,
    }


def read_archives(spark: SparkSession, folder: str, with_payload: bool = True, batch_bytes: int = 4 << 20) -> DataFrame:
    """The page records of a committed archive; each block and payload is held against its digest, each file against its count of records.

    Returns page_id, url, record_id, record_type, payload_bytes, payload_digest, refers_to and
    payload (null for revisits). Files are streamed: a task holds a batch of records. An archive without marker is refused.
    """
    store, path = open_store(folder)
    if not exists(store, f"{path}/{MARKER}"):
        raise ValueError(f"{folder} holds no committed archive")
    schema = pa.schema(
        [("page_id", pa.int64()), ("url", pa.string()), ("record_id", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())]
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = open_store(folder)
        for batch in batches:
            for name, records in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found, size, count = [], 0, 0
                with store.open_input_stream(f"{path}/{name}", compression=None) as raw, io.BufferedReader(gzip.GzipFile(fileobj=raw), 1 << 18) as stream:
                    for fields, block in _Reader(stream):
                        if fields["warc-type"] == "warcinfo":
                            continue
                        found.append(_parsed(fields, block, with_payload))
                        count += 1
                        size += len(block) if with_payload else 256
                        if size >= batch_bytes:
                            yield pa.RecordBatch.from_pylist(found, schema=schema)
                            found, size = [], 0
                if count != records:
                    raise ValueError(f"{name} has {count} records, not {records}")
                yield pa.RecordBatch.from_pylist(found, schema=schema)

    files = spark.read.schema(_MANIFEST).parquet(f"{folder}/manifest").select("name", "records")
    files = files.repartitionByRange(max(1, files.count()), "name")
    kinds = "page_id long, url string, record_id string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary"
    return files.mapInArrow(read, kinds)
