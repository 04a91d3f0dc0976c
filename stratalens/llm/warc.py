"""Deterministic sharded WARC archives.

Writing:

1. Payload digests are taken, and of records with equal payloads of at least
   ``revisit_bytes`` the one with the largest key is stored; the others become ``revisit``
   records that name it.
2. Keys and payload sizes alone are sorted, added up and cut into shards of
   ``shard_bytes``; the last key of each is its border, so shards depend on rows only and not on how
   they were partitioned.
3. Each shard is sorted and written by one task, record by record as gzip members without
   time stamps.  A file is rolled when its compressed size reaches ``roll_bytes``.  Headers
   (lengths, digests, record ids) are made anew from the record.
4. Files are written under a temporary folder of the task attempt.  The successful
   attempts' files are listed in a pending manifest; then each is renamed, and last the manifest
   is written.  Readers follow the manifest, so files of lost attempts are never seen, and
   every step can be repeated.

Reading streams the files of the manifest, checks both digests of every record and gives one row
per record.

Defined results: NULL payload is empty; NULL key is lowest and written without a key header.
Rows with equal key and payload are separate records with ids of their own, all of
the same type.  An empty table gives an empty manifest.  Other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import materialise
from .shared import MOST_TASKS, one_task_each, open_folder, range_index

SPACE = uuid.UUID("6f1c1d52-2d0b-5c8e-9d5b-3f0c0a7c4d11")
FILES = "name string, hidden string, records long, bytes long, sha1 string, first_key long, last_key long"
RECORDS = (
    "key long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, "
    "file string, payload string"
)
LINE = "\r\n"


def _sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def _uuid(*parts) -> str:
    return f"<urn:uuid:{uuid.uuid5(SPACE, '|'.join(map(str, parts)))}>"


def _member(headers: list[tuple[str, object]], block: bytes) -> bytes:
    """One record as a gzip member; headers without a value are left out."""
    lines = [f"{k}: {v}" for k, v in [*headers, ("WARC-Block-Digest", _sha1(block)), ("Content-Length", len(block))] if v is not None]
    head = LINE.join(["WARC/1.1", *lines, "", ""]).encode()
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress(head + block + b"\r\n\r\n") + pack.flush()


def _record(key, copy: int, url: str | None, payload: bytes, digest: str, refers_to, date: str) -> bytes:
    target = None if url is None else url.replace("\r", "%0D").replace("\n", "%0A")
    named = "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()
    http = LINE.join(["HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8", f"Content-Length: {len(payload)}", "", ""]).encode()
    revisit = refers_to is not None
    headers = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", _uuid(key, digest, copy)),
        ("WARC-Date", date),
        ("WARC-Target-URI", target),
        ("WARC-Payload-Digest", named),
        ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest" if revisit else None),
        ("WARC-Refers-To", _uuid(refers_to, digest, 0) if revisit else None),
        ("X-Record-Key", key),
        ("X-Refers-To-Key", refers_to),
        ("Content-Type", "application/http;msgtype=response"),
    ]
    return _member(headers, http if revisit else http + payload)


def _with_roles(pages: DataFrame, revisit_bytes: int) -> DataFrame:
    """Add ``refers_to``: the key of the stored record with the same payload, NULL if it is this one."""
    shared = (
        pages.where(F.col("size") >= revisit_bytes).groupBy("digest", "size")
        .agg(F.max("key").alias("last"), F.count("*").alias("n")).where("n > 1").drop("n")
    )
    joined = pages.join(materialise(shared), ["digest", "size"], "left")
    other = F.col("last").isNotNull() & ~F.col("last").eqNullSafe(F.col("key"))
    return joined.withColumn("refers_to", F.when(other, F.col("last"))).drop("last")


def _borders(pages: DataFrame, shard_bytes: int) -> list[tuple]:
    """The last (key, digest) of every shard but the last.  The driver holds one key per shard."""
    spread = pages.select("key", "digest", "size").orderBy("key", "digest").withColumn("place", F.monotonically_increasing_id())
    spread = materialise(spread.withColumn("part", F.shiftright("place", 33)))
    parts = spread.groupBy("part").agg(F.sum("size").alias("size")).select(
        "part", F.coalesce(F.sum("size").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("offset")
    )
    inside = F.sum("size").over(Window.partitionBy("part").orderBy("place")) - F.col("size")
    at = spread.withColumn("inside", inside).join(parts, "part")
    shards = at.groupBy(F.floor((F.col("offset") + F.col("inside")) / shard_bytes).alias("shard")).agg(
        F.max(F.struct("key", "digest")).alias("last")
    )
    return [tuple(r["last"]) for r in shards.orderBy("shard").collect()[:-1]]


def write_archives(
    pages: DataFrame,
    path: str,
    *,
    key_column: str = "page_id",
    url_column: str = "url",
    payload_column: str = "html",
    shard_bytes: int = 64 << 20,
    roll_bytes: int = 16 << 20,
    revisit_bytes: int = 1000,
    date: str = "1970-01-01T00:00:00Z",
) -> None:
    """Write one record per row below ``path``, a folder of its own."""
    payload = F.coalesce(F.col(payload_column), F.lit("")).cast("binary")
    rows = pages.select(
        F.col(key_column).cast("long").alias("key"), F.col(url_column).cast("string").alias("url"), payload.alias("payload"),
        F.sha1(payload).alias("digest"), F.octet_length(payload).cast("long").alias("size"),
    )
    borders = _borders(rows, shard_bytes)

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, folder = open_folder(path)
        hidden = f"{folder}/_temporary/attempt-{TaskContext.get().taskAttemptId()}"
        system.create_dir(hidden, recursive=True)
        shard, roll, data, size, keys, last, copy, done = None, 0, [], 0, [], None, 0, []

        def flush():
            nonlocal roll, data, size, keys
            if data:
                name, body = f"shard-{shard:06d}-{roll:04d}.warc.gz", b"".join(data)
                with system.open_output_stream(f"{hidden}/{name}", compression=None) as out:
                    out.write(body)
                done.append((name, f"{hidden}/{name}", len(keys), len(body), hashlib.sha1(body).hexdigest(), keys[0], keys[-1]))
            roll, data, size, keys = roll + 1, [], 0, []

        for pdf in batches:
            for r in pdf.itertuples(index=False):
                key, refers_to = (None if pd.isna(x) else int(x) for x in (r.key, r.refers_to))
                if r.shard != shard:
                    flush()
                    shard, roll = r.shard, 0
                if not data:
                    info = f"software: stratalens{LINE}format: WARC File Format 1.1{LINE}".encode()
                    data.append(_member([("WARC-Type", "warcinfo"), ("WARC-Record-ID", _uuid("info", shard, roll)), ("WARC-Date", date),
                                         ("Content-Type", "application/warc-fields")], info))
                copy = copy + 1 if last == (key, r.digest) else 0
                last = (key, r.digest)
                data.append(_record(key, copy, r.url, bytes(r.payload), r.digest, refers_to, date))
                keys.append(key)
                size += len(data[-1])
                if size >= roll_bytes:
                    flush()
            yield pd.DataFrame(done, columns=[f.split()[0] for f in FILES.split(", ")]).astype({"first_key": "Int64", "last_key": "Int64"})
            done = []
        flush()
        yield pd.DataFrame(done, columns=[f.split()[0] for f in FILES.split(", ")]).astype({"first_key": "Int64", "last_key": "Int64"})

    sharded = _with_roles(rows, revisit_bytes).withColumn("shard", range_index(borders, F.col("key"), F.col("digest")))
    sorted_rows = sharded.repartition(min(len(borders) + 1, MOST_TASKS), "shard").sortWithinPartitions("shard", "key", "digest")
    pending = materialise(sorted_rows.mapInPandas(write, FILES))
    _commit(pending, path)


def _commit(pending: DataFrame, path: str) -> None:
    """Rename the listed files, then publish the manifest."""

    def rename(batches):
        system, folder = open_folder(path)
        for pdf in batches:
            for name, hidden in zip(pdf["name"], pdf["hidden"]):
                if system.get_file_info(f"{folder}/{name}").is_file is False:
                    system.move(hidden, f"{folder}/{name}")
            yield pdf.drop(columns="hidden")

    kept = ", ".join(f for f in FILES.split(", ") if not f.startswith("hidden"))
    pending.mapInPandas(rename, kept).write.parquet(f"{path}/manifest")
    system, folder = open_folder(path)
    if system.get_file_info(f"{folder}/_temporary").type.name == "Directory":
        system.delete_dir(f"{folder}/_temporary")


def _records(stream, piece: int = 1 << 20) -> Iterator[bytes]:
    """The gzip members of a stream, each decompressed."""
    data = stream.read(piece)
    while data:
        unpack, parts = zlib.decompressobj(31), []
        while True:
            parts.append(unpack.decompress(data))
            if unpack.eof:
                data = unpack.unused_data or stream.read(piece)
                break
            data = stream.read(piece)
            if not data:
                raise ValueError("an archive ends inside a record")
        yield b"".join(parts)


def _parsed(record: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = record.partition(b"\r\n\r\n")
    headers = dict(x.split(": ", 1) for x in head.decode().split(LINE)[1:])
    block = rest[: int(headers["Content-Length"])]
    if _sha1(block) != headers["WARC-Block-Digest"]:
        raise ValueError(f"block digest of {headers.get('WARC-Record-ID')} differs")
    return headers, block


def read_archives(spark: SparkSession, path: str, *, with_payload: bool = False) -> DataFrame:
    """One row per record in the archives that the manifest names, as in ``RECORDS``."""
    names = [f.split()[0] for f in RECORDS.split(", ")]

    def read(batches):
        system, folder = open_folder(path)
        for pdf in batches:
            for name in pdf["name"]:
                rows = []
                with system.open_input_stream(f"{folder}/{name}", compression=None) as stream:
                    for record in _records(stream):
                        headers, block = _parsed(record)
                        kind = headers["WARC-Type"]
                        if kind == "warcinfo":
                            continue
                        http, _, payload = block.partition(b"\r\n\r\n")
                        digest = base64.b32decode(headers["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
                        if kind == "response" and hashlib.sha1(payload).hexdigest() != digest:
                            raise ValueError(f"payload digest of {headers['WARC-Record-ID']} differs")
                        length = int(dict(x.split(": ", 1) for x in http.decode().split(LINE)[1:])["Content-Length"])
                        rows.append((
                            headers.get("X-Record-Key"), headers.get("WARC-Target-URI"), kind, headers.get("X-Refers-To-Key"),
                            length, digest, name, payload.decode() if with_payload and kind == "response" else None,
                        ))
                        if len(rows) >= 1000:
                            yield _frame(rows, names)
                            rows = []
                yield _frame(rows, names)

    files = spark.read.parquet(f"{path}/manifest").select("name")
    return one_task_each(files).mapInPandas(read, RECORDS)


def _frame(rows: list[tuple], names: list[str]) -> pd.DataFrame:
    pdf = pd.DataFrame(rows, columns=names)
    for c in ("key", "refers_to"):
        pdf[c] = pd.array([None if x is None else int(x) for x in pdf[c]], dtype="Int64")
    return pdf
