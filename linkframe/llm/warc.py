"""WARC archives, index first.

Every partition writes one gzip-per-record archive into the shared folder and returns an index row per record: file,
offset, length, URL, digest. The index, a table, is the only way in: a task that was lost and run again leaves a file
that no index row names. Reading takes any selection of index rows, sorts them by file and place, joins neighbours into
one byte range (up to a gap and a size) and parses the records out of it.

Records of equal payloads are written once: the one with the smallest id is a response, the others revisit it.

Defined cases: a null payload is an empty one; payloads shorter than ``least_revisit`` bytes are all responses; rows that
share the smallest id and the payload are all responses; a null id is larger than any id, and if all are null all are
responses; a null URL gives no target header, control characters and spaces in one are percent-encoded there; an empty
table gives an empty index. Files are reached through pyarrow's file systems, so the folder may be a path or a URI.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
from collections.abc import Iterator

import pandas as pd
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import fresh_path, materialize, ship

INDEX = "record_id long, url string, file string, offset long, length long, payload_digest string, record_type string"
RECORDS = "record_id long, url string, record_type string, refers_to long, payload_digest string, payload_bytes long, payload binary"
URN = "urn:record:"
FILE_BYTES = 1 << 30
#: Selected records nearer than GAP bytes are read in one range, up to RANGE bytes.
GAP, RANGE = 1 << 16, 8 << 20


def _quoted(url: str) -> str:
    return re.sub(r"[\x00-\x20\x7f-\x9f]", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), url)


def render(record_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """One record, before compression. A revisit keeps the HTTP head, with the payload's length, and drops the payload."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if revisit else head + payload
    lines = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <{URN}{'' if record_id is None else record_id}>",
        "WARC-Date: 1970-01-01T00:00:00Z", *([] if url is None else [f"WARC-Target-URI: {_quoted(url)}"]),
        f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}",
    ]
    if revisit:
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        lines.append(f"WARC-Refers-To: <{URN}{refers_to}>")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(record: bytes) -> dict:
    """The fields of one record; raises if its payload doesn't have the digest it states."""
    top, _, rest = record.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in top.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    head, _, payload = block.partition(b"\r\n\r\n")
    stated = int(re.search(rb"Content-Length: (\d+)", head)[1])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    response = fields["WARC-Type"] == "response"
    if response and (len(payload) != stated or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    number = lambda x: int(n) if x and (n := x[len(URN) + 1 : -1]) else None
    return {
        "record_id": number(fields["WARC-Record-ID"]), "url": fields.get("WARC-Target-URI"), "record_type": fields["WARC-Type"],
        "refers_to": number(fields.get("WARC-Refers-To")), "payload_digest": digest, "payload_bytes": stated,
        "payload": payload if response else None,
    }


def plan(pages: DataFrame, key: str, url: str, payload: Column, least_revisit: int = 0) -> DataFrame:
    """record_id, url, payload, sha1, refers_to (null: a response)."""
    rows = pages.select(F.col(key).cast("long").alias("record_id"), F.col(url).alias("url"), F.coalesce(payload, F.lit(b"")).alias("payload"))
    rows = rows.withColumn("sha1", F.sha1("payload"))
    # Only ids and digests are grouped, summed before the shuffle; the payloads meet one row a digest.
    firsts = rows.where(F.octet_length("payload") >= least_revisit).groupBy("sha1").agg(
        F.min("record_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    joined = rows.join(firsts, "sha1", "left")
    other = F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("record_id"))
    return joined.select("record_id", "url", "payload", "sha1", F.when(other, F.col("first")).alias("refers_to"))


def write(records: DataFrame, name: str = "warc") -> DataFrame:
    """Write the rows of `plan`; the index."""
    ship(records.sparkSession)
    folder = fresh_path(records.sparkSession, name)

    def archived(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, base = fs.FileSystem.from_uri(folder)
        system.create_dir(base, recursive=True)
        out, offset, file = None, 0, ""
        try:
            for b in batches:
                found = []
                for record_id, url, payload, sha1, refers_to in zip(b["record_id"], b["url"], b["payload"], b["sha1"], b["refers_to"]):
                    if out is None or offset >= FILE_BYTES:
                        if out is not None:
                            out.close()
                        file, offset = f"{uuid.uuid4().hex}.warc.gz", 0
                        out = system.open_output_stream(f"{base}/{file}", compression=None)
                    record_id = None if pd.isna(record_id) else int(record_id)
                    url = None if pd.isna(url) else url
                    revisit = not pd.isna(refers_to)
                    digest = base64.b32encode(bytes.fromhex(sha1)).decode()
                    data = gzip.compress(render(record_id, url, bytes(payload), digest, int(refers_to) if revisit else None, revisit), 6, mtime=0)
                    out.write(data)
                    found.append((record_id, url, f"{folder}/{file}", offset, len(data), digest, "revisit" if revisit else "response"))
                    offset += len(data)
                yield pd.DataFrame(found, columns=[c.split()[0] for c in INDEX.split(", ")]).astype({"record_id": "Int64"})
        finally:
            if out is not None:
                out.close()

    # Ids as text: pandas would turn longs with nulls into doubles.
    texts = records.select(F.col("record_id").cast("string"), "url", "payload", "sha1", F.col("refers_to").cast("string"))
    return materialize(texts.mapInPandas(archived, INDEX), f"{name}-index")


def read(index: DataFrame) -> DataFrame:
    """The records of the given index rows, parsed and checked."""
    ship(index.sparkSession)

    def parsed(rows: list[tuple[str, int, int]]) -> list[dict]:
        file, start, _ = rows[0]
        system, path = fs.FileSystem.from_uri(file)
        with system.open_input_file(path) as source:
            data = source.read_at(rows[-1][1] + rows[-1][2] - start, start)
        return [parse(gzip.decompress(data[o - start : o - start + n])) for _, o, n in rows]

    def fetched(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        frame = lambda found: pd.DataFrame(found, columns=[c.split()[0] for c in RECORDS.split(", ")]).astype({"record_id": "Int64", "refers_to": "Int64"})
        run: list[tuple[str, int, int]] = []
        for b in batches:
            for row in zip(b["file"], b["offset"], b["length"]):
                if run and (row[0] != run[-1][0] or row[1] - run[-1][1] - run[-1][2] > GAP or row[1] + row[2] - run[0][1] > RANGE):
                    yield frame(parsed(run))
                    run = []
                run.append(row)
        if run:
            yield frame(parsed(run))

    places = index.select("file", "offset", "length").repartitionByRange("file", "offset").sortWithinPartitions("file", "offset")
    return places.mapInPandas(fetched, RECORDS)
