"""WARC archives: an index first, then byte-range reads of selected records.

Writing: payload digests are grouped to find, for equal payloads, the one record that holds them; each task then writes one archive of
separately compressed records and returns an index row for each (file, offset, length, URL, digest).  Reading: selected index rows are sorted by
file and offset, neighbours are joined to ranges of bounded size, and tasks read ranges and cut them into records.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .files import fresh, read
from .store import Scratch
from .words import batches_of

INDEX = "page_id long, url string, file string, offset long, length long, payload_digest string, payload_bytes long, record_type string, refers_to long"
_SALTS = 32
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()

#: Bytes of payloads that a task works on at once, but for a longer one.
TURN = 4 << 20


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool, date: str) -> bytes:
    """One record: an HTTP response, or a revisit whose block has its head alone."""
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = head if revisit else head + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {date}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if revisit:
        lines += [f"WARC-Profile: {_REVISIT}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    lines += [f"WARC-Payload-Digest: sha1:{digest(payload)}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """A record's fields; raises ValueError where lengths or the digest do not hold."""
    front, _, rest = data.partition(b"\r\n\r\n")
    first, *lines = front.decode().split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(x.split(": ", 1) for x in lines)
    block = rest[: int(fields["Content-Length"])]
    if rest[len(block) :] != b"\r\n\r\n":
        raise ValueError("wrong record length")
    head, _, payload = block.partition(b"\r\n\r\n")
    size = int(next(x for x in head.decode().split("\r\n") if x.startswith("Content-Length: "))[16:])
    named = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    revisit = fields["WARC-Type"] == "revisit"
    if not revisit and (len(payload) != size or digest(payload) != named):
        raise ValueError("damaged payload")
    ident = lambda x: int(x[10:-1]) if x and x[10:-1] not in ("", "None") else None
    return {
        "page_id": ident(fields["WARC-Record-ID"]),
        "url": fields.get("WARC-Target-URI"),
        "payload_bytes": size,
        "payload_digest": named,
        "record_type": fields["WARC-Type"],
        "refers_to": ident(fields.get("WARC-Refers-To")),
        "payload": None if revisit else payload,
    }


def _write(uri: str, date: str):
    def write(batches):
        out, at = None, 0
        for batch in batches_of(batches, "html", TURN):
            rows = []
            for r in batch.to_pylist():
                if out is None:
                    system, path, name = fresh(uri, ".warc.gz")
                    out = system.open_output_stream(path, compression=None)
                payload = (r["html"] or "").encode()
                revisit = bool(r["revisit"])
                data = gzip.compress(record(r["page_id"], r["url"], payload, r["refers_to"], revisit, date), 6, mtime=0)
                out.write(data)
                rows.append((r["page_id"], r["url"], name, at, len(data), digest(payload), len(payload), "revisit" if revisit else "response", r["refers_to"]))
                at += len(data)
            cols = list(zip(*rows, strict=True))
            types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], [x.split()[0] for x in INDEX.split(", ")])
        if out is not None:
            out.close()

    return write


def write_warc(pages: DataFrame, min_revisit_bytes: int = 0, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Write a record for each row of ``pages`` (page_id, url, html) and return the index.

    Of equal payloads of at least ``min_revisit_bytes`` the row with the largest page_id is the response and the others revisit it.  A null html
    is an empty payload.  Rows that share the largest page_id are all responses; a null page_id is smaller than any, and where no equal
    payload has one, all are responses.  Other columns are not read; an empty table writes no archive.
    """
    pages = pages.select("page_id", "url", "html").withColumn("key", F.sha1(F.coalesce("html", F.lit(""))))
    sizes = pages.select("page_id", "key", F.coalesce(F.octet_length("html"), F.lit(0)).alias("size")).where(F.col("size") >= min_revisit_bytes)
    tops = sizes.groupBy("key").agg(F.max("page_id").alias("top"), F.count("*").alias("many")).where("many > 1 and top is not null").select("key", "top")
    # a payload may fill a third of the table: its rows are dealt over salts
    salted = tops.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))))
    again = sizes.withColumn("salt", F.pmod(F.xxhash64("page_id"), F.lit(_SALTS)).cast("int")).join(salted, ["key", "salt"]).where("not page_id <=> top")
    again = again.select(F.col("page_id").alias("id"), F.col("key").alias("k"), "top").distinct()
    typed = pages.join(again, pages["page_id"].eqNullSafe(again["id"]) & (pages["key"] == again["k"]), "left")
    typed = typed.select("page_id", "url", "html", F.col("top").alias("refers_to"), F.col("top").isNotNull().alias("revisit"))
    scratch = Scratch(pages.sparkSession, "warc")
    return scratch.write(typed.mapInArrow(_write(scratch.at("archives"), date), INDEX), "index")


def ranges(index: DataFrame, gap: int = 64 << 10, most: int = 8 << 20) -> DataFrame:
    """Byte ranges that cover the index's records: neighbours in a file up to ``gap`` bytes apart, in ranges of about ``most`` bytes.  Repeated rows count once."""
    by = Window.partitionBy("file").orderBy("offset")
    end = F.col("offset") + F.col("length")
    breaks = (F.col("offset") - F.lag(end).over(by) > gap) | (F.floor(F.col("offset") / most) != F.floor(F.lag("offset").over(by) / most))
    runs = index.select("file", "offset", "length").distinct().withColumn("break", F.coalesce(breaks.cast("int"), F.lit(1)))
    runs = runs.withColumn("run", F.sum("break").over(by))
    return runs.groupBy("file", "run").agg(F.min("offset").alias("start"), F.max(end).alias("end"), F.array_sort(F.collect_list(F.struct("offset", "length"))).alias("records"))


def _read(batches):
    types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
    for batch in batches:
        for run in batch.to_pylist():
            data = read(run["file"], run["start"], run["end"] - run["start"])
            rows = []
            for r in run["records"]:
                at = r["offset"] - run["start"]
                rows.append(parse(zlib.decompress(data[at : at + r["length"]], 31)))
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in rows], t) for k, t in zip(rows[0], types, strict=True)], list(rows[0]))


def read_warc(index: DataFrame, gap: int = 64 << 10, most: int = 8 << 20, part_bytes: int = 4 << 20) -> DataFrame:
    """The records of an index or of any selection of its rows; a revisit has no payload of its own.  A damaged record raises.

    Rows that name the same record give it once; rows without a place (file, offset, length) are left out, and an empty index gives no record.
    Ranges are dealt over as many partitions as their bytes fill, since an index row tells little of what its range holds.
    """
    index = index.where("file is not null and offset is not null and length is not null")
    runs = ranges(index, gap, most)
    parts = max(1, -(-int(index.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]) // part_bytes))
    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"
    return runs.repartition(parts, "file", "run").mapInArrow(_read, schema)
