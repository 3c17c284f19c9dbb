"""WARC archives of pages, indexed while they are written.

Each task writes one archive of separately compressed records and, per record,
an index row with file, offset, length, URL and digest. Readers start from index
rows: the byte ranges of the selected records are sorted, joined where they lie
close together, and fetched one by one.

Records with equal payloads of at least ``least_bytes`` are stored once: the one
with the largest page id is the response, the others are revisits of it.
"""

from __future__ import annotations

import base64
import binascii
import gzip
import hashlib
import uuid
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from veinworks.llm.base import fresh_folder, map_arrow, query, table
from veinworks.llm.files import coalesce, filesystem, read_at, task_name

LEAST_BYTES = 1000
GAP, MOST = 1 << 16, 8 << 20  # bytes between joined ranges, bytes of a joined range
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"


def record_id(page_id) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}')}>"


def build_record(page_id, url: str | None, payload: bytes, digest: str, refers_to, revisit: bool, date: str) -> bytes:
    """One uncompressed record. Page ids and the payload's size stand in fields of their own."""
    body = HTTP % len(payload) + (b"" if revisit else payload)
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", record_id(page_id)), ("WARC-Date", date),
        ("WARC-Target-URI", None if url is None else quote(url, safe="%/:=&?~#+!$,;'@()*[]")),
        ("WARC-Payload-Digest", "sha1:" + base64.b32encode(binascii.unhexlify(digest)).decode()),
        ("WARC-Profile", PROFILE if revisit else None),
        ("WARC-Refers-To", record_id(refers_to) if revisit else None),
        ("X-Refers-To-Page", refers_to if revisit else None), ("X-Page", page_id), ("X-Payload-Length", len(payload)),
        ("Content-Type", "application/http; msgtype=response"), ("Content-Length", len(body)),
    ]
    head = "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None)
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + body + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """(header fields, payload) of an uncompressed record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("no WARC record here")
    fields = dict(line.split(": ", 1) for line in lines)
    body = rest[: int(fields["Content-Length"])]
    return fields, body.partition(b"\r\n\r\n")[2]


def plan_records(pages: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """(page_id, url, payload, digest, refers_to): refers_to is null for responses.

    A null html is an empty payload. Payloads are equal if their SHA-1 and sizes
    are. Rows that repeat the largest page id are all responses; rows with a
    null page id refer to it, and are responses where it is null too. Other
    columns are ignored.
    """
    payload = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    rows = pages.select("page_id", "url", payload.alias("payload")).withColumn("digest", F.sha1("payload"))
    large = rows.where(F.octet_length("payload") >= least_bytes)
    shared = large.groupBy("digest").agg(F.max("page_id").alias("keeper"), F.count(F.lit(1)).alias("n")).where("n > 1")
    # The left side keeps every row; a digest that many rows share is split by adaptive execution.
    joined = rows.join(shared.drop("n"), "digest", "left")
    refers_to = F.when(~F.col("page_id").eqNullSafe(F.col("keeper")), F.col("keeper"))
    return joined.select("page_id", "url", "payload", "digest", refers_to.alias("refers_to"))


def write_archives(pages: DataFrame, folder: str, least_bytes: int = LEAST_BYTES, date: str = DATE) -> DataFrame:
    """Write a record per row of ``pages`` (page_id, url, html); returns the index.

    The index (page_id, url, digest, record_type, refers_to, file, offset,
    length) is kept as Parquet beside the archives.
    """
    kind = pages.schema["page_id"].dataType.simpleString()
    schema = (
        f"page_id {kind}, url string, digest string, record_type string, refers_to {kind}, "
        "file string, offset long, length long"
    )

    def run(batches):
        stream, offset = None, 0
        for batch in batches:
            if stream is None:
                _, name = task_name("pages", ".warc.gz")
                fs, path = filesystem(folder)
                stream = fs.open_output_stream(f"{path}/{name}", compression=None)
            types, places = [], []
            page_ids, urls, payloads, digests, refers = batch.columns
            for k in range(batch.num_rows):
                refers_to = refers[k].as_py()
                record = build_record(
                    page_ids[k].as_py(), urls[k].as_py(), payloads[k].as_py(), digests[k].as_py(), refers_to,
                    refers_to is not None, date,
                )
                packed = gzip.compress(record, 6, mtime=0)
                stream.write(packed)
                types.append("response" if refers_to is None else "revisit")
                places.append((name, offset, len(packed)))
                offset += len(packed)
            files, offsets, lengths = zip(*places, strict=True) if places else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [page_ids, urls, digests, pa.array(types, pa.string()), refers,
                 pa.array(files, pa.string()), pa.array(offsets, pa.int64()), pa.array(lengths, pa.int64())],
                ["page_id", "url", "digest", "record_type", "refers_to", "file", "offset", "length"],
            )
        if stream is not None:
            stream.close()

    fs, path = filesystem(folder)
    fs.create_dir(path, recursive=True)
    map_arrow(plan_records(pages, least_bytes), run, schema).write.parquet(f"{folder}/index")
    return pages.sparkSession.read.schema(schema).parquet(f"{folder}/index")


def read_archives(index: DataFrame, folder: str, gap: int = GAP, most: int = MOST) -> DataFrame:
    """(page_id, url, record_type, digest, payload_bytes, refers_to, payload) of the records of ``index``.

    Any selection of index rows may be read. Everything comes from the records;
    stored payloads are held against their digest. The payload of a revisit is
    null: it is that of the record it refers to.
    """
    kind = index.schema["page_id"].dataType
    number = str(kind.simpleString()) in ("tinyint", "smallint", "int", "bigint")
    names = ["page_id", "url", "record_type", "digest", "payload_bytes", "refers_to", "payload"]
    name_ = kind.simpleString()
    schema = f"page_id {name_}, url string, record_type string, digest string, payload_bytes long, refers_to {name_}, payload binary"

    def as_id(text: str | None):
        return None if text is None or text == "None" else int(text) if number else text

    def rows_of(file: str, url: dict, fs, path: str):
        with fs.open_input_file(f"{path}/{file}") as opened:
            wanted = sorted(url)
            for start, size in coalesce(wanted, gap, most):
                data = read_at(opened, start, size)
                while wanted and wanted[0][0] < start + size:
                    offset, length = wanted.pop(0)
                    fields, payload = parse_record(gzip.decompress(data[offset - start : offset - start + length]))
                    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
                    revisit = fields["WARC-Type"] == "revisit"
                    if not revisit and hashlib.sha1(payload).hexdigest() != digest:
                        raise OSError(f"{file}: payload at {offset} does not match its digest")
                    row = (
                        as_id(fields.get("X-Page")), url[offset, length], fields["WARC-Type"], digest,
                        int(fields["X-Payload-Length"]) if revisit else len(payload),
                        as_id(fields.get("X-Refers-To-Page")), None if revisit else payload,
                    )
                    yield row

    def run(batches):
        fs, path = filesystem(folder)
        types = [pa.int64() if number else pa.string(), *[pa.string()] * 3, pa.int64(), pa.int64() if number else pa.string(), pa.binary()]
        for batch in batches:
            by_file: dict[str, dict] = {}
            for file, offset, length, url in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                by_file.setdefault(file, {})[offset, length] = url
            rows, held = [], 0
            for file, url in sorted(by_file.items()):
                for row in rows_of(file, url, fs, path):
                    rows.append(row)
                    held += row[4]
                    if held >= MOST:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)
                        rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)

    return map_arrow(index.select("file", "offset", "length", "url"), run, schema)


@query(
    "op10_warc",
    """WITH p AS (SELECT page_id, COALESCE(html, '') AS html FROM pages),
    q AS (SELECT page_id, octet_length(encode(html))::BIGINT AS payload_bytes, sha1(html) AS payload_digest FROM p),
    k AS (SELECT payload_digest, MAX(page_id) AS keeper FROM q WHERE payload_bytes >= 1000 GROUP BY payload_digest)
    SELECT page_id, payload_bytes, payload_digest, CASE WHEN keeper <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN keeper <> page_id THEN keeper END AS refers_to FROM q LEFT JOIN k USING (payload_digest)""",
)
def op10(spark, sf_dir):
    """A record for every page, read back through the index."""
    folder = fresh_folder(spark, "warc")
    rows = read_archives(write_archives(table(spark, sf_dir, "pages"), folder), folder)
    return rows.select("page_id", "payload_bytes", F.col("digest").alias("payload_digest"), "record_type", "refers_to")
