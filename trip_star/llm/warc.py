"""WARC archives: a writer of monolithic gzip files and their normaliser.

``write_archives`` writes one archive per task: a single gzip stream that holds
a response record per row, as crawlers leave them. ``normalise`` inflates each
such stream once, from front to back, and rewrites every record as a gzip
member of its own, so that any record can be read alone; records whose payload
another record already has become revisits (headers only, with the digest and
the record they refer to). Beside each archive it writes a sidecar index
(``.idx``: offset, length, record type, digest, record id per line).
``read_members`` reads records by index, each from its offset.

Edge cases: null html is an empty payload; null urls give no target URI; line
ends in a url are escaped; rows without an id and repeated rows are records of
their own (of equal payloads the record with the smallest id, then the first
written, is the response; an id beats none); archives of several gzip members
are read as well; an empty table gives no archive and an empty result. Only id,
url and html are read, so further columns cannot clash.

At scale: payloads go from Parquet to the archives and from archive to archive
in tasks; Spark shuffles only (archive, record number, digest) rows. Memory is
bounded by one record. Files have names of their own per attempt and count only
once the task's rows are written, so a lost executor leaves no half archive in
a result. Folders may be any that pyarrow can open (local, HDFS, S3 also as s3a,
GCS, ABFS), with the credentials that it finds itself; others, such as wasbs, are
an error. They lie under the session's checkpoint folder.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from trip_star.llm.common import lookup, materialise, raw, scratch_dir, sliced

LEVEL = 4
CHUNK = 1 << 20
END = b"\r\n\r\n"
_DATE = "2026-01-01T00:00:00Z"  # records carry no crawl time; a fixed one keeps archives reproducible


def arrow_uri(uri: str) -> str:
    """The uri as pyarrow spells it: Hadoop's names of a store's connector (s3a, s3n;
    abfss) and its short form of local paths are others."""
    for hadoop, arrow in ((r"^file:/+", "file:///"), (r"^s3[an]://", "s3://"), (r"^abfss://", "abfs://")):
        uri = re.sub(hadoop, arrow, uri)
    return uri


def open_folder(uri: str):
    """A file system and the folder's path in it."""
    from pyarrow import fs

    try:
        files, path = fs.FileSystem.from_uri(arrow_uri(uri))
    except pa.ArrowInvalid as e:
        raise ValueError(f"archives can't lie under {uri}: name a local, HDFS, S3, GCS or ABFS folder in spark.checkpoint.dir") from e
    files.create_dir(path, recursive=True)
    return files, path


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(kind: str, record_id: str, url: str | None, digest: str, payload: bytes, refers_to: str | None = None) -> bytes:
    """A WARC record: response (HTTP headers and payload) or revisit (HTTP headers)."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    return _assemble(kind, record_id, url, digest, http, payload if kind == "response" else b"", refers_to)


def _assemble(kind, record_id, url, digest, http: bytes, payload: bytes, refers_to: str | None) -> bytes:
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{record_id}>", f"WARC-Date: {_DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if refers_to is not None:
        head.append(f"WARC-Refers-To: <{refers_to}>")
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    head.append(f"WARC-Payload-Digest: sha1:{digest}")
    head.append("Content-Type: application/http; msgtype=response")
    head.append(f"Content-Length: {len(http) + len(payload)}")
    return "\r\n".join(head).encode() + END + http + payload + END


def parse_headers(head: bytes) -> dict[str, str]:
    lines = head.decode().split("\r\n")[1:]
    return {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}


class Records:
    """The records (headers, block) of a gzip stream, read once from front to back."""

    def __init__(self, stream):
        self.stream, self.inflate, self.buffer = stream, zlib.decompressobj(31), bytearray()

    def _more(self) -> bool:
        data = self.inflate.unused_data if self.inflate.eof else b""
        if self.inflate.eof:
            data = data or self.stream.read(CHUNK)
            if not data:
                return False
            self.inflate = zlib.decompressobj(31)
        else:
            data = self.stream.read(CHUNK)
            if not data:
                if self.inflate.eof or not self.buffer:
                    return False
                raise EOFError("the archive ends inside a record")
        self.buffer += self.inflate.decompress(data)
        return True

    def __iter__(self):
        while True:
            while (end := self.buffer.find(END)) < 0:
                if not self._more():
                    return
            headers = parse_headers(bytes(self.buffer[:end]))
            size = end + len(END) + int(headers["content-length"])
            while len(self.buffer) < size + len(END):
                if not self._more():
                    raise EOFError("the archive ends inside a record")
            block = bytes(self.buffer[end + len(END) : size])
            del self.buffer[: size + len(END)]
            yield headers, block


def record_name(row_id: str | None, archive: str, number: int) -> str:
    return f"urn:record:{archive}:{number}:{'' if row_id is None else row_id}"


def row_id_of(record_id: str) -> str | None:
    return record_id.strip("<>").split(":", 4)[4] or None


def write_archives(
    pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", level: int = LEVEL
) -> DataFrame:
    """Writes the archives; one row per record: ``archive``, ``number`` (from 0),
    ``row_id``, ``payload_bytes``, ``digest``. Every evaluation writes anew, so
    the result is to be materialised."""

    def run(batches):
        archive, number, out, files, gzip = f"{uuid.uuid4().hex}.warc.gz", 0, None, None, None
        for batch in sliced(batches):
            if out is None:
                files, path = open_folder(folder)
                out, gzip = files.open_output_stream(f"{path}/{archive}", compression=None), zlib.compressobj(level, zlib.DEFLATED, 31)
            sizes, digests, numbers = [], [], []
            for row_id, url, payload in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), raw(batch.column(2)), strict=True):
                payload = payload or b""
                digest = base32_sha1(payload)
                out.write(gzip.compress(record("response", record_name(row_id, archive, number), url, digest, payload)))
                sizes.append(len(payload))
                digests.append(digest)
                numbers.append(number)
                number += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array([archive] * len(sizes)), pa.array(numbers, pa.int64()), batch.column(0), pa.array(sizes, pa.int64()), pa.array(digests)],
                names=["archive", "number", "row_id", "payload_bytes", "digest"],
            )
        if out is not None:
            out.write(gzip.flush())
            out.close()

    rows = pages.select(F.col(id_col).cast("string").alias("id"), F.col(url_col).alias("url"), F.col(payload_col).alias("payload"))
    return rows.mapInArrow(run, "archive string, number long, row_id string, payload_bytes long, digest string")


def choose_revisits(records: DataFrame, min_bytes: int = 0, id_type: str = "long") -> DataFrame:
    """``archive``, ``number``, ``first_archive``, ``first_number``, ``first_id``:
    for each record the first one of equal payload (itself below ``min_bytes``).
    ``records`` should be materialised."""
    order = F.struct(F.col("row_id").isNull().alias("nameless"), F.col("row_id").cast(id_type).alias("id"), "archive", "number")
    first = F.min(order)
    large = records.filter(F.col("payload_bytes") >= min_bytes)
    heads = large.groupBy("digest", "payload_bytes").agg(first.alias("first"), F.count(F.lit(1)).alias("n"))
    heads = materialise(heads.withColumn("key", F.concat_ws(":", "digest", "payload_bytes")).select("key", "n", "first"), "payloads")
    keyed = large.withColumn("key", F.concat_ws(":", "digest", "payload_bytes"))
    found = lookup(keyed, heads, "key", "n", records.count()).select(
        "archive", "number", F.col("first.archive").alias("first_archive"), F.col("first.number").alias("first_number"),
        F.col("first.id").cast("string").alias("first_id"),
    )
    small = records.filter(F.col("payload_bytes") < min_bytes)
    return found.unionByName(
        small.select("archive", "number", F.col("archive").alias("first_archive"), F.col("number").alias("first_number"), F.col("row_id").alias("first_id"))
    )


def normalise(decisions: DataFrame, source: str, target: str, level: int = LEVEL) -> DataFrame:
    """Rewrites the archives of ``source`` named in ``decisions`` (see
    ``choose_revisits``; a row per record) to ``target``; one row per record:
    ``archive`` (the new one), ``offset``, ``length``. To be materialised."""
    n = max(1, decisions.select("archive").distinct().count())

    def run(batches):
        def rewrite(archive: str, rows):
            """``rows``: (number, first archive, first number, first id) in order."""
            from_files, from_path = open_folder(source)
            to_files, to_path = open_folder(target)
            name = f"{archive.removesuffix('.warc.gz')}-{uuid.uuid4().hex}.warc.gz"
            index, offset = [], 0
            with (
                from_files.open_input_stream(f"{from_path}/{archive}", compression=None) as stream,
                to_files.open_output_stream(f"{to_path}/{name}", compression=None) as out,
                to_files.open_output_stream(f"{to_path}/{name}.idx", compression=None) as sidecar,
            ):
                for (headers, block), (number, first_archive, first_number, first_id) in zip(Records(stream), rows, strict=True):
                    kind, refers_to = headers["warc-type"], None
                    http, _, payload = block.partition(END)
                    if (first_archive, first_number) != (archive, number):
                        kind, payload, refers_to = "revisit", b"", record_name(first_id, first_archive, first_number)
                    record_id = headers["warc-record-id"].strip("<>")
                    digest = headers["warc-payload-digest"].removeprefix("sha1:")
                    whole = _assemble(kind, record_id, headers.get("warc-target-uri"), digest, http + END, payload, refers_to)
                    gzip = zlib.compressobj(level, zlib.DEFLATED, 31)
                    member = gzip.compress(whole) + gzip.flush()
                    out.write(member)
                    sidecar.write(f"{offset}\t{len(member)}\t{kind}\t{digest}\t{record_id}\n".encode())
                    index.append((name, offset, len(member)))
                    offset += len(member)
            return index

        def emit(index):
            columns = zip(*index, strict=True)
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int64()), strict=True)], names=["archive", "offset", "length"]
            )

        now, rows = None, []
        for batch in batches:
            for archive, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if archive != now:
                    if rows:
                        yield emit(rewrite(now, rows))
                    now, rows = archive, []
                rows.append(row)
        if rows:
            yield emit(rewrite(now, rows))

    columns = ["archive", "number", "first_archive", "first_number", "first_id"]
    return (
        decisions.select(*columns).repartition(n, "archive").sortWithinPartitions("archive", "number")
        .mapInArrow(run, "archive string, offset long, length long")
    )


def read_members(index: DataFrame, folder: str, id_field: StructField) -> DataFrame:
    """One row per indexed record: its id, ``payload_bytes``, ``payload_digest``,
    ``record_type``, ``refers_to``. A response's payload is measured again; a
    revisit's figures are those of its headers."""

    def run(batches):
        files, path = open_folder(folder)
        now, source = None, None
        for batch in batches:
            out = []
            for archive, offset, length in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if archive != now:
                    if source:
                        source.close()
                    now, source = archive, files.open_input_file(f"{path}/{archive}")
                data = zlib.decompress(source.read_at(length, offset), 31)
                head, _, rest = data.partition(END)
                headers = parse_headers(head)
                http, _, payload = rest[: int(headers["content-length"])].partition(END)
                kind, refers_to = headers["warc-type"], headers.get("warc-refers-to")
                if kind == "response":
                    size, digest = len(payload), base32_sha1(payload)
                else:
                    size, digest = int(parse_headers(http)["content-length"]), headers["warc-payload-digest"].removeprefix("sha1:")
                out.append((row_id_of(headers["warc-record-id"]), size, digest, kind, row_id_of(refers_to) if refers_to else None))
            types = (pa.string(), pa.int64(), pa.string(), pa.string(), pa.string())
            columns = zip(*out, strict=True) if out else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
            )
        if source:
            source.close()

    rows = index.select("archive", "offset", "length").mapInArrow(
        run, "id string, payload_bytes long, payload_digest string, record_type string, refers_to string"
    )
    kind = id_field.dataType.simpleString()
    return rows.select(
        F.col("id").cast(kind).alias(id_field.name), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind).alias("refers_to")
    )


def archive_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", min_bytes: int = 0) -> tuple[str, DataFrame]:
    """Writes, normalises and indexes: the folder of the archives, and the index."""
    folder = scratch_dir(pages.sparkSession, "warc")
    records = materialise(write_archives(pages, f"{folder}/whole", id_col, url_col, payload_col), "warc-records")
    decisions = choose_revisits(records, min_bytes, pages.schema[id_col].dataType.simpleString())
    return f"{folder}/members", materialise(normalise(decisions, f"{folder}/whole", f"{folder}/members"), "warc-index")


def query(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    folder, index = archive_pages(pages)
    return read_members(index, folder, pages.schema["page_id"])


SQL = r"""
WITH payloads AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages
),
digests AS (
  SELECT page_id, payload_bytes, array_to_string(list_transform(range(0, 32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           ((('0x' || substr(h, ((i // 4) * 5 + 1)::BIGINT, 5))::INTEGER >> ((3 - i % 4) * 5)::INTEGER) & 31) + 1, 1)), '') AS payload_digest
  FROM payloads
),
firsts AS (SELECT payload_digest, payload_bytes, min(page_id) AS first_id FROM digests GROUP BY ALL)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to
FROM digests JOIN firsts USING (payload_digest, payload_bytes)
"""
