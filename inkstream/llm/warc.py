"""WARC archives: a writer with revisit records and a sequential, verifying reader.

Writing. Each task streams its rows into archive files of about ``FILE_BYTES``, one gzip member per
record, straight to the shared folder, under a name of its own (partition and a random part), and
returns one manifest row per file. Only files named in the written manifest count: what a lost or
repeated attempt left behind is never read. Whether a payload was seen before is settled first, on
narrow rows: the smallest page id of each digest (aggregated before the shuffle), joined only for
digests that repeat.

Reading. The manifest rows are dealt to tasks; each opens its files as streams and reads them record
by record: a gzip member is inflated piece by piece (``PIECE`` bytes of input at a time), the header
is parsed, the block is taken by its Content-Length, and the SHA-1 digests of block and payload are
checked. A record that is cut short, badly framed or whose digest differs raises an error.

Files are reached through pyarrow's file systems by the URI of the shared folder, so it may be a
mounted folder or any store that pyarrow can open.

Cases: null html is an empty payload (stored like any other); a null url gives a record without a
target; line breaks and other odd characters of urls are percent-encoded; a null id is written as
such, and is a response only if no equal payload has an id; all rows with the smallest id of a payload
are responses; repeated rows are kept; an empty table gives no files and no rows; payloads of any
length are written and read in pieces; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inkstream.llm.common import batch_of, fresh_path, materialize, raw_texts, read

FILE_BYTES = 128 << 20
PIECE = 1 << 18
LEAST = 0                       # payload bytes from which equal payloads are revisits
DATE = "2000-01-01T00:00:00Z"   # fixed, so that archives do not depend on the clock
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = T.StructType([
    T.StructField("page_id", T.LongType()), T.StructField("target_uri", T.StringType()),
    T.StructField("record_type", T.StringType()), T.StructField("payload_bytes", T.LongType()),
    T.StructField("payload_digest", T.StringType()), T.StructField("refers_to", T.LongType()),
    T.StructField("archive", T.StringType()), T.StructField("offset", T.LongType()),
    T.StructField("payload", T.BinaryType())])


class WarcError(ValueError):
    """A record that is cut short, badly framed, or differs from its digest."""


def base32_sha1(raw: bytes) -> str:
    return base64.b32encode(hashlib.sha1(raw).digest()).decode()


# --------------------------------------------------------------------------- one record
def record(fields: list[tuple[str, str]], block: list[bytes], level: int = 6) -> bytes:
    """One gzip member: version line, header fields, block, two empty lines."""
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return b"".join([packer.compress(head.encode()), *map(packer.compress, block),
                     packer.compress(b"\r\n\r\n"), packer.flush()])


def page_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """A response with its payload, or a revisit with the HTTP head alone. The HTTP head keeps the
    length of the full payload, the payload digest is that of the full payload in both."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = [http] if revisit else [http, payload]
    digest = hashlib.sha1()
    for b in block:
        digest.update(b)
    name = "none" if page_id is None else str(page_id)
    fields = [("WARC-Type", "revisit" if revisit else "response"),
              ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{name}')}>"),
              ("WARC-Date", DATE), ("WARC-Page-ID", name),
              ("WARC-Payload-Digest", "sha1:" + base32_sha1(payload)),
              ("WARC-Block-Digest", "sha1:" + base64.b32encode(digest.digest()).decode()),
              ("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(sum(map(len, block))))]
    if url is not None:
        fields.append(("WARC-Target-URI", quote(url, safe="!#$%&'()*+,/:;=?@[]~-._")))
    if revisit:
        other = "none" if refers_to is None else str(refers_to)
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To-Page-ID", other),
                   ("WARC-Refers-To", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{other}')}>")]
    return record(fields, block)


# --------------------------------------------------------------------------- sequential reader
class Members:
    """The bytes of an archive, one gzip member at a time, inflated as they are asked for."""

    def __init__(self, stream):
        self.stream, self.raw, self.read_bytes = stream, b"", 0
        self.inflater, self.data, self.offset = None, b"", 0

    def _more(self) -> bool:
        self.raw = self.stream.read(PIECE)
        self.read_bytes += len(self.raw)
        return bool(self.raw)

    def next_member(self) -> bool:
        """Begin the next member; False at the end of the archive."""
        if not self.raw and not self._more():
            return False
        self.offset = self.read_bytes - len(self.raw)
        self.inflater, self.data = zlib.decompressobj(31), b""
        return True

    def _inflate(self) -> bool:
        """Inflate a piece; False at the end of the member."""
        while not self.inflater.eof:
            if not self.raw and not self.inflater.unconsumed_tail and not self._more():
                raise WarcError(f"member at {self.offset} is cut short")
            try:
                out = self.inflater.decompress(self.inflater.unconsumed_tail or self.raw, PIECE)
            except zlib.error as e:
                raise WarcError(f"member at {self.offset}: {e}") from e
            self.raw = self.inflater.unused_data
            if out:
                self.data += out
                return True
        return False

    def until(self, mark: bytes, most: int = 1 << 20) -> bytes:
        while mark not in self.data:
            if len(self.data) > most or not self._inflate():
                raise WarcError(f"member at {self.offset} has no complete header")
        head, _, self.data = self.data.partition(mark)
        return head

    def pieces(self, size: int) -> Iterator[bytes]:
        """Exactly ``size`` bytes, in pieces."""
        while size:
            if not self.data and not self._inflate():
                raise WarcError(f"block of the member at {self.offset} is cut short")
            part, self.data = self.data[:size], self.data[size:]
            size -= len(part)
            yield part

    def finish(self) -> None:
        """The member ends with two empty lines and nothing else (its check sum is checked here)."""
        while self._inflate():
            if len(self.data) > 4:
                break
        if self.data != b"\r\n\r\n":
            raise WarcError(f"record at {self.offset} does not end after its content length")


def records(stream, keep_payload: bool = True) -> Iterator[dict]:
    """The records of an archive in order; digests are verified."""
    members = Members(stream)
    while members.next_member():
        lines = members.until(b"\r\n\r\n").decode("utf-8", "replace").split("\r\n")
        if not lines[0].startswith("WARC/1."):
            raise WarcError(f"no WARC record at {members.offset}")
        head = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        if not head.get("content-length", "").isdigit():
            raise WarcError(f"record at {members.offset} has no content length")
        block, payload, http = hashlib.sha1(), hashlib.sha1(), b""
        kept, size, in_payload = [], 0, not head.get("content-type", "").startswith("application/http")
        for part in members.pieces(int(head["content-length"])):
            block.update(part)
            if not in_payload:
                http += part
                if b"\r\n\r\n" not in http:
                    continue
                http, _, part = http.partition(b"\r\n\r\n")
                in_payload = True
            payload.update(part)
            size += len(part)
            if keep_payload:
                kept.append(part)
        members.finish()
        for name, got in (("warc-block-digest", block), ("warc-payload-digest", payload)):
            want = head.get(name)
            if want and (name == "warc-block-digest" or head.get("warc-type") != "revisit"):
                kind, _, value = want.partition(":")
                if kind.lower() == "sha1" and value != base64.b32encode(got.digest()).decode():
                    raise WarcError(f"{name} differs in the record at {members.offset}")
        yield {"head": head, "http": http, "payload": b"".join(kept) if keep_payload else None,
               "payload_bytes": size, "offset": members.offset}


def _number(text: str | None) -> int | None:
    return int(text) if text and text != "none" else None


def page_row(rec: dict, archive: str) -> tuple:
    head, kind = rec["head"], rec["head"].get("warc-type")
    size = rec["payload_bytes"]
    if kind == "revisit":       # the HTTP head has the length of the full payload
        for line in rec["http"].decode("latin-1").split("\r\n")[1:]:
            k, _, v = line.partition(":")
            if k.strip().lower() == "content-length":
                size = int(v)
    return (_number(head.get("warc-page-id")), head.get("warc-target-uri"), kind, size,
            head.get("warc-payload-digest", "").partition(":")[2],
            _number(head.get("warc-refers-to-page-id")), archive, rec["offset"], rec["payload"])


# --------------------------------------------------------------------------- Spark
def first_pages(pages: DataFrame, id_col: str, html_col: str, least: int) -> DataFrame:
    """Of each payload that occurs more than once: its key and its smallest page id."""
    size = F.octet_length(F.col("html"))
    keys = pages.select(F.col(id_col).alias("id"), F.coalesce(F.col(html_col), F.lit("")).alias("html")).select(
        "id", F.sha1("html").alias("key"), size.alias("size"))
    return (keys.where(F.col("size") >= least).groupBy("key").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
            .where("n > 1").select("key", "first"))


def write(pages: DataFrame, folder: str, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
          least: int = LEAST, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write the archives below ``folder``; returns the manifest ``archive, records, bytes``."""
    spark = pages.sparkSession
    first = materialize(first_pages(pages, id_col, html_col, least), "warc-first")
    own = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("url"),
                       F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    own = own.withColumn("key", F.when(F.octet_length("html") >= least, F.sha1("html")))
    rows = own.join(first.select("key", F.col("first").cast("long").alias("first"), F.lit(True).alias("again")), "key", "left")
    revisit = F.coalesce(F.col("again") & ~F.col("id").eqNullSafe(F.col("first")), F.lit(False))
    rows = rows.select("id", "url", "html", "first", revisit.alias("revisit"))

    def run(batches):
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        where, path = fs.FileSystem.from_uri(folder)
        out, name, count, size, done = None, "", 0, 0, []
        for batch in batches:
            cols = [batch.column(k) for k in (0, 1, 3, 4)]
            for k, raw in enumerate(raw_texts(batch.column(2))):
                if out is None:
                    name = f"part-{part:05d}-{uuid.uuid4().hex}.warc.gz"
                    out, count, size = where.open_output_stream(f"{path}/{name}", compression=None), 0, 0
                i, url, ref, rev = (c[k].as_py() for c in cols)
                member = page_record(i, url, raw, ref if rev else None, rev)
                out.write(member)
                count, size = count + 1, size + len(member)
                if size >= file_bytes:
                    out.close()
                    done.append((name, count, size))
                    out = None
        if out is not None:
            out.close()
            done.append((name, count, size))
        yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.string()), *[
            pa.array([d[k] for d in done], pa.int64()) for k in (1, 2)]], ["archive", "records", "bytes"])

    where, path = fs.FileSystem.from_uri(folder)
    where.create_dir(path, recursive=True)
    rows.mapInArrow(run, "archive string, records long, bytes long").write.parquet(f"{folder}/manifest")
    return spark.read.parquet(f"{folder}/manifest")


def read_archives(manifest: DataFrame, folder: str, *, with_payload: bool = True) -> DataFrame:
    """One row per record of the archives in ``manifest`` (schema ``RECORD``; payload null unless
    asked for)."""
    def run(batches):
        where, path = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for name, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows, size, seen = [], 0, 0
                with where.open_input_stream(f"{path}/{name}", compression=None) as stream:
                    for rec in records(stream, with_payload):
                        seen += 1
                        rows.append(page_row(rec, name))
                        size += 200 + len(rows[-1][-1] or b"")
                        if size > 8 << 20:
                            yield batch_of(RECORD, list(zip(*rows)))
                            rows, size = [], 0
                if seen != n:
                    raise WarcError(f"{name} holds {seen} of {n} records")
                if rows:
                    yield batch_of(RECORD, list(zip(*rows)))

    files = manifest.select("archive", "records")
    tasks = max(1, files.count())
    return files.repartition(min(tasks, 4096), "archive").mapInArrow(run, RECORD)


def unresolved(rows: DataFrame) -> DataFrame:
    """Revisits whose response is not in the archives, or has another digest."""
    revisits = rows.where("record_type = 'revisit'").alias("r")
    responses = rows.where("record_type = 'response'").select("page_id", "payload_digest").distinct().alias("o")
    same = F.col("r.refers_to").eqNullSafe(F.col("o.page_id")) & (F.col("r.payload_digest") == F.col("o.payload_digest"))
    return revisits.join(responses, same, "left_anti")


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fresh_path(spark, "warc")
    pages = read(spark, sf_dir, "pages", "page_id", "url", "html")
    return read_archives(write(pages, folder), folder, with_payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
f AS (SELECT html, min(page_id) AS first, count(*) AS n FROM p GROUP BY html)
SELECT page_id, CAST(strlen(p.html) AS BIGINT) AS payload_bytes,
  list_aggregate(list_transform(range(0, 32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 + (
    (CAST('0x' || substr(h, CAST(1 + 5 * (k // 4) AS INT), 5) AS INT) >> CAST(15 - 5 * (k % 4) AS INT)) & 31) AS INT), 1)),
    'string_agg', '') AS payload_digest,
  CASE WHEN page_id IS NOT DISTINCT FROM first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM p JOIN f USING (html)
"""
