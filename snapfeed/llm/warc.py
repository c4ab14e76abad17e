"""WARC archives without repeated payloads: revisit records and their resolution.

Pages become records with a payload digest (SHA-1, base 32).  Only headers are shuffled by digest: of the
records with equal payloads the one with the largest key is the response, all others become revisit records
that refer to it.  Archives are written by Spark's file committer, one gzip stream a file; a record's block is
read back by its Content-Length.  Revisit records are resolved by a join of their headers to the responses.
"""

from __future__ import annotations

import gzip
import hashlib
from base64 import b32encode
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import checkpoint, identified, prepare, unused

CRLF = "\r\n"
#: Fixed values of the format.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DIGITS, BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def digest_of(payload: Column) -> Column:
    """Upper-case base 32 of the payload's SHA-1: five hex digits are four base-32 digits."""
    h = F.sha1(payload)
    return F.concat(*[F.translate(F.lpad(F.conv(F.substring(h, 1 + 5 * i, 5), 16, 32), 4, "0"), DIGITS, BASE32) for i in range(8)])


def _uuid(*parts: Column) -> Column:
    """A name-based record id."""
    h = F.sha1(F.concat_ws("\x1f", *[F.coalesce(p.cast("string"), F.lit("\x00")) for p in parts]))
    cut = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(h, a, n) for a, n in cut]), F.lit(">"))


def records(pages: DataFrame, payload: str = "html", url: str = "url", key: str = "page_id") -> DataFrame:
    """(key, url, payload, bytes, digest, record_id, record_type, refers_to, refers_to_key, refers_to_url): one record a row of ``pages``.

    Rows equal in key, url and payload are told apart by their place (``identified``): of the largest (key, url) of a payload the first row
    is the response, every other row a revisit.  A null payload is empty, and empty payloads are shared like others; a null key is
    smaller than any other; a null url is allowed.  The key is an integer column."""
    (place,) = unused(pages, "_place")
    own = identified(pages, place).select(F.col(key).cast("long").alias("key"), F.col(url).alias("url"), F.coalesce(F.col(payload), F.lit("")).alias("payload"), F.col(place).alias("_place"))
    own = own.withColumn("digest", digest_of(F.col("payload"))).withColumn("bytes", F.octet_length("payload").cast("long"))
    # one join column that tells nulls apart
    own = own.withColumn("_row", F.concat_ws("|", "digest", F.coalesce(F.col("key").cast("string"), F.lit("-")), F.concat(F.lit("u"), F.col("url"))))
    heads = checkpoint(own.groupBy("_row", "key", "url", "digest").agg(F.min("_place").alias("_first")))
    first = checkpoint(heads.groupBy("digest").agg(F.max(F.struct("key", "url")).alias("_of")))
    heads = heads.join(first, "digest").select("_row", "_of", "_first")
    # the first of equal rows is number 1, the others go by their place
    found = own.join(heads, "_row").withColumn("_turn", F.when(F.col("_place") == F.col("_first"), 1).otherwise(F.col("_place")))
    response = (F.col("_turn") == 1) & F.col("key").eqNullSafe(F.col("_of.key")) & F.col("url").eqNullSafe(F.col("_of.url"))
    found = found.withColumn("record_type", F.when(response, "response").otherwise("revisit"))
    again = F.col("record_type") == "revisit"
    return found.select(
        "key", "url", "payload", "bytes", "digest", _uuid(F.col("key"), F.col("url"), F.col("digest"), F.col("_turn")).alias("record_id"), "record_type",
        F.when(again, _uuid(F.col("_of.key"), F.col("_of.url"), F.col("digest"), F.lit(1))).alias("refers_to"),
        F.when(again, F.col("_of.key")).alias("refers_to_key"), F.when(again, F.col("_of.url")).alias("refers_to_url"))


def _header(name: str, value: Column) -> Column:
    return F.concat(F.lit(name + ": "), value, F.lit(CRLF))  # null: no such header


def _one_line(url: str) -> Column:
    return F.replace(F.replace(F.col(url), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))


def write(found: DataFrame, path: str, date: str = "2024-01-01T00:00:00Z") -> None:
    """Write ``records`` as archives below ``path``: fresh headers, a block only for responses (a revisit has the HTTP head only)."""
    again = F.col("record_type") == "revisit"
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), F.col("bytes").cast("string"), F.lit(CRLF * 2))
    head = F.concat_ws(
        "", F.lit(f"WARC/1.1{CRLF}"), _header("WARC-Type", F.col("record_type")), _header("WARC-Record-ID", F.col("record_id")),
        _header("WARC-Date", F.lit(date)), _header("WARC-Target-URI", _one_line("url")), _header("X-Page-Key", F.col("key").cast("string")),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.when(again, _header("WARC-Refers-To", F.col("refers_to"))), F.when(again, _header("WARC-Refers-To-Target-URI", _one_line("refers_to_url"))),
        F.when(again, _header("WARC-Profile", F.lit(PROFILE))), _header("Content-Type", F.lit("application/http; msgtype=response")),
        _header("Content-Length", (F.octet_length(http) + F.when(again, 0).otherwise(F.col("bytes"))).cast("string")), F.lit(CRLF))
    record = F.concat(head, http, F.when(again, "").otherwise(F.col("payload")))
    found.select(record.alias("value")).write.option("lineSep", CRLF * 2).option("compression", "gzip").text(path)


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record of an uncompressed archive."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode("utf-8", "surrogatepass").split(CRLF)
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        headers = dict(x.split(": ", 1) for x in lines[1:])
        size = int(headers["Content-Length"])
        yield headers, data[end + 4: end + 4 + size]
        at = end + 4 + size
        if data[at: at + 4] != b"\r\n\r\n":
            raise ValueError(f"record does not end at byte {at}")
        at += 4


def read(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """The records of the archives below ``path``: key, url, record_id, record_type, digest (as the header has it), refers_to,
    bytes and own_digest of the payload (null for revisits), and the payload itself if asked for.  A file is one row of a
    task, so files should be of tens of MB, as ``write`` makes them from partitions of that size."""
    prepare(spark)
    names = ["key", "url", "record_id", "record_type", "digest", "refers_to", "bytes", "own_digest"] + ["payload"] * payloads
    kinds = [pa.int64(), *[pa.string()] * 5, pa.int64(), pa.string(), *[pa.string()] * payloads]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for content in b.column(0):
                rows = []
                for head, block in parse(gzip.decompress(content.as_py())):
                    whole = head["WARC-Type"] == "response"
                    body = block[block.index(b"\r\n\r\n") + 4:]
                    own = (head.get("X-Page-Key"), head.get("WARC-Target-URI"), head["WARC-Record-ID"], head["WARC-Type"],
                           head["WARC-Payload-Digest"].removeprefix("sha1:"), head.get("WARC-Refers-To"),
                           len(body) if whole else None, b32encode(hashlib.sha1(body).digest()).decode() if whole else None)
                    rows.append((int(own[0]) if own[0] else None, *own[1:], *([body.decode("utf-8", "surrogatepass") if whole else None] * payloads)))
                for at in range(0, len(rows), 512):
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows[at: at + 512], strict=True), kinds, strict=True)], names=names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    return files.mapInArrow(run, "key long, url string, record_id string, record_type string, digest string, refers_to string, bytes long, own_digest string"
                            + ", payload string" * payloads)


def resolve(found: DataFrame) -> DataFrame:
    """(key, bytes, digest, record_type, refers_to_key) of records read back: a revisit gets its payload's size and the response's
    key by a join of its header to the response it refers to.  A revisit without its response in the archives keeps nulls."""
    heads = checkpoint(found.select("key", "record_id", "record_type", "digest", "refers_to", "bytes", "own_digest"))
    responses = heads.where("record_type = 'response'").select(
        "key", "bytes", F.col("own_digest").alias("digest"), "record_type", F.lit(None).cast("long").alias("refers_to_key"))
    originals = heads.where("record_type = 'response'").select(F.col("record_id").alias("refers_to"), F.col("key").alias("refers_to_key"), F.col("bytes").alias("_bytes"))
    revisits = (heads.where("record_type = 'revisit'").drop("bytes").join(originals, "refers_to", "left")
                .select("key", F.col("_bytes").alias("bytes"), "digest", "record_type", "refers_to_key"))
    return responses.unionByName(revisits)
