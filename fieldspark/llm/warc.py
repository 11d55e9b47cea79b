"""WARC archives with revisit resolution.

Only headers (id, digest, length) are shuffled, by payload digest: the record with the smallest page_id
of those with one payload becomes the original, and its digest, id and address are joined to the
others, which are written as revisit records: fresh headers, the HTTP head, and no payload. Archives are
written by Spark's text writer, whose line separator is the end of a record, so any file system that
Spark knows will do and a lost task is written again. Reading goes by Content-Length, archive by archive.
"""

from __future__ import annotations

import gzip
import hashlib
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldspark.llm.spread import spread_join
from fieldspark.session import materialize

#: Fixed values of the format.
VERSION, RECORD_END = "WARC/1.1", "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
LEAST_BYTES = 100  # smaller payloads are always written
ARCHIVE_BYTES = 32_000_000  # payload bytes of an archive, about

_READ = {
    "record_type": pa.string(),
    "record_id": pa.string(),
    "refers_to_id": pa.string(),
    "page_id": pa.int64(),
    "target_uri": pa.string(),
    "payload_bytes": pa.int64(),
    "payload_digest": pa.string(),
}
_SQL = "record_type string, record_id string, refers_to_id string, page_id long, target_uri string, payload_bytes long, payload_digest string"


def page_records(pages: DataFrame) -> DataFrame:
    """pages(page_id, url, html) -> page_id, target_uri, payload, payload_bytes, payload_digest; null html: empty."""
    payload = F.coalesce(F.col("html").cast("binary"), F.lit("").cast("binary"))
    return pages.select("page_id", F.col("url").alias("target_uri"), payload.alias("payload"), F.octet_length(payload).cast("long").alias("payload_bytes"), F.sha2(payload, 256).alias("payload_digest"))


def origins(headers: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """The original of each payload that several records have: payload_digest, origin_id, origin_uri, copies.

    headers(payload_digest, payload_bytes, page_id, target_uri). The smallest page_id wins, null after
    all others; counted and chosen before the shuffle, so a payload may have any share of the records.
    """
    first = F.min(F.struct(F.col("page_id").isNull().alias("null_id"), "page_id", "target_uri"))
    groups = headers.where(F.col("payload_bytes") >= least_bytes).groupBy("payload_digest").agg(first.alias("first"), F.count(F.lit(1)).alias("copies"))
    return groups.where("copies > 1").select("payload_digest", F.col("first.page_id").alias("origin_id"), F.col("first.target_uri").alias("origin_uri"), "copies")


def with_origins(records: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """records (read more than once) with record_type, and for revisits origin_id and origin_uri.

    The table of originals is written first: Spark broadcasts it where its size allows, and then no payload moves.
    """
    known = materialize(origins(records.drop("payload"), least_bytes), "warc-origins").withColumn("has_origin", F.lit(True))
    total = known.agg(F.coalesce(F.sum("copies"), F.lit(0)).alias("total")).first()["total"]
    if not total:
        return records.select("*", F.lit("response").alias("record_type"), F.lit(None).cast("long").alias("origin_id"), F.lit(None).cast("string").alias("origin_uri"))
    found = spread_join(records, known, ["payload_digest"], "copies", total, "left")
    revisit = F.coalesce("has_origin", F.lit(False)) & ~F.col("page_id").eqNullSafe(F.col("origin_id"))
    only = lambda c: F.when(revisit, F.col(c)).alias(c)
    return found.select(*records.columns, F.when(revisit, "revisit").otherwise("response").alias("record_type"), only("origin_id"), only("origin_uri"))


def record_id(page_id: Column, payload_digest: Column) -> Column:
    """<urn:uuid:...>, the same for the same page_id and payload."""
    h = F.md5(F.concat_ws(":", F.coalesce(page_id.cast("string"), F.lit("-")), payload_digest))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(h, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]), F.lit(">"))


def _line(name: str, value: Column) -> Column:
    """A header line; none for null; line ends within a value are percent-encoded."""
    plain = F.replace(F.replace(value, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.coalesce(F.concat(F.lit(f"{name}: "), plain, F.lit("\r\n")), F.lit(""))


def record_text(date: Column) -> Column:
    """A whole record but for its end, of the columns that with_origins gives."""
    head = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("payload_bytes").cast("string"), F.lit("\r\n\r\n"))
    revisit = F.col("record_type") == "revisit"
    length = F.octet_length(head) + F.when(revisit, F.lit(0)).otherwise(F.col("payload_bytes"))
    return F.concat(
        F.lit(f"{VERSION}\r\n"),
        _line("WARC-Type", F.col("record_type")),
        _line("WARC-Record-ID", record_id(F.col("page_id"), F.col("payload_digest"))),
        _line("WARC-Date", date),
        _line("WARC-Target-URI", F.col("target_uri")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("payload_digest"))),
        _line("WARC-Refers-To", F.when(revisit, record_id(F.col("origin_id"), F.col("payload_digest")))),
        _line("WARC-Refers-To-Target-URI", F.col("origin_uri")),
        _line("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
        _line("X-Page-ID", F.col("page_id").cast("string")),
        _line("Content-Type", F.lit("application/http; msgtype=response")),
        _line("Content-Length", length.cast("string")),
        F.lit("\r\n"),
        head,
        F.when(revisit, F.lit("")).otherwise(F.col("payload").cast("string")),
    )


def write_archives(records: DataFrame, path: str, least_bytes: int = LEAST_BYTES, date: Column | None = None) -> str:
    """Write records (read more than once) as deduplicated gzip archives under path, which must not exist.

    Payloads go where Spark has read them; an archive gets as many records as make ARCHIVE_BYTES on average.
    """
    date = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'") if date is None else date
    mean = records.agg(F.avg("payload_bytes").alias("mean")).first()["mean"] or 0.0
    text = with_origins(records, least_bytes).select(record_text(date).alias("value"))
    text.write.option("lineSep", RECORD_END).option("compression", "gzip").option("maxRecordsPerFile", max(1, int(ARCHIVE_BYTES / (mean + 500)))).text(path)
    return path


def parse_archive(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of each record; gzip by record or as a whole, or plain."""
    f = gzip.open(io.BytesIO(data)) if data[:2] == b"\x1f\x8b" else io.BytesIO(data)
    while line := f.readline():
        if not line.startswith(b"WARC/"):
            raise ValueError("damaged archive: no record where one should begin")
        headers = {}
        while (line := f.readline()).strip():
            name, _, value = line.partition(b":")
            headers[name.decode("latin-1").strip().lower()] = value.strip().decode("utf-8", "replace")
        size = int(headers["content-length"])
        block = f.read(size)
        if len(block) < size or f.read(4) != RECORD_END.encode():
            raise ValueError("damaged archive: a record ends too soon or too late")
        yield headers, block


def read_record(headers: dict[str, str], block: bytes) -> tuple:
    """Values of a record in the order of the columns, then its payload; the payload's digest must agree."""
    head, _, payload = block.partition(b"\r\n\r\n") if headers.get("content-type", "").startswith("application/http") else (b"", b"", block)
    kind, said = headers.get("warc-type"), headers.get("warc-payload-digest", "").removeprefix("sha256:")
    if kind == "revisit":
        sizes = [int(v) for k, _, v in (x.partition(b":") for x in head.split(b"\r\n")[1:]) if k.strip().lower() == b"content-length"]
        size, digest = sizes[0] if sizes else None, said or None
    else:
        size, digest = len(payload), hashlib.sha256(payload).hexdigest()
        if said and len(said) == 64 and said != digest:
            raise ValueError(f"damaged archive: payload of {headers.get('warc-record-id')} does not have its digest")
    page = headers.get("x-page-id")
    return kind, headers.get("warc-record-id"), headers.get("warc-refers-to"), int(page) if page else None, headers.get("warc-target-uri"), size, digest, payload


def _reader(payload: bool):
    kinds = _READ | ({"payload": pa.binary()} if payload else {})

    def batch(rows):
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds.values())], list(kinds))

    def read(batches):
        for files in batches:
            for content in files.column(0):
                rows, held = [], 0
                for headers, block in parse_archive(content.as_py()):
                    if headers.get("warc-type") in ("response", "resource", "revisit"):
                        rows.append(read_record(headers, block)[: len(kinds)])
                        held += len(block) if payload else 200
                    if held > 4_000_000:
                        yield batch(rows)
                        rows, held = [], 0
                yield batch(rows)

    return read


def read_archives(spark: SparkSession, path: str, payload: bool = False) -> DataFrame:
    """Records of all archives under path: record_type, record_id, refers_to_id, page_id, target_uri, payload_bytes, payload_digest (and payload).

    Digest and size of a response are those of the payload read; a revisit's are those its headers give.
    Other kinds of record are passed over. An archive is read by one task; one that is cut or changed is an error.
    """
    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(_reader(payload), _SQL + (", payload binary" if payload else ""))


def resolve_revisits(records: DataFrame) -> DataFrame:
    """records of read_archives (read more than once) -> page_id, target_uri, payload_bytes, payload_digest, record_type, refers_to.

    A revisit takes size and digest from the response it refers to, and that one's page_id as refers_to; a
    digest that differs is an error. Where the response is in none of the archives, it keeps what its
    headers say and refers_to is null.
    """
    revisit = F.col("record_type") == "revisit"
    uses = records.where(revisit).groupBy("refers_to_id").agg(F.count(F.lit(1)).alias("uses"))
    firsts = records.where(~revisit).groupBy("record_id").agg(F.min(F.struct("page_id", "payload_bytes", "payload_digest")).alias("origin"))
    table = materialize(uses.join(firsts.withColumnRenamed("record_id", "refers_to_id"), "refers_to_id"), "warc-referred")
    total = table.agg(F.coalesce(F.sum("uses"), F.lit(0)).alias("total")).first()["total"]
    rows = records.where(revisit)
    found = spread_join(rows, table, ["refers_to_id"], "uses", total, "left")
    differs = F.col("origin.payload_digest") != F.col("payload_digest")
    digest = F.when(differs, F.raise_error(F.lit("a revisit record's digest is not that of the response it refers to"))).otherwise(F.coalesce("origin.payload_digest", "payload_digest"))
    columns = "page_id", "target_uri"
    revisits = found.select(*columns, F.coalesce("origin.payload_bytes", "payload_bytes").alias("payload_bytes"), digest.alias("payload_digest"), "record_type", F.col("origin.page_id").alias("refers_to"))
    return records.where(~revisit).select(*columns, "payload_bytes", "payload_digest", "record_type", F.lit(None).cast("long").alias("refers_to")).unionByName(revisits)


def deduplicate_archives(spark: SparkSession, source: str, target: str, least_bytes: int = LEAST_BYTES) -> str:
    """Archives under source written anew under target, each payload once, revisits referring to it with fresh headers.

    Revisits in the source are joined to their payload's original by digest; one whose payload is in none
    of the archives is an error, as it could not be read any more.
    """
    records = materialize(read_archives(spark, source, payload=True), "warc-records")
    lost = records.where("record_type = 'revisit'").select("payload_digest").join(records.where("record_type <> 'revisit'").select("payload_digest"), "payload_digest", "left_anti")
    if lost.take(1):
        raise ValueError("a revisit record's payload is in none of the archives")
    # a revisit must not become the original that keeps the payload, so originals are chosen among responses
    full = records.where("record_type <> 'revisit'").select("page_id", "target_uri", "payload", "payload_bytes", "payload_digest")
    chosen = materialize(with_origins(full, least_bytes), "warc-chosen")
    kept = chosen.where("record_type = 'response'").groupBy("payload_digest").agg(F.min(F.struct(F.col("page_id").isNull().alias("null_id"), "page_id", "target_uri")).alias("first"))
    again = records.where("record_type = 'revisit'").select("page_id", "target_uri", "payload", "payload_bytes", "payload_digest")
    uses = materialize(again.groupBy("payload_digest").agg(F.count(F.lit(1)).alias("copies")).join(kept, "payload_digest"), "warc-again")
    total = uses.agg(F.coalesce(F.sum("copies"), F.lit(0)).alias("total")).first()["total"]
    joined = spread_join(again, uses, ["payload_digest"], "copies", total)
    revisits = joined.select("page_id", "target_uri", "payload", "payload_bytes", "payload_digest", F.lit("revisit").alias("record_type"), F.col("first.page_id").alias("origin_id"), F.col("first.target_uri").alias("origin_uri"))
    date = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    text = chosen.unionByName(revisits).select(record_text(date).alias("value"))
    mean = full.agg(F.avg("payload_bytes").alias("mean")).first()["mean"] or 0.0
    text.write.option("lineSep", RECORD_END).option("compression", "gzip").option("maxRecordsPerFile", max(1, int(ARCHIVE_BYTES / (mean + 500)))).text(target)
    return target


def archive_pages(pages: DataFrame, path: str) -> DataFrame:
    """pages(page_id, url, html) written as archives under path and read back: page_id, payload_bytes, payload_digest, record_type, refers_to.

    Null html is an empty payload, null url no Target-URI. Of equal payloads of LEAST_BYTES bytes or more the
    smallest page_id is the response (null comes after all others) and the rest revisit it; rows that repeat
    that page_id and payload are responses too, as is every row if all have null page_id. Smaller payloads are
    all responses. Whole payloads of any length up to an Arrow cell's 2 GB. Empty table: no rows. Other columns
    are ignored.
    """
    write_archives(page_records(pages), path)
    records = materialize(read_archives(pages.sparkSession, path), "warc-headers")
    return resolve_revisits(records).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
