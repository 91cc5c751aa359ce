"""WARC archives: written from pages, and read back by boundary-chain verification.

Reading does not trust the magic line: a payload may hold it. The archives are scanned as segments
that end at each magic line, so a file may be split anywhere. Every task emits, for each segment that
parses as a record header, the record's offset and that of its successor, and follows these pointers
inside its own split. Pointer jumping from each file's start over what leaves a split then finds the
one true entry of every split, and a second scan walks the records from there. Whatever no chain
reaches, such as a magic line inside a payload, is payload.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kinmatch.llm.common import arrow_settings, in_batches, rows_in_order, stage, text_or_empty

MAGIC = "WARC/1.0\r\n"
#: Date of every record written: archives of equal pages are equal.
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"

_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_END = b"\r\n\r\n"


def base32_of_hex(digest: Column) -> Column:
    """Upper-case base32 of a digest of 40 hex digits: five hex digits are four of base 32."""
    letters = []
    for i in range(8):
        value = F.conv(F.substring(digest, 5 * i + 1, 5), 16, 10).cast("int")
        letters += [F.substring(F.lit(_BASE32), F.shiftright(value, shift).bitwiseAND(F.lit(31)) + 1, F.lit(1)) for shift in (15, 10, 5, 0)]
    return F.concat(*letters)


def records(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """(record) one archive record for each row of ``pages`` (page_id, url, html, ...).

    Of rows with equal payloads of at least ``least_bytes`` the smallest page_id is a response and
    larger ones are revisits of it; a null page_id is a response only if its group has no other id.
    Null html is the empty payload, a null url leaves the header out, rows that repeat the smallest
    page_id are all responses, extra columns are ignored.
    """
    payload = text_or_empty("html")
    slim = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").alias("url"), payload.alias("payload"))
    slim = slim.withColumn("digest", F.unhex(F.sha2("payload", 256)))
    groups = slim.where(F.octet_length("payload") >= least_bytes).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    # staged: broadcast by the engine if small, else a join that may split a hot digest
    shared = stage(groups.where("n > 1 AND first IS NOT NULL").select("digest", "first"), "shared-payloads")
    known = slim.join(shared, "digest", "left")
    revisit = F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("page_id"))
    uri = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    name = lambda x: F.concat(F.lit("<urn:page:"), F.coalesce(x.cast("string"), F.lit("null")), F.lit(">\r\n"))
    head = F.concat(
        F.lit(MAGIC + "WARC-Type: "),
        F.when(revisit, "revisit").otherwise("response"),
        F.lit(f"\r\nWARC-Date: {DATE}\r\nContent-Type: text/html; charset=utf-8\r\nWARC-Record-ID: "),
        name(F.col("page_id")),
        F.coalesce(F.concat(F.lit("WARC-Target-URI: "), uri, F.lit("\r\n")), F.lit("")),
        F.when(revisit, F.concat(F.lit(f"WARC-Profile: {PROFILE}\r\nWARC-Refers-To: "), name(F.col("first")))).otherwise(""),
        F.lit("WARC-Payload-Digest: sha1:"),
        base32_of_hex(F.sha1("payload")),
        F.lit("\r\nX-Payload-Length: "),
        F.octet_length("payload").cast("string"),
        F.lit("\r\nContent-Length: "),
        F.when(revisit, F.lit(0)).otherwise(F.octet_length("payload")).cast("string"),
        F.lit("\r\n\r\n"),
    )
    return known.select(F.concat(head, F.when(revisit, "").otherwise(F.col("payload")), F.lit("\r\n")).alias("record"))


def write(pages: DataFrame, folder: str, least_bytes: int = 0) -> None:
    """Write the archives of ``pages``, one for each partition, to a folder that every executor reaches."""
    records(pages, least_bytes).write.option("lineSep", "\r\n").text(folder)


def header_of(segment: bytes) -> tuple[dict[str, str], int] | None:
    """Header fields and length of a record without its magic line; none if it is no header."""
    end = segment.find(_END)
    if end < 0:
        return None
    fields = {}
    for line in segment[:end].split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if not colon or not name or b" " in name:
            return None
        fields[name.decode("latin-1").lower()] = value.strip().decode("utf-8", "replace")
    if not re.fullmatch(r"\d{1,18}", fields.get("content-length", "")) or "warc-type" not in fields:
        return None
    return fields, end + len(_END)


def _segments(spark: SparkSession, folder: str) -> DataFrame:
    """(file, block, content): what stands between magic lines; ``block`` is where the split begins."""
    lines = spark.read.option("lineSep", MAGIC).text(folder)
    place = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")]
    return lines.select(*place, F.col("value").cast("binary").alias("content"))


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per split one row with its size, and one for each candidate record. Offsets count from the split's first segment."""

    def rows() -> Iterator[tuple]:
        for (file, block), segments in groupby(rows_in_order(batches), key=lambda r: r[:2]):
            at, found = 0, []
            for _, _, content in segments:
                if (header := header_of(content)) is not None:
                    found.append((at - len(MAGIC), at + header[1] + int(header[0]["content-length"]) + len(_END)))
                at += len(content) + len(MAGIC)
            out: dict[int, int | None] = {}
            for start, after in reversed(found):  # where the chain leaves the split; none if it breaks
                out[start] = out.get(after) if after < at - len(MAGIC) else after
            yield file, block, None, at
            yield from ((file, block, start, leave) for start, leave in out.items() if leave is not None)

    long, string = pa.int64(), pa.string()
    yield from in_batches(rows(), list(zip(("file", "block", "start", "leave"), (string, long, long, long), strict=True)), 5000)


def entries(spark: SparkSession, folder: str) -> DataFrame:
    """(file, block, base, entry) of each split: offset in the file of its first segment and of its first true record (null: none)."""
    found = stage(_segments(spark, folder).mapInArrow(_candidates, "file string, block long, start long, leave long"), "candidates")
    in_order = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    splits = found.where("start IS NULL").select("file", "block", F.coalesce(F.sum("leave").over(in_order), F.lit(0).cast("long")).alias("base"))
    splits = stage(splits, "splits")
    jumps = found.where("start IS NOT NULL").join(splits, ["file", "block"])
    jumps = stage(jumps.select("file", (F.col("start") + F.col("base")).alias("start"), (F.col("leave") + F.col("base")).alias("leave"), "block"), "jumps")
    # file names compress so well that files' sizes say little of these tables' sizes in memory: no broadcast of them
    jumps = jumps.hint("merge")
    starts = jumps.select("file", "start", "block").hint("merge")
    reached = jumps.where("start = 0").select("file", "start")
    most = splits.groupBy("file").count().agg(F.max("count")).first()[0] or 0
    hops = 1
    while hops < most:  # all true entries less than ``hops`` splits along their chain are reached
        landed = reached.join(jumps, ["file", "start"]).select("file", F.col("leave").alias("start"))
        reached = stage(reached.unionByName(landed.join(starts, ["file", "start"], "left_semi")).distinct(), "reached")
        onward = jumps.select("file", F.col("start").alias("via"), F.col("leave").alias("beyond")).hint("merge")
        twice = jumps.withColumnRenamed("leave", "via").join(onward, ["file", "via"])
        jumps, hops = stage(twice.select("file", "start", F.col("beyond").alias("leave"), "block"), "jumps").hint("merge"), hops * 2
    first = reached.join(starts, ["file", "start"]).groupBy("file", "block").agg(F.min("start").alias("entry"))
    return stage(splits.join(first, ["file", "block"], "left"), "entries")


_RECORD = [
    ("file", pa.string()), ("offset", pa.int64()), ("record_type", pa.string()), ("record_id", pa.string()), ("uri", pa.string()),
    ("refers_to", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("intact", pa.bool_()),
    ("payload", pa.binary()), ("missing", pa.int64()),
]
_SCHEMA = (
    "file string, offset long, record_type string, record_id string, uri string, refers_to string, "
    "payload_bytes long, payload_digest string, intact boolean, payload binary, missing long"
)


def _record(file: str, offset: int, fields: dict[str, str], payload: bytes, missing: int, with_payload: bool) -> tuple:
    """A row of ``read``; with bytes missing, all that is known so far."""
    told = fields.get("warc-payload-digest", "").removeprefix("sha1:")
    size, digest, intact = len(payload), told, None
    if fields["warc-type"] == "revisit":
        size = int(fields.get("x-payload-length", 0))
    elif not missing:
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        intact = not told or digest == told
    known = (file, offset, fields["warc-type"], fields.get("warc-record-id"), fields.get("warc-target-uri"), fields.get("warc-refers-to"))
    return (*known, size, digest, intact, payload if missing or with_payload else None, missing)


def _walk(with_payload: bool):
    """Rows (file, block, base, entry, content) in order in; records out. A row without a type is a piece of payload from before the split."""

    def split(rows: Iterator[tuple]) -> Iterator[tuple]:
        at = None
        head, fields, parts, lacking, due = 0, None, [], 0, None
        for file, _, base, entry, content in rows:
            if at is None:
                at, due = base, entry
            start = at - len(MAGIC)
            at += len(content) + len(MAGIC)
            if start == due:
                fields, begin = header_of(content)
                size = int(fields["content-length"])
                head, due, body = start, start + len(MAGIC) + begin + size + len(_END), content[begin : begin + size]
                parts, lacking = [body], size - len(body)
            elif fields is not None and lacking:
                body = (MAGIC.encode() + content)[:lacking]
                parts.append(body)
                lacking -= len(body)
            elif fields is None and start >= 0:
                yield file, start, None, None, None, None, 0, None, None, MAGIC.encode() + content, 0
                continue
            if fields is not None and not lacking and parts:
                yield _record(file, head, fields, b"".join(parts), 0, with_payload)
                parts = []
        if fields is not None and lacking:
            yield _record(file, head, fields, b"".join(parts), lacking, True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups = groupby(rows_in_order(batches), key=lambda r: r[:2])
        yield from in_batches((row for _, rows in groups for row in split(rows)), _RECORD, 200)

    return run


def read(spark: SparkSession, folder: str, with_payload: bool = False) -> DataFrame:
    """The records of all archives below ``folder``: file, offset, record_type, record_id, uri, refers_to,
    payload_bytes, payload_digest (bare upper-case base32 SHA-1 of the payload read), intact (whether it
    is the digest that the header tells) and, if asked for, payload.

    A revisit has the size and digest that its header tells of the full payload. Reading of a file
    ends where its chain breaks; a record that the file's end cuts off is left out. Empty files give
    no rows.
    """
    arrow_settings(spark)
    known = entries(spark, folder)
    # one row a split, as many as the file listing that the driver holds; a join by exchange could cut a split's segments apart (skew handling)
    scan = _segments(spark, folder).withColumn("seq", F.monotonically_increasing_id()).join(F.broadcast(known), ["file", "block"])
    walked = scan.sortWithinPartitions("file", "block", "seq").select("file", "block", "base", "entry", "content").mapInArrow(_walk(with_payload), _SCHEMA)
    walked = stage(walked, "records")
    whole = walked.where("record_type IS NOT NULL AND missing = 0").drop("missing")
    cut = walked.where("missing > 0")
    if cut.isEmpty():
        return whole

    # payloads that hold a magic line where a split ends: put together from the splits' leading pieces
    after = Window.partitionBy("file").orderBy("offset").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    pieces = cut.unionByName(walked.where("record_type IS NULL"))
    pieces = pieces.withColumn("head", F.last(F.when(F.col("missing") > 0, F.col("offset")), ignorenulls=True).over(after)).where("head IS NOT NULL")

    def finish(table: pa.Table) -> pa.Table:
        rows = sorted(table.select([name for name, _ in _RECORD]).to_pylist(), key=lambda r: r["offset"])
        first, held = rows[0], b"".join(r["payload"] for r in rows[1:])
        if len(held) < first["missing"]:
            return pa.Table.from_batches([], pa.schema(_RECORD))
        payload = first["payload"] + held[: first["missing"]]
        fields = {"warc-type": first["record_type"], "warc-payload-digest": first["payload_digest"] or "", "warc-record-id": first["record_id"], "warc-target-uri": first["uri"]}
        return pa.Table.from_batches(list(in_batches([_record(first["file"], first["offset"], fields, payload, 0, with_payload)], _RECORD)), pa.schema(_RECORD))

    return whole.unionByName(pieces.groupBy("file", "head").applyInArrow(finish, _SCHEMA).drop("missing"))


def pages_of(found: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of records that ``write`` wrote."""
    number = lambda c: F.regexp_extract(c, r"^<urn:page:(-?\d+)>$", 1).try_cast("long")
    return found.select(number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", number("refers_to").alias("refers_to"))
