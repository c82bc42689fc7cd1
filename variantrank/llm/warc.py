"""WARC archives of pages: written with chunked transfer framing, long records in segments, and read back whole.

Writing. A page is a response record whose block is an HTTP response with a chunked body. A block over `segment` bytes is
split: the response holds the first part, continuation records the others, each with the origin's identifier and its number, the
last also with the total length. Of equal payloads of LEAST_REVISIT bytes or more, the one with the largest page id is
the response and the others are revisit records that name it and hold no body. Spark's text writer puts the blank lines
between records, so archives are gzipped text files on any file system, committed by task.

Reading. The text reader cuts archives before every record, wherever Spark finds them; a record whose payload itself
looks like the beginning of a record is put together again by its content length. Records of one piece are decoded where
they are read. Segments are grouped by their origin's identifier, ordered by number, checked against the total
length and only then freed of their framing, one record at a time. Revisits meet the response they name by a join.

Defined results: a null payload is empty; a null page id has no field in the archive and is null again; of equal payloads with the same
largest page id, that with the largest address is the response; repeated rows are repeated records, all responses or all
revisits, and come back as often as they were written; a null address is left out, and control characters in it are
written as %XX; very long payloads are segments; an empty table gives an archive without records, which gives an empty
table; other columns are ignored. Archives that break the rules give rows with a problem and without digest instead of an error.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from variantrank.llm.common import shared_dir, write_stage

SEGMENT, CHUNK, LEAST_REVISIT = 16_384, 4096, 1000
#: What stands between records, and how each begins but for its minor version.
BETWEEN, BEGIN = "\r\n\r\n", "WARC/1."
MOST_BROADCAST = 1 << 20
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nTransfer-Encoding: chunked\r\n\r\n"


def _urn(*parts: Column) -> Column:
    """A record identifier from values that may be null."""
    digest = F.md5(F.concat(*[F.concat(F.coalesce(F.concat(F.lit("="), p), F.lit("")), F.lit("\n")) for p in parts]))
    return F.concat_ws("-", *[F.substring(digest, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])


def plan(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """(page_id, url, payload, digest, record_id, refers_to): refers_to is the record id of the response that a revisit names.

    Only payloads that occur more than once are listed; the list is broadcast up to MOST_BROADCAST rows and joined by a
    shuffle beyond that. Pages themselves are not shuffled in the first case.
    """
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit("").cast("binary"))
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    long_ones = rows.where(F.length("payload") >= LEAST_REVISIT)
    same = long_ones.groupBy("digest").agg(F.max(F.struct("page_id", "url")).alias("best"), F.count("*").alias("n"))
    same = write_stage(same.where("n > 1").select(F.col("digest").alias("_digest"), "best"), "equal-payloads")
    same = F.broadcast(same) if same.count() <= MOST_BROADCAST else same
    joined = rows.join(same, F.col("digest") == F.col("_digest"), "left")
    is_best = F.col("page_id").eqNullSafe(F.col("best.page_id")) & F.col("url").eqNullSafe(F.col("best.url"))
    named = lambda page, url: _urn(page.cast("string"), url, F.col("digest"))
    return joined.select(
        "page_id", "url", "payload", "digest", named(F.col("page_id"), F.col("url")).alias("record_id"),
        F.when(F.col("best").isNotNull() & ~is_best, named(F.col("best.page_id"), F.col("best.url"))).alias("refers_to"),
    )


def chunked(payload: bytes, size: int) -> bytes:
    """The payload in HTTP's chunked framing."""
    chunks = [payload[i : i + size] for i in range(0, len(payload), size)]
    return b"".join(b"%x\r\n%b\r\n" % (len(c), c) for c in chunks) + b"0\r\n\r\n"


def _head(fields: list[tuple[str, object]]) -> bytes:
    lines = [f"{name}: {value}" for name, value in fields if value is not None]
    return "\r\n".join([f"{BEGIN}1", *lines, "", ""]).encode()


def _records(batches: Iterator[pa.RecordBatch], segment: int, chunk: int) -> Iterator[pa.RecordBatch]:
    """The records of pages as plan() gives them, without what stands between records."""
    for batch in batches:
        out, size = [], 0
        for page, url, payload, digest, record, refers in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            target = url and re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)
            named = [("WARC-Record-ID", f"<urn:uuid:{record}>"), ("WARC-Date", DATE), ("WARC-Target-URI", target), ("X-Page-ID", page)]
            named.append(("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()))
            kind = ("Content-Type", "application/http; msgtype=response")
            if refers is not None:
                revisit = [("WARC-Type", "revisit"), *named, ("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<urn:uuid:{refers}>"), kind]
                out.append(_head([*revisit, ("Content-Length", len(HTTP))]) + HTTP)
                continue
            block = HTTP + chunked(payload, chunk)
            parts = [block[i : i + segment] for i in range(0, len(block), segment)]
            first = [("WARC-Type", "response"), *named, ("WARC-Segment-Number", 1 if len(parts) > 1 else None), kind]
            out.append(_head([*first, ("Content-Length", len(parts[0]))]) + parts[0])
            for n, part in enumerate(parts[1:], 2):
                own = uuid.uuid5(uuid.UUID(record), str(n))
                fields = [("WARC-Type", "continuation"), ("WARC-Record-ID", f"<urn:uuid:{own}>"), ("WARC-Date", DATE), ("WARC-Target-URI", target)]
                fields += [("WARC-Segment-Origin-ID", f"<urn:uuid:{record}>"), ("WARC-Segment-Number", n)]
                fields += [("WARC-Segment-Total-Length", len(block) if n == len(parts) else None), ("Content-Length", len(part))]
                out.append(_head(fields) + part)
            size += len(block)
            if size > 1 << 23:
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])
                out, size = [], 0
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])


def write(pages: DataFrame, path: str, segment: int = SEGMENT, chunk: int = CHUNK, **columns: str) -> None:
    """Write pages as gzipped archives below path."""
    planned = plan(pages, **columns).withColumn("page_id", F.col("page_id").cast("string"))
    records = planned.mapInArrow(lambda batches: _records(batches, segment, chunk), "value binary")
    records.select(F.col("value").cast("string")).write.option("lineSep", BETWEEN).option("compression", "gzip").text(path)


def dechunked(body: bytes) -> bytes | None:
    """The body without its chunked framing; null if the framing is broken."""
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        size = re.fullmatch(rb"([0-9A-Fa-f]+)[ \t]*(?:;.*)?", body[at:end], re.DOTALL) if end >= 0 else None
        if not size:
            return None
        n, at = int(size[1], 16), end + 2
        if n == 0:
            return b"".join(out)
        out.append(body[at : at + n])
        at += n
        if len(out[-1]) < n or body[at : at + 2] != b"\r\n":
            return None
        at += 2


def payload_of(block: bytes) -> bytes | None:
    """The payload of an HTTP response; null if it is broken."""
    head, found, body = block.partition(b"\r\n\r\n")
    if not found or not head.startswith(b"HTTP/"):
        return None
    return dechunked(body) if re.search(rb"(?im)^transfer-encoding:[ \t]*chunked[ \t\r]*$", head) else body


def _fragments(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, bytes, str | None]]:
    """(fields in lower case, block, problem) of the records in fragments (file, value), in the order of the files."""
    fields, parts, have, need, current = {}, None, 0, 0, None
    for batch in batches:
        for file, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            value = value.as_py()
            if parts is not None and file != current:
                yield fields, b"".join(parts), "truncated"
                parts = None
            current = file
            if parts is None:
                value = value.removeprefix(BEGIN.encode())
                head, found, rest = value.partition(b"\r\n\r\n")
                version, *lines = head.split(b"\r\n")
                pairs = [line.decode("utf-8", "replace").partition(":") for line in lines]
                fields = {name.strip().lower(): said.strip() for name, _, said in pairs}
                length = fields.get("content-length", "")
                if not value.strip():
                    continue
                if not found or not version.isdigit() or not length.isdigit():
                    yield fields, b"", "no record header"
                    continue
                parts, have, need = [rest], len(rest), int(length)
            else:  # the payload held what looks like the beginning of a record
                parts += [(BETWEEN + BEGIN).encode(), value]
                have += len(parts[-1]) + len(parts[-2])
            if have >= need:
                block = b"".join(parts)
                yield fields, block[:need], None if not block[need:].strip(b"\r\n") else "longer than its length"
                parts = None
    if parts is not None:
        yield fields, b"".join(parts), "truncated"


def _bare(value: str | None) -> str | None:
    return value and value.strip("<>").removeprefix("urn:uuid:")


def _hex(digest: str | None) -> str | None:
    """The SHA-1 of a digest field, written in base 32 or 16."""
    kind, _, said = (digest or "").partition(":")
    if kind.lower() != "sha1":
        return None
    try:
        return said.lower() if len(said) == 40 else base64.b32decode(said.upper()).hex()
    except binascii.Error:
        return None


PARSED = (
    "record_type string, record_id string, page_id string, url string, said_digest string, refers_to string, origin string, "
    "number long, total long, block binary, payload binary, payload_bytes long, payload_digest string, problem string"
)
KINDS = [pa.string()] * 7 + [pa.int64()] * 2 + [pa.binary()] * 2 + [pa.int64(), pa.string(), pa.string()]
FIELDS = [c.split()[0] for c in PARSED.split(", ")]


def _decoded(row: dict, block: bytes, with_payload: bool) -> dict:
    """The row with what its whole block holds."""
    payload = payload_of(block)
    if payload is None:
        return row | {"problem": row["problem"] or "broken response"}
    digest = hashlib.sha1(payload).hexdigest()
    wrong = "other digest" if row["said_digest"] not in (None, digest) else None
    return row | {"payload": payload if with_payload else None, "payload_bytes": len(payload), "payload_digest": digest, "problem": row["problem"] or wrong}


def _number(value: str | None) -> int | None:
    return int(value) if value and value.isdigit() and len(value) < 19 else None


def _batches(rows: Iterator[dict]) -> Iterator[pa.RecordBatch]:
    out, size = [], 0

    def made() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r.get(c) for r in out], t) for c, t in zip(FIELDS, KINDS, strict=True)], FIELDS)

    for row in rows:
        out.append(row)
        size += 200 + len(row.get("block") or b"") + len(row.get("payload") or b"")
        if size > 1 << 23:
            yield made()
            out, size = [], 0
    yield made()


def _parsed(batches: Iterator[pa.RecordBatch], with_payload: bool) -> Iterator[dict]:
    for fields, block, problem in _fragments(batches):
        row = {
            "record_type": fields.get("warc-type"), "record_id": _bare(fields.get("warc-record-id")), "page_id": fields.get("x-page-id"),
            "url": fields.get("warc-target-uri"), "said_digest": _hex(fields.get("warc-payload-digest")), "refers_to": _bare(fields.get("warc-refers-to")),
            "problem": problem,
        }
        number = _number(fields.get("warc-segment-number"))
        if row["record_type"] == "continuation" or number is not None:
            origin = _bare(fields.get("warc-segment-origin-id")) or row["record_id"]
            yield row | {"origin": origin, "number": number, "total": _number(fields.get("warc-segment-total-length")), "block": block}
        elif row["record_type"] == "response":
            yield _decoded(row, block, with_payload) if problem is None else row
        else:
            yield row


def _assembled(batches: Iterator[pa.RecordBatch], with_payload: bool) -> Iterator[dict]:
    """One row per segmented record (and copy of it), of segments sorted by origin and number."""
    segments: list[dict] = []

    def whole() -> Iterator[dict]:
        first = [s for s in segments if s["record_type"] != "continuation"]
        parts = list({s["number"]: s for s in segments}.values())
        row = (first[0] if first else dict.fromkeys(FIELDS) | {"record_type": "response", "record_id": segments[0]["origin"]}) | {"block": None}
        size = sum(len(s["block"]) for s in parts)
        broken = next((s["problem"] for s in segments if s["problem"]), None)
        if not first or [s["number"] for s in parts] != list(range(1, len(parts) + 1)) or parts[-1]["total"] is None:
            row["problem"] = broken or "missing segment"
        elif broken or parts[-1]["total"] != size:
            row["problem"] = broken or "other total length"
        else:
            row = _decoded(row, b"".join(s["block"] for s in parts), with_payload)
        for _ in range(max(1, len(first))):
            yield row

    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            if segments and segments[0]["origin"] != row["origin"]:
                yield from whole()
                segments.clear()
            if segments and segments[-1]["number"] == row["number"]:
                row["block"] = segments[-1]["block"] if row["block"] == segments[-1]["block"] else row["block"]
            segments.append(row)
    if segments:
        yield from whole()


def read(spark: SparkSession, path: str, id_type: str = "long", with_payload: bool = True) -> DataFrame:
    """One row per page of the archives below path: page_id, url, record_type, refers_to (a page id), payload,
    payload_bytes, payload_digest, problem (null if all is well). A revisit has its response's payload_bytes, and no payload.

    Archives may be compressed or plain. A plain one is cut into splits; only there can a record be misread, namely if its
    payload holds a whole record right behind a split's edge.
    """
    lines = spark.read.option("lineSep", BETWEEN + BEGIN).text(path)
    fragments = lines.select(F.col("_metadata.file_path").alias("file"), F.col("value").cast("binary").alias("value"))
    parsed = write_stage(fragments.mapInArrow(lambda b: _batches(_parsed(b, with_payload)), PARSED), "warc-records")
    segments = parsed.where("origin is not null").repartition("origin").sortWithinPartitions("origin", "number")
    joined = segments.mapInArrow(lambda b: _batches(_assembled(b, with_payload)), PARSED)
    found = write_stage(parsed.where("origin is null and record_type = 'response'").union(joined).drop("origin", "number", "total", "block"), "warc-responses")
    revisits = parsed.where("origin is null and record_type = 'revisit'")
    named = revisits.select(F.col("refers_to").alias("record_id")).distinct()
    targets = found.join(named, "record_id", "left_semi").groupBy("record_id")
    targets = targets.agg(F.min(F.struct("page_id", "payload_bytes", "payload_digest")).alias("target"))
    # Written, so that the join can split a response that very many revisits name.
    targets = write_stage(targets.withColumnRenamed("record_id", "_named"), "revisited")
    targets = F.broadcast(targets) if targets.count() <= MOST_BROADCAST else targets
    met = revisits.join(targets, F.col("refers_to") == F.col("_named"), "left")
    digest = F.coalesce("said_digest", "target.payload_digest")
    problem = F.when(F.col("_named").isNull(), "nothing revisited").when(digest != F.col("target.payload_digest"), "other digest")
    out = lambda c, t=None: F.lit(None).cast(t).alias(c) if t else F.col(c)
    responses = found.select("page_id", "url", "record_type", out("refers_to", "string"), "payload", "payload_bytes", "payload_digest", "problem")
    again = met.select(
        "page_id", "url", "record_type", F.col("target.page_id").alias("refers_to"), out("payload", "binary"), F.col("target.payload_bytes").alias("payload_bytes"),
        F.when(F.col("_named").isNotNull(), digest).alias("payload_digest"), F.coalesce("problem", problem).alias("problem"),
    )
    return responses.union(again).withColumns({c: F.col(c).cast(id_type) for c in ("page_id", "refers_to")})


def archive_dir(spark: SparkSession) -> str:
    """A new folder for archives that all executors see."""
    return f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
