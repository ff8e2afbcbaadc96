"""WARC derivatives (operator 6): from each response a linked metadata and a plain-text conversion record.

Responses have ``key`` (the caller's number), ``record_id``, ``target_uri``, ``date``, ``headers`` (a map of the source's headers) and
``payload`` (text). Each partition writes one WARC/1.1 file of gzip members, a record per member, under a name
of its own; only a committed task's rows name a file as part of the result. Both derivatives carry
``WARC-Refers-To`` (the response's id), its target and date and their own block digest; the metadata record
keeps the source headers and the payload's digest, the conversion record has the page's text.

Record ids are made from the response's id and the kind, so a repeated run gives the same ones. A null payload
is an empty one, a null uri or date an empty header, null headers none; repeated responses give repeated
records; an empty table gives no file.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftlake.llm.common import SLICE_CHARS, decoded, filesystem, in_arrow, only, slices
from siftlake.session import scratch_path

ENTRIES = "key long, file string, offset long, size long, record_id string, refers_to string, kind string"
RECORDS = ENTRIES + ", target_uri string, date string, block_digest string, payload_digest string, block string"

_OPENED = re.compile(r"<!--|<(script|style|noscript|template)\b", re.I)
_CLOSED = {"": re.compile("-->"), **{tag: re.compile(rf"</{tag}\s*+>", re.I) for tag in ("script", "style", "noscript", "template")}}
_BREAKS = re.compile(r"<\s*+/?\s*+(?:p|div|br|li|ul|ol|h[1-6]|tr|table|article|section|nav|header|footer|title|head|body|blockquote|pre)\b[^>]*+>", re.I)
_TAGS = re.compile(r"<[!/?a-zA-Z][^>]*+>")
_BLANKS, _LINES = re.compile(r"[^\S\n]+"), re.compile(r" ?\n[ \n]*")


def _without_dropped(page: str) -> str:
    """A blank for each comment, script and the like; one without an end stays. Takes time in proportion to the page."""
    kept, upto, at, endless = [], 0, 0, set()
    while opened := _OPENED.search(page, at):
        kind, at = (opened[1] or "").lower(), opened.end()
        closed = None if kind in endless else _CLOSED[kind].search(page, at)
        if closed is None:
            endless.add(kind)  # nor has any later one an end
            continue
        kept.append(page[upto:opened.start()])
        upto = at = closed.end()
    return " ".join([*kept, page[upto:]])


def plain_text(page: str) -> str:
    """The text of a page: no scripts, comments or tags, a line per block, entities resolved."""
    text = _without_dropped(page)
    tagged = text.rfind(">") + 1  # what follows has no whole tag
    text = _TAGS.sub("", _BREAKS.sub("\n", text[:tagged])) + text[tagged:]
    return _LINES.sub("\n", _BLANKS.sub(" ", decoded(text))).strip()


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def derived_id(record_id: str, kind: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{record_id}#{kind}')}>"


def _line(value: object) -> str:
    return re.sub(r"[\r\n]+", " ", "" if value is None else str(value))


def record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One gzip member with one record."""
    head = "".join(f"{name}: {_line(value)}\r\n" for name, value in [*headers, ("Content-Length", str(len(block)))])
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n") + packer.flush()


def derivatives(row: dict) -> Iterator[tuple[str, str, bytes]]:
    """(id, kind, member) of the two records of a response."""
    payload = (row["payload"] or "").encode()
    common = [("WARC-Refers-To", row["record_id"]), ("WARC-Target-URI", row["target_uri"]), ("WARC-Date", row["date"]),
              ("WARC-Refers-To-Target-URI", row["target_uri"]), ("WARC-Refers-To-Date", row["date"])]
    fields = [("payload-digest", digest(payload)), ("payload-length", str(len(payload))), *[(f"source-{k}", v) for k, v in sorted(row["headers"] or [])]]
    blocks = {"metadata": ("application/warc-fields", "".join(f"{k}: {_line(v)}\r\n" for k, v in fields).encode()),
              "conversion": ("text/plain; charset=utf-8", plain_text(row["payload"] or "").encode())}
    ids = {kind: derived_id(row["record_id"] or "", kind) for kind in blocks}
    for kind, (media, block) in blocks.items():
        other = ids["conversion" if kind == "metadata" else "metadata"]
        yield ids[kind], kind, record([("WARC-Type", kind), ("WARC-Record-ID", ids[kind]), *common, ("WARC-Concurrent-To", other),
                                       ("Content-Type", media), ("WARC-Block-Digest", digest(block))], block)


def write_derivatives(responses: DataFrame, folder: str) -> DataFrame:
    """Write the records; a row per record with its file and place."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs = sink = None
        name, place = f"derived-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.gz", 0
        for batch in batches:
            for part in slices(batch, "payload"):
                rows = []
                for response in part.to_pylist():
                    for record_id, kind, member in derivatives(response):
                        if sink is None:
                            fs, path = filesystem(f"{folder}/{name}")
                            sink = fs.open_output_stream(path, compression=None)
                        sink.write(member)
                        rows.append((response["key"], name, place, len(member), record_id, response["record_id"], kind))
                        place += len(member)
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(
                    zip(*rows, strict=True), (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()), strict=True)],
                    names=["key", "file", "offset", "size", "record_id", "refers_to", "kind"])
        if sink is not None:
            sink.close()

    spark = responses.sparkSession
    fs, path = filesystem(folder)
    fs.create_dir(path, recursive=True)
    rows = only(responses, key="long", record_id="string", target_uri="string", date="string", headers="map<string,string>", payload="string")
    in_arrow(rows, write, ENTRIES).write.parquet(f"{folder}/index")
    return spark.read.parquet(f"{folder}/index")


def parse_record(member: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block of one member."""
    head, _, rest = zlib.decompress(member, 31).partition(b"\r\n\r\n")
    headers = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    return headers, rest[:int(headers["Content-Length"])]


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """The records of an index, from the files alone: a row per record."""

    schema = pa.schema([
        ("key", pa.int64()), ("file", pa.string()), ("offset", pa.int64()), ("size", pa.int64()),
        *[(c, pa.string()) for c in ("record_id", "refers_to", "kind", "target_uri", "date", "block_digest", "payload_digest", "block")]])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, source = None, None
        for batch in batches:
            out, held = [], 0
            for row in batch.to_pylist():
                if row["file"] != name:
                    fs, path = filesystem(f"{folder}/{row['file']}")
                    name, source = row["file"], fs.open_input_file(path)
                source.seek(row["offset"])
                headers, block = parse_record(source.read(row["size"]))
                fields = dict(x.split(": ", 1) for x in block.decode().split("\r\n") if ": " in x) if headers["WARC-Type"] == "metadata" else {}
                out.append({**row, "record_id": headers["WARC-Record-ID"], "refers_to": headers["WARC-Refers-To"], "kind": headers["WARC-Type"],
                            "target_uri": headers["WARC-Target-URI"], "date": headers["WARC-Date"], "block_digest": headers["WARC-Block-Digest"],
                            "payload_digest": fields.get("payload-digest"), "block": block.decode()})
                held += len(block)
                if held > SLICE_CHARS:  # blocks are held by their size, not by their number
                    yield pa.RecordBatch.from_pylist(out, schema=schema)
                    out, held = [], 0
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    return in_arrow(index, read, RECORDS)


def responses_of(pages: DataFrame, date: str) -> DataFrame:
    """Pages as responses; their ids follow from page_id and url."""
    made = F.sha2(F.concat_ws(" ", F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.coalesce("url", F.lit(""))), 256)
    dashed = F.concat_ws("-", *[F.substring(made, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    return pages.select(
        F.concat(F.lit("<urn:uuid:"), dashed, F.lit(">")).alias("record_id"), F.col("url").alias("target_uri"), F.lit(date).alias("date"),
        F.create_map(F.lit("content-type"), F.lit("text/html; charset=utf-8"), F.lit("content-length"), F.coalesce(F.octet_length("html"), F.lit(0)).cast("string")).alias("headers"),
        F.col("html").alias("payload"), F.col("page_id").cast("long").alias("key"))


def derivative_digests(pages: DataFrame, date: str) -> DataFrame:
    """Write the derivatives of all pages under the shared folder, read them back, and digest each record."""
    folder = scratch_path(pages.sparkSession, "warc")
    records = read_records(write_derivatives(responses_of(pages, date), folder), folder)
    return records.select(F.col("key").alias("page_id"), "record_id", "refers_to", "kind", "target_uri", "date", "block_digest", "payload_digest",
                          F.octet_length("block").cast("long").alias("block_bytes"), F.sha2("block", 256).alias("block_sha256"))
