"""WARC archives: writing, and reading with boundary-chain verification.

Writing.  One record per page; of pages with equal payloads the one with the smallest id
is a response and the others are revisits of it.  Spark's text writer makes the files:
a row is a record, and the line separator is the blank lines that end a record.

Reading.  The magic line ``WARC/1.0`` splits a file into candidate records, wherever
Spark cuts the file.  A candidate's headers say where its successor must begin.  Magic
inside a payload makes a false candidate, which no chain from the file's start reaches:

1. each task numbers the candidates of its split and measures them; sums over the few
   splits of a file turn places within a split into offsets within the file;
2. within a split, chains are followed to the first offset behind it (the exit);
3. over the splits of a file, exits are followed from the file's start by pointer
   jumping, which doubles the distance each round;
4. each split walks its chain from its entry: these are the records.  Candidates in
   between belong to the payload of the record before them and are put back into it.

Only offsets are shuffled; bytes move only where a payload holds the magic.

Defined results: a NULL payload is empty; a NULL page id is written as an empty id and
sorts last; a NULL url is an empty target; rows that repeat id, url and payload are one
response and revisits of it; extra columns are ignored; a broken chain ends where it
breaks, and what lies behind is not returned.
"""

from __future__ import annotations

import base64
import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderlens.llm.common import written

MAGIC = b"WARC/1.0\r\n"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
#: The record that a reader returns.
RECORD = (
    "record_type string, record_id string, refers_to string, target_uri string, header_digest string, header_bytes long,"
    " payload_bytes long, payload_digest string, payload binary"
)


def base32(digits: Column) -> Column:
    """Upper-case base32 of 40 hexadecimal digits: eight groups of five digits, four characters each."""
    out = []
    for g in range(8):
        value = F.conv(F.substring(digits, 5 * g + 1, 5), 16, 10).cast("int")
        out += [F.substring(F.lit(BASE32), (F.shiftright(value, 15 - 5 * j).bitwiseAND(F.lit(31)) + 1), F.lit(1)) for j in range(4)]
    return F.concat(*out)


def dedup_payloads(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", min_bytes: int = 0) -> DataFrame:
    """(page_id, url, payload, sha1, refers_to, is_response): revisits point to the smallest id of equal payloads.

    Payloads under ``min_bytes`` are all responses.  Only payloads that occur twice or more
    are looked up, one row each, so payloads stay where they are read while those are few.
    """
    rows = pages.select(
        F.col(id_col).alias("page_id"), F.coalesce(F.col(url_col), F.lit("")).alias("url"), F.coalesce(F.col(payload_col), F.lit("")).alias("payload"),
    ).withColumn("sha1", F.sha1(F.col("payload").cast("binary")))
    light = rows.groupBy("sha1", "page_id", "url").agg(F.count("*").alias("copies"))
    order = F.struct(F.col("page_id").isNull(), F.col("page_id"), F.col("url"))
    first = light.groupBy("sha1").agg(
        F.sum("copies").alias("pages"), F.min_by(F.struct("page_id", "url", "copies"), order).alias("first")).filter("pages > 1")
    first = written(first.select(F.col("sha1").alias("key"), "first"), "warc_repeated")
    joined = rows.join(first, rows.sha1 == first.key, "left")
    is_first = F.col("page_id").eqNullSafe(F.col("first.page_id")) & (F.col("url") == F.col("first.url"))
    joined = joined.withColumn("is_response", F.col("key").isNull() | is_first | (F.octet_length("payload") < min_bytes))
    if not first.filter("first.copies > 1").isEmpty():
        # Rows that repeat id, url and payload of a first one: one of them is the response.
        again = F.coalesce(is_first & (F.col("first.copies") > 1) & (F.octet_length("payload") >= min_bytes), F.lit(False))
        nth = F.explode(F.sequence(F.lit(1), F.col("first.copies").cast("int")))
        copies = joined.filter(again).dropDuplicates(["sha1"]).withColumn("nth", nth)
        joined = joined.filter(~again).unionByName(copies.withColumn("is_response", F.col("nth") == 1).drop("nth"))
    return joined.select("page_id", "url", "payload", "sha1", F.when(~F.col("is_response"), F.col("first.page_id")).alias("refers_to"), "is_response")


def record(date: str) -> Column:
    """One WARC record as text, without the blank lines behind it."""
    urn = lambda c: F.concat(F.lit("<urn:x-page:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    uri = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.octet_length("payload").cast("string"), F.lit("\r\n\r\n"))
    size = F.octet_length(http) + F.when(F.col("is_response"), F.octet_length("payload")).otherwise(0)
    kind = F.when(F.col("is_response"), F.lit("WARC-Type: response\r\n")).otherwise(F.concat(
        F.lit("WARC-Type: revisit\r\nWARC-Profile: http://netpreserve.org/warc/1.0/revisit/identical-payload-digest\r\nWARC-Refers-To: "),
        urn(F.col("refers_to")), F.lit("\r\n")))
    return F.concat(
        F.lit(MAGIC.decode()), kind, F.lit("WARC-Record-ID: "), urn(F.col("page_id")), F.lit("\r\nWARC-Target-URI: "), uri,
        F.lit(f"\r\nWARC-Date: {date}\r\nWARC-Payload-Digest: sha1:"), base32(F.col("sha1")),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "), size.cast("string"), F.lit("\r\n\r\n"),
        http, F.when(F.col("is_response"), F.col("payload")).otherwise(F.lit("")),
    )


def write_archives(pages: DataFrame, path: str, date: str = "2024-01-01T00:00:00Z", **columns) -> None:
    """Archives below ``path``, one for each task that writes."""
    dedup_payloads(pages, **columns).select(record(date).alias("value")).write.option("lineSep", "\r\n\r\n").text(path)


def _headers(head: bytes) -> dict[bytes, bytes]:
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(b":") for x in head.split(b"\r\n")) if v}


def measure(data: bytes) -> tuple[int, int] | None:
    """(length of the headers with their blank line, length of the block) of what follows the magic."""
    end = data.find(b"\r\n\r\n")
    length = re.search(rb"(?im)^content-length:[ \t]*(\d+)[ \t]*\r?$", data[: end + 2]) if end >= 0 else None
    return (end + 4, int(length[1])) if length else None


def parse(data: bytes, payloads: bool) -> tuple | None:
    """A RECORD from what follows the magic, or None if the block is not whole."""
    sizes = measure(data)
    if sizes is None or len(data) < sum(sizes):
        return None
    head, block = _headers(data[: sizes[0] - 4]), data[sizes[0]: sum(sizes)]
    http, gap, payload = block.partition(b"\r\n\r\n")
    if not block.startswith(b"HTTP/") or not gap:
        http, payload = b"", block
    page = lambda k: re.sub(r"^<urn:x-page:(.*)>$", r"\1", head[k].decode()) if k in head else None
    text = lambda k: head[k].decode() if k in head else None
    inner = _headers(http).get(b"content-length")
    return (
        text(b"warc-type"), page(b"warc-record-id"), page(b"warc-refers-to"), text(b"warc-target-uri"),
        re.sub("^sha1:", "", text(b"warc-payload-digest") or "") or None, int(inner) if inner else None,
        len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode(), payload if payloads else None,
    )


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, split, v): the bytes between magic lines, in file order within a split."""
    return spark.read.option("lineSep", MAGIC.decode()).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), F.col("value").cast("binary").alias("v"))


def candidates(spark: SparkSession, path: str, payloads: bool) -> DataFrame:
    """What stands between magic lines, by (file, split, seq): size, place in the split, length to the next record.

    Where a piece is exactly one record it comes parsed.
    """

    def run(batches):
        at = (None, None)
        for batch in batches:
            rows = []
            for file, split, v in zip(*(batch.column(k).to_pylist() for k in range(3))):
                if (file, split) != at:
                    at, seq, place = (file, split), 0, 0
                sizes = measure(v)
                whole = sizes is not None and len(v) == sum(sizes) + 4
                got = parse(v, payloads) if whole else None
                rows.append((file, split, seq, place, len(v), sum(sizes) + 4 if sizes else None, *(got or (None,) * 9)))
                seq, place = seq + 1, place + len(v) + len(MAGIC)
            names = ["file", "split", "seq", "place", "size", "step", *RECORD_NAMES]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(_TYPES)], names)

    return _lines(spark, path).mapInArrow(run, f"file string, split long, seq long, place long, size long, step long, {RECORD}")


RECORD_NAMES = [f.split()[0] for f in RECORD.split(", ")]
_KINDS = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
_RECORD_TYPES = [_KINDS[f.split()[1]] for f in RECORD.split(", ")]
_TYPES = [pa.string(), *[pa.int64()] * 5, *_RECORD_TYPES]


def _exits(table: pa.Table) -> pa.Table:
    """For each candidate of a split the first offset of its chain behind the split."""
    table = table.sort_by("off")
    off, nxt = table.column("off").to_pylist(), table.column("nxt").to_pylist()
    where = {o: i for i, o in enumerate(off)}
    out = list(nxt)
    for i in range(len(off) - 1, -1, -1):
        if nxt[i] in where:
            out[i] = out[where[nxt[i]]]
    return table.drop_columns(["nxt", "seq"]).append_column("nxt", pa.array(out, pa.int64()))


def _walk(nodes: pa.Table, entry: pa.Table) -> pa.Table:
    """(file, split, seq, off, owner): the owner is the last record at or before the candidate in this split."""
    nodes = nodes.sort_by("off")
    off, nxt = nodes.column("off").to_pylist(), dict(zip(nodes.column("off").to_pylist(), nodes.column("nxt").to_pylist()))
    records, at = set(), min(entry.column("entry").to_pylist(), default=None)
    while at in nxt and at not in records:
        records.add(at)
        at = nxt[at]
    owner, last = [], None
    for o in off:
        last = o if o in records else last
        owner.append(last)
    return nodes.drop_columns(["nxt"]).append_column("owner", pa.array(owner, pa.int64()))


def reachable(nodes: DataFrame) -> DataFrame:
    """(file, split, seq, off, owner) for (file, split, seq, off, nxt) by chains from each file's first candidate.

    Rows before a file's first record, or in a file without any, have no owner.
    """
    jump = written(nodes.groupBy("file", "split").applyInArrow(_exits, "file string, split long, off long, nxt long"), "warc_exits")
    splits = jump.select("file", "split", "off")
    found = written(jump.groupBy("file").agg(F.min("off").alias("entry")), "warc_entries")
    pairs = jump.select("file", "off", "nxt")
    while True:
        a, b = pairs.alias("a"), pairs.alias("b")
        more = found.join(pairs, (found.file == pairs.file) & (found.entry == pairs.off)).select(found.file, F.col("nxt").alias("entry"))
        both = written(found.union(more.filter("entry IS NOT NULL")).distinct(), "warc_entries")
        if both.count() == found.count():
            break
        found = both
        pairs = written(a.join(b, (F.col("a.file") == F.col("b.file")) & (F.col("a.nxt") == F.col("b.off"))).select("a.file", "a.off", "b.nxt"), "warc_jumps")
    entries = found.join(splits, (found.file == splits.file) & (found.entry == splits.off)).select(splits.file, "split", "entry")
    walked = nodes.groupBy("file", "split").cogroup(entries.groupBy("file", "split")).applyInArrow(_walk, "file string, split long, seq long, off long, owner long")
    walked = written(walked, "warc_walk")
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    carry = walked.groupBy("file", "split").agg(F.max("owner").alias("last")).select("file", "split", F.last("last", ignorenulls=True).over(before).alias("carried"))
    return walked.join(carry, ["file", "split"]).select("file", "split", "seq", "off", F.coalesce("owner", "carried").alias("owner"))


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """The records (RECORD) of the archives below ``path``; with ``payloads`` false, sizes and digests only."""
    pieces = written(candidates(spark, path, payloads), "warc_candidates")
    gap = len(MAGIC)
    per_split = pieces.groupBy("file", "split").agg(F.sum(F.col("size") + gap).alias("n"))
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    base = per_split.select("file", "split", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    off = F.col("base") + F.col("place")
    nodes = written(
        pieces.select("file", "split", "seq", "place", "step").join(base, ["file", "split"]).filter(off > 0)  # what precedes the first magic is no candidate
        .select("file", "split", "seq", off.alias("off"), (off + F.col("step") + gap).alias("nxt")), "warc_nodes",
    )
    owned = reachable(nodes).filter("owner IS NOT NULL")
    per_owner = owned.groupBy("file", "owner").agg(F.count("*").alias("pieces"))
    plan = written(owned.join(per_owner, ["file", "owner"]), "warc_owned")
    whole = plan.filter("pieces = 1 AND off = owner").select("file", "split", "seq")
    simple = pieces.filter("record_type IS NOT NULL").join(whole, ["file", "split", "seq"]).selectExpr(*RECORD_NAMES)

    def join_up(table: pa.Table) -> pa.Table:
        rows = sorted(zip(table.column("off").to_pylist(), table.column("raw").to_pylist()))
        got = parse(MAGIC.join(v for _, v in rows), payloads)
        return pa.table([pa.array([got[k]] if got else [], t) for k, t in enumerate(_RECORD_TYPES)], names=RECORD_NAMES)

    # Pieces of records that hold the magic; usually a small table, so that the bytes stay where they are read.
    rest = written(plan.filter("pieces > 1 OR off <> owner").select("file", "split", "seq", "off", "owner"), "warc_pieces")
    if rest.isEmpty():
        return simple
    parts = _numbered(_lines(spark, path)).join(rest, ["file", "split", "seq"]).select("file", "owner", "off", "raw")
    return simple.unionByName(parts.groupBy("file", "owner").applyInArrow(join_up, RECORD))


def _numbered(lines: DataFrame) -> DataFrame:
    """(file, split, seq, raw) of all pieces."""

    def run(batches):
        at, seq = None, 0
        for batch in batches:
            keys = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
            number = []
            for key in keys:
                at, seq = key, (seq + 1 if key == at else 0)
                number.append(seq)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(np.array(number, np.int64)), batch.column(2)], ["file", "split", "seq", "raw"])

    return lines.mapInArrow(run, "file string, split long, seq long, raw binary")
