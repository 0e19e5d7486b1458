"""Writing pages as WARC archives, and reading archives back by boundary-chain verification.

An archive is split at every occurrence of the record magic, in parallel and wherever it stands.
Each occurrence is a candidate that names its successor: the offset behind its header, its declared
length and the separator. A payload may contain the magic, even whole forged records, so a
candidate counts only if a chain of successors leads to it from the start of its file. Reachability
is found by pointer jumping: in each round every pointer doubles its length and every reached
record reaches the one its pointer names, so a file of n records takes log2(n) rounds of joins over
three narrow columns. Pieces behind rejected magic are put back into the record they lie in.

Archives are written by Spark's text writer, whose line separator is the WARC record separator.
Payloads of equal content (by SHA-1) are stored once; the others are revisit records.

A null payload is an empty one; a null URL is left out of the header. Line breaks in URLs are
percent-encoded. Rows with a null id have an empty record id; they are revisits only of payloads
that a row with an id has. Rows that repeat the smallest id of a payload are all responses; rows that repeat an id with
other payloads are records of their own. Further columns play no part. An empty table gives archives without records. A file that does not begin with a record has none, and
a record whose bytes are cut off by the end of its file is not returned.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from palaver.llm.common import column_bytes, slices, table
from palaver.operators.ranking import running_total
from palaver.session import fresh_path, materialise

#: Fixed values of the format.
MAGIC = "WARC/1.0\r\n"
SEPARATOR = "\r\n\r\n"
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\n\r\n"
_ID = "urn:page:"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(kind: str, ident: str, url: str | None, payload: str, sha1: str, refers_to: str | None, date: str) -> str:
    """A record without the separator behind it."""
    block = _HTTP + (payload if kind == "response" else "")
    lines = [f"WARC-Type: {kind}", f"WARC-Record-ID: <{_ID}{ident}>", f"WARC-Date: {date}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <{_ID}{refers_to}>",
                  "WARC-Profile: http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"]
    lines += [f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(sha1)).decode()}",
              "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block.encode())}"]
    return MAGIC + "\r\n".join(lines) + SEPARATOR + block


def write_archives(
    pages: DataFrame,
    path: str,
    key: str = "page_id",
    url: str = "url",
    payload: str = "html",
    least_bytes: int = 0,
    date: str = "1970-01-01T00:00:00Z",
) -> None:
    """One record per row below ``path``; equal payloads of at least ``least_bytes`` bytes are written once."""
    rows = pages.select(
        F.col(key).alias("key"), F.col(url).alias("url"), F.coalesce(payload, F.lit("")).alias("payload")
    ).withColumn("sha1", F.sha1(F.col("payload").cast("binary")))
    repeated = materialise(
        rows.where(F.octet_length("payload") >= least_bytes)
        .groupBy("sha1")
        .agg(F.min("key").alias("first"), F.count("*").alias("n"))
        .where("n > 1 and first is not null")
        .select("sha1", "first"),
        "warc-repeated",
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "payload"):
            out = [
                record("response" if r["first"] is None else "revisit", r["ident"], r["url"], r["payload"], r["sha1"], r["first"], date)
                for r in batch.to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], ["record"])

    visits = rows.join(repeated, "sha1", "left").select(
        F.coalesce(F.col("key").cast("string"), F.lit("")).alias("ident"),
        F.col("url").cast("string").alias("url"),
        "payload",
        "sha1",
        F.when(~F.col("key").eqNullSafe(F.col("first")), F.col("first").cast("string")).alias("first"),
    )
    visits.mapInArrow(run, "record string").write.option("lineSep", SEPARATOR).text(path)


def parse(piece: bytes) -> dict | None:
    """Header fields and sizes of a candidate, given the bytes behind its magic; None without a whole header."""
    end = piece.find(b"\r\n\r\n")
    if end < 0:
        return None
    fields = dict(x.split(b":", 1) for x in piece[:end].split(b"\r\n") if b":" in x)
    value = {k.strip().lower(): v.strip().decode("utf-8", "replace") for k, v in fields.items()}
    size = value.get(b"content-length", "")
    if not (size.isascii() and size.isdigit() and len(size) < 16):
        return None
    strip = lambda name: value.get(name, "").strip("<>").removeprefix(_ID)
    return {
        "type": value.get(b"warc-type"),
        "ident": strip(b"warc-record-id"),
        "refers_to": strip(b"warc-refers-to") if b"warc-refers-to" in value else None,
        "digest": value.get(b"warc-payload-digest", "").removeprefix("sha1:"),
        "uri": value.get(b"warc-target-uri"),
        "block": end + 4,
        "size": int(size),
    }


_PIECE = (
    "file string, block_start long, at long, length long, type string, ident string, refers_to string, digest string, "
    "uri string, behind long, whole boolean, payload_bytes long, payload_digest string, bytes binary, payload binary"
)
_SCHEMA = pa.schema(
    [("file", pa.string()), ("block_start", pa.int64()), ("at", pa.int64()), ("length", pa.int64()), ("type", pa.string()),
     ("ident", pa.string()), ("refers_to", pa.string()), ("digest", pa.string()), ("uri", pa.string()), ("behind", pa.int64()),
     ("whole", pa.bool_()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("bytes", pa.binary()),
     ("payload", pa.binary())]
)


def _payload(block: bytes) -> bytes:
    """What follows the HTTP header."""
    at = block.find(b"\r\n\r\n")
    return block[at + 4 :] if at >= 0 else b""


def _pieces(spark: SparkSession, path: str, with_bytes: bool) -> DataFrame:
    """Every stretch between two magics, with its offset counted from the first stretch of its file block.

    Spark reads a file in blocks and a block's lines in order; a line belongs to the block in which
    it begins, so lengths add up to offsets.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, at = None, 0
        for batch in slices(batches, "value"):
            out = []
            files, starts = batch.column("file").to_pylist(), batch.column("block_start").to_pylist()
            for file, start, piece in zip(files, starts, column_bytes(batch, "value"), strict=True):
                if (file, start) != block:
                    block, at = (file, start), 0
                row = {"file": file, "block_start": start, "at": at, "length": len(piece) + len(MAGIC)}
                if found := parse(piece):
                    stop = found["block"] + found["size"]
                    row |= {k: found[k] for k in ("type", "ident", "refers_to", "digest", "uri")}
                    row |= {"behind": len(MAGIC) + stop + len(SEPARATOR), "whole": stop <= len(piece)}
                    if row["whole"]:
                        payload = _payload(piece[found["block"] : stop])
                        row |= {"payload_bytes": len(payload), "payload_digest": digest(payload)}
                        if with_bytes:
                            row["payload"] = payload
                if with_bytes:
                    row["bytes"] = piece
                out.append(row)
                at += row["length"]
            yield pa.RecordBatch.from_pylist(out, _SCHEMA)

    lines = spark.read.option("lineSep", MAGIC).text(path).select(
        "value",
        F.regexp_extract("_metadata.file_path", "[^/]*$", 0).alias("file"),
        F.col("_metadata.file_block_start").alias("block_start"),
    )
    return lines.mapInArrow(run, _PIECE)


def _offsets(narrow: DataFrame) -> DataFrame:
    """Offset of the first piece of every block of a file: one row per block."""
    sums = narrow.groupBy("file", "block_start").agg(F.sum("length").alias("n"))
    earlier = Window.partitionBy("file").orderBy("block_start").rowsBetween(Window.unboundedPreceding, -1)
    return sums.select("file", "block_start", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))


def reachable(candidates: DataFrame) -> DataFrame:
    """``file, start`` of the candidates (``file, start, successor``) that a chain reaches from offset 0."""
    nodes = materialise(
        candidates.select("file", "start", F.col("successor").alias("ptr"), (F.col("start") == 0).alias("hit")), "warc-chain"
    )
    while nodes.where("ptr is not null").limit(1).count():
        reached = nodes.where("hit and ptr is not null").select("file", F.col("ptr").alias("start"), F.lit(True).alias("now")).distinct()
        ahead = nodes.select("file", F.col("start").alias("ptr"), F.col("ptr").alias("further"))
        nodes = materialise(
            nodes.join(reached, ["file", "start"], "left")
            .join(ahead, ["file", "ptr"], "left")
            .select("file", "start", F.col("further").alias("ptr"), (F.col("hit") | F.coalesce("now", F.lit(False))).alias("hit")),
            "warc-chain",
        )
    return nodes.where("hit").select("file", "start")


def read_archives(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """The records below ``path``: ``file, start, type, ident, refers_to, digest, uri, payload_bytes, payload_digest``
    and, if asked for, ``payload``. Digests and sizes are computed from the bytes read, not taken from headers."""
    narrow = materialise(_pieces(spark, path, False).drop("bytes", "payload"), "warc-pieces")
    base = materialise(_offsets(narrow), "warc-blocks")
    placed = narrow.join(base, ["file", "block_start"]).withColumn("start", F.col("base") + F.col("at") - len(MAGIC))
    placed = placed.where("start >= 0")  # what precedes the first magic of a file is no candidate
    chain = reachable(placed.select("file", "start", (F.col("start") + F.col("behind")).alias("successor")))
    pieces_of = materialise(
        placed.join(chain.withColumn("genuine", F.lit(True)), ["file", "start"], "left").withColumn("genuine", F.col("genuine").isNotNull()),
        "warc-genuine",
    )
    header = ["file", "start", "type", "ident", "refers_to", "digest", "uri"]
    columns = [*header, "payload_bytes", "payload_digest", *(["payload"] if with_payload else [])]
    entire = pieces_of.where("genuine and whole")
    if with_payload:
        whole = _pieces(spark, path, True).select("file", "block_start", "at", "payload")
        entire = _met(entire, whole, "payload")
    broken = pieces_of.where("genuine and not whole")
    if not broken.limit(1).count():
        return entire.select(*columns)
    # each piece lies in the last genuine record before it: those of one number
    counted = pieces_of.select("file", "start", "block_start", "at", "whole", F.col("genuine").cast("long").alias("_one"))
    numbered = running_total(counted, ["file"], ["start"], "_one", [True], "number")
    owners = numbered.where("_one = 1 and not whole").select("file", "number", F.col("start").alias("owner"))
    wanted = materialise(numbered.select("file", "start", "block_start", "at", "number").join(owners, ["file", "number"]), "warc-parts")
    pieces = _pieces(spark, path, True).select("file", "block_start", "at", "bytes")
    # the pieces of one record, as long as the record itself
    whole_again = (
        _met(wanted, pieces, "bytes")
        .groupBy("file", F.col("owner").alias("start"))
        .agg(F.array_sort(F.collect_list(F.struct(F.col("start").alias("o"), "bytes"))).alias("parts"))
    )

    def rejoin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                data = MAGIC.encode().join(p["bytes"] or b"" for p in r["parts"])
                found = parse(data)
                stop = found["block"] + found["size"]
                if stop <= len(data):
                    payload = _payload(data[found["block"] : stop])
                    yield pa.RecordBatch.from_pylist(
                        [{"file": r["file"], "start": r["start"], "payload_bytes": len(payload), "payload_digest": digest(payload),
                          "payload": payload}],
                        pa.schema([("file", pa.string()), ("start", pa.int64()), ("payload_bytes", pa.int64()),
                                   ("payload_digest", pa.string()), ("payload", pa.binary())]),
                    )

    again = whole_again.mapInArrow(rejoin, "file string, start long, payload_bytes long, payload_digest string, payload binary")
    return entire.select(*columns).union(broken.select(*header).join(again, ["file", "start"]).select(*columns))


def _met(wanted: DataFrame, pieces: DataFrame, column: str) -> DataFrame:
    """``wanted`` with ``column`` of the piece it names. A second scan may cut files elsewhere than the first: that is an error, not a loss."""
    place = ["file", "block_start", "at"]
    told = F.when(F.col(column).isNull(), F.raise_error(F.lit("the archives were read in other blocks than before; read them again")))
    return wanted.join(pieces, place, "left").withColumn(column, F.coalesce(F.col(column), told.cast("binary")))


def resolved(records: DataFrame) -> DataFrame:
    """Records with the payload size and digest that a revisit refers to: those of the response with the id and the digest it names."""
    first = records.where("type = 'response'").groupBy(F.col("ident").alias("refers_to"), F.col("payload_digest").alias("digest")).agg(
        F.min("payload_bytes").alias("n")
    )
    # only revisits refer to anything: the others, whose reference is null, are not joined
    revisits = records.where("type = 'revisit'").join(first, ["refers_to", "digest"], "left")
    found = F.when(F.col("n").isNotNull(), F.col("digest"))
    revisits = revisits.withColumns({"payload_bytes": F.col("n"), "payload_digest": found}).select(records.columns)
    return records.where("type is distinct from 'revisit'").unionByName(revisits)


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "warc")
    write_archives(table(spark, sf_dir, "pages"), path)
    rows = resolved(read_archives(spark, path, with_payload=False))
    return rows.select(
        F.col("ident").cast("long").alias("page_id"),
        F.col("payload_bytes").cast("long").alias("payload_bytes"),
        "payload_digest",
        F.col("type").alias("record_type"),
        F.col("refers_to").cast("long").alias("refers_to"),
    )
