"""WARC archives of pages, and a globally ordered capture index.

Pages are written as WARC records (repeated payloads as revisits), the
archives are read back, and the index entries of every archive form one sorted
run. Runs are cut at common key bounds and, within each key range, merged by a
loser tree into the captures of all archives by URL key and timestamp.
"""

from __future__ import annotations

import gzip
import hashlib
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelkit.llm.common import new_path, stored

REVISIT_BYTES = 100         # smaller payloads are always stored
RECORDS_PER_FILE = 1000
RANGE_ROWS = 200_000        # index entries in one key range, about
EPOCH = 1_704_067_200       # capture time of pages without one: this plus the page id, in seconds
CRLF = "\r\n"


def _header(name: str, value: Column) -> Column:
    """A header line, empty for a null value; line breaks in the value become spaces."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), F.regexp_replace(value.cast("string"), r"[\r\n]+", " "),
                               F.lit(CRLF)), F.lit(""))


def _utc(seconds: str) -> Column:
    """A Unix time as ``yyyy-MM-ddTHH:mm:ssZ``, whatever the session's time zone."""
    at = F.col(seconds)
    part = lambda size, of: F.lpad((F.floor(F.pmod(at, F.lit(of)) / size)).cast("string"), 2, "0")
    day = F.date_from_unix_date(F.floor(at / 86400).cast("int")).cast("string")
    return F.concat(day, F.lit("T"), part(3600, 86400), F.lit(":"), part(60, 3600), F.lit(":"), part(1, 60), F.lit("Z"))


def write_archives(pages: DataFrame, path: str) -> None:
    """Write (page_id, url, html[, ts]) as gzipped WARC files below ``path``, RECORDS_PER_FILE records each.

    Of records with equal payloads of at least REVISIT_BYTES bytes the one
    with the smallest page id is a response, the others revisit it. A null
    html is an empty payload; a null url leaves the header out; rows with a
    null id are responses, or revisits where a row with an id holds their payload.
    """
    ts = F.col("ts").cast("long") if "ts" in pages.columns else \
        F.lit(EPOCH) + F.pmod(F.coalesce(F.col("page_id"), F.lit(0)), F.lit(365 * 86400))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url",
                        F.coalesce("html", F.lit("")).alias("payload"), ts.alias("ts"))
    rows = rows.withColumn("digest", F.sha2(F.col("payload").cast("binary"), 256)) \
        .withColumn("bytes", F.octet_length("payload"))
    # Revisits are found among ids and digests; payloads then meet them by id, so a payload that is
    # everywhere (an error page) is no hot key.
    names = rows.where(F.col("bytes") >= REVISIT_BYTES).select("page_id", "digest")
    firsts = names.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1")
    copies = (names.join(firsts.select("digest", "first"), "digest")
              .where(F.coalesce(F.col("first") != F.col("page_id"), F.col("first").isNotNull()))
              .select(F.col("page_id").alias("p"), F.col("digest").alias("d"), "first").distinct())
    rows = rows.join(copies, F.col("page_id").eqNullSafe(F.col("p")) & (F.col("digest") == F.col("d")), "left")
    again = F.col("first").isNotNull()
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
                    F.col("bytes").cast("string"), F.lit(CRLF * 2))
    block = F.concat(http, F.when(again, F.lit("")).otherwise(F.col("payload")))
    kind = F.when(again, F.lit("revisit")).otherwise(F.lit("response"))
    urn = lambda c: F.concat(F.lit("<urn:page:"), c.cast("string"), F.lit(">"))
    record = F.concat(
        F.lit(f"WARC/1.1{CRLF}"), _header("WARC-Type", kind),
        _header("WARC-Record-ID", F.coalesce(urn(F.col("page_id")), F.lit("<urn:page:none>"))),
        _header("WARC-Date", _utc("ts")),
        _header("WARC-Target-URI", F.col("url")),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        _header("WARC-Profile", F.when(again, F.lit(
            "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))),
        _header("WARC-Refers-To", F.when(again, urn(F.col("first")))),
        _header("Content-Type", F.lit("application/http; msgtype=response")),
        _header("Content-Length", F.octet_length("block")), F.lit(CRLF), F.col("block"))
    (rows.withColumn("block", block).select(record.alias("value")).write
     .option("lineSep", CRLF * 2).option("maxRecordsPerFile", RECORDS_PER_FILE)
     .option("compression", "gzip").text(path))


def url_key(url: str | None) -> str:
    """Sortable key of a URL: host labels reversed, then port, path and query; no scheme, user or fragment."""
    rest = (url or "").strip().split("#", 1)[0]
    rest = rest.split("://", 1)[-1]
    cut = min([k for k in (rest.find("/"), rest.find("?")) if k >= 0], default=len(rest))
    host, path = rest[:cut].rpartition("@")[2].lower(), rest[cut:]
    name, _, port = host.partition(":")
    key = ",".join(reversed([x for x in name.split(".") if x]))
    return key + (f":{port}" if port and port not in ("80", "443") else "") + ")" + (path or "/")


def records(data: bytes) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """(offset, length, headers, block) of every record of an archive."""
    at, size = 0, len(data)
    while at < size:
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode("utf-8").split(CRLF)
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        headers = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        start = end + 4
        stop = start + int(headers["content-length"])
        yield at, stop - at, headers, data[start:stop]
        at = stop + 4


def _id(value: str | None) -> int | None:
    text = (value or "").rpartition(":")[2].rstrip(">")
    return int(text) if text.lstrip("-").isdigit() else None


RUN_FIELDS = ("urlkey string, ts string, page_id long, url string, record_type string, refers_to long, "
              "payload_bytes long, payload_digest string, file string, offset long, length long, seq long")


def _entries(file: str, data: bytes) -> list[tuple]:
    """The index entries of an archive, sorted: one run. Stored payloads must match their digest.

    Offsets and lengths count bytes of the archive as unpacked.
    """
    out = []
    for offset, length, h, block in records(data):
        head, _, payload = block.partition(b"\r\n\r\n")
        digest = h["warc-payload-digest"].partition(":")[2]
        if h["warc-type"] == "response":
            size = len(payload)
            if hashlib.sha256(payload).hexdigest() != digest:
                raise ValueError(f"payload of the record at byte {offset} of {file} does not match its digest")
        else:
            size = int(head.rpartition(b"Content-Length:")[2].split(b"\r\n")[0])
        url = h.get("warc-target-uri")
        out.append((url_key(url), h.get("warc-date", ""), _id(h.get("warc-record-id")), url, h["warc-type"],
                    _id(h.get("warc-refers-to")), size, digest, file, offset, length))
    out.sort(key=_order)
    return [(*row, k) for k, row in enumerate(out)]


def _order(row: tuple) -> tuple:
    """Index order: URL key, timestamp, page id (nulls first), then place."""
    return row[0], row[1], row[2] is not None, row[2] or 0, row[8], row[9]


def read_runs(spark, path: str) -> DataFrame:
    """The sorted index run of every archive below ``path`` (one file is one run)."""
    names = [f.strip().split()[0] for f in RUN_FIELDS.split(",")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, data in zip(batch.column(0), batch.column(1)):
                rows = _entries(file.as_py(), gzip.decompress(data.as_py()))
                for start in range(0, len(rows), 10_000):
                    frame = pd.DataFrame(rows[start:start + 10_000], columns=names).astype(
                        {"page_id": "Int64", "refers_to": "Int64"})
                    yield pa.RecordBatch.from_pandas(frame, preserve_index=False)

    files = spark.read.format("binaryFile").load(path).where("length > 0").select("path", "content")
    return files.mapInArrow(run, RUN_FIELDS)


def merge(runs: list[list], key: Callable) -> Iterator:
    """K-way merge of sorted runs by a loser tree: log2(k) comparisons per row."""
    k = len(runs)
    if not k:
        return
    heads = [iter(r) for r in runs]
    rows = [next(h, None) for h in heads]
    keys = [None if r is None else key(r) for r in rows]

    def beats(i: int, j: int) -> bool:
        """Run i's head goes before run j's; finished runs lose, ties go to the earlier run."""
        if keys[i] is None or keys[j] is None:
            return keys[i] is not None or (keys[j] is None and i < j)
        return (keys[i], i) < (keys[j], j)

    losers = [-1] * k           # losers[0] is the overall winner
    for i in range(k):          # play every run up the tree once
        winner, node = i, (i + k) // 2
        while node > 0:
            if losers[node] < 0:
                losers[node], winner = winner, -1
                break
            if beats(losers[node], winner):
                losers[node], winner = winner, losers[node]
            node //= 2
        if winner >= 0:
            losers[0] = winner
    while keys[losers[0]] is not None:
        winner = losers[0]
        yield rows[winner]
        rows[winner] = next(heads[winner], None)
        keys[winner] = None if rows[winner] is None else key(rows[winner])
        node = (winner + k) // 2
        while node > 0:
            if beats(losers[node], winner):
                losers[node], winner = winner, losers[node]
            node //= 2
        losers[0] = winner


def merge_runs(runs: DataFrame) -> DataFrame:
    """All index entries in global order: by key_range, then position.

    Entries are dealt to key ranges (bounds on URL key, timestamp and id, so
    that one URL's captures may span ranges); each range merges the pieces of
    all runs it got.
    """
    n = max(1, -(-runs.count() // RANGE_ROWS), int(runs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = runs.repartitionByRange(n, "urlkey", "ts", "page_id", "file", "offset")
    names = runs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        pieces: dict[str, list[tuple]] = {}
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                pieces.setdefault(row[8], []).append(row)
        for piece in pieces.values():  # a run's rows keep their order; fetched blocks may not
            if any(a[-1] > b[-1] for a, b in zip(piece, piece[1:])):
                piece.sort(key=lambda r: r[-1])
        part, position, out = TaskContext.get().partitionId(), 0, []

        def flush() -> pa.RecordBatch:
            frame = pd.DataFrame(out, columns=[*names, "key_range", "position"]).astype(
                {"page_id": "Int64", "refers_to": "Int64"})
            out.clear()
            return pa.RecordBatch.from_pandas(frame, preserve_index=False)

        for row in merge([pieces[f] for f in sorted(pieces)], _order):
            out.append((*row, part, position))
            position += 1
            if len(out) == 10_000:
                yield flush()
        if out:
            yield flush()

    return dealt.mapInArrow(run, f"{RUN_FIELDS}, key_range long, position long")


def archive(pages: DataFrame, path: str | None = None) -> DataFrame:
    """Write the archives, read them back and return the merged index.

    One row per page, with urlkey, ts, page_id, url, record_type, refers_to,
    payload_bytes and payload_digest (of the full payload), file, offset,
    length, and rank, its place (from 1) in the global order of captures by
    URL key, timestamp and page id. Repeated rows give
    repeated records; an empty table gives an empty index.
    """
    spark = pages.sparkSession
    path = path or new_path(spark, "warc")
    write_archives(pages, path)
    merged = stored(merge_runs(stored(read_runs(spark, path), "runs")).drop("seq"), "index")
    sizes = merged.groupBy("key_range").agg(F.count("*").alias("n"))
    before = Window.orderBy("key_range").rowsBetween(Window.unboundedPreceding, -1)   # one row per key range
    starts = sizes.select("key_range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    return (merged.join(F.broadcast(starts), "key_range")
            .withColumn("rank", F.col("start") + F.col("position") + 1).drop("key_range", "position", "start"))
