"""WARC archives with an externally merged capture index (operator 6).

Every page becomes one WARC/1.1 record (HTTP payload left out: the block is the HTML).
Of records with equal payloads of at least ``MIN_SHARED`` bytes the one with the smallest
page_id is a response; the others are revisits without a block that refer to it.  Spark's
text writer lays records one behind the other (the record separator is its line
separator), so archives have the usual commit protocol of a Spark table.

Index: every archive file yields its captures as a locally sorted run (URL key, time,
page).  Runs are range-partitioned by the same key and every range is merged from its k
run slices by a loser tree, so the parts in order form one globally ordered capture history.

Archives are read whole by file (``files`` of bounded record counts keep that bounded),
records are parsed by their Content-Length and checked against their digests.

Defined cases: null html is an empty payload; null page_ids sort last and are written as
empty; a null url is an empty target; rows with the same page_id and payload are all
responses if theirs is the smallest id; payloads shared only by null ids are responses; an
empty table gives no archive, an empty index and an empty result.
"""

from __future__ import annotations

import gzip
import hashlib
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

MIN_SHARED = 100
SEPARATOR = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def classify(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``html``, ``payload_bytes``, ``payload_digest``, ``refers_to`` (null: a response)."""
    p = pages.select("page_id", F.coalesce("url", F.lit("")).alias("url"), F.coalesce("html", F.lit("")).alias("html"))
    p = p.select("*", F.octet_length("html").cast("long").alias("payload_bytes"), F.sha2("html", 256).alias("payload_digest"))
    # one row per shared payload; the smallest id is found before anything is moved
    shared = (p.where(F.col("payload_bytes") >= MIN_SHARED).groupBy(F.col("payload_digest").alias("d"))
              .agg(F.count(F.lit(1)).alias("n"), F.min("page_id").alias("first_id")).where("n > 1").drop("n"))
    return (p.join(shared, p["payload_digest"] == shared["d"], "left")
            .withColumn("refers_to", F.when(~F.col("page_id").eqNullSafe(F.col("first_id")), F.col("first_id")))
            .drop("d", "first_id"))


def _record(id_text: Column) -> Column:
    """One record without the separator that ends it."""
    name = lambda i: F.concat(F.lit("<urn:page:"), i, F.lit(">"))
    # captures carry no time of their own: ids count seconds from a fixed day
    at = F.date_format(F.timestamp_seconds(F.lit(1_700_000_000) + F.coalesce(F.col("page_id").cast("long"), F.lit(0)) % 100_000_000),
                       "yyyy-MM-dd'T'HH:mm:ss'Z'")
    revisit = F.col("refers_to").isNotNull()
    url = F.regexp_replace("url", r"[\r\n]+", " ")
    lines = [
        F.lit("WARC/1.1"), F.concat(F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: "), name(id_text)), F.concat(F.lit("WARC-Date: "), at),
        F.concat(F.lit("WARC-Target-URI: "), url), F.concat(F.lit("WARC-Payload-Digest: sha256:"), F.col("payload_digest")),
        F.concat(F.lit("X-Payload-Length: "), F.col("payload_bytes").cast("string")),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), name(F.col("refers_to").cast("string")))),
        F.when(revisit, F.lit(f"WARC-Profile: {PROFILE}")),
        F.lit("Content-Type: text/html; charset=utf-8"),
        F.concat(F.lit("Content-Length: "), F.when(revisit, F.lit("0")).otherwise(F.col("payload_bytes").cast("string")))]
    return F.concat(F.concat_ws("\r\n", *lines), F.lit("\r\n\r\n"), F.when(revisit, F.lit("")).otherwise(F.col("html")))


def write_archives(pages: DataFrame, path: str, records_per_file: int = 10_000) -> None:
    """Write ``pages`` as WARC files (gzip) of at most ``records_per_file`` records to ``path``."""
    record = _record(F.coalesce(F.col("page_id").cast("string"), F.lit("")))
    (classify(pages).select(record.alias("value")).write.option("lineSep", SEPARATOR).option("compression", "gzip")
     .option("maxRecordsPerFile", records_per_file).text(path))


def records(data: bytes) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """(offset, length, headers, block) of every record of an archive."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        first, *lines = data[at:end].decode().split("\r\n")
        if not first.startswith("WARC/"):
            raise ValueError(f"no record at {at}")
        headers = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines)
        stop = end + 4 + int(headers["Content-Length"])
        block = data[end + 4:stop]
        if data[stop:stop + 4] != b"\r\n\r\n":
            raise ValueError(f"record at {at} is cut")
        yield at, stop + 4 - at, headers, block
        at = stop + 4


def url_key(url: str) -> str:
    """The URL with its host's labels reversed, in lower case and without the scheme: sorts by site."""
    try:
        parts = urlsplit(url)
        host = ",".join(reversed((parts.hostname or "").split(".")))
        port = f":{parts.port}" if parts.port else ""
    except ValueError:
        return url.lower()
    query = f"?{parts.query}" if parts.query else ""
    return f"{host}{port}){parts.path or '/'}{query}".lower() if host else url.lower()


INDEX = ("url_key string, captured string, page_id {id}, run string, place long, offset long, length long, url string, "
         "record_type string, payload_bytes long, payload_digest string, refers_to {id}")
_ID = r"<urn:page:(.*)>$"


def read_runs(path: str, pages: DataFrame) -> DataFrame:
    """The captures of all archives under ``path``; each file is one run, sorted locally."""
    kind = pages.schema["page_id"].dataType.simpleString()
    text_schema = INDEX.format(id="string")
    names = [c.split()[0] for c in text_schema.split(", ")]
    types = [pa.int64() if c.split()[1] == "long" else pa.string() for c in text_schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                name = b.column(0)[i].as_py()
                data = gzip.decompress(b.column(1)[i].as_py())
                rows = []
                for offset, length, h, block in records(data):
                    digest = h["WARC-Payload-Digest"].removeprefix("sha256:")
                    size = int(h["X-Payload-Length"])
                    own = h["WARC-Type"] == "response"
                    if own and (len(block) != size or hashlib.sha256(block).hexdigest() != digest):
                        raise ValueError(f"{name}: payload at {offset} does not match its digest")
                    page = h["WARC-Record-ID"][len("<urn:page:"):-1]
                    other = h["WARC-Refers-To"][len("<urn:page:"):-1] if "WARC-Refers-To" in h else None
                    url = h.get("WARC-Target-URI", "")
                    rows.append((url_key(url), h["WARC-Date"], page or None, name, 0, offset, length, url,
                                 h["WARC-Type"], size, digest, other))
                rows.sort(key=lambda r: (r[0], r[1], r[2] is None, r[2] or ""))
                cols = [[r[c] for r in rows] for c in range(len(names))]
                cols[4] = list(range(len(rows)))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=names)

    files = pages.sparkSession.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    read = files.select("path", "content").mapInArrow(run, text_schema)
    return read.withColumn("page_id", F.col("page_id").cast(kind)).withColumn("refers_to", F.col("refers_to").cast(kind))


class LoserTree:
    """Merges k sorted lists: each inner node keeps the loser of its match, the overall winner leaves
    and only its path is replayed."""

    def __init__(self, lists: list[list], key):
        self.k = max(len(lists), 1)
        self.lists, self.key = lists, key
        self.at = [0] * self.k
        self.heads = [(0, key(x[0])) if x else (1,) for x in lists] or [(1,)]  # (1,): used up, loses to all
        self.nodes = [-1] * self.k
        for leaf in range(self.k):
            self._play(leaf, building=True)

    def _play(self, leaf: int, building: bool = False) -> None:
        winner, node = leaf, (leaf + self.k) // 2
        while node:
            other = self.nodes[node]
            if building and other < 0:
                self.nodes[node] = winner
                return
            if (self.heads[other], other) < (self.heads[winner], winner):
                self.nodes[node], winner = winner, other
            node //= 2
        self.nodes[0] = winner

    def __iter__(self) -> Iterator:
        while True:
            w = self.nodes[0]
            if self.heads[w] == (1,):
                return
            yield self.lists[w][self.at[w]]
            self.at[w] += 1
            more = self.at[w] < len(self.lists[w])
            self.heads[w] = (0, self.key(self.lists[w][self.at[w]])) if more else (1,)
            self._play(w)


def merge_runs(runs: DataFrame) -> DataFrame:
    """The capture history: part by part in ascending order of URL key, time, run and place in the run.

    The runs are stored first: the range sort looks at them twice, and a lost range reads its slices again
    instead of the archives."""
    ranged = (written(runs, "warc-runs").repartitionByRange("url_key", "captured", "run", "place")
              .sortWithinPartitions("run", "place"))
    names = ranged.columns
    at = {c: i for i, c in enumerate(names)}
    step = 65_536

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slices: dict[str, list[tuple]] = {}
        schema = None
        for b in batches:
            schema = b.schema
            for row in zip(*(c.to_pylist() for c in b.columns)):
                slices.setdefault(row[at["run"]], []).append(row)
        if schema is None:
            return
        order = lambda r: (r[at["url_key"]], r[at["captured"]], r[at["run"]], r[at["place"]])
        held: list[tuple] = []
        for row in LoserTree(list(slices.values()), order):
            held.append(row)
            if len(held) == step:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
                held = []
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)

    return ranged.mapInArrow(run, ranged.schema)
