import gzip
import hashlib
import random

import pytest

from nightledger.llm import warc

PAGE = "page_id long, url string, html string, url_key string"
BIG = "<p>" + "é" * 60 + "\r\n\r\n</p>"


def by_hand(rows):
    first = {}
    for i, _, html in rows:
        if i is not None:
            first[html or ""] = min(first.get(html or "", i), i)
    out = []
    for i, _, html in rows:
        data = (html or "").encode()
        least = first.get(html or "") if len(data) >= 100 else None
        other = least if least is not None and least != i and sum((h or "") == (html or "") for _, _, h in rows) > 1 else None
        out.append((i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if other is not None else "response", other))
    return sorted(out, key=repr)


def back(df):
    return sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def odd():
    return [(5, "http://a.b.org/x?q=1", BIG), (3, "https://A.b.org:8080", BIG), (9, None, BIG), (3, "http://a.b.org/x?q=1", BIG),
            (None, "nourl", BIG), (1, "http://z.com/", None), (2, "http://z.com/", ""), (4, "http://[bad", "short"), (6, "x\r\ny", "short"),
            (7, "http://z.com/", "WARC/1.1\r\n\r\n" + "b" * 100), (8, "http://z.com/", "WARC/1.1\r\n\r\n" + "b" * 100)]


def make(spark, rows):
    return spark.createDataFrame([(*r, "clash") for r in rows], PAGE)


def test_round_trip_of_odd_pages(spark, odd, tmp_path):
    path = str(tmp_path / "w")
    pages = make(spark, odd)
    warc.write_archives(pages, path, records_per_file=2)
    assert back(warc.merge_runs(warc.read_runs(path, pages))) == by_hand(odd)


def test_archives_are_plain_warc(spark, odd, tmp_path):
    path = tmp_path / "w"
    warc.write_archives(make(spark, odd), str(path))
    seen = []
    for f in path.glob("part-*"):
        for _, _, h, block in warc.records(gzip.decompress(f.read_bytes())):
            seen.append(h["WARC-Type"])
            assert h["WARC-Type"] == "revisit" and not block and "WARC-Refers-To" in h or len(block) == int(h["Content-Length"])
    assert sorted(seen) == sorted(r[3] for r in by_hand(odd))


def test_history_is_globally_ordered(spark, sf_small, tmp_path):
    path = str(tmp_path / "w")
    pages = spark.read.parquet(f"{sf_small}/pages.parquet")
    warc.write_archives(pages.repartition(5), path, records_per_file=7)
    history = warc.merge_runs(warc.read_runs(path, pages))
    rows = [r for part in history.rdd.glom().collect() for r in part]  # parts in order
    keys = [(r["url_key"], r["captured"], r["run"], r["place"]) for r in rows]
    assert keys == sorted(keys) and len({r["run"] for r in rows}) > 5
    assert back(history) == by_hand([(r["page_id"], r["url"], r["html"]) for r in pages.collect()])


def test_loser_tree_merges_any_number_of_lists():
    rng = random.Random(1)
    for k in range(12):
        lists = [sorted(rng.choices(range(30), k=rng.randrange(9))) for _ in range(k)]
        assert list(warc.LoserTree(lists, lambda x: x)) == sorted(x for y in lists for x in y)


def test_url_keys_sort_by_site():
    assert warc.url_key("HTTP://www.Example.org:80/A?b") == "org,example,www:80)/a?b"
    assert warc.url_key("http://x.org") == "org,x)/" and warc.url_key("") == ""


def test_a_changed_payload_is_noticed(spark, odd, tmp_path):
    path = tmp_path / "w"
    pages = make(spark, odd)
    warc.write_archives(pages.coalesce(1), str(path))
    f = next(path.glob("part-*"))
    data = gzip.decompress(f.read_bytes()).replace(b"short", b"shirt", 1)
    f.write_bytes(gzip.compress(data))
    next(path.glob(f".{f.name}.crc")).unlink()
    with pytest.raises(Exception, match="does not match its digest"):
        warc.read_runs(str(path), pages).collect()


def test_empty_table(spark, tmp_path):
    path = str(tmp_path / "w")
    pages = make(spark, [])
    warc.write_archives(pages, path)
    assert warc.merge_runs(warc.read_runs(path, pages)).count() == 0
