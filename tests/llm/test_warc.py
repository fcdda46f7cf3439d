"""Archives: round trips, determinism, commits."""

import base64
import glob
import gzip
import hashlib
import os
from collections import Counter, defaultdict

import pytest

from catalog_star.llm import warc

ROWS = [
    (1, "http://b/1", "<p>same</p>"), (2, "http://a/é\r\nX: y", "<p>same</p>"), (3, None, None), (4, "http://a/2", ""), (5, "http://a/3", "x" * 300_000),
    (6, "http://c/ 1", "\r\n\r\nWARC/1.1\r\n"), (6, "http://c/ 1", "\r\n\r\nWARC/1.1\r\n"), (None, None, "ü"), (None, None, "ü"), (8, "http://d", "ü"),
]


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(*r, 0, "x", "y") for r in ROWS]
    return spark.createDataFrame(rows, "page_id long, url string, html string, payload int, record_type string, __digest string")


def test_round_trip(spark, pages, tmp_path):
    folder = f"file://{tmp_path}/archive"
    manifest = warc.write_archives(pages, folder, shard_bytes=100_000, roll_bytes=500)
    found = warc.read_archives(spark, folder).collect()
    assert len(found) == len(ROWS) and manifest.agg({"records": "sum"}).first()[0] == len(ROWS)
    same = defaultdict(list)
    for page, url, html in ROWS:
        same[(html or "").encode()].append((page is not None, page or 0, url or ""))
    wanted = Counter()
    for page, url, html in ROWS:
        data = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        wanted[page, len(data), digest] += 1
    assert wanted == Counter((r["page_id"], r["payload_bytes"], r["payload_digest"]) for r in found)
    by_digest = defaultdict(list)
    for r in found:
        by_digest[r["payload_digest"]].append(r)
    for group in by_digest.values():
        latest = max((r["page_id"] for r in group if r["page_id"] is not None), default=None)
        responses = [r for r in group if r["record_type"] == "response"]
        assert len(responses) == 1 and responses[0]["page_id"] == latest and responses[0]["refers_to"] is None
        assert len(responses[0]["payload"]) == responses[0]["payload_bytes"]
        assert all(r["refers_to"] == latest and r["payload"] is None for r in group if r["record_type"] == "revisit")


def test_files_depend_on_the_records_only(spark, pages, tmp_path):
    digests = []
    for n in (1, 7):
        folder = f"{tmp_path}/archive{n}"
        warc.write_archives(pages.repartition(n), folder, shard_bytes=100_000, roll_bytes=400)
        files = sorted(glob.glob(f"{folder}/*.warc.gz"))
        digests.append({os.path.basename(f): hashlib.sha256(open(f, "rb").read()).hexdigest() for f in files})
        assert len(files) > 3
    assert digests[0] == digests[1]


def test_files_are_rolled_and_members_stand_alone(spark, pages, tmp_path):
    folder = f"{tmp_path}/archive"
    manifest = warc.write_archives(pages, folder, shard_bytes=1 << 30, roll_bytes=900).collect()
    for r in manifest:
        path = f"{folder}/{r['name']}"
        assert os.path.getsize(path) == r["bytes"] and (r["bytes"] <= 900 or r["records"] == 1)
        assert hashlib.sha256(open(path, "rb").read()).hexdigest() == r["sha256"]
        assert gzip.open(path).read().startswith(b"WARC/1.1\r\nWARC-Type: warcinfo\r\n")


def test_least_bytes_spares_small_payloads(spark, pages, tmp_path):
    warc.write_archives(pages, f"{tmp_path}/archive", least_bytes=3)
    found = warc.read_archives(spark, f"{tmp_path}/archive", with_payload=False).collect()
    assert {r["record_type"] for r in found if r["payload_bytes"] < 3} == {"response"}
    assert sum(r["record_type"] == "revisit" for r in found) == 2


def test_commit_may_be_repeated_and_lost_attempts_go(spark, pages, tmp_path):
    folder = f"{tmp_path}/archive"
    warc.write_archives(pages, folder)
    os.makedirs(f"{folder}/_temporary")
    open(f"{folder}/_temporary/shard-000000-000000.warc.gz.lost", "wb").write(b"half a file")
    os.remove(f"{folder}/{warc.MARKER}")
    with pytest.raises(ValueError, match="no committed archive"):
        warc.read_archives(spark, folder)
    warc.commit(spark, folder)
    assert not os.path.exists(f"{folder}/_temporary")
    assert warc.read_archives(spark, folder).count() == len(ROWS)


def test_altered_records_are_noticed(spark, pages, tmp_path):
    folder = f"{tmp_path}/archive"
    manifest = warc.write_archives(pages, folder).collect()
    path = f"{folder}/{manifest[0]['name']}"
    data = gzip.open(path).read().replace(b"<p>same", b"<p>samE")
    with gzip.open(path, "wb") as out:
        out.write(data)
    with pytest.raises(Exception, match="was altered"):
        warc.read_archives(spark, folder).count()


def test_empty_table(spark, pages, tmp_path):
    assert warc.write_archives(pages.where("false"), f"{tmp_path}/archive").count() == 0
    assert warc.read_archives(spark, f"{tmp_path}/archive").count() == 0
