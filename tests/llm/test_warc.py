import base64
import gzip
import hashlib

import pytest
from pyarrow import fs
from pyspark.sql import functions as F

from linkframe.llm import warc

PAGES = [
    (1, "http://a/ b\r\nX: 1", "<p>one</p>"), (2, None, ""), (3, "http://c/", None), (4, "http://d/é", "\r\n\r\nWARC/1.1\r\n\r\n"), (5, "u", "ß" * 100_000),
    (6, "http://a/", "<p>one</p>"), (1, "http://a/", "<p>one</p>"), (None, "http://n/", "<p>one</p>"), (None, "http://m/", "only null"), (0, "", "\x00\U0001f600"),
]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame(PAGES, "page_id long, url string, html string").repartition(3)


def written(pages, **options):
    return warc.write(warc.plan(pages, "page_id", "url", F.col("html").cast("binary"), **options))


def expected(least=0):
    out = []
    for i, _, html in PAGES:
        data = (html or "").encode()
        ids = [j for j, _, h in PAGES if (h or "").encode() == data and j is not None]
        first = min(ids, default=None)
        other = len(data) >= least and first is not None and i != first
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((i, len(data), digest, "revisit" if other else "response", first if other else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("least", [0, 5])
def test_round_trip(pages, least):
    back = warc.read(written(pages, least_revisit=least)).collect()
    found = [(r["record_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in back]
    assert sorted(found, key=repr) == expected(least)
    assert {bytes(r["payload"]).decode() for r in back if r["record_type"] == "response"} == {h or "" for _, _, h in PAGES}


def test_archives_are_plain_warc_and_the_index_points_into_them(pages):
    index = written(pages).collect()
    files = {r["file"] for r in index}
    for file in files:
        system, path = fs.FileSystem.from_uri(file)
        data = system.open_input_stream(path, compression=None).read()
        assert gzip.decompress(data).count(b"WARC/1.1\r\nWARC-Type: ") == sum(r["file"] == file for r in index)
        end = 0
        for r in sorted((r for r in index if r["file"] == file), key=lambda r: r["offset"]):
            assert r["offset"] == end
            end += r["length"]
        assert end == len(data)


def test_any_selection_is_read(pages, monkeypatch):
    index = written(pages)
    some = index.where("record_type = 'response' and url like 'http://d%'")
    assert [bytes(r["payload"]).decode() for r in warc.read(some).collect()] == ["\r\n\r\nWARC/1.1\r\n\r\n"]
    assert warc.read(index.limit(0)).count() == 0


def test_damage_is_noticed():
    good = warc.render(7, "u", b"payload", base64.b32encode(hashlib.sha1(b"payload").digest()).decode(), None, False)
    assert warc.parse(good)["payload"] == b"payload"
    with pytest.raises(ValueError):
        warc.parse(good.replace(b"payload\r\n", b"Payload\r\n"))


def test_empty_table_and_clashing_names(pages):
    assert warc.read(written(pages.limit(0))).count() == 0
    clash = pages.withColumns({"payload": F.lit(1), "sha1": F.lit(2), "record_id": F.lit(3), "n": F.lit(4), "first": F.lit(5)})
    assert warc.read(written(clash)).count() == len(PAGES)
