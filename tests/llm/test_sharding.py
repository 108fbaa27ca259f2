import re
import zlib

import numpy as np
import pytest

from linkframe.llm import sharding


def check(rows, shards):
    sizes = np.bincount([r["shard"] for r in rows], [r["size"] for r in rows], minlength=shards)
    largest = max((r["size"] for r in rows), default=0)
    assert not rows or sizes.max() - sizes.min() <= 2 * largest
    for shard in range(shards):
        slots = sorted(r["slot"] for r in rows if r["shard"] == shard)
        assert slots == list(range(len(slots)))
    return sizes


def test_shards_are_contiguous_balanced_and_exact(documents):
    rng = np.random.RandomState(0)
    docs = documents([(int(i), "é" * int(rng.randint(0, 300)), "en", "a") for i in rng.permutation(2000)])
    rows = sharding.shard_documents(docs, 24).collect()
    check(rows, 24)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    place, total = 0, sum(r["size"] for r in rows)
    for row in sorted(rows, key=lambda r: r["doc_id"]):
        assert row["size"] == len(texts[row["doc_id"]].encode()) + 8
        assert row["text_crc32"] == zlib.crc32(texts[row["doc_id"]].encode())
        assert row["shard"] == (2 * place + row["size"]) * 24 // (2 * total)
        place += row["size"]
    order = [(r["shard"], r["slot"]) for r in sorted(rows, key=lambda r: r["doc_id"])]
    assert order == sorted(order)


@pytest.mark.parametrize("same", [0, None])
def test_one_key_for_all_rows_is_split(documents, same):
    rows = sharding.shard_documents(documents([(same, "copy", "en", "a")] * 1200), 24).collect()
    assert set(check(rows, 24)) == {50 * 12}


def test_awkward_and_empty(awkward, nothing):
    rows = sharding.shard_documents(awkward, 24).collect()
    assert len(rows) == awkward.count() and all(0 <= r["shard"] < 24 for r in rows)
    check(rows, 24)
    assert sharding.shard_documents(nothing, 24).count() == 0


def test_no_python_in_the_plan(awkward):
    plan = sharding.shard_documents(awkward, 24)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_clashing_names(documents):
    rows = documents([(1, "a", "en", "s"), (2, "b", "en", "s")]).selectExpr("doc_id", "doc_id as size", "'x' as shard", "'y' as slot", "lang")
    out = sharding.shard_by_bytes(rows, 2, ["doc_id"])
    assert out.columns == ["doc_id", "size", "lang", "shard", "slot"]
    assert sorted((r["doc_id"], r["shard"]) for r in out.collect()) == [(1, 0), (2, 1)]
