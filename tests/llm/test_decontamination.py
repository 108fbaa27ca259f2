import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from linkframe.llm import decontamination as D
from linkframe.llm.text import word_hashes


def brute_tiles(doc, item, least):
    """The longest common run of unmarked words, again and again."""
    doc, item, tiles = list(doc), list(item), []
    marked_doc, marked_item = [False] * len(doc), [False] * len(item)
    while True:
        best = (0, 0, 0)
        for j in range(len(item)):
            for i in range(len(doc)):
                n = 0
                while i + n < len(doc) and j + n < len(item) and doc[i + n] == item[j + n] and not (marked_doc[i + n] or marked_item[j + n]):
                    n += 1
                if n > best[0]:
                    best = (n, j, i)
        n, j, i = best
        if n < least:
            return tiles
        tiles.append((i, j, n))
        marked_doc[i:i + n] = marked_item[j:j + n] = [True] * n


def test_tiling_equals_brute_force():
    rng = np.random.RandomState(4)
    for _ in range(150):
        doc, item = rng.randint(0, 4, rng.randint(0, 40)).astype(np.uint64), rng.randint(0, 4, rng.randint(0, 20)).astype(np.uint64)
        found, wanted = D.tile(doc, item, 3), brute_tiles(doc, item, 3)
        assert sorted(n for _, _, n in found)[-1:] == sorted(n for _, _, n in wanted)[-1:]
        assert sum(n for *_, n in found) == sum(n for *_, n in wanted) or [n for *_, n in found][0] == [n for *_, n in wanted][0]
        for i, j, n in found:
            assert (doc[i:i + n] == item[j:j + n]).all()
        for place in (0, 1):
            cells = [c for t in found for c in range(t[place], t[place] + t[2])]
            assert len(cells) == len(set(cells))


ITEM = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon"
WORDS = ITEM.split()


@pytest.fixture(scope="module")
def bench(spark):
    return spark.createDataFrame([
        (1, ITEM), (2, ITEM.upper()), (3, "one two three four"), (4, None), (5, ""), (None, "no item id but words enough here"),
        (6, "the cat sat on the mat and the dog lay on the rug by the door"),
    ], "item_id long, text string")


@pytest.fixture(scope="module")
def docs(documents, awkward):
    fill = "some plain filler words of a document that says nothing of note and goes on for a while "
    rows = [
        (100, fill + ITEM + fill), (101, fill + " ".join(WORDS[10:]) + " " + fill * 30 + " ".join(WORDS[:10])), (102, fill * 3),
        (103, fill + ", ".join(WORDS).title() + "! " + fill), (104, " ".join(WORDS[:11])), (105, " ".join(WORDS[:12])),
        (106, " ".join(w for k in range(0, 20, 4) for w in WORDS[k:k + 4])), (107, "one two three four"),
        (108, fill * 2000 + ITEM), (109, (ITEM + " ") * 300), (100, fill + ITEM + fill), (110, " ".join(WORDS[::-1])),
    ]
    return documents([(i, t, "en", "a") for i, t in rows]).unionByName(awkward)


CAUGHT = {100, 101, 103, 105, 106, 108, 109}


def test_planted_passages(docs, bench):
    rows = D.Tiling().pairs(docs, bench).collect()
    assert {r["doc_id"] for r in rows} == CAUGHT and {r["item_id"] for r in rows} == {1, 2}
    assert len(rows) == 2 * (len(CAUGHT) + 1)
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[101]["tiles"] == 2 and by_id[101]["coverage"] == 1.0
    assert by_id[105]["covered"] == 12 and by_id[105]["words"] == 20


def test_items_without_an_id_count(spark, documents, bench, tmp_path):
    rows = [(1, "it says: no item id but words enough here, and more"), (2, ITEM), (3, "something else that nobody has asked about")]
    docs = documents([(i, t, "en", "a") for i, t in rows])
    found = sorted(((r["doc_id"], r["item_id"]) for r in D.Tiling().pairs(docs, bench).collect()), key=repr)
    assert found == [(1, None), (2, 1), (2, 2)]
    bench.write.parquet(f"{tmp_path}/benchmark.parquet")
    assert [r["doc_id"] for r in corpus_pipeline.benchmark_decontamination(spark, docs, str(tmp_path)).collect()] == [3]


def test_blocks_make_no_difference(docs, bench):
    key = lambda r: tuple(r)
    whole = sorted(map(key, D.Tiling().pairs(docs, bench).collect()))
    assert sorted(map(key, D.Tiling(block_words=1).pairs(docs, bench).collect())) == whole


def test_pairs_equal_brute_force_on_the_tables(spark):
    sf = "/root/testdata/sf0.001"
    docs, bench = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet")
    tiling, wanted = D.Tiling(), set()
    items = [(r["item_id"], word_hashes(r["text"])[0]) for r in bench.collect()]
    for r in docs.collect():
        words = word_hashes(r["text"])[0]
        for i, item in items:
            common = np.isin(item, words).mean()
            if common >= tiling.threshold and sum(n for *_, n in D.tile(words, item, 3)) >= tiling.threshold * len(item):
                wanted.add((r["doc_id"], i))
    assert {(r["doc_id"], r["item_id"]) for r in tiling.pairs(docs, bench).collect()} == wanted and wanted


def test_empty_tables(docs, bench, nothing):
    assert D.Tiling().pairs(nothing, bench).count() == 0
    assert D.Tiling().pairs(docs, bench.limit(0)).count() == 0


def test_stage(spark, docs, bench, tmp_path):
    bench.write.parquet(f"{tmp_path}/benchmark.parquet")
    marked = docs.withColumns({"contaminated": F.lit("x"), "contaminated_0_": F.lit(0), "doc": F.lit(1)})
    out = corpus_pipeline.benchmark_decontamination(spark, marked, str(tmp_path))
    assert out.columns == marked.columns and out.count() == docs.count() - len(CAUGHT) - 1
    assert not CAUGHT & {r["doc_id"] for r in out.collect()} and {r["contaminated"] for r in out.collect()} == {"x"}
    (tmp_path / "none").mkdir()
    bench.limit(0).write.parquet(f"{tmp_path}/none/benchmark.parquet")
    assert corpus_pipeline.benchmark_decontamination(spark, docs, f"{tmp_path}/none").count() == docs.count()
