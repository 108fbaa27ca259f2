import zlib
from collections import Counter
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import check
from linkframe.llm import spelling
from linkframe.llm.spelling import SpellingVariants
from graphs import SMALL


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def brute_force(rows, method):
    counts = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if method.misspell and h % method.misspell == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= method.least_length and n >= method.least_count}
    forms, near = {}, {}
    for w, n in words.items():
        others = [v for v in words if one_edit(w, v)]
        near[w] = len(others)
        best = min(others, key=lambda v: (-words[v], v), default=None)
        forms[w] = best if best is not None and words[best] >= method.ratio * n else None
    out = []
    for w, n in words.items():
        root = w
        while forms[root] is not None:
            root = forms[root]
        out.append((w, forms[w], root, n, near[w], words.get(forms[w])))
    return sorted(out, key=repr)


def grouped(df):
    return sorted((tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()), key=repr)


@settings(max_examples=60, deadline=None)
@given(st.text("abcdàÿ", min_size=1, max_size=6), st.integers(1, 5))
def test_neighbourhoods_hold_all_edits_of_the_reduced_word(word, symbols):
    rows = spelling.reduced([word], symbols)
    got = set(spelling.neighbourhood(rows, symbols)[0].tolist())
    letters = rows[0].tolist()
    edits = {tuple(letters)} | {tuple(letters[:i] + letters[i + 1 :]) for i in range(len(letters))}
    for b in range(1, symbols + 1):
        edits |= {tuple(letters[:i] + [b] + letters[i + 1 :]) for i in range(len(letters))}
        edits |= {tuple(letters[:i] + [b] + letters[i:]) for i in range(len(letters) + 1)}
    want = {int(spelling.reduced_hash(np.array([e], np.uint64))[0]) if e else 0 for e in edits}
    assert got == want


@pytest.mark.parametrize("misspell", [97, 2, 0])
def test_equals_brute_force(spark, misspell):
    rng = np.random.default_rng(5)
    stems = ["".join(rng.choice(list("abcdefgéß"), int(rng.integers(4, 9)))) for _ in range(25)]
    words = []
    for w in stems:
        words += [w] * int(rng.integers(1, 40))
        for _ in range(6):
            k = int(rng.integers(0, len(w)))
            words += [w[:k] + str(rng.choice(list("abé"))) + w[k + int(rng.integers(0, 2)) :]] * int(rng.integers(1, 9))
    rng.shuffle(words)
    rows = [(i, " ".join(words[i :: 40]).title() if i % 3 else ",".join(words[i :: 40])) for i in range(40)]
    method = SpellingVariants(misspell=misspell)
    assert grouped(method.group(spark.createDataFrame(rows, "doc_id long, text string"))) == brute_force(rows, method)


def test_chains_are_walked_to_their_end(spark):
    rows = [(0, " ".join(sum(([w] * n for w, n in (("abcdefgh", 3), ("abcdefg", 6), ("abcdef", 12), ("abcde", 24), ("abcdx", 48), ("abcyx", 100))), [])))]
    method = SpellingVariants(misspell=0)
    got = {r[0]: r[2] for r in grouped(method.group(spark.createDataFrame(rows, "doc_id long, text string")))}
    assert set(got.values()) == {"abcyx"}


def test_awkward_rows_and_empty_tables(awkward, nothing, spark):
    texts = awkward.withColumn("word", F.lit(1)).withColumn("n", F.lit(2)).withColumn("run", F.lit(3))
    rows = [(r["doc_id"], r["text"]) for r in awkward.collect()]
    method = SpellingVariants()
    assert grouped(method.group(texts)) == brute_force(rows, method)
    assert method.group(nothing).count() == 0


def test_query_matches_its_sql(spark, duck):
    assert check.compare(spark, duck, SMALL, "op12_spelling_variants").startswith("ok")
