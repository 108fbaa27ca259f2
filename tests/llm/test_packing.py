import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from linkframe.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")
ENCODER = packing.WordEncoder(PATH)


def least_sequences(lengths, capacity):
    """The optimum, by branch and bound."""
    lengths, best = sorted(lengths, reverse=True), len(lengths)

    def go(k, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if k == len(lengths):
            best = len(rooms)
            return
        for room in {r for r in rooms if r >= lengths[k]}:
            rest = list(rooms)
            rest.remove(room)
            go(k + 1, [*rest, room - lengths[k]])
        go(k + 1, [*rooms, capacity - lengths[k]])

    go(0, [])
    return best


def test_words_met_before_are_found_without_a_walk_through_all():
    class Kept(dict):
        def __iter__(self):
            raise AssertionError("walked through all words of the older half")

    encoder = packing.WordEncoder(PATH)
    texts = ["Some words, some Ünïcödé, it's 42 <|x|> \u0130stanbul " + "long" * 40, "", "some words again 42"]
    first = encoder.encode(texts)
    assert [np.frombuffer(ids, "<u4").tolist() for ids in first] == [e.ids for e in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]
    encoder.known, encoder.older = {}, Kept(encoder.known)
    assert encoder.encode(texts) == first
    assert not any(len(w) > packing.CACHE_CHARS for w in encoder.known)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=9))
def test_the_reduction_keeps_the_optimum(lengths):
    counts = np.bincount(lengths, minlength=21).astype(np.int64)
    fixed = packing.reduce(counts, 20)
    taken = Counter(n for set_, times in fixed for n in set_ for _ in range(times))
    assert all(sum(set_) <= 20 for set_, _ in fixed)
    left = [n for n in range(21) for _ in range(counts[n])]
    assert taken + Counter(left) == Counter(lengths)
    assert sum(times for _, times in fixed) + least_sequences(left, 20) == least_sequences(lengths, 20)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=300))
def test_a_plan_places_every_piece_once_without_gaps(lengths):
    counts = Counter(lengths)
    made = packing.plan(counts, 50)
    held = defaultdict(list)
    for length, n in counts.items():
        sequence, offset = made.find(np.full(n, length), np.arange(n))
        for s, o in zip(sequence.tolist(), offset.tolist()):
            held[s].append((o, length))
    for parts in held.values():
        end = 0
        for o, n in sorted(parts):
            assert o == end
            end += n
        assert end <= 50
    assert sorted(held) == list(range(made.sequences))
    assert made.sequences <= 11 / 9 * -(-sum(lengths) // 50) + len(lengths) * 0.25 + 1


def test_plans_are_fast_for_huge_counts():
    made = packing.plan({n: 10**9 + n for n in range(1, 4097)})
    # No two pieces longer than half a sequence, and no three halves, share one: fewer is not possible.
    assert made.sequences == sum(10**9 + n for n in range(2049, 4097)) + (10**9 + 2048) // 2


def brute_pieces(rows):
    tokenizer, out = Tokenizer.from_file(PATH), []
    for i, text in rows:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        out += [(i, k // 4096, k, len(ids[k:k + 4096]), zlib.crc32(ids[k:k + 4096].tobytes())) for k in range(0, len(ids), 4096)]
    return sorted(out, key=repr)


ODD = ["it's we'll I'm", "a\x1cb\x85c d e", "<|endoftext|>x <|startoftext|>", "é ́x", "ΣΑΣ ΟΔΟΣ İI ﬁ ẞ", "tab\tand\r\nline", "   ", "\n\n", "日本語 テキスト", "12345 6.7", "End. End, END., don't. DON'T, a).", "x., y,. .", "é. É, Ñ.,"]


@pytest.fixture(scope="module")
def docs(documents, awkward):
    return documents([(200 + k, t, "en", "a") for k, t in enumerate(ODD)]).unionByName(awkward)


def test_pieces_equal_the_tokenizer_and_fit(docs):
    rows = packing.pack(packing.pieces(docs, PATH, keep_ids=True)).collect()
    wanted = brute_pieces([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert sorted(((r["row"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows), key=repr) == wanted
    assert all(zlib.crc32(bytes(r["ids"])) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"] for r in rows)
    held = defaultdict(list)
    for r in rows:
        held[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in held.values():
        ends = np.cumsum([0] + [n for _, n in sorted(parts)])
        assert [o for o, _ in sorted(parts)] == ends[:-1].tolist() and ends[-1] <= 4096
    assert len(held) == -(-sum(r["length"] for r in rows) // 4096)


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from(list("aAbB.,'s \n\téÉİßΣσς<|>endoftextENDOF1２２ñÄẞĳǅŉ\u0301\u0345\x1c\x85ﬁ\u0958²")), max_size=30))
def test_ids_of_any_text_equal_the_tokenizer(text):
    assert ENCODER.encode([text])[0] == np.array(ENCODER.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def test_a_small_word_memory_changes_nothing(monkeypatch):
    texts = ["one two three one", "two " * 50, "x" * 300 + " one"] * 4
    whole = packing.WordEncoder(PATH).encode(texts)
    monkeypatch.setattr(packing, "CACHE_WORDS", 1)
    encoder = packing.WordEncoder(PATH)
    assert [encoder.encode([t])[0] for t in texts] == whole


def test_empty_table_and_clashing_names(nothing, docs):
    assert packing.pack(packing.pieces(nothing, PATH)).count() == 0
    clash = docs.withColumns({"row": F.lit(1), "piece": F.lit(2), "length": F.lit(3), "block": F.lit(4)})
    assert packing.pack(packing.pieces(clash, PATH)).count() == len(brute_pieces([(r["doc_id"], r["text"]) for r in docs.collect()]))
