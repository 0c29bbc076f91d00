import io
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from llm.helpers import rows
from riskloom.llm import packing, token_output, tokens
from riskloom.llm.queries import tokenizer_path
from riskloom.llm.tokens import Encoder

FILES = ("word_bpe_49k.json", "byte_bpe_50k.json")
ODD = [
    "", "a  b", "a \n b", " lead", "trail ", "a\tb", "I'm don't 'sword", "ÅÄ Åb İx ΣΑΣ", "<|endoftext|> a<|endoftext|>b <|startoftext|>", "a\x00b c", "\n\n", "a\nb\n",
    "12 345a b7", "日本 語", "é ́a", "don't. it's, x%%% A.B.", "a\x1cb \x1d", "ﬁne Ⅷ ª º", "a　b  c", "word, Word! WORD;", "x|y |z",
]


@pytest.fixture(scope="module", params=FILES)
def both(request):
    path = tokenizer_path(request.param)
    return Encoder(path), Tokenizer.from_file(path)


def same(encoder, library, texts):
    ids, counts = encoder.encode(texts)
    got = [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] if texts else []
    return got == [e.ids for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_ids_are_the_library_s(both, spark, small):
    texts = [r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    assert both[0].kind in ("leading", "dropping")
    assert same(*both, ODD + texts + [None])
    assert same(*both, texts + ODD)  # from the cache


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="abZ é'.,!|%09\n \t ſΣ", max_size=25), min_size=1, max_size=4))
def test_ids_of_random_texts(texts):
    for name in FILES:
        path = tokenizer_path(name)
        if path not in CACHE:
            CACHE[path] = (Encoder(path), Tokenizer.from_file(path))
        assert same(*CACHE[path], texts)


CACHE = {}


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(0, 3), min_size=1, max_size=60), min_size=1, max_size=8))
def test_grammar_round_trip(docs):
    ids = np.asarray([x for d in docs for x in d], dtype=np.uint32)
    first = np.r_[0, np.cumsum([len(d) for d in docs])]
    symbols, at, rules = token_output.compress(ids, first, 4, at_once=2, least=2)
    assert token_output.expand(symbols, rules, 4).tolist() == ids.tolist()
    for d, a, b in zip(docs, at, at[1:]):
        assert token_output.expand(symbols[a:b], rules, 4).tolist() == d


def test_file_round_trip_and_spans():
    rng = np.random.default_rng(2)
    docs = [rng.integers(0, 9, n) for n in (1, 400, 7, 3000)]
    data = token_output.to_bytes([None, 5, 6, 9], np.asarray([len(d) for d in docs]), np.concatenate(docs).astype(np.uint32), 50_257)
    shard = token_output.Shard(pa.PythonFile(io.BytesIO(data), mode="r"))
    assert shard.doc_ids == [None, 5, 6, 9] and len(shard.rules) and shard.n_symbols < 0.6 * 3408
    assert shard.ids(1, 3).tolist() == [*docs[1].tolist(), *docs[2].tolist()]
    for start, n in ((0, 1), (17, 30), (2990, 10), (0, 3000), (5, 0)):
        assert shard.span(3, start, n).tolist() == docs[3][start : start + n].tolist()


def test_wide_symbols():
    ids = np.asarray([70_000, 70_001] * 50, dtype=np.uint32)
    data = token_output.to_bytes([1], np.asarray([100]), ids, 80_000)
    shard = token_output.Shard(pa.PythonFile(io.BytesIO(data), mode="r"))
    assert shard.width == 4 and shard.ids(0, 1).tolist() == ids.tolist()


def encoded(library, text, end):
    return np.asarray([*library.encode(text or "", add_special_tokens=False).ids, end], dtype="<u4")


def test_token_output(spark, documents):
    path = tokenizer_path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    docs = [(9, "Some text, some text"), (3, ""), (4, None), (7, "same"), (7, "same"), (8, "word " * 30_000), (1, " odd  space\n"), (-5, "é")]
    shards, folder = token_output.write_shards(documents(*docs, (None, "no id")), path)
    got = [tuple(r) for r in token_output.read_back(shards, folder).collect()]
    start, expected = 0, []
    for d, t in [(None, "no id"), *sorted(docs, key=lambda r: r[0])]:
        ids = encoded(library, t, 0)
        expected.append((d, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(got, key=lambda r: r[1]) == expected
    empty, folder = token_output.write_shards(documents((1, "a")).limit(0), path)
    assert token_output.read_back(empty, folder).collect() == []


def test_packing(spark, documents):
    path = tokenizer_path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    docs = [(i, "word " * (i % 37)) for i in range(300)] + [(1000, None), (1001, ""), (1002, "a b c " * 5000), (1003, "same"), (1003, "same")]
    got = packing.pack(documents(*docs, (None, "no id")), path).collect()
    sequences, pieces = defaultdict(list), defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id].append((r.start, r.length, r.ids_crc32, r.doc_tokens))
    for parts in sequences.values():
        parts.sort()
        assert [o for o, _ in parts] == np.r_[0, np.cumsum([n for _, n in parts])][:-1].tolist() and sum(n for _, n in parts) <= 4096
    texts = defaultdict(list)
    for d, t in [*docs, (None, "no id")]:
        texts[d].append(encoded(library, t, 2))
    for d, full in texts.items():
        expected = [(a, min(4096, len(x) - a), zlib.crc32(x[a : a + 4096].tobytes()), len(x)) for x in full for a in range(0, len(x), 4096)]
        assert sorted(pieces[d]) == sorted(expected)
    assert len(sequences) <= 1 + sum(r.length for r in got) // 4000
    assert packing.pack(documents((1, "a")).limit(0), path).collect() == []


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 50), st.integers(1, 40), max_size=12))
def test_shortest_pack_first_places_every_piece(histogram):
    patterns = packing.shortest_pack_first(histogram, 50)
    placed = defaultdict(int)
    for count, lengths in patterns:
        assert sum(lengths) <= 50
        for n in lengths:
            placed[n] += count
    assert placed == histogram
    slots = packing.Slots(patterns)
    seen = set()
    for n, count in histogram.items():
        sequence, offset = slots.place(np.full(count, n), np.arange(count))
        for s, o in zip(sequence.tolist(), offset.tolist()):
            cells = {(s, o + i) for i in range(n)}
            assert not cells & seen
            seen |= cells


def test_packing_small_table_is_tight(spark, small):
    got = packing.pack(spark.read.parquet(f"{small}/documents.parquet"), tokenizer_path("word_bpe_49k.json")).collect()
    assert sum(r.length for r in got) > 0.97 * 4096 * len({r.sequence_id for r in got})


def test_a_full_cache_keeps_the_words_met_again(both, monkeypatch):
    """the ids stay the library's while the cache fills up, and common words aren't learned anew."""
    monkeypatch.setattr(tokens, "CACHE_WORDS", 60)
    encoder, library = Encoder(tokenizer_path(FILES[both[0].kind == "leading"])), both[1]
    learned, learn = [], encoder._encode_letters
    monkeypatch.setattr(encoder, "_encode_letters", lambda heads: learned.extend(heads) or learn(heads))
    letters = "abcdefghijklmnop"
    for i in range(40):
        rare = [f"{letters[i % 16]}{letters[i // 16]}{letters[j]}x" for j in range(16)]
        assert same(encoder, library, ["start the common words, of all texts.", " ".join(rare), ""])
        assert len(encoder.keys) <= 60 + 40
    assert learned.count(b" common") + learned.count(b"common") == 1


def test_texts_of_unusual_white_space_are_encoded_whole():
    """one pass over the batch tells them as splitting each text did."""
    encoder = Encoder(tokenizer_path("byte_bpe_50k.json"))
    texts = ODD + [x for c in map(chr, [*range(0x250), 0x1680, *range(0x1FFF, 0x2070), 0x3000, 0xFEFF]) for x in (f"a{c}b", f"{c}a", f"a{c}", c)]
    assert encoder._by_words(texts).tolist() == [" ".join(t.split()) == t.replace("\n", " ") for t in texts]
