import struct
import zlib
from collections import defaultdict

import public_tokenizers
import pytest
from helpers import ODD, documents
from hypothesis import given, settings
from hypothesis import strategies as st
from keyed_lake.llm.packing import Tokens, cut_pieces, pack, sum_of_squares

FILE = public_tokenizers.path("word_bpe_49k.json")
TEXTS = ODD + ["The cat's hat, isn't it? 3.14 <|endoftext|> a\tb\x1cc", "ΣΑΣ İstanbul Ａ ﬁ é “quoted”—dash…", "word " * 5000]


@pytest.fixture(scope="module")
def tokens():
    return Tokens(FILE)


def direct(tokens, text):
    return tokens.tokenizer.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60) | st.text(alphabet="aB's.,%<|> \n\té4", max_size=60))
def test_ids_are_the_tokenizers(text):
    known = test_ids_are_the_tokenizers.__dict__.setdefault("tokens", Tokens(FILE, 200))
    assert list(known.of([text])) == [struct.pack(f"<{len(direct(known, text))}I", *direct(known, text))]


def test_pieces(spark, tokens):
    rows = cut_pieces(documents(spark, TEXTS), "doc_id", "text", FILE, ids=True).collect()
    whole = defaultdict(bytes)
    for r in sorted(rows, key=lambda r: (r.doc_id, r.piece)):
        assert r.start * 4 == len(whole[r.doc_id]) and r.length * 4 == len(r.ids) and r.ids_crc32 == zlib.crc32(r.ids)
        whole[r.doc_id] += bytes(r.ids)
    for i, t in enumerate(TEXTS):
        assert list(struct.unpack(f"<{len(whole[i]) // 4}I", whole[i])) == [*direct(tokens, t), 0]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=80))
def test_sum_of_squares_rule(lengths):
    """Against the rule written out: every choice makes the sum smallest."""
    sequence, offset = sum_of_squares(lengths, 64)
    fill = defaultdict(int)
    for s, k, o in zip(lengths, sequence.tolist(), offset.tolist()):
        counts = defaultdict(int)
        for f in fill.values():
            counts[64 - f] += f < 64

        def total(gap, s=s, counts=counts):
            new = dict(counts)
            if gap < 64:
                new[gap] = new.get(gap, 0) - 1
            if gap - s:
                new[gap - s] = new.get(gap - s, 0) + 1
            return sum(v * v for v in new.values())

        choices = {g: total(g) for g in [64, *(g for g, n in counts.items() if n and g >= s)]}
        assert o == fill[k]
        assert choices[64 - fill[k]] == min(choices.values())
        fill[k] += s
    assert all(f <= 64 for f in fill.values())


def test_packed_sequences(spark):
    texts = TEXTS + [f"some words {i} " * (i % 90) for i in range(400)]
    rows = pack(documents(spark, texts), "doc_id", "text", FILE, capacity=256, group_rows=150).collect()
    places = defaultdict(list)
    for r in rows:
        places[r.sequence_id].append((r.offset, r.length))
    for parts in places.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 256
    assert {r.doc_id for r in rows} == set(range(len(texts)))
    assert len(places) <= 1.1 * sum(r.length for r in rows) / 256 + 1


def test_empty(spark):
    assert pack(documents(spark, ["a"]).where("false"), "doc_id", "text", FILE).count() == 0
