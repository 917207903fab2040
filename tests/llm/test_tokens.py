import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tidemark.llm.packing import binary_lengths, encoder, pack
from tidemark.llm.token_counts import count_long, count_tokens, load

MODEL = public_tokenizers.path("piece_bpe_32k.model")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
BITS = [" ", "  ", "   ", "a", "b", "\n", "▁", "你", "𝒳", "xyz", "é", "\t", "<s>", " .", " ", "\x1c", "　", "<|endoftext|>", "'s", "12", " w", ".", "a,", "é!", "ª?", "Ⅷ.", "\0"]


def odd_texts(count):
    rng = random.Random(3)
    return ["".join(rng.choices(BITS, k=rng.randint(0, 80))) for _ in range(count)]


def test_spliced_counts_are_those_of_the_whole():
    model, sizes, splits = load(MODEL)
    assert splits
    for text in [*odd_texts(2000), "x" * 500, " " * 500, "ab " * 300, "é" * 300 + " a"]:
        assert count_long(model, sizes, text, 16, 8) == len(model.encode(text)), text


def test_counts(odd, odd_rows):
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    got = sorted((tuple(r) for r in count_tokens(odd, MODEL, limit=100, chunk=64).collect()), key=repr)
    want = []
    for i, text in odd_rows:
        tokens = len(model.encode(text or ""))
        want.append((i, len((text or "").encode()), tokens, tokens > 100))
    assert got == sorted(want, key=repr)


def test_remembered_words_give_the_ids_of_whole_texts():
    tokenizer = Tokenizer.from_file(BYTES)
    texts = odd_texts(3000)
    for text, data in zip(texts, encoder(BYTES)(texts)):
        assert np.frombuffer(data, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text


@pytest.mark.parametrize("tokens", [1, 2, 1023, 1024, 1025, 5000])
def test_lengths(tokens):
    lengths = binary_lengths(tokens, 1024)
    assert sum(lengths) == tokens and all(n & (n - 1) == 0 and n <= 1024 for n in lengths)
    assert len(lengths) <= tokens // 1024 + 10


def test_packing(odd, odd_rows):
    tokenizer = Tokenizer.from_file(BYTES)
    rows = pack(odd, BYTES, longest=64, with_ids=True).collect()
    assert len({r.sequence_id for r in rows}) == len(rows) and all(r.offset == 0 for r in rows)
    pieces = defaultdict(list)
    for r in rows:
        assert r.length == len(r.ids) and r.length & (r.length - 1) == 0 and r.length <= 64
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        pieces[r.doc_id, r.doc_tokens].append((r.start, r.ids))
    want = defaultdict(list)
    for i, text in odd_rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        want[i, len(ids)].append(ids)
    for key, texts in want.items():
        # Repeated ids of equal length come as often as they are given.
        got = sorted(pieces.pop(key))
        if len(texts) == 1:
            assert [x for _, ids in got for x in ids] == texts[0]
        assert sum(len(ids) for _, ids in got) == sum(map(len, texts))
    assert not pieces


def test_no_rows(empty):
    assert count_tokens(empty, MODEL).collect() == []
    assert pack(empty, BYTES).collect() == []


def test_ids_of_another_tokenizer(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    texts = [*odd_texts(200), "Plain words, with Capitals. And more.", "two\nlines of text"]
    rows = pack(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), path, longest=64, with_ids=True).collect()
    got = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r.doc_id, r.start)):
        got[r.doc_id] += r.ids
    assert got == {i: [*tokenizer.encode(t, add_special_tokens=False).ids, 0] for i, t in enumerate(texts)}


def test_only_the_known_way_to_cut_is_taken():
    assert encoder(BYTES).by_parts and not encoder(public_tokenizers.path("word_bpe_49k.json")).by_parts
