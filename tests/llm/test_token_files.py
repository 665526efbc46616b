import random
import zlib

import numpy as np
import pytest

from shelflens.llm import token_files as K
from shelflens.llm.queries import op4_token_files, tokenizer_file
from shelflens.session import scratch_dir
from tests_llm import SF, frame


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(tokenizer_file())  # the library's defaults


def test_query_round_trip(spark, tokenizer):
    docs = frame(SF, "documents").sort_values("doc_id")
    got, start = {r.doc_id: r for r in op4_token_files(spark, SF).collect()}, 0
    for i, text in zip(docs.doc_id, docs.text):
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_words_are_safe_cuts(tokenizer):
    rng = random.Random(1)
    alphabet = ["a", "b ", " ", "  ", "\n", "\t", "\u00a0", "\u3000", "\x1c", "\u200b", "1", "2", "é", "漢", "'s", "'", "!", "—", "\u0085", "<|endoftext|>"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 30))) for _ in range(1500)]
    texts += [" ".join(rng.choice(["word", "Big,", "é!", "x'", "y's", "1.", "|", "\u01c5.", "a\nb", "#a"]) for _ in range(rng.randint(1, 12))) for _ in range(1500)]
    texts += ["x <|endoftext|> y", "<|endoftext|>", "a<|endoftext|>b c", "<|endoftext|> <|endoftext|>\nz", None, ""]
    rng.shuffle(texts)
    encoder = K._Encoder(tokenizer_file(), "<u2", 7)
    for step in (1, 50, len(texts)):  # new and known units
        for a in range(0, len(texts), step):
            stream, at = encoder.encode(texts[a:a + step])
            for text, i, j in zip(texts[a:a + step], at, at[1:]):
                assert stream[i:j].tolist() == [*tokenizer.encode(text or "", add_special_tokens=False).ids, 7], repr(text)
    assert tokenizer.encode("x <|endoftext|> y", add_special_tokens=False).ids.count(50256) == 1


def test_a_full_cache_starts_anew(tokenizer, monkeypatch):
    monkeypatch.setattr(K, "CACHE", 20)
    encoder = K._Encoder(tokenizer_file(), "<u2")
    for k in range(40):
        text = " ".join(f"word{k}x{j}" for j in range(9))
        assert encoder.encode([text, text])[0].tolist() == 2 * tokenizer.encode(text).ids and len(encoder.known) <= 29


def test_code_lengths_are_optimal_and_limited():
    rng = np.random.default_rng(0)
    for n, limit in ((1, 4), (2, 4), (5, 3), (40, 6), (300, 16), (1000, 10)):
        uses = (rng.pareto(0.6, n) * 3 + 1).astype(np.int64)
        bits = K.code_lengths(uses, limit)
        assert bits.max() <= limit and sum(2.0 ** -bits) <= 1
        codes = K.canonical_codes(bits)
        words = {format(int(c), f"0{b}b") for c, b in zip(codes, bits)}
        assert len(words) == n and (n > 300 or not any(a != b and b.startswith(a) for a in words for b in words))
    # without a binding limit: as short as plain Huffman
    import heapq
    uses = rng.integers(1, 500, 200)
    heap, total = list(map(int, uses)), 0
    heapq.heapify(heap)
    while len(heap) > 1:
        both = heapq.heappop(heap) + heapq.heappop(heap)
        total += both
        heapq.heappush(heap, both)
    assert int((uses * K.code_lengths(uses, 30)).sum()) == total
    assert K.code_lengths(np.arange(1, 40), 4).max() == 6  # 39 ids need 6 bits


def test_block_round_trip():
    rng = np.random.default_rng(2)
    for n in (1, 63, 64, 65, 5000):
        ids = rng.integers(0, 50, n) ** 2 % 47
        used, uses = np.unique(ids, return_counts=True)
        bits = K.code_lengths(uses)
        code_of, bits_of = np.zeros(50, np.uint64), np.zeros(50, np.int64)
        code_of[used], bits_of[used] = K.canonical_codes(bits), bits
        payload, marks = K.encode_block(ids, code_of, bits_of)
        assert len(marks) // 2 == -(-n // K.CHECKPOINT)
        assert (K.decode_block(payload, marks, n, *K._decode_table(used, bits)) == ids).all()


def test_edges(spark, edge, none, edge_rows, tokenizer, monkeypatch):
    monkeypatch.setattr(K, "BLOCK_TOKENS", 200)
    path, tokens = scratch_dir(spark, "t"), K.tokenize(edge, tokenizer_file())
    K.write_token_file(tokens, path, K.vocabulary_size(tokenizer_file()))
    rows = sorted(K.read_token_file(spark, path).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == sorted((r[0] for r in edge_rows), key=lambda i: (i is not None, i))
    assert sorted(bytes(r.ids) for r in rows) == sorted(np.array(tokenizer.encode(r[1] or "", add_special_tokens=False).ids + [0], "<u4").tobytes() for r in edge_rows)
    assert [r.start for r in rows] == np.cumsum([0, *(r.n_tokens for r in rows)])[:-1].tolist()
    assert K.token_digest(none, tokenizer_file()).count() == 0
