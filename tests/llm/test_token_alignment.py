import hashlib
import random
from collections import Counter

import pytest

from shelflens.llm import token_alignment as L
from shelflens.llm.queries import op13_token_alignment, piece_file, tokenizer_file
from tests_llm import SF, frame


class Brute:
    """Everything from ids and decoded bytes, one byte at a time."""

    def __init__(self):
        import sentencepiece
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(tokenizer_file())
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_file())
        keep = list(range(ord("!"), ord("~") + 1)) + list(range(0xA1, 0xAD)) + list(range(0xAE, 0x100))
        self.chars, extra = {}, 0
        for byte in range(256):
            if byte in keep:
                self.chars[chr(byte)] = byte
            else:
                self.chars[chr(256 + extra)] = byte
                extra += 1

    def tokens(self, text):
        if not text:
            return None
        a = [(i, bytes(self.chars[c] for c in self.a.id_to_token(i))) for i in self.a.encode(" " + text, add_special_tokens=False).ids]
        b = []
        for i in self.b.encode(text):
            p = self.b.id_to_piece(i)
            b.append((i, bytes([int(p[3:5], 16)]) if len(p) == 6 and p[:3] == "<0x" else p.replace("▁", " ").encode()))
        raw = (" " + text).encode()
        return (a, b) if b"".join(x for _, x in a) == raw and b"".join(x for _, x in b) == raw else None

    def one(self, text):
        got = self.tokens(text)
        if got is None:
            return (0, 0, 0, 0, ""), []
        ends = [[], []]
        owner = [[], []]
        for side, tokens in enumerate(got):
            for k, (_, raw) in enumerate(tokens):
                owner[side] += [k] * len(raw)
                ends[side].append(len(owner[side]))
        links = sorted(set(zip(*owner)))
        cuts = sorted(set(ends[0]) & set(ends[1]))
        groups, at = [], [0, 0]
        for cut in cuts:
            sides = []
            for side in (0, 1):
                start = at[side]
                while at[side] < len(ends[side]) and ends[side][at[side]] <= cut:
                    at[side] += 1
                sides.append(",".join(str(t[0]) for t in got[side][start:at[side]]))
            groups.append("|".join(sides))
        sha = hashlib.sha256(";".join(groups).encode()).hexdigest()
        return (len(got[0]), len(got[1]), len(cuts), len(links), sha), [(got[0][x][0], got[1][y][0]) for x, y in links]

    def all(self, texts):
        each = [self.one(t) for t in texts]
        count = Counter(p for _, links in each for p in set(links))
        best = {}
        for (a, _), n in count.items():
            best[a] = max(best.get(a, 0), n)
        return [(*f[:4], sum(count[p] == best[p[0]] for p in links), sum(count[p] for p in links), f[4]) for f, links in each]


@pytest.fixture(scope="module")
def brute():
    return Brute()


def rows_of(df):
    return [(r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in df.collect()]


def hard_texts():
    rng = random.Random(6)
    alphabet = ["a", "tion", "b ", " ", "  ", "\n", "\n\n", "\t", " ", "　", "\x1c", "​", "1", "2024", "é", "漢", "字", "😀", "👩‍👧", "'s", "!",
                "—", "\u0085", "<|endoftext|>", "<s>", "</s>", "<unk>", "<0x0A>", "▁", "\x00", "ﬁ", "é", "﻿", "ǅ", "𝒳"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 25))) for _ in range(1200)]
    words = ["word", "Big,", "é!", "x'", "y's", "1.", "|", "漢字", "😀ok", "#a", "<s>", "<|endoftext|>", "naïve", "\x00", "​", "ﬁn", "123456"]
    return texts + ["".join(rng.choice(words) + rng.choice(" \n") for _ in range(rng.randint(1, 12)))[:-1] for _ in range(1200)]


def test_texts_of_all_kinds(brute):
    texts = hard_texts()
    aligner = L.Aligner(tokenizer_file(), piece_file())
    rows = aligner.documents(texts)[0]
    for text, row in zip(texts, rows):
        assert row == brute.one(text)[0], repr(text)
    assert len(aligner.known) > 100 and any(r[0] == 0 for r in rows)


def test_query_against_brute_force(spark, brute):
    docs = frame(SF, "documents")
    want = [(int(i), *x) for i, x in zip(docs.doc_id, brute.all(docs.text))]
    assert sorted(rows_of(op13_token_alignment(spark, SF))) == sorted(want)


def test_edges_in_small_chunks(spark, edge, none, edge_rows, brute, monkeypatch):
    monkeypatch.setattr(L, "CHUNK_CHARS", 2000)
    extra = [(100 + k, t) for k, t in enumerate(hard_texts()[1100:1300])]
    rows = [(r[0], r[1]) for r in edge_rows] + extra
    df = edge.select("doc_id", "text", "score", "a.b".join("``")).unionByName(
        spark.createDataFrame(extra, "doc_id long, text string"), allowMissingColumns=True)
    got = rows_of(L.align_documents(df, tokenizer_file(), piece_file()))
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(got, key=key) == sorted(((i, *x) for (i, _), x in zip(rows, brute.all([t for _, t in rows]))), key=key)
    assert L.align_documents(none, tokenizer_file(), piece_file()).count() == 0
