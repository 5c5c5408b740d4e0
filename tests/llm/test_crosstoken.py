"""Alignment of two tokenizers against nested loops over the libraries' own tokens."""

import hashlib
import random
from collections import Counter

import public_tokenizers as P
import pytest
import sentencepiece
from tokenizers import Tokenizer

from lexforge.llm import crosstoken, queries


@pytest.fixture(scope="module")
def sides():
    a = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))


def letters():
    """{letter: byte} of byte-level vocabularies."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def tokens_of(sides, text):
    """[(id, bytes)] of both sides."""
    a, b = sides
    byte_of = letters()
    left = [(i, bytes(byte_of[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
    right = [(i, bytes([int(b.id_to_piece(i)[1:-1], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()) for i in b.encode(text)]
    return left, right


def plain(sides, rows):
    per_doc = []
    for doc, text in rows:
        left, right = tokens_of(sides, text or "")
        want = (" " + (text or "")).encode()
        if not text or b"".join(t for _, t in left) != want or b"".join(t for _, t in right) != want:
            left, right = [], []
        spans = []
        for side in (left, right):
            at, out = 0, []
            for i, t in side:
                out.append((i, at, at + len(t)))
                at += len(t)
            spans.append(out)
        links = [(i, j) for i, s, e in spans[0] for j, s2, e2 in spans[1] if s < e2 and s2 < e]
        cuts = sorted({e for *_, e in spans[0]} & {e for *_, e in spans[1]})
        groups = ";".join("|".join(",".join(str(i) for i, s, e in side if (cuts[g - 1] if g else 0) < e <= cut) for side in spans) for g, cut in enumerate(cuts))
        per_doc.append((doc, len(spans[0]), len(spans[1]), len(cuts), links, groups))
    count = Counter(p for d in per_doc for p in set(d[4]))
    most = {}
    for (i, _), c in count.items():
        most[i] = max(most.get(i, 0), c)
    return sorted([(d, a, b, g, len(links), groups, sum(count[p] == most[p[0]] for p in links), sum(count[p] for p in links)) for d, a, b, g, links, groups in per_doc], key=str)


def rows_of():
    rnd = random.Random(12)
    alphabets = ["ab ", "the cat sat on mats, don't. ", "éÉüß日本 한국 ", "0123 45", " \n\t", "🙂👍 a", "\u0000▁ x", "​  ́e", "<|endoftext|></s><unk> <0x41>", "\x85\xa0 a²³¼ªº\xad\x1c7", "".join(map(chr, range(256)))]
    rows = [(i, "".join(rnd.choice(a) for _ in range(rnd.randint(1, 60)))) for a in alphabets for i in range(12)]
    rows += [(500, "<|endoftext|> plain <s> text </s><0x0A>"), (501, None), (502, ""), (None, "the cat"), (None, None), (503, "the cat"), (503, "the cat"), (504, " "), (505, "  the"),
             (506, "a▁b"), (507, "ﬁ ½ Å"), (508, "word " * 300), (509, "日" * 50 + "\n\n\n")]
    return rows


def run(spark, rows, parts=4):
    df = spark.createDataFrame([(a, b, 1, 2) for a, b in rows], "doc_id long, text string, n_a int, _key int").repartition(parts)
    out = crosstoken.align(df, queries.BYTE_TOKENIZER, queries.PIECE_MODEL)
    return sorted([(r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.groups, r.n_best, r.count_sum) for r in out.collect()], key=str)


def test_alignment_equals_nested_loops(spark, sides):
    rows = rows_of()
    want = plain(sides, rows)
    assert run(spark, rows) == want
    assert any(w[1] == 0 for w in want if w[0] not in (501, 502)) and sum(w[1] > 0 for w in want) > 80


def test_many_blocks(spark, sides, monkeypatch):
    """A block a slice and a slice a row: counts come together from everywhere and go back everywhere."""
    monkeypatch.setattr(crosstoken, "BLOCK", 0)
    monkeypatch.setattr(crosstoken, "SLICE", 1)
    rows = rows_of()[::2]
    assert run(spark, rows, 2) == plain(sides, rows)


def test_documents(spark, sides):
    docs = [r for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect() if len(r.text) < 1500][:60]
    rows = [(r.doc_id, r.text) for r in docs]
    want = plain(sides, rows)
    assert run(spark, rows) == want
    df = spark.createDataFrame(rows, "doc_id long, text string")
    digests = {r.doc_id: r.groups for r in crosstoken.align(df, queries.BYTE_TOKENIZER, queries.PIECE_MODEL, digest=True).collect()}
    assert digests == {w[0]: hashlib.sha256(w[5].encode()).hexdigest() for w in want}


def test_nothing(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, None), (2, "")]) == [(1, 0, 0, 0, 0, "", 0, 0), (2, 0, 0, 0, 0, "", 0, 0)]
