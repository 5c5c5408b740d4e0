"""Token operators against the public libraries: merge replay, packing."""

import base64
import hashlib
import random
import string
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from tokenizers import Tokenizer

from lexforge.llm import bpe, packing, queries, tokens

ALPHABETS = ["ab", "a", "aA! \n", "ab's don't ", "éÉüß日本 한", string.printable, "0123456789 ", "\u0000 \t x\x1c\x85", "İıſKΣσς a", "üé ,."]


def texts(n=150, length=60):
    rnd = random.Random(4)
    made = ["".join(rnd.choice(a) for _ in range(rnd.randint(0, length))) for a in ALPHABETS for _ in range(n)]
    return [*made, "", "<|endoftext|> x", "a<|startoftext|>b <|ENDOFTEXT|>, endoftext|> <|endoftext|", "x<|endoftext|>.<|endoftext|>", "wort" * 5000,
            "end" + "." * 9 + " ?!?!?!?! a-- b--- it's 'quoted' x's. c\u0301d. a\u0000b. \u0000", "The the THE, the. the!"]


def tiktoken_encoding():
    with open(queries.BYTE_RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_replay_equals_the_library():
    encoder, library = bpe.Encoder(bpe.load_merges(queries.BYTE_RANKS), P.PATTERN), tiktoken_encoding()
    given = texts()
    ids, offsets = encoder.encode(given)
    for i, text in enumerate(given):
        assert ids[offsets[i]:offsets[i + 1]].tolist() == library.encode_ordinary(text), text


def test_replay_of_ranks_out_of_order():
    """A merge may give a pair of lower rank; the lowest rank goes first even then."""
    tokens_of = [bytes([b]) for b in range(256)]
    ranks = {t: 1000 + i for i, t in enumerate(tokens_of)}
    ranks |= {b"ab": 5, b"abc": 1, b"bc": 3, b"cc": 2, b"aa": 7, b"aaa": 6}
    merges = bpe.Merges(ranks)
    library = tiktoken.Encoding("own", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})
    rnd = random.Random(2)
    for _ in range(300):
        word = "".join(rnd.choice("abc") for _ in range(rnd.randint(1, 12)))
        ids, _ = bpe.replay(merges, [word.encode()])
        assert ids.tolist() == library.encode_ordinary(word), word


def test_bpe_query_columns(spark):
    library = tiktoken_encoding()
    given = [(i, t) for i, t in enumerate(texts(3))] + [(None, "a b"), (7, None), (7, None)]
    df = spark.createDataFrame([(a, b, "x") for a, b in given], "doc_id long, text string, ids string").repartition(3)
    out = bpe.bpe_digests(bpe.decode(bpe.encode(df, queries.BYTE_RANKS, P.PATTERN), queries.BYTE_RANKS)).collect()
    want = []
    for key, text in given:
        ids = library.encode_ordinary(text or "")
        want.append((key, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert sorted(map(tuple, out), key=str) == sorted(want, key=str)
    assert bpe.encode(df.limit(0), queries.BYTE_RANKS, P.PATTERN).count() == 0


@pytest.fixture(scope="module")
def library():
    # as the file has it: no switch of the operator's is repeated here
    return Tokenizer.from_file(queries.WORD_TOKENIZER)


def test_pieces_equal_the_library(library):
    encoder = tokens.PieceEncoder(queries.WORD_TOKENIZER)
    given = texts()
    ids, offsets = encoder.encode(given)
    for i, (text, own) in enumerate(zip(given, library.encode_batch(given, add_special_tokens=False))):
        assert ids[offsets[i]:offsets[i + 1]].tolist() == own.ids, text


def test_special_tokens_may_be_plain_text():
    """With the switch off, their strings are cut like any other text."""
    plain = Tokenizer.from_file(queries.WORD_TOKENIZER)
    given = ["<|endoftext|> a<|startoftext|>b", "a <|endoftext|>"]
    special = [Tokenizer.from_file(queries.WORD_TOKENIZER).encode(t, add_special_tokens=False).ids for t in given]
    assert 49407 in special[0] and 49406 in special[0]
    plain.encode_special_tokens = True
    ids, offsets = tokens.PieceEncoder(queries.WORD_TOKENIZER, special=False).encode(given)
    for i, text in enumerate(given):
        assert ids[offsets[i]:offsets[i + 1]].tolist() == plain.encode(text, add_special_tokens=False).ids != special[i]


def check_pieces(rows, given, library, sequence):
    want = {}
    for key, text in given:
        want.setdefault(key, []).append([*library.encode(text or "", add_special_tokens=False).ids, 2])
    stream = {}
    for r in rows:
        assert len(r.ids) == 4 * r.length and 0 < r.length and r.offset + r.length <= sequence
        assert (r.sequence_id, r.offset) not in stream
        stream[r.sequence_id, r.offset] = r
    at, whole, docs, current = 0, [], [], None
    for (number, offset), r in sorted(stream.items()):
        assert number * sequence + offset == at  # no gap and no overlap in the whole stream
        at += r.length
        values = np.frombuffer(r.ids, "<u4").tolist()
        if r.start == 0:
            current = [r.doc_id, r.doc_tokens, []]
            docs.append(current)
        assert current[0] == r.doc_id and len(current[2]) == r.start
        current[2] += values
        whole += values
    assert all(n == len(ids) for _, n, ids in docs)
    got = {}
    for key, _, ids in docs:
        got.setdefault(key, []).append(ids)
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    return whole


@pytest.mark.parametrize("sequence", [16, 4096])
def test_packing(spark, library, sequence):
    given = [(i, t) for i, t in enumerate(texts(10))] + [(None, "null id"), (3, "again"), (3, "again"), (5, None)]
    df = spark.createDataFrame([(a, b, 1) for a, b in given], "doc_id long, text string, _ids int").repartition(5)
    pieces = packing.pack(df, queries.WORD_TOKENIZER, sequence=sequence)
    whole = check_pieces(pieces.collect(), given, library, sequence)
    digests = packing.piece_digests(pieces).collect()
    assert {(r.sequence_id, r.offset): r.ids_crc32 for r in digests} == {(r.sequence_id, r.offset): zlib.crc32(r.ids) for r in pieces.collect()}
    sequences = {r.sequence_id: np.frombuffer(r.ids, "<u4").tolist() for r in packing.packed_sequences(pieces).collect()}
    assert sum((sequences[i] for i in range(len(sequences))), []) == whole
    assert all(len(sequences[i]) == sequence for i in range(len(sequences) - 1))


def test_packing_of_nothing(spark):
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string"), queries.WORD_TOKENIZER).collect() == []


def test_packing_of_documents(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    check_pieces(packing.pack(docs, queries.WORD_TOKENIZER).collect(), [(r.doc_id, r.text) for r in docs.collect()], library, 4096)
