"""Sentence-piece encoding and decoding against the library."""

import random

import numpy as np
import pytest

from millwright.llm import pieces

sentencepiece = pytest.importorskip("sentencepiece")
public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def texts():
    r = random.Random(3)
    some = [*"   \n\t▁abcdeéstTh.,:01-'<>ßé日本語한글😀‍\x00\x01�́ǅ", "the", " the", "<unk>", "<s>", "<0x41>", "ing", "    ", " ", "﻿"]
    out = ["".join(r.choice(some) for _ in range(r.randint(0, 60))) for _ in range(1500)]
    out += ["".join(chr(r.choice([r.randrange(0x20, 0x3000), r.randrange(0x10000, 0x20000), r.randrange(97, 123)])) for _ in range(30)) for _ in range(500)]
    out += [None, "", " ", "▁", "  a", "a" * 30_000, " " * 3000, "ab" * 9000, "\n" * 500, "th" * 3001, "x" + " " * 17 + "y"]
    out.append("".join(r.choice("aeiourstln") for _ in range(20_000)))
    out.append(" ".join("".join(r.choice("aeiourstln") for _ in range(7)) for _ in range(150_000)))  # longer than a slice
    return out + out[:20]


def test_ids_and_texts_are_the_library_s(spark, library, texts):
    rows = [(k if k % 50 else None, t, "en", "x", [9]) for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, `KEY` string, decoded string, ids array<int>").repartition(3)
    wanted = [library.encode(t or "") for t in texts]
    expected = [(k if k % 50 else None, w, library.decode(w)) for k, w in enumerate(wanted)]
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    for got in (pieces.decode(pieces.encode(docs, PATH), PATH), pieces.round_trip(docs, PATH)):
        assert sorted([(r["doc_id"], r["ids"], r["decoded"]) for r in got.collect()], key=key) == sorted(expected, key=key)


def test_any_ids_decode_as_in_the_library(library):
    r = random.Random(4)
    decoder = pieces.Decoder(pieces.read_model(PATH))
    runs = [[r.choice([r.randrange(32000), r.randrange(262), r.randrange(3, 259), 0, 1]) for _ in range(r.randint(0, 12))] for _ in range(4000)]
    bounds = np.cumsum([0, *map(len, runs)])
    assert decoder(np.array([i for x in runs for i in x], np.int64), bounds) == [library.decode(x) for x in runs]
    with pytest.raises(ValueError):
        decoder(np.array([32000]), np.array([0, 1]))


def small(scores):
    texts = [f"<0x{b:02X}>" for b in range(256)] + list(scores)
    return pieces.Model(texts, [0.0] * 256 + list(scores.values()), [pieces.BYTE] * 256 + [pieces.NORMAL] * len(scores), False, "?")


def test_longest_first_is_taken_back():
    scores = {"a": -9, "b": -9, "c": -9, "d": -9, "ab": -3, "bc": -1, "abcd": -4, "cd": -2, "bcd": -5}
    model = small(scores)
    encoder = pieces.Encoder(model)
    r = random.Random(0)
    for _ in range(3000):
        text = "".join(r.choice("abcdx") for _ in range(r.randint(1, 14)))
        want = [x for p in encoder.merged(text) for x in ([encoder.ids[p]] if p in encoder.ids else [encoder.byte_ids[b] for b in p.encode()])]
        assert encoder(text) == want


def test_pieces_across_blanks_are_found():
    model = small({"a": -9, " ": -9, "a ": -1, "a a": -2, " a": -3})
    encode, one = pieces.TextEncoder(model), pieces.Encoder(model)
    for text in ("a a a", "aa a  a", " a"):
        data = np.frombuffer(text.encode(), np.uint8)
        ids, _ = encode(data, np.array([0, len(data)]))
        assert ids.tolist() == [one.ids[p] for p in one.merged(text)]


def test_an_empty_table_gives_no_rows(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert pieces.decode(pieces.encode(docs, PATH), PATH).collect() == [] == pieces.round_trip(docs, PATH).collect()
    nothing = spark.createDataFrame([(1, None)], "doc_id long, ids array<int>")
    assert pieces.decode(nothing, PATH).first()["decoded"] == ""
