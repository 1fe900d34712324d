import random
import zlib

import numpy as np
import pytest
from corpus_cases import clashing, frame, rows

from barloom.llm import token_files as tf
from barloom.llm.queries import tokenizer_path

PATH = tokenizer_path()


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


@pytest.mark.parametrize("top", [1, 255, 256, 70_000, 2**32 - 1])
def test_segments_round_trip(top):
    rng = np.random.default_rng(top)
    ids = (rng.integers(0, top + 1, 3000) >> rng.integers(0, 24, 3000)).astype(np.uint32)
    segment = tf.Segment(tf.pack(ids, np.array([0, 10, 3000])))
    assert (segment.ids() == ids).all() and segment.ends.tolist() == [0, 10, 3000]
    assert [segment.token_at(i) for i in range(3000)] == ids.tolist()
    with pytest.raises(IndexError):
        segment.token_at(3000)


def test_an_empty_segment():
    assert len(tf.Segment(tf.pack(np.empty(0, np.uint32), np.array([0]))).ids()) == 0


ALPHABET = "aAsStTéÉß×÷!,.'’ \t\n\r\x0b\x0c\x1c\x85\xa0ΣσςİıK<|>😀10½ﬁ‍가"


def test_pieces_give_the_ids_of_whole_texts(tokenizer):
    rng, encoder = random.Random(1), tf.ChunkEncoder(PATH, most=500)
    for _ in range(1500):
        text = "".join(rng.choice(ALPHABET) for _ in range(rng.randrange(40)))
        text += rng.choice(["", "", "<|endoftext|>", "<|EndOfText|>", "<|startoftext|>a"])
        assert encoder.encode([text])[0].tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_other_tokenizers_are_asked_for_whole_texts():
    from tokenizers import Tokenizer

    path = tokenizer_path("byte_bpe_50k.json")
    text = "Hello  wörld, it's\n\n 1234"
    assert tf.ChunkEncoder(path).encode([text, None])[0].tolist() == Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids


def read_back(spark, workspace, df, **options):
    path = workspace.path("tokens")
    tf.write_tokens(df, path, PATH, **options)
    return tf.read_segments(spark, path), tf.read_documents(tf.read_segments(spark, path)).collect()


def expected(tokenizer, data):
    """(doc_id, n, crc) of each row; and all that may start where."""
    out = []
    for r in data:
        ids = np.array([*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 1], "<u4")
        out.append((r[0], len(ids), zlib.crc32(ids.tobytes())))
    return out


def test_files_of_odd_rows(spark, workspace, tokenizer):
    df = clashing(frame(spark), "part", "seq", "data", "tokens", "start")
    segments, found = read_back(spark, workspace, df, part_bytes=40_000, segment_tokens=2_000)
    assert segments.count() > 10
    key = lambda t: (t[0] is not None, t)
    assert sorted([(r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in found], key=key) == sorted(expected(tokenizer, rows()), key=key)
    at = 0
    for r in sorted(found, key=lambda r: r["start"]):
        assert r["start"] == at
        at += r["n_tokens"]
    ids = [r["doc_id"] for r in sorted(found, key=lambda r: r["start"])]
    assert ids[0] is None and ids[1:] == sorted(ids[1:])


def test_nothing_gives_nothing(spark, workspace):
    assert read_back(spark, workspace, frame(spark, []))[1] == []


def test_query(spark, sf_dir, tokenizer):
    from barloom.llm.queries import QUERIES

    data = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect())
    found = sorted(QUERIES["op4_token_files"](spark, sf_dir).collect())
    want, at = expected(tokenizer, data), 0
    for r, (doc, n, crc) in zip(found, want, strict=True):
        assert (r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) == (doc, at, n, crc)
        at += n
