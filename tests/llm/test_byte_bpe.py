"""Byte-level BPE against its library, and the trees against each other."""

import base64
import random
from hashlib import sha256

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from forumlens.llm import byte_bpe, queries

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def made():
    return byte_bpe.coder(PATH, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def odd_texts():
    draw = random.Random(1)
    yield from ("", "a" * 5000 + " " * 300 + "\n" * 77, "日本語" * 200, "<|endoftext|>", "-" * 1000, "ab" * 400, "՘a֋ ⃁x 1²½ 𲎰 𑷠", "\r\n \r\n")
    for _ in range(200):
        kinds = ((32, 127), (0x80, 0x3000), (0x10000, 0x33500))
        yield "".join([chr(draw.randrange(*draw.choice(kinds))) for _ in range(60)])
    yield "".join(draw.choice("ab \n'tsx1é日😀") for _ in range(20000))


def test_ids_equal_the_library(made, library):
    texts = list(odd_texts())
    coded = made.encode_all(texts)
    assert [np.frombuffer(c, "<u4").tolist() for c in coded] == [library.encode_ordinary(t) for t in texts]
    assert [made.decode(c) for c in coded] == [t.encode() for t in texts]


def test_blocks_of_a_long_text_and_a_forgetful_worker(made, library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "CHARS", 50)
    monkeypatch.setattr(byte_bpe, "REMEMBERED", 10)
    monkeypatch.setattr(byte_bpe, "TOGETHER", 3)
    texts = [t for t in odd_texts() if len(t) < 3000]
    for at in range(0, len(texts), 7):
        some = texts[at : at + 7]
        assert [np.frombuffer(c, "<u4").tolist() for c in made.encode_all(some)] == [library.encode_ordinary(t) for t in some]


def test_trees_side_by_side_equal_single_trees(made):
    draw = random.Random(2)
    words = [bytes(draw.choices(b" aeinrst", k=draw.randrange(2, 200))) for _ in range(300)]
    together = byte_bpe.merge_together(words, made.ranks)
    assert [np.frombuffer(t, "<u4").tolist() for t in together] == [byte_bpe.merge_long(w, made.ranks) for w in words]


def test_merges_take_the_leftmost_pair_of_least_rank():
    ranks = byte_bpe.Ranks({bytes([b]): b for b in range(256)} | {b"aa": 256, b"aaa": 257, b"ba": 258})
    for word, ids in ((b"aaaa", [256, 256]), (b"aaaaa", [256, 257]), (b"baa", [98, 256]), (b"bab", [258, 98])):
        assert byte_bpe.merge_long(word, ranks) == ids
        assert np.frombuffer(byte_bpe.merge_together([word], ranks)[0], "<u4").tolist() == ids


def test_columns_and_odd_rows(spark, documents, library):
    found = byte_bpe.encode_documents(documents.withColumnsRenamed({"bucket": "Decoded"}), PATH, public_tokenizers.PATTERN)
    assert found.columns == ["doc_id", "text", "shard", "a.b", "token_ids", "decoded"]
    rows = found.collect()
    assert len(rows) == documents.count()
    for row in rows:
        assert row["token_ids"] == library.encode_ordinary(row["text"] or "")
        assert bytes(row["decoded"]) == (row["text"] or "").encode()
    assert byte_bpe.encode_documents(documents.limit(0), PATH, public_tokenizers.PATTERN).count() == 0


def test_query_equals_the_library_on_a_whole_table(spark, library):
    folder = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    found = queries.op13_byte_bpe(spark, folder).collect()
    want = {d: np.array(library.encode_ordinary(t), "<u4").tobytes() for d, t in texts.items()}
    assert len(found) == len(texts)
    for row in found:
        assert tuple(row)[1:] == (len(want[row["doc_id"]]) // 4, sha256(want[row["doc_id"]]).hexdigest(), sha256(texts[row["doc_id"]].encode()).hexdigest())
