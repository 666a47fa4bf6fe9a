"""Alignment of two tokenizers against plain Python over the libraries' own tokens."""

import random
from collections import Counter
from hashlib import sha256

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tokenizers

from forumlens.llm import alignment, queries
from forumlens.llm.bpe_automaton import byte_symbols

PATHS = [public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
COLUMNS = alignment.NEW


@pytest.fixture(scope="module")
def libraries():
    a = tokenizers.Tokenizer.from_file(PATHS[0])
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=PATHS[1])


def tokens_of(text, libraries):
    """[(id, bytes)] of both, or nothing."""
    if not text:
        return [], []
    a, b = libraries
    byte_of = {s: i for i, s in enumerate(byte_symbols())}
    of_a = [(i, bytes(byte_of[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
    of_b = []
    for i in b.encode(text):
        piece = b.id_to_piece(i)
        of_b.append((i, bytes([int(piece[1:-1], 16)]) if piece.startswith("<0x") and len(piece) == 6 else piece.replace("▁", " ").encode()))
    whole = (" " + text).encode()
    if any(b"".join(t for _, t in x) != whole for x in (of_a, of_b)):
        return [], []
    return of_a, of_b


def groups_of(of_a, of_b):
    """The groups, from the sets of ends."""
    ends = [np.cumsum([len(t) for _, t in x]).tolist() for x in (of_a, of_b)]
    common = sorted(set(ends[0]) & set(ends[1]))
    parts = [[[i for (i, _), e in zip(x, own) if low < e <= high] for x, own in zip((of_a, of_b), ends)] for low, high in zip([0, *common], common)]
    return parts


def plain(texts, libraries):
    """The contract's numbers of each text."""
    found = []
    for text in texts:
        of_a, of_b = tokens_of(text, libraries)
        groups = groups_of(of_a, of_b) if len(of_a) < 400 else fast_groups(of_a, of_b)
        links = Counter((x, y) for ga, gb in groups for x in ga for y in gb)
        found.append((len(of_a), len(of_b), groups, links))
    held = Counter(pair for *_, links in found for pair in links)
    most = Counter()
    for (x, _), n in held.items():
        most[x] = max(most[x], n)
    rows = []
    for n_a, n_b, groups, links in found:
        line = ";".join("|".join(",".join(map(str, ids)) for ids in g) for g in groups)
        best = sum(n for (x, y), n in links.items() if held[x, y] == most[x])
        total = sum(n * held[pair] for pair, n in links.items())
        rows.append((n_a, n_b, len(groups), sum(links.values()), best, total, sha256(line.encode()).hexdigest() if n_a else ""))
    return rows


def fast_groups(of_a, of_b):
    groups, at, to, end_a, end_b, j = [], [], [], 0, 0, 0
    for i, t in of_a:
        at.append(i)
        end_a += len(t)
        while end_b < end_a:
            to.append(of_b[j][0])
            end_b += len(of_b[j][1])
            j += 1
        if end_a == end_b:
            groups.append((at, to))
            at, to = [], []
    return groups


def odd_texts():
    draw = random.Random(4)
    yield from (None, "", " ", "a", "  two  spaces", "a▁b", "<s> </s> <unk> <|endoftext|> <0x41>", "日本語のテキスト", "é" * 300, "\n\n\t x", "-" * 999, "𲎰࢏՘ ሀ", "ab" * 4000)
    yield " ".join(f"word{draw.randrange(900)}" for _ in range(3000))
    for _ in range(60):
        kinds = ((32, 127), (0x80, 0x600), (0x3000, 0x3100), (0x1F600, 0x1F640))
        yield "".join([chr(draw.randrange(*draw.choice(kinds))) for _ in range(40)])


def test_cut_groups_equal_common_ends():
    draw = random.Random(6)
    for k in range(400):
        n = draw.randrange(1, 300)
        dense = draw.choice((0.2, 0.9, 0.99))
        ends = [np.array(sorted({e for e in range(1, n) if draw.random() < dense} | {n})) for _ in range(2)]
        if k % 3 == 0:
            ends[1] = np.union1d(ends[0], ends[1][: draw.randrange(1, 4)])
        common = np.intersect1d(*ends)
        for own, last in zip(ends, alignment.cut_groups(*ends)):
            assert last.tolist() == np.isin(own, common).tolist()


def test_a_long_stretch_goes_on_after_a_shift():
    ends = np.arange(1, 2_000_001)
    shifted = np.delete(ends, 777)
    last_a, last_b = alignment.cut_groups(ends, shifted)
    assert (~last_a).sum() == 1 and last_b.all() and not last_a[777]


@pytest.mark.parametrize("large", [False, True])
def test_texts_equal_plain_python(spark, libraries, monkeypatch, large):
    made = alignment.aligner(*PATHS, public_tokenizers.PATTERN)
    monkeypatch.setattr(alignment, "MANY_LINKS", 3 if large else 4096)
    texts = list(odd_texts())
    counts, hashes, keys, times = made.align([t or "" for t in texts])
    want = plain(texts, libraries)
    assert [(*c, h) for c, h in zip(counts.tolist(), hashes)] == [(*w[:4], w[6]) for w in want]
    assert np.bincount(keys >> 40, weights=times, minlength=len(texts)).tolist() == [w[3] for w in want]
    assert (np.diff(keys) > 0).all()


@pytest.mark.parametrize("block_bytes", [200, 1 << 20])
def test_whole_result_equals_plain_python(spark, libraries, block_bytes):
    texts = [*odd_texts(), "a", "  two  spaces"]
    df = spark.createDataFrame([(k, t, k % 7, "x") for k, t in enumerate(texts)], "doc_id long, text string, N_A int, `a.b` string").repartition(3)
    found = alignment.align_documents(df, *PATHS, public_tokenizers.PATTERN, block_bytes)
    assert found.columns == ["doc_id", "text", "a.b", *COLUMNS]
    got = {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in found.collect()}
    assert got == dict(enumerate(plain(texts, libraries)))
    assert alignment.align_documents(df.limit(0), *PATHS, public_tokenizers.PATTERN).count() == 0


def test_both_byte_level_libraries_agree_below_the_mark(libraries):
    made = alignment.aligner(*PATHS, public_tokenizers.PATTERN).a
    assert made.quick is not None
    for code in range(1, 0x530):
        for text in (f" a{chr(code)}1", f" 1{chr(code)}a", f" .{chr(code)}. {chr(code)}x"):
            assert made.quick.encode_ordinary(text) == libraries[0].encode(text, add_special_tokens=False).ids


def test_query_equals_plain_python_on_a_whole_table(spark, libraries):
    folder = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    found = {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in queries.op11_alignment(spark, folder).collect()}
    assert found == dict(zip([r[0] for r in rows], plain([r[1] for r in rows], libraries)))
