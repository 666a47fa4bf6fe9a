import re
from itertools import combinations

import duckdb
import public_tokenizers
import pytest
import tokenizers
import xxhash

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from forumlens.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


def test_registered():
    assert set(QUERIES) | {"pipeline"} <= set(queries())
    assert [name for name in QUERIES] == sorted(QUERIES, key=lambda n: int(n[2:].split("_")[0])) and len(QUERIES) == 13


@pytest.mark.parametrize("name", [n for n in QUERIES if n in oracle_sql()])
def test_query_equals_sql(spark, name):
    db = duckdb.connect()
    for table in ("documents", "pages", "embeddings", "benchmark"):
        db.execute(f"create view {table} as select * from '{FOLDER}/{table}.parquet'")
    got, want = queries()[name](spark, FOLDER), db.sql(oracle_sql()[name])
    assert sorted(got.columns) == sorted(want.columns)
    order = sorted(got.columns)
    mine = sorted(str(tuple(r[c] for c in order)) for r in got.collect())
    place = [want.columns.index(c) for c in order]
    assert mine == sorted(str(tuple(r[i] for i in place)) for r in want.fetchall())


def test_stages(spark, documents, tmp_path):
    for table, schema in (("labels", "doc_id long, quality int, toxic int"), ("benchmark", "item_id long, text string")):
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{table}.parquet")
    for name, stage in corpus_pipeline.STAGES:
        for docs in (documents, documents.limit(0)):
            out = stage(spark, docs, str(tmp_path))
            assert out.columns[: len(docs.columns)] == docs.columns
            assert out.count() == (0 if docs is not documents else 6 if name == "near duplicates" else 9)
            assert name == "tokens" or out.columns == docs.columns


def test_whole_run(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    out = corpus_pipeline.run(spark, FOLDER)
    assert 0 < out.count() <= docs.count() and out.columns == [*docs.columns, "token_ids", "decoded"]
    assert out.select("doc_id").distinct().count() == out.count()


def plain_print(text):
    """The fingerprint by the contract's words."""
    words = [w for w in re.split("[ \t\n\v\f\r]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    parts = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_near_duplicates_equal_all_pairs(spark):
    """The second stage on a whole table, and on it twice over."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    prints = [plain_print(r["text"]) for r in rows]
    label = {r["doc_id"]: r["doc_id"] for r in rows}
    for (a, x), (b, y) in combinations(zip([r["doc_id"] for r in rows], prints), 2):
        if (x ^ y).bit_count() <= 4 and label[a] != label[b]:
            low, high = sorted((label[a], label[b]))
            label = {d: low if at == high else at for d, at in label.items()}
    want = sorted(set(label.values()))
    assert len(want) < len(rows)
    for given in (docs, docs.union(docs)):
        kept = corpus_pipeline.remove_near_duplicates(spark, given, "")
        assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == want


NAMES = ["n_words", "is_toxic", "n_bytes", "Hits", "N_Removed", "p_toxic", "words", "kept", "block", "print", "component_id", "row", "to", "items", "contaminated", "a.b", "kept3", "label"]


def test_clashing_columns_stay(spark, tmp_path):
    """Names that operators use inside, each with values of its own, through every stage."""
    toxic = ["scum and trash you worthless moron"] * 12
    clean = [f"a quiet walk number{i} along the river bank with friends" for i in range(30)]
    item = "one two three four five six seven eight nine ten eleven twelve thirteen"
    texts = [*toxic, *clean, clean[0], f"{item} and", "shared passage of words that is long enough to be a repeat " + "x", "shared passage of words that is long enough to be a repeat " + "y"]
    texts = [f"{t} doc{i}" if t in toxic else t for i, t in enumerate(texts)]
    values = [(i, t, *[f"{n}{i}" for n in NAMES], len(t)) for i, t in enumerate(texts)]
    schema = ", ".join(["doc_id long", "text string", *[f"`{n}` string" for n in NAMES], "n_chars int"])
    docs = spark.createDataFrame(values, schema)
    spark.createDataFrame([(i, 1, int(i < 12)) for i in range(40)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([("i", item)], "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    gone = {}
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"] for r in docs.select("doc_id").collect()}
        docs = stage(spark, docs, str(tmp_path))
        rows = docs.collect()
        gone[name] = before - {r["doc_id"] for r in rows}
        assert docs.columns[: 3 + len(NAMES)] == ["doc_id", "text", *NAMES, "n_chars"]
        for r in rows:
            assert [r[n] for n in NAMES] == [f"{n}{r['doc_id']}" for n in NAMES]
            assert r["n_chars"] == len(r["text"])
    assert gone["toxicity"] == set(range(12))
    assert gone["near duplicates"] >= {42} and gone["near duplicates"] <= {42, 44, 45}
    assert gone["repeated strings"] == set() and gone["tokens"] == set()
    assert gone["decontamination"] == {43}


def test_whole_run_equals_its_stages_in_plain_python(spark):
    """By doc_id, text and ids: near duplicates, repeats, contamination and tokens of what the fitted chain keeps."""
    stages = dict(corpus_pipeline.STAGES)
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    kept = {r["doc_id"]: r["text"] for r in stages["near duplicates"](spark, stages["toxicity"](spark, docs, FOLDER), FOLDER).select("doc_id", "text").collect()}
    texts, seen = {}, {}
    for doc, text in sorted(kept.items()):
        raw = (text or "").encode()
        cover = bytearray(len(raw))
        for i in range(len(raw) - 49):
            if seen.setdefault(raw[i : i + 50], doc) < doc:
                cover[i : i + 50] = b"\1" * 50
        texts[doc] = bytes(b for b, c in zip(raw, cover) if not c).decode(errors="ignore")
    word = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    split = lambda t: [w.decode() for w in word.findall(re.sub(rb"[A-Z]", lambda m: m[0].lower(), t.encode()))]
    windows = set()
    for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect():
        words = split(r["text"] or "")
        windows |= {tuple(words[i : i + 13]) for i in range(max(1, len(words) - 12))} if words else set()
    lengths = {len(w) for w in windows}
    library, want = tokenizers.Tokenizer.from_file(public_tokenizers.path(corpus_pipeline.TOKENIZER)), {}
    for doc, text in texts.items():
        words = split(text)
        hit = set()
        for n in lengths:
            for i in range(len(words) - n + 1):
                if tuple(words[i : i + n]) in windows:
                    hit |= set(range(i, i + n))
        if not hit or 20 * len(hit) < len(words):
            want[doc] = (text, library.encode(text, add_special_tokens=False).ids)
    found = {r["doc_id"]: (r["text"] or "", r["token_ids"]) for r in corpus_pipeline.run(spark, FOLDER).collect()}
    assert len(want) < len(kept) and found == want
