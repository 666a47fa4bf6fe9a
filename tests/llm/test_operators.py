"""Every operator against brute force or an exact round trip, with its odd cases."""

import base64
import hashlib
import itertools
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tokenizers
import xxhash
from pyspark.sql import functions as F

from forumlens.llm import bpe_automaton, decontamination, hmm, quotations, shuffling, simhash, suffix_dedup, topk, toxicity, warc


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def texts(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


# 1. WARC


@pytest.mark.parametrize("sizes", [{}, {"shard_bytes": 3000, "file_bytes": 900}])
def test_warc_round_trip(spark, sizes):
    pages = [(i, f"http://e.com/{i % 7} ä", f"<p>{'é' * (i % 5)}</p>") for i in range(60)]
    pages += [(100, None, None), (101, "u", ""), (None, "u", "<p></p>"), (7, "again", "<p>éé</p>"), (10**15, "x", "y" * 5000)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    manifest, folder = warc.scratch_archive(df, **sizes)
    got = rows(warc.read_warc(manifest, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))
    largest = defaultdict(lambda: -1)
    for i, _, html in pages:
        largest[html or ""] = max(largest[html or ""], -1 if i is None else i)
    want = []
    for i, _, html in pages:
        body = (html or "").encode()
        first = largest[html or ""]
        revisit = i is None or i < first
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        want.append((i, len(body), digest, "revisit" if revisit else "response", first if revisit else None))
    assert got == sorted(want, key=str)
    again, _ = warc.scratch_archive(df.repartition(3), **sizes)
    assert rows(again) == rows(manifest)  # the same files, byte for byte
    assert sum(r["records"] for r in manifest.collect()) == len(pages)
    empty, folder = warc.scratch_archive(df.limit(0))
    assert warc.read_warc(empty, folder).count() == 0


def test_warc_shards_stay_even_with_far_ids(spark):
    """One id far away, clustered ids at both ends of 64 bits, and nulls."""
    ids = [*range(2000), *range(10**12, 10**12 + 2000), 10**15, -(2**63), 2**63 - 1, None]
    df = spark.createDataFrame([(i, "u", f"{i} " + "x" * 500) for i in ids], "page_id long, url string, html string").repartition(5)
    manifest, folder = warc.scratch_archive(df, shard_bytes=100_000, file_bytes=1 << 30)
    records = [r["records"] for r in manifest.collect()]
    assert sum(records) == len(ids) and len(records) >= 40 and max(records) < 2 * sum(records) / len(records)
    assert warc.read_warc(manifest, folder).select("page_id").distinct().count() == len(ids)
    again, _ = warc.scratch_archive(df.repartition(3), shard_bytes=100_000, file_bytes=1 << 30)
    assert rows(again) == rows(manifest)
    assert rows(warc.open_archive(spark, folder)) == rows(manifest)


# 2. top k


def test_top_k_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk, "SHARD", 40)
    chance = np.random.default_rng(5)
    centres = chance.normal(size=(6, 8))
    vectors = [(i, (centres[i % 6] + 0.2 * chance.normal(size=8)).tolist()) for i in range(400)]
    vectors += [(1000 + i, vectors[0][1]) for i in range(50)] + [(2, vectors[2][1])]
    odd = [(3000, None), (3050, [1.0, None] * 4), (3100, [float("nan")] * 8), (3150, [float("inf")] * 8), (3200, [1.0]), (None, [1.0] * 8), (3250, [])]
    df = spark.createDataFrame(vectors + odd, "vec_id long, embedding array<double>")
    good = sorted({(i, tuple(math.floor(256 * x) for x in v)) for i, v in vectors})
    want = []
    for q, v in good:
        if q % 50 == 0:
            best = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in good if i != q)[:5]
            want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(best)]
    assert rows(topk.top_k(df, F.col("vec_id") % 50 == 0)) == sorted(want, key=str)
    assert topk.top_k(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


# 3. SimHash


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    counts = [sum(xxhash.xxh64_intdigest(g, 42) >> b & 1 for g in grams) for b in range(64)]
    return sum(1 << b for b in range(64) if 2 * counts[b] > len(grams))


def test_simhash_components(spark, documents):
    found = rows(simhash.near_duplicates(documents))
    assert [(r[0], r[1]) for r in found] == sorted([(i, f"{plain_fingerprint(t):016x}") for i, t in texts(documents)], key=str)
    group = {r[0]: r[2] for r in found}
    assert group[1] == group[2] == 1 and group[3] == group[4] == 3 and group[None] is None
    kept = simhash.first_of_each(documents)
    assert kept.columns == documents.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(map(str, ids)) == sorted(map(str, [1, 3, None, 5, 6, 7]))
    assert simhash.near_duplicates(documents.limit(0)).count() == 0


def test_trees_lose_no_link():
    chance = np.random.default_rng(1)
    seeds = chance.integers(0, 2**63, 1500, dtype=np.uint64)
    near = [seeds ^ (np.uint64(1) << chance.integers(0, 64, 1500).astype(np.uint64)) ^ (np.uint64(1) << chance.integers(0, 64, 1500).astype(np.uint64)) for _ in range(3)]
    points = np.unique(np.concatenate([seeds, *near]))
    plain = simhash.Forest(len(points))
    i, j = np.nonzero(np.bitwise_count(points[:, None] ^ points[None, :]) <= 4)
    plain.join(i, j)
    for agree in (1, 2):
        forest = simhash.Forest(len(points))
        for mask in simhash.choices(4, agree):
            tree = simhash.VantageTree(points[::3], mask, len(points), 300)
            for _, some in tree.route(points):
                forest.join(some, some[simhash.near_links(points[some], mask, leaf=16)])
        assert (forest.label == plain.label).all()


# 4. HMM


def test_recursions_equal_the_sum_over_all_paths():
    chance = np.random.default_rng(1)
    k, m = 3, 5
    model = hmm.Model(chance.dirichlet(np.ones(k)), chance.dirichlet(np.ones(k), size=k), chance.dirichlet(np.ones(m), size=k).T.copy())
    seqs = [chance.integers(0, m, n) for n in (4, 1, 6, 3)]
    lengths = np.array([len(s) for s in seqs])
    layout, seen = hmm.side_by_side(np.concatenate(seqs), lengths, np.arange(4))
    scale = model.forward(model.emissions(seen), layout)
    got = np.zeros(4)
    got[layout.order] = np.bincount(layout.text, weights=np.log(scale)[layout.place], minlength=4)
    sums = {"start": np.zeros(k), "move": np.zeros((k, k)), "emit": np.zeros((m, k))}
    model.expect(seen, layout, sums)
    want = {n: np.zeros_like(v) for n, v in sums.items()}
    for n, seq in enumerate(seqs):
        paths = []
        for p in itertools.product(range(k), repeat=len(seq)):
            w = model.start[p[0]] * model.emit[seq[0], p[0]]
            for a, b, o in zip(p, p[1:], seq[1:]):
                w *= model.move[a, b] * model.emit[o, b]
            paths.append((p, w))
        total = sum(w for _, w in paths)
        assert math.isclose(math.log(total), got[n])
        for p, w in paths:
            want["start"][p[0]] += w / total
            for a, b in zip(p, p[1:]):
                want["move"][a, b] += w / total
            for o, z in zip(seq, p):
                want["emit"][o, z] += w / total
    assert all(np.allclose(sums[n], want[n]) for n in sums)


def test_scores(spark, documents):
    fold = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 1, F.lit(True))
    scored = hmm.score_texts(documents, fold, block_tokens=50)
    assert scored.columns[:5] == documents.columns
    tokens = [(i, (t or "").encode().lower().split() + [b"\n"], i is not None and zlib.crc32(str(i).encode()) % 5 == 1) for i, t in texts(documents)]
    counts = Counter(w for _, ws, out in tokens if not out for w in ws)
    n, v = sum(counts.values()), len(counts)
    want = sorted((str(i), out, len(ws), sum(counts[w] > 0 for w in ws), n, round(sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws), 6)) for i, ws, out in tokens)
    got = scored.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score").collect()
    assert sorted((str(r[0]), *r[1:5], round(r[5], 6)) for r in got) == want
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in got)
    assert hmm.score_texts(documents.limit(0), fold).count() == 0
    assert hmm.score_texts(documents, F.lit(False)).count() == len(tokens)


def test_states_help_on_held_out_texts(spark):
    chance = random.Random(3)
    tongues = [[f"{c}{i}" for i in range(150)] for c in "abcd"]
    rows_of = [(i, " ".join(chance.choice(tongues[i % 4]) for _ in range(60))) for i in range(400)]
    df = spark.createDataFrame(rows_of, "doc_id long, text string").repartition(3)
    r = hmm.score_texts(df, F.col("doc_id") % 5 != 1, rounds=4).filter("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert r[0] > 0.85 * r[1]


def plain_rounds(trained, ratio, states, rounds):
    """Baum-Welch word by word: start, move and each word's ratios, with the expected counts and shares of the last round."""
    counts = Counter(w for ws in trained for w in ws)
    n = sum(counts.values())
    start, move = np.full(states, 1 / states), np.full((states, states), 0.1 / states) + 0.9 * np.eye(states)
    for _ in range(rounds):
        begun, moved, emitted = np.ones(states), np.ones((states, states)), {w: np.zeros(states) for w in counts}
        for ws in trained:
            ahead, behind = [start * ratio[ws[0]]], [np.ones(states)]
            for w in ws[1:]:
                ahead.append(ahead[-1] @ move * ratio[w])
            for w in ws[:0:-1]:
                behind.insert(0, move @ (ratio[w] * behind[0]))
            total = ahead[-1].sum()
            for t, w in enumerate(ws):
                emitted[w] += ahead[t] * behind[t] / total
                if t:
                    moved += np.outer(ahead[t - 1], ratio[w] * behind[t]) * move / total
            begun += ahead[0] * behind[0] / total
        start, move = begun / begun.sum(), moved / moved.sum(axis=1, keepdims=True)
        mass = sum(emitted.values()) / n
        b = hmm.BACKGROUND
        ratio = {w: (1 - b) * (e + 0.5 * mass) / (mass * (counts[w] + 0.5)) + b for w, e in emitted.items()}
    return start, move, ratio, counts


def test_scores_equal_a_plain_model(spark, monkeypatch):
    chance, states = random.Random(5), 3
    docs = [(i, " ".join(chance.choice("abc"[i % 3]) + str(chance.randrange(9)) for _ in range(chance.randrange(1, 25)))) for i in range(40)]
    docs += [(40, "never seen a1"), (41, None), (42, "a1 a1 b2"), (42, "a1 a1 b2")]
    monkeypatch.setattr(hmm, "first_groups", lambda blocks, tasks, anchors, states: np.arange(len(anchors)) % states)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = hmm.score_texts(df, F.col("doc_id") % 5 != 0, states=states, rounds=4, block_tokens=60).collect()

    words = {i: (t or "").encode().split() + [hmm.END] for i, t in docs}
    trained = [(t or "").encode().split() + [hmm.END] for i, t in docs if i % 5]
    counts = Counter(w for ws in trained for w in ws)
    hashes = dict(zip(counts, hmm.word_hashes(list(counts))))
    everywhere = hmm.word_hashes(sorted({w for ws in words.values() for w in ws}))  # so few that all are anchors
    assert len(everywhere) <= hmm.ANCHORS
    anchors = everywhere[np.argsort(everywhere[:, 0])]
    first = hmm.first_ratios(np.array(list(hashes.values())), anchors, np.arange(len(anchors)) % states, states)
    start, move, ratio, counts = plain_rounds(trained, dict(zip(hashes, first)), states, 4)
    n, v = sum(counts.values()), len(counts)
    share = lambda w: (counts[w] + 0.5) / (n + 0.5 * (v + 1))
    for k in range(states):  # all words and the unknown one
        assert math.isclose(sum(share(w) * r[k] for w, r in ratio.items()) + share(b"never"), 1, rel_tol=1e-9)
    assert len(got) == len(docs)
    for r in got:
        at, total = start, 0.0
        for t, w in enumerate(words[r["doc_id"]]):
            at = (at @ move if t else at) * ratio.get(w, np.ones(states))
            total += math.log10(at.sum() * share(w))
            at = at / at.sum()
        assert math.isclose(r["score"], total, rel_tol=2e-3), (r, total)


def test_each_word_has_its_own_states(spark):
    """Rare words that a small number of hash classes would throw together with frequent ones."""
    chance = random.Random(3)
    tongues = [[f"{c}{i}" for i in range(12000)] for c in "abcd"]
    rows_of = [(i, " ".join([f"{'abcd'[i % 4]}{chance.randrange(12)}" for _ in range(20)] + chance.choices(tongues[i % 4], k=300))) for i in range(800)]
    df = spark.createDataFrame(rows_of, "doc_id long, text string").repartition(3)
    r = hmm.score_texts(df, F.col("doc_id") % 5 != 1).filter("held_out").agg(F.sum("score"), F.sum("base_score"), F.sum("n_known")).first()
    # with every word known to one language, each is 4 times as likely as in the whole corpus
    assert r[0] - r[1] > 0.8 * math.log10(4) * r[2]


# 5. toxicity


def test_toxicity(spark, documents):
    chance = random.Random(1)
    words = [f"w{i}" for i in range(200)]
    data = []
    for i in range(600):
        text = [chance.choice(words) for _ in range(30)]
        toxic = i % 5 == 0
        if toxic:
            text.insert(chance.randrange(30), chance.choice(["moron", "scum", "worthless"]))
        data.append((i, " ".join(text), int(chance.random() < 0.8), int(toxic)))
    df = spark.createDataFrame(data, "doc_id long, text string, quality int, toxic int").repartition(2)
    labels = df.filter("doc_id < 400").select("doc_id", "quality", "toxic")
    labels = labels.unionByName(spark.createDataFrame([(1, None, 1), (None, 1, 1)], labels.schema))
    judged = toxicity.judge(df.select("doc_id", "text"), labels).join(df.select("doc_id", "toxic"), "doc_id")
    held_out = judged.filter("doc_id >= 400").collect()
    assert sum(r["is_toxic"] == bool(r["toxic"]) for r in held_out) >= 0.95 * len(held_out)
    odd = toxicity.judge(documents, labels)
    assert odd.columns[:5] == documents.columns and odd.count() == documents.count()
    assert toxicity.judge(documents, labels.limit(0)).filter("is_toxic or p_toxic <> 0").count() == 0
    assert toxicity.judge(documents.limit(0), labels).count() == 0


# 6. quotations


def test_quotations(spark):
    said = [
        (1, 0, "Shall we meet?\nOn Monday or\nTuesday.\n\nBring the maps."),
        (1, 1, "> shall  we MEET?\n> On Monday or\n> Tuesday.\nMonday."),
        (1, 2, "Something else."),
        (1, 3, "Ann wrote:\n>> Bring the maps.\n> Monday.\nFine."),
        (1, 4, "> Something nobody said\nWhat?"),
        (1, 5, "> On Monday or\n> never at all, it seems\nNo."),
        (2, 0, "> Monday.\nOther conversation."),
        (2, 0, None),
        (2, 1, ""),
        (None, 1, "> Monday.\nlost"),
        (3, None, "> x"),
    ]
    df = spark.createDataFrame([(*r, "user", 9) for r in said], "conv_id long, turn long, text string, role string, thread long")
    out = quotations.link_quotations(df)
    assert out.columns == ["conv_id", "turn", "text", "role", "reply_to", "thread", "n_quotes", "n_linked"]
    got = {(r["conv_id"], r["turn"], r["text"]): (r["reply_to"], r["thread"], r["n_quotes"], r["n_linked"]) for r in out.collect()}
    assert got[1, 0, said[0][2]] == (None, 0, 0, 0)
    assert got[1, 1, "Monday."] == (0, 0, 1, 1)
    assert got[1, 2, "Something else."] == (1, 2, 0, 0)
    assert got[1, 3, "Fine."] == (1, 0, 2, 2)
    assert got[1, 4, "What?"] == (3, 4, 1, 0)
    assert got[1, 5, "No."] == (4, 5, 1, 0)
    assert got[2, 0, "Other conversation."] == (None, 0, 1, 0) and (2, 0, None) in got and (2, 1, "") in got
    assert got[None, 1, "lost"][:2] == (None, None) and got[3, None, ""][:2] == (None, None)
    assert len(got) == len(said)
    assert [r["turn"] for r in out.collect() if r["conv_id"] == 1] == [0, 1, 3, 2, 4, 5]
    assert quotations.link_quotations(df.limit(0)).count() == 0
    assert "Python" not in out._jdf.queryExecution().toString()


# 7. sharding


def test_shards(spark, documents):
    more = documents.unionByName(spark.range(500).selectExpr("id + 100 as doc_id", "repeat('ab ', cast(id % 40 as int)) as text", "'q' as bucket", "id as shard", "'r' as `a.b`"))
    one = shuffling.external_shuffle(more, bucket_bytes=2000)
    two = shuffling.external_shuffle(more.repartition(7), bucket_bytes=2000)
    assert rows(one.select("doc_id", "shard", "slot")) == rows(two.select("doc_id", "shard", "slot"))
    slots = defaultdict(list)
    for r in one.collect():
        slots[r["shard"]].append(r["slot"])
    assert sorted(slots) == list(range(24)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    names = ["doc_id", "text", "bucket", "`a.b`"]
    assert rows(one.select(*names)) == rows(more.select(*names))
    assert shuffling.external_shuffle(documents.limit(0)).count() == 0


def test_fisher_yates_is_uniform():
    seen = Counter(tuple(shuffling.fisher_yates(3, np.random.default_rng([s, 1]))) for s in range(6000))
    assert len(seen) == 6 and all(850 < n < 1150 for n in seen.values())


# 8. repeated strings


def plain_removal(pairs, length=50):
    first = {}
    for d, t in pairs:
        b = (t or "").encode()
        for i in range(len(b) - length + 1 if d is not None else 0):
            first[b[i : i + length]] = min(first.get(b[i : i + length], d), d)
    out = []
    for d, t in pairs:
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1 if d is not None else 0):
            if first[b[i : i + length]] < d:
                gone[i : i + length] = True
        spans = int(gone[:1].sum()) + int((gone[1:] & ~gone[:-1]).sum())
        out.append((d, len(b), int(gone.sum()), spans, hashlib.sha256(np.frombuffer(b, np.uint8)[~gone].tobytes()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("frequent", [3, 10**6])
def test_repeats_equal_brute_force(spark, documents, monkeypatch, frequent):
    monkeypatch.setattr(suffix_dedup, "FREQUENT", frequent)
    monkeypatch.setattr(suffix_dedup, "CHUNK", 5000)
    chance = random.Random(3)
    words = ["alpha", "be", "gamma", "the", "of", "x", "née", "日本"]
    sentence = lambda n: " ".join(chance.choice(words) for _ in range(n))
    pool = [sentence(chance.randrange(8, 60)) for _ in range(20)]
    made = [(i, "".join(chance.choice([chance.choice(pool), sentence(5), "q" * chance.randrange(0, 120)]) for _ in range(chance.randrange(8)))) for i in range(10, 130)]
    df = documents.select("doc_id", "text").unionByName(spark.createDataFrame(made, "doc_id long, text string")).repartition(4)
    cut = suffix_dedup.remove_repeats(df, block_bytes=3000, bucket_bytes=6000)
    assert rows(cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256))) == plain_removal(texts(df))


def test_repeats_keep_other_columns(spark, documents):
    cut = suffix_dedup.remove_repeats(documents)
    assert cut.columns[:5] == documents.columns
    assert rows(cut.select("doc_id", "bucket", "shard", "`a.b`")) == rows(documents.select("doc_id", "bucket", "shard", "`a.b`"))
    assert suffix_dedup.remove_repeats(documents.limit(0)).count() == 0


# 9. decontamination


def test_decontamination(spark, documents):
    quick = "the quick brown fox jumps over the lazy dog again and again, they say"
    items = [(1, quick), (1, "word3 word4"), (2, "日本語"), (3, None), (None, "no number"), (4, "..."), (5, "quick fox")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    scanned = decontamination.scan_windows(documents, bench)
    small = decontamination.scan_windows(documents, bench, slice_bytes=16)
    names = ["doc_id", "n_words", "n_hit", "items", "contaminated"]
    got = rows(decontamination.judged(scanned).select(*names))
    assert got == rows(decontamination.judged(small).select(*names))
    by_id = {r[0]: r for r in got}
    assert by_id[1][1:] == (14, 14, ["1"], True) and by_id[3][1:] == (0, 0, [], False)
    assert by_id[5][2] == 2 * 31 and by_id[5][4] is False and by_id[6][3] == ["2"]
    assert by_id[None][1:] == (3, 2, [], True)
    kept = decontamination.decontaminate(documents, bench)
    assert kept.columns == documents.columns and sorted(str(r["doc_id"]) for r in kept.collect()) == ["3", "4", "5", "7"]
    spans = {r["doc_id"]: r["text"] for r in decontamination.decontaminate(documents, bench, remove="spans").collect()}
    assert spans[1] == "." and spans[None] == " here" and spans[6] == "¡Él dijo: ! <|endoftext|> \t\n x" and spans[3] is None
    assert decontamination.decontaminate(documents, bench.limit(0)).count() == documents.count()
    assert decontamination.decontaminate(documents.limit(0), bench).count() == 0


# 10. BPE


def test_bpe_equals_the_library(spark, documents):
    path = public_tokenizers.path("word_bpe_49k.json")
    library = tokenizers.Tokenizer.from_file(path)
    own = bpe_automaton.tokenizer(path)
    chance = random.Random(1)
    kinds = [(32, 127), (9, 14), (0x80, 0x2500), (0x2500, 0xD7FF), (0x10000, 0x1FFFF)]
    made = ["".join(chr(chance.randrange(*chance.choice(kinds))) for _ in range(30)) for _ in range(1500)]
    made += ["", "ΣΑΣ ΟΔΟΣ.", "İstanbul ﬁ", "don't I'LL we'Ve", "a" * 2000, "a<|endoftext|>b <|startoftext|>", "é Å", "\x1c\x85 x"]
    for text in made:
        want = library.encode(text, add_special_tokens=False)
        assert own.encode(text) == want.ids
        assert own.decode(want.ids) == library.decode(want.ids, skip_special_tokens=False)
    out = bpe_automaton.encode_documents(documents, path)
    assert out.columns == [*documents.columns, "token_ids", "decoded"]
    for r in out.collect():
        want = library.encode(r["text"] or "", add_special_tokens=False).ids
        assert r["token_ids"] == want and r["decoded"] == library.decode(want, skip_special_tokens=False)
    assert bpe_automaton.encode_documents(documents.limit(0), path).count() == 0


def test_automaton_equals_the_merge_loop():
    """Gadgets against plain merging, also for merges that overlap themselves."""
    merges = [("a", "a"), ("aa", "b"), ("b", "a"), ("aa", "aa"), ("ba", "aab"), ("a", "b</w>"), ("aa", "b</w>")]
    made = {x + y for x, y in merges}
    symbols = ["a", "b", "a</w>", "b</w>"]
    ids = {s: i for i, s in enumerate([*symbols, *(x + y for x, y in merges)])}
    automaton = bpe_automaton.Automaton(symbols, merges, ids)
    automaton.compile("</w>")
    assert made <= set(automaton.labels)
    for n in range(1, 10):
        for word in map("".join, itertools.product("ab", repeat=n)):
            parts = [*word[:-1], word[-1] + "</w>"]
            for pair in merges:
                i = 0
                while i + 1 < len(parts):
                    if (parts[i], parts[i + 1]) == pair:
                        parts[i : i + 2] = ["".join(pair)]
                    i += 1
            assert [automaton.labels[t] for t in automaton.path(word)] == parts, word
