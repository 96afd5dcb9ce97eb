"""Every operator against a plain version on small rows, with nulls, empty texts, repeats and clashing columns."""

import hashlib
import math
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from trendmark.llm import chat, decontaminate, language, mixing, nearest, ngram_join, quality, recurrent, token_counts, wavelet
from trendmark.llm.common import learning_row, table
from trendmark.session import scratch_path

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, row string, part string, score string, whole string"
LONG = " ".join(f"w{i % 997}x{i % 13}" for i in range(30_000))
ODD = ["", None, " \t\n", "a", "B b", "Été — naïve x", LONG, "the same words here again", "the same words here again"]


def rows_of(spark, texts, first=0):
    rows = [(first + i, t, "en", None if i % 5 == 4 else f"s{i % 2}", 0, "r", "p", "s", "w") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def odd(spark):
    """Odd texts, one row twice and one without an id."""
    rows = rows_of(spark, ODD)
    return rows.unionByName(rows.filter("doc_id = 7")).unionByName(rows.filter("doc_id = 4").withColumn("doc_id", F.lit(None).cast("bigint")))


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def real(spark, tiny):
    return table(spark, tiny, "documents")


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def test_recurrent_probabilities(spark, odd, real, none):
    for docs in (odd, real):
        found = recurrent.score_documents(docs, learning_row("doc_id", 7, 2)).collect()
        texts = docs.select("doc_id", "text").collect()
        assert len(found) == len(texts)
        words = {r.doc_id: re.findall(r"[^\x20\x09-\x0D]+", lowered(r.text)) + [""] for r in texts}
        held = {i: zlib.crc32(str("" if i is None else i).encode()) % 7 == 2 for i in words}
        counts = Counter(w for r in texts if not held[r.doc_id] for w in words[r.doc_id])
        total = sum(counts.values())
        for r in found:
            own = words[r.doc_id]
            assert (r.held_out, r.n_tokens, r.train_tokens) == (held[r.doc_id], len(own), total)
            assert r.n_known == sum(w in counts for w in own)
            base = sum(np.log10((counts[w] + 1) / (total + len(counts) + 1)) for w in own)
            assert r.base_score == pytest.approx(base, rel=1e-9) and r.score < 0
    fresh = [r for r in found if r.held_out]
    assert sum(r.score for r in fresh) > sum(r.base_score for r in fresh)
    assert recurrent.score_documents(none, learning_row("doc_id", 7, 2)).count() == 0


def test_recurrent_learns_from_every_word(spark):
    recurrent.ready(spark)
    docs = rows_of(spark, [" ".join(f"w{i}x{j}" for j in range(10)) for i in range(20)])
    vocabulary = recurrent.learn_vocabulary(recurrent.count_words(docs))
    learnt, fresh = recurrent.learn_unit(docs, vocabulary), recurrent.Unit.fresh(vocabulary)
    changed = (learnt.x != fresh.x).any(1)
    assert len(vocabulary.keys) == 201 and all(changed[i] for i, key in enumerate(vocabulary.keys) if key != recurrent.END)


def test_recurrent_gradient():
    vocabulary = recurrent.Vocabulary(np.array([recurrent.END, 7, 8], np.uint64), np.zeros(3, int), np.array([5, 3, 2]), {0: (4, 2)}, 14, 5)
    unit = recurrent.Unit.fresh(vocabulary)
    inputs = np.array([[1, 2], [recurrent.WORDS, 0], [0, 1]], np.int32)
    ends, real, h = inputs == 0, np.ones_like(inputs, bool), np.zeros((2, recurrent.HIDDEN), np.float32)
    g, _ = unit.gradient(h, inputs, ends, real)

    def loss(flat):
        own = recurrent.Unit(flat)
        states, _ = own.read(h, inputs, ends)
        return -own.log_probabilities(states.reshape(-1, recurrent.HIDDEN), inputs.ravel()).mean()

    for i in np.argsort(-np.abs(g))[:40:4]:
        near = [unit.flat.copy(), unit.flat.copy()]
        near[0][i] += 1e-2
        near[1][i] -= 1e-2
        assert (loss(near[0]) - loss(near[1])) / 2e-2 == pytest.approx(g[i], rel=0.05, abs=2e-4)
    whole = [np.array([1, 2, 1, 1, 2, 0] * 40, np.int32)]
    states, _ = unit.read(np.zeros((1, recurrent.HIDDEN), np.float32), whole[0][:, None], np.arange(240)[:, None] == 239)
    straight = unit.log_probabilities(states[:, 0], whole[0]).sum()
    assert recurrent.sequence_scores(unit, whole)[0] == pytest.approx(straight, rel=1e-4)


def test_recurrent_classes_fill_blocks():
    vocabulary = recurrent.Vocabulary(np.arange(recurrent.WORDS, dtype=np.uint64), np.zeros(recurrent.WORDS, int), np.ones(recurrent.WORDS), {0: (4, 2)}, 2000, 1300)
    unit, rng = recurrent.Unit.fresh(vocabulary), np.random.default_rng(6)
    # Classes of no word, one, just as many as a block has, and one more; and tail classes.
    inputs = np.concatenate([np.full(n, 32 * c) + rng.integers(0, 32, n) for c, n in enumerate((0, 1, 32, 33, 0, 700, 64))] + [np.arange(recurrent.WORDS, recurrent.WORDS + 20)])
    inputs = rng.permutation(np.resize(inputs, (50, 17)).ravel()).astype(np.int32)
    states = rng.normal(0, 0.5, (len(inputs), recurrent.HIDDEN)).astype(np.float32)
    plain = []
    for state, at in zip(states.astype(float), inputs.tolist()):
        logits = state @ unit.wc + unit.bc
        c, w = (at // 32, at % 32) if at < recurrent.WORDS else (at - recurrent.WORDS + recurrent.CLASSES, None)
        words = state @ unit.ww[c] + unit.bw[c] if w is not None else np.zeros(1)
        plain.append(logits[c] - np.log(np.exp(logits).sum()) + words[w or 0] - np.log(np.exp(words).sum()))
    assert unit.log_probabilities(states, inputs) == pytest.approx(np.array(plain), abs=1e-4)
    # A step's arrays are not kept for a whole window, nor class logits for all of its tokens.
    many = np.resize(inputs, 64 * 256)
    spread = np.resize(states, (len(many), recurrent.HIDDEN))
    tracemalloc.start()
    unit.log_probabilities(spread, many)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 8e6


@pytest.mark.parametrize("taught", [True, False])
def test_recurrent_score_is_the_same_alone_and_among_others(spark, taught):
    texts = [" ".join(f"w{(i * j) % 7}" for j in range(i % 40 + 1)) for i in range(700)]
    docs = rows_of(spark, ["a b c"] * 20 + texts).coalesce(1)  # more documents than lanes in one task
    learns = F.col("doc_id") < (200 if taught else 0)
    scores = {r.doc_id: r.score for r in recurrent.score_documents(docs, learns).collect()}
    assert len({round(scores[i], 4) for i in range(20)}) == 1
    if not taught:
        alone = recurrent.score_documents(docs.filter("doc_id = 333"), learns).first()
        assert alone.score == pytest.approx(scores[333], rel=1e-5)


def test_model_words_are_known_however_many_are_as_frequent(spark, monkeypatch):
    monkeypatch.setattr(recurrent, "KNOWN", 10)
    recurrent.ready(spark)
    docs = rows_of(spark, [" ".join(f"w{i}x{j}" for j in range(10)) for i in range(20)])
    vocabulary = recurrent.learn_vocabulary(recurrent.count_words(docs))
    assert len(vocabulary.keys) == 201 and vocabulary.keys[0] == recurrent.END


def test_words_and_their_forms():
    texts = ["The Cat. sat,\tÉté longer-one x\x00", None, "", "a a A", "  ", "wordlonger, 1234567890"]
    found = recurrent.Words(recurrent.pa.array(texts))
    own = [re.findall(rb"[^ \t]+", (t or "").encode().lower()) for t in texts]
    form = lambda w: (12 if w.isascii() else 0) + 3 * (0 if w[-1] >= 97 else {46: 1, 44: 2}.get(w[-1], 3)) + (len(w) >= 6) + (len(w) >= 10)
    assert found.bounds.tolist() == np.cumsum([0, *(len(w) + 1 for w in own)]).tolist()
    assert found.form.tolist() == [x for words in own for x in [*map(form, words), recurrent._END_FORM]]
    keys = defaultdict(set)
    for key, word in zip(found.keys.tolist(), [w for words in own for w in [*words, b""]]):
        keys[word].add(key)
    assert all(len(x) == 1 for x in keys.values()) and len({min(x) for x in keys.values()}) == len(keys) and keys[b""] == {0}


def test_chat_round_trip(spark):
    texts = ["hi", "", None, "<|end|>&amp;", "<|turn:user|>", "x<", "|>y", "<|>", "&lt;|", "a\nb"]
    rows = [(c, t, r, texts[(t + c) % len(texts)], 1) for c in range(4) for t in range(9) for r in [["user", "assistant", None, "<|and|>"][(t // 2 + c) % 4]]]
    rows += [rows[0], (None, 1, "assistant", "z", 1)]
    frame = spark.createDataFrame(rows, "conv_id int, turn int, role string, text string, formatted int")
    formatted = chat.format_conversations(frame)
    back = {r.conv_id: [(t.role, t.text) for t in r.turns] for r in chat.read_conversations(formatted).collect()}
    wanted = defaultdict(list)
    for c, t, r, x, _ in sorted(rows, key=lambda v: (v[0] is None, v[0], v[1], v[2] or "", v[3] or "")):
        wanted[c].append((r or "", x or ""))
    assert back == wanted
    for r in chat.fingerprints(formatted).collect():
        turns = wanted[r.conv_id]
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        loss = "".join(b for a, b in turns if a == "assistant")
        assert (r.n_turns, r.loss_chars, r.loss_sha256) == (len(turns), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    for r in chat.masked_texts(formatted).collect():
        assert sum(x.chars for x in r.loss_runs) == len(r.formatted)
        assert r.loss_texts == [b for a, b in wanted[r.conv_id] if a == "assistant"]
    # A wrong mask shows in the digest.
    moved = formatted.withColumn("loss_runs", F.transform("loss_runs", lambda x: F.struct(x["chars"], (~x["loss"]).alias("loss"))))
    digests = lambda df: {r.conv_id: r.loss_sha256 for r in chat.fingerprints(df).collect()}
    assert all(digests(moved)[i] != d for i, d in digests(formatted).items())
    long = spark.range(1500).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.element_at(F.array(F.lit("user"), F.lit("assistant")), (F.col("id") % 2 + 1).cast("int")).alias("role"), F.concat(F.lit("é<|"), "id").alias("text"))
    found = chat.fingerprints(chat.format_conversations(long)).first()
    assert found.loss_sha256 == hashlib.sha256("".join(f"é<|{i}" for i in range(1, 1500, 2)).encode()).hexdigest()
    assert chat.fingerprints(chat.format_conversations(frame.limit(0))).count() == 0


def test_nearest_recall(spark, tiny):
    rows = [(i, [float(np.cos(i / 7)), float(np.sin(i / 7)), i % 3 / 9], "x") for i in range(60)]
    rows += [(100 + i, [1.0, 0.0, 0.0], "x") for i in range(20)]
    rows += [(500, None, "x"), (550, [0.0, 0.0, 0.0], "x"), (600, [1.0, None, 2.0], "x"), (650, [float("nan"), 1.0, 1.0], "x"), (None, [1.0, 1.0, 1.0], "x"), (700, [1.0], "x"), rows[0]]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, node string")
    for vectors in (frame, table(spark, tiny, "embeddings")):
        found = nearest.nearest(vectors, F.col("vec_id") % 50 == 0).collect()
        kept = {r.vec_id: np.array(r.embedding, float) for r in nearest.valid(vectors).collect()}
        hits = 0
        for q in (queries := [i for i in kept if i % 50 == 0]):
            score = {i: float(v @ kept[q] / np.linalg.norm(v) / np.linalg.norm(kept[q])) for i, v in kept.items() if i != q}
            best = sorted(score, key=lambda i: (-round(score[i], 12), i))[:5]
            own = sorted((r for r in found if r.query_id == q), key=lambda r: r.rank)
            assert [r.rank for r in own] == [1, 2, 3, 4, 5]
            assert all(r.score == pytest.approx(score[r.vec_id], abs=1e-12) for r in own)
            hits += len(set(best) & {r.vec_id for r in own})
        assert hits >= 0.9 * 5 * len(queries)
    tiny_and_huge = [(50 * i, [1e-200 * math.cos(i), 1e-200 * math.sin(i), 0.0]) for i in range(1, 9)] + [(i, [1e200 * math.cos(i + 0.1), 1e200 * math.sin(i + 0.1), 0.0]) for i in range(1, 9)]
    extreme = spark.createDataFrame(tiny_and_huge + [(900, [5e-324, 0.0, 0.0]), (901, [1.7e308, 1.7e308, 0.0])], "vec_id bigint, embedding array<double>")
    for r in nearest.nearest(extreme, F.col("vec_id") % 50 == 0).collect():
        a, b = (np.array(dict(tiny_and_huge + [(900, [1.0, 0.0, 0.0]), (901, [1.0, 1.0, 0.0])])[i]) for i in (r.query_id, r.vec_id))
        a, b = a / np.abs(a).max(), b / np.abs(b).max()
        assert r.score == pytest.approx(a @ b / np.linalg.norm(a) / np.linalg.norm(b), abs=1e-12)
    assert nearest.nearest(frame.limit(0), F.col("vec_id") % 50 == 0).count() == 0
    few = nearest.nearest(frame.filter("vec_id in (0, 1, 2)"), F.col("vec_id") % 50 == 0)
    assert {r.vec_id for r in few.collect()} == {1, 2}


def test_nearest_beam_grows_with_the_table():
    assert nearest.beam_of(10) == nearest.BEAM and nearest.beam_of(16 * nearest.BEAM_FITS) == 8 * nearest.BEAM


def test_nearest_takes_few_jobs_and_searches_every_shard(spark, monkeypatch):
    monkeypatch.setattr(nearest, "SHARD", 300, raising=False)
    rng = np.random.default_rng(4)
    rows = rng.normal(size=(1500, 16))
    frame = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(rows)], "vec_id bigint, embedding array<double>")
    spark.sparkContext.setJobGroup("nearest-jobs", "nearest")
    found = nearest.nearest(frame, F.col("vec_id") % 50 == 0).collect()
    # A search by rounds over all queries took more jobs the more rounds it needed.
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("nearest-jobs")) < 60
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    unit = rows / np.linalg.norm(rows, axis=1, keepdims=True)
    near = unit @ unit.T - 9 * np.eye(len(unit))
    best = {(i, int(j)) for i in range(0, 1500, 50) for j in np.argsort(-near[i])[:5]}
    assert len(found) == 150 and len(best & {(r.query_id, r.vec_id) for r in found}) >= 0.95 * 150


def test_nearest_shard_graph_and_search():
    rng = np.random.default_rng(5)
    for n in (1, 2, 30, 257, 3000):
        unit = rng.normal(size=(n, 12)).astype(np.float32)
        unit /= np.linalg.norm(unit, axis=1, keepdims=True)
        ids, near = nearest.greedy(unit, nearest.descend(unit), unit[:100])
        for i in range(min(n, 100)):
            kept = ids[i][near[i] > -3]
            assert len(kept) == len(set(kept.tolist())) == min(n, nearest.WIDTH)
            assert near[i][near[i] > -3] == pytest.approx(unit[kept] @ unit[i], abs=1e-5)
        sim = unit[:100] @ unit.T
        hits = sum(len(set(np.argsort(-row)[:5].tolist()) & set(own[value > -3].tolist())) for row, own, value in zip(sim, ids, near))
        assert hits >= 0.95 * sim.shape[0] * min(5, n)
    splits = nearest._tree(unit, 8, rng)
    assert (nearest._leaves(unit, splits, 8)[:, 0] == nearest._leaf(unit, splits)).mean() > 0.99


def test_decontamination(spark, odd, none):
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    texts = [*ODD, "one two three", "x One, TWO three y", " ".join(f"k{i}" for i in range(30)), "zz " + " ".join(f"k{i}" for i in range(5, 22)) + " é"]
    docs = rows_of(spark, texts)
    items = {"1": "one two Three", "2": " ".join(f"K{i}" for i in range(30)), "10": None, "11": "--", "3": "B b"}
    bench = spark.createDataFrame([(int(i), t, 1) for i, t in items.items()], "item_id bigint, text string, words int")
    windows = []
    for item, text in items.items():
        own = pattern.findall(lowered(text))
        windows += [(item, own[i : i + 13]) for i in range(max(1, len(own) - 12)) if own]
    for limit in (decontaminate.WINDOWS, 1):
        found = {r.doc_id: r for r in decontaminate.judged(decontaminate.find_items(docs, bench, windows=limit)).collect()}
        for i, text in enumerate(texts):
            own = pattern.findall(lowered(text))
            hit, ids = set(), set()
            for item, w in windows:
                for a in range(len(own) - len(w) + 1):
                    if own[a : a + len(w)] == w:
                        hit.update(range(a, a + len(w)))
                        ids.add(item)
            r = found[i]
            assert (r.n_words, r.n_hit, r.items) == (len(own), len(hit), sorted(ids))
            assert r.contaminated == (0 < len(hit) and 20 * len(hit) >= len(own))
    kept = decontaminate.clean(docs, bench)
    assert kept.columns == docs.columns and kept.count() == sum(not r.contaminated for r in found.values())
    assert decontaminate.find_items(none, bench).count() == 0
    assert decontaminate.judged(decontaminate.find_items(odd, bench.limit(0))).filter("contaminated").count() == 0


#: Rows of one id and of none: hit by two items in two places, by one, and clean, some with as many words.
SHARED = ["a b c d e f", "a b c x y z", "p q r s t u", "x y z d e f", "long " * 6]


def shared_ids(spark):
    docs = rows_of(spark, SHARED).withColumn("doc_id", F.lit(4).cast("bigint"))
    docs = docs.unionByName(docs.withColumn("doc_id", F.lit(None).cast("bigint")))
    return docs, spark.createDataFrame([(1, "a b c"), (2, "d e f")], "item_id bigint, text string")


def test_decontamination_finds_items_row_by_row_in_blocks(spark):
    docs, bench = shared_ids(spark)
    wanted = Counter((i, 6, n, tuple(items)) for i in (4, None) for n, items in [(6, "12"), (3, "1"), (0, ""), (3, "2"), (0, "")])
    for limit in (decontaminate.WINDOWS, 1):
        found = decontaminate.judged(decontaminate.find_items(docs, bench, windows=limit)).collect()
        assert Counter((r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in found) == wanted


def test_decontamination_drops_contaminated_rows_only(spark):
    docs, bench = shared_ids(spark)
    for limit in (decontaminate.WINDOWS, 1):
        kept = decontaminate.clean(docs, bench, windows=limit)
        assert kept.columns == docs.columns
        assert Counter((r.doc_id, r.text) for r in kept.collect()) == Counter((i, SHARED[k]) for i in (4, None) for k in (2, 4))


def test_tokens(spark, odd, none, real):
    specials = rows_of(spark, ["a<|endoftext|>b", "<|endoftext|>", "A<|STARTOFTEXT|> <|startoftext|>", "İ J̌ Σς  x　", "it's  we'll\n\n x ", "1234 \x1c a"], 50)
    docs = odd.unionByName(specials)
    byte, word = (public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "word_bpe_49k.json"))
    slow = Tokenizer.from_file(byte)
    texts = docs.select("doc_id", "text").collect()
    found = Counter((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts.count_tokens(docs, byte).collect())
    n = lambda t: len(slow.encode(t or "", add_special_tokens=False).ids)
    assert found == Counter((r.doc_id, len((r.text or "").encode()), n(r.text), n(r.text) > 512) for r in texts)
    assert token_counts.count_tokens(none, byte).count() == 0
    slow = Tokenizer.from_file(word)
    target = scratch_path(spark, "test")
    wavelet.write_shards(docs, target, word, shard=50)
    start, wanted = 0, []
    for r in sorted(texts, key=lambda r: (r.doc_id is not None, r.doc_id, r.text or "")):
        ids = slow.encode(r.text or "", add_special_tokens=False).ids + [2]
        wanted.append((r.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert Counter(map(tuple, wavelet.read_documents(spark, target).collect())) == Counter(wanted)
    target = scratch_path(spark, "test")
    wavelet.write_shards(none, target, word)
    assert wavelet.read_documents(spark, target).count() == 0


def test_wavelet_matrix():
    ids = np.random.default_rng(1).integers(0, 900, 3000).astype(np.uint16)
    ids[500:900] = 7
    matrix = wavelet.WaveletMatrix.build(ids)
    assert (matrix.decode() == ids).all()
    for i in (0, 511, 512, 513, 2999):
        assert matrix.access(i) == ids[i]
    for symbol in (7, int(ids[0]), 901):
        places = np.flatnonzero(ids == symbol)
        assert matrix.count(symbol) == len(places) and matrix.count(symbol, 100, 700) == (ids[100:700] == symbol).sum()
        assert [matrix.locate(symbol, k) for k in range(min(5, len(places)))] == places[:5].tolist()
    with pytest.raises(IndexError):
        matrix.locate(901, 0)


def test_mixing(spark, odd, none, real):
    for docs in (real, odd):
        rows = mixing.mix_sizes(docs).collect()
        assert sorted(rows) == sorted(mixing.mix_sizes(docs).collect()) if docs is real else True
        sizes = docs.select("source", mixing.count_words(F.col("text")).alias("size"))
        words = Counter()
        for r in sizes.collect():
            words[r.source] += r["size"]
        names = sorted((s for s in words if s is not None)) + [s for s in words if s is None]
        weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
        left, free, target = 1.5 * sum(words.values()), set(names), {}
        while free:
            share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
            over = [s for s in free if share[s] > 2 * words[s]]
            if not over:
                target |= share
                break
            for s in over:
                target[s] = 2.0 * words[s]
                left -= target[s]
                free.discard(s)
        taken, goal = Counter(), {}
        for r in rows:
            assert 0 <= r.taken <= 2 * r["size"]
            taken[r.source_size, round(r.target, 3)] += r.taken
            goal[r.source_size, round(r.target, 3)] = r.target
        assert sorted(round(v, 3) for v in target.values()) == pytest.approx(sorted(k[1] for k in goal))
        largest = max(r["size"] for r in rows)
        assert all(abs(taken[k] - goal[k]) <= largest for k in goal)
    assert mixing.mix_sizes(none).count() == 0
    mixed = mixing.mix(odd)
    assert mixed.columns == odd.columns


def test_quality(spark, odd, none):
    folder = "/root/testdata/sf0.01"  # the smallest tables hold too few labels
    real, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    model = quality.learn(real, labels.filter(learning_row("doc_id", 5, 0)))
    scored = quality.score(real, model, ["doc_id"]).join(labels, "doc_id").filter(~learning_row("doc_id", 5, 0))
    rows = scored.collect()
    assert np.mean([(r.score >= quality.THRESHOLD) == r.quality for r in rows]) > 0.9
    found = quality.score(odd, model, ["doc_id"]).collect()
    assert len(found) == odd.count() and all(0 <= r.score <= 1 for r in found)
    untaught = quality.learn(odd, labels.limit(0))
    assert {r.score for r in quality.score(odd, untaught, ["doc_id"]).collect()} == {0.5}
    # One labelled id may hold a third of all rows: about ``sample`` documents are learnt from.
    hot = real.unionByName(real.limit(1).crossJoin(spark.range(500)).drop("id"))
    seen, kept = [], quality.AdditiveModel
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(quality, "AdditiveModel", lambda x, y: seen.append(len(x)) or kept(x, y))
        quality.learn(hot, labels.limit(0).unionByName(labels.join(real.limit(1).select("doc_id"), "doc_id", "right").select(*labels.columns).fillna(1)), sample=60)
    assert 20 < seen[0] < 140
    assert quality.keep_accepted(odd, untaught).columns == odd.columns
    assert quality.score(none, model, ["doc_id"]).count() == 0


def plain_components(texts, size, percent):
    sets = {}
    for i, t in texts.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", lowered(t))
        sets[i] = {tuple(w[k : k + size]) for k in range(len(w) - size + 1)} or ({tuple(w)} if w else set())
    root = {i: i for i in sets}
    for i in sorted(sets):
        for j in sorted(sets):
            if j < i and sets[i] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                a, b = sorted((root[i], root[j]))
                root = {k: a if v == b else v for k, v in root.items()}
    return {i: (len(sets[i]), root[i]) for i in sets}


def test_ngram_join(spark, odd, none):
    rng = np.random.default_rng(5)
    base = [f"t{x}" for x in rng.integers(0, 5000, 120)]
    texts = list(ODD)
    for _ in range(60):  # a chain of near copies, some linked only through others
        base = [w if rng.random() > 0.02 else f"n{rng.integers(1 << 30)}" for w in base]
        texts.append(" ".join(base))
    texts += [" ".join(texts[9].split()[:40]) + f" u{k} " + " ".join(f"q{k}_{i}" for i in range(90)) for k in range(20)]
    docs = rows_of(spark, texts)
    wanted = plain_components(dict(enumerate(texts)), 5, 75)
    for chunk in (ngram_join.CHUNK, 400):  # one task, or many chunks of a cluster
        found = ngram_join.join_components(docs, bucket=500, chunk=chunk)
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in found.collect()} == wanted
    once = ngram_join.first_of_each(odd)
    assert once.columns == odd.columns
    # The row without an id has the text of document 4.
    assert sorted((r.doc_id is None, r.doc_id) for r in once.collect()) == [(False, i) for i in range(8)]
    assert ngram_join.join_components(none).count() == 0
    assert ngram_join.first_of_each(none).count() == 0


def test_ngram_join_judges_rows_that_share_an_id_by_their_own_texts(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "HOT", 5)  # both ways of naming classes
    words = lambda name, n: " ".join(f"{name}{i}" for i in range(n))
    texts = [(1, words("a", 40)), (1, words("b", 400)), (2, words("a", 40)), (None, words("a", 39)), (None, words("c", 30)), (None, words("c", 30))]
    texts += [(None, None), (None, ""), (3, words("d", 9)), (3, words("e", 9)), (-5, words("b", 390))]
    texts += [(9, words("f", 50))] * 6 + [(9, words("g", 50)), (8, words("g", 48)), (7, words("h", 3))]  # one id has a third of all rows
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    by_row = plain_components({i: t for i, (_, t) in enumerate(texts)}, 5, 75)
    least = defaultdict(list)
    for i, (doc_id, _) in enumerate(texts):
        least[by_row[i][1]].append(doc_id)
    name = {c: min((x for x in ids if x is not None), default=None) for c, ids in least.items()}
    wanted = Counter((doc_id, by_row[i][0], name[by_row[i][1]]) for i, (doc_id, _) in enumerate(texts))
    assert Counter(map(tuple, ngram_join.join_components(docs).collect())) == wanted
    assert (2, 36, 1) in wanted and (1, 396, -5) in wanted
    kept = Counter(map(tuple, ngram_join.first_of_each(docs).collect()))
    first = {}
    for i, (doc_id, text) in sorted(enumerate(texts), key=lambda x: (x[1][0] is None, x[1][0] or 0)):
        first.setdefault(by_row[i][1], (doc_id, text))
    assert kept == Counter(first.values())


def test_language(spark, tiny, real):
    pages = table(spark, tiny, "pages")
    odd = spark.createDataFrame([(-1, None, None), (-2, "", ""), (-3, "no address", "<html lang='fr'>"), (-3, "no address", "<html lang='fr'>")], "page_id bigint, url string, html string")
    found = language.identify(pages.unionByName(odd), real).collect()
    assert len(found) == pages.count() + 4
    told = [r.lang == r.declared for r in found if r.page_id >= 0]
    assert np.mean(told) > 0.95 and all(0 < r.confidence <= 1 for r in found)
    assert {r.lang for r in language.identify(odd, real.limit(0)).collect()} == {None}
    assert language.identify(pages.limit(0), real).count() == 0


def test_language_learns_every_language(spark):
    # Seventy languages, each of its own letters; the last ones are the rarest.
    word = lambda i: "".join(chr(97 + (i * k + k * k) % 26) for k in range(1, 9)) + chr(97 + i % 26) + chr(97 + i // 26)
    rows = [(f"l{i:02}", " ".join([word(i)] * 20)) for i in range(70) for _ in range(2 if i < 64 else 1)]
    docs = spark.createDataFrame(rows, "lang string, text string")
    names, prior, _ = language.learn_text_model(docs)
    assert len(names) == 70 and np.exp(prior).sum() == pytest.approx(1)
    pages = [(i, f"http://h{i}.t{i}/", f"<html lang='l'>{' '.join([word(i)] * 30)}") for i in range(70)]
    found = language.identify(spark.createDataFrame(pages, "page_id bigint, url string, html string"), docs).collect()
    assert {r.page_id: r.lang for r in found} == {i: f"l{i:02}" for i in range(70)}


def test_language_fuses_as_a_plain_version(spark, tiny, real):
    odd = [(-1, None, None), (-2, "http://a.b.example.de/x", "<html lang='de'>"), (-3, "http://example.de", ""), (-4, "http://c.b.example.de/", "der die und <!-- no"), (-4, "http://c.b.example.de/", "der die und <!-- no")]
    pages = table(spark, tiny, "pages").unionByName(spark.createDataFrame(odd, "page_id bigint, url string, html string"), allowMissingColumns=True)
    names, prior, logs = language.learn_text_model(real)
    parts = language.page_parts(pages).collect()
    text, guess = [], []
    for r in parts:
        bucket, _ = language.trigrams(np.frombuffer(r.text.encode(), np.uint8), np.array([0, len(r.text.encode())]))
        text.append(logs[:, bucket].sum(1) / language.TEMPER)
        guess.append(int(np.argmax(text[-1] + prior)))
    k, s, every = len(names), language.SMOOTH, len(parts)
    one = np.eye(k)
    counts = {key: defaultdict(lambda: np.zeros(k)) for key in ("declared", "suffix", "host", "site", "domain")}
    for r, g in zip(parts, guess):
        for key, own in counts.items():
            own[r[key]] += one[g]
    total = sum(one[g] for g in guess)
    wanted = []
    for r, t, g in zip(parts, text, guess):
        labels = r.host.split(".")
        assert (r.site, r.domain, r.suffix) == (".".join(labels[-3:]), ".".join(labels[-2:]), labels[-1])
        p, seen = (total - one[g] + 1) / (every - 1 + k), set()
        for key in ("domain", "site", "host"):
            own = counts[key][r[key]] - one[g]
            if r[key] not in seen:
                p = (own + s * p) / (own.sum() + s)
            seen.add(r[key])
        value = t + np.log(p)
        for key in ("declared", "suffix"):
            if r[key]:
                own = counts[key][r[key]]
                value = value + np.log(np.maximum((own - one[g] + s * own.sum() / every) / (total + s), 1e-6))
        wanted.append((r.page_id, names[int(np.argmax(value))], 1 / np.exp(value - value.max()).sum()))
    found = sorted((r.page_id, r.lang, r.confidence) for r in language.identify(pages, real).collect())
    assert [x[:2] for x in found] == [x[:2] for x in sorted(wanted)]
    assert [x[2] for x in found] == pytest.approx([x[2] for x in sorted(wanted)], rel=1e-6)


def test_language_reads_long_unclosed_markup_once(spark):
    html = ["<!-- " * 100_000, "<script>" * 100_000, "<" * 300_000, "a <b x='1'>c</b><!-- d --> e<style>f</STYLE > g <script>h", "i < j <!-- k"]
    pages = spark.createDataFrame([(i, "", h) for i, h in enumerate(html)], "page_id bigint, url string, html string")
    found = {r.page_id: r.text.split() for r in language.page_parts(pages).collect()}
    assert [found[0], found[1], len(found[2][0]), found[3], found[4]] == [[], [], 300_000, ["a", "c", "e", "g"], ["i", "<", "j"]]


def test_language_of_a_new_host_comes_from_its_domain(spark):
    docs = spark.createDataFrame([("b", "bebe bubu bobo " * 9)] * 2 + [("a", "aka taka saka " * 9)], "lang string, text string")
    pages = [(i, f"http://h{i}.org{i}.com/", "bebe bubu bobo " * 9) for i in range(60)]
    pages += [(100 + i, "http://www.example.com/", "aka taka saka " * 9) for i in range(10)] + [(200, "http://new.example.com/", ""), (201, "http://new.other.com/", "")]
    found = {r.page_id: r.lang for r in language.identify(spark.createDataFrame(pages, "page_id bigint, url string, html string"), docs).collect()}
    assert (found[100], found[200], found[201], found[0]) == ("a", "a", "b", "b")


def test_pipeline_stages(spark, tiny, real):
    docs = real.withColumns({c: F.lit("x") for c in ("row", "part", "score", "kept", "hit", "whole")})
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, tiny)
        assert kept.columns == docs.columns
        assert 0 < kept.count()
        docs = spark.createDataFrame(kept.toArrow(), kept.schema)
    tokens = corpus_pipeline.STAGES[-1][1](spark, docs, tiny)
    assert tokens.count() == docs.count()
