"""Alignment, packing and lexical search against plain versions."""

import hashlib
import math
import re
import zlib
from bisect import bisect_right
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from trendmark.llm import alignment, lexical, packing, queries
from trendmark.llm.common import table
from trendmark.llm.piece_table import PieceTable
from trendmark.llm.tokens import listed, word_tokenizer

BYTE, WORD, PIECE = (public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"))
SCHEMA = "doc_id bigint, text string, key string, part string, length string, score string, item string, ids string"
LONG = " ".join(f"w{i % 997}x{i % 13}" for i in range(9_000))
ODD = [
    "", None, " \t\n", "a", "B b", "Été — naïve x", LONG, "the same words here again", "the same words here again", "it's <s>x</s> <|endoftext|> 12,345",
    "a▁b", "tabs\t\tand  spaces \n\n;\r\n end ", "中文 and 😀😀   x", "Ɗan H̱ ǅ",
]


@pytest.fixture(scope="module")
def odd(spark):
    """Odd texts, one row three times, two texts under one id and two rows without an id."""
    rows = [(i, t) for i, t in enumerate(ODD)] + [(7, ODD[7])] * 2 + [(4, "other words"), (None, "no id"), (None, "no id")]
    return spark.createDataFrame([(*r, "k", "p", "l", "s", "i", "x") for r in rows], SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def test_word_ids_are_the_library_s():
    library, own = Tokenizer.from_file(WORD), word_tokenizer(WORD)
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = [" ".join(f"a{c}'s{c}1" for c in points[i : i + 8]) for i in range(0, len(points), 8)]
    rng = np.random.default_rng(3)
    some = [" ", "  ", "\n", "\x1c", "\x85", "\xa0", "a", "B", "É", "İ", "Σ", "'s", "'LL", "'", "'stop", "12", "Ɗ", "中", "😀", "̀", "\x00", "H̱", "≠", ".", "ǅ", *points[0xC0:0x250]]
    texts += ["".join(rng.choice(some, rng.integers(30))) for _ in range(10_000)]
    texts += ["".join(rng.choice([*some[:25], "<|endoftext|>", "<|ENDOFTEXT|>", "<|"], rng.integers(20))) for _ in range(1_000)]
    ids, bounds = own.ids(pa.array([*texts, None, ""]), 2)
    wanted = [[*e.ids, 2] for e in library.encode_batch_fast(texts, add_special_tokens=False)] + [[2], [2]]
    assert (bounds == np.cumsum([0, *map(len, wanted)])).all()
    assert (ids == np.concatenate(wanted)).all()


def test_piece_table_starts_anew_when_full():
    made = []

    def values(pieces):
        made.append(len(pieces))
        return [listed([list(p) for p in pieces])]

    own = PieceTable(values, pieces=4, room=30)
    rng = np.random.default_rng(0)
    for size in (3, 3, 40, 2, 5):  # also more pieces at once than the table holds
        words = [bytes(rng.integers(97, 100, rng.integers(1, 6)).astype(np.uint8)) for _ in range(size)]
        ends = np.cumsum([len(w) for w in words])
        data = np.frombuffer(b"".join(words), np.uint8)
        hashes = np.array([hash(w) % (1 << 64) for w in words], np.uint64)
        entries = own.entries(hashes, data, ends - [len(w) for w in words], ends)
        lengths, flat = own.lists[0].gather(entries)
        assert lengths.tolist() == [len(w) for w in words] and bytes(flat.astype(np.uint8)) == b"".join(words)


def plain_alignment(texts):
    """Of each text: tokens, groups as text, links as pairs of ids."""
    a_tokenizer = Tokenizer.from_file(BYTE)
    a_tokenizer.encode_special_tokens = True
    b_tokenizer = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in visible)}
    out = []
    for text in texts:
        a = a_tokenizer.encode(" " + (text or ""), add_special_tokens=False).ids
        b = b_tokenizer.encode(text or "")
        a_bytes = [bytes(byte_of[c] for c in a_tokenizer.id_to_token(i)) for i in a]
        b_bytes = [bytes([int(p[3:5], 16)]) if re.fullmatch("<0x..>", p) else p.replace("▁", " ").encode() for p in map(b_tokenizer.id_to_piece, b)]
        whole = (" " + (text or "")).encode()
        if not text or b"".join(a_bytes) != whole or b"".join(b_bytes) != whole:
            out.append(([], [], "", 0, []))
            continue
        place = lambda parts: [(x, x + len(p)) for x, p in zip(np.cumsum([0, *map(len, parts)]).tolist(), parts)]
        a_at, b_at = place(a_bytes), place(b_bytes)
        ends = sorted({y for _, y in a_at} & {y for _, y in b_at})
        inside = [([], []) for _ in ends]
        for side, ids, at in ((0, a, a_at), (1, b, b_at)):
            for i, (x, _) in zip(ids, at):
                inside[bisect_right(ends, x)][side].append(str(i))
        groups = ["|".join(",".join(own) for own in both) for both in inside]
        links, k = [], 0
        for i, (x, y) in zip(a, a_at):
            while b_at[k][1] <= x:
                k += 1
            n = k
            while n < len(b) and b_at[n][0] < y:
                links.append((i, b[n]))
                n += 1
        out.append((a, b, ";".join(groups), len(groups), links))
    return out


def test_alignment(spark, odd, none, tiny):
    for docs, frequent in ((odd, 1 << 19), (odd, 40), (table(spark, tiny, "documents"), 3000)):
        rows = docs.select("doc_id", "text").collect()
        plain = plain_alignment([r.text for r in rows])
        count = Counter(link for *_, links in plain for link in links)
        highest = defaultdict(int)
        for (_, b), n in count.items():
            highest[b] = max(highest[b], n)
        wanted = Counter()
        for r, (a, b, groups, n_groups, links) in zip(rows, plain):
            digest = hashlib.sha256(groups.encode()).hexdigest() if a else ""
            best = sum(count[x] == highest[x[1]] for x in links)
            wanted[r.doc_id, len(a), len(b), n_groups, len(links), digest, best, sum(count[x] for x in links)] += 1
        own = alignment.Alignment(docs, BYTE, PIECE, frequent=frequent)
        texts = own.groups()
        found = own.with_counts(texts.withColumn("groups_sha256", F.when(F.col("n_groups") > 0, F.sha2("groups", 256)).otherwise("")))
        columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum"]
        assert Counter(map(tuple, found.select(columns).collect())) == wanted
        assert Counter(r.groups for r in found.collect()) == Counter(g for _, _, g, _, _ in plain)
    own = alignment.Alignment(none, BYTE, PIECE)
    assert own.with_counts(own.groups()).count() == 0


def test_pointer_jumping_reaches_the_end_of_long_groups():
    a, b = np.full(1000, 2), np.array([1, *[2] * 999, 1])  # no common end before the last
    group_a, group_b = alignment.Aligned(a, b).groups()
    assert set(group_a) == set(group_b) == {999}
    assert len(alignment.Aligned(a, b).links()[0]) == 2000
    group_a, group_b = alignment.Aligned(np.array([1, 2, 3]), np.array([3, 1, 2])).groups()
    assert group_a.tolist() == [1, 1, 2] and group_b.tolist() == [1, 2, 2]


def checked_plan(lengths, capacity):
    """How many sequences the plan takes, after a check that pieces fill them without gaps."""
    values, counts = np.unique(lengths, return_counts=True)
    plan = packing.Plan(dict(zip(values.tolist(), counts.tolist())), capacity)
    filled, placed = defaultdict(list), Counter()
    for length, rank, n, sequence, each, offset in sorted(plan.lines):
        assert rank == placed[length]  # the runs of a length follow each other
        placed[length] += n
        for i in range(n):
            filled[sequence + i // each].append((offset + i % each * length, length))
    assert placed == dict(zip(values.tolist(), counts.tolist()))
    for parts in filled.values():
        parts.sort()
        assert [o for o, _ in parts] == np.cumsum([0, *(n for _, n in parts)])[:-1].tolist() and sum(n for _, n in parts) <= capacity
    assert len(filled) == plan.sequences
    return plan.sequences


def least_sequences(lengths, capacity):
    """The fewest sequences, by trying."""
    best = len(lengths)

    def put(i, room):
        nonlocal best
        if len(room) >= best:
            return
        if i == len(lengths):
            best = len(room)
            return
        for r in {x: k for k, x in enumerate(room) if x >= lengths[i]}.values():
            put(i + 1, [x - lengths[i] * (k == r) for k, x in enumerate(room)])
        put(i + 1, [*room, capacity - lengths[i]])

    lengths = sorted(lengths, reverse=True)
    put(0, [])
    return best


def best_fit(lengths, capacity):
    """Sequences that best fit takes, piece by piece from the longest down."""
    room = []
    for n in sorted(lengths, reverse=True):
        fits = [k for k, x in enumerate(room) if x >= n]
        if fits:
            room[min(fits, key=lambda k: room[k])] -= n
        else:
            room.append(capacity - n)
    return len(room)


def test_packing_plan():
    rng = np.random.default_rng(1)
    for _ in range(60):  # above a third: the fewest there are
        lengths = rng.integers(11, 31, rng.integers(1, 9)).tolist()
        assert checked_plan(lengths, 30) == least_sequences(lengths, 30)
    for _ in range(20):
        lengths = rng.integers(1, 31, rng.integers(1, 10)).tolist()
        assert checked_plan(lengths, 30) <= least_sequences(lengths, 30) + 1
    for high in (12, 60, 100):
        lengths = rng.integers(1, high + 1, 700).tolist()
        assert checked_plan(lengths, 100) <= best_fit(lengths, 100) + 1
    assert checked_plan(rng.integers(1, 4097, 40_000), 4096) < 40_000 * 2048.5 / 4096 * 1.005
    assert checked_plan([1], 1) == 1 and checked_plan([4096] * 3, 4096) == 3
    assert packing.Plan({}).sequences == 0


def test_packing(spark, odd, none, tiny):
    library = Tokenizer.from_file(WORD)
    for docs, capacity in ((odd, 50), (odd, 4096), (table(spark, tiny, "documents"), 256)):
        found = packing.pack(docs.repartition(3), WORD, 1, capacity).withColumn("ids_crc32", F.crc32("ids")).collect()
        wanted, total = Counter(), 0
        for r in docs.select("doc_id", "text").collect():
            ids = [*library.encode(r.text or "", add_special_tokens=False).ids, 1]
            total += len(ids)
            for piece, a in enumerate(range(0, len(ids), capacity)):
                own = ids[a : a + capacity]
                wanted[r.doc_id, piece, a, len(own), zlib.crc32(np.array(own, "<u4").tobytes())] += 1
        assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == wanted
        filled = defaultdict(list)
        for r in found:
            filled[r.sequence_id].append((r.offset, r.length))
        for parts in filled.values():
            parts.sort()
            assert [o for o, _ in parts] == np.cumsum([0, *(n for _, n in parts)])[:-1].tolist()
            assert sum(n for _, n in parts) <= capacity
        lengths = [k[3] for k, n in wanted.items() for _ in range(n)]
        assert len(filled) == packing.Plan(Counter(lengths), capacity).sequences <= max(-(-total // capacity) * 1.1 + 1, 2)
    assert packing.pack(none, WORD).count() == 0


def plain_search(docs, items, k):
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    words = lambda t: pattern.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    terms = [(i, Counter(words(t))) for i, t in docs]
    holding = Counter(w for _, c in terms for w in c)
    n, total = sum(bool(c) for _, c in terms), sum(sum(c.values()) for _, c in terms)
    out = Counter()
    for item, text in items:
        asked, scored = Counter(words(text)), []
        for doc_id, c in terms:
            m = 100 - 25 + (25 * sum(c.values()) * n) // max(total, 1)
            score = sum(r * math.floor(1000 * math.log((2 * n + 2) / (2 * holding[w] + 1))) * (10**9 * c[w] // (1000 * c[w] + 12 * m)) for w, r in asked.items() if w in c)
            if score:
                scored.append((-score, doc_id is None, doc_id or 0))
        for rank, (score, missing, doc_id) in enumerate(sorted(scored)[:k], 1):
            out[item, rank, None if missing else doc_id, -score] += 1
    return out


def test_lexical_search(spark, odd, none, tiny, monkeypatch):
    more = spark.createDataFrame([(100 + i, f"same Same words t{i % 3} été") for i in range(90)], "doc_id bigint, text string")
    docs = odd.select("doc_id", "text").unionByName(more)
    texts = ["same words", "été Same same same NAÏVE", "", None, "-- !", "unknown", "t1 x b x12x3", " ".join(f"w{i}x{i % 13}" for i in range(300)), "no id"]
    items = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)] + [(1, "again", 1), (None, "b", 1)], "item_id bigint, text string, rank int")
    monkeypatch.setattr(lexical, "DOCS", 7)
    monkeypatch.setattr(lexical, "ITEMS", 3)
    for k, block in ((20, lexical.BLOCK), (3, 5)):
        found = lexical.search(docs, items, k, block)
        assert found.columns == ["item_id", "rank", "doc_id", "score"]
        plain = plain_search([tuple(r) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()], k)
        assert Counter(map(tuple, found.collect())) == plain
    real, bench = table(spark, tiny, "documents"), table(spark, tiny, "benchmark")
    plain = plain_search([(r.doc_id, r.text) for r in real.collect()], [(r.item_id, r.text) for r in bench.collect()], 20)
    assert Counter(map(tuple, queries.op13_lexical_search(spark, tiny).collect())) == plain
    assert lexical.search(docs, items.limit(0)).count() == 0
    assert lexical.search(none, items).count() == 0


def test_partial_sums_stay_exact():
    rng = np.random.default_rng(2)
    matrix = rng.integers(0, 50, (4, 9))
    matrix[1, 3] = 1000  # more than a part may hold
    parts = lexical.exact_parts(matrix, exact=120)
    again = np.zeros_like(matrix)
    for columns, weights in parts:
        assert (weights.sum(1) < 120).all()
        for i, column in enumerate(columns):
            again[:, column] += weights[:, i].astype(int)
    assert (again == matrix).all()


def test_best_keeps_ties_by_id():
    best = lexical.Best(1, 3)
    for ids in ([9, 8], [7, 1, 5], [3]):
        ids = np.array(ids)
        best.add(0, np.full((1, len(ids)), 4), ids, np.zeros(len(ids), bool))
    assert best.doc_id.tolist() == [1, 3, 5]
