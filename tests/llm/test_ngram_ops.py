"""Resampling, phrases and language-model scores against plain versions."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import brute
import numpy as np
import pyarrow as pa
import pytest
from fixture import SCHEMA, documents
from pyspark.sql import functions as F

from kinetrace.llm import lm, phrases, resampling, words

ROWS = documents(seed=5)
WORD11 = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
WORD13 = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def texts(n=60, alphabet="abABé.,!  \n\tx9", seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 300))) for _ in range(n)] + [None, "", " ", "x" * 900, "a b " * 200]


def batches(rows):
    whole = pa.record_batch([pa.array(range(len(rows))), pa.array(rows)], names=["doc_id", "text"])
    return iter([whole.slice(0, 25), whole.slice(25)])


@pytest.mark.parametrize("limit", [30, 200, 1 << 20])
def test_blocks_hold_every_word_once(limit):
    kind = words.classes(b" \t", b".,;:!?\n\x0b\x0c\r")
    for n in (1, 2, 3):
        got, want = Counter(), Counter()
        for block in words.blocks(batches(texts()), 1, kind, lambda b: b.column(0).to_pylist(), limit, 3):
            for i in block.counted(n).tolist():
                got[block.units[block.unit[i]].tag, bytes(block.data[block.at[i] : block.at[i + n] - 1])] += 1
        for doc, text in enumerate(texts()):
            for piece in re.split(r"[.,;:!?\x0A-\x0D]", brute.lower(text)):
                own = [w for w in re.split(r"[ \t]+", piece) if w]
                for i in range(len(own) - n + 1):
                    want[doc, " ".join(own[i : i + n]).encode()] += 1
        assert got == want


def resampled(rows, target, options):
    def features(text):
        own = WORD11.findall(brute.lower(text))
        return len(own), [zlib.crc32(" ".join(own[i : i + k]).encode()) % options.buckets for k in range(1, options.order + 1) for i in range(len(own) - k + 1)]

    found = [features(r[1]) for r in rows]
    s, t = Counter(b for _, f in found for b in f), Counter(b for x in target for b in features(x)[1])
    n = options.buckets
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s.total() + n) / ((s[b] + 1) * (t.total() + n)))) for b in range(n)]
    out = []
    for r, (size, f) in zip(rows, found):
        h = int(hashlib.sha256(f"{options.seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f)
        out.append((r[0], size, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((x for x in out if x[1] >= options.min_words), key=lambda x: (-x[4], x[0] is not None, x[0]))
    drawn = defaultdict(list)
    for i, x in enumerate(able[: options.percent * len(able) // 100], 1):
        drawn[x].append(i)
    return sorted(((*x, drawn[x].pop(0) if drawn[x] else None) for x in out), key=str)


@pytest.mark.parametrize("limit, options", [(words.BLOCK, resampling.Options()), (2000, resampling.Options(order=3, buckets=97, percent=35, min_words=4, seed=5))])
def test_resampling_equals_a_plain_version(spark, docs, options, limit):
    target = [ROWS[i][1] for i in range(0, 40)]
    got = resampling.resample(spark, docs, spark.createDataFrame([(i, x) for i, x in enumerate(target)], "item_id long, text string"), options, limit)
    assert sorted(map(tuple, got.collect()), key=str) == resampled(ROWS, target, options)


def test_resampling_odd_rows(spark, none):
    text = " ".join(f"w{i % 7}" for i in range(30))
    rows = [(None, text), (None, text), (1, text), (1, text), (2, None), (3, ""), (4, "one"), (5, text + " tail")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 number", "2 rank", "'x' score", "0 place")
    options = resampling.Options(percent=100)
    got = resampling.resample(spark, df, none.select("text"), options)
    assert sorted(map(tuple, got.collect()), key=str) == resampled(rows, [], options)
    assert resampling.resample(spark, none, df).count() == 0


def test_a_run_is_hashed_once(monkeypatch):
    seen = []
    monkeypatch.setattr(resampling.zlib, "crc32", lambda b, f=zlib.crc32: seen.append(bytes(b)) or f(b))
    for block in words.blocks(batches(["a b a b a b"] * 30), 1, resampling.KIND, lambda b: [None] * b.num_rows, overlap=1):
        list(resampling.runs(block, 2, 10))
    assert sorted(seen) == [b"a", b"a b", b"b", b"b a"]


def mined(rows, options):
    f, n = Counter(), Counter()
    for r in rows:
        lang = r[2] or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", brute.lower(r[1])):
            own = [w for w in re.split(r"[ \t]+", piece) if w]
            n[lang] += len(own)
            for k in range(1, options.order + 1):
                for i in range(len(own) - k + 1):
                    f[lang, *own[i : i + k]] += 1
    held = {g: a for g, a in f.items() if len(g) > 2 and a >= options.min_count}
    best = {}
    for (lang, *w), a in held.items():
        sides = [(f[lang, *w[:k]], f[lang, *w[k:]]) for k in range(1, len(w))]
        best[lang, *w] = min((options.scale * a // (x + y), k, x, y) for k, (x, y) in enumerate(sides))
    gone = set()
    for (lang, *w), a in held.items():
        for i in range(len(w)):
            for j in range(i + 2, len(w) + 1):
                if j - i < len(w) and 100 * a >= options.cover * held[lang, *w[i:j]]:
                    gone.add((lang, *w[i:j]))
    out = []
    for lang in n:
        own = sorted((-best[g][0], -held[g], " ".join(g[1:]).encode(), g) for g in held if g[0] == lang and g not in gone)
        out += [(lang, i, p.decode(), -a, best[g][2], best[g][3], n[lang], -s) for i, (s, a, p, g) in enumerate(own[: options.top], 1)]
    return sorted(out)


@pytest.mark.parametrize("limit, options", [(400, phrases.Options(min_count=3, top=25)), (words.BLOCK, phrases.Options(order=3, min_count=2, cover=50))])
def test_phrases_equal_a_plain_version(spark, options, limit):
    rng = random.Random(4)
    vocabulary = ["ein", "Ein", "été", "b", "c", "d", "new york", "new york city", "a", "a a", "x."]
    rows = [(i, rng.choice([" ", "\t", " \x0b", ", "]).join(rng.choice(vocabulary) for _ in range(rng.randint(0, 40))), rng.choice(["aa", "aa", "bb", None]), *[None] * 5) for i in range(150)]
    rows += [(1, None, "aa", *[None] * 5), (1, "", None, *[None] * 5), (7, "solo", "rare", *[None] * 5)] + [(9, "new york city hall", "aa", *[None] * 5)] * 40
    got = phrases.collocations(spark, spark.createDataFrame(rows, SCHEMA).repartition(3), options, limit)
    assert sorted(map(tuple, got.collect())) == mined(rows, options)


def test_phrases_with_a_full_bit_array_are_the_same(spark, docs, none, monkeypatch):
    """Bits set by other n-grams only let more candidates be counted."""
    options = phrases.Options(min_count=4)
    want = mined(ROWS, options)
    monkeypatch.setattr(phrases, "frequent_bits", lambda level: np.full(phrases.FILTER_BITS // 8, 255, np.uint8))
    assert sorted(map(tuple, phrases.collocations(spark, docs, options).collect())) == want and want
    assert phrases.collocations(spark, none).count() == 0


def test_phrase_scores_beyond_64_bits(spark):
    big = 1 << 45
    level = lambda rows: spark.createDataFrame([("x", p, a) for p, a in rows], "lang string, phrase string, a long")
    from kinetrace.llm.common import Scratch

    found = [level([("a", big + 3), ("b", big + 1)]), level([("a b", big)])]
    row = phrases.weakest_cuts(Scratch(spark, "test", found[0]), found, phrases.Options()).first()
    assert (row.l, row.r, row.score) == (big + 3, big + 1, 2_000_000 * big // (2 * big + 4))


def unigram(rows, options):
    tokens = [(r[0], WORD13.findall(brute.lower(r[1])) + ["\n"], zlib.crc32(("" if r[0] is None else str(r[0])).encode()) % options.folds == options.rest) for r in rows]
    c = Counter(t for _, own, held in tokens if not held for t in own)
    n, v = c.total(), len(c)
    return n, sorted(((d, held, len(own), sum(c[t] > 0 for t in own), n, round(sum(math.log10((c[t] + 1) / (n + v + 1)) for t in own), 6)) for d, own, held in tokens), key=str)


@pytest.mark.parametrize("order", [2, 3])
def test_lm_counts_and_blocks(spark, docs, none, order):
    options = lm.Options(order=order, turns=5)
    found = {}
    for limit in (3000, words.BLOCK):
        rows = lm.scores(spark, docs, options, limit).collect()
        assert sorted(((*r[:5], round(r.base_score, 6)) for r in rows), key=str) == unigram(ROWS, options)[1]
        found[limit] = {r.doc_id: r.score for r in rows}
        assert all(r.score < 0 and math.isfinite(r.score) for r in rows)
    assert all(abs(found[3000][d] - x) < 1e-6 for d, x in found[words.BLOCK].items())
    assert lm.scores(spark, none).count() == 0


def mixture(rows, options, weights):
    """p(word | word before) of order 2 by the definition, with given weights; and the vocabulary."""
    held = lambda d: zlib.crc32(str(d).encode()) % options.folds == options.rest
    one, two, before = Counter(), Counter(), Counter()
    for d, text in rows:
        if not held(d):
            own = ["<s>", *WORD13.findall(brute.lower(text)), "</s>"]
            one.update(own[1:])
            two.update(zip(own, own[1:]))
            before.update(own[:-1])
    n, v = one.total(), len(one)

    def p(word, last):
        c = before[last]
        w = weights[lm.DEPTHS + 1 + int(math.log2(c)) if c else 0]
        return w[0] / (v + 1) + w[1] * one[word] / n + (w[2] * two[last, word] / c if c else 0)

    return p, list(one)


def test_lm_scores_are_the_mixture(spark, monkeypatch):
    """Scores equal the definition, whose probabilities of all words and the unknown one add up to one."""
    weights = np.random.default_rng(3).random((2 * lm.DEPTHS, 3)) * (lm.start_weights(2) > 0)
    weights /= weights.sum(axis=1, keepdims=True)
    monkeypatch.setattr(lm, "learn_weights", lambda *a: weights)
    rows = [(r[0], r[1]) for r in ROWS]
    p, known = mixture(rows, lm.Options(), weights)
    got = lm.scores(spark, spark.createDataFrame(rows, "doc_id long, text string").repartition(3), limit=4000).collect()
    for r in got:
        own = ["<s>", *WORD13.findall(brute.lower(rows[r.doc_id][1])), "</s>"]
        assert abs(sum(math.log10(p(w, v)) for v, w in zip(own, own[1:])) - r.score) < 1e-6
    for last in ["<s>", known[0], known[5], "never seen"]:
        assert abs(sum(p(w, last) for w in [*known, "never seen"]) - 1) < 1e-9


def test_lm_learns_weights_that_fit_held_out_text(spark):
    rng = random.Random(2)
    follow = {w: rng.sample("abcdefghij", 2) for w in "abcdefghij"}

    def line():
        out = [rng.choice("abcdefghij")]
        while rng.random() < 0.9:
            out.append(rng.choice(follow[out[-1]]))
        return " ".join(out)

    rows = [(i, line()) for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    learned, even = (lm.scores(spark, docs, lm.Options(turns=t)).where("held_out").agg(F.sum("score"), F.sum("base_score"), F.sum("n_tokens")).first() for t in (20, 0))
    assert learned[0] > even[0] + 0.02 * learned[2] and learned[0] > learned[1] + 0.2 * learned[2]


def test_lm_reads_few_rows_at_a_time(spark):
    key = "spark.sql.parquet.columnarReaderBatchSize"
    before = spark.conf.get(key)
    with lm.batches_of(spark, 256):
        assert int(spark.conf.get(key)) == lm.READ_ROWS
    assert spark.conf.get(key) == before


def test_long_rows_are_stored_in_small_row_groups(spark):
    from pyarrow import parquet

    from kinetrace.llm.common import Scratch

    scratch = Scratch(spark, "long", spark.range(1))
    made = lambda frames: (d.assign(b=[np.random.default_rng(i).bytes(1 << 20) for i in d["id"]]) for d in frames)
    rows = spark.range(0, 60, 1, 1).mapInPandas(made, "id long, b binary")
    stored = scratch.store(rows, "rows", long_rows=True)
    files = [f.removeprefix("file://") for f in stored.inputFiles()]
    groups = [parquet.ParquetFile(f).metadata.row_group(i).num_rows for f in files for i in range(parquet.ParquetFile(f).metadata.num_row_groups)]
    assert sum(groups) == 60 and max(groups) <= 40
    assert stored.agg(F.sum("id"), F.min(F.length("b"))).first()[:] == (1770, 1 << 20)


def test_lm_packed_values(spark):
    for kind in (np.int32, np.int64):
        for values in ([7], [0] * 5000, [1, -1, np.iinfo(kind).max, np.iinfo(kind).min]):
            assert lm.unplaned(lm.planes(np.array(values, kind)), kind).tolist() == values
    assert len(lm.planes(np.ones(100_000, np.int64))) < 1000


def test_lm_odd_rows(spark):
    rows = [(None, "a b"), (None, None), (1, "a b c"), (1, "a b c"), (2, ""), (3, " \n "), (4, "w" * 5000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 block", "2 role", "'x' score", "0 doc")
    options = lm.Options()
    got = lm.scores(spark, df, options, 100)
    assert sorted(((*r[:5], round(r.base_score, 6)) for r in got.collect()), key=str) == unigram(rows, options)[1]
    held = [i for i in range(50) if zlib.crc32(str(i).encode()) % 7 == 2][:2]
    alone = lm.scores(spark, df.where("false").unionByName(spark.createDataFrame([(i, "a b") for i in held], "doc_id long, text string"), allowMissingColumns=True))
    assert [tuple(r)[2:] for r in alone.collect()] == [(3, 0, 0, 0.0, 0.0)] * 2
    assert alone.count() == 2 and isinstance(alone.agg(F.sum("score")).first()[0], float)
