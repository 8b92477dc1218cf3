"""Private data, collocations and hard negatives against brute force and held-out windows."""

import hashlib
import itertools
import math
import re
import time
from collections import Counter
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from orderloom.llm import collocations, negatives, pii
from orderloom.llm.tagger import Tagger

SCHEMA = "doc_id long, text string, lang string, source string, row string, kind string, spans string, place string"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, lang, "s", "r", "k", "x", "p") for i, t, lang in rows], SCHEMA)


# Private data

BASE_PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute_luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = d * 2 if i % 2 else d
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def brute_base(text):
    found = []
    for order, (kind, pattern) in enumerate(BASE_PATTERNS.items()):
        for m in re.finditer(pattern, text):
            digits = [int(c) for c in m.group() if c in "0123456789"]
            if kind == "ip" and max(map(int, m.group().split("."))) > 255:
                continue
            if kind == "card" and not (12 <= len(digits) <= 19 and brute_luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            found.append((m.start(), order, f"{kind}:{m.start()}:{m.end()}"))
    return [x for *_, x in sorted(found)]


def numbered_texts(count, seed):
    random = np.random.default_rng(seed)

    def card():
        digits = random.integers(0, 10, 15).tolist()
        return "".join(map(str, [*digits, next(c for c in range(10) if brute_luhn([*digits, c]))]))

    words = "the garden of a house and river is old but not very far from this town".split()
    makers = (
        lambda: f"{random.choice(words)}.{random.integers(99)}@{random.choice(words)}-{random.integers(9)}.example.com",
        lambda: ".".join(str(x) for x in random.integers(0, 256, 4)),
        card,
        lambda: f"+1 ({random.integers(100, 999)}) 555-{random.integers(1000, 9999)}",
    )
    for i in range(count):
        text = " ".join(random.choice(words, 30))
        middle = makers[i % 5]() if i % 5 < 4 else f"in {random.integers(1900, 2024)} or {random.integers(10**5)}"
        yield f"{text} {middle} {' '.join(random.choice(words, 30))}"


AWKWARD = [
    (0, None, "en"),
    (1, "", "en"),
    (2, "1.2.3.4.5.6.7.8.9 and 1.2.3.999.1.2.3.4 and 007.0.0.1", None),
    (3, "a@b.c.d@e.f @x.y g@h a.b@c-d.e.", "en"),
    (4, "é漢😀 me@here.org 4111 1111-1111 1111, 4111 1111 1111 1112", "fr"),
    (4, "é漢😀 me@here.org 4111 1111-1111 1111, 4111 1111 1111 1112", "fr"),
    (5, "+49 (30) 123-4567.8 +1 ((( +12345678 +1234567890123456", "de"),
    (6, "9" * 3000 + "." * 50 + "x" * 3000 + "@" * 50, "en"),
    (None, "call +1 (555) 555-1234 63.51.2.9", "en"),
    (7, ("word " * 3000 + "me@far.example.org ") * 3, "en"),
]


def test_base_spans_equal_the_patterns():
    random = np.random.default_rng(1)
    texts = [t or "" for _, t, _ in AWKWARD]
    texts += ["".join(random.choice(list("0123456789.@+- ()a%é"), 60)) for _ in range(4000)]
    texts += list(numbered_texts(100, 2))
    for text in texts:
        assert [f"{k}:{a}:{b}" for k, a, b in pii.base_spans(text)] == brute_base(text), text


def test_private_digest(spark):
    rows = AWKWARD + [(100 + i, t, "en") for i, t in enumerate(numbered_texts(400, 3))]
    found = pii.private_digest(spark, docs_of(spark, rows)).collect()
    assert len(found) == len(rows)
    text_of = {i: t or "" for i, t, _ in rows}
    for r in found:
        base = brute_base(text_of[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(x.startswith(k) for x in base) for k in BASE_PATTERNS]
        spans = r.spans.split(",") if r.spans else []
        assert not Counter(base) - Counter(spans) and len(spans) == len(base) + r.n_added
    assert pii.private_digest(spark, docs_of(spark, [])).count() == 0


@pytest.fixture(scope="module")
def model():
    return pii.fit([x for t in numbered_texts(1500, 4) for x in pii.examples_of(t)])


def test_every_window_of_a_text_is_decoded(model):
    class Seen:
        def __init__(self):
            self.windows = []
            self.follow = model.tagger.follow

        def decode(self, ids):
            self.windows.append(ids)
            return model.tagger.decode(ids)

    texts = ["plain words without any mark " * 40, "", "x", "write to someone at example.org today " * 3]
    seen = Seen()
    replace(model, tagger=seen).added(texts, [[] for _ in texts])
    windows = np.concatenate(seen.windows)
    whole = 0
    for text in texts:
        starts = pii.window_starts(pii.codes_of(text)).tolist()
        assert {i for a in starts for i in range(a, min(a + pii.WINDOW, len(text)))} == set(range(len(text)))
        whole += len(starts)
    assert len(windows) == whole == 36 + 0 + 1 + 3


def test_decoding_of_blocks_is_that_of_all_paths(model):
    ids, _ = pii.training_windows([x for t in numbered_texts(600, 3) for x in pii.examples_of(t)])
    assert len(ids) > 512
    path, e = model.tagger.decode(ids)
    slow = model.tagger._emissions(model.tagger._run(ids, False)[0])
    assert np.allclose(e, slow, atol=1e-3)
    assert (path == model.tagger._best_paths(e)).all() and (path > 0).any()


def test_decoding_takes_less_time_than_the_plain_network(model):
    ids = np.random.default_rng(5).integers(1, 129, (512, pii.WINDOW)).astype(np.uint8)
    shares = []
    for _ in range(9):
        begin = time.thread_time()
        model.tagger._run(ids, False)
        middle = time.thread_time()
        model.tagger.emissions(ids)
        shares.append((time.thread_time() - middle) / (middle - begin))
    # 0.8 of it when gates were slices of one array, 0.5 since each has its own.
    assert sorted(shares)[4] < 0.66


def test_the_tagger_finds_disguised_spans(model):
    assert model.precision >= pii.PRECISION and model.recall > 0.8
    text = "the garden and river (555) 555-0143 is old but not very far, " + "a house " * 30 + "jo.3@river-4[.]example"
    text += " mail to town.55 (at) house-3.example.com and then of a garden in 1984 or 77012"
    added = model.added([text], [pii.base_spans(text)])[0]
    said = {(k, text[a:b]) for k, a, b in added}
    assert ("phone", "(555) 555-0143") in said
    assert ("email", "town.55 (at) house-3.example.com") in said
    clean = ["the garden of a house is old. " * 40, "in 1984 or 77012 but not far. " * 40, ""]
    assert model.added(clean, [[], [], []]) == [[], [], []]


def test_few_examples_leave_the_base_alone(spark):
    assert pii.fit([]) is None
    assert pii.learn(spark, docs_of(spark, AWKWARD)) is None


def test_gradients_and_paths():
    random = np.random.default_rng(0)
    allowed = np.ones((3, 3), dtype=bool)
    allowed[0, 2] = False
    tagger = Tagger(6, allowed, hidden=3, seed=1)
    tagger.weights = {k: w + random.normal(0, 0.4, w.shape) for k, w in tagger.weights.items()}
    ids, tags = random.integers(0, 6, (3, 5)), np.array([[0, 1, 2, 2, 0], [1, 1, 0, 0, 1], [2, 0, 1, 2, 2]])
    value, slopes = tagger.loss(ids, tags)
    e = tagger.emissions(ids)

    def score(n, path):
        w = tagger.weights
        s = w["first"][path[0]] + w["last"][path[-1]] + sum(e[n, t, k] for t, k in enumerate(path))
        return s + sum(tagger.follow()[a, b] for a, b in zip(path, path[1:]))

    every = list(itertools.product(range(3), repeat=5))
    total = [math.log(sum(math.exp(score(n, p)) for p in every)) for n in range(3)]
    assert math.isclose(value, sum(total[n] - score(n, tags[n]) for n in range(3)) / 3, rel_tol=1e-4)
    best = tagger.decode(ids)[0]
    assert [tuple(x) for x in best.tolist()] == [max(every, key=lambda p, n=n: score(n, p)) for n in range(3)]
    for name, w in tagger.weights.items():
        for _ in range(6):
            at = tuple(random.integers(0, n) for n in w.shape)
            old = w[at]
            sides = []
            for step in (1e-3, -1e-3):
                w[at] = old + step
                sides.append(tagger.loss(ids, tags)[0])
            w[at] = old
            assert math.isclose((sides[0] - sides[1]) / 2e-3, slopes[name][at], rel_tol=2e-2, abs_tol=2e-4), name


def test_windows_are_reconciled():
    def span(kind, start, end, gain, cut=False):
        return pii.Found(kind, start, end, gain, cut)

    # Seen twice; cut in one window, whole in the next; in conflict, the larger sum wins.
    assert pii.reconciled([span(0, 5, 9, 1.0), span(0, 5, 9, 2.0)], []) == [span(0, 5, 9, 2.0)]
    assert pii.reconciled([span(0, 50, 64, 3.0, True), span(0, 50, 70, 1.0)], []) == [span(0, 50, 70, 1.0)]
    long = pii.reconciled([span(0, 10, 64, 2.0, True), span(0, 32, 96, 2.0, True), span(0, 64, 100, 2.0, True)], [])
    assert [(f.start, f.end) for f in long] == [(10, 100)]
    some = [span(0, 0, 10, 1.0), span(1, 8, 20, 1.5), span(2, 20, 30, 1.0), span(3, 5, 25, 0.9)]
    assert [f.kind for f in pii.reconciled(some, [])] == [1, 2]
    assert [f.kind for f in pii.reconciled(some, [(9, 12)])] == [2]
    random = np.random.default_rng(3)
    for _ in range(200):
        some = [span(int(k), int(a), int(a + n), float(g)) for k, a, n, g in zip(random.integers(0, 4, 7), random.integers(0, 30, 7), random.integers(1, 12, 7), random.random(7) + 0.1)]
        unique = {}
        for f in some:
            key = (f.kind, f.start, f.end)
            unique[key] = max(unique.get(key, f), f, key=lambda x: x.gain)
        some = list(unique.values())
        fits = lambda own: all(a.end <= b.start or b.end <= a.start for a, b in itertools.combinations(own, 2))
        sums = [sum(f.gain * (f.end - f.start) for f in own) for n in range(8) for own in itertools.combinations(some, n) if fits(own)]
        chosen = pii.reconciled(some, [])
        assert fits(chosen) and math.isclose(sum(f.gain * (f.end - f.start) for f in chosen), max(sums))


# Collocations


def brute_collocations(rows, least, top):
    counts, totals = {}, Counter()
    for _, text, lang in rows:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang or "und"] += len(words)
            for k in range(1, 6):
                for i in range(len(words) - k + 1):
                    key = (lang or "und", tuple(words[i : i + k]))
                    counts[key] = counts.get(key, 0) + 1
    out = []
    candidates = {key: a for key, a in counts.items() if len(key[1]) >= 2 and a >= least}
    longer = Counter()
    for (lang, words), a in candidates.items():
        for size in range(2, len(words)):
            for i in range(len(words) - size + 1):
                key = (lang, words[i : i + size])
                longer[key] = max(longer[key], a)
    for (lang, words), a in candidates.items():
        if longer[lang, words] >= a:
            continue
        cuts = [(1000 * a * totals[lang] // (counts[lang, words[:k]] * counts[lang, words[k:]]), k) for k in range(1, len(words))]
        score, k = min(cuts)
        out.append((lang, " ".join(words), a, counts[lang, words[:k]], counts[lang, words[k:]], totals[lang], score))
    ranked = []
    for lang in {x[0] for x in out}:
        own = sorted((x for x in out if x[0] == lang), key=lambda x: (-x[6], -x[2], x[1].encode()))
        ranked += [(lang, i + 1, *x[1:]) for i, x in enumerate(own[:top])]
    return sorted(ranked)


@pytest.mark.parametrize("run_words", [7, 1_000_000])
def test_collocations(spark, monkeypatch, run_words):
    monkeypatch.setattr(collocations, "RUN_WORDS", run_words)
    random = np.random.default_rng(4)
    words = [f"W{i}" for i in range(12)] + ["é", "naïve", "a\x1cb", "漢字", "und"]
    rows = [(i, " ".join(random.choice(words, 25)) + random.choice([".", "!", "\n", "\t"]), ["en", "fr", None][i % 3]) for i in range(150)]
    rows += [(i, "Once upon a TIME, there was; a hot passage here\rOnce upon a time", "en") for i in range(40)]
    rows += [(900, None, "en"), (901, "", None), (902, " .,; ", "xx"), (903, "lone", "yy"), (None, "x y x y x y " * 2000, "en"), (904, "z z z z z z z", "zz")]
    docs = docs_of(spark, rows).repartition(3)
    for least, top in ((3, 50), (6, 2000)):
        found = collocations.collocations(spark, docs, least, top).collect()
        assert sorted(tuple(r) for r in found) == brute_collocations(rows, least, top)
    assert collocations.collocations(spark, docs_of(spark, []), 3).count() == 0
    assert collocations.collocations(spark, docs, 10**6).count() == 0


def test_quicksort_counts_equal_partitions():
    random = np.random.default_rng(5)
    keys = random.integers(0, 4, (500, 5))
    for row, n in zip(keys, random.integers(1, 6, 500)):
        row[n:] = -1
    weight = random.integers(1, 9, 500)
    expected = Counter()
    for row, w in zip(keys.tolist(), weight.tolist()):
        for n in range(1, 6):
            if row[n - 1] >= 0:
                expected[tuple(row[:n])] += w
    found = {tuple(keys[row, :n].tolist()): total for row, n, total in collocations.frequent_prefixes(keys, weight, 20)}
    assert found == {k: w for k, w in expected.items() if w >= 20}


def test_the_filter_never_denies_a_frequent_pair(spark):
    pairs = [("en", f"a{i} b{i % 7}") for i in range(3000)] + [("é", "x y")]
    frame = spark.createDataFrame(pairs, "lang string, phrase string")
    held = collocations.frequent_pairs(frame, len(pairs))
    for lang, phrase in pairs:
        one, two = collocations._word_hashes(collocations.pa.array([w.encode() for w in phrase.split(" ")]))
        assert held.holds(collocations._pair_hashes(lang, np.array([one]), np.array([two])))[0]
    other = np.random.default_rng(0).integers(0, 2**63, 20_000).astype(np.uint64)
    assert held.holds(other).mean() < 0.1


def test_exact_products_pass_64_bits(spark):
    huge = 3 * 10**12
    counts = spark.createDataFrame([("en", 0, "", 10**13), ("en", 1, "a", huge), ("en", 1, "b", huge), ("en", 2, "a b", huge - 1)], collocations.COUNTS)
    assert collocations.scored_phrases(counts).first()["score"] == 1000 * (huge - 1) * 10**13 // huge**2


# Hard negatives

VECTORS = "id long, label int, embedding array<double>, place long, block string, score string"


def brute_negatives(rows, every, positives, negatives_, low, high):
    usable = []
    for n, (i, label, vector) in enumerate(rows):
        if label is None or not vector or any(x is None or not math.isfinite(x) for x in vector):
            continue
        whole = [math.floor(256 * x) for x in vector]
        if sum(x * x for x in whole) < negatives.MOST_SQUARES:
            usable.append((n, i, label, whole))
    out = []
    for n, i, label, vector in usable:
        if i is None or i % every:
            continue
        others = [(sum(map(lambda x, y: x * y, vector, w)), math.inf if j is None else j, m, k) for m, j, k, w in usable if m != n and len(w) == len(vector)]
        others.sort(key=lambda x: (-x[0], x[1]))
        for p in [x for x in others if x[3] == label][:positives]:
            fit = [x for x in others if x[3] != label and low * p[0] <= 100 * x[0] <= high * p[0]][:negatives_]
            out += [(i, *(None if k == math.inf else k for k in (p[1], rank + 1, x[1])), p[0], x[0]) for rank, x in enumerate(fit)]
    return Counter(out)


@pytest.mark.parametrize("block", [7, 65_536])
def test_hard_negatives(spark, monkeypatch, block):
    monkeypatch.setattr(negatives, "BLOCK", block)
    monkeypatch.setattr(negatives, "LEAST_BLOCK", 16)
    monkeypatch.setattr(negatives, "PACKED", 5)
    random = np.random.default_rng(6)
    rows = [(i, int(random.integers(0, 4)), (random.normal(size=8) * 0.4 + 0.3).tolist()) for i in range(120)]
    rows += [(200 + i, i % 4, [0.5] * 8) for i in range(60)]  # ties: equal vectors, equal scores
    rows += [(10, 1, rows[3][2]), (10, 2, rows[4][2])]  # repeated ids are rows of their own
    rows += [(300, None, [0.1] * 8), (310, 1, None), (320, 1, []), (330, 1, [None] * 8), (340, 1, [math.nan] * 8), (350, 1, [math.inf] * 8)]
    rows += [(360, 1, [1e300] * 8), (370, 1, [0.1, 0.2]), (371, 2, [0.1, 0.1]), (372, 1, [0.2, 0.2]), (None, 1, [0.4] * 8)]
    rows += [(380, 3, [4e5, -4e5] * 4), (381, 3, [4e5, -3e5] * 4), (382, 2, [4e5, 4e4] * 4)]
    frame = spark.createDataFrame([(*r, 1, "b", "s") for r in rows], VECTORS)
    found = negatives.hard_negatives(spark, frame, F.col("id") % 10 == 0, 5, 6, 30, 90).collect()
    assert Counter(tuple(r) for r in found) == brute_negatives(rows, 10, 5, 6, 30, 90)
    assert negatives.hard_negatives(spark, frame.limit(0), F.col("id") % 10 == 0).count() == 0
    assert negatives.hard_negatives(spark, frame, F.col("id") == -5).count() == 0


@pytest.mark.parametrize("most", [1, 200, 10**4, 2**20, 2**28])
def test_packed_scores_are_exact(most):
    random = np.random.default_rng(7)
    candidates, anchors = (random.integers(-most, most + 1, (n, 33)) for n in (41, 5))
    packed = negatives.Packed(candidates)
    bias = max(0, -int(anchors.min()))
    packed.fit(int(anchors.max()) + bias)
    for anchor in anchors:
        exact = [sum(int(x) * int(y) for x, y in zip(anchor, row)) for row in candidates]
        assert packed.scores(anchor, bias).tolist() == exact


def test_digest_moves_labels(spark):
    rows = [(i, i % 10, [math.cos(i), math.sin(i), 1.0]) for i in range(300)]
    frame = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")
    found = Counter(tuple(r) for r in negatives.mined_digest(spark, frame).collect())
    moved = [(i, (k + 1) % 10 if i % 7 == 0 else k, np.array(v, dtype=np.float32).astype(float).tolist()) for i, k, v in rows]
    assert found == brute_negatives(moved, 100, 5, 10, 30, 90)
