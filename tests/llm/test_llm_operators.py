"""The ten operators against brute force on small tables with awkward rows."""

import hashlib
import math
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from orderloom.llm import chat, embeddings, fingerprints, language, mixing, neardup, packing, repeats, sharding, token_files
from orderloom.llm.common import connected, scratch_uri, staged

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, shard string, row string"
LONG = " ".join(f"word{i} tail{i % 7}" for i in range(9000))
BASE = " ".join(f"shared{i}" for i in range(60))
ROWS = [
    (0, None, None, None, None, "x", "y"),
    (1, "", "en", "a", 0, None, None),
    (2, BASE, "en", "a", 1, None, None),
    (3, BASE, "en", "b", 1, None, None),
    (3, BASE, "en", "b", 1, None, None),
    (4, BASE + " more", "en", None, 1, None, None),
    (5, LONG, "en", "c", 1, None, None),
    (6, "  a \t b  ", "xx", "c", 1, None, None),
    (7, "123 ...", None, "c", 1, None, None),
    (8, "éß漢字 <|endoftext|> x", "fr", "c", 1, None, None),
    (None, "no id " + BASE, "en", "c", 1, None, None),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def brute_jump(key, shards):
    seed = 42 if key is None else xxhash.xxh64_intdigest(int(key).to_bytes(8, "little", signed=True), 42)
    bucket = target = draw = 0
    while target < shards:
        bucket = target
        value = xxhash.xxh64_intdigest(draw.to_bytes(4, "little"), seed)
        target = int((bucket + 1) * (2.0**31 / float((value >> 33) + 1)))
        draw += 1
    return bucket


def test_sharding(spark, docs, none):
    rows = sharding.shard_documents(spark, docs, 8).collect()
    assert len(rows) == len(ROWS)
    for row in rows:
        assert row.shard == brute_jump(row.doc_id, 8)
        assert row.grown_shard == brute_jump(row.doc_id, 9)
        assert row.grown_shard in (row.shard, 8)
    for shard in {r.shard for r in rows}:
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(sum(r.shard == shard for r in rows)))
    assert {(r.doc_id, r.size, r.text_crc32) for r in rows} == {
        (r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in ROWS
    }
    assert sharding.shard_documents(spark, none, 8).count() == 0


def brute_repeats(texts, window):
    count = Counter(t[i : i + window] for t in texts for i in range(len(t) - window + 1))
    out = []
    for text in texts:
        gone = [False] * len(text)
        for i in range(len(text) - window + 1):
            if count[text[i : i + window]] > 1:
                gone[i : i + window] = [True] * window
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(b for b, g in zip(text, gone, strict=True) if not g)
        out.append((len(text), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("most", [1, 8192])
def test_repeats(spark, docs, none, most, monkeypatch):
    monkeypatch.setattr(repeats, "MOST_RUNS", most)
    extra = [(100 + i, "x" * 30 * i + BASE[i * 9 :] + "é" * 120 + "aaa" * 90 * (i % 2), None, None, None, None, None) for i in range(12)]
    table = docs.unionByName(spark.createDataFrame(extra, SCHEMA))
    rows = repeats.repeats_digest(spark, table).collect()
    texts = [(r[0], (r[1] or "").encode()) for r in ROWS + extra]
    expected = Counter((key, *x) for (key, _), x in zip(texts, brute_repeats([t for _, t in texts], 200), strict=True))
    assert Counter(tuple(r) for r in rows) == expected
    assert repeats.repeats_digest(spark, none).count() == 0


def test_repeats_of_one_row(spark, monkeypatch):
    gathered = []

    def recorded(session, rows):
        out = staged(session, rows)
        if "stretches" in out.columns:
            gathered.append(out)
        return out

    monkeypatch.setattr(repeats, "staged", recorded)
    table = spark.createDataFrame([(None, BASE)] * 300 + [(1, BASE[:300])] * 3, "doc_id long, text string")
    rows = repeats.repeats_digest(spark, table).collect()
    gone = hashlib.sha256(b"").hexdigest()
    assert Counter(tuple(r) for r in rows) == {(None, len(BASE), len(BASE), 1, gone): 300, (1, 300, 300, 1, gone): 3}
    for row in gathered[0].collect():
        assert len(row.stretches) == len({(s.start, s.stop) for s in row.stretches}) < 40


def test_chat(spark):
    turns = [(1, 0, "user", "hi"), (1, 1, "assistant", "yo"), (2, 0, "user", None), (2, 1, "assistant", "no"), (None, 0, "user", "x"), (3, 0, None, "")]
    table = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    rows = chat.format_preferences(chat.replaced_replies(chat.conversations(table))).collect()
    assert [(r.pair_id, r.shared_turns, r.prompt, r.chosen, r.rejected) for r in rows] == [
        (1, 1, "<|user|>\nhi\n", "<|assistant|>\nyo\n", "<|assistant|>\nno\n")
    ]
    assert [tuple(x) for x in rows[0].chosen_mask] == [(14, 3)]
    assert chat.conversations(table.limit(0)).count() == 0


def rendered(turns):
    return "".join(f"<|{role}|>\n{text}\n" for role, text in turns)


def test_preferences_split_where_the_turns_do(spark):
    """Early splits, a side that is a prefix of the other, several completions, empty sides."""
    talk = [("user", "q"), ("assistant", "a1"), ("user", "why"), ("assistant", "a2"), ("assistant", "a3")]
    pairs = [
        (talk, [("user", "other")] + talk[1:]),
        (talk, talk[:2]),
        (talk[:2], talk),
        (talk, talk),
        (talk, talk[:1] + [("assistant", "b1"), ("assistant", "b2"), ("user", "x"), ("assistant", "b3")]),
        ([], talk),
        (None, talk[:2]),
    ]
    schema = "pair_id long, chosen array<struct<role:string,text:string>>, rejected array<struct<role:string,text:string>>"
    table = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], schema)
    found = {r.pair_id: r for r in chat.format_preferences(table).collect()}
    for i, (chosen, rejected) in enumerate(pairs):
        chosen, rejected = chosen or [], rejected or []
        if i not in found:
            continue
        shared = 0
        while shared < min(len(chosen), len(rejected)) and chosen[shared] == rejected[shared]:
            shared += 1
        r = found[i]
        assert (r.shared_turns, r.prompt) == (shared, rendered(chosen[:shared]))
        for side, text, mask in ((chosen, r.chosen, r.chosen_mask), (rejected, r.rejected, r.rejected_mask)):
            assert text == rendered(side[shared:])
            said = "".join(text[m[0] : m[0] + m[1]] for m in mask)
            assert said == "".join(f"{t}\n" for role, t in side[shared:] if role == "assistant")
    assert len(found) >= 6


def test_fingerprints(spark, docs, none):
    rows = fingerprints.fingerprint_documents(spark, docs).collect()
    assert len(rows) == len(ROWS)
    ordered = sorted(((r[0], r[1] or "") for r in ROWS if r[0] is not None), key=lambda r: r[0])
    edited = Counter()
    for (key, text), (_, following) in zip(ordered, ordered[1:] + ordered[:1], strict=True):
        quarter = len(text) // 4
        edited[key, hashlib.sha256((text[: len(text) - quarter] + following[:quarter]).encode()).hexdigest()] += 1
    assert Counter((r.doc_id, r.edited_sha256) for r in rows if r.doc_id is not None) == edited
    by_id = {r.doc_id: r for r in rows}
    assert by_id[2].fingerprint == by_id[3].fingerprint and by_id[2].near_next == 1.0
    assert by_id[0].fingerprint == "" and by_id[0].near_edited == 1.0
    assert fingerprints.fingerprint_documents(spark, none).count() == 0


def test_fingerprints_estimate_generalised_jaccard(spark):
    """Shares of equal samples against min-sum / max-sum of the word counts; next to next."""
    random = np.random.default_rng(9)
    texts = [" ".join(random.choice([f"w{i}" for i in range(40)], 160)) for _ in range(150)]
    rows = fingerprints.fingerprint_documents(spark, spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()

    def alike(one, two):
        a, b = Counter(one.split()), Counter(two.split())
        return sum((a & b).values()) / sum((a | b).values())

    errors = []
    for r in rows:
        text, following = texts[r.doc_id], texts[(r.doc_id + 1) % 150]
        quarter = len(text) // 4
        edited = text[: len(text) - quarter] + following[:quarter]
        errors += [r.near_next - alike(text, following), r.near_edited - alike(text, edited)]
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.1


@pytest.mark.parametrize("most", [3, 65_536])
def test_document_order_in_few_buckets(spark, monkeypatch, most):
    monkeypatch.setattr(fingerprints, "MOST_BUCKETS", most)
    random = np.random.default_rng(10)
    ids = sorted(set(random.integers(-(2**40), 2**40, 300).tolist()) | set(range(50)))
    table = spark.createDataFrame([(i, f"t{i}") for i in ids], "doc_id long, text string").repartition(5)
    rows = fingerprints.with_next(table, rows_per_bucket=20).where("NOT guest").collect()
    assert len({r.bucket for r in rows}) == (3 if most == 3 else max(1, len(ids) // 20))
    assert {r.doc_id: r.next_text for r in rows} == {a: f"t{b}" for a, b in zip(ids, ids[1:] + ids[:1], strict=True)}


@pytest.mark.parametrize("crowded", [(7,), (-3,), (99,), (7, 8), (7, -3, 99)])
def test_crowded_ids_are_dealt_over_buckets(spark, crowded):
    """Ids that many rows share, one of their texts often, against the order sorted as a whole."""
    random = np.random.default_rng(12)
    rows = [(i, f"plain text {i} of its own kind") for i in range(0, 60, 2)]
    for key in crowded:
        rows += [(key, f"crowd {key} says {i} and {i * i} here") for i in range(90)]
        rows += [(key, "the same words over and over again")] * 70 + [(key, None)] * 3
    table = spark.createDataFrame([rows[i] for i in random.permutation(len(rows))], "doc_id long, text string").repartition(6)
    ordered = sorted(
        ((key, text or "") for key, text in rows),
        key=lambda r: (r[0], np.uint64(xxhash.xxh64_intdigest(r[1].encode(), 42)).astype(np.int64)),
    )
    expected = Counter()
    for (key, text), (_, following) in zip(ordered, ordered[1:] + ordered[:1], strict=True):
        quarter = len(text) // 4
        edited = (text[: len(text) - quarter] + following[:quarter]).encode()
        expected[key, len(text), hashlib.sha256(edited).hexdigest(), text == following] += 1
    found = fingerprints.fingerprint_documents(spark, table, rows_per_bucket=20).collect()
    # Different words may agree in all of 32 samples only by being the same words in this table.
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256, r.near_next == 1.0) for r in found) == expected
    sizes = Counter(r.bucket for r in fingerprints.with_next(table, rows_per_bucket=20).collect())
    assert len(sizes) > 4 and max(sizes.values()) < 60
    whole = fingerprints.fingerprint_documents(spark, table, rows_per_bucket=10**6).collect()
    assert sorted(map(tuple, whole), key=str) == sorted(map(tuple, found), key=str)


def test_one_id_for_all(spark):
    table = spark.createDataFrame([(5, "always the same text")] * 100 + [(5, "another")], "doc_id long, text string")
    rows = fingerprints.fingerprint_documents(spark, table.repartition(5), rows_per_bucket=10).collect()
    assert Counter(r.n_chars for r in rows) == {20: 100, 7: 1}
    assert sum(r.near_next == 1.0 for r in rows) == 99


def test_encoders_are_forgotten_and_built_again():
    from orderloom.llm import tokens

    path = tokens.default_vocabulary()
    before = tokens.encoder(path).encode(["some words, twice some words"])
    tokens.forget()
    assert not tokens._encoders
    assert tokens.encoder(path).encode(["some words, twice some words"]) == before


def test_encoder_that_forgets_parts():
    from tokenizers import Tokenizer

    from orderloom.llm import tokens

    path = tokens.default_vocabulary()
    plain, encoder = Tokenizer.from_file(path), tokens.Encoder(path, 4)
    for i in range(30):
        texts = [f"always common words and new{i} ones{i % 7}", f"common or{i % 3} not"]
        expected = [np.array(plain.encode(t, add_special_tokens=False).ids, dtype="<u4").tobytes() for t in texts]
        assert encoder.encode(texts) == expected
        assert len(encoder._memo) + len(encoder._older) < 40


def test_encoder_looks_up_each_distinct_part_once(monkeypatch):
    from tokenizers import Tokenizer

    from orderloom.llm import tokens

    path = tokens.default_vocabulary()
    plain, encoder = Tokenizer.from_file(path), tokens.Encoder(path)
    random = np.random.default_rng(5)
    words = ["the", "garden", "é漢", "x.\ny", "", "<|endof", "don't", "1,024"]
    texts = [" ".join(random.choice(words, n)) for n in (0, 1, 2, 500, 5000)] + ["", " ", "lead", "a <|endoftext|> b"]
    looked_up = []
    rows = encoder._rows
    monkeypatch.setattr(encoder, "_rows", lambda parts: looked_up.append(len(parts)) or rows(parts))
    for _ in range(2):
        for text, ids in zip(texts, encoder.encode(texts), strict=True):
            assert np.frombuffer(ids, dtype="<u4").tolist() == plain.encode(text, add_special_tokens=False).ids, text
    assert max(looked_up) <= len(words) and len(encoder._memo) <= len(words)
    assert encoder.encode([]) == []
    assert len(encoder.encode(["plenty of words here"] * 3)) == 3


def test_pieces_hold_the_ids_of_the_library(spark, docs):
    from tokenizers import Tokenizer

    from orderloom.llm.tokens import default_vocabulary

    plain = Tokenizer.from_file(default_vocabulary())
    extra = [(50 + i, "some more words here " * (40 * i + 1), "en", "a", 0, None, None) for i in range(30)]
    rows = packing.pack_documents(spark, docs.unionByName(spark.createDataFrame(extra, SCHEMA))).collect()
    ids = Counter()
    for row in ROWS + extra:
        ids[row[0], np.array([*plain.encode(row[1] or "", add_special_tokens=False).ids, 0], dtype="<u4").tobytes()] += 1
    starts = Counter()
    for r in rows:
        options = [data for key, data in ids if key == r.doc_id and len(data) == 4 * r.doc_tokens]
        assert any(zlib.crc32(data[4 * r.start : 4 * (r.start + r.length)]) == r.ids_crc32 for data in options)
        starts[r.doc_id, r.start, r.length] += 1
    for (key, data), times in ids.items():
        covered = sorted((start, length) for (own, start, length), n in starts.items() if own == key and start + length <= len(data) // 4 and n >= times)
        assert covered and covered[0][0] == 0
    used = Counter()
    for r in rows:
        used[r.sequence_id] += r.length
    padded = sum(packing.WINDOW if n & (n - 1) else n for n in used.values())
    assert sum(used.values()) / padded > 0.9


def test_packing(spark, docs, none):
    rows = packing.pack_documents(spark, docs).collect()
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= packing.WINDOW
    assert sum(r.length for r in rows) == sum(r.doc_tokens for r in rows if r.start == 0)
    assert Counter(r.doc_id for r in rows if r.start == 0) == Counter(r[0] for r in ROWS)
    assert packing.pack_documents(spark, none).count() == 0


def test_packing_plan_uses_every_piece_once():
    counts = np.random.default_rng(1).integers(0, 50, 65)
    counts[0] = 0
    used = Counter()
    for combination, times in packing.pack_histogram(counts):
        assert sum(combination) <= 64 and times > 0
        for n in combination:
            used[n] += times
    assert all(used[n] == counts[n] for n in range(1, 65))


def words(text):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return [w for w in __import__("re").findall(r"[^\x20\x09-\x0D]+", low)]


def brute_components(items, linked):
    root = {i: i for i, _ in items}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for x, (i, a) in enumerate(items):
        for j, b in items[:x]:
            if linked(a, b):
                one, two = sorted((find(i), find(j)))
                root[two] = one
    return {i: find(i) for i in root}


@pytest.mark.parametrize("width", [2, 5])
def test_near_duplicates(spark, none, width):
    random = np.random.default_rng(5)
    base = [f"w{i}" for i in random.integers(0, 400, 120)]
    texts = [None, "", "One", "one", "a b"]
    for i in range(40):
        copy = list(base)
        for j in random.integers(0, 120, i % 5):
            copy[j] = f"new{random.integers(0, 99999)}"
        texts.append(" ".join(copy))
    texts += [" ".join(f"u{i}x{j}" for j in range(50)) for i in range(10)] + texts[6:9]
    table = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")

    def shingles(text):
        w = words(text)
        return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set()

    sets = [(i, shingles(t)) for i, t in enumerate(texts)]
    expected = brute_components(sets, lambda a, b: a and b and 100 * len(a & b) >= 80 * len(a | b))
    rows = neardup.near_digest(spark, table, width).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in rows} == {
        i: (len(s), expected[i], expected[i] == i) for i, s in sets
    }
    kept = neardup.drop_near_copies(spark, table, width)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(expected.values()))
    assert neardup.near_digest(spark, none, width).count() == 0


@pytest.mark.parametrize("size", [1, 3, 60, 399])
def test_cells_of_large_nodes(spark, size, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", 20)
    rows = [(7, p, 400, 400 - size, p >= size) for p in range(400)]
    cells = neardup._cells(spark.createDataFrame(rows, "node long, place long, n long, queries long, query boolean"))
    groups = {}
    for r in cells.collect():
        groups.setdefault(r.cell, []).append((r.place, r.block))
    assert max(map(len, groups.values())) < 4 * 20
    met = Counter(
        (a, b) for own in groups.values() for a, x in own for b, y in own if a < b and x != y and (a >= size or b >= size)
    )
    assert met == {(a, b): 1 for b in range(size, 400) for a in range(b)}


def test_blocks_of_a_chain_meet(spark):
    rows = [(root, place, blocks) for root, n, blocks in ((1, 90, 4), (2, 5, 1)) for place in range(100 * root, 100 * root + n)]
    cells = neardup._chain_cells(spark.createDataFrame(rows, "root long, place long, blocks long")).collect()
    assert Counter(r.place for r in cells) == {place: blocks for _, place, blocks in rows}
    groups = {}
    for r in cells:
        groups.setdefault(r.cell, set()).add(r.place)
    met = {(a, b) for own in groups.values() for a in own for b in own}
    assert met == {(a, b) for r, a, _ in rows for s, b, _ in rows if r == s}
    assert max(map(len, groups.values())) < 75


@pytest.mark.parametrize("most", [16, 3])
def test_near_duplicates_in_large_nodes(spark, monkeypatch, most):
    for name, value in (("SMALL", 8), ("BLOCK", 8), ("DEEPEST", 2), ("MOST_BLOCKS", most)):
        monkeypatch.setattr(neardup, name, value)
    random = np.random.default_rng(8)
    slots = random.random((90, 60)) < 0.1
    texts = [" ".join(f"d{i}x{j}" if new else f"s{j}" for j, new in enumerate(row)) for i, row in enumerate(slots)]
    texts += [texts[i] + " more" for i in range(0, 90, 3)]
    sets = [(i, set(zip(words(t), words(t)[1:]))) for i, t in enumerate(texts)]
    expected = brute_components(sets, lambda a, b: 100 * len(a & b) >= 80 * len(a | b))
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in neardup.near_digest(spark, table).collect()} == expected
    assert len(set(expected.values())) > 20


def test_trees_reach_the_target_recall(spark, monkeypatch):
    """Pairs at 0.803 in a family that shares most words, so that nodes have to branch far down."""
    for name, value in (("SMALL", 8), ("AT_ONCE", 0), ("DEEPEST", 6)):
        monkeypatch.setattr(neardup, name, value)
    asked = []
    count = neardup.trees_for
    monkeypatch.setattr(neardup, "trees_for", lambda depth, alike: asked.append(depth) or count(depth, alike))
    shared = " ".join(f"s{j}" for j in range(66))
    texts = []
    for i in range(500):
        own = shared + "".join(f" f{i}x{j}" for j in range(33))
        texts += [own + "".join(f" {side}{i}x{j}" for j in range(12)) for side in "ab"]
    rows = neardup.near_digest(spark, spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in rows} == {i: i - i % 2 for i in range(1000)}
    assert asked == [2, 3, 4, 5, 6]


def test_number_of_trees_by_trial():
    """Of made pairs at the threshold, as many meet at a depth as the number of trees promises."""
    random = np.random.default_rng(4)
    mins = random.integers(0, 2**32, (4000, neardup.MINS), dtype=np.uint32)
    other = np.where(random.random(mins.shape) < 0.8, mins, random.integers(0, 2**32, mins.shape, dtype=np.uint32))
    for depth in (2, 5):
        trees = range(neardup.trees_for(depth, 0.8))
        met = [set(), set()]
        for some, values in zip(met, (mins, other), strict=True):
            owner, nodes = neardup._roots(values, trees)
            for _ in range(depth - 1):
                owner, nodes = neardup._children(nodes, owner, values, 0.8)
            some.update(zip(owner.tolist(), nodes.tolist(), strict=True))
        missed = 4000 - len({owner for owner, _ in met[0] & met[1]})
        assert missed <= 4
    assert neardup.trees_for(9, 0.8) > neardup.trees_for(2, 0.8) > 1
    assert neardup.trees_for(2, 1.0) < neardup.trees_for(2, 0.8) and neardup.trees_for(9, 0.3) == neardup.MINS


def test_language(spark, docs, none):
    train = [(i, ("the house and the garden " if i % 2 else "das haus und der garten ") * 3, "en" if i % 2 else "de") for i in range(60)]
    table = spark.createDataFrame(train, "doc_id long, text string, lang string")
    model = language.learn(spark, table)
    found = {r.row.doc_id: (r.lang_pred, r.score) for r in language.identify(spark, docs, model).collect()}
    assert found[0][0] == found[1][0] == found[7][0] == "und" and found[2][0] in ("en", "de")
    right = language.identify(spark, table, model).where(F.col("row.lang") == F.col("lang_pred")).count()
    assert right == 60
    assert language.language_digest(spark, none).count() == 0
    assert {r.doc_id for r in language.drop_unknown(spark, docs).collect()} == {2, 3, 4, 5, 6, 8, None}


def grams_of(text, width=language.NGRAM):
    data = b"  " + bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in text.lower().encode()) + b"  "
    return [data[i : i + width] for i in range(len(data) - width + 1)]


def test_the_filter_answers_like_exact_sets(spark):
    """Every n-gram of an exact set is found in its language's filter; few others are."""
    random = np.random.default_rng(3)
    words = {lang: ["".join(random.choice(list(letters), 6)) for _ in range(80)] for lang, letters in (("aa", "abcdefgh"), ("bb", "efghijkl"), ("cc", "mnopqrst"))}
    rows = [(i, " ".join(random.choice(words[lang], 40)), lang) for i, lang in enumerate(["aa", "bb", "cc"] * 30)]
    model = language.learn(spark, spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    sets = {}
    for lang in words:
        docs_of = [set(grams_of(t)) for _, t, own in rows if own == lang]
        count = Counter(g for d in docs_of for g in d)
        sets[lang] = {g: n / len(docs_of) for g, n in count.items() if n >= 2}
    every = set().union(*sets.values())
    exact = {
        lang: {g for g in own if own[g] >= language.PURITY * max(s.get(g, 0) for s in sets.values())} for lang, own in sets.items()
    }
    values = {g: np.array([int.from_bytes(g, "little")], dtype=np.uint64) for g in every}
    wrong = asked = 0
    for g, value in values.items():
        slots = language._slots(language.mixed(value))
        bits = model.table[slots[0][0]] & model.table[slots[1][0]] & model.table[slots[2][0]]
        for i, lang in enumerate(model.languages):
            said = bool((bits[i // 8] >> (i % 8)) & 1)
            assert said or g not in exact[lang]
            asked += g not in exact[lang]
            wrong += said and g not in exact[lang]
    assert wrong <= 0.01 * asked + 2
    for _, text, lang in rows[:20]:
        found, score = model.predict([text])
        shares = {x: sum(g in exact[x] for g in grams_of(text)) / len(grams_of(text)) for x in exact}
        assert found == [max(shares, key=shares.get)] and abs(score[0] - max(shares.values())) < 0.02


def test_one_document_in_a_third_of_the_rows_does_not_make_the_sample(spark, monkeypatch):
    monkeypatch.setattr(language, "SAMPLE_PER_LANGUAGE", 50)
    gathered = []

    def recorded(session, rows):
        gathered.append(staged(session, rows))
        return gathered[-1]

    monkeypatch.setattr(language, "staged", recorded)
    rows = [(i, f"text number {i} of the house", "en") for i in range(2000)] + [(7, "hot copy of the garden", "en")] * 1000
    language.learn(spark, spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    texts = [r.text for r in gathered[0].collect()]
    assert len(texts) == len(set(texts)) and 40 <= len(texts) <= 50


def test_the_whole_table_is_learned_from_and_sets_the_least_score(spark, monkeypatch):
    """Neither a word that few documents have nor a low score of one document is missed."""
    monkeypatch.setattr(language, "SAMPLE_PER_LANGUAGE", 30)
    monkeypatch.setattr(language, "SAMPLE_HELD_OUT", 30, raising=False)
    monkeypatch.setattr(language, "GRAMS_AT_ONCE", 20_000)
    monkeypatch.setattr(language, "LOST", 0.02)
    random = np.random.default_rng(6)
    words = ["".join(random.choice(list("abcdefgh"), 5)) for _ in range(60)]
    rows = [(i, " ".join(random.choice(words, 30)) + (" zyxwvut" if i % 150 == 0 else ""), "en") for i in range(1200)]
    rows += [(i, "".join(random.choice(list("uvwxyz"), 60)), "xx") for i in range(1200, 1500)] + rows[:300] * 2
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    keep = [r for r in dict.fromkeys(rows) if zlib.crc32(str(r[0]).encode()) % 4 != 2]
    model = language.learn(spark, table.where(~language.held_out(F.col("doc_id"))), whole=True)
    slots = language._slots(language.mixed(np.array([int.from_bytes(b"zyxwv", "little")], dtype=np.uint64)))
    assert sum("zyxwv" in t for _, t, _ in keep) >= 2
    assert (model.table[slots[0]] & model.table[slots[1]] & model.table[slots[2]])[0, 0] & 1

    given = language.learn(spark, spark.createDataFrame(keep, "doc_id long, text string, lang string"), whole=True)
    assert (given.table == model.table).all()

    away = {(t, lang) for i, t, lang in rows if zlib.crc32(str(i).encode()) % 4 == 2}
    named = [(lang, *(x[0] for x in model.predict([t]))) for t, lang in away]
    scores = sorted(score for lang, said, score in named if lang == said)
    assert len(scores) > 200
    assert language.least_score(spark, table, model) == scores[int(np.ceil(0.02 * len(scores))) - 1]


def test_texts_of_no_language_go(spark):
    random = np.random.default_rng(4)
    words = ["".join(random.choice(list("abcdefgh"), 5)) for _ in range(60)]
    rows = [(i, " ".join(random.choice(words, 30)), "en") for i in range(800)]
    strange = [(1000 + i, " ".join("".join(random.choice(list("uvwxyz"), 7)) for _ in range(30)), None) for i in range(20)]
    table = spark.createDataFrame(rows + strange + [(2000, "12 34", "en")], "doc_id long, text string, lang string")
    kept = {r.doc_id for r in language.drop_unknown(spark, table).collect()}
    assert not kept & {i for i, *_ in strange} and 2000 not in kept and len(kept) >= 798


@pytest.mark.parametrize("missing", ["lang", "doc_id"])
def test_unlabelled_documents_stay(spark, docs, missing):
    bare = docs.withColumn(missing, F.lit(None).cast(docs.schema[missing].dataType))
    rows = language.drop_unknown(spark, bare)
    assert rows.columns == docs.columns
    assert Counter(r.text for r in rows.collect()) == Counter(r[1] for r in ROWS if r[1] not in (None, "", "123 ..."))


def test_token_files(spark, docs, none):
    target = scratch_uri(spark)
    rows = token_files.read_token_files(token_files.write_token_files(spark, docs, target), target).collect()
    assert len(rows) == len(ROWS)
    at = 0
    for r in sorted(rows, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    from tokenizers import Tokenizer

    from orderloom.llm.tokens import default_vocabulary

    plain = Tokenizer.from_file(default_vocabulary())
    expected = Counter()
    for row in ROWS:
        ids = np.array([*plain.encode(row[1] or "", add_special_tokens=False).ids, 2], dtype="<u4")
        expected[row[0], len(ids), zlib.crc32(ids.tobytes())] += 1
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in rows) == expected
    empty = scratch_uri(spark)
    assert token_files.read_token_files(token_files.write_token_files(spark, none, empty), empty).count() == 0


def test_sequences_at_random_are_views_of_the_file(spark, docs, monkeypatch):
    monkeypatch.setattr(token_files, "ROWS_PER_BATCH", 3)
    target = scratch_uri(spark)
    files = token_files.write_token_files(spark, docs, target, length=64).collect()
    import pyarrow as pa

    for file in files:
        with pa.memory_map(file.path) as mapped:
            table = pa.ipc.open_stream(mapped).read_all()
        found = token_files.Sequences(file.path, file.batches)
        assert len(found) == table.num_rows and sum(table.column("attention_mask")[i].as_py().count(True) for i in range(len(found))) == file.ids
        base = found._file
        base.seek(0)
        whole = base.read_buffer()
        for i in np.random.default_rng(1).permutation(len(found)).tolist():
            before = pa.total_allocated_bytes()
            ids, mask = found.ids(i), found.mask(i)
            assert pa.total_allocated_bytes() - before < 2 * 64
            assert ids.tolist() == table.column("input_ids")[i].as_py()
            assert mask.to_pylist() == table.column("attention_mask")[i].as_py()
            for address in (ids.ctypes.data, mask.buffers()[1].address):
                assert whole.address <= address < whole.address + whole.size
        with pytest.raises(IndexError):
            found.ids(len(found))


def test_added_tokens_read_as_the_library_reads_them():
    from tokenizers import Tokenizer

    from orderloom.llm.tokens import default_vocabulary, encoder

    plain = Tokenizer.from_file(default_vocabulary())
    texts = ["x <|endoftext|> y", "<|endoftext|>", "a<|endoftext|>b c  d", "<|endof text|>", "plain words here", "", " lead", "trail ", "é漢 \n\t z"]
    texts += [" ".join(np.random.default_rng(i).choice(["<|endoftext|>", "a", "bc", " ", "d\n", "é"], 12)) for i in range(200)]
    for text, ids in zip(texts, encoder(default_vocabulary()).encode(texts), strict=True):
        assert np.frombuffer(ids, dtype="<u4").tolist() == plain.encode(text, add_special_tokens=False).ids, text


@pytest.mark.parametrize("ids", [True, False])
def test_mixing_comes_near_its_targets(spark, ids):
    rows = [(i if ids else None, "word " * (1 + i % 7), f"s{i % 3}") for i in range(3000)]
    found = mixing.mix_digest(spark, spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert len(found) == 3000 and all(r.taken <= 3 * r.size for r in found)
    for target in {r.target for r in found}:
        taken = sum(r.taken for r in found if r.target == target)
        assert abs(taken - target) <= 0.1 * target
    again = mixing.mix_digest(spark, spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, found))


def test_mixing(spark, docs, none):
    rows = mixing.mix_digest(spark, docs).collect()
    assert len(rows) == len(ROWS)
    assert math.isclose(sum({(r.source_size, r.target) for r in rows} and {r.target for r in rows}), sum(r.size for r in rows))
    assert all(r.taken <= 3 * r.size for r in rows)
    assert mixing.mix_sources(spark, docs).columns == docs.columns
    assert mixing.mix_digest(spark, none).count() == 0


def test_embeddings(spark):
    random = np.random.default_rng(0)
    base = random.normal(size=(150, 16))
    near = base[:60] + random.normal(size=(60, 16)) * 0.08
    vectors = [x.tolist() for x in (*base, *near, *base[:5], *base[:5] * 3)]
    vectors += [None, [], [0.0] * 16, [float("nan")] * 16, [float("inf")] + [1.0] * 15, [None] + [1.0] * 15, [1.0, 2.0]]
    table = spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>")
    rows = {r.vec_id: r for r in embeddings.near_vectors(spark, table).collect()}
    unit = np.array(vectors[:220]) / np.linalg.norm(np.array(vectors[:220]), axis=1, keepdims=True)
    linked = unit @ unit.T >= 0.95
    np.fill_diagonal(linked, False)
    found = sum(rows[i].n_links for i in range(220))
    assert 0.9 * linked.sum() <= found <= linked.sum()
    assert all(rows[i].n_links <= linked[i].sum() for i in range(220))
    assert all(rows[i].n_links == 0 and rows[i].kept for i in range(220, 227))
    assert embeddings.near_vectors(spark, table.limit(0)).count() == 0


def test_embeddings_far_from_zero(spark):
    random = np.random.default_rng(2)
    base = random.normal(size=(400, 32)) + 2.4
    near = base + random.normal(size=(400, 32)) * 0.5
    close = base.mean(axis=0) + random.normal(size=(40, 32)) * 0.5
    table = np.concatenate([base, near, close])
    unit = table / np.linalg.norm(table, axis=1, keepdims=True)
    assert 0.9 < np.linalg.norm(unit.mean(axis=0)) < 0.95
    linked = unit @ unit.T >= 0.95
    np.fill_diagonal(linked, False)
    rows = embeddings.near_vectors(spark, spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(table)], "vec_id long, embedding array<double>"))
    found = sum(r.n_links for r in rows.collect())
    assert 0.99 * linked.sum() <= found <= linked.sum()
    two = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 0.2])], "vec_id long, embedding array<double>")
    assert {r.vec_id: (r.n_links, r.component_id) for r in embeddings.near_vectors(spark, two).collect()} == {0: (1, 0), 1: (1, 0)}


@pytest.mark.parametrize("shift", [0.0, 0.13, 0.3])
@pytest.mark.parametrize("dimension", [2, 64])
def test_embedding_tables_reach_their_recall(shift, dimension):
    random = np.random.default_rng(3)
    sample = random.normal(size=(3000, dimension)) / math.sqrt(dimension) + shift
    sample /= np.linalg.norm(sample, axis=1, keepdims=True)
    mean, rotations, bits, tables = embeddings.learned_tables(sample, 50_000, 0.95)
    one, other, _ = embeddings.probe_pairs(sample, mean, 0.95)
    assert (one * other).sum(axis=1).min() >= 0.95 - 1e-9
    assert embeddings.measured_recall(one, other, mean, rotations, bits, tables) >= embeddings.RECALL


def test_connected_follows_long_chains(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(50)] + [(100, 99)], "a long, b long")
    assert {r.node: r.root for r in connected(spark, links).collect()} == {i: 0 for i in range(51)} | {99: 99, 100: 99}
