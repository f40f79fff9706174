"""Operators on documents against brute force on small tables with nulls, ties, repeats and clashing columns."""

import dataclasses
import math
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from halfstar.llm import bloom_lm, decontamination, jaccard_join, signature_tree, tables, toxicity, words
from halfstar.llm.tables import connected_components

_LOWER = {i: i + 32 for i in range(65, 91)}
#: Columns beside those of documents, with names that operators use inside.
CLASHES = "component string, score string, node long, key long, n long, ids string, cluster long, block long"


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(_LOWER))


def documents(spark, rows):
    """Rows of (doc_id, text) with further columns that clash."""
    schema = f"doc_id long, text string, {CLASHES}"
    return spark.createDataFrame([(i, t, *[None] * 8) for i, t in rows], schema)


def corpus(seed=1, n=120, longest=400):
    """Random texts with exact and near copies, some very short, a very long one, NULLs and empty ones."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdeéñ") for _ in range(rng.randrange(1, 7))) for _ in range(400)]
    texts = [" ".join(rng.choices(vocabulary, k=rng.randrange(1, longest))) for _ in range(n)]
    for t in rng.sample(texts, n // 3):
        parts = t.split(" ")
        for _ in range(rng.randrange(0, 3)):
            parts[rng.randrange(len(parts))] = rng.choice(vocabulary)
        texts.append(rng.choice([" ", "\n", "\t "]).join(parts).upper() if rng.random() < 0.3 else " ".join(parts))
    texts += [None, None, "", " \n\t", "one", "one", "one two", "x" * 5000, " ".join(rng.choices(vocabulary, k=20_000))]
    rows = list(enumerate(texts))
    return rows + [rows[3], rows[3], (rows[4][0], "another text for a known id")]


# words


def test_words_are_hashed_as_wholes_across_segments(monkeypatch):
    texts = ["Hello  World\tfoo", None, "", "été Hello\x0bÀ hello", " x ", "y" * 50 + " hello world Foo", "tail"]
    whole, at = words.word_hashes(pa.array(texts))
    seen = {}
    for i, text in enumerate(texts):
        found = split(text)
        assert at[i + 1] - at[i] == len(found)
        for word, h in zip(found, whole[at[i] : at[i + 1]], strict=True):
            assert seen.setdefault(word, h) == h
    assert len(set(seen.values())) == len(seen)
    for segment in (1, 3, 7, 64):
        monkeypatch.setattr(words, "SEGMENT", segment)
        again, at_again = words.word_hashes(pa.array(texts))
        assert (again == whole).all() and (at_again == at).all()


def test_shingles_of_short_texts():
    hashes, at = words.word_hashes(pa.array(["a b", "a b c", "a b c d", "", "a b"]))
    whole, starts = words.shingle_hashes(hashes, at, 3, whole_if_short=True)
    assert np.diff(starts).tolist() == [1, 1, 2, 0, 1]
    assert whole[0] == whole[4] and len(set(whole.tolist())) == 3
    assert np.diff(words.shingle_hashes(hashes, at, 3, whole_if_short=False)[1]).tolist() == [0, 1, 2, 0, 0]


# n-gram Jaccard join


def brute_components(rows, width, percent):
    sets = []
    for _, text in rows:
        w = split(text)
        sets.append({tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set())
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            common = len(a & b) if a and b else 0
            if common and 100 * common >= percent * (len(a) + len(b) - common):
                up[max(root(i), root(j))] = min(root(i), root(j))
    groups = {}
    for i, (doc_id, _) in enumerate(rows):
        groups.setdefault(root(i), []).append(doc_id)
    return sorted((d, len(sets[i]), d if not sets[i] else min(groups[root(i)])) for i, (d, _) in enumerate(rows))


@pytest.mark.parametrize(("width", "percent"), [(3, 90), (5, 80), (1, 80)])
def test_components_equal_brute_force(spark, width, percent):
    rows = corpus(seed=width)
    got = jaccard_join.similar_components(documents(spark, rows), width, percent).collect()
    assert sorted(map(tuple, got)) == brute_components(rows, width, percent)


def test_clusters_larger_than_a_block(spark, monkeypatch):
    rng = random.Random(4)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(60):  # a chain: neighbours are similar, ends are not
        if i % 3 == 0:
            base[rng.randrange(120)] = f"v{i}"
        rows.append((i, " ".join(base)))
    rows += [(100 + i, " ".join(base[:-1] + [f"u{i}"])) for i in range(30)]
    monkeypatch.setattr(jaccard_join, "BLOCK_SETS", 4)
    got = jaccard_join.similar_components(documents(spark, rows), 3, 90).collect()
    assert sorted(map(tuple, got)) == brute_components(rows, 3, 90)


def test_components_of_empty_tables_and_missing_ids(spark):
    assert jaccard_join.similar_components(documents(spark, [])).count() == 0
    rows = [(None, "a b c d"), (5, "a b c d"), (None, None), (None, "q r s"), (2, "A B C D")]
    got = jaccard_join.similar_components(documents(spark, rows)).collect()
    assert sorted(map(tuple, got), key=str) == sorted([(None, 2, 2), (5, 2, 2), (None, 0, None), (None, 1, None), (2, 2, 2)], key=str)


def test_rows_without_an_id_link_others(spark, monkeypatch):
    base = [f"w{i}" for i in range(60)]
    chain = []
    for i in range(8):  # only neighbours are similar
        base[7 * i] = f"v{i}"
        chain.append(" ".join(base))
    rows = [(None if i % 3 else 50 - i, t) for i, t in enumerate(chain)] + [(None, chain[1]), (None, None), (None, "q r s")]
    for blocks in (1024, 2):
        monkeypatch.setattr(jaccard_join, "BLOCK_SETS", blocks)
        got = jaccard_join.similar_components(documents(spark, rows), 3, 90).collect()
        assert sorted((r.doc_id is not None, r.doc_id or 0, r.component_id or 0) for r in got) == sorted((d is not None, d or 0, 44 if t in chain else 0) for d, t in rows)


def test_no_key_is_gathered_in_a_window(spark, monkeypatch):
    plans = []
    write = jaccard_join.connected_components
    monkeypatch.setattr(jaccard_join, "connected_components", lambda edges, label: plans.append(edges._jdf.queryExecution().toString()) or write(edges, label))
    rows = corpus(seed=22, n=30, longest=60)
    got = jaccard_join.similar_components(documents(spark, rows), 3, 90).collect()
    assert sorted(map(tuple, got)) == brute_components(rows, 3, 90) and plans and not any("Window" in p for p in plans)


def test_similar_sets_always_share_a_key():
    rng = np.random.default_rng(5)
    for percent in (80, 90):
        for size in [*range(1, 140, 3), 200, 500, 1100]:
            a = np.unique(rng.integers(0, 1 << 63, size, dtype=np.uint64))
            drop = int(len(a) * (100 - percent) / 100)
            b = a[rng.permutation(len(a))[drop:]] if rng.random() < 0.5 else np.concatenate([a[drop // 2 :], rng.integers(0, 1 << 63, drop // 3, dtype=np.uint64)])
            b = np.unique(b)
            if not len(b) or not signature_tree.similar(a, b, percent):
                continue
            owner, keys = jaccard_join.set_keys(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]), percent)
            assert set(keys[owner == 0].tolist()) & set(keys[owner == 1].tolist())


def test_similar_sets_of_distant_sizes_share_a_key():
    rng = np.random.default_rng(15)
    for percent in (20, 40, 50, 60, 66, 67):
        for size in [*range(5, 140, 3), 500]:
            a = np.unique(rng.integers(0, 1 << 63, size * 100 // percent, dtype=np.uint64))
            b = np.sort(rng.permutation(a)[: -(-percent * len(a) // 100)])
            # steps of texts of their own, so that no set sees the sizes of others
            keys = [set(jaccard_join.set_keys(x, np.array([0, len(x)]), percent)[1].tolist()) for x in (a, b)]
            assert signature_tree.similar(a, b, percent) and keys[0] & keys[1]


def test_sets_two_bands_apart_share_a_key():
    rng = np.random.default_rng(15)  # sizes 81 and 126; the next band ends at 121
    for _ in range(150):
        a = np.unique(rng.integers(0, 1 << 63, 126, dtype=np.uint64))
        b = np.sort(rng.permutation(a)[:81])
        keys = [set(jaccard_join.set_keys(x, np.array([0, len(x)]), 64)[1].tolist()) for x in (a, b)]
        assert keys[0] & keys[1]


def test_tree_links_equal_all_pairs():
    rng = np.random.default_rng(6)
    sets = []
    for _ in range(12):
        base = np.unique(rng.integers(0, 1 << 62, int(rng.integers(3, 200)), dtype=np.uint64))
        for _ in range(int(rng.integers(1, 12))):
            keep = rng.random(len(base)) > 0.04
            keep[0] = True
            sets.append(base[keep])
    for bits in (64, 256, 4096):
        forest, expected = signature_tree.Forest(len(sets)), signature_tree.Forest(len(sets))
        tree = signature_tree.Tree(sets, np.arange(len(sets)), bits)
        signature_tree.link_sets(tree, tree, 90, forest)
        apart = signature_tree.Forest(len(sets))
        half = len(sets) // 2
        sides = [signature_tree.Tree(sets[:half], np.arange(half), bits), signature_tree.Tree(sets[half:], np.arange(half, len(sets)), bits)]
        signature_tree.link_sets(*sides, 90, apart)
        for side in sides:
            signature_tree.link_sets(side, side, 90, apart)
        for i in range(len(sets)):
            for j in range(i):
                if signature_tree.similar(sets[i], sets[j], 90):
                    expected.link(i, j)
        roots = [expected.root(i) for i in range(len(sets))]
        assert [forest.root(i) for i in range(len(sets))] == roots == [apart.root(i) for i in range(len(sets))]


def test_connected_components_of_paths_stars_and_cycles(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, 100 + i) for i in range(1, 40)] + [(200, 201), (201, 202), (202, 200)] + [(7, 7), (-5, 300), (300, -5)]
    found = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    expected = {i: 0 for i in range(31)} | {100 + i: 100 for i in range(40)} | {200: 200, 201: 200, 202: 200, -5: -5, 300: -5}
    assert found == expected
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


# decontamination


def test_contained_items_equal_brute_force(spark, monkeypatch):
    rng = random.Random(7)
    vocabulary = [f"w{i}" for i in range(300)]
    items = [(i, " ".join(rng.choices(vocabulary, k=k))) for i, k in enumerate([4, 5, 6, 9, 12, 17, 30, 60, 100, 250])]
    items += [(20, None), (21, ""), (None, "w1 w2 w3 w4 w5 w6"), (3, items[3][1])]
    rows = [(i, " ".join(rng.choices(vocabulary, k=rng.randrange(1, 3000)))) for i in range(60)]
    for k in range(40):
        item = rng.choice(items[:10])[1].split()
        if rng.random() < 0.5 and len(item) > 20:  # not quite whole
            item[rng.randrange(len(item))] = "changed"
        doc = rows[k][1].split()
        at = rng.randrange(len(doc) + 1)
        rows[k] = (k, " ".join(doc[:at] + item + doc[at:]).upper() if k % 3 else " \n".join(doc[:at] + item + doc[at:]))
    rows += [(90, None), (91, ""), (92, "w1 w2"), (None, items[5][1]), rows[2], rows[2]]

    def shingles(text):
        w = split(text)
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}

    expected = []
    for doc_id, text in rows:
        whole = shingles(text)
        for item_id, item in items:
            own = shingles(item) if item_id is not None else set()
            if own and 100 * len(own & whole) >= 80 * len(own):
                expected.append((doc_id, item_id, len(own & whole), len(own)))
    benchmark = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, doc_id int")
    docs = documents(spark, rows)
    got = sorted(map(tuple, decontamination.contaminated(docs, benchmark).collect()), key=str)
    assert len(expected) > 30 and got == sorted(expected, key=str)
    monkeypatch.setattr(decontamination, "SLICE_ITEMS", 4)
    assert sorted(map(tuple, decontamination.contaminated(docs, benchmark).collect()), key=str) == got
    assert decontamination.contaminated(documents(spark, []), benchmark).count() == 0
    assert decontamination.contaminated(docs, benchmark.where("false")).count() == 0


def test_the_smallest_items_are_always_found(spark):
    rng = random.Random(21)
    items = [(i, " ".join(f"i{i}x{k}" for k in range(n))) for i, n in enumerate([*[5] * 1500, *range(6, 13)])]
    rows = [(i, " ".join(["at"] + rng.choices("abcdefgh", k=9) + text.split() + rng.choices("abcdefgh", k=9))) for i, text in items]
    got = decontamination.contaminated(documents(spark, rows), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert sorted((r.doc_id, r.item_id) for r in got) == [(i, i) for i, _ in items]


def test_items_below_five_words_are_searched_as_a_whole(spark):
    items = spark.createDataFrame([(1, "One two"), (2, "three"), (3, "a b c d"), (4, "a b c d e"), (5, "one TWO"), (6, " "), (7, None), (None, "three")], "item_id long, text string")
    docs = documents(spark, [(1, "zero one\nTwo x one two"), (2, "onetwo two one"), (3, "a b c d"), (4, "three a b c d e f"), (None, "three"), (6, "three four"), (7, ""), (8, None)])
    got = decontamination.contaminated(docs, items, short_items=True).collect()
    expected = [(1, 1, 1, 1), (1, 5, 1, 1), (3, 3, 1, 1), (4, 2, 1, 1), (4, 3, 1, 1), (4, 4, 1, 1), (None, 2, 1, 1), (6, 2, 1, 1)]
    assert sorted(map(tuple, got), key=str) == sorted(expected, key=str)
    assert [tuple(r) for r in decontamination.contaminated(docs, items).collect()] == [(4, 4, 1, 1)]


# toxicity


def toxic_corpus(n=600):
    rng = random.Random(8)
    plain = ["".join(rng.choice(["an", "the", "ing", "ou", "er", "le"]) for _ in range(rng.randrange(1, 4))) for _ in range(300)]
    rows, labels = [], []
    for i in range(n):
        toxic = i % 7 == 0
        text = rng.choices(plain, k=rng.randrange(5, 80))
        if toxic:
            text.insert(rng.randrange(len(text)), rng.choice(["zwackig,", "(Zwackus)", "zwackling"]))
        rows.append((i, " ".join(text)))
        labels.append((i, 1, int(toxic)))
    return rows, labels


def test_held_out_toxicity(spark):
    rows, labels = toxic_corpus()
    rows += [(None, None), (1000, ""), (1001, " "), (1002, "!!! ..."), rows[0], rows[0]]
    marks = spark.createDataFrame(labels + [(None, 1, 1), (3000, 1, None), (0, 1, 1)], "doc_id long, quality int, toxic int")
    docs = documents(spark, rows)
    model = toxicity.fit(docs, marks.where("doc_id is null or doc_id % 4 <> 2"))
    scored = toxicity.score(docs, model)
    assert scored.columns == [*[c for c in docs.columns if c != "score"], "score"] and scored.count() == len(rows)
    got = {r.doc_id: r.score for r in scored.collect()}
    held = [(got[i], t) for i, _, t in labels if i % 4 == 2]
    right = sum((s >= 0.3) == bool(t) for s, t in held) / len(held)
    assert right >= 0.97 and all(0 <= s <= 1 for s in got.values())
    assert got[1000] == got[1001] == got[1002] == got[None] < 0.5


def test_toxicity_without_labels_of_both_kinds(spark):
    docs = documents(spark, [(1, "a"), (2, "b")])
    for labels, least, most in (([], 0, 0.01), ([(1, 1)], 0.99, 1), ([(2, 0)], 0, 0.01)):
        model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
        assert all(least <= r.score <= most for r in toxicity.score(docs, model).collect())
    assert toxicity.score(documents(spark, []), model).count() == 0


def test_the_sample_is_bounded(spark):
    rows, labels = toxic_corpus(100)
    sample = toxicity.training_sample(documents(spark, rows), spark.createDataFrame(labels, "doc_id long, q int, toxic int"), rows=30)
    assert sample.count() == 30


def test_log_count_ratios_are_those_of_naive_bayes():
    toxic, other = np.array([3.0, 0.0, 5.0]), np.array([1.0, 9.0, 5.0])
    p, q = toxic + 2 * 8 / 23, other + 2 * 15 / 23
    assert np.allclose(toxicity.log_count_ratios(toxic, other), np.log(p / p.sum() / (q / q.sum())))


# language model


def test_exact_parts_of_scores(spark):
    rows = corpus(seed=9, n=150, longest=60) + [(None, "a b"), (None, None)]
    got = bloom_lm.score(documents(spark, rows), train=F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) != 1)
    counts = Counter()
    for doc_id, text in rows:
        if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 != 1:
            counts.update([*split(text), None])
    total = sum(counts.values())
    expected = []
    for doc_id, text in rows:
        tokens = [*split(text), None]
        base = sum(math.log10((counts[t] + 0.5) / (total + 0.5 * (len(counts) + 1))) for t in tokens)
        expected.append((doc_id, len(tokens), sum(counts[t] > 0 for t in tokens), total, round(base, 6)))
    rows_got = got.collect()
    assert sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in rows_got), key=str) == sorted(expected, key=str)
    assert all(r.score < 0 for r in rows_got)


def test_rare_words_are_joined_like_frequent_ones(spark, monkeypatch):
    docs = documents(spark, corpus(seed=10, n=60, longest=50))
    train = F.col("doc_id") % 3 != 0
    whole = sorted(map(tuple, bloom_lm.score(docs, train).collect()))
    monkeypatch.setattr(bloom_lm, "FREQUENT", 5)
    again = sorted(map(tuple, bloom_lm.score(docs, train).collect()))
    for a, b in zip(whole, again, strict=True):
        assert a[:4] == b[:4] and np.allclose(a[4:], b[4:])


def test_levels_are_never_below_those_of_the_counts(spark):
    rows = corpus(seed=11, n=80, longest=200)
    docs = documents(spark, rows)
    model = bloom_lm.load(bloom_lm.count(docs))
    words_of, pairs_of = Counter(), Counter()
    for _, text in rows:
        tokens, _ = bloom_lm.token_hashes(pa.array([text], pa.string()))
        words_of.update(tokens.tolist())
        pairs_of.update(bloom_lm.pair_hashes(tokens).tolist())
    for counter, salt in ((words_of, True), (pairs_of, False)):
        grams = np.array(list(counter), dtype=np.uint64)
        asked = bloom_lm.salted(grams, 21) if salt else grams
        found = model.levels(asked, np.full(len(grams), 100))
        true = bloom_lm.levels_of(np.array(list(counter.values())))
        assert (found >= true).all() and (found == true).mean() > 0.99
    strangers = np.arange(1, 20_001, dtype=np.uint64)
    assert (model.levels(words.salted(strangers, 77), np.full(20_000, 9)) > 0).mean() <= model.false_positives + 0.01


def test_a_known_text_is_likelier_than_a_new_one(spark):
    rows = corpus(seed=12, n=100, longest=80)
    text = next(t for _, t in rows if t and len(split(t)) > 40)
    mixed = split(text)
    random.Random(1).shuffle(mixed)
    docs = documents(spark, [*rows, (5000, text), (5001, " ".join(mixed))])
    got = {r.doc_id: r.score for r in bloom_lm.score(docs, F.col("doc_id") < 5000).collect()}
    assert got[5000] > got[5001]


def test_scores_without_training_rows(spark):
    rows = bloom_lm.score(documents(spark, [(1, "a b"), (2, None)]), F.lit(None).cast("boolean")).collect()
    assert sorted((r.doc_id, r.n_tokens, r.n_known, r.train_tokens) for r in rows) == [(1, 3, 0, 0), (2, 1, 0, 0)]
    assert bloom_lm.score(documents(spark, []), F.lit(True)).count() == 0


def test_the_filter_grows_with_its_entries(spark, monkeypatch):
    rows = corpus(seed=13, n=120, longest=200)
    docs = documents(spark, rows)
    monkeypatch.setattr(bloom_lm, "FILTER_BYTES", 1 << 12)
    model = bloom_lm.load(bloom_lm.count(docs))
    assert model.false_positives <= 0.05
    strangers = words.salted(np.arange(1, 20_001, dtype=np.uint64), 77)
    assert (model.levels(strangers, np.full(20_000, 9)) > 0).mean() <= 0.06
    # no word is asked for beyond the level of all tokens, even of a filter that is full
    full = dataclasses.replace(model, bits=np.full_like(model.bits, 255))
    tokens, _ = bloom_lm.token_hashes(pa.array([rows[0][1], "new words"]))
    assert (full.log_probabilities(*np.unique(tokens, return_inverse=True), tokens) <= 0).all()


def test_counts_of_a_step_are_a_row_for_each_segment(monkeypatch):
    rng = random.Random(4)
    texts = [" ".join(f"w{rng.randrange(4000)}" for _ in range(300)) for _ in range(200)] + [None, ""]
    batches = [pa.RecordBatch.from_arrays([pa.array(texts[k : k + 20], pa.string())], ["text"]) for k in range(0, len(texts), 20)]
    tokens, _ = bloom_lm.token_hashes(pa.array(texts, pa.string()))
    true = {True: Counter(tokens.tolist()), False: Counter(bloom_lm.pair_hashes(tokens).tolist())}
    for most in (1 << 30, 20_000, 1):
        monkeypatch.setattr(bloom_lm, "COUNT_TOKENS", most)
        got, rows = {True: Counter(), False: Counter()}, 0
        for part in bloom_lm.step_counts(iter(batches)):
            rows += part.num_rows
            for segment, is_word, grams, n in zip(*(part[x].to_pylist() for x in ("segment", "is_word", "grams", "n")), strict=True):
                grams = np.frombuffer(grams, dtype=np.uint64)
                assert set(((bloom_lm.salted(grams, 21) if is_word else grams) >> np.uint64(64 - bloom_lm.SEGMENT_BITS)).tolist()) == {segment}
                got[is_word].update(dict(zip(grams.tolist(), np.frombuffer(n, dtype=np.int32).tolist(), strict=True)))
        assert got == true
        if most == 1 << 30:  # all batches together, many n-grams in a row
            assert rows <= 2 << bloom_lm.SEGMENT_BITS < len(true[False])


def test_segments_add_up_steps():
    rng = np.random.default_rng(5)
    grams = rng.integers(0, 1 << 52, 3000, dtype=np.uint64)  # all of segment 0
    parts, true = [], Counter()
    for _ in range(80):  # enough for sums to be merged on the way
        some, n = rng.permutation(grams)[:2500], rng.integers(1, 9, 2500).astype(np.int32)
        true.update(dict(zip(some.tolist(), n.tolist(), strict=True)))
        parts.append(([0, False], some.tobytes(), n.tobytes()))
    word = np.array([77], dtype=np.uint64)
    parts += [([9, True], word.tobytes(), np.array([k], dtype=np.int32).tobytes()) for k in (2, 3)]
    batches = [pa.RecordBatch.from_pydict({"segment": pa.array([s], pa.int32()), "is_word": [w], "grams": [g], "n": [n]}) for (s, w), g, n in parts]
    rows = [r for x in bloom_lm._segments(iter(batches)) for r in x.to_pylist()]
    keys = np.array(list(true))
    bits, entries = bloom_lm._enter(keys.astype(np.uint64), np.array(list(true.values())))
    assert rows[0] == {"kind": 1, "key": 0, "n": entries, "bits": bits.tobytes()}
    assert rows[1] == {"kind": 0, "key": 77, "n": 5, "bits": None}
    assert (rows[2]["kind"], rows[2]["key"], len(rows)) == (1, 9, 3)


def test_texts_to_score_go_to_workers_in_small_batches(spark):
    limit = "spark.sql.execution.arrow.maxBytesPerBatch"
    session = spark.newSession()
    docs = documents(session, [(1, "some words"), (2, None)])
    bloom_lm.count(docs)
    assert int(session.conf.get(limit)) == tables.BATCH_BYTES
    session.conf.unset(limit)
    bloom_lm.score(docs, F.lit(False))
    assert int(session.conf.get(limit)) == tables.BATCH_BYTES


def test_a_filter_too_large_to_broadcast_gives_the_same_scores(spark, monkeypatch):
    rows = corpus(seed=14, n=60, longest=80) + [(None, "a b"), (None, None)]
    docs, train = documents(spark, rows), F.col("doc_id") % 3 != 0
    for least in (1 << 12, 1 << 24):
        monkeypatch.setattr(bloom_lm, "FILTER_BYTES", least)
        monkeypatch.setattr(bloom_lm, "BROADCAST_BYTES", 1 << 30)
        whole = sorted(map(tuple, bloom_lm.score(docs, train).collect()), key=str)
        monkeypatch.setattr(bloom_lm, "BROADCAST_BYTES", 0)
        joined = sorted(map(tuple, bloom_lm.score(docs, train).collect()), key=str)
        assert len(whole) == len(joined) == len(rows)
        for a, b in zip(whole, joined, strict=True):
            assert a[:4] == b[:4] and np.allclose(a[4:], b[4:])
    assert bloom_lm.score(documents(spark, []), train).count() == 0


def test_a_large_filter_is_asked_in_few_rows(spark, monkeypatch):
    """Texts are shuffled as numbers of words, and what they ask as a row for each step and segment, not one for each pair or use."""
    texts = [" ".join(f"w{(k * 7919 + i * i) % 6000}" for i in range(300)) for k in range(150)]
    docs = documents(spark, [(k, t) for k, t in enumerate(texts)] + [(None, texts[0]), (None, None)]).coalesce(2)
    tables_stored, keep = {}, bloom_lm.stored

    def noted(df, label):
        tables_stored[label] = keep(df, label)
        return tables_stored[label]

    monkeypatch.setattr(bloom_lm, "stored", noted)
    monkeypatch.setattr(bloom_lm, "BROADCAST_BYTES", 0)
    scores = bloom_lm.score(docs, F.lit(True))
    assert "Join" not in scores._jdf.queryExecution().optimizedPlan().toString()
    assert scores.count() == len(texts) + 2
    pairs = len({(a, b) for t in texts for a, b in zip(["", *t.split()], [*t.split(), ""], strict=True)})
    counts = {label: t.count() for label, t in tables_stored.items() if label != "ngram_counts"}
    assert max(counts.values()) <= 2 << bloom_lm.SEGMENT_BITS < pairs


@pytest.mark.parametrize("n", [0, 1, 7, 5000])
def test_keys_of_segments_are_narrowed_and_widened(n):
    rng = np.random.default_rng(n)
    keys = np.unique(np.concatenate([rng.integers(0, 1 << 64, n, dtype=np.uint64), np.array([0, (1 << 64) - 1], dtype=np.uint64)[: 2 * (n > 1)]]))
    steps, width = bloom_lm._narrow(keys)
    segments = (keys >> np.uint64(64 - bloom_lm.SEGMENT_BITS)).astype(int)
    for segment in np.unique(segments):
        cell = steps[segments == segment].ravel()
        two = bloom_lm._wide([cell, cell[:0], cell], [width, 3, width], int(segment))
        assert (two == np.tile(keys[segments == segment], 2)).all()


def test_texts_of_many_steps_come_back(monkeypatch):
    monkeypatch.setattr(bloom_lm, "COUNT_TOKENS", 50)
    texts = ["a b a", None, "", *(f"w{k % 9} w{k % 4} x" for k in range(60))]
    batch = pa.RecordBatch.from_arrays([pa.array([None, *range(len(texts) - 1)], pa.int64()), pa.array(texts, pa.string())], ["doc_id", "text"])
    monkeypatch.setattr(bloom_lm, "SCORE_STEP", 40)
    rows = [r for x in bloom_lm._text_steps(iter([batch])) for r in x.to_pylist()]
    assert len(rows) > 2 and len({r["step"] for r in rows}) == len(rows)
    tokens = [words[seq] for words, seq in map(bloom_lm._tokens, rows)]
    expected, at = bloom_lm.token_hashes(pa.array(texts, pa.string()))
    assert (np.concatenate(tokens) == expected).all()
    assert [i for r in rows for i in r["ids"]] == batch["doc_id"].to_pylist()
    assert (np.concatenate([np.frombuffer(r["sizes"], "<i4") for r in rows]) == np.diff(at)).all()


def test_stored_tables_leave_no_shuffles(spark):
    def files():
        found = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
        return {x.getName() for x in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(found) if x.getName().startswith("shuffle_")}

    cleaned = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was, before = spark.conf.get(cleaned), files()
    table = tables.stored(spark.range(1000).withColumn("k", F.xxhash64("id")).repartition(8, "k"), "shuffled")
    for _ in range(4):  # they are removed in the background, but do not wait for the driver's garbage
        if left := files() - before:
            time.sleep(0.5)
    assert not left
    assert table.count() == 1000 and spark.conf.get(cleaned) == was


# large clusters and repeated ids


def test_near_copies_under_one_id_are_placed_once(spark, monkeypatch):
    """Texts are fetched by row: near copies that share an id bring no more texts than there are."""
    base = [f"w{i}" for i in range(80)]
    rows = [(7, " ".join([*base[:-1], f"u{i}"])) for i in range(200)] + [(7, " ".join(base))] * 50
    placed = {}
    write = jaccard_join.stored
    monkeypatch.setattr(jaccard_join, "stored", lambda df, label: placed.setdefault(label, write(df, label)))
    got = jaccard_join.similar_components(documents(spark, rows), 3, 90).collect()
    assert len(got) == 250 and {r.component_id for r in got} == {7}
    assert placed["placed"].count() == 201


def test_only_shingles_of_items_are_hashed_for_minima(monkeypatch):
    """Of a document, the passages it has of items, wherever they begin and whatever gaps they have; nothing of the rest."""
    rng = random.Random(31)
    items = [" ".join(f"i{n}_{k}" for k in range(size)) for n, size in enumerate([13, 20, 21, 36, 37, 70, 150, 300])]
    index = decontamination.ItemIndex([*range(len(items))], items)
    texts, wanted = [" ".join(f"z{k}" for k in range(5000))], set()
    for _ in range(120):
        n = rng.randrange(len(items))
        words_of = items[n].split()
        shingles = len(words_of) - 4
        if rng.random() < 0.6 and shingles >= 25:  # one word differs: five shingles are missing
            words_of[rng.randrange(len(words_of))] = "other"
        wanted.add((len(texts), n))
        texts.append(" ".join([*(f"y{k}" for k in range(rng.randrange(400))), *words_of, *(f"x{k}" for k in range(rng.randrange(90)))]))
    values, starts = words.shingle_hashes(*words.word_hashes(pa.array(texts)), 5, whole_if_short=False)
    hashed = []
    minima = decontamination._minima
    monkeypatch.setattr(decontamination, "_minima", lambda v, cuts: hashed.append(len(v)) or minima(v, cuts))
    assert index.candidates(values, np.diff(starts)) == wanted
    assert sum(hashed) == np.isin(values, np.concatenate(index.sets)).sum()
    assert index.candidates(values[: starts[1]], np.diff(starts[:2])) == set()


def test_texts_that_only_share_a_passage_are_not_moved(spark, monkeypatch):
    """They share keys, but their sketches tell that they are not similar: no cluster grows from them."""
    passage = [f"p{i}" for i in range(40)]
    rows = [(i, " ".join([*passage, *(f"o{i}_{k}" for k in range(60 + i % 20))])) for i in range(150)]
    rows.append((500, rows[3][1] + " more"))
    placed = {}
    write = jaccard_join.stored
    monkeypatch.setattr(jaccard_join, "stored", lambda df, label: placed.setdefault(label, write(df, label)))
    for width, percent in ((3, 90), (5, 80)):
        placed.clear()
        got = jaccard_join.similar_components(documents(spark, rows), width, percent).collect()
        assert sorted(map(tuple, got)) == brute_components(rows, width, percent)
        assert placed["key_groups"].count() > 2 and placed["placed"].count() == 2


@pytest.mark.parametrize("percent", [64, 80, 90])
def test_sketches_keep_all_similar_sets(percent):
    rng = np.random.default_rng(percent)
    for size in (1, 5, 24, 63, 64, 65, 200, 1000, 70_000):
        a = np.unique(rng.integers(0, 1 << 63, size, dtype=np.uint64))
        b = np.unique(np.concatenate([a[len(a) * (100 - percent) // (100 + percent) :], rng.integers(0, 1 << 63, size // 50, dtype=np.uint64)]))
        c = np.unique(rng.integers(0, 1 << 63, size, dtype=np.uint64))
        sets = [a, a[size * (100 - percent) // 100 :], b, c]
        sketches = jaccard_join.parity_sketches(np.concatenate(sets), np.cumsum([0, *map(len, sets)]))
        facts = {"cluster": [1] * 4, "block": [0] * 4, "side": [0] * 4, "part": [*range(4)], "n": [*map(len, sets)]}
        found = set(zip(*jaccard_join._likely_pairs(pa.table({**facts, "sketch": sketches}), percent), strict=True))
        similar = {(i, j) for i in range(4) for j in range(i + 1, 4) if signature_tree.similar(sets[i], sets[j], percent)}
        assert similar <= found and ((0, 3) not in found or size < 63)


def test_a_broken_cluster_is_compared_by_shared_keys(spark, monkeypatch):
    """Groups that only share a passage, and chains inside them, over many blocks."""
    rng = random.Random(8)
    passage = [f"p{i}" for i in range(16)]
    rows, i = [], 0
    for group in range(30):
        own = [f"g{group}_{k}" for k in range(rng.randrange(2, 14))]
        for _ in range(rng.randrange(1, 9)):
            words = [*passage, *own]
            if rng.random() < 0.7:
                words[rng.randrange(len(words))] = f"x{i}"
            rows.append((i, " ".join(words)))
            i += 1
    moved = []
    link = jaccard_join._link_blocks
    monkeypatch.setattr(jaccard_join, "_link_blocks", lambda df, *a: moved.append(df.count()) or link(df, *a))
    for blocks in (1024, 5, 2):
        monkeypatch.setattr(jaccard_join, "BLOCK_SETS", blocks)
        for percent in (80, 90):
            got = jaccard_join.similar_components(documents(spark, rows), 3, percent).collect()
            assert sorted(map(tuple, got)) == brute_components(rows, 3, percent), (blocks, percent)


def test_chain_over_many_blocks_moves_few_rows(spark, monkeypatch):
    base, rows = [f"w{i}" for i in range(150)], []
    for i in range(120):  # neighbours are similar, ends are not
        if i % 3 == 0:
            base[i * 7 % 150] = f"v{i}"
        rows.append((i, " ".join(base) + f" t{i}"))
    moved = []
    link = jaccard_join._link_blocks
    monkeypatch.setattr(jaccard_join, "_link_blocks", lambda df, *a: moved.append(df.count()) or link(df, *a))
    monkeypatch.setattr(jaccard_join, "BLOCK_SETS", 10)
    got = jaccard_join.similar_components(documents(spark, rows), 3, 90).collect()
    assert sorted(map(tuple, got)) == brute_components(rows, 3, 90)
    assert moved[0] == len(rows) and sum(moved) < 12 * len(rows)  # as many blocks, and all pairs of them, would be 132 times


def test_small_tables_take_few_tasks(spark, monkeypatch):
    """However many partitions shuffles have, a few edges or blocks are done by a task for each core at most, and blocks stay whole."""
    most, files = spark.sparkContext.defaultParallelism, []
    write = tables.stored

    def noted(df, label):
        out = write(df, label)
        files.append(len(out.inputFiles()))
        return out

    monkeypatch.setattr(tables, "stored", noted)
    edges = spark.createDataFrame([(0, i) for i in range(1, 300)] + [(500, 501), (502, 501)], "a long, b long")
    blocks = spark.range(4000).selectExpr("id % 40 cluster", "id % 7 block", "id")
    settings = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        found = {r.node: r.component for r in connected_components(edges).collect()}
        placed = jaccard_join._by_block(blocks, ["cluster", "block", "id"], 3)
        tasks = placed.rdd.glom().collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert found == {**dict.fromkeys(range(300), 0), 500: 500, 501: 500, 502: 500}
    assert 0 < max(files) <= most
    assert len(tasks) <= most and sum(map(len, tasks)) == 4000
    seen = [(r.cluster, r.block) for t in tasks for k, r in enumerate(t) if not k or (r.cluster, r.block) != (t[k - 1].cluster, t[k - 1].block)]
    assert len(seen) == len(set(seen)) == 280
