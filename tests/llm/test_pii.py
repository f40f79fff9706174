"""Personal data: rules against plain regular expressions, the CRF against enumeration, the model on labels kept from it."""

import hashlib
import itertools
import random
import re

import numpy as np
import pytest

from halfstar.llm import pii, queries, span_crf

SMALL = "/root/testdata/sf0.001"
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute(text):
    out = []
    for kind, pattern in enumerate(PLAIN.values()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == 1 and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == 2:
                doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
                if not 13 <= len(digits) <= 19 or sum(d // 10 + d % 10 for d in doubled) % 10:
                    continue
            if kind == 3 and not 9 <= len(digits) <= 15:
                continue
            out.append((kind, *m.span()))
    return out


def written(spans):
    return ",".join(f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in spans)


ODD = [
    "", " ", "a@b.c@d.e", "@", "x@@y.z", "é.x@ex.com, ü@a.b", "a@b a@b.c.", "_a@b.c-d.e_", "1.2.3.4.5.6.7.8", "1.2.3.256 255.255.255.255 0001.002.0.0", "1.2.3..4.5.6.7",
    "4111 1111 1111 1111", "4111-1111-1111-1111 1", "4111111111111112", "٤111111111111111", "+1 (555) 010-9999", "+12", "+1 2", "++49 (0) 30.123456-", "+1 (555) 010-9999 4111 1111 1111 1111",
    "+123456789012345678", "🙂 a@b.c 🙂", "9" * 5000 + "." + "1" * 5000 + ".2.3", "+" * 50 + "1" * 40, "1 " * 3000,
]


def test_rules_equal_plain_expressions():
    rng = random.Random(4)
    parts = ["a", "@", ".", "b.c", "1", "22", "255", "256", " ", "-", "+", "(", ")", "4111111111111111", "é", "0", "99", "%"]
    texts = [t for t in ODD if len(t) < 4000] + ["".join(rng.choices(parts, k=rng.randrange(1, 30))) for _ in range(4000)]
    for text in texts:
        assert pii.base_spans(text) == brute(text), text


def test_long_runs_are_read_once():
    for text in ("x" * 300_000, "1" * 300_000, "1." * 200_000, "+" + "-" * 300_000, "a@" * 100_000, "1 " * 200_000, "@" * 200_000):
        pii.base_spans(text)


def test_slopes_equal_differences():
    rng = np.random.default_rng(3)
    chars = rng.integers(0, span_crf.PAD + 1, (5, 3)).astype(np.uint8)
    tags = np.array([[0, 1, 3], [1, 2, 4], [2, 0, 0], [0, 3, 1], [0, 4, 2]], dtype=np.uint8)
    parameters = [p + rng.normal(0, 0.05, p.shape) for p in span_crf.start(("x", "y"))]
    _, slopes = span_crf.gradients(parameters, chars, tags)
    for p, slope in zip(parameters, slopes, strict=True):
        for _ in range(12):
            at = tuple(rng.integers(0, n) for n in p.shape)
            if p.shape[-1] == span_crf.PAD + 1:
                at = (at[0], int(chars[rng.integers(0, 5), rng.integers(0, 3)]))
            old, losses = p[at], []
            for d in (1e-5, -1e-5):
                p[at] = old + d
                losses.append(span_crf.gradients(parameters, chars, tags)[0])
            p[at] = old
            assert abs((losses[0] - losses[1]) / 2e-5 - slope[at]) < 1e-4 * max(1, abs(slope[at]))


def test_best_path_and_bound_equal_enumeration(monkeypatch):
    rng, skipped = np.random.default_rng(5), 0
    ok = span_crf.allowed(2)
    model = span_crf.train(np.zeros((0, 4), np.uint8), np.zeros((0, 4), np.uint8), ("x", "y"))
    for _ in range(60):
        ahead = rng.normal(rng.choice([-1, -5]), 1.5, (4, 4, 1)).astype(np.float32)
        transitions = np.where(ok, rng.normal(0, 1, (5, 5)), -1e4).astype(np.float32)
        full = np.concatenate([np.zeros((4, 1), np.float32), ahead[:, :, 0]], axis=1)
        paths = {p: sum(full[t, k] for t, k in enumerate(p)) + sum(transitions[a, b] for a, b in zip(p[:-1], p[1:])) for p in itertools.product(range(5), repeat=4)}
        best = tuple(span_crf.viterbi(ahead, transitions)[:, 0].tolist())
        assert abs(paths[best] - max(paths.values())) < 1e-4
        monkeypatch.setattr(span_crf, "_ahead", lambda m, c, tags: ((t, ahead[t, tags - 1]) for t in range(3, -1, -1)))
        assert span_crf.may_hold(model._replace(transitions=transitions), np.zeros((4, 1), np.uint8))[0] or best == (0, 0, 0, 0)
        skipped += not span_crf.may_hold(model._replace(transitions=transitions), np.zeros((4, 1), np.uint8))[0]
    assert skipped > 3


def test_windows_cover_texts_and_their_middles_once():
    wide = span_crf.WINDOW
    sizes = np.array([0, 1, 32, wide - 1, wide, wide + 1, 2 * wide - 32, 2 * wide - 31, 5000])
    text, begin = span_crf.windows_of(sizes)
    for k, n in enumerate(sizes.tolist()):
        covered = sorted(begin[text == k].tolist())
        assert (not covered) == (n == 0)
        assert all(b - a == span_crf.WINDOW - span_crf.OVERLAP for a, b in zip(covered[:-1], covered[1:]))
        assert not covered or (covered[0] == 0 and covered[-1] + span_crf.WINDOW >= n and (n <= span_crf.WINDOW or covered[-1] < n))


def corpus(n=1500, seed=1):
    """Texts with planted data, one in six without."""
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefghiklmnoprstuvé") for _ in range(rng.randrange(2, 9))) for _ in range(500)]
    texts = []
    for i in range(n):
        parts = rng.choices(words, k=rng.randrange(5, 60))
        made = [
            lambda: f"{rng.choice(words).replace('é', 'e')}.{rng.randrange(99)}@mail{rng.randrange(9)}.example.com",
            lambda: ".".join(str(rng.randrange(256)) for _ in range(4)),
            lambda: f"+1 ({rng.randrange(1000):03}) 555-{rng.randrange(10000):04}",
            lambda: str(rng.randrange(10**6)),
        ]
        if i % 6:
            parts.insert(rng.randrange(len(parts)), made[i % 4]())
        texts.append(" ".join(parts))
    return texts


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.createDataFrame(list(enumerate(corpus())), "doc_id long, text string").repartition(4)
    return pii.fit(pii.labelled_spans(docs))


def test_model_finds_spans_that_it_has_not_seen(model):
    assert np.isfinite(model.evidence[[0, 1, 3]]).all() and np.isinf(model.evidence[2])
    texts = corpus(600, seed=9)
    labels = {(t, *s) for t, text in enumerate(texts) for s in brute(text) if s[0] != 2}
    found = set(pii.added(model, texts))
    assert len(found & labels) > 0.9 * len(labels) and len(found - labels) < 0.05 * len(labels)


def test_rewritten_data_are_added_and_rules_stay(spark, model):
    rng = random.Random(2)
    texts = corpus(60, seed=11) + [t + f" call 001 ({rng.randrange(1000):03}) 555-{rng.randrange(10000):04} now" for t in corpus(60, seed=12)]
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t in enumerate(texts)], "doc_id long, text string, spans string, base string")
    rows = {r.doc_id: r for r in pii.find(docs, model).collect()}
    more = 0
    for i, text in enumerate(texts):
        base = [(pii.KINDS.index(s.kind), s.start, s.end) for s in rows[i].spans if s.base]
        others = [s for s in rows[i].spans if not s.base]
        assert base == brute(text)
        assert not any(a < s.end and s.start < b for s in others for _, a, b in base)
        more += any(s.kind == "phone" and text[s.start : s.end].startswith("001") for s in others)
    assert more > 40


def test_a_span_across_windows_stays_whole(model):
    filler = "abel omira tuben "
    data = "+1 (555) 555-0199"
    for shift in range(span_crf.WINDOW - 56, span_crf.WINDOW + 6, 5):
        text = (filler * 40)[:shift] + " " + data + " " + filler * 40
        assert (0, 3, shift + 1, shift + 1 + len(data)) in pii.added(model, [text])


def test_odd_texts_have_spans_of_the_rules(spark, model):
    texts = [None, *ODD, "word " * 100_000 + "a@b.cd", ODD[2], ODD[2]]
    ids = [None, 1, 1, *range(len(texts) - 3)]
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in zip(ids, texts)], "doc_id long, text string, start int, kind string").repartition(3)
    rows = pii.find(docs, model).collect()
    strip = lambda spans: [(pii.KINDS.index(s.kind), s.start, s.end) for s in spans if s.base]
    got = sorted(((r.doc_id, r.text, strip(r.spans)) for r in rows), key=repr)
    assert got == sorted(((i, t, brute(t) if t and len(t) < 9000 else [(0, 500_000, 500_006)] if t and "word" in t else brute(re.sub("9{4000}|1{4000}", "", t)) if t else []) for i, t in zip(ids, texts)), key=repr)
    assert pii.find(docs.where("false"), model).count() == 0


def test_model_of_no_labels_adds_nothing(spark):
    empty = spark.createDataFrame([(1, None, None), (2, "", []), (None, "a@b.c", None)], "doc_id long, text string, spans array<struct<kind: string, start: int, end: int>>")
    nothing = pii.fit(empty)
    assert np.isinf(nothing.evidence).all() and pii.added(nothing, ["a@b.c and 1.2.3.4", ""]) == []
    assert np.isinf(pii.fit(empty.where("false")).evidence).all()


def test_redaction_keeps_offsets(spark):
    docs = spark.createDataFrame([(1, "mail a@b.cd or 1.2.3.4 é")], "doc_id long, text string")
    found = pii.find(docs, pii.fit(pii.labelled_spans(docs)))
    assert found.select(pii.redacted(found["text"], found["spans"])).first()[0] == "mail ****** or ******* é"


def test_sample_is_bounded_and_of_all(spark):
    docs = spark.range(3000).selectExpr("id as doc_id", "concat('t', id) as text")
    assert pii.sample(docs, 5000).count() == 3000
    few = sorted(r.doc_id for r in pii.sample(docs, 200).collect())
    assert 150 < len(few) <= 200 and few == sorted(r.doc_id for r in pii.sample(docs.repartition(7), 200).collect())


def test_registered_query_keeps_the_rules(spark):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    result = queries.QUERIES["op12_pii"](spark, SMALL)
    assert result.dtypes == [("doc_id", "bigint")] + [(f"n_{k}", "bigint") for k in pii.KINDS] + [("base_sha256", "string"), ("spans", "string")]
    rows = result.collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        base = brute(texts[r.doc_id])
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(k == n for k, _, _ in base) for n in range(4))
        assert r.base_sha256 == hashlib.sha256(written(base).encode()).hexdigest()
        parts = [p for p in r.spans.split(",") if p]
        assert set(written([s]) for s in base) <= set(parts)
        order = [(pii.KINDS.index(k), int(a)) for k, a, _ in (p.split(":") for p in parts)]
        assert order == sorted(order)
