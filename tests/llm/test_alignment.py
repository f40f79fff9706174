"""Token alignment against brute force over all token pairs, with the libraries called on whole texts."""

import hashlib
import random
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from halfstar.llm import alignment, queries

SMALL = "/root/testdata/sf0.001"
JSON = open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8").read()
MODEL = open(public_tokenizers.path("piece_bpe_32k.model"), "rb").read()


@pytest.fixture(scope="module")
def libraries():
    tokenizer = Tokenizer.from_str(JSON)
    tokenizer.encode_special_tokens = True
    model = sentencepiece.SentencePieceProcessor(model_proto=MODEL)
    return tokenizer, alignment.byte_level_entries(JSON), model, alignment.piece_entries(model)


def tokens(text, libraries):
    tokenizer, entries, model, pieces = libraries
    if not text:
        return [], []
    a, b = tokenizer.encode(" " + text, add_special_tokens=False).ids, model.encode(text)
    whole = (" " + text).encode()
    return (a, b) if b"".join(entries[i] for i in a) == whole == b"".join(pieces[i] for i in b) else ([], [])


def spans(ids, entries):
    out, at = [], 0
    for i in ids:
        out.append((at, at + len(entries[i])))
        at = out[-1][1]
    return out


def brute(texts, libraries):
    """Digest rows, without `doc_id`, of some texts."""
    rows, all_links = [], []
    for text in texts:
        a, b = tokens(text, libraries)
        x, y = spans(a, libraries[1]), spans(b, libraries[3])
        links, j = [], 0
        for i, (low, high) in enumerate(x):
            while j and y[j][0] > low:
                j -= 1
            while y[j][1] <= low:
                j += 1
            k = j
            while k < len(y) and y[k][0] < high:
                links.append((i, k))
                k += 1
        common = sorted({e for _, e in x} & {e for _, e in y})
        groups, low = [], 0
        for end in common:
            parts = [",".join(str(t) for t, (p, q) in zip(ids, at) if low <= p and q <= end) for ids, at in ((a, x), (b, y))] if len(a) < 3000 else None
            groups.append(parts)
            low = end
        digest = hashlib.sha256(";".join("|".join(g) for g in groups).encode()).hexdigest() if a and len(a) < 3000 else "" if not a else None
        rows.append([len(a), len(b), len(common), len(links), digest])
        all_links.append([(a[i], b[j]) for i, j in links])
    count = Counter(p for links in all_links for p in links)
    best = defaultdict(int)
    for (_, b), n in count.items():
        best[b] = max(best[b], n)
    return [tuple(r[:4]) + (sum(count[p] == best[p[1]] for p in links), sum(count[p] for p in links), r[4]) for r, links in zip(rows, all_links)]


def digests(df):
    return [(r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in df.collect()]


def same(got, want):
    """Equal rows; digests that brute force has left out are not compared."""
    known = {(r[0], *r[1:7]) for r in want if r[7] is None}
    strip = lambda rows: sorted((r[:7] + ((None,) if r[:7] in known else (r[7],)) for r in rows), key=repr)
    assert strip(got) == strip(want)


ODD = [
    None, "", " ", "  ", "a", " a", "a ", "plain words", "two  spaces and   three", "tab\tline\nend\n", "<s></s><unk><|endoftext|> x", "<0x41> ▁", "U+2581▁inside",
    "naïve café, 北京 日本語 🙂🙂 é", "\x00\x01", "don't we'll 12345 67", "x" * 3000, "word " * 500, "  leading", " wide　space", "plain words",
]


def test_runs_find_every_link():
    rng = random.Random(5)
    for _ in range(2000):
        end = rng.randrange(1, 60)
        a = sorted({rng.randrange(1, end + 1) for _ in range(rng.randrange(end))} | {end})
        b = sorted({x for x in a if rng.random() < 0.8} | {rng.randrange(1, end + 1) for _ in range(rng.randrange(4))} | {end})
        runs, groups = alignment.diagonal_runs(a, b)
        found = {(a[i + k], b[j + k]) for i, j, n in zip(*[iter(runs)] * 3) for k in range(n)}
        assert all(x == y for x, y in found)
        found |= {(a[i], b[j]) for _, _, i, j in zip(*[iter(groups)] * 4)}
        assert sorted(found) == [(x, x) for x in sorted(set(a) & set(b))]
        before_a, before_b = [0, *a], [0, *b]
        assert all(before_a[i] == before_b[j] for i, j, _, _ in zip(*[iter(groups)] * 4))


def test_digests_equal_brute_force(spark, libraries, monkeypatch):
    rng = random.Random(3)
    texts = ODD + [" ".join(rng.choices([t for t in ODD if t and len(t) < 100], k=rng.randrange(1, 20))) for _ in range(60)]
    ids = [None, 1, 1, *range(2, len(texts) - 1)]
    docs = spark.createDataFrame([(i, t, "x", 1, "y") for i, t in zip(ids, texts)], "doc_id long, text string, pairs string, row long, n_a string").repartition(5)
    want = [(i, *r) for i, r in zip(ids, brute(texts, libraries))]
    for limit in (alignment.FREQUENT, 50, 0):  # counts broadcast, most of them joined, all joined
        monkeypatch.setattr(alignment, "FREQUENT", limit)
        same(digests(alignment.link_counts(docs, JSON, MODEL)), want)
    assert alignment.link_counts(docs.where("false"), JSON, MODEL).count() == 0
    nothing = alignment.link_counts(docs.where("text is null or text = ''"), JSON, MODEL).collect()
    assert len(nothing) == 2 and all(r.n_links == r.count_sum == 0 and r.groups_sha256 == "" for r in nothing)


def test_groups_come_back_as_lists(spark, libraries):
    docs = spark.createDataFrame(list(enumerate(ODD)), "doc_id long, text string")
    for r in alignment.alignments(docs, JSON, MODEL).collect():
        a, b = tokens(ODD[r.doc_id], libraries)
        assert (r.a_ids, r.b_ids) == (a, b) and len(r.a_ends) == len(r.b_ends)
        ends_a, ends_b = ([q for _, q in spans(ids, e)] for ids, e in ((a, libraries[1]), (b, libraries[3])))
        assert [(ends_a[i - 1], ends_b[j - 1]) for i, j in zip(r.a_ends, r.b_ends)] == [(e, e) for e in sorted(set(ends_a) & set(ends_b))]


def test_registered_query_equals_brute_force(spark, libraries):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    want = [(r.doc_id, *x) for r, x in zip(rows, brute([r.text for r in rows], libraries))]
    result = queries.QUERIES["op11_token_alignment"](spark, SMALL)
    assert result.columns[:8] == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert [t for _, t in result.dtypes] == ["bigint"] * 7 + ["string"]
    same(digests(result), want)
