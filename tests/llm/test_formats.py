"""Encoders, files, rules, conversations and embeddings against brute force and exact round trips."""

import base64
import hashlib
import random
import re
import tracemalloc
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
import zstandard
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from halfstar.llm import bpe, chat, embedding_dedup, files, queries, token_records, url_rules, warc

PIECES = ["a", "b ", " ", "  ", "\n", "'ll", "'", "'v", "e", " é", "1", "\t", "\u3000", "\x1c", "<|endoftext|>", "!", "\u00a0", "x y", "x,y.\r\n", ".\n", "a's", "9.5", "日本", "😀", "the and ing"]


def random_texts(seed, n=800, longest=40):
    rng = random.Random(seed)
    return ["".join(rng.choice(PIECES) for _ in range(rng.randrange(0, longest))) for _ in range(n)]


# byte-level BPE


@pytest.fixture(scope="module")
def vocabulary():
    return queries.vocabulary()


@pytest.fixture(scope="module")
def library(vocabulary):
    return tiktoken.Encoding("own", pat_str=vocabulary.pattern, mergeable_ranks=vocabulary.ranks, special_tokens={})


@pytest.mark.parametrize(("chars", "size"), [(4, 2), (8, 4), (16, 8), (1 << 13, 64)])
def test_ids_equal_those_of_the_library(vocabulary, library, monkeypatch, chars, size):
    monkeypatch.setattr(bpe, "LEAF_CHARS", chars)
    monkeypatch.setattr(bpe, "LEAF_BYTES", size)
    encoder = bpe.Encoder(vocabulary)
    rng = random.Random(3)
    long = ["a" * 3000, "ab" * 900, " " * 2000 + "x", "thethethe" * 300, "日本" * 500, "".join(rng.choice("abcdefghij") for _ in range(4000))]
    for text in [*random_texts(chars), *long]:
        ids = np.frombuffer(encoder.encode(text), "<i4").tolist()
        assert ids == library.encode_ordinary(text)
        assert bpe.decode_ids(vocabulary.tokens, ids) == text.encode()


def test_long_merges_equal_short_ones(vocabulary):
    encoder = bpe.Encoder(vocabulary)
    rng = random.Random(4)
    for _ in range(300):
        raw = "".join(rng.choice("abthein é") for _ in range(rng.randrange(2, 80))).encode()
        if raw not in vocabulary.ranks:
            assert encoder.merge(raw) == encoder.merge_long(raw)


def test_encoding_and_decoding_of_rows(spark, vocabulary, library):
    rows = [(1, "Hello world", "x", "y"), (2, None, "x", None), (2, "", None, "y"), (None, "x" * 20_000, "z", "z"), (1, "Hello world", "x", "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, decoded string")
    encoded = bpe.encode(docs, vocabulary)
    assert encoded.columns == ["doc_id", "text", "decoded", "ids"]
    got = bpe.decode(encoded, vocabulary).collect()
    assert sorted(r.text or "" for r in got) == sorted(r[1] or "" for r in rows)
    for r in got:
        assert list(r.ids) == library.encode_ordinary(r.text or "") and bytes(r.decoded) == (r.text or "").encode()
    again = bpe.round_trip(docs, vocabulary)
    assert sorted(map(str, again.select("ids", "decoded").collect())) == sorted(str(r) for r in bpe.decode(encoded, vocabulary).select("ids", "decoded").collect())
    assert bpe.encode(docs.where("false"), vocabulary).count() == 0 == bpe.round_trip(docs.where("false"), vocabulary).count()
    nothing = spark.createDataFrame([(1, None)], "doc_id long, ids array<int>")
    assert bytes(bpe.decode(nothing, vocabulary).first().decoded) == b""


# token records


def test_chunks_encode_like_whole_texts():
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        source = file.read()
    whole = Tokenizer.from_str(source)
    whole.encode_special_tokens = True
    encoder = token_records.LibraryEncoder(source, 2)
    texts = [*random_texts(5, 3000), "", None, " ", "a ", " a", "a\u00a0 b", "a \u2003b c", "é à"]
    for size in (1, 7, len(texts)):
        for k in range(0, len(texts), size):
            part = texts[k : k + size]
            for text, ids in zip(part, encoder.encode(pa.array(part, pa.string())), strict=True):
                assert ids.tolist() == whole.encode(text or "", add_special_tokens=False).ids


def test_token_files(spark, tmp_path):
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        source = file.read()
    whole = Tokenizer.from_str(source)
    whole.encode_special_tokens = True
    rows = [(i * 7 % 101, t) for i, t in enumerate(random_texts(6, 101))] + [(5, None), (5, ""), (None, "null id"), (-3, "w " * 5000)]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, file string, start int")
    index = token_records.write_records(docs, source, 2, f"file://{tmp_path}")
    got = sorted(map(tuple, token_records.read_records(index).collect()), key=lambda r: r[1])
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    expected, start = [], 0
    for doc_id, text in rows:
        ids = [*whole.encode(text or "", add_special_tokens=False).ids, 2]
        expected.append((doc_id, start, zlib.crc32(np.array(ids, "<u4").tobytes()), len(ids)))
        start += len(ids)
    assert got == expected
    shuffled = token_records.read_at(index.orderBy(F.rand(1))).collect()
    assert sorted((str(r.doc_id), len(r.ids), zlib.crc32(np.array(r.ids, "<u4").tobytes())) for r in shuffled) == sorted((str(d), n, c) for d, _, c, n in expected)
    assert token_records.read_records(token_records.write_records(docs.where("false"), source, 2)).count() == 0


def test_damaged_records_are_noticed():
    raw = b"".join(token_records.frame(bytes([k]) * k) for k in range(50))
    assert [len(d) for d in token_records.unframe(raw[k : k + 7] for k in range(0, len(raw), 7))] == list(range(50))
    for broken in (raw[:-1], raw[:5] + b"\x01" + raw[6:], raw[:-6] + b"x" + raw[-5:]):
        with pytest.raises(ValueError):
            list(token_records.unframe([broken]))


# WARC


def test_archives(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "FILE_BYTES", 20_000)
    monkeypatch.setattr(warc, "SAMPLE_BYTES", 5_000)
    rng = random.Random(7)
    rows = [(i, f"http://h/{i} é\r\n%", "<html>" + " ".join(rng.choices(["tag", "word", "é"], k=rng.randrange(0, 400)))) for i in range(80)]
    rows += [(100 + i, None, "<html>same") for i in range(40)] + [(200, "", None), (201, "u", ""), (None, "u", "<html>same"), (None, None, None), (3, "x", rows[3][2]), (139, "y", "<html>same")]
    rows += [(300, "u", "z" * 100_000)]
    pages = spark.createDataFrame([(i, u, h, "x") for i, u, h in rows], "page_id long, url string, html string, digest string")
    for least in (0, 11):
        files = warc.write_archives(pages, least, f"file://{tmp_path}/{least}")
        got = warc.read_archives(files).collect()
        best = {}
        for page_id, _, html in rows:
            if page_id is not None:
                best[html or ""] = max(best.get(html or "", page_id), page_id)
        expected = []
        for page_id, _, html in rows:
            raw = (html or "").encode()
            revisit = page_id is not None and len(raw) >= least and page_id < best[html or ""]
            digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
            expected.append((page_id, len(raw), digest, "revisit" if revisit else "response", best[html or ""] if revisit else None))
        assert sorted((tuple(r)[:5] for r in got), key=str) == sorted(expected, key=str)
        assert files.agg(F.sum("records")).first()[0] == len(rows) and files.count() > 2
    assert warc.read_archives(warc.write_archives(pages.where("false"))).count() == 0


def test_archives_are_zstandard_with_a_leading_dictionary(spark, tmp_path):
    pages = spark.createDataFrame([(i, "u", f"<html>{i} text of page {i}" * 50) for i in range(300)], "page_id long, url string, html string").coalesce(1)
    address = warc.write_archives(pages, 0, f"file://{tmp_path}").first().file
    with open(address.removeprefix("file://"), "rb") as file:
        raw = file.read()
    size = int.from_bytes(raw[4:8], "little")
    assert raw[:4] == bytes.fromhex("5d2a4d18") and raw[8:12] == bytes.fromhex("37a430ec")  # skippable frame, trained dictionary
    reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw[8 : 8 + size]))
    text = reader.stream_reader(raw[8 + size :], read_across_frames=True).read()
    assert text.count(b"WARC/1.1\r\n") == 300 and len(raw) < len(text) / 3
    with pytest.raises(ValueError):
        list(warc.read_archive([raw[:-3]]))


# URL rules


def brute_verdict(url, rules, default="allow"):
    host = path = ""
    if url is not None and "://" in url:
        host, path = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1], re.S).groups()
        host = host.translate({i: i + 32 for i in range(65, 91)})
    fit = [(len(h), len(p or ""), h, p or "", a) for h, p, a in rules if h and a and (host == h or host.endswith("." + h)) and path.startswith(p or "")]
    best = max(fit) if fit else None
    return host, path, best and best[2] + best[3], best[4] if best else default


RULES = queries.URL_RULES
MORE = [*RULES, ("com", "/x", "block"), ("a.example.com", "/de/", "allow"), ("a.example.com", "/de/q", "block"), ("example.com", None, "block"), (None, "/", "block"), ("org", "/", None), ("net", "/", "block")]


def test_verdicts_equal_brute_force(spark):
    rng = random.Random(8)
    urls = [None, "", "abc", "http://", "http://NET/", "x://y://z/a", "http://example.net?x", "http://example.net/en/#a", "https://my-example.net/en/a", "http://example.net./", "http://.net/", "http://a.b-c.net/", "http://ne/", "http://net0/", "http://ex\nample.net/en/\nx", "http://É.net/", "HTTP://a@b.net:80/%2F"]
    for _ in range(1500):
        host = ".".join(rng.choice(["a", "b", "example", "net", "com", "org", "example-x", "Net"]) for _ in range(rng.randrange(1, 5)))
        urls.append(f"http://{host}{rng.choice(['', '/', '/de/', '/de/q', '/en/', '/fr/x?y', '/x#', '?a/de/', '/' + 'y' * 3000])}")
    rows = [*enumerate(urls), (None, urls[7]), (7, urls[7])]
    pages = spark.createDataFrame([(i, u, "x", 1) for i, u in rows], "page_id long, url string, at string, sweep int")
    for rules in (RULES, MORE, []):
        table = spark.createDataFrame(rules, "host string, path string, action string")
        got = sorted(map(tuple, url_rules.judge(pages, table).collect()), key=str)
        assert got == sorted(((i, *brute_verdict(u, rules)) for i, u in rows), key=str)
    assert url_rules.judge(pages.where("false"), table).count() == 0


@pytest.mark.parametrize("query", ["op7_url_filters", "op10_chat_formatting"])
def test_native_queries_run_no_python(spark, query):
    plan = queries.QUERIES[query](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


# conversations


def test_examples_read_back(spark):
    rng = random.Random(9)
    parts = ["</s>", "[INST]", "<|im_end|>", "<|im_start|>", "\n", "\\", "a", "é", "<", "|>", "[", "/INST]", "<<SYS>>", "$1", "<\\/s>", "<|im_end|>\n<|im_start|>", "😀", "<|", " "]
    rows = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]"), (None, None, None, None), (5, 1, "assistant", "x"), (5, 1, "assistant", "x"), (9000, 1, "user", "y" * 50_000)]
    for c in range(200):
        for t in range(rng.randrange(1, 7)):
            rows.append((c, t, rng.choice(["user", "assistant", "assistant", "sys\ntem", "a\\nb", "", None, "<|im_end|>"]), rng.choice([None, "".join(rng.choice(parts) for _ in range(rng.randrange(0, 14)))])))
    table = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, turns string")
    found = chat.expand(table)
    found = found.select("*", chat.turns_of(F.col("text")).alias("turns"), chat.loss_text(F.col("text"), F.col("loss_start"), F.col("loss_chars")).alias("loss")).collect()
    chats, examples = {}, {}
    for c, *rest in rows:
        chats.setdefault(c, []).append(rest)
    for r in sorted(found, key=lambda r: r.example):
        examples.setdefault(r.conv_id, []).append(r)
    assert set(chats) == set(examples)
    for c, turns in chats.items():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1] is not None, (t[1] or "").encode(), t[2] is not None, (t[2] or "").encode()))
        expected = [(role or "", text or "") for _, role, text in turns]
        ends = [i for i, t in enumerate(turns) if t[1] == "assistant" or i == len(turns) - 1]
        assert [r.last for r in examples[c]] == [i == len(turns) - 1 for i in ends]
        for i, r in zip(ends, examples[c], strict=True):
            assert [tuple(t) for t in r.turns] == expected[: i + 1]
            assert r.loss == (expected[i][1] if expected[i][0] == "assistant" else "") and (r.loss_start >= 0) == (expected[i][0] == "assistant")
            plain = r.text.replace(chat.START, "").replace(chat.END, "")
            assert not re.search(r"</?s>|\[/?INST\]|<</?SYS>>|<\|\w*\|>", plain)
            assert r.text.count(chat.START) == r.text.count(chat.END) == i + 1
    assert chat.expand(table.where("false")).count() == 0


def test_chat_query_digests(spark):
    got = queries.op10_chat_formatting(spark, "/root/testdata/sf0.001").collect()
    rows = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").collect()
    chats = {-7: [(0, "user", "</s>[INST] ok [/INST]"), (1, "assistant", "</s>[INST] ok [/INST]")]}
    for r in rows:
        chats.setdefault(r.conv_id, []).append((r.turn, r.role, r.text or ""))
    assert len(got) == len(chats)
    for r in got:
        turns = sorted(chats[r.conv_id])
        loss = "".join(t for _, role, t in turns if role == "assistant")
        whole = "".join(f"{role}\n{t}\n" for _, role, t in turns)
        digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == (len(turns), digest(whole), len(loss), digest(loss))


# embeddings


def brute_links(rows, threshold):
    good = {i: np.array(v, dtype=float) / np.linalg.norm(v) for i, (_, v) in enumerate(rows) if v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    up, links = list(range(len(rows))), [0] * len(rows)

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in good:
        for j in good:
            if j < i and len(good[i]) == len(good[j]) and good[i] @ good[j] >= threshold:
                links[i] += 1
                links[j] += 1
                up[max(root(i), root(j))] = min(root(i), root(j))
    groups = {}
    for i, (v, _) in enumerate(rows):
        groups.setdefault(root(i), []).append(v)
    return sorted((v, links[i], min(groups[root(i)]), v == min(groups[root(i)])) for i, (v, _) in enumerate(rows))


@pytest.mark.parametrize("block", [512, 3])
def test_links_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(embedding_dedup, "BLOCK", block)
    rng = np.random.default_rng(10)
    rows = []
    for _ in range(40):
        center = rng.standard_normal(32)
        for _ in range(int(rng.integers(1, 8))):
            rows.append([float(np.float32(x)) for x in center * rng.uniform(0.5, 2) + 0.1 * rng.standard_normal(32)])
    rows += [rows[0]] * 12 + [rows[5]] + [None, [], [0.0] * 32, [float("nan")] * 32, [float("inf")] + [1.0] * 31, [None] + [1.0] * 31, rows[1][:31], [1e30 * x for x in rows[2]]]
    rows = [(1000 - i, v) for i, v in enumerate(rows)]
    rows.append(rows[3])
    table = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<float>, label int, node string")
    got = sorted(map(tuple, embedding_dedup.near_duplicates(table, 0.9).collect()))
    assert got == brute_links(rows, 0.9)
    assert embedding_dedup.near_duplicates(table.where("false")).count() == 0


def test_chains_of_vectors_are_one_component(spark):
    """Ends that are linked over a middle vector only, whichever of the three has the smallest hash."""
    rng, rows = np.random.default_rng(3), []
    for chain in range(30):
        x, y = np.linalg.qr(rng.standard_normal((64, 2)))[0].T
        rows += [(10 * chain + k, (np.cos(a) * x + np.sin(a) * y).tolist()) for k, a in enumerate(np.radians([0, 13.5, 27]))]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r.vec_id: (r.n_links, r.component_id) for r in embedding_dedup.near_duplicates(table, 0.9).collect()}
    assert got == {10 * chain + k: (1 + (k == 1), 10 * chain) for chain in range(30) for k in range(3)}


def cell_rows(vectors, cells, copies):
    n = len(vectors)
    columns = {"cell": pa.array(cells, pa.int64()), "x": pa.array([0] * n, pa.int32()), "side": pa.array([0] * n, pa.int32()), "node": pa.array(np.arange(n) * 7919 % 10_007)}
    return pa.RecordBatch.from_pydict(columns | {"raw": pa.array([v.astype("<f8").tobytes() for v in vectors], pa.binary()), "copies": pa.array(copies, pa.int64())})


def test_a_cell_of_near_copies_takes_little_memory():
    rng = np.random.default_rng(12)
    n = 1000
    rows = cell_rows(rng.standard_normal(64) + 0.05 * rng.standard_normal((n, 64)), [5] * n, [1] * n)
    hashes = {64: embedding_dedup.Hashes(64, 3, 4)}
    tracemalloc.start()
    got = pa.Table.from_batches(embedding_dedup._compared([rows], (64, 0, 5, 0, 0), hashes, 0.9))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got["n"].to_pylist() == [n - 1] * n and set(got["low"].to_pylist()) == {0}
    assert peak < 1 << 26  # all pairs with their vectors would take some 0.7 GB


def test_small_cells_share_a_product(monkeypatch):
    rng = np.random.default_rng(13)
    monkeypatch.setattr(embedding_dedup, "PRODUCT", 64)
    vectors = np.repeat(rng.standard_normal((6, 16)), 5, axis=0) + 0.15 * rng.standard_normal((30, 16))
    cells, copies = sorted(rng.integers(0, 4, 30).tolist()), rng.integers(1, 4, 30).tolist()
    rows, hashes = cell_rows(vectors, cells, copies), embedding_dedup.Hashes(16, 2, 3)
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    keys, nodes = hashes.keys(unit), rows["node"].to_pylist()
    for table in (0, 2):
        counts, reach = [0] * 30, list(nodes)
        pairs = [(i, j) for i in range(30) for j in range(30) if i != j and cells[i] == cells[j] and unit[i] @ unit[j] >= 0.9 and not (keys[i, :table] == keys[j, :table]).any()]
        for i, j in pairs:
            counts[i] += copies[j]
        for i, j in pairs * 30:
            reach[i] = min(reach[i], reach[j])
        got = pa.Table.from_batches(embedding_dedup._compared([rows], (16, table, 0, 0, 0), {16: hashes}, 0.9)).to_pylist()
        assert got == [{"node": nodes[i], "n": counts[i], "low": reach[i]} for i in range(30) if counts[i]]


def test_keys_do_not_depend_on_the_order_of_a_sum(monkeypatch):
    hashes = embedding_dedup.Hashes(24, 3, 5)
    vectors = np.random.default_rng(14).standard_normal((300, 24))
    places = np.repeat(hashes.shifts[None, :], 300, axis=0)
    for d in range(24):
        places += vectors[:, d : d + 1] * hashes.directions[d]
    with np.errstate(over="ignore"):
        expected = (np.floor(places / embedding_dedup.WIDTH).astype(np.int64).reshape(300, 5, 3) * hashes.weights).sum(axis=2)
    for doubt in (1e-9, 0.01, 1.0):
        monkeypatch.setattr(embedding_dedup, "DOUBT", doubt)
        assert (hashes.keys(vectors) == expected).all()
        assert (hashes.keys(vectors[7:9], 2, 4) == expected[7:9, 2:4]).all()


def test_links_found_in_rounds_are_the_same(spark, monkeypatch):
    rng = np.random.default_rng(15)
    rows = [(i, (rng.standard_normal(32) if i % 9 else np.ones(32)).tolist()) for i in range(90)]
    rows += [(100 + i, [x + 0.2 * float(rng.standard_normal()) for x in v]) for i, v in rows]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    whole = sorted(map(tuple, embedding_dedup.near_duplicates(table, 0.9).collect()))
    monkeypatch.setattr(embedding_dedup, "ROUND_BYTES", 1)
    labels, keep = [], embedding_dedup.stored
    monkeypatch.setattr(embedding_dedup, "stored", lambda df, label: labels.append(label) or keep(df, label))
    assert sorted(map(tuple, embedding_dedup.near_duplicates(table, 0.9).collect())) == whole == brute_links(rows, 0.9)
    assert labels.count("vector_links") > 1


def test_recall_at_the_threshold():
    rng = np.random.default_rng(11)
    a = rng.standard_normal((1500, 64))
    a /= np.linalg.norm(a, axis=1)[:, None]
    b = rng.standard_normal((1500, 64))
    b -= (a * b).sum(axis=1)[:, None] * a
    b = 0.9 * a + np.sqrt(1 - 0.81) * b / np.linalg.norm(b, axis=1)[:, None]
    for n in (10_000, 1_000_000):
        k, tables = embedding_dedup.tables_for(n, 0.9)
        hashes = embedding_dedup.Hashes(64, k, tables)
        assert (hashes.keys(a) == hashes.keys(b)).any(axis=1).mean() >= 0.95


# skew and addresses



def test_rows_of_one_id_are_dealt_to_many_files(spark, tmp_path):
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        source = file.read()
    rows = [(i if i % 3 else (None if i % 2 else 7), f"text {i % 900}") for i in range(2400)] + [(7, "the same")] * 800
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    index = token_records.write_records(docs, source, 2, f"file://{tmp_path}")
    parts = {r.part: r.n for r in index.groupBy("part").agg(F.count("*").alias("n")).collect()}
    assert sum(parts.values()) == len(rows) and max(parts.values()) < 2.5 * len(rows) / 8
    got = sorted(((r.start, r.doc_id) for r in token_records.read_records(index).collect()))
    ids = [d for _, d in got]
    assert ids == sorted(ids, key=lambda d: (d is not None, d or 0))


def test_tokenizers_that_are_not_byte_level_are_refused():
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file, pytest.raises(ValueError):
        token_records.LibraryEncoder(file.read(), 2)


def test_conversations_without_an_id_are_single_turns(spark):
    rows = [(None, i, "assistant" if i % 2 else "user", f"t{i // 4}") for i in range(400)] + [(1, 0, "user", "a"), (1, 1, "assistant", "b")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    found = chat.expand(table).collect()
    lonely = [r for r in found if r.conv_id is None]
    assert len(lonely) == 400 and all(r.last and r.example == 0 and r.text.count(chat.START) == 1 for r in lonely)
    assert len({r.alone for r in lonely}) == 400 and [r.alone for r in found if r.conv_id == 1] == [None]


def test_folders_without_a_scheme_are_completed(spark, tmp_path):
    assert files.qualified(spark, str(tmp_path)) == f"file://{tmp_path}"
    assert files.qualified(spark, f"file:{tmp_path}") == files.qualified(spark, f"file://{tmp_path}") == f"file://{tmp_path}"
    with pytest.raises(ValueError):
        files.qualified(spark, "webhdfs://nowhere:1/x")
    pages = spark.createDataFrame([(1, "u", "x"), (2, "u", "x")], "page_id long, url string, html string")
    listed = warc.write_archives(pages, folder=str(tmp_path / "a"))
    assert all(r.file.startswith("file:///") for r in listed.collect())
    assert sorted((r.page_id, r.refers_to) for r in warc.read_archives(listed).collect()) == [(1, 2), (2, None)]


def test_query_formats_every_character(spark):
    """The formatted characters of op10, counted from the template turn by turn."""
    turns = {}
    for r in spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").collect():
        turns.setdefault(r.conv_id, []).append((r.turn, r.role, r.text or ""))
    broken = lambda t: len(t) + len(re.findall(r"[<\[]\\*(?=/?s>|/?INST\]|<?/?SYS>>|\|[A-Za-z0-9_]*\|>)", t))
    got = {r.conv_id: r.formatted_chars for r in queries.QUERIES["op10_chat_formatting"](spark, "/root/testdata/sf0.001").collect()}
    assert set(got) == {*turns, -7}
    for c, each in turns.items():
        sizes = [len(chat.START) + len(role) + 1 + broken(text) + len(chat.END) + 1 for _, role, text in sorted(each)]
        ends = [i for i, t in enumerate(sorted(each)) if t[1] == "assistant" or i == len(each) - 1]
        assert got[c] == sum(sum(sizes[: i + 1]) for i in ends)
