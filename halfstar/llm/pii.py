"""Personal data in texts: spans that rules find, and those that a character-level BiLSTM-CRF adds to them.

The rules name e-mail addresses, IP addresses, payment card numbers and telephone numbers. A model (see ``span_crf``) is trained on labelled spans,
by default those of the rules in a bounded sample of texts, with some of them written in other ways; it then reads every text whole
and adds what looks like a span but follows no rule. Each kind needs so much evidence that, in windows kept out of training, at least
``PRECISION`` of what the model finds is labelled; a kind for which that cannot be shown adds nothing.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import span_crf
from .tables import stored
from .words import grouped

KINDS = ("email", "ip", "card", "phone")
#: Texts that labels are taken from, at most; windows with spans, with words like them and without; characters of a training window.
SAMPLE_ROWS, WITH_SPANS, NEAR, WITHOUT, LENGTH = 16_384, 1_536, 1_024, 512, 64
#: Share of the windows that only thresholds are set on; least share of found spans there that are labelled, and their least number.
HELD_OUT, PRECISION, LEAST = 4, 0.98, 15
#: Bytes of text that are read at once.
READ = 1 << 22

_SPANS = "array<struct<kind: string, start: int, end: int, base: boolean>>"

# A match of a rule always begins where a run of its first characters begins or the match before ended, which these say outright, so that
# no long run is tried from each of its characters.
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_IP = re.compile(r"[0-9](?<![0-9][0-9])[0-9]*+(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_OTHER = re.compile(r"[^0-9]")
_DIGITS = re.compile(r"[^\s]*?[0-9@+][^\s]*")


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) << place % 2
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and _LOCAL.match(text, start - 1):
            start -= 1
        match = _DOMAIN.match(text, at + 1) if start < at else None
        if match:
            yield start, match.end()
            done = match.end()
        # what lies before this sign cannot belong to the next one
        at = text.find("@", max(done, at + 1))


def addresses(text: str) -> Iterator[tuple[int, int]]:
    for match in _IP.finditer(text):
        if all(len(part) <= 3 and int(part or "0") <= 255 for part in (p.lstrip("0") for p in match.group().split("."))):
            yield match.span()


def cards(text: str) -> Iterator[tuple[int, int]]:
    for match in _CARD.finditer(text):
        if match.end() - match.start() >= 13:
            digits = _OTHER.sub("", match.group())
            if 13 <= len(digits) <= 19 and luhn(digits):
                yield match.span()


def phones(text: str) -> Iterator[tuple[int, int]]:
    for match in _PHONE.finditer(text):
        if 9 <= len(_OTHER.sub("", match.group())) <= 15:
            yield match.span()


RULES: tuple[Callable[[str], Iterator[tuple[int, int]]], ...] = (emails, addresses, cards, phones)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """Spans ``(kind, start, end)`` of all rules, by kind, then start; offsets count code points."""
    return [(kind, *span) for kind, rule in enumerate(RULES) for span in rule(text)]


def rewritten(kind: int, span: str) -> str:
    """The same datum written as no rule takes it; the span itself if there is no such way."""
    if KINDS[kind] == "email":
        return span.replace("@", "[at]").replace(".", "[dot]")
    if KINDS[kind] == "phone":
        return span.replace("+", "00", 1)
    return span


def _texts(docs: DataFrame, column: str = "text") -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(column).cast("string").alias("text"))


def labelled_spans(docs: DataFrame) -> DataFrame:
    """Labels by the rules: ``(doc_id, text, spans)`` of ``docs (doc_id, text, ...)``, a NULL text as an empty one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in grouped(batches, READ):
            spans = [[{"kind": KINDS[k], "start": a, "end": b} for k, a, b in base_spans(t or "")] for t in batch["text"].to_pylist()]
            kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["text"], pa.array(spans, kind)], ["doc_id", "text", "spans"])

    return _texts(docs).mapInArrow(run, "doc_id long, text string, spans array<struct<kind: string, start: int, end: int>>")


def sample(docs: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """At most ``rows`` rows, those with the smallest hash of id and text; all, where there are not more."""
    order = F.xxhash64("doc_id", F.col("text"), F.lit("labels"))
    n = docs.count()
    if n <= rows:
        return docs
    # a few more than needed by their hash, then exactly so many
    share = min(1.0, 1.2 * rows / n)
    kept = docs.withColumn("_order", order).where(F.col("_order") < int(-(1 << 63) + share * ((1 << 64) - 1024)))
    cut = kept.select("_order").orderBy("_order").limit(rows + 1).agg(F.max("_order"), F.count("*")).first()
    return kept.where(F.col("_order") < F.lit(cut[0]) if cut[1] > rows else F.lit(True)).drop("_order")


def _training_rows(labelled: DataFrame) -> DataFrame:
    """Windows of labelled texts, ``(sort, order, chars, tags)``: each span somewhere in one, as it is and rewritten (sort 2), each
    word with a digit or sign that is in no span (1), and one without spans for each text (0)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in grouped(batches, READ):
            rows = []
            for text, spans in zip(batch["text"].to_pylist(), batch["spans"].to_pylist(), strict=True):
                if not text:
                    continue
                known = [(KINDS.index(s["kind"]), s["start"], s["end"]) for s in spans if s["kind"] in KINDS]
                random = np.random.default_rng([len(text), *map(ord, text[:32])])
                for kind, start, end in known:
                    for write in (False, True):
                        span = text[start:end]
                        new = rewritten(kind, span) if write else span
                        if write and new == span:
                            continue
                        before = text[max(0, start - LENGTH) : start]
                        whole = before + new + text[end : end + LENGTH]
                        moved = [(k, a - start + len(before), b - start + len(before)) for k, a, b in known if b <= start]
                        moved += [(k, a - end + len(before) + len(new), b - end + len(before) + len(new)) for k, a, b in known if a >= end]
                        moved.append((kind, len(before), len(before) + len(new)))
                        low = len(before) - int(random.integers(0, max(1, LENGTH - len(new))))
                        rows.append((2, *_window(whole, sorted(moved, key=lambda s: s[1]), low)))
                # what is no span though it looks like one teaches more than the rest of a text
                for match in _DIGITS.finditer(text):
                    if not any(a < match.end() and b > match.start() for _, a, b in known):
                        low = match.start() - int(random.integers(0, LENGTH - LENGTH // 8))
                        rows.append((1, *_window(text, known, low)))
                low = int(random.integers(0, max(1, len(text) - LENGTH // 2)))
                if not any(a < low + LENGTH and b > low for _, a, b in known):
                    rows.append((0, *_window(text, [], low)))
            if rows:
                sort, chars, tags = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(sort, pa.int32()), pa.array(chars, pa.binary()), pa.array(tags, pa.binary())], ["sort", "chars", "tags"])

    return labelled.select("text", "spans").mapInArrow(run, "sort int, chars binary, tags binary").withColumn("order", F.xxhash64("chars", "tags"))


def _window(text: str, spans: list[tuple[int, int, int]], low: int) -> tuple[bytes, bytes]:
    """Characters and tags of ``LENGTH`` places from ``low`` on; places outside the text are padding."""
    chars, tags = np.full(LENGTH, span_crf.PAD, dtype=np.uint8), np.zeros(LENGTH, dtype=np.uint8)
    inside = slice(max(0, -low), max(0, -low) + max(0, min(LENGTH - max(0, -low), len(text) - max(0, low))))
    part = text[max(0, low) : low + LENGTH]
    chars[inside] = span_crf.characters(part)
    tags[inside] = span_crf.tags_of([(k, a - max(0, low), b - max(0, low)) for k, a, b in spans if b > low and a < low + LENGTH], len(part))
    return chars.tobytes(), tags.tobytes()


def fit(labelled: DataFrame) -> span_crf.Model:
    """A model from ``labelled (text, spans, ...)``, where ``spans`` are structs of ``kind, start, end``, in code points.

    Trained on at most ``WITH_SPANS`` windows with spans, ``NEAR`` with words that look like some and ``WITHOUT`` others, those with the smallest hash, of which every ``HELD_OUT``-th only sets
    thresholds. NULL and empty texts, NULL spans and kinds that are not known give no windows. A kind of fewer than ``LEAST`` held-out spans is
    never added, so an empty table gives a model that finds nothing. Long texts are cut into windows; repeated ones count once each.
    """
    rows = _training_rows(labelled.select("text", F.coalesce("spans", F.array()).alias("spans")))
    rows = stored(rows, "training_windows")
    windows = [rows.where(F.col("sort") == sort).orderBy("order").limit(most).toArrow() for sort, most in ((2, WITH_SPANS), (1, NEAR), (0, WITHOUT))]
    chars, tags = (np.array([np.frombuffer(x, dtype=np.uint8) for part in windows for x in part[c].to_pylist()], dtype=np.uint8).reshape(-1, LENGTH) for c in ("chars", "tags"))
    held = np.arange(len(chars)) % HELD_OUT == HELD_OUT - 1
    model = span_crf.train(chars[~held], tags[~held], KINDS)
    # a window counts for all of its sort that were not drawn
    there = {r["sort"]: r["count"] for r in rows.groupBy("sort").count().collect()}
    weights = np.repeat([there.get(sort, 0) / max(1, part.num_rows) for sort, part in zip((2, 1, 0), windows, strict=True)], [part.num_rows for part in windows])
    return model._replace(evidence=_evidence(model, chars[held], tags[held], weights[held]))


def _evidence(model: span_crf.Model, chars: np.ndarray, tags: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """For each kind the least evidence from which on enough of the spans that the model finds are labelled; infinite, if there is none."""
    out = np.full(len(KINDS), np.inf)
    if not len(chars):
        return out
    found = span_crf.spans_of(model, chars.ravel(), np.full(len(chars), LENGTH))
    labels = set(span_crf.read_tags(tags))
    for kind in range(len(KINDS)):
        mine = sorted(((odds, (text, kind, a, b) in labels, weights[text]) for text, k, a, b, odds in found if k == kind and a > 0 and b < LENGTH), reverse=True)
        right = np.cumsum([good for _, good, _ in mine])
        share = np.cumsum([good * w for _, good, w in mine]) / np.maximum(np.cumsum([w for _, _, w in mine]), 1e-9)
        enough = np.flatnonzero((share >= PRECISION) & (right >= LEAST))
        if len(enough):
            out[kind] = max(mine[enough[-1]][0], 0.0)
    return out


def find(docs: DataFrame, model: span_crf.Model) -> DataFrame:
    """Spans of personal data in whole texts: ``(doc_id, text, spans)``, spans as structs of ``kind, start, end, base``, by kind, then start.

    ``base`` tells what a rule has found from what the model has added; these touch no span of any rule. Offsets count code points, the end
    is exclusive. A row comes back for each row of ``docs (doc_id, text, ...)``: a NULL text as it is, with no spans, as an empty one; NULL and repeated
    ids each by themselves. Other columns are dropped. Texts of any length are read whole; an empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in grouped(batches, READ):
            texts = [t or "" for t in batch["text"].to_pylist()]
            spans = [[(*s, True) for s in base_spans(t)] for t in texts]
            for text, k, a, b in added(shared.value, texts):
                if not any(a < high and low < b for _, low, high, base in spans[text] if base):
                    spans[text].append((k, a, b, False))
            rows = [[{"kind": KINDS[k], "start": a, "end": b, "base": base} for k, a, b, base in sorted(each)] for each in spans]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["text"], pa.array(rows, kind)], ["doc_id", "text", "spans"])

    return _texts(docs).mapInArrow(run, f"doc_id long, text string, spans {_SPANS}")


def added(model: span_crf.Model, texts: list[str]) -> list[tuple[int, int, int, int]]:
    """Spans of the model with enough evidence, ``(text, kind, start, end)``, without white space at their ends."""
    chars, sizes = span_crf.characters("".join(texts)), np.array([len(t) for t in texts], dtype=np.int64)
    out = []
    for text, kind, a, b, odds in span_crf.spans_of(model, chars, sizes):
        if odds >= model.evidence[kind]:
            part = texts[text][a:b]
            a, b = a + len(part) - len(part.lstrip()), b - (len(part) - len(part.rstrip()))
            if a < b:
                out.append((text, kind, a, b))
    return out


def written(spans: Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redacted(text: Column, spans: Column) -> Column:
    """The text with each character of a span as an asterisk, so that offsets stay."""
    cover = lambda t, s: F.concat(F.substring(t, F.lit(1), s["start"]), F.repeat(F.lit("*"), s["end"] - s["start"]), F.substring(t, s["end"] + 1, F.length(t)))
    return F.aggregate(spans, text, cover)
