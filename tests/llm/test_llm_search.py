"""Source divergence, exact top-k search and fill-in-middle against brute force and exact round trips."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from zoneflow.llm import divergence, top_k
from zoneflow.llm.divergence import source_divergence
from zoneflow.llm.fill_in_middle import (
    Frames, digest, fill_in_middle, frame_text, output_texts, rearrange, restored, sections, store_frames, with_digests)
from zoneflow.llm.top_k import exact_top_k

LETTERS = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans({c: chr(c + 32) for c in range(65, 91)})


def audit(rows, least=10, ranks=10):
    """(lang, source, part, item, value, rank) from the definition, term by term."""
    docs = [(lang or "", source or "", LETTERS.findall((text or "").translate(LOWER))) for lang, source, text in rows]
    out = set()
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        seen, total, by = Counter(), Counter(), defaultdict(Counter)
        for _, source, words in own:
            seen.update(set(words))
            total.update(words)
            by[source].update(words)
        kept = [t for t in total if seen[t] >= least]

        def share(counts, kept=kept):
            n = sum(counts[t] for t in kept)
            return {t: 1 + 1_000_000_000 * (counts[t] + 2) // (n + 2 * len(kept)) for t in kept}

        def f(p, q):
            return (p - q) * (p - q) // (p + q)

        whole, shares = share(total), {s: share(c) for s, c in by.items()}
        for s, p in shares.items():
            pairs = [(sum(f(p[t], q[t]) for t in kept), o) for o, q in shares.items() if o != s]
            terms = [(f(p[t], whole[t]), t) for t in kept if by[s][t] and p[t] > whole[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, ranks)):
                order = sorted(found, key=lambda x: (-x[0], x[1].encode()))[:most]
                out |= {(lang, s, part, item, v, i) for i, (v, item) in enumerate(order, 1)}
    return out


def audited(df, **options):
    rows = [tuple(r) for r in source_divergence(df, **options).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


DOCS = "doc_id long, text string, lang string, source string"


def test_divergence_equals_brute_force(spark):
    rng = np.random.default_rng(5)
    vocabulary = [f"w{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10]}" for i in range(100)] + ["Éa", "ÉA", "你好", "ab1cd"]
    rows = []
    for i in range(400):
        source = "hot" if rng.random() < 0.35 else f"s{rng.integers(0, 6)}"
        words = rng.choice(vocabulary, rng.integers(0, 40))
        text = " ".join(words) + (" X" * (i % 5) if source == "hot" else "")
        rows.append((["en", "de", None][i % 3], None if i % 50 == 0 else source, None if i % 60 == 0 else text))
    # One language whose terms are all rare, and one with no term at all.
    rows += [("xx", f"s{i % 3}", f"own{'abcdefghij'[i]}") for i in range(8)] + [("yy", "a", "12 34"), ("yy", "b", None)]
    docs = spark.createDataFrame([(i, t, lang, s) for i, (lang, s, t) in enumerate(rows)], DOCS).repartition(5)
    assert audited(docs) == audit(rows)
    assert audited(docs, least_documents=1, ranks=3) == audit(rows, 1, 3)


def test_divergence_of_many_equal_values(spark):
    """A cell of thousands of terms reaches the report by its first terms in UTF-8 order alone."""
    def word(i):
        return "".join("abcdefghij"[int(d)] for d in f"{i:04d}")

    rows = [("en", "a", " ".join(word(i) for i in range(3000)) + " zé zz"), ("en", "b", "other " * 50)] * 12
    docs = spark.createDataFrame([(i, t, lang, s) for i, (lang, s, t) in enumerate(rows)], DOCS)
    assert audited(docs) == audit(rows)


def test_divergence_counts_survive_a_full_table(spark, monkeypatch, sf_dir):
    monkeypatch.setattr(divergence, "COUNTED", 50)
    rows = [("en", f"s{i % 3}", f"alpha beta {'gamma ' * (i % 4)} x{'abcdefgh'[i % 8]}") for i in range(60)]
    docs = spark.createDataFrame([(i, t, lang, s) for i, (lang, s, t) in enumerate(rows)], DOCS)
    assert audited(docs) == audit(rows)


def test_divergence_of_odd_rows(spark, odd_documents, no_documents):
    rows = [(r["lang"], r["source"], r["text"]) for r in odd_documents.collect()]
    assert audited(odd_documents) == audit(rows)
    assert audited(odd_documents, least_documents=1) == audit(rows, 1)
    assert audited(no_documents) == set()


def test_share_is_exact_for_large_counts(spark):
    n, total, v = 9_000_000_000_000, 10_000_000_000_001, 123_456
    got = spark.range(1).select(F.expr(divergence._share(f"{n}L", f"{total}L", f"{v}L")).alias("p")).first()["p"]
    assert got == 1 + 1_000_000_000 * (n + 2) // (total + 2 * v)


def searched(rows, k=20, every=20, scale=64):
    def whole(v):
        return None if v is None or any(x is None or not math.isfinite(x) for x in v) else [math.floor(scale * x) for x in v]

    known = [(i, q) for i, v in rows if i is not None and (q := whole(v)) is not None]
    out = Counter()
    for at, (i, q) in enumerate(known):
        if i % every == 0:
            scores = [(-max(-2**63, min(2**63 - 1, sum(a * b for a, b in zip(q, w, strict=False)))), j)
                      for other, (j, w) in enumerate(known) if other != at]
            out.update((i, rank, j, -s) for rank, (s, j) in enumerate(sorted(scores)[:k], 1))
    return out


def answers(df, **options):
    return Counter(tuple(r) for r in exact_top_k(df, **options).collect())


VECTORS = "vec_id long, embedding array<float>, label int"


@pytest.mark.parametrize(("dim", "clusters"), [(64, 0), (64, 5), (7, 0), (1, 0)])
def test_search_equals_brute_force(spark, monkeypatch, dim, clusters):
    monkeypatch.setattr(top_k, "BLOCK_BYTES", 8 * dim * 60)
    rng = np.random.default_rng(dim + clusters)
    own = rng.normal(size=(700, dim))
    if clusters:
        own = own * 0.05 + rng.normal(size=(clusters, dim))[rng.integers(0, clusters, 700)]
    # A third of all rows is one vector; ids repeat.
    own[::3] = own[0]
    rows = [(i % 650, v.astype(np.float32).tolist()) for i, v in enumerate(own)]
    df = spark.createDataFrame([(*r, 1) for r in rows], VECTORS).repartition(4)
    assert answers(df) == searched(rows)


def test_search_in_several_passes(spark, monkeypatch):
    monkeypatch.setattr(top_k, "BLOCK_BYTES", 8 * 4 * 20)
    monkeypatch.setattr(top_k, "GROUP_BYTES", 8 * 4 * 10)
    rng = np.random.default_rng(1)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(400, 4)).astype(np.float32))]
    df = spark.createDataFrame([(*r, 1) for r in rows], VECTORS)
    assert answers(df, k=3, every=10) == searched(rows, 3, 10)


def test_search_of_odd_rows(spark):
    """Nulls, non-finite and huge components, lengths that differ, few rows, no rows, columns with clashing names."""
    big = 3e38
    rows = [(0, [1.0, 2.0]), (20, [1.0]), (40, []), (60, None), (None, [1.0, 1.0]), (80, [1.0, None]), (100, [float("nan"), 1.0]),
            (120, [float("inf"), 1.0]), (1, [-0.001, 0.3]), (2, [big, big]), (140, [-big, 0.0]), (140, [-big, 0.0]), (3, [1e5, 1e6]), (160, [1e7, -1e6])]
    data = [(i, v, 1, 2, "x") for i, v in rows]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>, block int, score int, ids string")
    exact_rows = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    assert answers(df) == searched(exact_rows)
    assert answers(df.where("false")) == Counter()
    assert answers(df.where("vec_id = 1")) == Counter()


def test_bounds_never_cut_a_score():
    rng = np.random.default_rng(2)
    for scale in (1.0, 50.0, 1e6, 1e17):
        a, b = (top_k.Vectors(np.arange(50), np.floor(scale * rng.normal(size=(50, 33)))) for _ in range(2))
        scores = a.own @ b.own.T
        least = np.sort(scores, axis=1)[:, -5] - (1 if scale < 1e9 else 1e-9 * np.abs(scores).max())
        i, j = top_k.survivors(a, b, least)
        assert {(x, y) for x, y in zip(*np.nonzero(scores > least[:, None]), strict=True)} <= set(zip(i.tolist(), j.tolist(), strict=True))


TEXTS = st.text(st.sampled_from("ab<PSM>é你😀\x00\n "), max_size=60)


@settings(max_examples=200, deadline=None)
@given(TEXTS, st.integers(4, 20), st.integers(0, 60), st.integers(0, 60), st.sampled_from(["psm", "spm"]))
def test_frames_rearrange_and_restore(text, size, one, two, form):
    markers = ("<P>", "<S>", "<M>")
    packer, opener = zstandard.ZstdCompressor(level=3), zstandard.ZstdDecompressor()
    frames = frame_text(text.encode(), packer, size)
    assert frames.units == len(text) and b"".join(frames.pieces(opener)) == text.encode()
    assert all(len(opener.decompress(f)) <= size for f in frames.frames)
    if any(m in text for m in markers):
        return
    first, last = sorted((one % (len(text) + 1), two % (len(text) + 1)))
    prefix, middle, suffix = text[:first], text[first:last], text[last:]
    out = rearrange(frames, form, first, last, markers, packer, opener)
    whole = f"<P>{prefix}<S>{suffix}<M>{middle}" if form == "psm" else f"<S>{suffix}<P>{prefix}<M>{middle}"
    assert b"".join(out.pieces(opener)).decode() == whole and out.units == len(whole)
    assert b"".join(restored(out, form, markers, opener)) == text.encode()


def test_only_cut_frames_are_opened():
    class Counted:
        def __init__(self):
            self.opened = []

        def decompress(self, frame):
            self.opened.append(frame)
            return zstandard.ZstdDecompressor().decompress(frame)

    packer, opener = zstandard.ZstdCompressor(), Counted()
    text = "".join(np.random.default_rng(0).choice(list("abcdefgh"), 10_000))
    frames = frame_text(text.encode(), packer, 100)
    out = rearrange(frames, "psm", 1234, 7777, ("<P>", "<S>", "<M>"), packer, opener)
    assert opener.opened == [frames.frames[12], frames.frames[77]]
    assert len(set(out.frames) & set(frames.frames)) >= 90


def test_a_mark_over_two_frames_is_found():
    assert [(k, p) for k, p in sections([b"<", b"P", b">a<", b"S>", b"<<M>x"], [b"<P>", b"<S>", b"<M>"]) if p] == [(1, b"a"), (2, b"<"), (3, b"x")]


def formed_by_definition(doc_id, text):
    text = text or ""
    h = hashlib.sha256(b"1:" + (b"" if doc_id is None else str(doc_id).encode())).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i:8 * i + 8], 16) for i in range(4))
    n = len(text)
    first, last = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not n or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    prefix, middle, suffix = text[:first], text[first:last], text[last:]
    if h4 % 100 < 20:
        return n, "spm", first, last - first, f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", first, last - first, f"<P>{prefix}<S>{suffix}<M>{middle}"


def test_fill_in_middle_of_odd_rows(spark, odd_documents, no_documents):
    extra = spark.createDataFrame([(100 + i, f"a {m} b" if i < 3 else "你" * 200_000 + "é", "en", "a", 1) for i, m in enumerate(["<P>", "<S>", "<M>", ""])],
                                  "doc_id long, text string, lang string, source string, n_chars long")
    docs = odd_documents.select(extra.columns).union(extra)
    rows = docs.collect()
    stored = store_frames(docs)
    formed = fill_in_middle(stored)
    want = Counter()
    for r in rows:
        n, form, first, middle, text = formed_by_definition(r["doc_id"], r["text"])
        want[(r["doc_id"], n, form, first, middle, hashlib.sha256(text.encode()).hexdigest(), hashlib.sha256((r["text"] or "").encode()).hexdigest())] += 1
    assert Counter(tuple(r) for r in with_digests(formed).collect()) == want
    assert Counter((r["doc_id"], r["text"]) for r in output_texts(formed).collect()) == Counter((r["doc_id"], formed_by_definition(r["doc_id"], r["text"])[4]) for r in rows)
    assert with_digests(fill_in_middle(store_frames(odd_documents))).count() == odd_documents.count()
    assert with_digests(fill_in_middle(store_frames(no_documents))).collect() == []


def test_markers_must_tell_apart(spark, no_documents):
    with pytest.raises(ValueError):
        store_frames(no_documents, ("aba", "<S>", "<M>"))
    assert digest([b"a", b"b"]) == hashlib.sha256(b"ab").hexdigest() and Frames().units == 0
