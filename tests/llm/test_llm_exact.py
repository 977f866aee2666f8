"""Text operators against brute force: joins, shards, packing, counts, windows, addresses, fingerprints, personal data."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from zoneflow.llm import decontaminate, fingerprint, packing, pii, sharding, similarity, token_count, url_filter
from zoneflow.llm.text import table


def shingles(text, width):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())


def components(texts, width, percent):
    sets = {i: shingles(t, width) for i, t in texts.items()}
    lists, root = defaultdict(list), {i: i for i in sets}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in sorted(sets):
        shared = Counter(j for t in sets[i] for j in lists[t])
        for j, both in shared.items():
            if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((top(i), top(j)))
                root[b] = a
        for t in sets[i]:
            lists[t].append(i)
    return {i: (len(s), top(i)) for i, s in sets.items()}


def found(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in df.collect()}


@pytest.mark.parametrize(("width", "percent"), [(3, 90), (5, 80)])
def test_links_equal_brute_force(spark, sf_dir, width, percent):
    docs = table(spark, sf_dir, "documents")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert found(similarity.jaccard_components(docs, width, percent)) == components(texts, width, percent)


def test_families_of_edits_lose_no_link(spark, monkeypatch):
    """Chains of edits whose ends are not similar, subfamilies, and a line that all share."""
    rng = np.random.default_rng(3)
    line = " ".join(f"common{i}" for i in range(40))
    texts, number = {}, 0
    for family in range(4):
        base = [f"w{family}x{i}" for i in rng.integers(0, 500, 150)]
        for branch in range(6):
            words = list(base)
            for _ in range(12):
                for at in rng.integers(0, len(words), rng.integers(1, 6)):
                    words[at] = f"e{rng.integers(0, 40)}"
                texts[number] = line + " " + " ".join(words)
                number += 1
    for i in range(40):
        texts[number + i] = line + " " + " ".join(f"r{x}" for x in rng.integers(0, 10**9, 60))
    docs = spark.createDataFrame([(i, t) for i, t in texts.items()], "doc_id long, text string")
    for width, percent in ((3, 90), (5, 80)):
        assert found(similarity.jaccard_components(docs, width, percent)) == components(texts, width, percent)
    monkeypatch.setattr(similarity, "FEW_PAIRS", 0)
    assert found(similarity.jaccard_components(docs, 5, 80, slices=3)) == components(texts, 5, 80)


def edited_families(spark):
    """Chains of edits around four texts, a few unrelated texts with a shared line, copies and rows without id or words."""
    rng, rows = np.random.default_rng(11), []
    line = " ".join(f"common{i}" for i in range(20))
    for family in range(4):
        words = [f"w{family}x{i}" for i in rng.integers(0, 500, 120)]
        for _ in range(25):
            for at in rng.integers(0, len(words), rng.integers(1, 5)):
                words[at] = f"e{rng.integers(0, 40)}"
            rows.append((len(rows), line + " " + " ".join(words)))
    rows += [(1000 + i, line + " " + " ".join(f"r{x}" for x in rng.integers(0, 10**9, 200))) for i in range(50)]
    texts = dict(rows) | {2000: rows[3][1], 2001: rows[120][1], 2002: "", 2003: " ".join(f"only{i}" for i in range(9))}
    rows = [*texts.items(), *rows[:4], (None, rows[5][1]), (None, rows[130][1]), (2004, None)]
    return texts | {2004: ""}, spark.createDataFrame(rows, "doc_id long, text string")


def test_few_tables_however_many_pairs_are_compared(spark, monkeypatch):
    """The driver's plans and stages follow the tables stored, of which each slice of all leaders once took its own."""
    from zoneflow.llm import components as labelling

    stored, store = Counter(), similarity.write_table

    def counting(df, name, keep=False):
        stored[name] += 1
        return store(df, name, keep)

    texts, docs = edited_families(spark)
    monkeypatch.setattr(similarity, "write_table", counting)
    monkeypatch.setattr(labelling, "write_table", counting)
    monkeypatch.setattr(similarity, "FEW_PAIRS", 0)
    kept = similarity.one_per_group(docs).where("doc_id is not null").select("doc_id").distinct()
    assert {r["doc_id"] for r in kept.collect()} == {i for i, (_, top) in components(texts, 5, 80).items() if i == top}
    assert stored["needed"] == stored["compared"] == 1 and sum(stored.values()) < 30, stored


def test_sets_with_too_many_tokens_of_their_own_are_not_indexed(spark, monkeypatch):
    seen, rows_of = [], similarity._index_rows

    def indexed(docs, *rest):
        seen.extend(r["doc_id"] for r in docs.collect())
        return rows_of(docs, *rest)

    texts, docs = edited_families(spark)
    monkeypatch.setattr(similarity, "_index_rows", indexed)
    for width, percent in ((3, 90), (5, 80)):
        seen.clear()
        want = components(texts, width, percent)
        got = similarity.jaccard_components(docs.where("doc_id is not null"), width, percent)
        assert found(got) == want
        assert not set(seen) & {*range(1000, 1050), 2000, 2001, 2002, 2004}
        assert {i for i, (_, top) in want.items() if i != top} - {2000, 2001} <= set(seen)


@pytest.mark.parametrize(("limit", "value"), [("MOST_HELD", 300), ("CHUNK", 2), ("COLUMNS", 7)])
def test_links_of_leaders_with_few_and_many_sets(spark, monkeypatch, limit, value):
    """Sets of a leader are linked in the task or, where there are too many, by joins: with the same result."""
    monkeypatch.setattr(similarity, limit, value)
    texts, docs = edited_families(spark)
    assert found(similarity.jaccard_components(docs.where("doc_id is not null"), 5, 80)) == components(texts, 5, 80)


def test_links_of_odd_rows(odd_documents, no_documents):
    rows = similarity.jaccard_components(odd_documents, 3, 90).collect()
    got = {(r["doc_id"], r["n_shingles"], r["component_id"]) for r in rows}
    assert len(rows) == odd_documents.count()
    assert {(1, 58, 1), (2, 58, 1), (3, 0, 3), (4, 0, 4), (5, 1, 5)} <= got
    assert (None, 3, None) in got
    kept = similarity.one_per_group(odd_documents)
    assert kept.columns == odd_documents.columns
    assert kept.where("doc_id in (1, 2)").select("doc_id").collect() == [(1,)]
    assert similarity.jaccard_components(no_documents).count() == 0


def test_equal_blocks_are_guaranteed():
    rng = np.random.default_rng(5)
    for n in (9, 10, 12, 30, 97, 300, 1200):
        for percent in (80, 90):
            base = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
            for _ in range(20):
                cut = similarity.most_apart(len(base), len(base), percent) // 2
                other = np.unique(np.concatenate([base[cut:], rng.integers(0, 1 << 63, cut).astype(np.uint64)]))
                keys, common = similarity.block_keys(base, percent)
                both = len(np.intersect1d(keys, similarity.block_keys(other, percent)[0]))
                assert len(np.intersect1d(base, other)) * 100 < percent * len(np.union1d(base, other)) or both >= max(common, 1 if cut else 0)


def test_sets_of_further_layouts_count_on_no_common_lists(monkeypatch):
    """What a set counts on must hold for a partner that stops at the first layout."""
    rng, further = np.random.default_rng(6), 0
    for _ in range(4000):
        base = np.unique(rng.integers(0, 1 << 63, int(rng.integers(20, 150))).astype(np.uint64))
        with monkeypatch.context() as first:
            first.setattr(similarity, "LAYOUTS", 1)
            stops = similarity.block_keys(base, 90)[1]
        assert similarity.block_keys(base, 90)[1] == stops
        further += stops == 0
    assert further


def least_capacity(sizes, shards):
    def fits(c):
        used, total = 1, 0
        for s in sizes:
            if s > c:
                return False
            if total + s > c:
                used, total = used + 1, 0
            total += s
        return used <= shards

    return next(c for c in range(max(sizes), sum(sizes) + 1) if fits(c))


def test_shards_have_the_least_capacity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").limit(60)
    rows = sharding.shard_documents(docs, 8).collect()
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    groups = Counter()
    for text in texts.values():
        groups[hashlib.sha256(text.encode()).hexdigest()] += len(text.encode()) + 1
    totals = Counter()
    slots = defaultdict(list)
    for r in rows:
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (
            len(texts[r["doc_id"]].encode()) + 1, zlib.crc32(texts[r["doc_id"]].encode()), "bytes", None)
        totals[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert max(totals.values()) == least_capacity([groups[k] for k in sorted(groups)], 8)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_shards_of_odd_rows_and_hot_groups(spark, odd_documents, no_documents):
    rows = sharding.shard_documents(odd_documents).collect()
    assert len(rows) == odd_documents.count()
    assert sharding.shard_documents(no_documents).count() == 0
    hot = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 < 2, "same").otherwise(F.col("id").cast("string")).alias("text"))
    placed = sharding.shard_documents(hot, 4).collect()
    by = defaultdict(list)
    for r in placed:
        by[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    assert len({r["shard"] for r in placed if r["doc_id"] % 3 < 2}) == 1


def test_a_heavy_group_leaves_no_shard_empty(spark):
    """One text that is most of the bytes, or a third of them: the largest shard is the least possible, the others are near each other."""
    for copies, others in ((60, 140), (100, 200)):
        docs = spark.createDataFrame([(i, "same " * 200 if i < copies else f"text {i} " + "x" * 20) for i in range(copies + others)], "doc_id long, text string")
        totals = Counter()
        for r in sharding.shard_documents(docs, 8).collect():
            totals[r["shard"]] += r["size"]
        rest = sorted(totals.values())[:-1]
        assert len(totals) == 8 and max(totals.values()) >= copies * 1001
        assert rest[-1] <= 1.5 * sum(rest) / 7 and rest[0] >= 0.5 * sum(rest) / 7


def test_even_cuts_never_exceed_the_least_capacity(spark):
    rng = np.random.default_rng(9)
    for shards in (1, 2, 3, 8):
        sizes = [int(x) for x in np.r_[rng.integers(1, 9, 12), rng.integers(1, 120, 3)][rng.permutation(15)]]
        rows = [(f"{i:04d}", s, 1, sum(sizes[:i + 1]), i + 1) for i, s in enumerate(sizes)]
        groups = spark.createDataFrame(rows, "digest string, bytes long, n long, end long, end_rows long").cache()
        capacity, _ = sharding.smallest_capacity(groups, shards)
        ends = sharding.even_cuts(groups, shards, capacity)
        assert capacity == least_capacity(sizes, shards) and len(ends) == shards + 1
        assert max(b - a for a, b in zip(ends, ends[1:], strict=False)) == capacity
        assert set(ends) <= {0, *(r[3] for r in rows)} and ends == sorted(ends) and ends[-1] == sum(sizes)


def check_packing(docs, rows, tokenizer):
    ids = defaultdict(list)
    for r in docs.select("doc_id", "text").collect():
        ids[r["doc_id"]].append(tokenizer.encode(r["text"] or "", add_special_tokens=False).ids + [0])
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append(r)
    for doc, own in ids.items():
        assert sum(r["length"] for r in pieces[doc]) == sum(map(len, own))
        for r in pieces[doc]:
            parts = [x[r["start"]:r["start"] + r["length"]] for x in own if len(x) == r["doc_tokens"]]
            assert r["ids_crc32"] in {zlib.crc32(np.array(p, "<u4").tobytes()) for p in parts}
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 1024
    filled = [sum(r["length"] for r in own) for own in sequences.values()]
    return 1 - sum(filled) / sum(n if n & (n - 1) == 0 else 1024 for n in filled)


def test_packing_places_every_id_once(spark, sf_dir, odd_documents, no_documents):
    tokenizer = Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))
    docs = table(spark, sf_dir, "documents")
    assert check_packing(docs, packing.pack_documents(docs, block_pieces=64).collect(), tokenizer) < 0.03
    check_packing(odd_documents, packing.pack_documents(odd_documents).collect(), tokenizer)
    assert packing.pack_documents(no_documents).count() == 0


def test_packing_balances_cost_and_joins_checksums():
    lengths = np.random.default_rng(1).integers(1, 1024, 500)
    placed = packing.pack(lengths)
    cost, used = defaultdict(float), defaultdict(int)
    for _piece, _start, n, to, _offset in placed:
        cost[to] += n + n * n / 1024
        used[to] += n
    assert sum(used.values()) == lengths.sum() and max(used.values()) <= 1024
    full = [c for to, c in cost.items() if used[to] > 1000]
    assert np.std(full) / np.mean(full) < 0.2
    parts = [b"abcd" * 16, b"efgh" * 16, b"ij"]
    assert packing.joined_crc([zlib.crc32(p) for p in parts], [len(p) for p in parts]) == zlib.crc32(b"".join(parts))


def test_token_counts_equal_the_library(spark, sf_dir, odd_documents, no_documents):
    tokenizer = Tokenizer.from_file(str(public_tokenizers.path("word_bpe_49k.json")))
    for docs in (table(spark, sf_dir, "documents"), odd_documents):
        texts = Counter((r["doc_id"], len((r["text"] or "").encode()), len(tokenizer.encode(r["text"] or "", add_special_tokens=False).ids))
                        for r in docs.select("doc_id", "text").collect())
        got = Counter((r["doc_id"], r["n_bytes"], r["n_tokens"]) for r in token_count.token_counts(docs).collect())
        assert got == texts
    assert token_count.token_counts(no_documents).count() == 0


def test_transducer_reads_contractions_like_the_pattern():
    tokenizer = Tokenizer.from_file(str(public_tokenizers.path("word_bpe_49k.json")))
    model = token_count.word_tokens(str(public_tokenizers.path("word_bpe_49k.json")))
    rng = np.random.default_rng(7)
    alphabet = list("'''strevlmd ax1!-\n\té²")
    texts = ["".join(rng.choice(alphabet, rng.integers(1, 400))) for _ in range(300)]
    assert token_count.count_tokens(texts, model).tolist() == [len(tokenizer.encode(t, add_special_tokens=False).ids) for t in texts]


def test_windows_in_blocks_and_their_removal(spark, sf_dir, odd_documents, no_documents):
    docs, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    whole = decontaminate.contamination(docs, benchmark)
    blocks = decontaminate.contamination(docs, benchmark, block_words=200)
    assert sorted(whole.collect()) == sorted(blocks.collect())
    assert whole.where("contaminated").count() > 0
    cleaned = decontaminate.decontaminate(docs, benchmark)
    assert cleaned.columns == docs.columns
    assert decontaminate.contamination(cleaned, benchmark).where("contaminated").count() == 0
    untouched = whole.where("not contaminated").select("doc_id").join(docs, "doc_id").select(docs.columns)
    assert untouched.exceptAll(cleaned).count() == 0
    items = spark.createDataFrame([("a", "Word1 word2"), (None, "word3"), ("b", None), ("c", "")], "item_id string, text string")
    got = {r["doc_id"]: r["n_hit"] for r in decontaminate.contamination(odd_documents, items).collect()}
    assert got[1] == 2 and got[7] == 800 and got[4] == 0
    assert decontaminate.decontaminate(odd_documents, items).count() == odd_documents.count()
    assert decontaminate.decontaminate(no_documents, items).count() == 0
    assert decontaminate.contamination(docs, items.limit(0)).where("contaminated").count() == 0


def test_pieces_of_items_and_removal_in_blocks(spark, sf_dir):
    """Items that span pieces, windows on their borders, copies, and clashing names, against a plain scan."""
    long_item = " ".join(f"w{i}" for i in range(300))
    items = [("a", long_item), ("a", long_item), ("b", "w298 W299 x"), ("c", "w3 w4 w5 w6 w7 w8 w9 w10 w11 w12 y"), ("d", "x" * 500)]
    texts = [" ".join(f"w{i}" for i in range(k, k + 14)) + " plain words after" * 9 for k in range(0, 286, 7)]
    texts += [long_item, None, "", "clean", "q w298 w299 x q q q", "v " * 40 + "w3 w4 w5 w6 w7 w298 w299 x w8 w9 w10 w11 w12 y", texts[0], "X" * 500 + " z z"]
    docs = spark.createDataFrame([(i, t, i, i) for i, t in enumerate(texts)], "doc_id long, text string, row long, ranges long")
    benchmark = spark.createDataFrame(items, "item_id string, text string")
    for block_words in (200, decontaminate.BLOCK_WORDS):
        known = decontaminate._stored(benchmark, 10, "item_id", "text", block_words)
        assert (len(known.blocks) == 1) == (block_words == decontaminate.BLOCK_WORDS)
        got = {r.doc_id: (r.n_hit, r.n_items) for r in decontaminate.contamination(docs, benchmark, block_words=block_words).collect()}
        for i, text in enumerate(texts):
            own, hit, met = (text or "").lower().split(), set(), set()
            for item, words in {(k, tuple(v.lower().split())) for k, v in items}:
                size = min(10, len(words))
                windows = {words[j:j + size] for j in range(len(words) - size + 1)}
                for j in range(len(own) - size + 1):
                    if tuple(own[j:j + size]) in windows:
                        hit |= set(range(j, j + size))
                        met.add(item)
            assert got[i] == (len(hit), len(met)), (block_words, i)
        cleaned = decontaminate.decontaminate(docs, benchmark, block_words=block_words)
        rows = sorted(cleaned.collect())
        whole = sorted(decontaminate.decontaminate(docs, benchmark).collect())
        assert rows == whole and cleaned.columns == docs.columns
        kept = {r.doc_id: r.text for r in rows}
        assert len(texts) - 8 not in kept and kept[len(texts) - 7] is None and kept[len(texts) - 5] == "clean"
        # The first cut joins the words of item c, whose second window ends in y; the second takes them out.
        assert set(kept[len(texts) - 3].split()) == {"v"}
        assert decontaminate.contamination(cleaned, benchmark, block_words=block_words).where("contaminated").count() == 0


def test_addresses(spark):
    urls = [(1, "HTTP://WWW.Example.COM/en/x?utm_source=a#t"), (2, None), (3, "no scheme"), (4, "https://a.example.com/en/"),
            (5, "https://b.net/es/1"), (6, "https://b.org/x/?ref=1"), (6, "http://b.org/x"), (7, "https://example.com"), (8, "x://notexample.com/en/")]
    pages = spark.createDataFrame(urls, "page_id long, url string")
    rules = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/")]
    rows = url_filter.judge_urls(pages, rules, url_filter.repeated_addresses(pages)).collect()
    got = {(r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in rows}
    assert len(rows) == len(urls)
    assert got == {
        (1, "www.example.com", "/en/x", "www.example.com/en/", "allow"), (2, "", "", None, "allow"), (3, "", "", None, "allow"),
        (4, "a.example.com", "/en/", "example.com/en/", "block"), (5, "b.net", "/es/1", "net/es/", "block"),
        (6, "b.org", "/x/", None, "block"), (6, "b.org", "/x", None, "block"), (7, "example.com", "", None, "allow"),
        (8, "notexample.com", "/en/", "com/", "allow")}
    assert url_filter.judge_urls(pages.limit(0), rules, pages.select(F.col("url").alias("address")).limit(0)).count() == 0


def test_bloom_has_no_false_negative_and_few_false_positives(spark):
    listed = spark.range(2000).select(F.concat(F.lit("in"), "id").alias("address"))
    probe = url_filter.blocked_bloom(listed, "address", 128)
    both = listed.unionByName(spark.range(2000).select(F.concat(F.lit("out"), "id").alias("address")))
    hits = both.where(url_filter.maybe_listed(F.col("address"), probe, 128))
    assert hits.where("address like 'in%'").count() == 2000
    assert hits.count() < 2100


def test_fingerprints(spark, sf_dir, odd_documents, no_documents):
    docs = table(spark, sf_dir, "documents")
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    rows = {r["doc_id"]: r for r in fingerprint.fingerprints(docs).collect()}
    order = sorted(texts, reverse=True)
    for i, doc in enumerate(order):
        text, following = texts[doc], texts[order[(i + 1) % len(order)]]
        edited = text[:len(text) - len(text) // 3] + following[:len(text) // 3]
        assert (rows[doc]["n_chars"], rows[doc]["edited_sha256"]) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert rows[doc]["fingerprint"] == fingerprint.as_text(fingerprint.fingerprint(text))
    near = [r["near_edited"] > r["near_next"] for r in rows.values()]
    assert sum(near) > 0.9 * len(near)
    assert fingerprint.fingerprints(odd_documents).count() == odd_documents.count()
    assert fingerprint.fingerprints(no_documents).count() == 0


def test_fingerprint_is_homomorphic():
    parts = [f"paragraph {i}." for i in range(30)]
    whole = fingerprint.vector_sum(parts)
    assert np.array_equal(whole, fingerprint.vector_sum(parts[::-1]))
    assert np.array_equal(fingerprint.changed(whole, ["new"], parts[:2]), fingerprint.vector_sum(["new", *parts[2:]]))
    assert not np.array_equal(whole, fingerprint.vector_sum(parts + parts[:1]))


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")


def test_base_spans_equal_the_plain_patterns():
    rng = np.random.default_rng(11)
    for _ in range(2000):
        text = "".join(rng.choice(list("aB1.@-+%_ 25"), rng.integers(1, 60)))
        spans = pii.base_spans(text)
        assert [(s, e) for k, s, e in spans if k == "email"] == [m.span() for m in EMAIL.finditer(text)]
        assert [(s, e) for k, s, e in spans if k == "ip"] == [m.span() for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    assert [k for k, _, _ in pii.base_spans("4041 8949-7460 8795 and +1 (386) 555-3733")] == ["card", "phone"]
    assert pii.base_spans("4041894974608796") == []


CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def passes_luhn(digits):
    total = 0
    for i, d in enumerate(reversed([int(c) for c in digits])):
        total += d if i % 2 == 0 else 2 * d - 9 * (2 * d > 9)
    return total % 10 == 0


def test_cards_and_phones_equal_the_plain_patterns():
    rng = np.random.default_rng(12)
    seen = Counter()
    for _ in range(4000):
        text = "".join(rng.choice(list("0123456789" * 3 + "+ -().a"), rng.integers(1, 80)))
        if rng.random() < 0.3:
            # A number that passes the check, with separators.
            body = rng.integers(0, 10, rng.integers(14, 20)).tolist()
            last = next(d for d in range(10) if passes_luhn("".join(map(str, [*body, d]))))
            text += " x" + "".join(f"{d}{rng.choice(['', '', ' ', '-'])}" for d in body) + f"{last}y"
        spans = pii.base_spans(text)
        cards = [m.span() for m in CARD.finditer(text) if 16 <= len(d := re.sub("[^0-9]", "", m[0])) <= 19 and passes_luhn(d)]
        phones = [m.span() for m in PHONE.finditer(text) if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
        assert [(s, e) for k, s, e in spans if k == "card"] == cards and [(s, e) for k, s, e in spans if k == "phone"] == phones
        seen += Counter(k for k, *_ in spans)
    assert seen["card"] > 500 and seen["phone"] > 50


@pytest.mark.parametrize("text", ["0" * 5000 + "1.1.1.1", "9" * 6000 + ".1.1.1", "1.2.3." + "0" * 7000, "+" + "1" * 9000, "4" * 9000, "a@" + "b." * 4000 + "c"])
def test_very_long_numbers_and_names_are_read(text):
    spans = pii.base_spans(text)
    assert all(0 <= s < e <= len(text) for _, s, e in spans)
    assert [k for k, *_ in spans] == {"0": ["ip"], "1": ["ip"], "a": ["email"]}.get(text[0], [])


def test_disclosure_equals_a_plain_count(spark):
    """Texts with one of three entities or none, terms bound to an entity loosely or tightly, copies, and repeated contexts."""
    rng = np.random.default_rng(8)
    entities, texts = ["ann@example.com", "bob@example.org", "10.1.2.3"], []
    for i in range(240):
        words = [f"word{'abcdefghij'[x // 10]}{'abcdefghij'[x % 10]}" for x in rng.integers(0, 60, 25)]
        e = i % 8
        if e < 3:
            words[10] = ["annie", "bobby", "router"][e] if rng.random() < 0.9 else "other"
            words.insert(5, entities[e])
        if rng.random() < 0.15:
            words[12] = ["annie", "bobby", "router"][int(rng.integers(0, 3))]
        texts.append(" ".join(words))
    texts += texts[:40] * 3 + [None, ""]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    different = {t or "" for t in texts}
    held, with_term, both, contexts = Counter(), Counter(), Counter(), defaultdict(set)
    for t in different:
        spans = pii.base_spans(t)
        own = {f"{k}:{t[a:b]}" for k, a, b in spans}
        line = [m[0].lower() for m in re.finditer(r"[a-zA-Z\x80-\U0010ffff]{3,}", t) if not any(a < m.end() and m.start() < b for _, a, b in spans)]
        held.update(own)
        with_term.update(set(line))
        for entity in own:
            for term in set(line):
                at = line.index(term)
                both[entity, term] += 1
                contexts[entity, term].add(tuple(line[max(0, at - 5):at + 6]))
    want, n = set(), len(different)
    for (entity, term), k in both.items():
        info = np.log2(n / held[entity])
        if held[entity] >= 3 and len(contexts[entity, term]) >= 3 and info > 0 and np.log2(k * n / (with_term[term] * held[entity])) >= 0.8 * info:
            want.add((entity, term))
    got = {tuple(r) for r in pii.revealing_terms(pii.find_entities(docs), docs).collect()}
    assert got == want and want


def test_revealing_terms_are_added_and_masked(spark, odd_documents, no_documents):
    rows = [(i, f"{'abcdefg'[i % 7]}lpha filler{'xyzuvw'[i % 6]} Zorbanic ann@example.com said number {i} to all") for i in range(6)]
    rows += [(100 + i, f"ordinary words number {i} said to all of us") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["spans"] for r in pii.personal_data(docs).collect()}
    start = rows[0][1].index("Zorbanic")
    assert f"term:{start}:{start + 8}" in got[0] and got[0].startswith("email:") and got[100] == ""
    assert "said" not in {rows[0][1][int(s.split(":")[1]):int(s.split(":")[2])] for s in got[0].split(",")}
    clean = {r["doc_id"]: r["text"] for r in pii.sanitise(docs).collect()}
    assert "Zorbanic" not in clean[0] and "<EMAIL>" in clean[0] and clean[100] == rows[6][1]
    odd = pii.sanitise(odd_documents)
    assert odd.columns == odd_documents.columns and odd.count() == odd_documents.count()
    assert pii.personal_data(odd_documents).count() == odd_documents.count()
    assert pii.personal_data(no_documents).count() == pii.sanitise(no_documents).count() == 0


def _term_words(spans, text):
    return [text[int(a):int(b)] for kind, a, b in (s.split(":") for s in spans.split(",") if s) if kind == "term"]


def test_copies_do_not_hide_a_revealing_term(spark):
    """30 copies of one text and two other contexts reveal as much as three texts without copies."""
    base = [f"{'abc'[i]}lpha filler{'xyz'[i]} Zorbanic ann@example.com said {'pqr'[i]}eta" for i in range(3)]
    texts = base[:1] * 30 + base[1:] + [f"ordinary words {'abcdefghij'[i % 10]}{'abcdefghij'[i // 10 % 10]}x said to us {i}" for i in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["spans"] for r in pii.personal_data(docs).collect()}
    assert all("Zorbanic" in _term_words(got[i], texts[i]) for i in range(32))


def test_terms_far_from_the_entity_are_revealing_everywhere(spark):
    """A name opens a text whose e-mail address ends it; it is marked again in a text without the address."""
    def middle(i):
        return " ".join(f"word{'abcdefghij'[i]}{'abcdefghij'[j % 10]}{'abcdefghij'[j // 10]}" for j in range(60))

    texts = [f"Zorbanic {middle(i)} ann@example.com" for i in range(8)] + [f"nobody but Zorbanic, {middle(9)} zorbanic"]
    texts += [f"ordinary text number {i}" for i in range(400)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["spans"] for r in pii.personal_data(docs).collect()}
    assert _term_words(got[0], texts[0]) == ["Zorbanic"] and _term_words(got[8], texts[8]) == ["Zorbanic", "zorbanic"]
    clean = {r["doc_id"]: r["text"] for r in pii.sanitise(docs).collect()}
    assert not [t for t in clean.values() if "zorbanic" in t.lower()] and clean[20] == texts[20]
