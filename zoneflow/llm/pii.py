"""Personal data in texts: fixed patterns, and terms that give a protected entity away by co-occurrence.

The corpus says how strongly a term reveals an entity: with n different texts
that hold a term, an entity or both out of N, the pair's pointwise mutual
information over the entity's own information is the term's disclosure. A term
above a threshold is a span wherever it stands, in texts without the entity
too. Texts that repeat word for word count once, and a term needs several
different contexts, so copies of one document prove nothing.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zoneflow.llm.text import Memo, free_prefix, map_batches, same_columns, to_array, to_arrow
from zoneflow.llm.url_filter import blocked_bloom, maybe_listed
from zoneflow.session import write_table

KINDS = ("email", "ip", "card", "phone")
MASKS = {"email": "<EMAIL>", "ip": "<IP>", "card": "<CARD>", "phone": "<PHONE>", "term": "<TERM>"}
# Words on each side of a term that count as its context.
REACH = 5
# Least number of different contexts, and least disclosure, of a revealing term.
SUPPORT = 3
DISCLOSURE = 0.8
# Sizes of the filters that keep most other texts and terms out of the shuffles.
BLOCKS = 1 << 14
CELLS = 1 << 20
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_AT = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_TERM = re.compile(r"[a-zA-Z\x80-\U0010ffff]{3,}")

Span = tuple[str, int, int]


def _emails(text: str) -> list[Span]:
    out, end = [], 0
    for m in _AT.finditer(text):
        start = m.start()
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < m.start():
            end = m.end()
            out.append(("email", start, end))
    return out


def _luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """E-mail addresses, IPv4 addresses, card numbers and phone numbers, by kind in this order and by start."""
    spans = _emails(text) if "@" in text else []
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p := part.lstrip("0")) < 4 and int(p or 0) <= 255 for part in m[0].split(".")):
                spans.append(("ip", *m.span()))
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and _luhn(digits):
                spans.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= len(_DIGIT.findall(m[0])) <= 15:
                spans.append(("phone", *m.span()))
    return spans


def joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def _terms(text: str, spans: list[Span]) -> list[re.Match]:
    """Terms outside the spans."""
    taken = sorted((s, e) for _, s, e in spans)
    found, at = [], 0
    for m in _TERM.finditer(text):
        while at < len(taken) and taken[at][1] <= m.start():
            at += 1
        if not any(s < m.end() and m.start() < e for s, e in taken[at:at + len(KINDS)]):
            found.append(m)
    return found


def _contexts(text: str) -> dict[str, int]:
    """Hash of the terms around the first occurrence of each term."""
    own, out = [m[0].lower() for m in _terms(text, base_spans(text))], {}
    for i, term in enumerate(own):
        if term not in out:
            out[term] = xxhash.xxh3_64_intdigest(" ".join(own[max(0, i - REACH):i + REACH + 1])) >> 1
    return out


_SPANS = "array<struct<kind:string,start:int,end:int>>"
_FOUND = f"doc_id long, digest string, spans {_SPANS}, entities array<string>"


def _digest(text: str) -> str:
    return hashlib.md5(text.encode(), usedforsecurity=False).hexdigest()


def _text_digest():
    return F.md5(F.coalesce("text", F.lit("")).cast("binary"))


def _as_rows(spans: list[Span]) -> list[dict]:
    return [{"kind": k, "start": s, "end": e} for k, s, e in spans]


def find_entities(docs: DataFrame) -> DataFrame:
    """doc_id, digest of the text, base spans and the different entities, for every row."""
    def run(batch):
        texts = [t or "" for t in batch.column("text").to_pylist()]
        spans = [base_spans(t) for t in texts]
        return {"doc_id": batch.column("doc_id"), "digest": [_digest(t) for t in texts], "spans": [_as_rows(s) for s in spans],
                "entities": [sorted({f"{k}:{t[a:b]}" for k, a, b in s}) for t, s in zip(texts, spans, strict=True)]}

    return map_batches(docs.select("doc_id", "text"), run, _FOUND)


def different_texts(docs: DataFrame, found: DataFrame) -> DataFrame:
    """Every text once; a filter of the repeated ones spares most others the shuffle."""
    repeated = found.groupBy("digest").count().where("count > 1").select("digest")
    again = maybe_listed(_text_digest(), blocked_bloom(repeated, "digest", BLOCKS), BLOCKS)
    texts = docs.select(F.coalesce("text", F.lit("")).alias("text"))
    return texts.where(~again).unionByName(texts.where(again).distinct())


def term_texts(texts: DataFrame) -> DataFrame:
    """(term, n): texts that hold a term outside the spans; every batch is counted before the shuffle."""
    wanted = to_arrow("term string, n long")

    def run(batches):
        for batch in batches:
            counts = Counter()
            for text in batch.column("text").to_pylist():
                counts.update({m[0].lower() for m in _terms(text, base_spans(text))})
            yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], schema=wanted)

    return texts.select("text").mapInArrow(run, "term string, n long")


def revealing_terms(found: DataFrame, docs: DataFrame, support: int = SUPPORT, disclosure: float = DISCLOSURE) -> DataFrame:
    """(entity, term) pairs whose disclosure reaches the threshold; all counts are of different texts."""
    # An entity of fewer texts has no term with enough contexts.
    held = found.select("digest", F.explode("entities").alias("entity")).distinct()
    entities = write_table(held.groupBy("entity").agg(F.count("*").alias("n_entity")).where(F.col("n_entity") >= support), "held")
    none = entities.select("entity", F.lit("").alias("term")).limit(0)
    if entities.isEmpty():
        return none
    eligible = write_table(held.join(entities.select("entity"), "entity"), "eligible")
    texts = different_texts(docs, found)

    def run(batch):
        own = batch.column("text").to_pylist()
        return {"digest": [_digest(t) for t in own], "terms": [[{"term": k, "context": c} for k, c in _contexts(t).items()] for t in own]}

    likely = maybe_listed(_text_digest(), blocked_bloom(eligible.select("digest").distinct(), "digest", BLOCKS), BLOCKS)
    terms = map_batches(texts.where(likely), run, "digest string, terms array<struct<term:string,context:long>>")
    together = (
        terms.select("digest", F.inline("terms")).join(eligible, "digest")
        .groupBy("entity", "term", "context").agg(F.count("*").alias("n"))
        .groupBy("entity", "term").agg(F.sum("n").alias("n_both"), F.count("*").alias("contexts")))
    kept = write_table(together.where(F.col("contexts") >= support).drop("contexts"), "together")
    if kept.isEmpty():
        return none
    counts = term_texts(texts).join(kept.select("term").distinct(), "term").groupBy("term").agg(F.sum("n").alias("n_term"))
    total = found.select("digest").distinct().count()
    info = F.log2(F.lit(float(total)) / F.col("n_entity"))
    mutual = F.log2(F.col("n_both") * float(total) / (F.col("n_term") * F.col("n_entity")))
    return kept.join(entities, "entity").join(counts, "term").where((info > 0) & (mutual >= disclosure * info)).select("entity", "term")


def term_spans(docs: DataFrame, revealing: DataFrame) -> DataFrame:
    """(digest, terms): all places of revealing terms, of every text that has some."""
    known = write_table(revealing.select("term").distinct(), "revealing")
    cells = known.select(F.pmod(F.crc32(F.col("term").cast("binary")), F.lit(CELLS)).alias("cell")).distinct()
    # Few of a text's terms pass this filter of fixed size; the join decides.
    marks = bytearray(CELLS)
    for row in cells.toLocalIterator():
        marks[row.cell] = 1
    shared = docs.sparkSession.sparkContext.broadcast(bytes(marks))

    def run(batch):
        texts = [t or "" for t in batch.column("text").to_pylist()]
        maybe, found = Memo(lambda w: shared.value[zlib.crc32(w.lower().encode()) % CELLS]), []
        for text in texts:
            near = any(maybe[w] for w in set(_TERM.findall(text)))
            found.append([{"term": m[0].lower(), "start": m.start(), "end": m.end()} for m in _terms(text, base_spans(text)) if maybe[m[0]]] if near else [])
        return {"digest": [_digest(t) for t in texts], "found": found}

    if known.isEmpty():
        return known.select(F.col("term").alias("digest"), F.array().cast(_SPANS).alias("terms"))
    places = map_batches(docs.select("text"), run, "digest string, found array<struct<term:string,start:int,end:int>>")
    return write_table(
        places.select("digest", F.inline("found")).distinct().join(known, "term")
        .groupBy("digest").agg(F.array_sort(F.collect_list(F.struct(F.lit("term").alias("kind"), "start", "end"))).alias("terms")), "places")


def _with_terms(rows: DataFrame, added: DataFrame, digest: str, terms: str) -> DataFrame:
    """`rows` with the column `terms`; a filter spares rows without any the shuffle."""
    likely = maybe_listed(F.col(digest), blocked_bloom(added.select("digest"), "digest", BLOCKS), BLOCKS)
    own = added.select(F.col("digest").alias(digest), F.col("terms").alias(terms))
    return rows.where(likely).join(own, digest, "left").unionByName(rows.where(~likely).withColumn(terms, F.lit(None).cast(_SPANS)))


def personal_data(docs: DataFrame, support: int = SUPPORT, disclosure: float = DISCLOSURE) -> DataFrame:
    """doc_id, counts by kind, base_sha256 and spans for every row.

    Null texts are empty and hold nothing; repeated rows and null ids are kept,
    other columns ignored. Added spans have the kind `term` and follow the base
    spans, which they never overlap.
    """
    found = write_table(find_entities(docs), "entities")
    added = term_spans(docs, revealing_terms(found, docs, support, disclosure))
    text = F.transform(F.col("spans"), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
    more = F.transform(F.coalesce("terms", F.array().cast(_SPANS)), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
    kinds = F.transform(F.col("spans"), lambda s: s["kind"])
    counts = [F.size(F.filter(kinds, lambda kind: kind == F.lit(k))).cast("long").alias(f"n_{k}") for k in KINDS]
    return _with_terms(found.drop("entities"), added, "digest", "terms").select(
        "doc_id", *counts, F.sha2(F.array_join(text, ","), 256).alias("base_sha256"), F.array_join(F.concat(text, more), ",").alias("spans"))


def _masked(text: str, spans: list[Span]) -> str:
    parts, at = [], 0
    for start, end, kind in sorted((s, e, k) for k, s, e in spans):
        if start >= at:
            parts += [text[at:start], MASKS[kind]]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def sanitise(docs: DataFrame, support: int = SUPPORT, disclosure: float = DISCLOSURE) -> DataFrame:
    """Rows of `docs` with entities generalised to their kind and revealing terms to a mark; other rows stay as they are."""
    names, wanted = same_columns(docs)
    found = write_table(find_entities(docs), "entities")
    added = term_spans(docs, revealing_terms(found, docs, support, disclosure))
    # `digest` and `terms` under names that the rows cannot have.
    free = free_prefix(names)

    def mask(batches):
        for batch in batches:
            texts = []
            for text, terms in zip(batch.column("text").to_pylist(), batch.column(f"{free}t").to_pylist(), strict=True):
                spans = base_spans(text or "") + [(t["kind"], t["start"], t["end"]) for t in terms or []]
                texts.append(_masked(text, spans) if spans else text)
            yield pa.RecordBatch.from_arrays(
                [to_array(texts if n == "text" else batch.column(n), wanted.field(n).type) for n in names], schema=wanted)

    return _with_terms(docs.withColumn(f"{free}d", _text_digest()), added, f"{free}d", f"{free}t").mapInArrow(mask, docs.schema)
