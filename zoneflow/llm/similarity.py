"""Exact Jaccard join of word shingle sets that skips index lists by position and derives answers from similar sets.

A linked set shares most of its tokens with another set. So a set is left alone
once more of its tokens than a link allows are in no other set; tokens of a
fixed range of hashes are counted for it. Only the sets that remain are indexed.

A set is laid out along one order of its tokens, the order of their 64-bit
hashes, and the order is cut into P position blocks. Two sets that differ in
at most H tokens agree on at least P - H whole blocks. So the index keeps one
list per block and block content: a set skips every list whose block differs
from its own, however frequent the tokens in it are. A list of single frequent
tokens, such as those of a line that a third of all documents share, is never
read.

Within a list only one set, the leader, is compared with the others by their
texts. The comparison yields the difference of a set to the leader. All further
answers come from these differences. The sets of a leader that has few are
linked with each other at once, in the task. Of a leader with many, sets close
to a common centre are linked by the triangle inequality, and any other pair
must share difference tokens, which an equality join on (leader, token) finds.
No large group is expanded into all pairs.
"""

from __future__ import annotations

import math
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zoneflow.llm.components import components
from zoneflow.llm.text import lists, map_batches, mix64, raw_texts, signed, to_arrow, word_hashes
from zoneflow.llm.url_filter import blocked_bloom, maybe_listed
from zoneflow.session import scratch, write_table

# Parts of the leaders with many sets that are answered one after the other, which bounds the disk, and sets below which one part does.
SLICES = 4
FEW_PAIRS = 20_000
# Sets that one task compares with one copy of their leader, and with each other where a leader has no more.
CHUNK = 512
# Tokens of differences that a task holds to do so, and columns of its tables of tokens.
MOST_HELD = 4_000_000
COLUMNS = 4096
# Blocks of the filter of ids whose texts are compared.
FILTER_BLOCKS = 1 << 14
LAYOUTS = 4
# Lists that a set shares with a leader it is compared with in any case.
FEW = 3
# Classes of distance from a group's centre, and their width in tokens.
STEPS = 16
STEP = 3
_U = np.uint64
_EMPTY = np.zeros(0, np.uint64)


def shingle_hashes(raw: bytes | None, width: int, words) -> np.ndarray:
    """Sorted distinct hashes of a text's word shingles; a shorter text is one shingle.

    64-bit hashes stand for the shingles: two sets of a thousand tokens meet a
    false common token with odds of about 1 to 10^13.
    """
    found = raw.lower().split() if raw else []
    n = len(found)
    if not n:
        return _EMPTY
    h = np.fromiter(map(words.__getitem__, found), np.uint64, n)
    size = min(width, n)
    total = np.full(n - size + 1, size, np.uint64)
    for k in range(size):
        total = total * _U(0x9E3779B97F4A7C15) + h[k:n - size + 1 + k]
    return np.unique(mix64(total))


def most_apart(smaller: int, larger: int, percent: int) -> int:
    """Largest symmetric difference two linked sets of these sizes may have."""
    return (100 - percent) * (smaller + larger) // (100 + percent)


def _spare(n: int, h: int, few: int) -> int | None:
    """Blocks beyond h + 1, so that a set of n tokens seldom has more blocks under `few` tokens than that."""
    spare = 1
    for _ in range(60):
        mean = n / (h + 1 + spare)
        poor = (h + 1 + spare) * math.exp(-mean) * sum(mean ** i for i in range(few))
        more = math.ceil(poor + 3 * math.sqrt(poor))
        if more <= spare:
            return spare
        if mean < 1.2 * few:
            return None
        spare = more
    return None


@lru_cache(None)
def _grid(percent: int) -> tuple[tuple[int, int, int], ...]:
    """(H, P, few) per level: the differences it allows for, its number of blocks and the least tokens of a block that counts."""
    levels, h = [(0, 1, 1)], 1
    while h < 1 << 40:
        n = math.ceil((levels[-1][0] + 1) * (100 + percent) / (2 * (100 - percent)))
        few = next((f for f in (2, 1) if _spare(n, h, f)), 1)
        levels.append((h, h + 1 + (_spare(n, h, few) or 1), few))
        h = h + 1 if h < 4 else h * 3 // 2
    return tuple(levels)


@lru_cache(100_000)
def _levels(n: int, percent: int) -> tuple[tuple[int, int, int, int], ...]:
    """Levels at which a set of n tokens meets its possible partners, as (number, H, P, few)."""
    grid, most = _grid(percent), n * 100 // percent
    first, last = ((most_apart(m, m, percent)) for m in (n, most))
    at = [next(i for i, (h, *_) in enumerate(grid) if h >= x) for x in (first, last)]
    return tuple((i, *grid[i]) for i in range(max(at[0], 1), at[1] + 1))


def block_keys(tokens: np.ndarray, percent: int) -> tuple[np.ndarray, int]:
    """Keys of the index lists a set belongs to, and how many of them it has in common with any linked set at least.

    Blocks with fewer than `few` tokens are left out as long as fewer of them
    exist than two linked sets have equal blocks, so one equal block that
    counts remains. A set with too many takes further independent layouts, and
    after the last one its poor blocks as well: no link is lost. Such a set is
    not counted on to have several lists in common with any other.
    """
    keys, common = [], len(tokens)
    for level, h, p, few in _levels(len(tokens), percent):
        for layout in range(LAYOUTS):
            order = tokens if not layout else np.sort(mix64(tokens + _U(layout * 0x9E3779B97F4A7C15 % (1 << 64))))
            cuts = np.searchsorted((order >> _U(32)) * _U(p) >> _U(32), np.arange(p + 1, dtype=np.uint64))
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix64(order ^ _U(0xA5A5A5A5A5A5A5A5)))])
            place = mix64(np.arange(p, dtype=np.uint64) + _U((level << 48) + (layout << 44)))
            own = mix64((sums[cuts[1:]] - sums[cuts[:-1]]) ^ place)
            poor = np.diff(cuts) < few
            keys.append(own[~poor])
            if not layout:
                rest = own[poor]
            if poor.sum() < p - h:
                # A partner that stops at an earlier layout has no keys of this one.
                common = 0 if layout else min(common, p - h - int(poor.sum()))
                break
        else:
            keys.append(rest)
            common = 0
    return (np.concatenate(keys) if keys else _EMPTY), common


def _counted(percent: int) -> np.uint64:
    """Hashes up to this one are counted: twice the share of its tokens that a linked set may have alone, and a little more."""
    return _U(min(100, 2 * (100 - percent) + 5) * ((1 << 64) - 1) // 100)


def _set_rows(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """Size and two prints of every set, and those of its tokens that are counted."""
    def run(batch: pa.RecordBatch):
        words, last, n, one, two, some = word_hashes(), _counted(percent), [], [], [], []
        for raw in raw_texts(batch.column("text")):
            tokens = shingle_hashes(raw, width, words)
            n.append(len(tokens))
            one.append(mix64(tokens).sum(dtype=np.uint64))
            two.append(mix64(tokens + _U(0x632BE59BD9B4E019)).sum(dtype=np.uint64))
            some.append(tokens[:np.searchsorted(tokens, last, "right")])
        return {"doc_id": batch.column("doc_id"), "n": n, "one": signed(np.array(one)), "two": signed(np.array(two)), "some": lists(some)}

    return map_batches(docs, run, "doc_id long, n long, one long, two long, some array<long>")


def _own_tokens(sets: DataFrame) -> DataFrame:
    """(one, own): how many of the counted tokens are in no set with another print; copies of a set count as one."""
    tokens = sets.select("one", F.explode("some").alias("token"))
    held = tokens.groupBy("token").agg(F.min("one").alias("one"), F.max("one").alias("last")).where("one = last")
    return held.groupBy("one").agg(F.count("*").alias("own"))


def _linkable(classes: DataFrame, own: DataFrame, percent: int) -> DataFrame:
    """doc_id of the classes that some other set may link with: p % of a set's tokens at least are in the other one."""
    alone = 100 * F.coalesce("own", F.lit(0)) > (100 - percent) * F.col("n")
    return classes.join(own, "one", "left").where(~alone).select(F.col("node").alias("doc_id")).distinct()


def _only(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of `docs` whose doc_id is in `ids`; a filter of fixed size keeps most others out of the shuffle."""
    asked = maybe_listed(F.col("doc_id"), blocked_bloom(ids, "doc_id", FILTER_BLOCKS), FILTER_BLOCKS)
    return docs.where(asked).join(ids, "doc_id", "left_semi")


def _index_rows(docs: DataFrame, width: int, percent: int) -> DataFrame:
    def run(batch: pa.RecordBatch):
        words, keys, common = word_hashes(), [], []
        for raw in raw_texts(batch.column("text")):
            for values, value in zip((keys, common), block_keys(shingle_hashes(raw, width, words), percent), strict=True):
                values.append(value)
        return {"doc_id": batch.column("doc_id"), "keys": lists(keys), "common": common}

    return map_batches(docs, run, "doc_id long, keys array<long>, common int").where("size(keys) > 0")


_COMPARED = "lead long, id long, n_lead long, n long, apart array<long>, link long"


def _reached(ids: np.ndarray, sizes: np.ndarray, apart: list[np.ndarray], percent: int, width: int) -> np.ndarray:
    """Smallest id that links among these sets reach from each of them, by their differences to one common set; `width` tokens make a table."""
    flat, owner = np.concatenate(apart), np.repeat(np.arange(len(ids)), [len(x) for x in apart])
    _, token, times = np.unique(flat, return_inverse=True, return_counts=True)
    shared = times > 1
    column, held = np.cumsum(shared) - 1, shared[token]
    rows, columns = owner[held], column[token[held]]
    by_column = np.argsort(columns, kind="stable")
    rows, columns = rows[by_column], columns[by_column]
    both = np.zeros((len(ids), len(ids)))
    for first in range(0, int(shared.sum()), width):
        a, b = np.searchsorted(columns, (first, first + width))
        part = np.zeros((len(ids), width), np.float32)
        part[rows[a:b], columns[a:b] - first] = 1
        both += part @ part.T
    far = np.array([len(x) for x in apart])
    linked = (100 + percent) * (far[:, None] + far - 2 * both) <= (100 - percent) * (sizes[:, None] + sizes)
    np.fill_diagonal(linked, True)
    while True:
        near = np.where(linked, ids, np.iinfo(np.int64).max).min(axis=1)
        if np.array_equal(near, ids):
            return ids
        ids = near


def _compare(rows: DataFrame, width: int, percent: int) -> DataFrame:
    """Compare the sets of a run of rows with the leader that opens it.

    The sets of a leader that has one run are linked with each other at once:
    `link` is the smallest id their links reach. Of other leaders, and where the
    differences of a run are too many to hold, each set's difference is returned.
    """
    wanted, most, columns_at_once = to_arrow(_COMPARED), MOST_HELD, COLUMNS

    def run(batches):
        words, lead, base, whole, held = word_hashes(), None, _EMPTY, False, 0
        ids, sizes, apart = [], [], []

        def end():
            count = len(ids)
            if whole and held <= most:
                reached = _reached(np.array([lead, *ids]), np.array([len(base), *sizes]), [_EMPTY, *apart], percent, columns_at_once)
                found = [pa.nulls(count, wanted[4].type), pa.array(reached[1:], pa.int64())]
            else:
                found = [lists(apart).cast(wanted[4].type), pa.nulls(count, pa.int64())]
            known = [pa.array(x, pa.int64()) for x in ([lead] * count, ids, [len(base)] * count, sizes)]
            return pa.RecordBatch.from_arrays(known + found, schema=wanted)

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("lead", "role", "doc_id", "chunks")]
            for own, role, doc, chunks, raw in zip(*columns, raw_texts(batch.column("text")), strict=True):
                tokens = shingle_hashes(raw, width, words)
                if not len(tokens):
                    continue
                if ids and (role == 0 or held > most):
                    yield end()
                    # What follows of a run that was too large to hold is not linked at once either.
                    whole = False
                    ids, sizes, apart, held = [], [], [], 0
                if role == 0:
                    lead, base, whole = own, tokens, chunks == 1
                elif own == lead:
                    ids.append(doc)
                    sizes.append(len(tokens))
                    apart.append(np.setxor1d(base, tokens, assume_unique=True))
                    held += len(apart[-1])
        if ids:
            yield end()

    return rows.mapInArrow(run, _COMPARED)


def _leaders(index: DataFrame) -> DataFrame:
    """(lead, id, lists) for every set and the smallest id of each list it is in; `lists` counts these lists."""
    entries = index.select("doc_id", F.explode("keys").alias("key"))
    # Stored apart, so that the shuffle files of the grouping go before those of the join come.
    shared = write_table(
        entries.groupBy("key").agg(F.min("doc_id").alias("lead"), F.max("doc_id").alias("last"))
        .where("lead <> last").select("key", "lead"), "shared")
    return entries.join(shared, "key").where("doc_id <> lead").groupBy(
        "lead", F.col("doc_id").alias("id")).agg(F.count("*").alias("lists"))


def _with_texts(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """Texts of every pair, leader first; a leader with many sets is repeated once per chunk of them."""
    sized = pairs.join(
        pairs.groupBy("lead").agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("chunks")), "lead")
    members = sized.select(
        F.col("id").alias("doc_id"), "lead", F.pmod(F.xxhash64("id"), "chunks").cast("int").alias("chunk"), F.lit(1).alias("role"), "chunks")
    heads = members.select(F.col("lead").alias("doc_id"), "lead", "chunk", F.lit(0).alias("role"), "chunks").distinct()
    needed = write_table(members.unionByName(heads), "needed")
    # A filter of fixed size keeps most other texts out of the shuffle.
    asked = maybe_listed(F.col("doc_id"), blocked_bloom(needed.select("doc_id").distinct(), "doc_id", FILTER_BLOCKS), FILTER_BLOCKS)
    rows = needed.join(docs.where(asked), "doc_id")
    return rows.repartition("lead", "chunk").sortWithinPartitions("lead", "chunk", "role")


def _worth_comparing(pairs: DataFrame, index: DataFrame) -> DataFrame:
    """Pairs of a set and a leader that must be compared; the others lose no link.

    A frequent token brings a set into a list or two of a leader that has
    nothing else in common with it. Linked sets share at least `common` lists.
    Where fewer than half as many lists of each are under leaders it shares
    fewer than `FEW` lists with, one of the shared lists has a leader with more
    for both. A set with too many such leaders is compared with all of them.
    """
    few = pairs.where(F.col("lists") < FEW)
    crowded = (
        few.groupBy("id").agg(F.sum("lists").alias("weak"))
        .join(index.select(F.col("doc_id").alias("id"), "common"), "id").where("2 * weak >= common").select("id").distinct())
    return pairs.where(F.col("lists") >= FEW).unionByName(few.join(crowded, "id", "left_semi"))


def _derived_links(compared: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """Links between sets that share a leader, from their differences to it alone.

    Tokens in which most sets of a leader differ from it are flipped first, so
    that the differences count from the group's own centre. With d the size of
    a difference and score = (100 - p) n - (100 + p) d, two sets are linked for
    certain when their scores sum to zero or more; the set with the top score
    stands for all such pairs. Other pairs must share difference tokens.
    """
    own = labels.select(F.col("node").alias("id"), "comp")
    known = compared.join(own, "id", "left").withColumn("comp", F.coalesce("comp", "id"))
    groups = known.groupBy("lead").agg(
        F.count("*").alias("m"), F.min("comp").alias("low"), F.max("comp").alias("high")).where("low <> high")
    open_ = known.join(groups.select("lead", "m"), "lead")
    common = (
        open_.select("lead", "m", F.explode("apart").alias("token")).groupBy("lead", "token")
        .agg(F.count("*").alias("c"), F.first("m").alias("m")).where("2 * c > m")
        .groupBy("lead").agg(F.collect_list("token").alias("flip"))
    )
    centred = open_.join(common, "lead", "left").withColumn("flip", F.coalesce("flip", F.array().cast("array<long>")))
    near = centred.select("lead", "id", "n", "comp", F.array_sort(
        F.concat(F.array_except("apart", "flip"), F.array_except("flip", "apart"))).alias("apart"))
    scored = near.withColumn("score", (100 - percent) * F.col("n") - (100 + percent) * F.size("apart"))
    tops = scored.groupBy("lead").agg(F.max(F.struct("score", "id")).alias("top"))
    stored = write_table(
        scored.join(tops, "lead").select("*", F.col("top.id").alias("hub"), F.col("top.score").alias("best")).drop("top"), "centred")
    sure = stored.where("score + best >= 0 and id <> hub").select(F.col("id").alias("a"), F.col("hub").alias("b"))

    # A partner has at least `least` common difference tokens. Only tokens that several sets of the leader have can
    # be common; ordered from rare to frequent, all but the last least - 1 of them must meet.
    least = F.greatest(F.lit(1), F.ceil(-(F.col("score") + F.col("best")) / (2.0 * (100 + percent)))).cast("int")
    far = F.col("score") + F.col("best") < 0
    needs = stored.groupBy("lead").agg(F.min(F.when(far, least)).alias("fewest")).where("fewest is not null")
    apart = stored.join(needs, "lead").select(
        "lead", "id", "n", "comp", "score", "best", F.when(far, F.col("id")).otherwise(F.col("hub")).alias("hub"),
        F.when(far, least).otherwise(F.col("fewest")).alias("need"), "apart").where("size(apart) >= need")
    single = apart.select("lead", "id", F.explode("apart").alias("token"))
    often = single.groupBy("lead", "token").agg(F.count("*").alias("c")).where("c > 1")
    shared = single.join(often, ["lead", "token"]).groupBy("lead", "id").agg(F.array_sort(F.collect_list(F.struct("c", "token"))).alias("shared"))
    # Partners are told apart by how far they are: the farther both are, the more tokens they must share.
    unit = 2 * (100 + percent) * STEP
    own = 2 * F.least(F.lit(STEPS - 1), F.floor((F.col("best") - F.col("score")) / unit)) + far.cast("int")
    nearest = F.col("best") - F.floor(F.col("other") / 2) * unit
    top = F.when(F.col("other") % 2 == 1, F.least(nearest, -F.col("best"))).otherwise(nearest)
    together = F.greatest(F.lit(1), F.ceil(-(F.col("score") + top) / (2.0 * (100 + percent)))).cast("int")
    heads = (
        apart.drop("apart").join(shared, ["lead", "id"]).where("size(shared) >= need")
        .withColumn("own", own.cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(2 * STEPS - 1))))
        .where((F.col("other") % 2 == 1) | far)
        .withColumn("cut", F.size("shared") - together + 1).where("cut > 0")
        .select("lead", "id", "n", "comp", "hub", "own", "other", F.explode(F.slice("shared", F.lit(1), F.col("cut"))).alias("token"))
        .select("lead", "id", "n", "comp", "hub", "own", "other", "token.token")
    )
    left, right = heads.alias("l"), heads.alias("r")
    same = [F.col("l.lead") == F.col("r.lead"), F.col("l.token") == F.col("r.token"),
            F.col("l.own") == F.col("r.other"), F.col("l.other") == F.col("r.own")]
    met = left.join(right, same).where(
        f"l.id < r.id and l.comp <> r.comp and l.hub <> r.hub and 100 * l.n >= {percent} * r.n and 100 * r.n >= {percent} * l.n"
    ).select("l.lead", F.col("l.id").alias("a"), F.col("r.id").alias("b")).distinct()
    sets = stored.select("lead", "id", "score", "apart")
    both = (
        met.join(sets.select("lead", F.col("id").alias("a"), F.col("score").alias("sa"), F.col("apart").alias("da")), ["lead", "a"])
        .join(sets.select("lead", F.col("id").alias("b"), F.col("score").alias("sb"), F.col("apart").alias("db")), ["lead", "b"])
    )
    found = both.where(F.col("sa") + F.col("sb") + 2 * (100 + percent) * F.size(F.array_intersect("da", "db")) >= 0)
    return sure.union(found.select("a", "b"))


def _as_edges(labels: DataFrame) -> DataFrame:
    return labels.select(F.col("node").alias("a"), F.col("comp").alias("b"))


def jaccard_components(
    docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text", slices: int = 1,
) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id.

    Words are runs between ASCII white space, A-Z lower-cased; a set has the
    distinct shingles of `width` words, or the whole sequence when it is
    shorter. Sets with at least `percent` % Jaccard similarity are linked, and
    component_id is the smallest id that links reach. An empty or null text has
    no shingles and no links. Rows that repeat an id count as one document; a
    row with a null id keeps a null component. Other columns are ignored.
    `slices` bounds the disk: so many parts of the sets under leaders with many
    are answered one after the other.
    """
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    used = "n > 0 and doc_id is not null"
    with scratch(docs.sparkSession):
        # Tokens, and then the keys of the sets that remain, are the largest tables; each goes once it has been read.
        counted = write_table(_set_rows(texts, width, percent), "counted")
        sets = write_table(counted.drop("some"), "sets", keep=True)
        own = write_table(_own_tokens(counted.where(used)), "own", keep=True)
    full = sets.where(used)
    classes = write_table(full.groupBy("one", "two", "n").agg(F.min("doc_id").alias("node")), "classes")
    linkable = write_table(_only(texts, write_table(_linkable(classes, own, percent), "linkable")), "texts")
    with scratch(docs.sparkSession):
        keyed = write_table(_index_rows(linkable, width, percent), "index")
        index = write_table(keyed.drop("keys"), "common", keep=True)
        leaders = write_table(_leaders(keyed), "leaders", keep=True)
    firsts = full.select("one", "two", "n", "doc_id").join(classes, ["one", "two", "n"])
    copies = firsts.where("doc_id <> node").select(F.col("doc_id").alias("id")).distinct()
    pairs = leaders.join(copies, "id", "left_anti")
    chosen = write_table(_worth_comparing(pairs, index).select("lead", "id"), "chosen")
    compared = write_table(_compare(_with_texts(chosen, linkable), width, percent), "compared")
    linked = f"link is not null or {100 + percent} * size(apart) <= {100 - percent} * (n + n_lead)"
    labels = components(compared.where(linked).select(F.coalesce("link", "lead").alias("a"), F.col("id").alias("b")))
    # A leader's sets are answered together; a slice of the leaders that are still open lies on disk at a time.
    wide = compared.where("apart is not null").drop("link")
    parts, own = slices if slices > 1 and wide.count() >= FEW_PAIRS else 1, F.pmod(F.xxhash64("lead"), F.lit(slices))
    derived = []
    for i in range(0 if wide.isEmpty() else parts):
        with scratch(docs.sparkSession):
            some = wide.where(own == i) if parts > 1 else wide
            derived.append(write_table(_derived_links(some, labels, percent), "derived", keep=True))
    if derived:
        labels = components(reduce(DataFrame.union, [_as_edges(labels), *derived]))
    groups = classes.join(labels, "node", "left").select("one", "two", "n", F.coalesce("comp", "node").alias("component_id"))
    rows = sets.join(groups, ["one", "two", "n"], "left")
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return rows.select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"))


def one_per_group(docs: DataFrame, width: int = 5, percent: int = 80, slices: int = SLICES) -> DataFrame:
    """Rows of `docs` without those that a smaller id of their group stands for; all columns are kept.

    Empty and null texts and null ids stay. Rows that repeat an id are one
    document and stay or go together.
    """
    with scratch(docs.sparkSession):
        found = jaccard_components(docs, width, percent, slices=slices)
        extra = write_table(found.where("doc_id <> component_id").select("doc_id").distinct(), "extra", keep=True)
    return docs.join(extra, "doc_id", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
