"""N-gram Jaccard self-join of documents by a grouped prefix join.

A document's set is its distinct shingles. All sets are ordered the same way, rare shingles first,
so that two similar sets share a shingle of their prefixes. Sets with the same prefix and size are
one group: groups are paired through shared prefix shingles, pairs are filtered by size and
position, and what is left is expanded to its members and verified on the whole sets.

Pairs are looked for twice. First every group meets one other, of the least groups of its prefix
shingles the one it shares most with, and every member the least member of its group; the components
of what is verified are found. Where the pairs across components would be many, sets outside the
largest component at their shingles then meet a few of its sets, drawn anew in every round, and what
is linked joins. Then all pairs across components are formed. A link within a component adds nothing
to the result, so none is lost, and a large group of near copies costs about as many pairs as members,
whichever of them have the least ids.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from sensorloom.llm.common import (
    HashFilter,
    counted_hashes,
    discard,
    hash_filter,
    lower_ascii,
    mix64,
    require,
    span_hashes,
    stored,
    text_bytes,
    text_slices,
)
from sensorloom.llm.components import components

WORDS = 5
SIMILAR = 80  # in hundredths
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

# Texts are sent to Python by about so many bytes at a time.
BATCH_BYTES = 8 << 20

# The most frequent shingles, at most so many, are ordered by how frequent they are.
FREQUENT = 1 << 20

# Where there may be more rows of pairs than so many for each row of postings, sets are drawn from the
# largest component at each shingle, and the best few are tried, first so many and then twice as many;
# at most so many times, and while at least this share of the sets that meet others links with one.
PAIRS_A_ROW, DRAWN, TRIED, TURNS, WORTHWHILE = 4, 16, 4, 5, 0.02


def shingle_sets(column: pa.Array, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of texts as sorted 64-bit hashes, end to end, and where each text's
    begin. A text of fewer words than a shingle has the whole sequence as one."""
    raw, offsets = text_bytes(column)
    raw = lower_ascii(raw)
    inside = np.concatenate([[False], ~IS_SPACE[raw], [False]])
    border = np.zeros(len(raw) + 1, bool)
    border[offsets] = True
    edge = (inside[1:] != inside[:-1]) | (border & inside[1:] & inside[:-1])
    starts, ends = np.flatnonzero(edge & inside[1:]), np.flatnonzero(edge & inside[:-1])
    hashes = span_hashes(raw, starts, ends)
    first = np.searchsorted(starts, offsets)
    counts = np.diff(first)
    sizes = np.where(counts > 0, np.maximum(counts - words + 1, 1), 0)
    text = np.repeat(np.arange(len(counts)), sizes)
    at = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + first[text]
    value = np.zeros(len(at), np.uint64)
    for step in range(words):
        # Short texts end early; a place behind the last word adds nothing.
        there = at + step < first[text + 1]
        word = hashes[np.minimum(at + step, max(len(hashes) - 1, 0))] if len(hashes) else value
        value = np.where(there, mix64(value * np.uint64(0x9E3779B97F4A7C15) + word), value)
    value = value.view(np.int64)
    order = np.lexsort((value, text))
    value, text = value[order], text[order]
    fresh = np.ones(len(value), bool)
    fresh[1:] = (value[1:] != value[:-1]) | (text[1:] != text[:-1])
    value, text = value[fresh], text[fresh]
    return value, np.searchsorted(text, np.arange(len(counts) + 1))


@dataclass(frozen=True)
class Order:
    """The common order of shingles: those of one set, those of several, the frequent ones by
    their counts. A shingle of one set may be taken for one of several, never the reverse."""

    several: HashFilter
    frequent: np.ndarray
    counts: np.ndarray

    def keys(self, values: np.ndarray) -> np.ndarray:
        level = self.several.has(values).astype(np.int64)
        if len(self.frequent):
            at = np.minimum(np.searchsorted(self.frequent, values), len(self.frequent) - 1)
            level = np.where(self.frequent[at] == values, self.counts[at] + 1, level)
        return level


def shingle_order(texts: DataFrame, words: int = WORDS) -> Order:
    """Count the sets of every shingle, of all documents; the counts combine before the shuffle.
    What is sent on is a filter of bounded size and a bounded list of the most frequent."""
    counts = counted_hashes(texts, lambda column: shingle_sets(column, words)[0], "shingle")
    several = stored(counts.filter("count > 1"), "shingles", BATCH_BYTES)
    levels = (
        several.groupBy(F.floor(F.log2(F.col("count").cast("double"))).cast("int").alias("level"))
        .count()
        .collect()
    )
    known = sum(row["count"] for row in levels)
    least, kept = 3, known
    while kept > FREQUENT or least == 3:
        kept = sum(row["count"] for row in levels if row["level"] >= least)
        least += 1
    least -= 1

    often = several.filter(F.col("count") >= 1 << least).toArrow()
    values = np.asarray(often["shingle"], dtype=np.int64)
    by_value = np.argsort(values)
    return Order(
        hash_filter(several.select("shingle"), known),
        values[by_value],
        np.asarray(often["count"], dtype=np.int64)[by_value],
    )


def overlap_needed(a: int, b: int, similar: int = SIMILAR) -> int:
    """The least intersection of sets of two sizes that are similar."""
    return -(-similar * (a + b) // (100 + similar))


_SETS = (
    "doc_id bigint, n_shingles bigint, print bigint, group bigint, "
    "prefix array<bigint>, places array<int>, shingles array<bigint>"
)


def _set_rows(sent, words: int, similar: int):
    """A row per text. A set whose prefix holds nothing that another set may have keeps no
    shingles: it is similar to no other set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order: Order = sent.value
        for batch in batches:
            for part in text_slices(batch, "text"):
                values, first = shingle_sets(part.column(1), words)
                level = order.keys(values)
                ids = part.column(0).to_pylist()
                rows = {name.split(" ")[0]: [] for name in _SETS.split(", ")}
                for at in range(len(ids)):
                    own, own_level = values[first[at] : first[at + 1]], level[first[at] : first[at + 1]]
                    size = len(own)
                    length = size - -(-similar * size // 100) + 1 if size else 0
                    chosen = np.lexsort((own, own_level))[:length]
                    prefix = own[chosen]
                    shared = np.flatnonzero(own_level[chosen] > 0)
                    rows["doc_id"].append(ids[at])
                    rows["n_shingles"].append(size)
                    rows["print"].append(_digest(own, size))
                    rows["group"].append(_digest(prefix, size))
                    rows["prefix"].append(prefix[shared])
                    rows["places"].append(shared.astype(np.int32))
                    rows["shingles"].append(own if len(shared) else own[:0])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(rows["doc_id"], pa.int64()),
                        pa.array(rows["n_shingles"], pa.int64()),
                        pa.array(rows["print"], pa.int64()),
                        pa.array(rows["group"], pa.int64()),
                        pa.array(rows["prefix"], pa.list_(pa.int64())),
                        pa.array(rows["places"], pa.list_(pa.int32())),
                        pa.array(rows["shingles"], pa.list_(pa.int64())),
                    ],
                    names=list(rows),
                )

    return run


def _digest(values: np.ndarray, size: int) -> int:
    """A hash of a list of shingles and a size."""
    at = np.arange(1, len(values) + 1, dtype=np.uint64)
    total = mix64(values.view(np.uint64) ^ mix64(at)).sum(dtype=np.uint64)
    return int(mix64(np.array([total + np.uint64(size)], dtype=np.uint64)).view(np.int64)[0])


def _verified(pairs: DataFrame, sets: DataFrame, similar: int) -> DataFrame:
    """The pairs (a, b) of set ids whose whole sets are similar. ``pairs`` is a stored table; only the
    sets that it names are moved."""
    named = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
    sets = sets.join(named, "id", "left_semi")
    one = sets.select(F.col("id").alias("a"), F.col("n").alias("n_a"), F.col("shingles").alias("s_a"))
    two = sets.select(F.col("id").alias("b"), F.col("n").alias("n_b"), F.col("shingles").alias("s_b"))
    both = F.size(F.array_intersect("s_a", "s_b"))
    return (
        pairs.join(one, "a")
        .join(two, "b")
        .filter(both * (100 + similar) >= similar * (F.col("n_a") + F.col("n_b")))
        .select(*pairs.columns)
    )


def _fits(similar: int):
    """Whether the sizes, and the places of a shared prefix shingle, allow enough overlap.

    The place counts as that of the first shingle the two sets share: nothing before it can add to
    the overlap. A similar pair passes at its first shared shingle, so none is lost.
    """
    a, b = F.col("n_a"), F.col("n_b")
    most = F.least(a - F.col("at_a"), b - F.col("at_b"))
    return (
        (a * 100 >= b * similar)
        & (b * 100 >= a * similar)
        & (most * (100 + similar) >= similar * (a + b))
    )


def _mixed(postings: DataFrame) -> DataFrame:
    """The postings (shingle, id, n, at, c) of shingles whose sets are in several components, with
    the largest of them and with about how many rows of pairs across components come on each row."""
    sizes = postings.groupBy("shingle", "c").count()
    main = sizes.groupBy("shingle").agg(
        F.max(F.struct("count", "c")).alias("most"), F.sum("count").cast("double").alias("all")
    )
    others = F.col("all") - F.col("most.count")
    main = main.filter(others > 0).select(
        "shingle", F.col("most.c").alias("main"), (others * (1 - others / F.col("all") / 2)).alias("pairs_a_row")
    )
    return postings.join(main, "shingle")


def _load(mixed: DataFrame) -> float:
    """About how many rows the pairs across components would have."""
    per = mixed.groupBy("shingle").agg(
        F.count(F.lit(1)).cast("double").alias("n"), F.count_if(F.col("c") != F.col("main")).cast("double").alias("o")
    )
    return per.agg(F.sum(F.col("o") * (F.col("n") - F.col("o") / 2))).first()[0] or 0.0


def _drawn(mixed: DataFrame, turn: int, similar: int) -> DataFrame:
    """Pairs (a, b, c_a, c_b) of a set of the largest component at a shingle and one outside it. Each
    shingle has a few sets a, the first in an order of the turn's own; a set b keeps those that
    it shares most prefix shingles with."""
    order = Window.partitionBy("shingle").orderBy(F.xxhash64("id", F.lit(turn)), "id")
    few = mixed.filter("c = main").withColumn("place", F.row_number().over(order))
    one = few.filter(F.col("place") <= DRAWN << turn).select(
        "shingle", F.col("id").alias("a"), F.col("n").alias("n_a"), F.col("at").alias("at_a"), F.col("c").alias("c_a")
    )
    two = mixed.filter("c != main").select(
        "shingle", F.col("id").alias("b"), F.col("n").alias("n_b"), F.col("at").alias("at_b"), F.col("c").alias("c_b")
    )
    shared = one.join(two, "shingle").filter(_fits(similar)).groupBy("a", "b", "c_a", "c_b").count()
    best = Window.partitionBy("b").orderBy(F.desc("count"), F.xxhash64("a", F.lit(turn)), "a")
    ranked = shared.withColumn("place", F.row_number().over(best))
    return ranked.filter(F.col("place") <= TRIED << turn).select("a", "b", "c_a", "c_b")


def _joined(nodes: DataFrame, name: str, merged: DataFrame) -> DataFrame:
    """The rows with the component in the column of that name replaced by what it has become part of."""
    became = merged.select(F.col("node").alias(name), F.col("component").alias("became"))
    both = nodes.join(became, name, "left").withColumn(name, F.coalesce("became", name))
    return both.select(nodes.columns)


def _relabelled(mixed: DataFrame, merged: DataFrame) -> DataFrame:
    """The rows by the components that their own have become part of. The largest at a shingle stays
    the one that others meet there, whether or not it still is the largest."""
    return _joined(_joined(mixed, "c", merged), "main", merged)


def _met(mixed: DataFrame, sets: DataFrame, rows: int, pairs: float, similar: int) -> DataFrame:
    """What components (node) become part of (component) when sets meet drawn ones. Only shingles of
    many pairs a row take part; the others have few pairs as they are."""
    hot = stored(mixed.filter(F.col("pairs_a_row") > PAIRS_A_ROW).drop("pairs_a_row"), "hot")
    light, moved = pairs - _load(hot), None
    for turn in range(TURNS):
        drawn = stored(_drawn(hot, turn, similar), "drawn")
        met = stored(_verified(drawn, sets, similar), "met")
        merged = stored(components(met.select(F.col("c_a").alias("a"), F.col("c_b").alias("b"))), "components")
        both = drawn.select("b", F.lit(0).alias("hit")).union(met.select("b", F.lit(1)))
        asked, linked = both.groupBy("b").agg(F.max("hit").alias("hit")).agg(F.count("b"), F.coalesce(F.sum("hit"), F.lit(0))).first()
        before, hot = hot, stored(_relabelled(hot, merged), "hot")
        fresh = merged.filter("node != component")
        earlier, moved = moved, stored(fresh if moved is None else _joined(moved, "component", merged).union(fresh), "moved")
        discard(before, drawn, met, merged, *([earlier] if earlier is not None else []))
        if linked <= WORTHWHILE * asked or light + _load(hot) <= PAIRS_A_ROW * rows:
            break
    discard(hot)
    return moved


def similar_documents(
    documents: DataFrame, words: int = WORDS, similar: int = SIMILAR
) -> DataFrame:
    """One row per row of ``documents`` (doc_id, text; other columns are ignored): doc_id,
    n_shingles and component_id, the smallest doc_id reachable by links, itself included.

    Texts are lower-cased in A-Z and cut into words at white space. A null text, or one without
    words, has an empty set and no links. A row without doc_id links with nothing and has a null
    component. Rows of one doc_id are vertices of one name: what either links to, both reach.
    Shingles are compared by 64-bit hashes.
    """
    rows = require(documents, ["doc_id", "text"])
    named = rows.filter("doc_id is not null")
    sent = rows.sparkSession.sparkContext.broadcast(shingle_order(named, words))
    made = stored(rows.mapInArrow(_set_rows(sent, words, similar), _SETS), "sets", BATCH_BYTES)
    sent.destroy()

    # Equal sets are one vertex: the smallest doc_id stands for them.
    member = made.filter("doc_id is not null and n_shingles > 0").select("doc_id", "n_shingles", "print")
    least = member.groupBy("print", "n_shingles").agg(F.min("doc_id").alias("id"))
    same = member.join(least, ["print", "n_shingles"]).select(F.col("doc_id").alias("a"), F.col("id").alias("b"))
    candidates = made.filter("size(prefix) > 0 and doc_id is not null")
    kept = least.select("id", F.col("print").alias("p"), F.col("n_shingles").alias("m")).join(
        candidates,
        (F.col("id") == F.col("doc_id")) & (F.col("p") == F.col("print")) & (F.col("m") == F.col("n_shingles")),
    )
    sets = stored(
        kept.dropDuplicates(["id", "print", "n_shingles"])
        .select("id", F.col("n_shingles").alias("n"), "group", "prefix", "places", "shingles"),
        "distinct-sets",
    )

    # Members of a group all meet its least member; groups meet at their prefix shingles.
    groups = sets.groupBy("group", "n").agg(F.min("id").alias("head"))
    heads = sets.join(groups, ["group", "n"])
    in_group = heads.filter("id != head").select(F.col("head").alias("a"), F.col("id").alias("b"))
    postings = stored(
        heads.filter("id = head").select(
            "id", "n", F.explode(F.arrays_zip("prefix", "places")).alias("p")
        ).select("id", "n", F.col("p.prefix").alias("shingle"), F.col("p.places").alias("at")),
        "postings",
    )
    first = postings.groupBy("shingle").agg(F.min(F.struct("id", "n", "at")).alias("least"), F.max("id").alias("most"))
    first = first.filter("least.id != most").select("shingle", "least")
    star = (
        postings.select("shingle", F.col("id").alias("b"), F.col("n").alias("n_b"), F.col("at").alias("at_b"))
        .join(first, "shingle")
        .select("b", "n_b", "at_b", F.col("least.id").alias("a"), F.col("least.n").alias("n_a"), F.col("least.at").alias("at_a"))
        .filter((F.col("a") != F.col("b")) & _fits(similar))
        .groupBy("b", "a")
        .count()
        .groupBy("b")
        .agg(F.max(F.struct("count", (-F.col("a")).alias("minus"))).alias("best"))
        .select((-F.col("best.minus")).alias("a"), "b")
    )
    tried = stored(star.union(in_group).distinct(), "pairs")
    links = stored(_verified(tried, sets, similar), "links")
    found = stored(components(links), "components")

    # Pairs across components. A shingle all of whose sets are in one component is left out; the
    # largest component at a shingle meets the others, and the others meet each other.
    of = sets.select("id", "n", "group").join(found.withColumnRenamed("node", "id"), "id", "left")
    of = of.select("id", "n", "group", F.coalesce("component", "id").alias("c"))
    head_of = heads.select("id", "head")
    spread = stored(
        postings.select("shingle", F.col("id").alias("head"), "at")
        .join(head_of, "head")
        .join(of.select("id", "n", "c"), "id")
        .select("shingle", "id", "n", "at", "c"),
        "postings",
    )
    mixed = stored(_mixed(spread), "mixed")
    rows, pairs = mixed.agg(F.count(F.lit(1)), F.coalesce(F.sum("pairs_a_row"), F.lit(0.0))).first()
    if pairs > PAIRS_A_ROW * rows:
        moved = _met(mixed, sets, rows, pairs, similar)
        before, mixed = mixed, stored(_relabelled(mixed, moved), "mixed")
        known = sets.select(F.col("id").alias("node")).join(found, "node", "left")
        known = known.select("node", F.coalesce("component", "node").alias("component"))
        found = stored(_joined(known, "component", moved), "components")
        discard(before, moved)

    others = mixed.filter("c != main")
    two = others.select(
        "shingle", F.col("id").alias("b"), F.col("n").alias("n_b"), F.col("at").alias("at_b"), F.col("c").alias("c_b")
    )
    one = mixed.select(
        "shingle", F.col("id").alias("a"), F.col("n").alias("n_a"), F.col("at").alias("at_a"), F.col("c").alias("c_a"), "main"
    )
    across = stored(
        one.join(two, "shingle")
        .filter(
            ((F.col("c_a") == F.col("main")) | (F.col("c_a") < F.col("c_b")))
            & (F.col("c_a") != F.col("c_b"))
            & _fits(similar)
        )
        .select(
            F.least("a", "b").alias("a"),
            F.greatest("a", "b").alias("b"),
            F.when(F.col("a") < F.col("b"), F.col("c_a")).otherwise(F.col("c_b")).alias("c_a"),
            F.when(F.col("a") < F.col("b"), F.col("c_b")).otherwise(F.col("c_a")).alias("c_b"),
        )
        .distinct()
        .join(tried.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), ["a", "b"], "left_anti"),
        "pairs",
    )
    # What is linked across components joins them as wholes.
    joins = _verified(across, sets, similar).select(F.col("c_a").alias("a"), F.col("c_b").alias("b"))
    # A doc_id of several sets joins their components. Most tables have none, and then plan nothing for it.
    several = same.groupBy("a").agg(F.min("b").alias("first"), F.max("b").alias("last"))
    several = several.filter("first != last").select("a", "first")
    if not several.isEmpty():
        several = same.join(several, "a").select(F.col("first").alias("a"), "b")
        c = found.withColumnRenamed("node", "a").withColumnRenamed("component", "c_a")
        d = found.withColumnRenamed("node", "b").withColumnRenamed("component", "c_b")
        several = several.join(c, "a", "left").join(d, "b", "left")
        joins = joins.union(several.select(F.coalesce("c_a", "a"), F.coalesce("c_b", "b")))
    joined = components(joins)
    discard(sets, postings, tried, links, spread, mixed, across)
    final = (
        same.select(F.col("a").alias("doc_id"), F.col("b").alias("node"))
        .join(found, "node", "left")
        .select("doc_id", F.coalesce("component", "node").alias("node"))
        .join(joined, "node", "left")
        .groupBy("doc_id")
        .agg(F.min(F.coalesce("component", "node")).alias("component"))
    )
    return (
        made.select("doc_id", "n_shingles")
        .join(final, "doc_id", "left")
        .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
    )
