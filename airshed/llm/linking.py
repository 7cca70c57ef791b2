"""From buckets of candidates to components of verified links, for the operators that join similar texts.

An operator deals classes (different sets of shingles) into buckets so that any two that link share one. In a small bucket all
members are compared with all, in a larger one a few, its centres: a number of pairs that grows with the rows. What then still lies in
several components of one larger bucket is searched without pairs: buckets that share a component make a cluster, its classes
outside the largest component are held as an inverted index by their size, in blocks of bounded size, and the cluster's classes
of sizes that may link pass by them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airshed.llm.common import written
from airshed.llm.components import components
from airshed.llm.hashing import grams, mixed, word_hashes

#: Members of a bucket that are compared with all its members, and the members up to which a bucket is small: all of them are centres.
CENTRES, SMALL = 3, 12
#: Shingles held at once by a task of the search, and pairs of equal shingles it counts at once.
HELD_SHINGLES, COUNTED_PAIRS = 1 << 21, 1 << 22


@dataclass(frozen=True)
class Rule:
    """Shingles of ``words`` words; two sets link if ``den`` * intersection >= ``num`` * union."""
    words: int = 5
    num: int = 80
    den: int = 100

    def difference(self, sizes):
        """The largest symmetric difference of two linked sets whose sizes add up to ``sizes``."""
        return sizes * (self.den - self.num) // (self.den + self.num)


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct shingle hashes of a text; with fewer words, the whole sequence is one shingle."""
    w = word_hashes((text or "").encode().lower().split())
    if not len(w):
        return w
    return np.unique(mixed(grams(w, min(words, len(w))) + np.uint64(min(words, len(w)))))


def whole_sets(rule: Rule):
    """(c, text) -> c, the size of its set and the set."""
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in batches:
                for at in range(0, len(batch), 200):
                    part = batch.slice(at, 200)
                    found = [shingle_set(text.as_py(), rule.words) for text in part.column(1)]
                    yield pa.RecordBatch.from_arrays([part.column(0), pa.array([len(s) for s in found], pa.int64()),
                                                      pa.array([s.view(np.int64) for s in found], pa.list_(pa.int64()))], names=["c", "n", "shingles"])
    return sets


def centres(buckets: DataFrame, columns: list[str]) -> DataFrame:
    """key and ``centres`` (structs of ``columns``, which begin with c) of every bucket (key, ``size`` and columns): all members of a small one,
    else the first in CENTRES hashed orders, which are the same orders in all buckets, so that buckets with the same members have the same centres."""
    small = buckets.filter(F.col("size") <= SMALL).groupBy("key").agg(F.collect_list(F.struct(*columns)).alias("centres"))
    return small.unionByName(larger(buckets).groupBy("key").agg(F.array_distinct(F.array(*[
        F.min_by(F.struct(*columns), F.xxhash64("c", F.lit(seed))) for seed in range(CENTRES)])).alias("centres")))


def _others(buckets: DataFrame, centred: DataFrame) -> DataFrame:
    """key and c of the members that are no centres."""
    return buckets.select("key", "c").join(centred, "key").filter(~F.array_contains("centres.c", F.col("c"))).select("key", "c")


def larger(buckets: DataFrame) -> DataFrame:
    """The buckets that may have members that are no centres."""
    return buckets.filter(F.col("size") > SMALL)


def compared(buckets: DataFrame, centred: DataFrame, pairs: DataFrame) -> DataFrame:
    """The classes c whose whole sets ``verify`` (of ``pairs`` (u, v)) and ``members`` (of the same buckets) may read."""
    return pairs.select(F.col("u").alias("c")).unionByName(pairs.select(F.col("v").alias("c"))).unionByName(
        _others(buckets, centred).select("c")).distinct()


def star_pairs(buckets: DataFrame, centred: DataFrame, columns: list[str]) -> DataFrame:
    """Each pair of a centre and a member of its bucket once, as u < v with their further ``columns`` as column_u and column_v."""
    own = F.struct(*columns)
    ends = buckets.join(centred, "key").select(own.alias("own"), F.explode("centres").alias("centre")).filter("own.c <> centre.c")
    ordered = ends.select(F.least("own", "centre").alias("low"), F.greatest("own", "centre").alias("high"))
    return ordered.select(*[F.col(f"{end}.{c}").alias({"c": side}.get(c, f"{c}_{side}")) for end, side in (("low", "u"), ("high", "v")) for c in columns]).distinct()


def verify(pairs: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """u, v and ``linked`` of each pair, from the whole sets. Only v's set is shuffled to u; a
    class with many partners is a skewed key of an equi-join, not a copied set for each."""
    v = sets.select(F.col("c").alias("v"), F.col("n").alias("n_v"), F.col("shingles").alias("s_v"))
    u = sets.select(F.col("c").alias("u"), F.col("n").alias("n_u"), F.col("shingles").alias("s_u"))
    common = F.size(F.array_intersect("s_u", "s_v"))
    return (pairs.select("u", "v").join(v, "v").join(u, "u").withColumn("common", common)
            .select("u", "v", (rule.den * F.col("common") >= rule.num * (F.col("n_u") + F.col("n_v") - F.col("common"))).alias("linked")))


def members(buckets: DataFrame, centred: DataFrame, linked: DataFrame, sets: DataFrame, rule: Rule, close=None) -> DataFrame:
    """node and component of the classes in components of several, given the links (u, v) among the pairs with a centre. Of ``buckets``, those
    that are all centres may be left out. ``close``: see ``_search``."""
    first = components(linked)
    found = written(_search(buckets, centred, first, sets, rule, close), "linking-found")
    return first if found.isEmpty() else components(linked.unionByName(found))


def _search(buckets: DataFrame, centred: DataFrame, member: DataFrame, sets: DataFrame, rule: Rule, close=None) -> DataFrame:
    """Links (u, v) between classes of one bucket that lie in different components: enough to join these, fewer than there are classes.
    Pairs with a centre are known, so only the other members of a bucket are looked at. The whole sets of a cluster are copied for each of its blocks;
    given ``close``, only the classes c take part that it returns of rows (cluster, c, component): it leaves out what links with no class of another component."""
    rest = _others(buckets, centred).join(member.withColumnRenamed("node", "c"), "c", "left").withColumn("component", F.coalesce("component", "c"))
    unsettled = rest.groupBy("key").agg(F.min("component").alias("least"), F.max("component").alias("most")).filter("least <> most")
    open_ = written(rest.join(unsettled.select("key", "least"), "key").select("c", "component", "least").distinct(), "linking-open")
    clusters = components(open_.select(F.col("least").alias("u"), F.col("component").alias("v")).distinct())
    clusters = clusters.select(F.col("node").alias("component"), F.col("component").alias("cluster"))
    rows = open_.select("c", "component").distinct().join(clusters, "component", "left").withColumn("cluster", F.coalesce("cluster", "component"))
    if close:
        rows = rows.join(written(close(rows), "linking-close"), "c", "left_semi")
    rows = rows.join(sets.select("c", "n"), "c")
    of = rows.groupBy("cluster", "component").agg(F.count("*").alias("classes"))
    of = of.groupBy("cluster").agg(F.max_by("component", F.struct("classes", "component")).alias("main"))
    # sizes of linked sets lie in one band or in neighbouring ones (a band is a little wider than what rounding may add)
    band = F.floor(F.log(F.col("n").cast("double")) / max(math.log(rule.den / rule.num) * (1 + 1e-9), 1e-9))
    rows = written(rows.join(of, "cluster").select("cluster", "c", "component", "main", "n", band.alias("band")), "linking-rows")
    held = rows.filter("component <> main").select("cluster", "band", "c", "component", "n")
    passing = rows.select("cluster", F.explode(F.array(*[F.col("band") + i for i in (-1, 0, 1)])).alias("band"), "c", "component", "n")

    def count(of: DataFrame, name: str) -> DataFrame:
        return of.groupBy("cluster", "band").agg(F.ceil(F.sum("n") / HELD_SHINGLES).alias(name))
    sizes = count(held, "blocks").join(count(passing, "parts"), ["cluster", "band"])

    def dealt(count: str):
        return F.pmod(F.xxhash64("c", F.lit(count)), F.col(count))

    def every(count: str):
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(count) - 1))
    group = F.xxhash64("cluster", "band").alias("cluster")  # groups that share a hash are searched together
    held = held.join(sizes, ["cluster", "band"]).select(group, dealt("blocks").alias("block"), every("parts").alias("part"), F.lit(0).alias("side"), "c", "component")
    passing = passing.join(sizes, ["cluster", "band"]).select(group, every("blocks").alias("block"), dealt("parts").alias("part"), F.lit(1).alias("side"), "c", "component")
    both = held.unionByName(passing).join(sets.select("c", "shingles"), "c").select("cluster", "block", "part", "side", "c", "component", "shingles")
    found = (both.repartition("cluster", "block", "part").sortWithinPartitions("cluster", "block", "part", "side")
             .mapInArrow(_searched(rule), "u long, v long").distinct())
    return found


class _Held:
    """The held classes of a group: an inverted index of their shingles, and the components as far as they are joined."""

    def __init__(self, rule: Rule, c: list[int], component: list[int], sets: list[np.ndarray]) -> None:
        self.rule, self.c, self.sizes = rule, np.array(c), np.array([len(s) for s in sets])
        self.label, self.joined = np.array(component), {}
        owner, shingles = np.repeat(np.arange(len(c)), self.sizes), np.concatenate(sets)
        order = np.argsort(shingles, kind="stable")
        self.owner = owner[order]
        self.shingles, self.starts, self.counts = np.unique(shingles[order], return_index=True, return_counts=True)

    def find(self, component: int) -> int:
        while component in self.joined:
            component = self.joined[component]
        return component

    def common(self, values: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
        """How many shingles each of some passing rows shares with each held class."""
        at = np.minimum(np.searchsorted(self.shingles, values), len(self.shingles) - 1)
        hit = self.shingles[at] == values
        at, row = at[hit], row[hit]
        n = self.counts[at]
        place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(self.starts[at], n)
        return np.bincount(np.repeat(row, n) * len(self.c) + self.owner[place], minlength=rows * len(self.c)).reshape(rows, len(self.c))

    def links(self, c: np.ndarray, component: np.ndarray, sets: list[np.ndarray]) -> Iterator[tuple[int, int]]:
        sizes = np.array([len(s) for s in sets])
        common = self.common(np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes), len(sets))
        near = self.rule.den * common >= self.rule.num * (sizes[:, None] + self.sizes[None, :] - common)
        for i in np.flatnonzero(near.any(axis=1)):
            own = self.find(int(component[i]))
            for j in np.flatnonzero(near[i] & (self.label != own)):
                if (other := int(self.label[j])) != own:
                    self.joined[other] = own
                    self.label[self.label == other] = own
                    yield int(c[i]), int(self.c[j])


def _searched(rule: Rule):
    """(cluster, block, part, side, c, component, shingles) sorted by them -> links (u, v) between components."""
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, index = None, ([], [], []), None
        for batch in batches:
            cluster, block, part, side, c, component = (batch.column(i).to_numpy() for i in range(6))
            offsets, values = batch.column(6).offsets.to_numpy(), batch.column(6).values.to_numpy()
            edges = np.flatnonzero((np.diff(cluster) != 0) | (np.diff(block) != 0) | (np.diff(part) != 0) | (np.diff(side) != 0)) + 1
            found: list[tuple[int, int]] = []
            for a, b in zip([0, *edges], [*edges, len(batch)], strict=True):
                if a == b:
                    continue
                if (group := (cluster[a], block[a], part[a])) != now:
                    now, held, index = group, ([], [], []), None
                sets = [values[offsets[i]:offsets[i + 1]] for i in range(a, b)]
                if side[a] == 0:
                    for kept, new in zip(held, (c[a:b].tolist(), component[a:b].tolist(), [s.copy() for s in sets]), strict=True):
                        kept.extend(new)
                    continue
                if not held[0]:
                    continue  # none of the group's held classes fell into this block
                index = index or _Held(rule, *held)
                step = max(1, COUNTED_PAIRS // (len(held[0]) * max(1, int(np.mean([len(s) for s in sets])))))
                for i in range(0, b - a, step):
                    found += index.links(c[a + i:min(b, a + i + step)], component[a + i:min(b, a + i + step)], sets[i:i + step])
            yield pa.RecordBatch.from_arrays([pa.array([min(x) for x in found], pa.int64()), pa.array([max(x) for x in found], pa.int64())], names=["u", "v"])
    return search


def labelled(documents: DataFrame, classes: DataFrame, member: DataFrame) -> DataFrame:
    """doc_id, text_digest, n_shingles, component_id and ``first`` of ``documents`` (doc_id, text_digest, n, digest), given
    their ``classes`` (c, digest) and the components of these."""
    component = classes.select("c", "digest").join(member.withColumnRenamed("node", "c"), "c", "left").select("digest", F.coalesce("component", "c").alias("component"))
    out = documents.join(component, "digest", "left")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_digest")
    leads = out.filter("n > 0").groupBy("component").agg(F.min(order).alias("lead"))
    out = out.join(leads, "component", "left")
    return out.select("doc_id", "text_digest", F.col("n").alias("n_shingles"),
                      F.when(F.col("n") > 0, F.col("lead.doc_id")).otherwise(F.col("doc_id")).alias("component_id"),
                      F.when(F.col("n") > 0, order == F.col("lead")).otherwise(F.lit(True)).alias("first"))
