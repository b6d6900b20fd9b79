"""Similarity join of texts by the Jaccard similarity of their word shingles, along chosen paths.

Every set picks a few of its shingles by a hash that all sets share; sets meet in a bucket if they
picked the same one. A bucket of few sets is searched whole, buckets of the same sets once. In a
larger one the sketch of every set is held against those of a few members. Sets that agree are
linked to them. A partner of a set that is very near to a member is not far from that member
itself, so only the other sets pick again, by a hash that depends on the bucket's path, and so on,
until buckets are small. A shingle that most sets of a bucket share says nothing about their
similarity: it is not picked again, and a bucket that splitting did not shrink is not split again.
The sets of such buckets, and of buckets that are large at the last depth, are joined exactly: by the
rarest shingles of each, one of which any two similar sets have in common. A pair at the threshold
misses all its common buckets with the probability that the recall target allows, which sets the
number of picks, that is of repeated runs.

Buckets only propose: they link sets that a bottom-k sketch holds for similar, and their connected
components are then compared pair by pair, in blocks of bounded size, by whole shingle sets. So
neither false links nor lists of pairs arise; a block reports counts and a spanning forest.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.work import distinct_by_key
from ..sources.scratch import Scope, job_scope, stored
from . import tokens as tk
from .components import connected_components
from .keys import may_be_named, text_key

#: Words of a shingle, sketch size, sets that a bucket may have, depth of paths, sets of a block.
SHINGLE, SKETCH, SMALL, DEPTH, BLOCK = 5, 48, 64, 4, 512
#: Share of a set's sketch that it picks again inside a bucket, members that a large bucket is held against, and
#: the share of common values from which a set is so near to such a member that its partners agree with it as well.
AGAIN, HUBS, CORE = 6, 3, 0.85
#: Memberships of buckets that a task searches, about, and those that it holds against members at once.
TASK_ROWS, AT_ONCE = 2_000, 2_048
#: Bytes of shingle sets that a task compares at once, on average.
TASK_BYTES = 8 << 20


def shingle_sets(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per slice of texts: distinct shingle hashes in order, text after text, and where each text begins.

    A text of fewer words than a shingle, but not none, has one shingle of all its words.
    """
    for _, _, _, _, firsts, values in tk.words_of(column):
        n = np.diff(firsts)
        grams, owner = tk.gram_hashes(values, SHINGLE), np.zeros(0, np.int64)
        if len(grams):
            owner = np.searchsorted(firsts, np.arange(len(grams)), "right") - 1
            whole = firsts[owner + 1] >= np.arange(len(grams)) + SHINGLE
            grams, owner = grams[whole], owner[whole]
        for k in range(1, SHINGLE):
            short = np.flatnonzero(n == k)
            if len(short):
                own = tk.mix(tk.gram_hashes(values, k)[firsts[short]] + np.uint64(k))
                grams, owner = np.concatenate([grams, own]), np.concatenate([owner, short])
        order = np.lexsort((grams, owner))
        grams, owner = grams[order], owner[order]
        new = np.ones(len(grams), bool)
        new[1:] = (grams[1:] != grams[:-1]) | (owner[1:] != owner[:-1])
        grams, owner = grams[new], owner[new]
        yield grams, np.searchsorted(owner, np.arange(len(n) + 1))


def _lists(values: np.ndarray, owner: np.ndarray, n: int, kind: pa.DataType) -> pa.Array:
    offsets = np.searchsorted(owner, np.arange(n + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


def _describe(picks: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            for grams, first in shingle_sets(batch.column("text")):
                n = len(first) - 1
                size = np.diff(first)
                owner = np.repeat(np.arange(n), size)
                names = []
                for salt in (0x1F83D9ABFB41BD6B, 0x5BE0CD19137E2179):
                    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(tk.mix(grams ^ np.uint64(salt)))])
                    names.append(total[first[1:]] - total[first[:-1]])
                both = np.stack(names, 1).astype("<u8").tobytes()
                node = pa.array([both[16 * i : 16 * i + 16] if size[i] else None for i in range(n)], pa.binary())
                rank = np.arange(len(grams)) - first[owner]
                low = rank < SKETCH
                columns = [_lists((grams[low] >> np.uint64(32)).astype(np.uint32).view(np.int32), owner[low], n, pa.int32())]
                salt = np.uint64(0x6A09E667F3BCC908)
                chance = (tk.mix(grams ^ salt) >> np.uint64(11)).astype(np.float64) / 2.0**53
                chosen = chance * size[owner] < picks
                columns.append(_lists(tk.mix(grams[chosen] + salt).view(np.int64), owner[chosen], n, pa.int64()))
                rows = batch.slice(done, n)
                done += n
                yield pa.RecordBatch.from_arrays([rows.column("doc_id"), rows.column("text_key"), node, pa.array(size, pa.int64()), *columns], names=["doc_id", "text_key", "node", "size", "sketch", "first"])

    return run


_KEY = "struct<a:long,b:long>"


def jaccard_join(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.8, recall: float = 0.9999,
    small: int = SMALL, depth: int = DEPTH, block: int = BLOCK,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, text_key, class_id, n_links, keep``.

    Two documents are linked if the sets of their shingles of five words (``[^\\x20\\x09-\\x0D]+``,
    unchanged) have a Jaccard similarity of ``threshold`` or more. ``n_links`` counts the linked
    documents, equal ones included; ``class_id`` is the least id of the connected component, and
    ``keep`` holds for its first row by id (null last), then ``text_key``; repeats of that row
    hold it too. A text without words, or null, is linked to nothing and kept; its class is its
    own id. Ids may be null or repeated. ``recall`` bounds the share of links missed at the
    threshold; every link reported is exact, up to collisions of 64-bit shingle hashes.
    """
    picks = math.log(3 / (1 - recall)) / threshold
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    keyed = rows.select("doc_id", text_key(F.col("text")).alias("text_key"), "text")
    spec = f"doc_id long, text_key {_KEY}, node binary, size long, sketch array<int>, first array<long>"
    row = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "text_key").alias("row")
    with job_scope(docs.sparkSession) as scope:
        described = stored(keyed.mapInArrow(_describe(picks), spec), "sets")
        known = described.filter("node is not null").select("node", row, "size", "sketch", "first")
        weights = stored(known.groupBy("node").agg(F.min("row").alias("row"), F.count("*").alias("weight")), "weights")
        # Of equal sets one row stands for all.
        sets = stored(distinct_by_key(known, ["node"], "row", total=known.count()), "distinct-sets")
        edges, left = _proposals(scope, sets, threshold, small, depth)
        if left is not None:
            edges = edges.unionByName(_by_rarest(keyed, weights, sets, left, threshold, small, block))
        found = stored(edges.filter("a <> b").distinct(), "proposals")
        groups = stored(connected_components(found), "groups")
        sizes = sets.select("node", "size")
        links = stored(_compared(keyed, weights.join(sizes, "node"), groups, threshold, block), "links-found")
        scope.drop(sets, found, groups)
        roots = connected_components(links.filter("b is not null").select("a", "b"))

        linked = links.filter("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n"))
        per_set = weights.join(linked, "node", "left").join(roots, "node", "left")
        per_set = per_set.select("node", "row", F.coalesce("root", "node").alias("root"), (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"))
        leaders = per_set.groupBy("root").agg(F.min("row").alias("leader"))
        judged = per_set.join(leaders, "root").select("node", "leader", "n_links")
        out = described.select("doc_id", "text_key", "node", row).join(judged, "node", "left").select(
            "doc_id", "text_key",
            F.when(F.col("leader").isNull(), F.col("doc_id")).otherwise(F.col("leader.doc_id")).alias("class_id"),
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            F.coalesce(F.col("row") == F.col("leader"), F.lit(True)).alias("keep"),
        )
        return stored(out, "classes", keep=True)


def _proposals(scope: Scope, sets: DataFrame, threshold: float, small: int, depth: int) -> tuple[DataFrame, DataFrame | None]:
    """Edges ``a, b`` whose components hold every similar pair that meets in a bucket, but for pairs of the sets ``node`` that come second.

    Those are the sets that large buckets are left with, if any.
    """
    paths = sets.select("node", F.explode("first").alias("path"), F.lit(None).cast("long").alias("parent"))
    edges = over = None
    for level in range(1, depth + 1):
        grouped = paths.groupBy("path").agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("node")).alias("same"), F.first("parent").alias("parent"))
        counts = stored(grouped.filter("n > 1"), "bucket-sizes")
        once = counts.filter(F.col("n") <= small).groupBy("same", "n").agg(F.min("path").alias("path"))
        kept = once.select("path", "n", F.lit(None).cast("long").alias("parent")).unionByName(counts.filter(F.col("n") > small).select("path", "n", "parent"))
        met = stored(paths.select("node", "path").join(kept, "path"), "buckets")
        found = stored(_searched(met.filter(F.col("n") <= small), sets, threshold), "edges")
        edges = found if edges is None else edges.unionByName(found)
        large = met.filter(F.col("n") > small).select("path", "node", "n", "parent")
        if large.isEmpty():
            break
        hubs = _hubs(large, sets)
        agreed = stored(_agreement(large, hubs, sets, threshold), "agreement")
        # A set is linked to one member, and the members that one set agrees with to each other, once for all sets.
        edges = edges.unionByName(agreed.filter("size(near) > 0").select(F.col("node").alias("a"), F.col("near")[0].alias("b")))
        several = agreed.filter("size(near) > 1").select("near").distinct()
        edges = edges.unionByName(several.select(F.explode("near").alias("a"), F.col("near")[0].alias("b")))
        # One that splitting did not shrink is not split again.
        shrunk = F.lit(level < depth) & (F.col("parent").isNull() | (2 * F.col("n") <= F.col("parent")))
        rest = agreed.filter("not core").select("path", "node", (F.size("near") > 0).alias("agrees"), shrunk.alias("shrunk"))
        scope.drop(counts, met)
        sizes = rest.groupBy("path").agg(F.count("*").alias("n"), F.min("agrees").alias("done"), F.first("shrunk").alias("shrunk")).filter("n > 1")
        # Where all sets agree with some member, the members are linked, and the exact comparison decides.
        whole = sizes.filter("done").join(hubs, "path").select(F.transform("hubs", lambda h: h["hub"]).alias("h"))
        edges = edges.unionByName(whole.select(F.explode("h").alias("a"), F.col("h")[0].alias("b")))
        split = rest.select("path", "node").join(sizes.filter("not done").select("path", "n", "shrunk").join(hubs.select("path", "shared"), "path"), "path")
        again = split.join(sets.select("node", "sketch"), "node")
        picked = F.filter("sketch", lambda x: F.pmod(F.xxhash64("path", x), F.lit(AGAIN)) == 0)
        again = stored(again.select("node", "path", "n", "shrunk", F.array_except(picked, "shared").alias("used"), F.arrays_overlap(picked, "shared").alias("passed")), "picked-again")
        # Sets of a bucket that is not split, and those that did not pick what most of it share.
        left = again.filter("not shrunk or passed").select("node")
        over = left if over is None else over.unionByName(left)
        paths = again.filter("shrunk").select("node", F.col("path").alias("up"), F.col("n").alias("parent"), F.explode("used").alias("token"))
        if paths.isEmpty():
            break
        paths = paths.select("node", F.xxhash64("up", "token").alias("path"), "parent")
    return edges, None if over is None else over.distinct()


def _by_rarest(keyed: DataFrame, weights: DataFrame, sets: DataFrame, left: DataFrame, threshold: float, small: int, block: int) -> DataFrame:
    """Edges ``a, b`` whose components hold every similar pair of the sets ``left``.

    In any one order of all shingles, two sets of similarity ``threshold`` have one in common among
    the first ``size - threshold * size + 1`` of each. In the order of how many sets hold them, those
    are rare ones; of one that no other set holds only the number matters.
    """
    left = stored(left, "left-sets")
    members = stored(left.join(weights.select("node", "row"), "node").select("node", "row.doc_id", "row.text_key"), "left-members")
    same = F.col("d.doc_id").eqNullSafe(F.col("m.doc_id")) & (F.col("d.text_key") == F.col("m.text_key"))
    wanted = keyed.filter(may_be_named(members, F.col("doc_id"), F.col("text_key")))
    # Written first: a task that also looked the rows up would hold two Python processes, which keep their memory.
    texts = stored(wanted.alias("d").join(members.alias("m"), same).select("node", "text"), "left-texts")
    tokens = stored(texts.mapInArrow(_shingled, "node binary, size long, token long"), "shingles")
    shared = tokens.groupBy("token").agg(F.count("*").alias("n")).filter("n > 1")
    own = tokens.join(shared, "token").groupBy("node", "size").agg(F.array_sort(F.collect_set(F.struct("n", "token"))).alias("held"))
    first = F.col("size") - F.ceil(threshold * F.col("size") - 1e-6) + 1 - (F.col("size") - F.size("held"))
    rare = own.filter(first > 0).select("node", F.explode(F.slice("held", F.lit(1), first.cast("int"))).alias("t"))
    rare = stored(rare.select("node", F.col("t.token").alias("path")), "rarest")
    counts = rare.groupBy("path").agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("node")).alias("same")).filter("n > 1")
    met = stored(rare.join(counts.groupBy("same", "n").agg(F.min("path").alias("path")).drop("same"), "path"), "rarest-shared")
    found = _searched(met.filter(F.col("n") <= small), sets, threshold)
    return stored(found.unionByName(_searched_in_blocks(met.filter(F.col("n") > small), sets, threshold, block)), "edges-of-rarest")


def _shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        done = 0
        for grams, first in shingle_sets(batch.column("text")):
            size = np.diff(first)
            at = pa.array(np.repeat(np.arange(len(size)), size))
            node = batch.column("node").slice(done, len(size)).take(at)
            yield pa.RecordBatch.from_arrays([node, pa.array(np.repeat(size, size), pa.int64()), pa.array(grams.view(np.int64))], names=["node", "size", "token"])
            done += len(size)


def _searched(met: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Edges between sets of small buckets whose sketches agree."""
    rows = met.select("path", "node").join(sets.select("node", "size", "sketch"), "node")
    parts = F.pmod(F.xxhash64("path"), F.lit(max(1, met.count() // TASK_ROWS))).alias("part")
    return rows.select(parts, "path", "node", "size", "sketch").groupBy("part").applyInArrow(_search(threshold), "a binary, b binary")


def _searched_in_blocks(met: DataFrame, sets: DataFrame, threshold: float, block: int) -> DataFrame:
    """Edges between sets of large buckets whose sketches may agree: any two blocks of a bucket are a unit of work."""
    n = F.ceil(F.col("n") / block).cast("int")
    rows = met.select("path", "node", n.alias("blocks")).withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    others = F.filter(F.sequence(F.lit(0), F.col("blocks") - 1), lambda x: (x != F.col("own")) | (F.col("blocks") == 1))
    rows = rows.select("path", "node", "own", F.explode(others).alias("x"))
    unit = F.xxhash64("path", F.least("own", "x"), F.greatest("own", "x"))
    rows = rows.select("node", unit.alias("unit")).join(sets.select("node", "size", "sketch"), "node")
    parts = max(1, rows.count() // TASK_ROWS)
    return rows.withColumn("part", F.pmod("unit", F.lit(parts))).groupBy("part").applyInArrow(_search_unit(threshold), "a binary, b binary")


def _search_unit(threshold: float) -> Callable[[pa.Table], pa.Table]:
    """Sketches that agree in a share of ``bound`` of their union's have at least ``bound / (2 - bound)`` of all their values in common."""
    bound = _bound(threshold)

    def run(table: pa.Table) -> pa.Table:
        unit, nodes, sketches = table["unit"].to_numpy(), table["node"].to_pylist(), table["sketch"].to_pylist()
        order = np.argsort(unit, kind="stable")
        out: set[tuple[bytes, bytes]] = set()
        for mine in np.split(order, np.flatnonzero(np.diff(unit[order])) + 1) if len(order) else ():
            every = np.ones(len(mine), bool)
            label = _labels(_linked([np.array(sketches[i]) for i in mine], every, every, bound / (2 - bound)))
            out.update((nodes[mine[i]], nodes[mine[label[i]]]) for i in np.flatnonzero(label != np.arange(len(mine))))
        return pa.table({"a": pa.array([x for x, _ in out], pa.binary()), "b": pa.array([y for _, y in out], pa.binary())})

    return run


def _hubs(large: DataFrame, sets: DataFrame) -> DataFrame:
    """``path, hubs, shared`` of large buckets: a few members, and the sketch values that two of them have.

    ``HUBS`` members of each bucket are taken by a hash of the member, so buckets of one group take
    the same ones and a set gets few links.
    """
    picks = [F.min(F.struct(F.xxhash64(F.lit(k), "node"), "node"))["node"] for k in range(HUBS)]
    hubs = large.groupBy("path").agg(F.array_distinct(F.array(*picks)).alias("hubs")).select("path", F.explode("hubs").alias("hub"))
    hubs = sets.select(F.col("node").alias("hub"), F.col("size").alias("hub_size"), F.col("sketch").alias("hub_sketch")).join(hubs, "hub")
    hubs = hubs.groupBy("path").agg(F.array_sort(F.collect_list(F.struct("hub", "hub_size", "hub_sketch"))).alias("hubs"))
    values = [F.coalesce(F.get("hubs", F.lit(k))["hub_sketch"], F.array().cast("array<int>")) for k in range(HUBS)]
    both = [F.array_intersect(x, y) for i, x in enumerate(values) for y in values[:i]]
    return stored(hubs.select("path", "hubs", F.array_distinct(F.concat(*both)).alias("shared")), "hubs")


def _agreement(large: DataFrame, hubs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """``path, node, n, parent, near, core`` for each membership of large buckets: the members that a set's sketch agrees with, and whether it is very near to one.

    The members are one row per bucket, so a bucket of any size is spread over tasks.
    """
    rows = large.join(sets.select("node", "size", "sketch"), "node").join(hubs.select("path", "hubs"), "path")
    rows = rows.select("path", "node", "n", "parent", "size", "sketch", "hubs.hub", "hubs.hub_size", "hubs.hub_sketch")
    return rows.mapInArrow(_agree(threshold), "path long, node binary, n long, parent long, near array<binary>, core boolean")


def _bound(threshold: float) -> float:
    """Least share of common values: a sketch of k values errs by sqrt(t (1 - t) / k); over four of those are allowed for."""
    return threshold - 4.5 * math.sqrt(threshold * (1 - threshold) / SKETCH)


def _agree(threshold: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def padded(lists: pa.Array) -> np.ndarray:
        sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        out = np.full((len(lists), SKETCH), -1, np.int64)
        out[np.arange(SKETCH) < sizes[:, None]] = lists.flatten().to_numpy().view(np.uint32)
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(i, AT_ONCE) for whole in batches for i in range(0, whole.num_rows, AT_ONCE)):
            many = batch.column("hub").value_lengths().to_numpy(zero_copy_only=False)
            own = np.repeat(np.arange(len(many)), many)
            size, hub_size = batch.column("size").to_numpy()[own], batch.column("hub_size").flatten().to_numpy()
            values = np.concatenate([padded(batch.column("sketch"))[own], padded(batch.column("hub_sketch").flatten())], 1)
            values = np.sort(np.where(values < 0, 1 << 40, values), 1)
            real = values < 1 << 40
            again = np.zeros(values.shape, bool)
            again[:, 1:] = real[:, 1:] & (values[:, 1:] == values[:, :-1])
            rank = np.cumsum(real & ~again, 1)
            seen = rank <= np.where((size <= SKETCH) & (hub_size <= SKETCH), 2 * SKETCH, SKETCH)[:, None]
            common, union = (again & seen).sum(1), (real & ~again & seen).sum(1)
            fits = np.minimum(size, hub_size) >= threshold * np.maximum(size, hub_size)
            near = (common >= _bound(threshold) * union) & fits
            core = np.zeros(len(many), bool)
            core[own[near & (common >= max(CORE, threshold) * union)]] = True
            offsets = np.searchsorted(own[near], np.arange(len(many) + 1)).astype(np.int32)
            agreed = pa.ListArray.from_arrays(pa.array(offsets), batch.column("hub").flatten().filter(pa.array(near)).cast(pa.binary()))
            kept = [batch.column(c) for c in ("path", "node", "n", "parent")]
            yield pa.RecordBatch.from_arrays([*kept, agreed, pa.array(core)], names=["path", "node", "n", "parent", "near", "core"])

    return run


def _search(threshold: float) -> Callable[[pa.Table], pa.Table]:
    """All pairs of every small bucket by their sketches; per bucket, each set and the first one of its component."""
    bound = _bound(threshold)

    def run(table: pa.Table) -> pa.Table:
        path, sizes = table["path"].to_numpy(), table["size"].to_numpy()
        lists = table["sketch"].combine_chunks()
        lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
        values = lists.flatten().to_numpy().view(np.uint32)
        first = np.concatenate([[0], np.cumsum(np.diff(lists.offsets.to_numpy()))])
        nodes = table["node"].to_pylist()
        order = np.argsort(path, kind="stable")
        cuts = np.flatnonzero(np.diff(path[order], prepend=path[order[0]] - 1 if len(order) else 0) != 0)
        out: set[tuple[bytes, bytes]] = set()
        for mine in np.split(order, cuts[1:]) if len(order) else ():
            out.update(_bucket(mine, nodes, sizes, values, first, threshold, bound))
        return pa.table({"a": pa.array([x for x, _ in out], pa.binary()), "b": pa.array([y for _, y in out], pa.binary())})

    return run


def _bucket(mine, nodes, sizes, values, first, threshold, bound):
    m = len(mine)
    owner = np.repeat(np.arange(m), first[mine + 1] - first[mine])
    own = np.concatenate([values[first[i] : first[i + 1]] for i in mine])
    every, column = np.unique(own, return_inverse=True)
    has = np.zeros((m, len(every)), bool)
    has[owner, column] = True
    size = sizes[mine]
    upto = np.array([len(every) if size[i] <= SKETCH else np.flatnonzero(has[i])[-1] + 1 for i in range(m)])
    label = np.arange(m)
    for i in range(m - 1):
        limit = np.minimum(upto[i], upto[i + 1 :])
        seen = np.arange(len(every))[None, :] < limit[:, None]
        common = (has[i + 1 :] & has[i] & seen).sum(1)
        union = ((has[i + 1 :] | has[i]) & seen).sum(1)
        fits = np.minimum(size[i], size[i + 1 :]) >= threshold * np.maximum(size[i], size[i + 1 :])
        for j in np.flatnonzero((common >= bound * union) & fits) + i + 1:
            if label[i] != label[j]:
                label[label == max(label[i], label[j])] = min(label[i], label[j])
    return [(nodes[mine[i]], nodes[mine[label[i]]]) for i in range(m) if label[i] != i]


def _compared(keyed: DataFrame, sets: DataFrame, groups: DataFrame, threshold: float, block: int) -> DataFrame:
    """Exact comparison inside proposed groups: rows ``a, n`` (linked documents) and ``a, b`` (forest edges).

    A group of more than ``block`` sets is cut into blocks by a hash, and every pair of blocks is a
    unit of work of its own, so no task gets a group whole.
    """
    sizes = groups.groupBy("root").agg(F.count("*").alias("total"))
    members = groups.join(sizes, "root").join(sets.select("node", "row", "weight", "size"), "node")
    members = stored(members.select("node", "root", "total", "weight", "size", "row.doc_id", "row.text_key"), "members")
    blocks = F.ceil(F.col("total") / block).cast("int")
    total = members.agg(F.sum(F.col("size") * 8 * blocks).alias("n")).first()["n"] or 0
    parts = max(1, total // TASK_BYTES)

    same = F.col("d.doc_id").eqNullSafe(F.col("m.doc_id")) & (F.col("d.text_key") == F.col("m.text_key"))
    wanted = keyed.filter(may_be_named(members, F.col("doc_id"), F.col("text_key")))
    texts = wanted.alias("d").join(members.alias("m"), same).select("node", "root", "total", "weight", "text")
    n = blocks
    own = F.pmod(F.xxhash64("node"), n).cast("int")
    other = F.transform(F.sequence(F.lit(0), n - 1), lambda x: F.struct(F.least(x, own).alias("low"), F.greatest(x, own).alias("high")))
    dealt = texts.select("node", "root", "weight", "text", own.alias("own"), F.explode(other).alias("work"))
    unit = F.xxhash64("root", "work.low", "work.high")
    dealt = dealt.select(F.pmod(unit, F.lit(parts)).alias("part"), unit.alias("unit"), "node", "weight", "text", (F.col("own") == F.col("work.low")).alias("left"), (F.col("own") == F.col("work.high")).alias("right"))
    return dealt.groupBy("part").applyInArrow(_compare(threshold), "a binary, b binary, n long")


def _gram_sets(texts: pa.ChunkedArray) -> list[np.ndarray]:
    """The shingles of each text."""
    return [grams[i:j] for chunk in texts.chunks for grams, first in shingle_sets(chunk) for i, j in zip(first[:-1], first[1:])]


def _compare(threshold: float) -> Callable[[pa.Table], pa.Table]:
    def run(table: pa.Table) -> pa.Table:
        unit, weight = table["unit"].to_numpy(), table["weight"].to_numpy()
        left, right = (np.array(table[c].to_pylist(), bool) for c in ("left", "right"))
        nodes, data = table["node"].to_pylist(), _gram_sets(table["text"])
        order = np.argsort(unit, kind="stable")
        cuts = np.flatnonzero(np.diff(unit[order]) != 0) + 1
        out: list[tuple[bytes, bytes | None, int | None]] = []
        for mine in np.split(order, cuts) if len(order) else ():
            once = {nodes[i]: i for i in mine.tolist()}  # repeated rows of one set count once
            mine = np.array(sorted(once.values(), key=lambda i: nodes[i]))
            sets = [data[i] for i in mine]
            linked = _linked(sets, left[mine], right[mine], threshold)
            count = linked @ weight[mine] if len(mine) else np.zeros(0)
            out += [(nodes[mine[i]], None, int(count[i])) for i in np.flatnonzero(count)]
            label = _labels(linked)
            out += [(nodes[mine[i]], nodes[mine[label[i]]], None) for i in np.flatnonzero(label != np.arange(len(mine)))]
        columns = list(zip(*out)) or [(), (), ()]
        return pa.table({"a": pa.array(columns[0], pa.binary()), "b": pa.array(columns[1], pa.binary()), "n": pa.array(columns[2], pa.int64())})

    return run


def _linked(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, threshold: float, width: int = 2048) -> np.ndarray:
    """Which sets are similar, of one block to the other or within one; by counts of common shingles."""
    m = len(sets)
    size = np.array([len(x) for x in sets])
    owner = np.repeat(np.arange(m), size)
    values, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = np.flatnonzero(times > 1)
    number = np.full(len(values), -1)
    number[shared] = np.arange(len(shared))
    keep = number[column] >= 0
    owner, column = owner[keep], number[column][keep]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    common = np.zeros((m, m))
    for low in range(0, len(shared), width):
        a, b = np.searchsorted(column, [low, low + width])
        part = np.zeros((m, min(width, len(shared) - low)), np.float32)
        part[owner[a:b], column[a:b] - low] = 1
        common += part @ part.T
    found = common >= threshold * (size[:, None] + size[None, :] - common)
    across = (left[:, None] & right[None, :]) | (right[:, None] & left[None, :])
    found &= across
    np.fill_diagonal(found, False)
    return found


def _labels(linked: np.ndarray) -> np.ndarray:
    """The least member of each member's component."""
    label = np.arange(len(linked))
    while True:
        near = np.where(linked, label[None, :], len(linked)).min(1, initial=len(linked))
        new = np.minimum(label, near)
        new = new[new]
        if (new == label).all():
            return label
        label = new
