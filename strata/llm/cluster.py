"""Connected components and block-wise verification of candidate clusters.

Both near-duplicate operators reduce candidates to clusters (components of a cheap superset of the links) and
then verify pairs inside a cluster. A cluster beyond ``block`` members is cut into blocks, so no task gets more
than two blocks of it:

1. one hub block is compared with every block: rows in proportion to the members;
2. members that the links found so far don't join to the cluster's largest component are compared with all of it.

Every pair with different components after step 1 has such a member, so no link between components is lost, and
a family of near copies costs its members times a block instead of all its pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import (
    broadcast_if_small, checkpointed, distinct, keep, lean, lean_group, mix, needed, shuffles_dropped)

BLOCK = 512
#: Edges of one task of ``connected_components``, at least.
EDGES = 50_000
#: Matches that ``links_of_tasks`` asks for beyond one, as a share of a set.
MATCHES = 0.1
#: Shared members counted at a time, bytes of items hashed at a time, rows of tasks compared at a time.
HITS, PIECE, ROWS = 1 << 20, 1 << 16, 1024
#: Rows of one call of the verification, or bytes of items: it takes many small clusters together.
BATCH, AT_ONCE = 1000, 1 << 19


def _large_star(e: DataFrame) -> DataFrame:
    both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))  # distinct comes later


def _small_star(e: DataFrame) -> DataFrame:
    low = e.groupBy("a").agg(F.min("b").alias("m"))
    rest = e.join(low, "a").filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return rest.unionByName(low.select("a", F.col("m").alias("b"))).distinct()


def spanning(edges: DataFrame) -> DataFrame:
    """Fewer edges (columns ``a``, ``b``) with the same components: of each partition's edges a spanning forest."""
    def forest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while (up := parent.setdefault(x, x)) != x:
                parent[x] = parent[up]
                x = up
            return x

        for pdf in batches:
            out = []
            for a, b in zip(pdf["a"].tolist(), pdf["b"].tolist(), strict=True):
                x, y = root(a), root(b)
                if x != y:
                    parent[max(x, y)] = min(x, y)
                    out.append((a, b))
                elif a == b:
                    out.append((a, b))
            yield pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return edges.select("a", "b").mapInPandas(lean(forest), "a long, b long")


def connected_components(edges: DataFrame) -> DataFrame:
    """``node``, ``component`` (smallest node of it) for every node of ``edges`` (columns ``a``, ``b``, long).

    Alternates large-star and small-star (Kiveris et al.) until the edges are stars; each round is checkpointed
    to the shared folder, in tasks (and files) whose number follows the edges. Loops and repeated edges are allowed; a
    node with loops only is its own component.
    """
    edges = checkpointed(spanning(edges))
    nodes = edges.filter("a = b").select(F.col("a").alias("node"))
    few = lambda d, n: checkpointed(d.coalesce(1 + n // EDGES))

    def state(d: DataFrame) -> tuple:
        with shuffles_dropped(d.sparkSession):
            return d.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    e = few(edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), edges.count())
    before = state(e)
    while before[0]:
        e = few(_small_star(_large_star(e)), before[0])
        now = state(e)
        if now == before:
            break
        before = now
    found = e.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    loops = nodes.distinct().join(found.select("node").union(roots.select("node")), "node", "left_anti")
    return found.unionByName(roots).unionByName(loops.select("node", F.col("node").alias("component")))


def links_of_cluster(node: np.ndarray, side: np.ndarray, need: np.ndarray, sets: list, prefixes: list,
                     percent: int, known: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links of one cluster (or of two of its blocks) that join components: side 0 against itself and side 1.

    Two similar sets (sorted arrays) share at least the smaller of their ``need`` values among their prefixes; only such
    pairs, of sizes that allow the similarity, are compared exactly (100 * shared >= percent * union). Pairs that
    links found before already join are passed over, and so are those with the same ``known`` component.
    """
    size = np.array([len(t) for t in sets])
    parent = list(range(len(node)))
    if known is not None:
        _, leader, which = np.unique(known, return_index=True, return_inverse=True)
        parent = leader[which].tolist()

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []

    def compare(i: int, j: int) -> None:
        a, b = root(i), root(j)
        if a == b:
            return
        few, many = (sets[i], sets[j]) if size[i] <= size[j] else (sets[j], sets[i])
        both = int(np.count_nonzero(many[np.minimum(np.searchsorted(many, few), len(many) - 1)] == few)) if len(few) else 0
        if 100 * both >= percent * (int(size[i]) + int(size[j]) - both):
            parent[max(a, b)] = min(a, b)
            out.append((int(node[i]), int(node[j])))

    if len(node) <= 4:  # too few for an index
        for i in range(len(node)):
            for j in range(i):
                if (side[i] == 0 or side[j] == 0) and 100 * min(size[i], size[j]) >= percent * max(size[i], size[j]):
                    compare(i, j)
        return out
    owner = np.repeat(np.arange(len(node)), [len(p) for p in prefixes])
    values, where = np.unique(np.concatenate(prefixes), return_inverse=True)
    order = np.argsort(where, kind="stable")
    posting, first = owner[order], np.concatenate([[0], np.cumsum(np.bincount(where, minlength=len(values)))])
    starts = np.concatenate([[0], np.cumsum([len(p) for p in prefixes])])
    label = np.array(parent)  # roots, brought up to date after each document
    for i in np.flatnonzero(side == 0):
        mine = where[starts[i]:starts[i + 1]]
        hits = np.concatenate([posting[first[v]:first[v + 1]] for v in mine]) if len(mine) else mine
        shared = np.bincount(hits, minlength=len(node))
        other = np.flatnonzero((shared >= np.minimum(need, need[i])) & (shared > 0) & (label != label[i])
                               & (100 * np.minimum(size, size[i]) >= percent * np.maximum(size, size[i])))
        found = len(out)
        for j in other[np.argsort(-shared[other], kind="stable")]:
            compare(int(i), int(j))
        if len(out) > found:
            label = np.array([root(x) for x in range(len(node))])
    return out


def _joined(least: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least member of each one's component (``least`` so far) after ``a`` and ``b`` are joined, too."""
    while (apart := least[a] != least[b]).any():
        a, b = a[apart], b[apart]
        now, low = least.copy(), np.minimum(least[a], least[b])
        for root in (least[a], least[b]):  # only these move: the others follow
            np.minimum.at(now, root, low)
        while (now[now] != now).any():
            now = now[now]
        least = now
    return least


def links_of_tasks(node: np.ndarray, task: np.ndarray, side: np.ndarray, known: np.ndarray, items: list[bytes],
                   percent: int, hashes: Callable) -> list[tuple[int, int]]:
    """``links_of_cluster`` for some tasks (numbers ``task``) of up to 2 ** 16 rows, all at once.

    The prefixes hold a set's rarest members here and ask for ``MATCHES`` of it. Similar pairs join their ``known``
    components; each of these but the least one that it is joined with is linked with that one. Hashes count by 48
    bits, as in ``keyed_sets``, with the task mixed in.
    """
    n = len(node)
    weight, keys = np.cumsum([len(x) for x in items]) // PIECE, []
    for mine in np.split(np.arange(n), np.flatnonzero(np.diff(weight)) + 1):
        h, owner = hashes([items[k] for k in mine])
        row = mine[owner]
        keys.append(distinct(((h ^ mix(task[row])) >> np.uint64(16) << np.uint64(16)) | row.astype(np.uint64)))
    keys = np.sort(np.concatenate(keys))
    owner = keys & np.uint64(0xFFFF)
    size = np.bincount(owner.astype(np.int64), minlength=n)
    first = np.cumsum(size) - size
    new = np.append(True, keys[1:] >> np.uint64(16) != keys[:-1] >> np.uint64(16))
    many = np.diff(np.append(np.flatnonzero(new), len(keys)))
    rare = np.minimum(np.repeat(many, many), 0xFFFF).astype(np.uint64)
    ordered = np.sort((owner << np.uint64(48)) | (rare << np.uint64(32)) | np.arange(len(keys), dtype=np.uint64))
    need = (1 + MATCHES * size).astype(np.int64)
    within = np.arange(len(keys)) - np.repeat(first, size)
    taken = ordered[within < np.repeat(prefix_length(size, percent, need), size)] & np.uint64(0xFFFFFFFF)
    taken = np.sort(taken).astype(np.int64)
    owner, value = owner[taken].astype(np.int64), keys[taken] >> np.uint64(16)
    start = np.flatnonzero(np.append(True, value[1:] != value[:-1]))
    many = np.diff(np.append(start, len(value)))
    start, hits = np.repeat(start, many), np.repeat(many, many)
    asking, place = np.flatnonzero(side == 0), np.cumsum(side == 0) - 1
    asks = np.flatnonzero((hits > 1) & (side[owner] == 0))
    shared = np.zeros(len(asking) * n, dtype=np.int32)
    total = np.cumsum(hits[asks])
    cut = np.searchsorted(total, np.arange(HITS, total[-1], HITS)) if len(total) else []
    for mine in np.split(asks, cut):
        k = hits[mine]
        at = np.arange(int(k.sum())) + np.repeat(start[mine] - (np.cumsum(k) - k), k)
        shared += np.bincount(np.repeat(place[owner[mine]] * n, k) + owner[at], minlength=len(shared)).astype(np.int32)
    pairs = np.flatnonzero(shared)
    x, y = np.divmod(pairs, n)
    x = asking[x]
    maybe = ((shared[pairs] >= np.minimum(need[x], need[y])) & (task[x] == task[y]) & (known[x] != known[y])
             & ((x < y) | (side[y] != 0)))
    x, y, score = x[maybe], y[maybe], shared[pairs][maybe] / need[x[maybe]]
    x, y = x[np.argsort(-score, kind="stable")], y[np.argsort(-score, kind="stable")]
    keys = np.sort((keys << np.uint64(48)) | (keys >> np.uint64(16)))
    _, lead, group = np.unique(np.stack([task, known.view(np.uint64)], axis=1), axis=0, return_index=True, return_inverse=True)
    least = np.arange(len(lead))
    while len(x):  # the likeliest pairs first: what they join isn't compared again
        now = 1 + int(np.searchsorted(np.cumsum(np.minimum(size[x], size[y])), HITS // 4))
        good = similar_pairs(keys, size, x[:now], y[:now], percent)
        least = _joined(least, group[x[:now][good]], group[y[:now][good]])
        apart = least[group[x[now:]]] != least[group[y[now:]]]
        x, y = x[now:][apart], y[now:][apart]
    moved = np.flatnonzero(least != np.arange(len(least)))
    return list(zip(node[lead[moved]].tolist(), node[lead[least[moved]]].tolist(), strict=True))


def _link(tasks: DataFrame, keys: list[str], percent: int, unpacked: Callable | None, rows: int,
          hashes: Callable | None = None) -> DataFrame:
    """Links of all tasks (rows of equal ``keys``): ``node``, ``side``, ``known``, ``item`` (bytes) and ``need``, where
    ``unpacked(items, needs)`` gives the distinct hashes of each set, sorted, and of each prefix. With ``hashes`` (see
    ``linked_stars``) whole sets are compared instead."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values([*keys, "side", "node"], kind="stable").drop_duplicates([*keys, "node"])
        new = (pdf[keys] != pdf[keys].shift()).any(axis=1).to_numpy()
        cut = np.flatnonzero(new)
        node, side, need, known = (pdf[c].to_numpy() for c in ("node", "side", "need", "known"))
        item = pdf["item"].to_numpy()
        ends = [*cut[1:], len(pdf)]
        out = []
        if hashes is not None:
            task = (np.cumsum(new) - 1).astype(np.uint64)
            start = 0
            for a, b in zip(cut, ends, strict=True):
                if b == len(pdf) or ends[int(task[a]) + 1] - start > ROWS:
                    out += links_of_tasks(node[start:b], task[start:b], side[start:b], known[start:b], list(item[start:b]),
                                          percent, hashes)
                    start = b
        else:
            for a, b in zip(cut, ends, strict=True):
                if b - a > 1:
                    sets, prefixes = unpacked(list(item[a:b]), need[a:b])
                    out += links_of_cluster(node[a:b], side[a:b], need[a:b], sets, prefixes, percent, known[a:b])
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    together = F.pmod(F.xxhash64(*keys), F.lit(max(1, rows // BATCH)))
    return tasks.withColumn("together", together).groupBy("together").applyInPandas(lean_group(run), "a long, b long")


def keyed_sets(h: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (owner, hash) as one sorted array of 64 bits (48 of them the hash's), and how many each owner has.

    ``owner`` is below 2 ** 16. Two hashes of one owner that agree in 48 bits count as one: for sets of up to
    10 ** 5 hashes that happens once in 10 ** 4 sets.
    """
    keys = distinct((owner.astype(np.uint64) << np.uint64(48)) | (h >> np.uint64(16)))
    return keys, np.bincount((keys >> np.uint64(48)).astype(np.int64), minlength=n)


def similar_pairs(keys: np.ndarray, size: np.ndarray, a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Whether the sets ``a[k]`` and ``b[k]`` of ``keyed_sets`` are similar (100 * shared >= percent * union), all at once."""
    first = np.cumsum(size) - size
    small, large = np.where(size[a] <= size[b], a, b), np.where(size[a] <= size[b], b, a)
    ok = 100 * size[small] >= percent * size[large]
    pair = np.repeat(np.flatnonzero(ok), size[small][ok])
    within = np.arange(len(pair)) - np.repeat(np.cumsum(size[small][ok]) - size[small][ok], size[small][ok])
    mask = np.uint64((1 << 48) - 1)
    wanted = (large[pair].astype(np.uint64) << np.uint64(48)) | (keys[first[small][pair] + within] & mask)
    hit = keys[np.minimum(np.searchsorted(keys, wanted), max(len(keys) - 1, 0))] == wanted if len(keys) else np.zeros(0, dtype=bool)
    shared = np.bincount(pair[hit], minlength=len(a))
    return ok & (100 * shared >= percent * (size[a] + size[b] - shared)) & (size[small] > 0)


def linked_stars(edges: DataFrame, items: DataFrame, percent: int, hashes: Callable) -> DataFrame:
    """Those of ``edges`` (distinct ``a``, ``b``) whose ``items`` (``node``, ``item``: bytes) are similar.

    All pairs of a center ``a`` are compared with one copy of it a task: a hot center is dealt to as many tasks as it
    has ``BLOCK``s of partners. Tasks take many centers together, ``AT_ONCE`` bytes on average. ``hashes(list of items)``
    gives the hashes of their sets' members and the place of each one's item.
    """
    weighed = edges.join(items.withColumnRenamed("node", "b"), "b")
    ways = edges.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / F.lit(BLOCK)).cast("long").alias("ways"))
    ways = broadcast_if_small(keep(ways.filter("ways > 1"), "ways"))
    members = (weighed.join(ways, "a", "left").withColumn("part", F.pmod(F.xxhash64(F.lit(7), "b"), F.coalesce("ways", F.lit(1).cast("long"))))
               .select("a", "part", F.lit(False).alias("lead"), F.col("b").alias("node"), "item"))
    centers = (edges.select("a").distinct().join(ways, "a", "left")
               .withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("ways", F.lit(1).cast("long")) - 1)))
               .join(items.withColumnRenamed("node", "a"), "a").select("a", "part", F.lit(True).alias("lead"), F.col("a").alias("node"), "item"))
    size = items.agg(F.sum(F.octet_length("item").cast("long")).alias("bytes"), F.count(F.lit(1)).alias("n")).first()
    average = (size.bytes or 0) / max(1, size.n)
    groups = max(1, int(edges.count() * 1.5 * (average + 16)) // AT_ONCE)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["a", "part"], kind="stable")
        lead = pdf["lead"].to_numpy(dtype=bool)
        star = np.cumsum((pdf[["a", "part"]] != pdf[["a", "part"]].shift()).any(axis=1).to_numpy()) - 1
        center = np.full(star[-1] + 1 if len(star) else 0, -1)
        center[star[lead]] = np.flatnonzero(lead)
        out = []
        for at in range(0, len(pdf), 1 << 15):  # places of a call fit 16 bits: members, then their centers
            mine = np.arange(at, min(at + (1 << 15), len(pdf)))
            mine = mine[~lead[mine] & (center[star[mine]] >= 0)]
            if not len(mine):
                continue
            used, which = np.unique(center[star[mine]], return_inverse=True)
            every = np.concatenate([mine, used])
            keys, n = keyed_sets(*hashes(pdf["item"].iloc[every].tolist()), len(every))
            good = similar_pairs(keys, n, len(mine) + which, np.arange(len(mine)), percent)
            out.append(pdf.iloc[mine[good]][["a", "node"]])
        found = pd.concat(out) if out else pd.DataFrame({"a": [], "node": []})
        return pd.DataFrame({"a": found["a"].to_numpy(dtype="int64"), "b": found["node"].to_numpy(dtype="int64")})

    both = members.unionByName(centers).withColumn("together", F.pmod(F.xxhash64("a", "part"), F.lit(groups)))
    return both.groupBy("together").applyInPandas(lean_group(run), "a long, b long")


def _ways(column: str, n) -> F.Column:
    return F.pmod(F.xxhash64(F.lit(7), F.col(column)), n)


def verified_components(clusters: DataFrame, items: Callable[[DataFrame], DataFrame], percent: int,
                        unpacked: Callable | None, block: int = BLOCK, links: DataFrame | None = None, *,
                        hashes: Callable | None = None) -> DataFrame:
    """``node``, ``component`` for the members of ``clusters`` (``node``, ``cluster``) that have verified links.

    ``items`` gets members (with further columns of ``clusters``) and returns them with ``item`` and ``need``, as
    ``_link`` takes them, with ``unpacked`` or ``hashes``. Nodes without links don't appear. ``links`` (``a``, ``b``) are verified already; with them
    ``clusters`` has their components as ``known``, and pairs inside of those aren't compared.
    """
    before, clusters = links, clusters if links is not None else clusters.withColumn("known", F.col("node"))
    sized = clusters.groupBy("cluster").agg(F.count(F.lit(1)).alias("m")).filter("m > 1")
    members = clusters.join(sized, "cluster").withColumn("blocks", F.ceil(F.col("m") / F.lit(block)).cast("long"))
    members = broadcast_if_small(keep(members, "members"))
    full = keep(items(members).withColumn("block", _ways("node", F.col("blocks"))), "items")
    weight = full.agg(F.sum(F.octet_length("item").cast("long"))).first()[0] or 0
    calls = max(full.count(), weight * BATCH // AT_ONCE)  # in rows of a batch
    hub = F.col("block") == 0
    tasks = full.withColumn("task", F.explode(F.when(hub, F.sequence(F.lit(0), F.col("blocks") - 1))
                                              .otherwise(F.array("block"))))
    tasks = tasks.withColumn("side", F.when(hub, 0).otherwise(1))
    columns = ["side", "node", "known", "item", "need"]
    links = checkpointed(_link(tasks.select("cluster", "task", *columns), ["cluster", "task"], percent, unpacked, calls, hashes))
    if before is not None:
        links = links.unionByName(before)
    cut = full.filter("blocks > 1")
    if cut.isEmpty():
        return connected_components(links)
    found = checkpointed(connected_components(links))
    large = (checkpointed(cut.select("cluster", "node", "blocks")).join(found, "node", "left")
             .withColumn("component", F.coalesce("component", "node")))
    main = (large.groupBy("cluster", "component").agg(F.count(F.lit(1)).alias("k"))
            .groupBy("cluster").agg(F.max_by("component", F.struct("k", "component")).alias("main")))
    apart = checkpointed(large.join(main, "cluster").filter("component != main").select("node", "cluster"))
    count = apart.groupBy("cluster").agg(F.ceil(F.count(F.lit(1)) / F.lit(block)).cast("long").alias("parts"))
    left = (cut.join(apart.select("node"), "node", "left_semi").join(count, "cluster")
            .withColumn("part", _ways("node", F.col("parts")))
            .withColumn("task", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumn("side", F.lit(0)))
    right = (cut.join(count, "cluster").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
             .withColumn("task", F.col("block")).withColumn("side", F.lit(1)))
    keys = ["cluster", "part", "task"]
    both = left.select(*keys, *columns).unionByName(right.select(*keys, *columns))
    more = _link(both, keys, percent, unpacked, 2 * calls, hashes)
    return connected_components(links.unionByName(checkpointed(more)))


def prefix_length(n, percent: int, need=1):
    """Tokens among which a set of ``n`` shares at least ``need`` with any similar set."""
    return np.minimum(n, n - needed(n, percent) + need)
