"""Approximate nearest neighbours with a hierarchical k-means tree (operator 4).

1. Equal vectors are collapsed: of each distinct vector at most k + 1 smallest ids can be among
   any query's k nearest (ties go to smaller ids), so that copies neither crowd a leaf nor multiply work.
2. A tree of spherical k-means splits is fitted on a bounded sample and broadcast. Every
   distinct vector is then indexed: it descends to one leaf. Leaves that hold more than ``LEAF_ROWS`` are split by a fit on
   a bounded sample of their own, again and again while the tree is smaller than ``TREE_BYTES``: so leaves grow in number with the table.
3. Calibration: exact neighbours of a bounded sample of queries (one scan of all vectors in blocks) show how many
   leaves each needs in the best-bin-first order. The visits are the fewest that reach the target recall on one half
   of these queries, widened until the other half, which had no say, has it too.
4. Each query walks the tree best bin first (a priority queue of branches by similarity), visits that many
   leaves, and goes on where these hold fewer than k + 1 vectors. Leaves lie on pages of bounded size (small neighbours share one, large
   ones have several); a query goes once to each page of its leaves and is compared with its own leaves there; the k best of each page are
   merged. Similarity is the cosine in double precision on original vectors.

Edge cases: vectors that are null, empty, zero, or hold
null or non-finite components take no part (neither as queries); vectors are searched among those of their own length; equal scores go
to smaller ids, however many tie; repeated ids are each a candidate; null ids take no part. Only vec_id and embedding are read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import drop_stage, ship, stage, table

K, QUERY_EVERY = 5, 50
#: The tree is fitted on at most so many vectors; a split has BRANCH children, a leaf of the fit at most LEAF vectors.
SAMPLE, BRANCH, LEAF = 40_000, 8, 256
#: A leaf of more distinct vectors is split by a fit on about LEAF_SAMPLE of them, while the tree's centres have at most TREE_BYTES.
LEAF_ROWS, LEAF_SAMPLE, TREE_BYTES = 4096, 4096, 128 << 20
#: Calibration uses at most so many queries, half of them to test the visits; visits are the fewest that reach this recall.
PROBES, RECALL = 400, 0.93
#: Vectors that are compared at a time; pages have a 32nd of the vectors, but no fewer and no more than this.
BLOCK_ROWS, LEAST_PAGE, MOST_PAGE = 4096, 1024, 65536
#: Queries that a task walks, about.
WALK_ROWS = 256


@dataclass
class Tree:
    """Inner nodes: first child (children are consecutive); leaves: -1 and a leaf number."""

    centre: np.ndarray
    first: np.ndarray
    leaf: np.ndarray
    branch: np.ndarray

    @property
    def n_leaves(self) -> int:
        return int(self.leaf.max()) + 1

    def descend(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each (unit) vector."""
        node = np.zeros(len(x), np.int64)
        most = int(self.branch.max())
        todo = np.flatnonzero(self.first[node] >= 0)
        while len(todo):
            v = node[todo]
            child = self.first[v][:, None] + np.minimum(np.arange(most), self.branch[v][:, None] - 1)
            similar = np.einsum("ijk,ik->ij", self.centre[child], x[todo])
            node[todo] = self.first[v] + np.minimum(similar.argmax(1), self.branch[v] - 1)
            todo = todo[self.first[node[todo]] >= 0]
        return self.leaf[node]

    def bins(self, q: np.ndarray) -> Iterator[int]:
        """All leaves in best-bin-first order: branches not taken wait in a priority queue by their similarity."""
        queue = [(0.0, 0)]
        while queue:
            _, v = heapq.heappop(queue)
            while self.first[v] >= 0:
                a, n = int(self.first[v]), int(self.branch[v])
                similar = self.centre[a : a + n] @ q
                best = int(similar.argmax())
                for c, s in enumerate(similar.tolist()):
                    if c != best:
                        heapq.heappush(queue, (-s, a + c))
                v = a + best
            yield int(self.leaf[v])

    def best_bins(self, q: np.ndarray, visits: int, sizes: np.ndarray | None = None, least: int = 0) -> list[int]:
        """The first ``visits`` leaves, and more until their ``sizes`` add up to ``least``."""
        out, held = [], 0
        for leaf in self.bins(q):
            if len(out) >= visits and (sizes is None or held >= least):
                break
            out.append(leaf)
            held += 0 if sizes is None else int(sizes[leaf])
        return out

    def graft(self, parts: dict[int, Tree]) -> Tree:
        """This tree with leaves replaced by trees; their leaves get new numbers, those replaced are no longer used."""
        centre, first, leaf, branch = [self.centre], self.first.copy(), self.leaf.copy(), self.branch.copy()
        firsts, leaves, branches, n, n_leaves = [first], [leaf], [branch], len(first), self.n_leaves
        node_of = {int(x): v for v, x in enumerate(self.leaf) if x >= 0}
        for old, t in sorted(parts.items()):
            v = node_of[old]
            # The part's root takes the leaf's place; its other nodes follow, one place lower than they were.
            first[v], branch[v], leaf[v] = n, t.branch[0], -1
            centre.append(t.centre[1:])
            firsts.append(np.where(t.first[1:] >= 0, t.first[1:] + n - 1, -1))
            leaves.append(np.where(t.leaf[1:] >= 0, t.leaf[1:] + n_leaves, -1))
            branches.append(t.branch[1:])
            n += len(t.first) - 1
            n_leaves += t.n_leaves
        return Tree(np.concatenate(centre), np.concatenate(firsts), np.concatenate(leaves), np.concatenate(branches))


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def fit(x: np.ndarray, branch: int = BRANCH, leaf: int = LEAF, seed: int = 0, rounds: int = 8) -> Tree:
    """A tree of spherical k-means splits over unit vectors."""
    rng = np.random.default_rng(seed)
    centre, first, leaves, width = [x.mean(0) if len(x) else np.zeros(1)], [-1], [-1], [0]
    todo, n_leaves = [(0, np.arange(len(x)))], 0
    while todo:
        v, own = todo.pop(0)
        if len(own) > leaf:
            c = x[own[rng.choice(len(own), branch, replace=False)]]
            for _ in range(rounds):
                near = (x[own] @ c.T).argmax(1)
                used = np.unique(near)
                c = unit(np.stack([x[own[near == j]].sum(0) for j in used]) + 1e-12)
            near = (x[own] @ c.T).argmax(1)
            used = np.unique(near)
            if len(used) > 1:
                first[v], width[v] = len(centre), len(used)
                for j in used:
                    todo.append((len(centre), own[near == j]))
                    centre.append(c[j])
                    first.append(-1)
                    leaves.append(-1)
                    width.append(0)
                continue
        leaves[v] = n_leaves
        n_leaves += 1
    return Tree(np.stack(centre), np.array(first), np.array(leaves), np.array(width))


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and vector (doubles) of the rows that take part."""
    v = F.col("embedding").cast("array<double>")
    finite = ~F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    rows = vectors.where(F.col("vec_id").isNotNull()).select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("vector"))
    return rows.where(F.col("vector").isNotNull() & (F.size("vector") > 0) & finite & F.exists("vector", lambda x: x != 0))


def distinct_vectors(rows: DataFrame, k: int) -> DataFrame:
    """vector, its key and the k + 1 smallest ids that have it.

    Ids are cut to k + 1 in salted groups before they meet, so that a vector shared by many rows gathers no long list.
    """
    keyed = rows.withColumn("key", F.xxhash64("vector")).withColumn("salt", F.pmod(F.xxhash64("vec_id"), F.lit(32)))
    low = Window.partitionBy("key", "vector", "salt").orderBy("vec_id")
    few = keyed.withColumn("n", F.row_number().over(low)).where(F.col("n") <= k + 1)
    return few.groupBy("key", "vector").agg(F.slice(F.array_sort(F.collect_list("vec_id")), 1, k + 1).alias("ids"))


def matrix(column: pd.Series, width: int) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64) if len(column) else np.zeros((0, width))


def cosines(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Cosine of q with each row, in an order of operations that depends on nothing but the two vectors."""
    return (x * q).sum(1) / (np.sqrt((x * x).sum(1)) * np.sqrt((q * q).sum()))


def best_of(q: np.ndarray, rough: np.ndarray, x: np.ndarray, first_ids: np.ndarray, k: int, at: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Positions and exact cosines of the k vectors nearest to q among those ``at``, by cosine, then id.

    All that may tie at the cut of the rough cosines are measured exactly.
    """
    at = np.arange(len(x)) if at is None else at
    if len(at) > k:
        at = at[rough >= np.partition(rough, len(at) - k)[len(at) - k] - 1e-12]
    exact = cosines(q, x[at])
    order = np.lexsort((first_ids[at], -exact))[:k]
    return at[order], exact[order]


def nearest_in(q_key: np.ndarray, q_vec: np.ndarray, x: np.ndarray, ids: list, k: int) -> list[tuple]:
    """Rows (query key, score, ids) of the k + 1 best distinct vectors of a block for each query vector."""
    scores = unit(q_vec) @ unit(x).T
    first_ids = np.array([i[0] for i in ids], np.int64)
    rows = []
    for j in range(len(q_vec)):
        at, exact = best_of(q_vec[j], scores[j], x, first_ids, k + 1)
        rows += [(q_key[j], s, ids[i]) for i, s in zip(at.tolist(), exact.tolist(), strict=True)]
    return rows


def merge(found: DataFrame, k: int) -> DataFrame:
    """The k + 1 best distinct vectors of each query vector."""
    best = Window.partitionBy("query").orderBy(F.desc("score"), F.element_at("ids", 1))
    return found.withColumn("n", F.row_number().over(best)).where(F.col("n") <= k + 1).drop("n")


FOUND = "query long, score double, ids array<long>"


def exact_search(index: DataFrame, q_key: np.ndarray, q_vec: np.ndarray, k: int) -> DataFrame:
    """Exact neighbours of a bounded block of query vectors, by a scan of all vectors."""
    shared = index.sparkSession.sparkContext.broadcast((q_key, q_vec))

    def scan(frames):
        key, q = shared.value
        kept = None
        for f in frames:
            for a in range(0, len(f), BLOCK_ROWS):
                part = f.iloc[a : a + BLOCK_ROWS]
                got = pd.DataFrame(nearest_in(key, q, matrix(part.vector, q.shape[1]), part.ids.tolist(), k), columns=["query", "score", "ids"])
                both = got if kept is None else pd.concat([kept, got])
                both = both.assign(low=both.ids.str[0]).sort_values(["query", "score", "low"], ascending=[True, False, True])
                kept = both.groupby("query").head(k + 1)[["query", "score", "ids"]]
        if kept is not None:
            yield kept

    return merge(index.select("vector", "ids", "key").mapInPandas(scan, FOUND), k)


def calibrate(tree: Tree, index: DataFrame, q_key: np.ndarray, q_vec: np.ndarray, k: int, recall: float) -> int:
    """The fewest leaf visits that reach ``recall`` on every second of these queries, widened until the others have it too."""
    truth = exact_search(index, q_key, q_vec, k)
    leaf_of = index.select(F.element_at("ids", 1).alias("low"), "leaf", "key")
    # A query's own vector is found in any case and says nothing.
    wanted = truth.select("query", F.element_at("ids", 1).alias("low")).join(leaf_of, "low").where(F.col("key") != F.col("query")).select("query", "leaf").toPandas()
    vectors = dict(zip(q_key.tolist(), unit(q_vec), strict=True))
    asked = [(int(q), g["leaf"].tolist(), vectors[q].tolist(), i % 2) for i, (q, g) in enumerate(wanted.groupby("query"))]
    if not asked:
        return 1
    spark = index.sparkSession
    shared = spark.sparkContext.broadcast(tree)

    def places(frames):
        for f in frames:
            rows = []
            for leaves, v, half in zip(f["leaves"], f["vector"], f["half"], strict=True):
                open_, q = set(leaves), np.array(v)
                for place, leaf in enumerate(shared.value.bins(q), 1):
                    if leaf in open_:
                        rows += [(half, place)] * list(leaves).count(leaf)
                        open_.discard(leaf)
                        if not open_:
                            break
            yield pd.DataFrame(rows, columns=["half", "place"])

    kind = "query long, leaves array<long>, vector array<double>, half int"
    need = spark.createDataFrame(asked, kind).repartition(min(len(asked), spark.sparkContext.defaultParallelism), "query").mapInPandas(places, "half int, place long").toPandas()

    def fewest(places_: np.ndarray) -> int:
        return int(np.sort(places_)[max(0, int(np.ceil(recall * len(places_))) - 1)])

    visits = fewest(need.place[need.half == 0].to_numpy())
    other = need.place[need.half == 1].to_numpy()
    while len(other) and (other <= visits).mean() < recall:
        visits += max(1, visits // 16)
    return visits


def pages(sizes: np.ndarray, rows: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """First page and number of pages of each leaf: small leaves next to each other share a page, large ones have several."""
    rows = rows or min(MOST_PAGE, max(LEAST_PAGE, int(sizes.sum()) // 32))
    first, blocks = np.zeros(len(sizes), np.int64), np.ones(len(sizes), np.int64)
    page = room = 0
    for leaf, n in enumerate(sizes.tolist()):
        if n > room:
            blocks[leaf] = max(1, -(-n // rows))
            first[leaf], page = page, page + int(blocks[leaf])
            room = 0 if blocks[leaf] > 1 else rows - n
        else:
            first[leaf] = max(0, page - 1)
            room -= n
    return first, blocks


def leaf_sizes(index: DataFrame, tree: Tree) -> np.ndarray:
    """Distinct vectors of each leaf: one small row for each leaf, whose number TREE_BYTES bounds."""
    out = np.zeros(tree.n_leaves, np.int64)
    for r in index.groupBy("leaf").agg(F.count("*").alias("n")).collect():
        out[r.leaf] = r.n
    return out


def indexed(plain: DataFrame, tree: Tree, width: int) -> DataFrame:
    shared = plain.sparkSession.sparkContext.broadcast(tree)

    def descend(frames):
        for f in frames:
            for a in range(0, len(f), BLOCK_ROWS):
                part = f.iloc[a : a + BLOCK_ROWS]
                yield part.assign(leaf=shared.value.descend(unit(matrix(part.vector, width))))[["key", "vector", "ids", "leaf"]]

    return stage(plain.select("key", "vector", "ids").mapInPandas(descend, "key long, vector array<double>, ids array<long>, leaf long"), "leaves")


def grow(tree: Tree, index: DataFrame, width: int, leaf_rows: int, leaf_sample: int, tree_bytes: int) -> tuple[Tree, DataFrame, np.ndarray]:
    """The tree with its large leaves split, the index of its leaves, and their sizes."""
    spark, whole = index.sparkSession, set()
    while True:
        sizes = leaf_sizes(index, tree)
        large = {leaf: int(sizes[leaf]) for leaf in np.flatnonzero(sizes > leaf_rows).tolist() if leaf not in whole}
        room = tree_bytes // (8 * width) - len(tree.first)
        # About so many nodes will a split add; the largest leaves come first while there is room.
        parts = {}
        for leaf, n in sorted(large.items(), key=lambda x: (-x[1], x[0])):
            more = min(leaf_sample // 8, 4 * -(-n // leaf_rows))
            if room < 2 * more:
                break
            parts[leaf], room = (n, more), room - 2 * more
        if not parts:
            return tree, index, sizes
        shares = spark.createDataFrame([(leaf, min(1.0, leaf_sample / n), more) for leaf, (n, more) in parts.items()], "leaf long, share double, parts int")
        drawn = index.join(F.broadcast(shares), "leaf").where(F.pmod(F.xxhash64("key", F.lit(3)), F.lit(1 << 20)) < F.col("share") * (1 << 20))

        def split(key, f):
            t = fit(unit(matrix(f.vector, width)), leaf=max(8, len(f) // int(f.parts.iloc[0])))
            return pd.DataFrame({"leaf": [key[0]], "centre": [t.centre.ravel()], "first": [t.first], "of": [t.leaf], "branch": [t.branch]})

        found = drawn.select("leaf", "vector", "parts").groupBy("leaf").applyInPandas(split, "leaf long, centre array<double>, first array<long>, of array<long>, branch array<long>").collect()
        grown = {r.leaf: Tree(np.array(r.centre).reshape(-1, width), np.array(r["first"]), np.array(r.of), np.array(r.branch)) for r in found}
        # A leaf whose vectors no split parts stays as it is.
        whole |= set(parts) - {leaf for leaf, t in grown.items() if t.n_leaves > 1}
        grown = {leaf: t for leaf, t in grown.items() if t.n_leaves > 1}
        if grown:
            tree = tree.graft(grown)
            before, index = index, indexed(index, tree, width)
            drop_stage(before)


def search(vectors: DataFrame, is_query, k: int = K, sample: int = SAMPLE, probes: int = PROBES, recall: float = RECALL, **more) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of each row that ``is_query`` selects by vec_id.

    ``more``: leaf (of the fit), leaf_rows, leaf_sample, tree_bytes, page_rows.
    """
    ship(vectors.sparkSession)
    rows = usable(vectors)
    widths = [r.d for r in rows.groupBy(F.size("vector").alias("d")).count().orderBy("d").collect()]
    found = [_search(rows.where(F.size("vector") == d), d, is_query, k, sample, probes, recall, **more) for d in widths]
    found = [x for x in found if x is not None]
    return reduce(DataFrame.unionByName, found) if found else vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")


def _search(
    rows: DataFrame, width: int, is_query, k: int, sample: int, probes: int, recall: float, leaf: int = LEAF, leaf_rows: int = LEAF_ROWS,
    leaf_sample: int = LEAF_SAMPLE, tree_bytes: int = TREE_BYTES, page_rows: int | None = None,
) -> DataFrame | None:
    """:func:`search` among vectors of one length; None without queries."""
    spark = rows.sparkSession
    asked = rows.where(is_query(F.col("vec_id"))).select("vec_id", F.xxhash64("vector").alias("query"), "vector")
    queries = stage(asked.groupBy("query", "vector").agg(F.count("*").alias("n")).select("query", "vector"), "queries")
    n_queries = queries.count()
    if not n_queries:
        drop_stage(queries)
        return None
    plain = stage(distinct_vectors(rows, k), "vectors")
    drawn = plain.select("vector", F.xxhash64("key").alias("o")).orderBy("o").limit(sample).select("vector").toPandas()
    tree = fit(unit(matrix(drawn.vector, width)), leaf=leaf)
    index = indexed(plain, tree, width)
    drop_stage(plain)
    tree, index, sizes = grow(tree, index, width, leaf_rows, leaf_sample, tree_bytes)
    trial = queries.orderBy(F.xxhash64("query"), "query").limit(probes).toPandas()
    visits = calibrate(tree, index, trial["query"].to_numpy(), matrix(trial.vector, width), k, recall)

    shared = spark.sparkContext.broadcast((tree, sizes, *pages(sizes, page_rows)))

    def store(frames):
        _, _, first, blocks = shared.value
        for f in frames:
            leaf = f.leaf.to_numpy()
            yield f.assign(page=first[leaf] + f.key.to_numpy() % blocks[leaf], query=0, asks=False, leaves=[[x] for x in leaf.tolist()])[["page", "asks", "query", "vector", "ids", "leaves"]]

    def walk(frames):
        tree, sizes, first, blocks = shared.value
        for f in frames:
            for a in range(0, len(f), WALK_ROWS):
                part, to, which, own = f.iloc[a : a + WALK_ROWS], [], [], []
                for i, v in enumerate(unit(matrix(part.vector, width))):
                    by_page: dict[int, list[int]] = {}
                    for x in tree.best_bins(v, visits, sizes, k + 1):
                        for page in range(first[x], first[x] + blocks[x]) if sizes[x] else ():
                            by_page.setdefault(int(page), []).append(x)
                    to += by_page
                    own += by_page.values()
                    which += [i] * len(by_page)
                rows = part.iloc[which]
                yield rows.assign(page=to, asks=True, ids=[[]] * len(rows), leaves=own)[["page", "asks", "query", "vector", "ids", "leaves"]]

    kinds = "page long, asks boolean, query long, vector array<double>, ids array<long>, leaves array<long>"
    n_tasks = max(spark.sparkContext.defaultParallelism, n_queries // WALK_ROWS)
    sent = queries.repartition(n_tasks, "query").mapInPandas(walk, kinds)
    # A page's vectors come before the queries sent to it; queries are answered batch by batch.
    dealt = index.mapInPandas(store, kinds).unionByName(sent).repartition("page").sortWithinPartitions("page", "asks")

    def answer(frames):
        here, held, ready = None, [], None
        for f in frames:
            for (page, asks), at in sorted(f.groupby(["page", "asks"]).indices.items()):
                part = f.iloc[at]
                if page != here:
                    here, held, ready = page, [], None
                if not asks:
                    held.append((matrix(part.vector, width), part.ids.tolist(), [x[0] for x in part.leaves]))
                    continue
                if ready is None:  # the page's vectors by leaf
                    of = np.concatenate([np.array(x, np.int64) for *_, x in held]) if held else np.zeros(0, np.int64)
                    order = np.argsort(of, kind="stable")
                    x = np.concatenate([x for x, *_ in held])[order] if held else np.zeros((0, width))
                    ids = [i for _, own, _ in held for i in own]
                    ids, of, held = [ids[i] for i in order], of[order], []
                    ready = x, unit(x), ids, np.array([i[0] for i in ids], np.int64), *np.unique(of, return_inverse=True)
                x, ux, ids, first_ids, here_leaves, of = ready
                for a in range(0, len(part), WALK_ROWS):
                    some, out = part.iloc[a : a + WALK_ROWS], []
                    asking = matrix(some.vector, width)
                    uq = unit(asking)
                    visited = np.zeros((len(some), len(here_leaves)), bool)
                    for i, leaves in enumerate(some.leaves):
                        visited[i] = np.isin(here_leaves, leaves)
                    # Where queries want much of the page, one product serves them all; each is held to its own leaves in any case.
                    whole = uq @ ux.T if len(here_leaves) and visited.mean() > 0.1 else None
                    for i, key in enumerate(some["query"]):
                        own = np.flatnonzero(visited[i][of])
                        if len(own):
                            rough = ux[own] @ uq[i] if whole is None else whole[i][own]
                            best, exact = best_of(asking[i], rough, x, first_ids, k + 1, own)
                            out += [(key, s, ids[j]) for j, s in zip(best.tolist(), exact.tolist(), strict=True)]
                    yield pd.DataFrame(out, columns=["query", "score", "ids"])

    found = merge(dealt.mapInPandas(answer, FOUND), k)
    rows_out = asked.select(F.col("vec_id").alias("query_id"), "query").join(found, "query").withColumn("vec_id", F.explode("ids")).where(F.col("vec_id") != F.col("query_id"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return rows_out.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op4_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings"), lambda c: c % QUERY_EVERY == 0)
