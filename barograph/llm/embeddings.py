"""Near-duplicate vectors by a flat graph.

Vectors alike in label and components form one class, with its smallest id. Classes are dealt to overlapping cells: every
vector is at home in the cell of its nearest centre and a visitor of other cells whose centre is almost as near, ``CELLS`` at
most. A cell is cut at random into shards. In each shard a graph is built: every vector is linked to near ones by robust
pruning, and to a few at random. The adjacency lists of all shards are united. Then the vectors at home in a cell search its
shards: a greedy best-first search from the shard's medoids, which goes on as long as it meets vectors in range. What it
finds is verified in double precision.

One task holds two shards of a cell and searches each from the other, so its size is bounded however many vectors lie close
together. Of every pair of vectors one cell decides: their common home, or else the home of one that the other visits, the
lower numbered of two such. Each link found is therefore counted once at both of its ends, where it is found, and is never
stored: a task gives one number per vector and a forest of links.

Centres are fitted by Spark on ``PER_CENTRE`` sampled vectors for each, ``MOST_CENTRES`` centres at most in all; labels of too few
vectors for two centres are one cell. Nothing depends on that limit but the size of the cells. The recall, the mean over
vectors of the share of each one's links, is audited against an exact scan for ``AUDITED`` vectors; below ``RECALL`` the overlap is doubled
and the search repeated. If no overlap is left to add and the recall is below ``LEAST_RECALL``, the query fails.

Cases: vectors that are null, zero, or hold null or non-finite components, and vectors of a null label, link with nothing;
vectors of different lengths are never compared; rows of one id are rows of their own; a null vec_id counts as a link but
names no component unless there is no other; of equally near centres or medoids the first counts; no rows give no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barograph.llm.graph import components, roots
from barograph.session import WorkArea

COSINE = 0.93
CELL, SHARD = 1024, 2048
MOST_CENTRES, PER_CENTRE = 16384, 16
FIT_ROUNDS = 5
MARGIN, CELLS = 0.1, 16
AUDITED, RECALL, LEAST_RECALL = 500, 0.95, 0.9
_NEAR, _FAR, _POOL, _PRUNE = 24, 8, 64, 1.2
_BEAM, _SLACK, _AT_ONCE, _ENTRIES = 32, 0.03, 512, 8
_PRODUCTS = 1 << 22  # of rows and centres at once

KEY = ("label", "dim")


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length 1 in double precision."""
    vectors = vectors.astype(np.float64)
    vectors /= np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def _matrix(column: pd.Series) -> np.ndarray:
    return unit(np.stack(column.to_list()))


def usable() -> Column:
    return F.expr(
        "label IS NOT NULL AND embedding IS NOT NULL AND size(embedding) > 0"
        " AND NOT exists(embedding, x -> x IS NULL OR isnan(x) OR abs(x) = double('infinity'))"
        " AND exists(embedding, x -> x <> 0)"
    )


def _nearest(x: np.ndarray, centre: np.ndarray):
    """Stretches of rows of ``x``: their place and their products with all centres."""
    rows = max(1, _PRODUCTS // len(centre))
    for at in range(0, len(x), rows):
        yield at, x[at : at + rows] @ centre.T


def centres(area: WorkArea, classes: DataFrame) -> dict[tuple, np.ndarray]:
    """Unit centres by label and length, for those that need more than one cell."""
    sizes = classes.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n"))
    total = sizes.filter(F.col("n") > CELL).agg(F.sum("n")).first()[0]
    if not total:
        return {}
    per_cell = max(CELL, total / MOST_CENTRES)
    large = sizes.filter(F.col("n") >= 2 * per_cell).collect()  # at most MOST_CENTRES / 2 rows
    if not large:
        return {}
    wanted = [(r.label, r.dim, int(r.n / per_cell), min(1.0, PER_CENTRE / per_cell)) for r in large]
    rates = area.spark.createDataFrame(wanted, "label int, dim int, centres int, rate double")
    lot = F.pmod(F.xxhash64("rep", F.lit(1)), F.lit(1 << 20)) / (1 << 20)
    sample = classes.join(F.broadcast(rates), list(KEY)).filter(lot < F.col("rate"))
    sample = area.stage(sample.select(*KEY, "rep", "centres", "embedding"), "sample")
    rank = F.row_number().over(Window.partitionBy(*KEY).orderBy(F.xxhash64("rep", F.lit(4)), "rep"))
    first = sample.select(*KEY, "rep", "centres", rank.alias("rank")).filter("rank <= centres")
    first = sample.join(first.select("rep"), "rep", "left_semi").select(*KEY, "rep", "embedding").toPandas()
    by_key = {tuple(map(int, k)): _matrix(g["embedding"]) for k, g in first.sort_values("rep").groupby(list(KEY))}
    for _ in range(FIT_ROUNDS):
        by_key = _moved(sample, by_key)
    return {k: c.astype(np.float32) for k, c in by_key.items()}


def _moved(sample: DataFrame, by_key: dict[tuple, np.ndarray]) -> dict[tuple, np.ndarray]:
    """Each centre moved to the mean direction of the sampled vectors nearest to it; only centres come to the driver."""
    held = sample.sparkSession.sparkContext.broadcast(by_key)
    schema = "label int, dim int, centre int, total array<double>"

    def sums(batches):
        totals: dict[tuple, np.ndarray] = {}
        met: dict[tuple, np.ndarray] = {}
        for batch in batches:
            for key, group in batch.groupby(list(KEY)):
                key = tuple(map(int, key))
                centre, x = held.value[key], _matrix(group["embedding"])
                total = totals.setdefault(key, np.zeros_like(centre))
                some = met.setdefault(key, np.zeros(len(centre), bool))
                for at, near in _nearest(x, centre):
                    best = near.argmax(axis=1)
                    np.add.at(total, best, x[at : at + len(best)])
                    some[best] = True
        for key, total in totals.items():
            which = np.flatnonzero(met[key])
            yield pd.DataFrame({"label": key[0], "dim": key[1], "centre": which, "total": list(total[which])})

    def added(key: tuple, parts: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"label": [key[0]], "dim": [key[1]], "centre": [key[2]], "total": [np.sum(np.stack(parts["total"].to_list()), axis=0)]})

    moved = sample.mapInPandas(sums, schema).groupBy(*KEY, "centre").applyInPandas(added, schema).toPandas()
    out = {k: c.copy() for k, c in by_key.items()}
    for label, dim, centre, total in moved.itertuples(index=False):
        if size := np.sqrt((np.asarray(total) ** 2).sum()):
            out[int(label), int(dim)][int(centre)] = total / size
    return out


def cells(classes: DataFrame, by_key: dict[tuple, np.ndarray], margin: float, most: int) -> DataFrame:
    """label, dim, rep, copies, embedding, cell, home (the cell where it is at home), visits (all its cells): each vector
    once for each of its cells, ``most`` of them."""
    held = classes.sparkSession.sparkContext.broadcast(by_key)

    def deal(batches):
        for batch in batches:
            for key, group in batch.groupby(list(KEY)):
                centre = held.value.get(tuple(map(int, key)))
                if centre is None:
                    yield group.assign(cell=0, home=0, visits=[[0]] * len(group))
                    continue
                for at, near in _nearest(_matrix(group["embedding"]), centre):
                    home = near.argmax(axis=1)
                    least = near.max(axis=1) - margin
                    if most < len(centre):
                        least = np.maximum(least, np.partition(near, -most, axis=1)[:, -most])
                    row, cell = np.nonzero(near >= least[:, None])
                    own = np.split(cell, np.flatnonzero(np.diff(row)) + 1)
                    yield group.iloc[at + row].assign(cell=cell, home=home[row], visits=[own[r] for r in row])

    schema = "label int, dim int, rep long, copies long, embedding array<double>, cell int, home int, visits array<int>"
    return classes.mapInPandas(deal, schema)


def prune(x: np.ndarray) -> list[np.ndarray]:
    """For each row the rows it is linked to: near ones that aren't nearer to each other, and some at random."""
    n = len(x)
    if n < 2:
        return [np.zeros(0, int)] * n
    near = (x @ x.T).astype(np.float32)
    np.fill_diagonal(near, -2)
    pool = min(_POOL, n - 1)
    cand = np.argpartition(-near, pool - 1, axis=1)[:, :pool]
    sims = np.take_along_axis(near, cand, axis=1)
    order = np.argsort(-sims, axis=1, kind="stable")
    cand, sims = np.take_along_axis(cand, order, axis=1), np.take_along_axis(sims, order, axis=1)
    far = np.sqrt(np.maximum(0, 2 - 2 * sims))
    left = np.ones(cand.shape, bool)
    links: list[list[int]] = [[] for _ in range(n)]
    for _ in range(min(_NEAR, pool)):
        some = np.flatnonzero(left.any(axis=1))
        if not len(some):
            break
        first = left[some].argmax(axis=1)
        chosen = cand[some, first]
        for i, c in zip(some.tolist(), chosen.tolist(), strict=True):
            links[i].append(c)
        between = np.sqrt(np.maximum(0, 2 - 2 * near[chosen[:, None], cand[some]]))
        left[some] &= _PRUNE * between > far[some]
        left[some, first] = False
    random = np.random.default_rng(n).integers(0, n, (n, _FAR))
    return [np.unique(np.append(a, b)) for a, b in zip(links, random, strict=True)]


def adjacency(members: DataFrame) -> DataFrame:
    """rep and near: the union of its adjacency lists in all shards, either way."""

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        reps = pdf["rep"].to_numpy()
        links = prune(_matrix(pdf["embedding"]))
        a = np.repeat(reps, [len(x) for x in links])
        b = reps[np.concatenate(links)] if len(a) else a
        return pd.DataFrame({"rep": np.concatenate([a, b]), "other": np.concatenate([b, a])}).query("rep != other")

    links = members.groupBy(*KEY, "cell", "shard").applyInPandas(build, "rep long, other long")
    return links.groupBy("rep").agg(F.collect_set("other").alias("near"))


def entries(x: np.ndarray) -> np.ndarray:
    """The medoid, and rows far from it and from each other."""
    at = [int((x @ x.mean(axis=0)).argmax())]
    closest = x @ x[at[0]]
    while len(at) < min(_ENTRIES, len(x)):
        at.append(int(closest.argmin()))
        closest = np.maximum(closest, x @ x[at[-1]])
    return np.unique(at)


def search(x: np.ndarray, links: np.ndarray, queries: np.ndarray, least: float) -> np.ndarray:
    """For each query (row) the rows of ``x`` that a best-first search over ``links`` (padded with -1) finds in range."""
    start = entries(x)
    sims = np.full((len(queries), len(x)), -2.0)
    sims[:, start] = queries @ x[start].T
    open_ = sims.copy()
    active = np.arange(len(queries))
    steps = 0
    while len(active):
        best = open_[active].argmax(axis=1)
        value = open_[active, best]
        go = (value > -2) & ((steps < _BEAM) | (value >= least - _SLACK))
        active, best = active[go], best[go]
        if not len(active):
            break
        open_[active, best] = -2
        next_ = links[best]
        q, k = np.nonzero(next_ >= 0)
        who, node = active[q], next_[q, k]
        new = sims[who, node] == -2
        who, node = who[new], node[new]
        found = np.einsum("ij,ij->i", queries[who], x[node])
        sims[who, node] = found
        open_[who, node] = found
        steps += 1
    return sims >= least


class _Shard:
    """The vectors of a shard, those at home in its cell first."""

    def __init__(self, cell: int, rows: pd.DataFrame):
        self.cell = cell
        rows = rows.assign(away=rows["home"] != cell).sort_values(["away", "rep"])
        self.reps, self.copies, self.homes = (rows[c].to_numpy() for c in ("rep", "copies", "home"))
        self.x = _matrix(rows["embedding"])
        self.at_home = int((~rows["away"]).sum())
        self.visits = rows["visits"].iloc[: self.at_home].to_list()
        place = pd.Series(np.arange(len(rows)), index=self.reps)
        flat = np.concatenate([np.asarray(a, np.int64) for a in rows["near"]])
        own = np.repeat(np.arange(len(rows)), rows["near"].map(len).to_numpy())
        there = place.reindex(flat).to_numpy()
        inside = ~np.isnan(there)
        own, there = own[inside], there[inside].astype(np.int64)
        degree = np.bincount(own, minlength=len(rows))
        self.links = np.full((len(rows), max(1, int(degree.max(initial=0)))), -1)
        self.links[own, np.arange(len(own)) - np.repeat(np.cumsum(degree) - degree, degree)] = there

    def decides(self, other: _Shard) -> np.ndarray:
        """For each vector at home here and each visitor in ``other``, whether this cell decides on the pair."""
        homes, at = np.unique(other.homes[other.at_home :], return_inverse=True)
        knows = np.zeros((self.at_home, len(homes)), bool)
        if len(homes) and self.at_home:
            flat = np.concatenate([np.asarray(v) for v in self.visits])
            own = np.repeat(np.arange(self.at_home), [len(v) for v in self.visits])
            place = np.minimum(np.searchsorted(homes, flat), len(homes) - 1)
            same = homes[place] == flat
            knows[own[same], place[same]] = True
        return (~knows | (self.cell < homes))[:, at]

    def meets(self, other: _Shard) -> np.ndarray:
        """The links from each vector at home here to each vector of ``other`` that its search finds."""
        found = np.zeros((self.at_home, len(other.reps)), bool)
        for at in range(0, self.at_home, _AT_ONCE):
            asked = self.x[at : min(at + _AT_ONCE, self.at_home)]
            found[at : at + len(asked)] = search(other.x, other.links, asked, COSINE)
        found[:, other.at_home :] &= self.decides(other)
        return found


def _tree(n: int, a0: int, b0: int, found: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links of ``n`` nodes that join what the links ``found`` join, whose rows begin at node a0 and columns at b0."""
    out = []
    for at in range(0, len(found), _AT_ONCE):
        q, k = np.nonzero(found[at : at + _AT_ONCE])
        label = roots(n, q + at + a0, k + b0)
        linked = np.flatnonzero(label != np.arange(n))
        out.append((label[linked], linked))
    return out


def _search_shards(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """Searches two shards of a cell from each other, or one from itself. Rows (a, b, n): a number of links n of vector a where
    b is null, else a link of a and b."""
    cell, low, high = map(int, key[2:])
    first, second = (_Shard(cell, rows[rows["shard"] == s]) for s in (low, high))
    if not len(first.reps) or not len(second.reps):
        return pd.DataFrame([], columns=["a", "b", "n"])
    there = first.meets(second)
    one = low == high
    back = there if one else second.meets(first)
    mutual = there[:, : second.at_home] | back[:, : first.at_home].T
    if one:
        np.fill_diagonal(mutual, False)
    there[:, : second.at_home] = mutual
    n_first = there @ second.copies
    n_second = there.T @ first.copies[: first.at_home]
    reps = first.reps if one else np.concatenate([first.reps, second.reps])
    shift = 0 if one else len(first.reps)
    n = np.zeros(len(reps), np.int64)
    n[: first.at_home] += n_first
    if one:
        n[first.at_home :] += n_second[first.at_home :]
    else:
        n[shift:] += n_second
        visitors = back[:, first.at_home :]
        n[shift : shift + second.at_home] += visitors @ first.copies[first.at_home :]
        n[first.at_home : shift] += visitors.T @ second.copies[: second.at_home]
    trees = _tree(len(reps), 0, shift, there)
    if not one:
        trees += _tree(len(reps), shift, first.at_home, back[:, first.at_home :])
    label = np.arange(len(reps))
    if trees:
        label = roots(len(reps), *(np.concatenate(t) for t in zip(*trees, strict=True)))
    linked = np.flatnonzero(label != np.arange(len(reps)))
    some = np.flatnonzero(n)
    numbers = pd.DataFrame({"a": reps[some], "b": pd.array([None] * len(some), dtype="Int64"), "n": n[some]})
    forest = pd.DataFrame({"a": reps[label[linked]], "b": pd.array(reps[linked], dtype="Int64"), "n": 0})
    return pd.concat([numbers, forest], ignore_index=True)


def searched(area: WorkArea, classes: DataFrame, by_key: dict[tuple, np.ndarray], margin: float, most: int, name: str) -> DataFrame:
    """What ``_search_shards`` gives, over all pairs of shards of a cell."""
    members = area.stage(cells(classes, by_key, margin, most), f"{name}-cells")
    sizes = members.groupBy(*KEY, "cell").agg(F.ceil(F.count(F.lit(1)) / SHARD).cast("int").alias("shards"))
    members = members.join(sizes, [*KEY, "cell"]).withColumn("shard", F.pmod(F.xxhash64("rep", F.lit(2)), F.col("shards")).cast("int"))
    members = area.stage(members, f"{name}-members")
    near = area.stage(adjacency(members), f"{name}-adjacency")
    nodes = members.join(near, "rep", "left").withColumn("near", F.coalesce("near", F.array().cast("array<long>")))
    nodes = nodes.withColumn("other", F.explode(F.expr("sequence(0, shards - 1)")))
    nodes = nodes.withColumns({"low": F.least("shard", "other"), "high": F.greatest("shard", "other")})
    nodes = nodes.select(*KEY, "cell", "low", "high", "shard", "rep", "copies", "home", "visits", "embedding", "near")
    found = nodes.groupBy(*KEY, "cell", "low", "high").applyInPandas(_search_shards, "a long, b long, n long")
    return area.stage(found, f"{name}-found")


def exact_links(classes: DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
    """rep and n: links of the asked vectors by comparison with all, a batch at a time."""
    by_key = {tuple(map(int, k)): (g["rep"].to_numpy(), _matrix(g["embedding"])) for k, g in asked.groupby(list(KEY))}

    def scan(batches):
        for batch in batches:
            for key, group in batch.groupby(list(KEY)):
                reps, x = by_key.get(tuple(map(int, key)), (None, None))
                if reps is None:
                    continue
                near = _matrix(group["embedding"]) @ x.T >= COSINE
                near &= group["rep"].to_numpy()[:, None] != reps[None, :]
                yield pd.DataFrame({"rep": reps, "n": group["copies"].to_numpy() @ near})

    counted = classes.mapInPandas(scan, "rep long, n long").groupBy("rep").agg(F.sum("n").alias("exact"))
    return counted.toPandas()


def audit(classes: DataFrame, found: DataFrame, audited: int = AUDITED) -> float:
    """The mean, over some vectors chosen by hash that have links, of the share of its links that the search found; 1 if none
    has links."""
    asked = classes.orderBy(F.xxhash64("rep", F.lit(3)), "rep").limit(audited).select(*KEY, "rep", "embedding").toPandas()
    if asked.empty:
        return 1.0
    exact = exact_links(classes, asked)
    exact = exact[exact["exact"] > 0]
    if exact.empty:
        return 1.0
    mine = found.filter(F.col("b").isNull() & F.col("a").isin([int(r) for r in exact["rep"]])).groupBy("a").agg(F.sum("n").alias("n"))
    got = dict(mine.toPandas().itertuples(index=False))
    return float(np.mean([got.get(rep, 0) / n for rep, n in exact.itertuples(index=False)]))


def near_duplicates(spark: SparkSession, vectors: DataFrame, margin: float = MARGIN, most: int = CELLS) -> DataFrame:
    """vec_id, n_links, component_id and kept of each row of ``vectors`` (vec_id, embedding, label)."""
    area = WorkArea(spark)
    own = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"), F.col("label").cast("int"))
    rows = own.withColumn("row", F.monotonically_increasing_id()).withColumn("usable", F.coalesce(usable(), F.lit(False)))
    rows = rows.withColumn("class", F.when(F.col("usable"), F.struct(F.xxhash64("embedding").alias("x"), F.hash("embedding").alias("y"))))
    rows = area.stage(rows, "rows")
    classes = rows.filter("usable").groupBy("label", F.size("embedding").alias("dim"), "class")
    classes = classes.agg(
        F.min("row").alias("rep"), F.min("vec_id").alias("first_id"), F.count(F.lit(1)).alias("copies"), F.first("embedding").alias("embedding")
    )
    named = area.stage(classes, "classes")
    classes = named.select(*KEY, "rep", "copies", "embedding")
    by_key = centres(area, classes)
    largest = max(map(len, by_key.values()), default=0)
    turn = 0
    while True:
        found = searched(area, classes, by_key, margin, most, f"search-{turn}")
        recall = audit(classes, found)
        if recall >= RECALL:
            break
        if not by_key or (margin >= 2 and most >= largest):
            if recall < LEAST_RECALL:
                raise RuntimeError(f"recall of {recall:.3f} with all overlap")
            break
        turn, margin, most = turn + 1, 2 * margin, 2 * most
    nodes = components(area, found.filter("b IS NOT NULL").select("a", "b"), "components")
    counts = found.filter("b IS NULL").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("n"))
    labelled = named.join(nodes, F.col("rep") == F.col("node"), "left").withColumn("root", F.coalesce("component", "rep"))
    labelled = area.stage(labelled.join(counts, "rep", "left").select("label", "class", "first_id", "copies", "root", "n"), "labelled")
    least = labelled.groupBy("root").agg(F.min("first_id").alias("component_id"))
    known = labelled.join(least, "root").select(
        F.col("label").alias("_label"), F.col("class").alias("_class"), (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"
    )
    known = area.stage(known, "known")
    joined = rows.filter("usable").join(known, (F.col("label") == F.col("_label")) & (F.col("class") == F.col("_class")))
    alone = rows.filter("NOT usable").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    both = joined.select("vec_id", F.col("n_links").cast("long"), "component_id").unionByName(alone)
    return both.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op8_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark, spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
