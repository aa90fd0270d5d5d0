"""SimHash (op7) and embeddings (op8)."""

import random
from collections import Counter

import duckdb
import numpy as np
from brute import SMALL_DIR, counted, simhash, vectors

from barograph.llm import embeddings, simhash as own
from barograph.llm.graph import components
from barograph.session import WorkArea


def found(spark, docs):
    rows = own.simhash_components(spark, docs).collect()
    return counted((r.doc_id, f"{r.fp & (1 << 64) - 1:016x}", r.component_id) for r in rows)


def test_odd_documents(spark, odd_docs, odd_rows, no_docs):
    assert found(spark, odd_docs) == counted(simhash(odd_rows))
    assert not found(spark, no_docs)


def test_small_table(spark, small_docs):
    docs = spark.createDataFrame(small_docs, "doc_id long, text string")
    assert found(spark, docs) == counted(simhash(small_docs))


def test_links_of_crowded_fingerprints(spark):
    """Many fingerprints a few bits apart, so that variants are cut again and again."""
    rng = random.Random(5)
    prints = set()
    for _ in range(12):
        centre = rng.getrandbits(64)
        prints |= {centre ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(7))) for _ in range(40)}
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    table = spark.createDataFrame([(p,) for p in signed], "fp long")
    for limit in (3, 4096):
        links = own.links(WorkArea(spark), table, limit).collect()
        label = {r.node: r.component for r in components(WorkArea(spark), spark.createDataFrame(links, "a long, b long"), "test").collect()}
        up = {p: p for p in signed}

        def root(x, up=up):
            while up[x] != x:
                x = up[x]
            return x

        for i, a in enumerate(signed):
            for b in signed[:i]:
                if ((a ^ b) & (1 << 64) - 1).bit_count() <= 3:
                    low, high = sorted((root(a), root(b)))
                    up[high] = low
        assert {p: label.get(p, p) for p in signed} == {p: root(p) for p in signed}


def test_no_stage_has_two_python_steps(spark, small_docs, monkeypatch):
    """Each would take a worker of its own for every task, and idle workers keep their memory."""
    plans, stage = {}, WorkArea.stage

    def noted(area, df, name):
        plans[name] = df._jdf.queryExecution().sparkPlan().toString()
        return stage(area, df, name)

    monkeypatch.setattr(WorkArea, "stage", noted)
    docs = spark.createDataFrame(list(small_docs)[:50], "doc_id long, text string")
    own.simhash_components(spark, docs).collect()
    steps = {name: plan.count("MapInArrow") + plan.count("ArrowEvalPython") for name, plan in plans.items()}
    assert steps["prints"] == 1 and steps["simhash-links-0"] == 1 and max(steps.values()) == 1


def test_components_of_long_chains_and_stars(spark):
    random.seed(2)
    names = random.sample(range(-(10**9), 10**9), 600)
    links = [(names[i], names[i + 1]) for i in range(200)] + [(names[300], names[i]) for i in range(301, 500)]
    links += [(names[550], names[550])]
    table = spark.createDataFrame(links, "a long, b long").repartition(9)
    label = {r.node: r.component for r in components(WorkArea(spark), table, "chains").collect()}
    expected = {n: min(names[:201]) for n in names[:201]} | {n: min(names[300:500]) for n in names[300:500]}
    assert label == expected
    assert not components(WorkArea(spark), table.limit(0), "none").collect()


def linked(spark, rows, **limits):
    table = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<float>, label int, rep string, cell int")
    out = embeddings.near_duplicates(spark, table.repartition(4), **limits).collect()
    assert all(r.kept == (r.vec_id == r.component_id) for r in out)
    return [(r.vec_id, r.n_links, r.component_id) for r in out]


def test_odd_vectors(spark):
    rows = [
        (1, [1.0, 0.0], 1), (2, [1.0, 0.1], 1), (3, [1.0, 0.0], 1), (4, [1.0, 0.0], 2), (5, [1.0, 0.0], None),
        (6, None, 1), (7, [], 1), (8, [0.0, 0.0], 1), (9, [1.0, None], 1), (10, [float("nan"), 1.0], 1),
        (11, [float("inf"), 0.0], 1), (12, [1.0], 1), (13, [2.0], 1), (14, [-1.0, 0.0], 1), (15, [3e38, 3e37], 1), (16, [1e-30, 0.0], 1),
    ]
    assert counted(linked(spark, rows)) == counted(vectors(rows))
    assert not linked(spark, rows[:0])


def test_many_vectors_of_one_label(spark):
    """More than a cell holds; near copies, exact copies, and one crowd larger than a shard."""
    rng = np.random.default_rng(4)
    base = rng.standard_normal((1500, 16))
    near = base[:300] + 0.1 * rng.standard_normal((300, 16))
    crowd = rng.standard_normal(16) + 0.05 * rng.standard_normal((2300, 16))
    every = np.concatenate([base, near, base[:50], crowd]).astype(np.float32)
    rows = [(i, v.tolist(), 7) for i, v in enumerate(every)]
    unit = every.astype(float) / np.linalg.norm(every.astype(float), axis=1, keepdims=True)
    exact = (unit @ unit.T >= 0.93).sum(axis=1) - 1
    got = {d: n for d, n, _ in linked(spark, rows)}
    n = np.array([got[i] for i in range(len(rows))])
    assert (n <= exact).all() and n.sum() >= 0.95 * exact.sum()
    assert n[:1850].sum() >= 0.95 * exact[:1850].sum()


def brute_links(every, least=0.93):
    unit = every.astype(float) / np.linalg.norm(every.astype(float), axis=1, keepdims=True)
    return [np.flatnonzero(near >= least) for near in unit @ unit.T]


def agreement(spark, every):
    """Share of each vector's links found, after checks that hold for any recall."""
    got = {d: (n, c) for d, n, c in linked(spark, [(i, v.tolist(), 7) for i, v in enumerate(every)])}
    exact = brute_links(every)
    sizes = Counter(c for _, c in got.values())
    for i, near in enumerate(exact):
        n, component = got[i]
        assert n <= len(near) - 1
        assert (n > 0) == (sizes[component] > 1)  # no link is counted at one end only
    return np.array([got[i][0] / (len(near) - 1) if len(near) > 1 else np.nan for i, near in enumerate(exact)])


def test_pairs_are_counted_at_both_ends(spark):
    """Vectors of one label and a noisy copy of each, just in range or just out of it, beside a crowd."""
    rng = np.random.default_rng(8)
    base = rng.standard_normal((3000, 64))
    copies = base + 0.385 * rng.standard_normal((3000, 64))
    crowd = rng.standard_normal(64) + 0.05 * rng.standard_normal((1500, 64))
    every = np.concatenate([base, copies, crowd]).astype(np.float32)
    shares = agreement(spark, every)
    assert 500 < np.isfinite(shares[:6000]).sum() < 6000
    assert np.nanmean(shares[:6000]) >= 0.95 and np.nanmean(shares[6000:]) >= 0.95


def test_recall_of_single_vectors(spark):
    """Few dimensions, so that ordinary vectors have many links across cells, and a crowd that holds most links."""
    rng = np.random.default_rng(9)
    crowd = rng.standard_normal(8) + 0.05 * rng.standard_normal((1500, 8))
    every = np.concatenate([rng.standard_normal((6000, 8)), crowd]).astype(np.float32)
    assert np.nanmean(agreement(spark, every)[:6000]) >= 0.9


def test_small_vectors(spark):
    rows = duckdb.sql(f"SELECT vec_id, embedding, label FROM '{SMALL_DIR}/embeddings.parquet'").fetchall()
    assert counted(linked(spark, rows)) == counted(vectors(rows))


def test_audit_sees_what_is_missing(spark):
    rows = [(i, 1, 2, 1, [1.0, i / 1000]) for i in range(40)]
    classes = spark.createDataFrame([(r[1], r[2], r[0], r[3], r[4]) for r in rows], "label int, dim int, rep long, copies long, embedding array<double>")
    half = spark.createDataFrame([(i, None, 19) for i in range(40)], "a long, b long, n long")
    assert abs(embeddings.audit(classes, half) - 19 / 39) < 1e-9
    few = spark.createDataFrame([(i, None, 39 if i % 4 else 0) for i in range(40)], "a long, b long, n long")
    assert abs(embeddings.audit(classes, few) - 0.75) < 1e-9
