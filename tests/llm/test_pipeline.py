"""The pipeline, stage by stage, and the registered queries."""

import shutil

import duckdb
import pyarrow as pa
import pytest
from brute import SF_DIR, SMALL_DIR, counted, leaked, mix, simhash
from test_outputs import restored

import __spark_entry__ as entry_point
import corpus_pipeline
from barograph.llm import classifier, packing
from barograph.llm.catalog import ORACLE_SQL, QUERIES

COLUMNS = list(corpus_pipeline.COLUMNS)


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Rows of the documents and after each stage."""
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = [docs.collect()]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF_DIR).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
        if k + 1 < len(corpus_pipeline.STAGES):
            assert docs.columns == COLUMNS
        rows.append(docs.collect())
    return rows


def test_rejected_documents_go(spark, stages):
    model = classifier.train(*[spark.read.parquet(f"{SF_DIR}/{t}.parquet") for t in ("documents", "labels")])
    blocks = classifier.features(pa.array([r.text for r in stages[0]]))
    scores = [s for x in blocks for s in (x * model[0]).sum(axis=1)]
    kept = [r for r, s in zip(stages[0], scores, strict=True) if s >= model[1]]
    assert counted(stages[1]) == counted(kept)
    good = dict(duckdb.sql(f"SELECT doc_id, quality FROM '{SF_DIR}/labels.parquet'").fetchall())
    stay = {r.doc_id for r in stages[1]}
    assert sum(d in stay for d, q in good.items() if q) >= 0.97 * sum(good.values())


def test_one_of_each_group_stays(stages):
    found = simhash([(r.doc_id, r.text) for r in stages[1]])
    kept = [r for r, (d, _, c) in zip(stages[1], found, strict=True) if d == c]
    assert counted(stages[2]) == counted(kept) and len(kept) < len(found)


def test_documents_with_benchmark_passages_go(stages):
    items = duckdb.sql(f"SELECT item_id, text FROM '{SF_DIR}/benchmark.parquet'").fetchall()
    hit = {n for n, _ in leaked([(r.doc_id, r.text) for r in stages[2]], items)}
    assert hit and counted(stages[3]) == counted(r for n, r in enumerate(stages[2]) if n not in hit)


def test_the_mix(stages):
    due = mix([(r.doc_id, r.text, r.source) for r in stages[3]])
    rows = []
    for d, text, taken in due:
        words = len(text.encode().split())
        rows += [(d, text)] * (taken // words if words else 0)
        if words and taken % words:
            n, cut = 0, text.encode()
            for i in range(len(cut) + 1):
                n = len(cut[:i].split())
                if n == taken % words and (i == len(cut) or cut[i : i + 1].isspace()):
                    rows.append((d, cut[:i].decode()))
                    break
    assert counted((r.doc_id, r.text) for r in stages[4]) == counted(rows)
    assert all(r.n_chars == len(r.text) for r in stages[4] if r.doc_id in {d for d, *_ in due})


def test_the_packed_rows(stages):
    texts, end = restored(stages[5])
    bpe = packing.encoder(packing.default_vocabulary()).bpe
    got = counted((d, tuple(ids)) for d, pieces in texts.items() for _, ids in pieces)
    due = []
    for r in stages[4]:
        ids = [*bpe.encode_ordinary(r.text), end]
        due += [(r.doc_id, tuple(ids[i : i + packing.ROW])) for i in range(0, len(ids), packing.ROW)]
    assert got == counted(due)


@pytest.fixture
def odd_dir(tmp_path, odd_docs):
    """The odd documents, twice over, with good and bad ones that carry labels."""
    spark = odd_docs.sparkSession
    extra = [(100 + i, f"A plain sentence of the usual kind number {i}, with some words and some more. And one.", "en", "s1", 70) for i in range(9)]
    extra += [(200 + i, "buy %%% now $$$ buy %%% now $$$ " * 5, "en", "s0", 70) for i in range(9)]
    plain = spark.createDataFrame(extra, odd_docs.select(*COLUMNS).schema)
    odd_docs.union(odd_docs).unionByName(plain, allowMissingColumns=True).write.parquet(f"{tmp_path}/documents.parquet")
    labels = spark.createDataFrame([(d, int(d < 200), 0) for d, *_ in extra], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "quick brown fox jumps over the lazy dog")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return tmp_path


def test_every_stage_takes_odd_documents(spark, odd_dir):
    docs = spark.read.parquet(f"{odd_dir}/documents.parquet")
    every = docs.drop_duplicates(COLUMNS).count()
    for name, stage in corpus_pipeline.STAGES:
        rows = stage(spark, docs, str(odd_dir)).collect()
        if name == "SimHash near-dedup":
            ids = [r.doc_id for r in rows if r.doc_id is not None]
            assert len(ids) == len(set(ids)) and len(rows) < every
        if name == "benchmark decontamination":
            assert {1, 2, 9} - {r.doc_id for r in rows} == {1, 2, 9} and {6, 7, 100} <= {r.doc_id for r in rows}
        assert rows
        assert not stage(spark, docs.limit(0), str(odd_dir)).collect()
    assert corpus_pipeline.run(spark, str(odd_dir)).count() > 0


def test_empty_tables(spark, odd_dir):
    for table in ("documents", "labels", "benchmark"):
        empty = spark.read.parquet(f"{odd_dir}/{table}.parquet").limit(0).toArrow()
        shutil.rmtree(odd_dir / f"{table}.parquet")
        spark.createDataFrame(empty).write.parquet(f"{odd_dir}/{table}.parquet")
    assert corpus_pipeline.run(spark, str(odd_dir)).collect() == []


def test_registered_queries(spark):
    names = entry_point.queries()
    for n in range(1, 11):
        assert [q for q in names if q.startswith(f"op{n}_")] == [q for q in QUERIES if q.startswith(f"op{n}_")]
        assert len([q for q in QUERIES if q.startswith(f"op{n}_")]) == 1
    assert names["pipeline"] is corpus_pipeline.run and "pipeline" not in entry_point.oracle_sql()
    due = {
        "op1": "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string",
        "op5": "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string",
        "op7": "doc_id bigint, fingerprint string, component_id bigint",
        "op8": "vec_id bigint, n_links bigint, component_id bigint, kept boolean",
        "op9": "doc_id bigint, size bigint, source_size bigint, target double, taken bigint",
        "op10": "doc_id bigint, held_out boolean, score double, predicted int",
    }
    tables = {"op8": "embeddings"}
    for name, query in QUERIES.items():
        short = name.split("_")[0]
        out = query(spark, SMALL_DIR)
        if short in due:
            assert dict(out.dtypes) == dict(x.split() for x in due[short].split(", "))
            n = spark.read.parquet(f"{SMALL_DIR}/{tables.get(short, 'documents')}.parquet").count()
            assert out.count() == n
        else:
            assert out.count() > 0


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_queries_equal_their_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "embeddings", "labels", "benchmark"):
        duck.execute(f"CREATE VIEW {table} AS FROM '{SF_DIR}/{table}.parquet'")
    theirs = duck.execute(ORACLE_SQL[name])
    columns = [d[0] for d in theirs.description]
    ours = QUERIES[name](spark, SF_DIR).select(*columns).collect()
    assert counted(tuple(r) for r in ours) == counted(theirs.fetchall())
