"""Packing (op3), scores (op4), mixing (op9)."""

import random
import tracemalloc
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from barograph.llm import mixing, packing
from barograph.llm import pseudo_likelihood as pl
from barograph.session import WorkArea


def restored(rows, row=packing.ROW):
    """Token ids, without the end mark, of each (doc_id, first ids) from packed rows."""
    end = packing.encoder(packing.default_vocabulary()).end
    pieces = []
    for r in rows:
        ids, places = np.frombuffer(bytes(r.ids), "<u2"), np.frombuffer(bytes(r.positions), "<u2")
        cuts = list(r.cumulative_lengths)
        assert len(ids) == len(places) == row and cuts[-1] == r.n_tokens <= row and len(cuts) == r.n_segments + 1
        assert not ids[r.n_tokens :].any()
        for d, p, a, b in zip(r.doc_ids, r.pieces, cuts, cuts[1:], strict=False):
            assert (places[a:b] == np.arange(b - a)).all()
            pieces.append((d, p, ids[a:b].tolist()))
    texts = defaultdict(list)
    for d, p, ids in sorted(pieces, key=lambda x: (x[0] is None, x[0] or 0, x[1])):
        texts[d].append((p, ids))
    return texts, end


def test_texts_come_back(spark, small_docs):
    docs = spark.createDataFrame(small_docs, "doc_id long, text string").repartition(4)
    bpe = packing.encoder(packing.default_vocabulary()).bpe
    for row, group in ((2048, 8 << 20), (64, 20_000)):
        texts, end = restored(packing.pack(docs, row=row, group_bytes=group).collect(), row)
        assert len(texts) == len(small_docs)
        for d, text in small_docs:
            assert [p for p, _ in texts[d]] == list(range(len(texts[d])))
            ids = [i for _, part in texts[d] for i in part]
            assert ids == [*bpe.encode_ordinary(text), end] and bpe.decode(ids[:-1]) == text


def test_odd_texts_come_back(spark, odd_docs, odd_rows, no_docs):
    rows = packing.pack(odd_docs).collect()
    texts, end = restored(rows)
    bpe = packing.encoder(packing.default_vocabulary()).bpe
    due = defaultdict(list)
    for d, text in odd_rows:
        ids = [*bpe.encode_ordinary(text or ""), end]
        due[d] += [(i // packing.ROW, ids[i : i + packing.ROW]) for i in range(0, len(ids), packing.ROW)]
    assert {d: sorted(x) for d, x in texts.items()} == {d: sorted(x) for d, x in due.items()}
    assert not packing.pack(no_docs).collect()


def test_encoder_equals_the_plain_one():
    import pyarrow as pa

    from barograph.llm.words import flat

    random.seed(11)
    own = packing.encoder(packing.default_vocabulary())
    signs = ["a", "B", "é", "ß", "中", " ", " ", " ", " ", "\n", "\t", "'s", "'", "1", "!", "\x7f", "\x1c", "😀", "\r\n", "ж"]
    texts = ["".join(random.choices(signs, k=random.randrange(40))) for _ in range(4000)] + [None, "", " ", "\n"]
    ids, ends = own.encode(*flat(pa.array(texts)))
    for t, a, b in zip(texts, ends, ends[1:], strict=False):
        assert ids[a:b].tolist() == own.bpe.encode_ordinary(t or "")


def test_best_fit():
    random.seed(12)
    for _ in range(200):
        row = random.choice([1, 7, 16, 100])
        lengths = sorted((random.randint(1, row) for _ in range(random.randrange(60))), reverse=True)
        expected, free = [], []
        for i, n in enumerate(lengths):
            fits = [f for f in free if f >= n]
            if fits:
                at = max(k for k, f in enumerate(free) if f == min(fits))
                expected[at].append(i)
                free[at] -= n
            else:
                expected.append([i])
                free.append(row - n)
        got = packing.best_fit(lengths, row)
        assert sorted(sum(got, [])) == list(range(len(lengths)))
        assert sorted(row - sum(lengths[i] for i in r) for r in got) == sorted(free)


def test_encoding_takes_small_steps(spark):
    """The tables that a task of token_pieces holds do not grow with the batch; the ids are those of single texts."""

    class Held:
        """Takes the function that a task would run."""

        def select(self, *_):
            return self

        def mapInArrow(self, rows, _):
            return rows

    rng = np.random.default_rng(23)
    words = np.array(["".join(chr(97 + c) for c in rng.integers(0, 26, 6)) for _ in range(5000)])
    texts = [" ".join(rng.choice(words, 1000)) for _ in range(1000)]
    own = packing.encoder(packing.default_vocabulary())
    batch = pa.RecordBatch.from_arrays([pa.array(range(1000), pa.int64()), pa.array(texts)], ["doc_id", "text"])
    tracemalloc.start()
    found = dict.fromkeys(range(1000), b"")
    for out in packing.token_pieces(Held(), packing.default_vocabulary())(iter([batch])):
        for r in out.to_pylist():
            found[r["doc_id"]] += r["ids"]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    for d in (0, 136, 137, 500, 999):
        assert np.frombuffer(found[d], own.dtype).tolist() == [*own.bpe.encode_ordinary(texts[d]), own.end]
    assert peak < 40e6


# Scores


def test_gradients():
    rng = np.random.default_rng(13)
    near, ids = rng.integers(0, pl.IDS + 1, (50, 4)), rng.integers(0, pl.IDS, 50)
    weights = pl.initial(np.ones(pl.IDS))
    before = pl.log_probabilities(weights, near, ids)
    squares = {k: np.full(s, 1e-4, np.float32) for k, s in pl.SHAPES.items()}
    for _ in range(30):
        pl.train_step(weights, squares, near, ids)
    assert pl.log_probabilities(weights, near, ids).mean() > before.mean() + 2
    assert np.allclose(pl.packed(pl.unpacked(pl.packed(weights))), pl.packed(weights))
    every = pl.log_probabilities(weights, np.repeat(near[:1], pl.IDS, axis=0), np.arange(pl.IDS))
    assert np.exp(every).sum() == pytest.approx(1, abs=1e-4)


def test_scoring_takes_small_steps():
    """Tables of scoring stay small, and a word's value depends on no other word; a plain version gives the same."""
    rng = np.random.default_rng(19)
    near, ids = rng.integers(0, pl.IDS + 1, (1 << 17, 4)), np.minimum(rng.zipf(1.3, 1 << 17), pl.IDS) - 1
    weights = pl.initial(np.bincount(ids, minlength=pl.IDS))
    tracemalloc.start()
    found = pl.log_probabilities(weights, near, ids)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 28e6
    for a, b in [(0, 1), (5, 7), (100, 1131), (70_000, 131_000)]:
        assert (pl.log_probabilities(weights, near[a:b], ids[a:b]) == found[a:b]).all()
    for i in range(0, len(ids), 9000):
        h = np.tanh(sum(weights["near"][j][near[i, j]].astype(float) for j in range(4)) + weights["bias"])
        kind, member = divmod(ids[i], pl.MEMBERS)
        classes = np.exp(weights["class_out"] @ h + weights["class_bias"])
        members = np.exp(weights["word_out"][kind] @ h + weights["word_bias"][kind])
        assert found[i] == pytest.approx(np.log(classes[kind] / classes.sum() * members[member] / members.sum()), abs=1e-5)


def test_training_tells_order(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    plain, model = pl.fit(spark, docs, 0), pl.fit(spark, docs)
    own = {r.doc_id: r for r in pl.scores(docs, model).collect()}
    base = {r.doc_id: r for r in pl.scores(docs, plain).collect()}
    words = sum(r.n_words for r in own.values())
    assert sum(r.log_likelihood for r in own.values()) / words > sum(r.log_likelihood for r in base.values()) / words + 0.05
    random.seed(14)
    mixed = [(r.doc_id, " ".join(random.sample(r.text.split(), len(r.text.split())))) for r in docs.filter("length(text) > 500").limit(200).collect()]
    worse = [r.log_likelihood < own[r.doc_id].log_likelihood for r in pl.scores(spark.createDataFrame(mixed, "doc_id long, text string"), model).collect()]
    assert np.mean(worse) > 0.7


def test_scores_of_odd_documents(spark, odd_docs, odd_rows, no_docs):
    model = pl.fit(spark, odd_docs)
    rows = pl.scores(odd_docs, model).collect()
    assert sorted(r.n_words for r in rows) == sorted(len((t or "").encode().split()) for _, t in odd_rows)
    assert all((r.log_likelihood < 0) == (r.n_words > 0) for r in rows)
    copies = {round(r.log_likelihood, 6) for r in rows if r.doc_id in (1, 2)}
    assert len(copies) == 1
    assert np.array_equal(model[1], pl.fit(spark, odd_docs)[1])
    assert not pl.scores(no_docs, pl.fit(spark, no_docs)).collect()


def test_rounds_train_on_every_word(spark, odd_docs, odd_rows):
    area = WorkArea(spark)
    frequent, weights = np.zeros(0, np.uint64), pl.packed(pl.initial(np.ones(pl.IDS)))
    for turn in range(pl.ROUNDS):
        weights = pl.trained(area, odd_docs, frequent, weights, turn)
    tables = [spark.read.parquet(f"{area.path}/weights-{turn}").filter("slice = 0") for turn in range(pl.ROUNDS)]
    assert sum(r.words for t in tables for r in t.collect()) == sum(len((t or "").encode().split()) for _, t in odd_rows)
    row = np.repeat([0, 2, 3, 7], [1, 10, 4, 300])
    assert sorted(np.concatenate([pl.targets(row, turn) for turn in range(pl.ROUNDS)])) == list(range(len(row)))


def test_words_of_shared_ids_have_their_own_probability(spark):
    """Far more words than ids: different words sum to one, and words never seen score below all real ones."""
    random.seed(15)
    words = [f"w{i}x" for i in range(9000)]
    text = [w for i, w in enumerate(words) for _ in range(1 + 8000 // (i + 1))]
    random.shuffle(text)
    docs = spark.createDataFrame([(i, " ".join(text[i::60])) for i in range(60)], "doc_id long, text string").repartition(3)
    model = pl.fit(spark, docs, 0)
    never = [f"n{random.getrandbits(60):x}" for _ in range(500)]
    single = spark.createDataFrame(list(enumerate(words + never)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.log_likelihood for r in pl.scores(single, model).collect()}
    p = np.exp([got[i] for i in range(len(words) + len(never))])
    real, unseen = p[: len(words)], p[len(words) :]
    assert unseen.max() < real.min()
    assert np.corrcoef(np.log(real), np.log([1 + 8000 // (i + 1) for i in range(9000)]))[0, 1] > 0.95
    # One word of each shared id's count is left for words never seen.
    assert 0.9 < real.sum() < 1 and real.sum() == pytest.approx(1 - 1024 / len(text), abs=0.02)


# Mixing


def check(rows):
    by_source = defaultdict(list)
    for r in rows:
        by_source[r.source].append(r)
        assert 0 <= r.taken <= 3 * r.size
        assert r.taken == (r.epochs or 0) * r.size + (r.cut or 0)
    for source in by_source.values():
        assert sum(r.taken for r in source) == round(source[0].target)
        assert sum(r.size for r in source) == source[0].source_size
    return {s: (x[0].source_size, x[0].target) for s, x in by_source.items()}


def test_targets_follow_weights_up_to_the_limit(spark):
    sizes = {"a": 10, "b": 1000, "c": 20, "d": 500, None: 4}
    rows = [(i * 100 + k, " ".join(["w"] * (n // 10 + (n % 10 if k == 0 else 0))), s) for i, (s, n) in enumerate(sizes.items()) for k in range(10)]
    rows = [(d, t if len(t) else None, s) for d, t, s in rows]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, source string, size string, one int").repartition(5)
    out = mixing.mix_sources(spark, docs).collect()
    assert len(out) == len(rows)
    got = check(out)
    total = sum(n for n, _ in got.values())
    weights = {"a": 1, "b": 2, "c": 3, "d": 1, None: 2}
    free = {s for s, (n, t) in got.items() if t < 3 * n - 1e-9}
    assert sum(t for _, t in got.values()) == pytest.approx(total)
    unit = {got[s][1] / weights[s] for s in free}
    assert max(unit) - min(unit) < 1e-9
    assert all(3 * got[s][0] <= max(unit) * weights[s] + 1e-9 for s in set(got) - free)
    again = mixing.mix_sources(spark, docs.repartition(3)).collect()
    assert sorted(map(str, again)) == sorted(map(str, out))


def test_mix_of_odd_documents(spark, odd_docs, odd_rows, no_docs):
    out = mixing.mix_sources(spark, odd_docs).collect()
    assert len(out) == len(odd_rows)
    check(out)
    assert not mixing.mix_sources(spark, no_docs).collect()
    empty = odd_docs.filter("text IS NULL OR trim(text) = ''")
    assert all(r.taken == 0 and r.target == 0 for r in mixing.mix_sources(spark, empty).collect())


def test_scores_equal_a_plain_loop(spark):
    """Each word's logarithm by the formula, one word at a time."""
    random.seed(21)
    words = [f"v{i}" for i in range(40)]
    texts = [" ".join(random.choices(words, weights=range(1, 41), k=random.choice([1, 2, 5, 60]))) for _ in range(50)] + ["", None, "  "]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    model = pl.fit(spark, docs)
    w, vocabulary = pl.unpacked(model.weights), pl.Vocabulary(model.frequent)

    def log_share(x, at):
        return x[at] - np.log(np.exp(x - x.max()).sum()) - x.max()

    def plain(text):
        data = np.frombuffer((text or "").encode(), np.uint8)
        ids = [int(i) for _, _, hashes, _ in pl.chunks(pa.array([text])) for i in vocabulary.ids(hashes)] if len(data) else []
        total = 0.0
        for k, i in enumerate(ids):
            h = w["bias"].astype(float)
            for j, gap in enumerate([-2, -1, 1, 2]):
                h = h + w["near"][j][ids[k + gap] if 0 <= k + gap < len(ids) else pl.IDS]
            h = np.tanh(h)
            kind, member = divmod(i, pl.MEMBERS)
            total += log_share(w["class_out"] @ h + w["class_bias"], kind) + log_share(w["word_out"][kind] @ h + w["word_bias"][kind], member)
        return len(ids), total

    for r in pl.scores(docs, model).collect():
        n, total = plain(texts[r.doc_id])
        assert r.n_words == n
        assert r.log_likelihood == pytest.approx(total, abs=1e-3 + 1e-5 * n)
