"""Fill-in-middle round trips, exact search against brute force, whitening against numpy; awkward rows have defined results."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm import columnar_search, fill_middle, whitening
from llm_rows import rows_of

VEC = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                    T.StructField("row", T.StringType()), T.StructField("x", T.LongType()), T.StructField("score", T.StringType()),
                    T.StructField("asks", T.StringType()), T.StructField("shard", T.StringType())])


def vectors(dims: int = 24, n: int = 700) -> list[tuple]:
    """Random vectors, a hot vector (a third of all rows), copies, zeros, nulls, non-finite ones, repeated ids."""
    r = np.random.RandomState(3)
    hot = (r.standard_normal(dims) / 3).astype("f4").tolist()
    rows = []
    for k in range(n):
        v = hot if k % 3 == 0 else (r.standard_normal(dims) * (1 + (k % 5 == 0)) / 4).astype("f4").tolist()
        rows.append((k, v))
    rows += [(n, [0.0] * dims), (n + 1, None), (n + 2, [None] * dims), (n + 3, [math.nan] + [0.0] * (dims - 1)),
             (n + 4, [math.inf] + [0.0] * (dims - 1)), (20, rows[20][1]), (40, rows[41][1]), (40, rows[41][1]), (None, rows[7][1])]
    return [(k, v, "clash", 1, "clash", "clash", "clash") for k, v in rows]


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("vectors") / "e")
    spark.createDataFrame(vectors(), VEC).repartition(5, "vec_id").write.parquet(path)
    return spark.read.parquet(path)


def fine(v) -> bool:
    return v is not None and all(c is not None and math.isfinite(c) for c in v)


def brute_top(rows: list[tuple], top: int) -> list[tuple]:
    ok = [(k, np.floor(64 * np.array(v, dtype="f8")).astype(np.int64)) for k, v, *_ in rows if k is not None and fine(v)]
    width = max((len(v) for _, v in ok), default=0)
    x = np.array([np.pad(v, (0, width - len(v))) for _, v in ok]).reshape(len(ok), width)
    out = []
    for a, (k, _) in enumerate(ok):
        if k % 20 == 0:
            s = x @ x[a]
            best = sorted((-int(s[b]), ok[b][0]) for b in range(len(ok)) if b != a)[:top]
            out += [(k, rank, i, -score) for rank, (score, i) in enumerate(best, 1)]
    return sorted(out, key=str)


def asks():
    return F.col("vec_id") % 20 == 0


@pytest.mark.parametrize("top,shard,seeds", [(20, 100, 4096), (20, 131_072, 60), (3, 64, 0), (2000, 300, 4096)])
def test_columnar_search_equals_brute_force(table, monkeypatch, top, shard, seeds):
    monkeypatch.setattr(columnar_search, "SHARD", shard)
    monkeypatch.setattr(columnar_search, "LEAST_SHARD", shard)
    monkeypatch.setattr(columnar_search, "SEEDS", seeds)
    got = columnar_search.top_k(table, asks(), top)
    assert got.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "bigint")]
    assert rows_of(got, *got.columns) == brute_top(vectors(), top)


@pytest.mark.parametrize("scale", [1e5, 4e6, 8e6])
def test_columnar_search_large_components(spark, tmp_path, scale):
    r = np.random.RandomState(1)
    rows = [(k, (r.standard_normal(6) * scale).astype("f4").tolist()) for k in range(60)] + [(60, [1.5, -2.5])]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").write.parquet(f"{tmp_path}/e")
    got = columnar_search.top_k(spark.read.parquet(f"{tmp_path}/e"), asks(), 5)
    assert rows_of(got, *got.columns) == brute_top(rows, 5)


def test_columnar_search_small_and_empty(spark, table):
    assert columnar_search.top_k(table.limit(0), asks()).count() == 0
    assert columnar_search.top_k(table.filter("vec_id % 20 <> 0"), asks()).count() == 0
    one = spark.createDataFrame([(20, [1.0, 2.0], "x")], "vec_id long, embedding array<double>, rank string")
    assert columnar_search.top_k(one, asks()).count() == 0
    two = spark.createDataFrame([(20, [1.0, 2.0]), (21, []), (40, [0.5])], "vec_id long, embedding array<double>")
    assert rows_of(columnar_search.top_k(two, asks()), "query_id", "rank", "vec_id", "score") == sorted(
        [(20, 1, 40, 64 * 32), (20, 2, 21, 0), (40, 1, 20, 64 * 32), (40, 2, 21, 0)], key=str)


def test_bounds_leave_no_pair_out():
    r = np.random.RandomState(0)
    x, q = r.randint(-40, 40, (50, 300)), r.randint(-40, 40, (7, 50))
    whole = q @ x
    least = np.sort(whole, axis=1)[:, -9].astype(float)
    i, j, s = columnar_search.tile_survivors(q.astype("f4"), columnar_search.rest_norms(q, 1), x.astype("f4"),
                                             columnar_search.rest_norms(x, 0), least, 0.6)
    assert (whole[i, j] == s).all()
    assert {(a, b) for a, b in zip(i, j)} >= {tuple(p) for p in np.argwhere(whole >= least[:, None])}
    assert len(i) < whole.size / 4


def test_fill_in_middle(spark, docs, docs_rows):
    got = fill_middle.fill_in_middle(docs, texts=True).collect()
    assert len(got) == len(docs_rows)
    seen = sorted((r.doc_id is None, r.doc_id or 0, r.n, r.restored) for r in got)
    assert seen == sorted((d[0] is None, d[0] or 0, len(d[1] or ""), d[1] or "") for d in docs_rows)
    forms = set()
    for r in got:
        t = r.restored
        h = hashlib.sha256(f"1:{'' if r.doc_id is None else r.doc_id}".encode()).hexdigest()
        h1, h2, h3, h4 = (int(h[k:k + 8], 16) for k in (0, 8, 16, 24))
        a, b = sorted((h1 % (len(t) + 1), h2 % (len(t) + 1)))
        form = "plain" if not t or any(m in t for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90 else "spm" if h4 % 100 < 20 else "psm"
        output = {"plain": t, "psm": f"<P>{t[:a]}<S>{t[b:]}<M>{t[a:b]}", "spm": f"<S>{t[b:]}<P>{t[:a]}<M>{t[a:b]}"}[form]
        assert (r.form, r.output) == (form, output)
        assert (r.prefix_chars, r.middle_chars) == ((None, None) if form == "plain" else (a, b - a))
        assert r.output_sha256 == hashlib.sha256(output.encode()).hexdigest()
        assert r.restored_sha256 == hashlib.sha256(t.encode()).hexdigest()
        forms.add(form)
    assert forms == {"plain", "psm", "spm"}


def test_fill_in_middle_marks_and_hot_ids(spark, tmp_path):
    texts = ["a <P> b", "<S>", "<M", "P><S", "<<<", "x" * 100_000 + "<", "é" * 70_000, "<<P>>"]
    rows = [(5, t, "row", "digest") for t in texts for _ in range(40)]  # one id holds all rows
    rows += [(k, t, "row", "digest") for k in range(100, 140) for t in ("<", "<P", "S>a<M", "😀" * (k % 7))]
    spark.createDataFrame(rows, "doc_id long, text string, row string, digest string").repartition(4).write.parquet(f"{tmp_path}/d")
    got = fill_middle.fill_in_middle(spark.read.parquet(f"{tmp_path}/d"), texts=True).collect()
    assert sorted((r.doc_id, r.restored) for r in got) == sorted((r[0], r[1]) for r in rows)
    assert all(r.restored_sha256 == hashlib.sha256(r.restored.encode()).hexdigest() for r in got)
    assert all(r.form == "plain" for r in got if any(m in r.restored for m in ("<P>", "<S>", "<M>")))


def test_fill_in_middle_empty_table(empty_docs):
    assert fill_middle.fill_in_middle(empty_docs).count() == 0


@pytest.mark.parametrize("cut", [1, 2, 3, 5, 1000])
def test_reader_finds_marks_across_pieces(cut):
    output = "<S>one <<P><two<M>three><"
    reader, parts = fill_middle.Reader("spm"), []
    for at in range(0, len(output), cut):
        parts += reader.feed(output[at:at + cut])
    parts += reader.end()
    assert "".join(t for _, t in sorted(parts)) == "<two" + "three><" + "one <"


def test_fill_in_middle_is_a_secondary_sort(docs):
    plan = fill_middle.fill_in_middle(docs)._jdf.queryExecution().toRdd().toDebugString()
    assert plan.count("PairwiseRDD") == 1  # the second sort finds its rows in place


def test_whitening_equals_numpy(table):
    got = whitening.whiten(table).toPandas()
    ok = [(k, v) for k, v, *_ in vectors() if fine(v)]
    x = np.floor(64 * np.array([v for _, v in ok], dtype="f8")).astype(np.int64) + 1_000_000
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(0)
    assert (got.n == n).all() and len(got) == 16 * len(ok)
    centred = fit - s / n
    e, u = np.linalg.eigh(centred.T @ centred / n)
    e, u = e[::-1][:16], u[:, ::-1][:, :16]
    mine = {}
    for k, part in got.groupby("component"):
        assert np.allclose(part.explained, e[k - 1] / (centred ** 2).sum() * n, rtol=1e-9)
        mine[k] = sorted(zip(part.vec_id.fillna(-1), part.deviation, part.whitened), key=lambda t: (t[0], t[1], abs(t[2])))
    assert (got.identity_error < 1e-10).all()
    deviation = [int(sum(int(c) ** 2 for c in r)) for r in x * n - s]
    y = (x - s / n) @ u / np.sqrt(e)
    for k in range(16):
        want = sorted(zip([-1 if i is None else i for i, _ in ok], deviation, y[:, k]), key=lambda t: (t[0], t[1], abs(t[2])))
        assert [w[:2] for w in want] == [w[:2] for w in mine[k + 1]]
        a, b = np.array([w[2] for w in want]), np.array([w[2] for w in mine[k + 1]])
        assert np.allclose(a, b, atol=1e-9) or np.allclose(a, -b, atol=1e-9)


def test_whitening_without_variance(spark, table):
    assert whitening.whiten(table.limit(0)).count() == 0
    v = "vec_id long, embedding array<double>"
    assert whitening.whiten(spark.createDataFrame([(1, None)], v)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, [])], v)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, [0.5, 1.0])] * 3, v)).count() == 0
    got = whitening.whiten(spark.createDataFrame([(1, [0.0, 1.0]), (2, [1.0, 1.0]), (3, [1.0, 1.0]), (4, [0.0])], v)).collect()
    assert {(r.vec_id, r.component) for r in got} == {(k, c) for k in (1, 2, 3, 4) for c in (1, 2)}  # [0.0] counts as [0.0, 0.0]
    got = whitening.whiten(spark.createDataFrame([(1, [0.0, 1.0]), (2, [1.0, 1.0]), (3, [1.0, 1.0])], v)).collect()
    assert {(r.vec_id, r.component, r.n, r.deviation, round(abs(r.whitened), 9), r.explained) for r in got} == {
        (k, 1, 2, 64 * 64, 1.0, 1.0) for k in (1, 2, 3)}  # the second direction has no variance


@pytest.mark.parametrize("values", [[5.0, 5.0, 5.0, 1.0], [1.0, 1.0], [3.0, 2.0, 1.0, 0.0, 0.0], [1e8, 1.0, 1e-8], [2.0]])
def test_spectral_split_of_known_eigenvalues(values):
    r = np.random.RandomState(5)
    q, _ = np.linalg.qr(r.standard_normal((len(values), len(values))))
    a = q @ np.diag(values) @ q.T
    got, v = whitening.components_of((a + a.T) / 2, len(values))
    assert np.allclose(got, values, atol=1e-12 * max(values))
    assert np.allclose(v.T @ v, np.eye(len(values)), atol=1e-12) and np.allclose(a @ v, v * got, atol=1e-12 * max(values))


def test_polar_factor_is_the_matrix_sign():
    r = np.random.RandomState(2)
    q, _ = np.linalg.qr(r.standard_normal((9, 9)))
    e = np.array([3.0, 1e-9, -1e-9, -2.0, 5.0, -5.0, 1.0, -1.0, 0.5])
    u = whitening.polar_factor(q @ np.diag(e) @ q.T)
    assert np.allclose(u, q @ np.diag(np.sign(e)) @ q.T, atol=1e-6) and np.allclose(u @ u, np.eye(9), atol=1e-12)
