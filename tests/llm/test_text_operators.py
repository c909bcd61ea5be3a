"""Each operator against a brute-force version, over rows that hold the awkward cases."""

from __future__ import annotations

import hashlib
import re
import string
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from strata.llm import decontaminate, line_dedup, ngram_join, sentencepiece, substring_dedup
from llm_rows import prose, rows_of

SPACE = re.compile(rb"[\x20\x09-\x0D]+")


def words(text) -> list[bytes]:
    return [w for w in SPACE.split((text or "").encode()) if w]


def brute_removed(rows, window):
    first = {}
    for d, t, *_ in rows:
        w = words(t)
        for k in range(len(w) - window + 1) if d is not None else ():
            key = tuple(w[k:k + window])
            first[key] = min(first.get(key, d), d)
    out = []
    for d, t, *_ in rows:
        w = words(t)
        gone = set()
        for k in range(len(w) - window + 1) if d is not None else ():
            if first[tuple(w[k:k + window])] < d:
                gone |= set(range(k, k + window))
        out.append((d, len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone).decode()))
    return sorted(out, key=str)


def test_repeated_passages(docs, docs_rows, empty_docs):
    want = brute_removed(docs_rows, 50)
    assert rows_of(substring_dedup.remove_repeats(docs), "doc_id", "n_words", "n_removed", "kept") == want
    # every anchor split to full-length prefixes, and tiny groups: the same spans
    assert rows_of(substring_dedup.remove_repeats(docs, hot=1, group=5), "doc_id", "n_words", "n_removed", "kept") == want
    assert substring_dedup.remove_repeats(empty_docs).count() == 0


def brute_components(rows):
    sets = []
    for _, t, *_ in rows:
        w = [x.lower() for x in words(t)]
        sets.append({tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    label = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b) and label[i] != label[j]:
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    least = defaultdict(lambda: None)
    for (d, *_), x in zip(rows, label, strict=True):
        if d is not None:
            least[x] = d if least[x] is None else min(least[x], d)
    return sorted(((r[0], len(s), least[x] if s else r[0]) for r, s, x in zip(rows, sets, label, strict=True)), key=str)


def test_jaccard_components(docs, docs_rows, empty_docs):
    got = rows_of(ngram_join.ngram_components(docs), "doc_id", "n_shingles", "component_id")
    assert got == brute_components(docs_rows)
    assert ngram_join.ngram_components(empty_docs).count() == 0


def test_one_document_of_a_group_stays(docs, docs_rows):
    kept = rows_of(ngram_join.keep_one(docs), "doc_id")
    parts = defaultdict(int)
    for _, n, c in brute_components(docs_rows):
        parts[c] += n > 0
    blank = sum(not words(t) for _, t, *_ in docs_rows)
    assert len(kept) == blank + sum(1 for c, n in parts.items() if n)
    assert len(ngram_join.keep_one(docs).columns) == len(docs.columns)


def test_unlike_groups_of_one_id_keep_a_document_each(spark, tmp_path):
    """Groups whose smallest doc_id is the same, or null."""
    a, b, c, d = (" ".join(f"{x}{k}" for k in range(40)) for x in "abcd")
    rows = [(1, a), (1, a), (1, b), (2, b), (None, c), (None, c), (None, d), (None, d + " more")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "d"))
    kept = ngram_join.keep_one(spark.read.parquet(str(tmp_path / "d"))).collect()
    assert sorted(r.text[0] for r in kept) == ["a", "b", "c", "d"]
    assert {r.text[0]: r.doc_id for r in kept} == {"a": 1, "b": 1, "c": None, "d": None}


def test_blocks_of_a_large_cluster_lose_no_link(docs, docs_rows, monkeypatch):
    import strata.llm.cluster as cluster
    monkeypatch.setattr(cluster.verified_components, "__defaults__", (4, None))
    got = rows_of(ngram_join.ngram_components(docs), "doc_id", "n_shingles", "component_id")
    assert got == brute_components(docs_rows)


def brute_lines(rows):
    lines, first = [], {}
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0))
    for k in order:
        for n, line in enumerate((rows[k][1] or "").encode().split(b"\n")):
            if line.strip():
                lines.append((k, n, line.strip()))
                first.setdefault(line.strip(), (order.index(k), n))
    distinct = list(first)
    sets = [{x[i:i + 8] for i in range(max(1, len(x) - 7))} for x in distinct]
    label = list(range(len(distinct)))
    for i in range(len(distinct)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]) and label[i] != label[j]:
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    best = {}
    for x, c in zip(distinct, label, strict=True):
        best[c] = min(best.get(c, first[x]), first[x])
    component = dict(zip(distinct, label, strict=True))
    gone = {(k, n) for k, n, line in lines if best[component[line]] != (order.index(k), n)}
    out = []
    for k, (doc, text, *_) in enumerate(rows):
        kept = "\n".join(x for n, x in enumerate((text or "").split("\n")) if (k, n) not in gone)
        out.append((doc, text if text is None else kept, sum(j == k for j, _ in gone)))
    return sorted(out, key=str)


def test_fuzzy_lines(docs, docs_rows, empty_docs):
    got = line_dedup.dedup_lines(docs)
    # of equal rows either may be the first: as a multiset the rows are the same
    assert rows_of(got, "doc_id", "text", "n_removed") == brute_lines(docs_rows)
    assert line_dedup.dedup_lines(empty_docs).count() == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_fuzzy_lines_of_families(spark, tmp_path, monkeypatch, seed):
    """Families whose members are alike along chains only, in small blocks, with one family holding a third of all lines."""
    import random
    import strata.llm.cluster as cluster
    monkeypatch.setattr(cluster, "BLOCK", 8)
    monkeypatch.setattr(cluster.verified_components, "__defaults__", (8, None))
    r = random.Random(seed)
    lines = []
    for size in (60, 20, 20, 10, 5, 5):
        line = "".join(r.choices(string.ascii_lowercase + " ", k=150)).strip()
        for _ in range(size):
            lines.append(line)
            at = r.randrange(len(line))
            line = (line[:at] + r.choice("0123456789") + line[at + 1:]).strip()
    lines += ["".join(r.choices(string.ascii_lowercase, k=r.randint(1, 60))) for _ in range(60)]
    r.shuffle(lines)
    rows = [(k, "\n".join(lines[3 * k:3 * k + 3])) for k in range(60)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(5).write.parquet(f"{tmp_path}/d")
    got = rows_of(line_dedup.dedup_lines(spark.read.parquet(f"{tmp_path}/d")), "doc_id", "text", "n_removed")
    assert got == brute_lines(rows)


def test_clashing_columns_stay(spark):
    docs = spark.createDataFrame([(1, "a\na", 77, "x")], "doc_id long, text string, n_lines int, N_Removed string")
    got = line_dedup.dedup_lines(docs).first().asDict()
    assert got == {"doc_id": 1, "text": "a", "n_lines": 77, "N_Removed": "x", "_n_lines": 2, "_n_removed": 1}


def test_rows_keep_their_numbers_when_cores_come_and_go(spark, tmp_path):
    """Files are packed into partitions by the number of cores; a change between two reads must not move a row."""
    from strata.llm.common import numbered
    texts = [prose(k, 30) for k in range(64)] + [prose(k, 30) for k in range(20)]
    bench = prose(500, 15)
    texts += [prose(k, 10) + " " + bench for k in (200, 201)]
    path = f"{tmp_path}/d"
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(16, "doc_id").write.parquet(path)
    docs, benchmark = spark.read.parquet(path), spark.createDataFrame([(1, bench)], "item_id long, text string")
    before = {r.doc_id: r.row for r in numbered(docs).collect()}
    assert len(set(before.values())) == len(texts)
    import strata.llm.cluster as cluster
    real, cores = cluster.connected_components, iter([4, 2, 7, 3, 5, 6, 4, 2, 7, 3, 5] * 9)

    def moves(edges):
        spark.conf.set("spark.sql.leafNodeDefaultParallelism", next(cores))
        return real(edges)

    want = [set(range(64)) | {84, 85}, set(range(84))]
    with pytest.MonkeyPatch.context() as m:
        try:
            for module in (line_dedup, ngram_join, cluster):
                m.setattr(module, "connected_components", moves)
            kept = {r.doc_id for r in line_dedup.dedup_lines(docs).filter("n_removed < n_lines").collect()}
            assert kept >= set(range(64)) and not kept & set(range(64, 84))
            assert {r.doc_id for r in ngram_join.keep_one(docs).collect()} == want[0]
            spark.conf.set("spark.sql.leafNodeDefaultParallelism", 8)
            out = decontaminate.drop_contaminated(docs, benchmark)
            spark.conf.set("spark.sql.leafNodeDefaultParallelism", 3)
            assert {r.doc_id for r in out.collect()} == want[1]
            assert {r.doc_id: r.row for r in numbered(docs).collect()} == before
        finally:
            spark.conf.unset("spark.sql.leafNodeDefaultParallelism")
    # a frame that is no scan is stored before it is numbered
    joined = docs.join(spark.range(10).withColumnRenamed("id", "doc_id"), "doc_id")
    assert numbered(joined).select("row").distinct().count() == 10


def test_minhash_recall():
    import numpy as np
    import random
    r = random.Random(3)
    hit = total = 0
    for _ in range(400):
        a = "".join(r.choices(string.ascii_lowercase + " ", k=220))
        at = r.randrange(200)
        b = a[:at] + "#" + a[at + 1:]
        s, t = (line_dedup.line_set(x.encode()) for x in (a, b))
        if len(np.intersect1d(s, t)) * 100 >= 85 * len(np.union1d(s, t)):
            total += 1
            x, y = line_dedup.bands([a.encode(), b.encode()])
            hit += bool((x == y).any())
    assert total > 300 and hit >= 0.99 * total


def test_minhash_recall_at_the_threshold():
    """Lines of 100 to 220 letters at similarity 0.80 to 0.85."""
    import numpy as np
    import random
    r = random.Random(11)
    lines = []
    while len(lines) < 8000:
        n = r.randint(100, 220)
        a = r.choices(string.ascii_lowercase + " ", k=n)
        b = a[:-r.randint(n // 8, n // 5)]
        s, t = (line_dedup.line_set("".join(x).encode()) for x in (a, b))
        if 80 * len(np.union1d(s, t)) <= 100 * len(np.intersect1d(s, t)) <= 85 * len(np.union1d(s, t)):
            lines += ["".join(a).encode(), "".join(b).encode()]
    found = line_dedup.bands(lines)
    missed = (~(found[::2] == found[1::2]).any(1)).sum()
    assert missed <= 0.002 * len(lines) / 2, missed
    assert (1 - 0.8 ** line_dedup.ROWS) ** line_dedup.BANDS <= 0.002


BENCH = [(1, "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron"), (2, "short item"),
         (2, "short item"), (3, None), (4, "..."), (None, "unnamed words here"), (5, "alpha " * 20)]


def brute_hits(rows, window=13):
    table = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
    find = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(table))
    out = []
    for d, t, *_ in rows:
        w, hit, items = find(t), set(), set()
        for i, b in BENCH:
            x = find(b)
            n = min(window, len(x))
            for k in range(len(x) - n + 1 if n else 0):
                for s in range(len(w) - n + 1):
                    if w[s:s + n] == x[k:k + n]:
                        hit |= set(range(s, s + n))
                        items |= {str(i)} if i is not None else set()
        out.append((d, len(w), len(hit), sorted(items), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def test_contamination(spark, docs, docs_rows, tmp_path):
    extra = [(900 + k, t, *docs_rows[0][2:]) for k, t in enumerate((
        "x " * 30 + BENCH[0][1] + " y" * 30, BENCH[0][1].upper(), "a Short, ITEM; here", "short thing item",
        "alpha " * 15, "alpha " * 12, "unnamed words here", "beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu"))]
    rows = docs_rows + extra
    from llm_rows import DOC
    spark.createDataFrame(rows, DOC).write.parquet(str(tmp_path / "d"))
    stored = spark.read.parquet(str(tmp_path / "d"))
    bench = spark.createDataFrame(BENCH, "item_id long, text string")
    got = decontaminate.contamination(stored, bench)
    assert sorted(((*r[:3], list(r[3]), r[4]) for r in got.select(
        "doc_id", "n_words", "n_hit", "items", "contaminated").collect()), key=str) == brute_hits(rows)
    left = decontaminate.drop_contaminated(stored, bench)
    assert left.count() == sum(not x[4] for x in brute_hits(rows)) and left.columns == stored.columns
    none = decontaminate.contamination(stored, spark.createDataFrame([], "item_id long, text string"))
    assert none.agg(F.sum("n_hit")).first()[0] == 0
    near = decontaminate.proximity(stored, bench, slack=3)
    assert {906, 902} <= {r.doc_id for r in near.collect()}


def test_sentencepiece_round_trip_and_library(spark, docs, docs_rows, empty_docs):
    import pytest
    got = sentencepiece.encode(docs).collect()
    assert all(r.round_trip for r in got) and len(got) == len(docs_rows)
    assert all(r.n_tokens == 0 for r in got if r.doc_id in (4, 5))
    assert sentencepiece.encode(empty_docs).count() == 0
    pb = pytest.importorskip("sentencepiece.sentencepiece_model_pb2")
    from sentencepiece import SentencePieceProcessor
    pieces = sentencepiece.load_pieces()
    model = pb.ModelProto()
    model.ParseFromString(open(sentencepiece.MODEL, "rb").read())
    model.trainer_spec.model_type = 1
    for k, p in enumerate(model.pieces):
        p.score = float(pieces.score[k])
    sp = SentencePieceProcessor(model_proto=model.SerializeToString())
    same = total = 0
    for r in docs_rows:
        if r[1] and "▁" not in r[1]:
            ours, theirs = next(sentencepiece.Encoder(pieces)([r[1]])), sp.encode(r[1])
            total += 1
            same += list(ours) == theirs
            assert abs(pieces.score[ours].sum() - pieces.score[theirs].sum()) < 1e-6  # ties may fall otherwise
    assert same >= 0.9 * total


def test_digest_is_of_utf8(docs):
    r = substring_dedup.remove_repeats(docs).select("kept", F.sha2("kept", 256).alias("h")).first()
    assert r.h == hashlib.sha256(r.kept.encode()).hexdigest()
