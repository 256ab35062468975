"""Periodic runs against a plain search over every period."""
import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from test_operators import SCHEMA, _table

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _runs(w, least=12):
    """(start, period, length) of every run, by walking each period's matches."""
    out = {}
    for p in range(1, len(w) // 2 + 1):
        i = 0
        while i < len(w) - p:
            s = i
            while i < len(w) - p and w[i] == w[i + p]:
                i += 1
            if i > s and i + p - s >= max(least, 2 * p):
                out.setdefault((s, i + p), p)
            i += i == s
    return sorted((s, p, e - s) for (s, e), p in out.items())


def _collapsed(w, runs):
    gone = {i for s, q, n in runs for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def test_runs_of_random_words():
    from tripmart.llm.periodic_runs import find_runs
    rnd = random.Random(1)
    for _ in range(150):
        docs = []
        for _ in range(rnd.randint(1, 5)):
            w = [rnd.randrange(rnd.choice([1, 2, 3, 20])) for _ in range(rnd.choice([0, 1, 5, 12, 13, 40, 120]))]
            if len(w) > 10:
                w = w[:rnd.randint(0, len(w))] + w[:rnd.randint(1, len(w) // 2)] * rnd.randint(1, 6) + w[:3]
            docs.append(w)
        ids = np.array([x for d in docs for x in d], np.int64)
        doc, s, n, p = find_runs(ids, [len(d) for d in docs])
        assert list(zip(doc.tolist(), s.tolist(), p.tolist(), n.tolist(), strict=True)) == [
            (k, *r) for k, d in enumerate(docs) for r in _runs(d)]


def test_extensions_of_the_grammar():
    from tripmart.llm.periodic_runs import Grammar
    rnd = np.random.default_rng(2)
    w = np.concatenate([rnd.integers(0, 2, 300), np.zeros(90, np.int64), np.tile(rnd.integers(0, 3, 7), 30)])
    sym = np.concatenate([[3], w, [4]])
    g = Grammar(sym)
    assert len(g.sym) < 8 * len(sym) and (g.sym[g.words:] > 4).any()        # names of higher levels
    i = rnd.integers(1, len(sym) - 1, 4000)
    j = rnd.integers(1, len(sym) - 1, 4000)
    i, j = np.minimum(i, j)[i != j], np.maximum(i, j)[i != j]
    for step in (1, -1):
        def plain(a, b):
            n = 0
            while 0 <= a and b < len(sym) and sym[a] == sym[b]:
                a, b, n = a + step, b + step, n + 1
            return n
        assert g.extension(i, j, step).tolist() == [plain(a, b) for a, b in zip(i.tolist(), j.tolist(), strict=True)]


@pytest.fixture(scope="module")
def awkward(spark):
    rows = _table()
    cycle = "eins zwei drei vier fünf "
    rows += [(i, t, None, None, None, 7, "x", 1) for i, t in (
        (50, cycle * 3), (51, cycle * 2 + "eins zwei"), (52, "a\x0bb\x0c" * 6), (53, "x " * 11), (54, "x " * 12),
        (55, cycle * 4 + "noch " + cycle * 4), (55, cycle * 4 + "noch " + cycle * 4), (None, "a b " * 2000 + "c" + " a b" * 9),
        (56, "Eins eins " * 6), (57, "a b " * 20))]
    return rows, spark.createDataFrame(rows, SCHEMA).repartition(3)


def test_periodic_runs_of_documents(awkward):
    from tripmart.llm.periodic_runs import periodic_runs
    rows, docs = awkward
    want = collections.Counter()
    for r in rows:
        w = WORD.findall(r[1] or "")
        runs = _runs(w)
        kept = _collapsed(w, runs)
        want[(r[0], len(w), tuple((s, n, q) for s, q, n in runs), hashlib.sha256(kept.encode()).hexdigest(), kept)] += 1
    got = collections.Counter((r.id, r.n_words, tuple(map(tuple, r.runs)), r.collapsed_sha256, r.collapsed)
                              for r in periodic_runs(docs).collect())
    assert got == want


def test_collapse_keeps_the_first_period(spark):
    from tripmart.llm.periodic_runs import periodic_runs
    df = spark.createDataFrame([(1, "start " + "one two three " * 5 + "end")], "doc_id long, text string")
    r = periodic_runs(df).first()
    assert r.collapsed == "start one two three end" and [tuple(x) for x in r.runs] == [(1, 15, 3)]
    assert periodic_runs(df.limit(0)).count() == 0


def test_query_contract(spark, awkward, tmp_path):
    from tripmart.llm.periodic_runs import op11_periodic_runs
    rows, docs = awkward
    rows = [r for r in rows if r[0] is not None]
    more = [(1000 + i, " ".join(f"w{(i * 7 + k * k) % 97}" for k in range(i % 60)), None, None, None, 7, "y", 1) for i in range(200)]
    spark.createDataFrame(rows + more, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    want, looped = collections.Counter(), 0
    for i, t, *_ in rows + more:
        w = WORD.findall(t or "")
        h, n = zlib.crc32(str(i).encode()), len(w)
        if h % 10 == 0 and n:
            looped += 1
            a = h // 10 % n
            p = 1 + (n - a) // (3 + h // 10 % 8)
            w = [w[k if k < a else a + (k - a) % p] for k in range(n)]
        runs = _runs(w)
        best = max(runs, key=lambda r: (r[2], -r[0], -r[1]), default=None)
        lines = "".join(f"{s},{n},{q}\n" for s, q, n in runs)
        sha = lambda x: hashlib.sha256(x.encode()).hexdigest()          # noqa: E731
        want[(i, len(runs), *((best[0], best[2], best[1], 1000 * best[2] // best[1]) if best else (None,) * 4),
              sha(lines), sha(_collapsed(w, runs)))] += 1
    got = op11_periodic_runs(spark, str(tmp_path)).select(
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")
    assert looped > 5 and collections.Counter(map(tuple, got.collect())) == want
    assert dict(got.dtypes)["exponent_milli"] == "bigint"


def test_null_columns(spark):
    from tripmart.llm.periodic_runs import looped
    df = spark.createDataFrame([(None, None, 1), (3, None, 2)], "doc_id long, text string, h int")
    assert sorted(map(tuple, looped(df).collect()), key=str) == [(3, ""), (None, "")]
    assert looped(df.filter(F.lit(False))).count() == 0
