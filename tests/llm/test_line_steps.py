"""Steps of the line dedup that work on rows, against plain versions."""
import random
import re

import xxhash
from pyspark.sql import functions as F
from test_operators import _line_blocks, _line_simhash

from tripmart.llm import line_dedup as m


def _signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_fingerprints_counted_by_an_aggregation(spark):
    rnd = random.Random(21)
    norms = [" ".join("".join(rnd.choice("abcdéf") for _ in range(rnd.randint(1, 6))) for _ in range(n)) for n in (1, 2, 3, 4, 5, 8, 9, 40, 127, 256, 700)]
    norms += ["ab " * n + "c" for n in (254, 32765, 32766, 32767, 40000)] + ["a"] * 3 + [norms[7]] * 2
    df = spark.createDataFrame([(1, 2, u, n) for u, n in enumerate(norms)] + [(1, 2, 0, norms[0])] * 4 + [(None, 2, 0, "x y")], "id long, th long, u int, norm string")
    out = m._fingerprinted(df)
    got = sorted((r.id is None, r.u, r.a, r.fp, tuple(r.ends)) for r in out.collect())
    ends = {(r.id is None, r.u): tuple(r.e) for r in df.select("id", "u", m._ends(F.col("norm")).alias("e")).collect()}
    want = [(r.id is None, r.u, _signed(xxhash.xxh64_intdigest(r.norm.encode(), 42)), _signed(_line_simhash(r.norm)), ends[r.id is None, r.u]) for r in df.collect()]
    assert got == sorted(want) and len(got) == len(norms) + 5


def test_lines_normalised_a_text_at_a_time_are_the_same(spark):
    rnd = random.Random(22)
    texts = ["".join(rnd.choice("aZ09 -\t\r\n\n\x00\x0b\x7féΣ Kİ") for _ in range(rnd.randint(0, 120))) for _ in range(300)]
    docs = spark.createDataFrame([(i, i, t) for i, t in enumerate(texts)], "id long, th long, text string")
    lines = sorted(map(tuple, m._lines(m._worded(docs)).select("id", "th", "u", "norm").collect()))
    assert sorted(map(tuple, m._normalised_lines(docs).collect())) == lines and len(lines) > 300
    n = {r.id: r.n_lines for r in m.report(docs.select(F.col("id").alias("doc_id"), "text")).collect()}
    assert [n[i] for i in range(300)] == [len(t.split("\n")) if t else 0 for t in texts]


def test_blocks_as_rows_are_those_of_the_rule(spark):
    rnd = random.Random(23)
    norms = [" ".join("".join(rnd.choice("abcdé") for _ in range(rnd.randint(1, 7))) for _ in range(n)) for n in (1, 2, 3, 6, 12, 20, 30, 60, 150)] + ["a", "ab"]
    texts = spark.createDataFrame(list(enumerate(norms)), "a long, norm string")
    got = {}
    for r in m._blocks(m._grid(texts)).collect():
        got.setdefault(r.a, []).append(r.k)
    want = {i: {_signed(_hash(*b)) for b in _line_blocks(n)} for i, n in enumerate(norms)}
    assert {i: set(k) for i, k in got.items()} == want and all(len(k) == len(set(k)) for k in got.values())


def _hash(i, j, head, tail):
    h = xxhash.xxh64_intdigest(i.to_bytes(4, "little"), 42)
    h = xxhash.xxh64_intdigest(j.to_bytes(4, "little"), h)
    for part in (head, tail):
        h = xxhash.xxh64_intdigest(xxhash.xxh64_intdigest(part, 42).to_bytes(8, "little"), h)
    return h


def test_few_words_are_enough_only_where_the_edits_are(spark):
    """Never told of strings further apart than the bound, and told of most lines with other words."""
    rnd = random.Random(24)
    rows = []
    for i in range(400):
        x = ["".join(rnd.choice("abcé") for _ in range(rnd.randint(0, 6))) for _ in range(rnd.randint(1, 40))]
        y = list(x)
        for _ in range(rnd.randint(0, 6)):
            k = rnd.randrange(len(y))
            if i % 2:
                y[k] = "".join(rnd.choice("xyz") for _ in range(rnd.randint(0, 6)))
            else:
                y[k:k + 1] = rnd.choice([[], ["q"], ["u", "v"]]) or ["w"]
        rows.append((" ".join(x), " ".join(y), rnd.randint(0, 30)))
    df = spark.createDataFrame(rows, "x string, y string, most int")
    out = df.select("x", "y", "most", m._few_words(F.col("x"), F.col("y"), F.col("most")).alias("few"), F.levenshtein("x", "y").alias("d")).collect()
    assert all(r.d <= r.most for r in out if r.few)
    near = [r.few for r in out if r.d <= r.most and len(re.findall(" ", r.x)) == len(re.findall(" ", r.y))]
    assert len(near) > 50 and sum(near) > 0.6 * len(near)
