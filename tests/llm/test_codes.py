"""Vector codes against every distance in Python integers, the lower bounds, and the edges."""

import hashlib
import math
import random

import duckdb
import numpy as np
from pyspark.sql import functions as F

from relspark.llm import codes

ROW = "vec_id long, embedding array<double>, label int"


def brute(rows, parts=8, entries=16, rounds=6):
    """One length of vectors, everything in Python integers."""
    kept = [(i, [math.floor(4096 * x) if abs(x) < 1e300 else 4096 * int(x) for x in v], label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    edges = codes.cuts(len(kept[0][1]), parts)
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    books = [[r[1][a:b] for r in first] for a, b in edges]
    near = lambda v, p: min((sum((x - y) ** 2 for x, y in zip(v, e, strict=True)), k) for k, e in enumerate(books[p]))
    for _ in range(rounds):
        for p, (a, b) in enumerate(edges):
            groups = {}
            for _, v, _ in kept:
                groups.setdefault(near(v[a:b], p)[1], []).append(v[a:b])
            for k, vs in groups.items():
                books[p] = [*books[p][:k], [sum(c) // len(vs) for c in zip(*vs, strict=True)], *books[p][k + 1 :]]
    digest = hashlib.sha256(",".join(str(x) for p in books for e in p for x in e).encode()).hexdigest()
    out, errors = [], {}
    for i, v, label in kept:
        found = [near(v[a:b], p) for p, (a, b) in enumerate(edges)]
        error = sum(d for d, _ in found)
        errors[label] = errors.get(label, 0) + error
        out.append((i, "".join(f"{k:02x}" for _, k in found), error, label))
    top = 2**63 - 1
    return sorted(((i, c, min(e, top), min(errors[label], top), digest) for i, c, e, label in out), key=repr)


def found(df):
    return sorted((tuple(r) for r in codes.compress(df).collect()), key=repr)


def test_matches_brute_force(spark):
    rng, rnd = np.random.default_rng(1), random.Random(1)
    base = rng.standard_normal((9, 16))
    rows = [(3 * k % 401, [float(x) for x in np.float32(base[k % 9] + rng.standard_normal(16) * rnd.choice([0, 0.1, 1]))], rnd.choice([1, 1, 2, None])) for k in range(300)]
    rows += [(9, rows[5][1], 2), (9, rows[5][1], 2), (None, rows[6][1], None), (500, None, 1), (501, [1.0, None] * 8, 1), (502, [float("nan")] * 16, 1), (0, [float("-inf")] * 16, None), (503, [0.0] * 16, 3)]
    df = spark.createDataFrame(rows, ROW).repartition(3)
    assert found(df) == brute(rows)
    clash = df.withColumns({"vec": F.lit(1), "code": F.lit("c"), "error": F.lit(2), "of": F.lit(3), "part": F.lit(4), "label_error": F.lit(5)})
    assert found(clash) == brute(rows)


def test_values_beyond_a_long_and_few_vectors(spark):
    rows = [(k, [1e200 * k, -3e15, 2.5e9 * k, 0.1, 1e306, -1e-300, 7.0, float(k)], 1) for k in range(5)]
    assert found(spark.createDataFrame(rows, ROW)) == brute(rows)
    one = [(4, [0.25] * 11, None)]
    assert found(spark.createDataFrame(one, ROW)) == brute(one)
    assert codes.compress(spark.createDataFrame([], ROW)).count() == 0


def test_lengths_have_codebooks_of_their_own(spark):
    rng = np.random.default_rng(2)
    long, short = ([(k + base, rng.standard_normal(n).tolist(), 1) for k in range(40)] for base, n in ((0, 16), (100, 8)))
    got = codes.compress(spark.createDataFrame([*long, *short, (200, [], 2)], ROW)).collect()
    for rows in (long, short):
        ids = {i for i, *_ in rows}
        assert sorted((r.vec_id, r.code, r.error, r.codebooks_sha256) for r in got if r.vec_id in ids) == [(i, c, e, h) for i, c, e, _, h in sorted(brute(rows))]
    assert [(r.code, r.error) for r in got if r.vec_id == 200] == [("00" * 8, 0)]


def test_bounds_rule_out_most_and_never_the_nearest():
    rng = np.random.default_rng(3)
    for spread in (1, 30, 5000, 1 << 22, 1 << 40):
        x, entries = (rng.integers(-spread, spread + 1, (n, 8)) for n in (400, 16))
        entries[5], x[:16], x[16:32] = entries[2], entries, entries + 1
        index, error, done = codes.nearest(x, entries)
        every = [[sum((int(a) - int(b)) ** 2 for a, b in zip(v, e, strict=True)) for e in entries] for v in x]
        assert index.tolist() == [min((d, k) for k, d in enumerate(row))[1] for row in every]
        assert [int(e) for e in error] == [min(row) for row in every] and done <= 400 * 16
    centres = rng.integers(-4000, 4000, (16, 8))
    _, _, done = codes.nearest(centres[rng.integers(0, 16, 2000)] + rng.integers(-200, 200, (2000, 8)), centres)
    assert done < 2000 * 3


def test_registered_query_is_its_sql(spark):
    con = duckdb.connect()
    con.execute("CREATE VIEW embeddings AS SELECT * FROM '/root/testdata/sf0.001/embeddings.parquet'")
    want = sorted(con.execute(codes.oracle_sql()).fetchall())
    assert want and sorted(tuple(r) for r in codes.op13_vector_codes(spark, "/root/testdata/sf0.001").collect()) == want
