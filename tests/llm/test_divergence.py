"""The source divergence audit against one loop for each group and term, and on its edges."""

import random
import re
from collections import Counter

import duckdb
from pyspark.sql import functions as F

from relspark.llm import divergence

DOC = "doc_id long, lang string, source string, text string"


def brute(rows, least, top):
    docs = [(lang or "", source or "", re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))) for _, lang, source, text in rows]
    out = []
    for lang in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == lang]
        held = Counter(t for _, _, ws in mine for t in set(ws))
        kept = [t for t, n in held.items() if n >= least]
        every = Counter(t for _, _, ws in mine for t in ws)
        counts = {s: Counter(t for _, source, ws in mine if source == s for t in ws) for s in {d[1] for d in mine}}
        p = {}
        for name, c in [*counts.items(), (None, every)]:
            total = sum(c[t] for t in kept)
            p[name] = {t: 1 + 10**9 * (c[t] + 5) // (total + 5 * len(kept)) for t in kept}
        for s in counts:
            pairs = [(-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode(), o) for o in counts if o != s]
            terms = [(p[None][t] - p[s][t], t.encode(), t) for t in kept if counts[s][t] and p[s][t] > p[None][t]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                out += [(lang, s, part, item, -value, k + 1) for k, (value, _, item) in enumerate(found)]
    return sorted(out)


def found(df, **options):
    return sorted(tuple(r) for r in divergence.audit(df, **options).collect())


def test_matches_brute_force(spark):
    rnd = random.Random(1)
    words = ["the", "The", "É", "é", "中文", "a1b", "x_y", "𝔘n", "İ", "co-op", "A\x00B", "ZZ", "éa", "z"]
    rows = [(k, rnd.choice(["en", "de", None, ""]), rnd.choice(["s0", "s0", "s0", "s1", "é", "z", None]), " ".join(rnd.choices(words, k=rnd.randint(0, 12)))) for k in range(300)]
    rows += [(1, "xx", "only", "alone"), (1, "yy", "b", ""), (None, "yy", "a", None), (2, "yy", "b", ""), (3, "en", "silent", "12 34")]
    df = spark.createDataFrame(rows, DOC).repartition(3)
    assert found(df, least_documents=5, top=4) == brute(rows, 5, 4)
    assert found(df, least_documents=1000) == brute(rows, 1000, 50)


def test_ties_go_by_the_bytes_of_the_item(spark):
    rows = [(k, "en", s, t) for k, (s, t) in enumerate([("a", "z é 中"), ("b", "q"), ("c", "q")])]
    got = found(spark.createDataFrame(rows, DOC), least_documents=1)
    assert [r[3] for r in got if r[1] == "a" and r[2] == "term"] == ["z", "é", "中"]
    assert [(r[3], r[5]) for r in got if r[1] == "a" and r[2] == "pair"] == [("b", 1), ("c", 2)]


def test_edges(spark):
    df = spark.createDataFrame([(1, "en", "s", "w " * 700_000 + "end"), (1, "en", "s", "w"), (2, "en", "t", "w")], DOC)
    clash = df.withColumns({"term": F.lit(1), "n": F.lit("n"), "p": F.lit(0.5), "counts": F.lit(2), "part": F.lit("x"), "total": F.lit("y"), "deal": F.lit(0)})
    expected = brute([(1, "en", "s", "w " * 700_001 + "end"), (2, "en", "t", "w"), (2, "en", "t", "")], 1, 50)
    got = found(clash, least_documents=1)
    assert [r[:4] for r in got] == [r[:4] for r in expected] and got == found(df, least_documents=1)
    assert found(df.limit(0)) == []
    assert found(df) == [("en", "s", "pair", "t", 0, 1), ("en", "t", "pair", "s", 0, 1)]


def test_pieces_cut_between_terms(monkeypatch):
    monkeypatch.setattr(divergence, "PIECE", 7)
    text = "Ab cdÉ\tefghijklmnop q\x00r-s " * 9
    assert [w.decode() for ws in divergence._pieces(text) for w in ws] == ["ab", "cdÉ", "efghijklmnop", "q", "r", "s"] * 9


def test_registered_query_is_its_sql(spark):
    con = duckdb.connect()
    con.execute("CREATE VIEW documents AS SELECT * FROM '/root/testdata/sf0.001/documents.parquet'")
    want = sorted(con.execute(divergence.ORACLE_SQL).fetchall())
    assert want and sorted(tuple(r) for r in divergence.op11_source_divergence(spark, "/root/testdata/sf0.001").collect()) == want
