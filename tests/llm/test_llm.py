"""Operators of the training-data package against brute force on small tables, with their edge cases."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from relspark.llm import components, embeddings, language, licenses, minhash, packing, pieces, pii, quality, substrings, toxicity

SF = "/root/testdata/sf0.001"
DOC = "doc_id long, text string"


def rows_of(spark, rows):
    return spark.createDataFrame(rows, DOC)


@pytest.fixture(scope="module")
def corpus(spark):
    return [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]


EDGES = [(1, None), (2, ""), (3, " \n\t"), (4, "x"), (5, "word " * 4000), (6, "word " * 4000), (None, "no id here"), (7, "é 中 𝔘 ▁▁ \x00"), (7, "é 中 𝔘 ▁▁ \x00")]


def crossed(spark, rows):
    """The rows with extra columns whose names the operators use inside."""
    extra = {"row": F.lit(1), "pack": F.lit("p"), "sig": F.lit(2.5), "n_words": F.lit("n"), "kept": F.lit(False), "label": F.lit(0), "score": F.lit(None).cast("double"), "words": F.lit("w"), "lang": F.lit("en"), "source": F.lit("s"), "n_chars": F.length("text").cast("long")}
    return rows_of(spark, rows).withColumns(extra)


def test_edges_do_not_crash(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for rows in (EDGES, []):
        docs = crossed(spark, rows)
        assert quality.score(docs, quality.train(docs, none), ["doc_id"]).count() == len(rows)
        assert toxicity.score(docs, toxicity.train(docs, none)).count() == len(rows)
        assert language.identify(docs, language.train(docs)).count() == len(rows)
        assert pii.find_pii(docs).count() == pii.redact(docs).count() == len(rows)
        assert pieces.digests(docs).count() == pieces.encode(docs).count() == len(rows)
        assert packing.pack(packing.tokenize(docs)).select("doc_id").distinct().count() == len({d for d, _ in rows})
        assert licenses.scan(docs).count() == len(rows)
        assert minhash.near_duplicates(docs).count() == len(rows)
        assert substrings.remove_repeats(docs).count() == len(rows)


def test_stages_keep_columns_and_rows(spark):
    docs = crossed(spark, EDGES)
    kept = substrings.suffix_stage(spark, docs, SF)
    assert kept.columns == docs.columns and kept.count() == len(EDGES)
    assert kept.where("doc_id is null").first().text == "no id here"
    assert minhash.neardup_stage(spark, docs, SF).columns == docs.columns
    assert quality.quality_stage(spark, docs, SF).columns == docs.columns
    assert pii.pii_stage(spark, docs, SF).columns == docs.columns


def test_stage_decides_rows_of_repeated_and_null_ids_by_their_texts(spark):
    a, b, c = (" ".join(f"{x}{k}" for k in range(60)) for x in "abc")
    rows = [(7, a), (7, b), (7, b), (9, a + " end"), (3, c), (None, c + " end"), (None, "alone " * 3), (None, "alone " * 3), (5, ""), (5, ""), (5, None), (6, ""), (None, ""), (None, "")]
    got = [tuple(r) for r in minhash.neardup_stage(spark, rows_of(spark, rows), SF).collect()]
    expected = [(7, a), (7, b), (3, c), (None, "alone " * 3), (5, ""), (5, None), (6, ""), (None, ""), (None, "")]
    assert sorted(got, key=repr) == sorted(expected, key=repr)


def test_components(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, 101), (101, 100), (5, 5), (None, 3)] + [(1000, k) for k in range(1001, 1100)]
    got = {r.node: r.component for r in components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(1, 41)} | {101: 100} | {k: 1000 for k in range(1001, 1100)}


def test_embeddings_match_brute_force(spark):
    rng = np.random.default_rng(1)
    base = rng.standard_normal((30, 16))
    rows = []
    for k in range(200):
        v = base[k % 30] + rng.standard_normal(16) * 0.05 if k % 2 else rng.standard_normal(16)
        rows.append((k, [float(x) for x in v], int(k % 3)))
    rows += [(200, rows[1][1], 1), (201, rows[1][1], 2), (202, [0.0] * 16, 1), (203, None, 1), (204, [float("nan")] * 16, 1), (205, [1.0, None], 1), (206, rows[1][1], None), (207, [], 1), (208, [x * 1e200 for x in rows[1][1]], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embeddings.near_duplicates(df).collect()}
    good = {i: (np.array(v) / np.abs(v).max(), l) for i, v, l in rows if v and None not in v and np.isfinite(v).all() and any(v) and l is not None}
    links = {i: set() for i, *_ in rows}
    for i, (v, l) in good.items():
        for j, (w, m) in good.items():
            if i < j and l == m and v @ w / np.sqrt((v @ v) * (w @ w)) >= 0.93:
                links[i].add(j), links[j].add(i)
    for i in links:
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()] - seen:
                seen.add(j), todo.append(j)
        assert got[i] == (len(links[i]), min(seen), i == min(seen))


def test_embeddings_of_a_concentrated_label_miss_nothing(spark):
    """One topic cone at mutual cosine 0.8: hyperplane signs agree for nearly all vectors, so passes miss planted pairs."""
    rng = np.random.default_rng(3)
    unit = lambda x: x / np.linalg.norm(x, axis=-1, keepdims=True)
    topic = unit(rng.standard_normal(64))
    base = unit(np.sqrt(0.8) * topic + np.sqrt(0.2) * unit(rng.standard_normal((3000, 64))))
    turn = rng.standard_normal((3000, 64))
    turn = unit(turn - (turn * base).sum(axis=1, keepdims=True) * base)
    vectors = np.concatenate([base, 0.931 * base + np.sqrt(1 - 0.931**2) * turn])
    df = spark.createDataFrame([(k, v.tolist(), 1) for k, v in enumerate(vectors)], "vec_id long, embedding array<double>, label int")
    hit = vectors @ vectors.T >= 0.93
    expected = hit.sum(axis=1) - 1
    for options in ({}, {"passes": 1, "window": 1}):
        got = embeddings.near_duplicates(df, **options).toPandas().set_index("vec_id").sort_index()
        assert got.n_links.tolist() == expected.tolist()
        root = got.component_id.to_numpy()
        a, b = np.nonzero(hit)
        assert (root[a] == root[b]).all() and got.kept.sum() == len(set(root))


def test_embedding_labels_keep_their_type_and_empty_tables(spark):
    v, w = [1.0, 0.0], [0.999, 0.01]
    for kind, a, b in (("double", 1.2, 1.7), ("string", "x", "y"), ("boolean", True, False)):
        rows = [(1, v, a, 0), (2, w, a, 0), (3, v, b, 0), (4, v, None, 0), (4, v, None, 0)]
        df = spark.createDataFrame(rows, f"vec_id long, embedding array<double>, label {kind}, key int").withColumns({"rep": F.lit("r"), "code": F.lit(0), "n": F.lit(9), "component": F.lit("c")})
        got = sorted(tuple(r) for r in embeddings.near_duplicates(df).collect())
        assert got == [(1, 1, 1, True, 1), (2, 1, 1, False, 1), (3, 0, 3, True, 1), (4, 0, 4, True, 1), (4, 0, 4, True, 1)]
        assert embeddings.near_duplicates(df.limit(0)).count() == 0
    zeros = spark.createDataFrame([(1, v, 0.0), (2, v, -0.0)], "vec_id long, embedding array<double>, label double")
    assert {r.component_id for r in embeddings.near_duplicates(zeros).collect()} == {1}


def test_passes_alone_find_planted_pairs():
    """Windows over codes accept no pair below the threshold and nearly all planted ones of a label of 20 000."""
    import pyarrow as pa

    rng = np.random.default_rng(9)
    unit = lambda x: x / np.linalg.norm(x, axis=-1, keepdims=True)
    base = unit(rng.standard_normal((10_000, 64)))
    turn = rng.standard_normal((10_000, 64))
    turn = unit(turn - (turn * base).sum(axis=1, keepdims=True) * base)
    vectors = np.concatenate([base, 0.96 * base + np.sqrt(1 - 0.96**2) * turn])
    flat = pa.FixedSizeListArray.from_arrays(pa.array(vectors.ravel()), 64).cast(pa.list_(pa.float64()))
    batch = pa.RecordBatch.from_arrays([pa.array(["1"] * len(vectors)), pa.array(np.full(len(vectors), 64, np.int32)), pa.array(np.arange(len(vectors))), flat], names=["label", "dim", "rep", "vec"])
    found = set()
    for rows in embeddings._keyed(embeddings.PASSES, 20)(iter([batch])):
        rows = pa.Table.from_batches([rows]).sort_by("key")
        a, b = embeddings._window_links(rows, embeddings.WINDOW, embeddings.THRESHOLD)
        rep = np.asarray(rows.column("rep"))
        found |= set(zip(np.minimum(rep[a], rep[b]).tolist(), np.maximum(rep[a], rep[b]).tolist(), strict=True))
    assert all(vectors[i] @ vectors[j] >= 0.93 for i, j in found)
    assert len(found & {(k, k + 10_000) for k in range(10_000)}) > 9_900


def test_account_values_are_masked_whole():
    automaton = pii.anchors()
    key = "Zm9v.YmFy/" * 9 + "q+Q="
    for cue, value in (("API key", "abc123x"), ("API_key", "abc123x"), ("User ID", "jane_doe"), ("pAsSwOrD", "hunterhunter"), ("token", key), ("\u0130 Secret", "abc123x"), ("IBAN", "DE44500105175407324931")):
        for mark in (": ", "=", '          :          "'):
            assert pii._redacted(f"the {cue}{mark}{value}. End", automaton) == f"the {cue}{mark}[ACCOUNT]. End"
    for plain in ("account: savings", "secret 123456", "broken: 1234567", "token: ab12"):
        assert pii._redacted(plain, automaton) == plain


def test_text_in_four_languages_has_four():
    logs = np.full((400, 5), -12.0)
    logs[np.arange(400), np.arange(400) % 4] = -2.0
    share, size = language.mixture(logs, np.array([0, 400]))
    assert size.tolist() == [4] and np.allclose(share[0], [0.25] * 4 + [0.0], atol=1e-3)


def brute_pii(t):
    kinds = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
    out = []
    for k, (kind, rx) in enumerate(kinds.items()):
        for m in re.finditer(rx, t):
            digits = re.sub("[^0-9]", "", m[0])
            total = sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(digits[::-1]))
            if kind == "ip" and max(map(int, m[0].split("."))) > 255 or kind == "card" and (not 14 <= len(digits) <= 19 or total % 10) or kind == "phone" and not 10 <= len(digits) <= 15:
                continue
            out.append((m.start(), k, m.end()))
    return sorted(out)


def test_pii_matches_the_patterns(corpus):
    rnd, a = random.Random(1), pii.anchors()
    parts = ["a.b", "@", "x", ".", "com", "12", "255", "1.2.3.4", "4111111111111111", " ", "-", "+1 ", "(555) ", "555-1234", "+", "..", "256", "%", "\n", "é", "5500-0000 0000 0004", "https://a.b/c", 'token = "ab12cd34"']
    for t in ["".join(rnd.choices(parts, k=rnd.randint(0, 12))) for _ in range(4000)] + [t for _, t in corpus]:
        assert [s for s in pii.find(t, a) if s[1] < 4] == brute_pii(t)
    assert pii._redacted('mail a@b.co, token = "ab12cd34"', a) == 'mail [EMAIL], token = "[ACCOUNT]"'


def test_sentencepiece_is_the_library(corpus):
    import public_tokenizers
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    sp, model = sentencepiece.SentencePieceProcessor(model_file=path), pieces.PieceModel(path)
    rnd, encoder = random.Random(2), pieces.Encoder(model)
    parts = ["a", "the", "er", " ", "  ", "▁", "\n", "é", "中", "𝔘", "ing", "\t", "\0", "<s>", "<0x0A>", "aaaa", "=====", "    ", "22", "İ", "�", "⁇"]
    cases = ["".join(rnd.choices(parts, k=rnd.randint(0, 25))) for _ in range(4000)] + [" " * 900 + "x", "a" * 3000, "the" * 400, ""] + [t for _, t in corpus]
    for t, (ids, text) in zip(cases, encoder.encode([encoder.split(t) for t in cases]), strict=True):
        want = sp.encode(t, add_bos=True, add_eos=True)
        assert np.frombuffer(ids, "<u4").tolist() == want
        assert text.decode() == sp.decode(want) == model.decode(want)


def test_long_units_of_a_batch_merge_together():
    import public_tokenizers
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    sp, model = sentencepiece.SentencePieceProcessor(model_file=path), pieces.PieceModel(path)
    rnd = random.Random(7)
    # Letters, repeats whose merges open pairs of the same rank, digits, other scripts; lengths on both sides of the switch.
    letters = ["abcdefghijklmnopqrstuvwxyz", "a", "ab", "-=", "0123456789", "aéß漢字𝔘", "the"]
    lengths = [1, 2, pieces.LONG - 2, pieces.LONG - 1, pieces.LONG, pieces.LONG + 1, 700, 1500, 4000]
    words = ["".join(rnd.choices(s, k=n)) for s in letters for n in lengths] + ["x" * 1_000_001, "".join(rnd.choices("etaoinshr", k=1_000_000))]
    rnd.shuffle(words)
    for word, (ids, text) in zip(words, model.encode_units(["▁" + w for w in words]), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == sp.encode(word)
        assert text.decode() == " " + word
    assert model.encode_units([]) == []


def test_packing(spark, corpus):
    import public_tokenizers
    from tokenizers import Tokenizer

    got = packing.pack(packing.tokenize(rows_of(spark, corpus))).toPandas().sort_values(["sequence_id", "offset"])
    assert (got.groupby("sequence_id").length.cumsum() - got.length == got.offset).all() and got.groupby("sequence_id").length.sum().max() <= 2048
    assert got.sequence_id.nunique() <= -(-got.length.sum() // 2048) + 2
    t, own = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), dict(list(got.groupby("doc_id")))
    for i, text in corpus[:80]:
        ids, at = np.array([*t.encode(text, add_special_tokens=False).ids, 0], "<u4"), 0
        for k, p in enumerate(own[i].sort_values("piece").itertuples()):
            assert (p.piece, p.start, p.ids_crc32) == (k, at, zlib.crc32(ids[at : at + p.length].tobytes())) and (k == 0 or p.length == 2048)
            at += p.length
        assert at == len(ids)


def test_bin_completion():
    for seed in range(8):
        r = random.Random(seed)
        counts = collections.Counter(r.randint(1, 2048) for _ in range(r.choice([1, 40, 3000])))
        used = collections.Counter()
        found = packing.complete(counts)
        for lengths, times in found:
            assert sum(lengths) <= 2048
            for x in lengths:
                used[x] += times
        assert used == counts and sum(t for _, t in found) <= sum(t for _, t in packing.best_fit(counts, 2048))
    with pytest.raises(ValueError):
        packing.complete({4000: 1})


def repeated(rows):
    first = {}
    for i, t in rows:
        b = t.encode()
        for k in range(len(b) - 49):
            first[b[k : k + 50]] = min(i, first.get(b[k : k + 50], i))
    out = {}
    for i, t in rows:
        b = t.encode()
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - 49):
            if first[b[k : k + 50]] < i:
                gone[k : k + 50] = True
        out[i] = (len(b), int(gone.sum()), int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum()), hashlib.sha256(np.frombuffer(b, np.uint8)[~gone].tobytes()).hexdigest())
    return out


def test_suffix_dedup_matches_brute_force(spark, corpus, monkeypatch):
    rnd = random.Random(3)
    base = ["".join(rnd.choices("abé ", k=rnd.randint(40, 300))) for _ in range(30)]
    made = [(i * 3 % 311, "".join(rnd.choice(base)[rnd.randint(0, 30) : rnd.randint(60, 300)] + rnd.choice(["", "x", "yy"]) for _ in range(rnd.randint(0, 5))) if i % 17 else "a" * rnd.randint(0, 200)) for i in range(300)]
    monkeypatch.setattr(substrings, "PACK", 1 << 14)
    for rows in (made, corpus):
        got = {r.doc_id: tuple(r)[1:] for r in substrings.remove_repeats(rows_of(spark, rows)).collect()}
        assert got == repeated(rows)


def test_merged_transforms_sort_all_suffixes():
    rnd = random.Random(4)
    snippets = ["".join(rnd.choices("ab", k=rnd.randint(50, 76))).encode() for _ in range(60)]
    size = np.array([len(s) + 1 for s in snippets])
    shards = []
    for lo, hi in ((0, 25), (25, 26), (26, 60)):
        data = np.frombuffer(b"".join(s + b"\xff" for s in snippets[lo:hi]), np.uint8)
        shards.append(substrings.Shard(data, np.cumsum(size[lo:hi]) - size[lo:hi], size[lo:hi], lo))
    order, block = substrings.merge(shards)
    snippet = np.concatenate([s.snippet for s in shards])[order]
    offset = np.concatenate([s.offset for s in shards])[order]
    heads = [(snippets[s] + b"\xff")[o : o + 50] for s, o in zip(snippet, offset, strict=True)]
    whole = [(h, b) for h, b in zip(heads, block, strict=True) if len(h) == 50 and h[-1] != 255]
    assert [h for h, _ in whole] == sorted(h for h, _ in whole)
    assert len({h for h, _ in whole}) == len({b for _, b in whole})


def test_merge_carries_only_suffixes_that_lead_to_windows(monkeypatch):
    rnd = random.Random(6)
    base = "".join(rnd.choices("abcé \x00", k=400))
    snippets = sorted({("".join(rnd.choices("ab", k=rnd.randint(0, 9))) + base[(k := rnd.randint(0, 300)) : k + rnd.randint(50, 60)]).encode() for _ in range(300)} | {b"a" * n for n in (50, 51, 76)}, key=lambda s: rnd.random())
    docs = np.array([rnd.randint(0, 99) for _ in snippets])
    seen = []
    true = substrings.merge
    monkeypatch.setattr(substrings, "merge", lambda shards: seen.append((shards, true(shards))) or seen[-1][1])
    monkeypatch.setattr(substrings, "SHARD", 1 << 11)
    got = np.hstack(substrings.earliest(snippets, docs)).tolist()
    windows = [[s[k : k + 50] for k in range(len(s) - 49)] for s in snippets]
    least = {}
    for own, d in zip(windows, docs.tolist(), strict=True):
        for w in own:
            least[w] = min(d, least.get(w, d))
    assert got == [least[w] for own in windows for w in own]
    shards, (order, block) = seen[-1]
    assert len(shards) > 5 and len(order) == len(got)
    for s in shards:
        suffixes = [(snippets[k] + b"\xff")[o:] for k, o in zip(s.snippet, s.offset, strict=True)]
        assert suffixes == sorted(suffixes) and len(suffixes) == len(s.far)
    flat = [(k, o) for s in shards for k, o in zip(s.snippet.tolist(), s.offset.tolist(), strict=True)]
    heads = [snippets[k][o : o + 50] for k, o in (flat[p] for p in order)]
    assert heads == sorted(heads) and len(set(zip(heads, block.tolist(), strict=True))) == len(least) == block.max()


def shingles(t, n):
    w = t.encode().lower().split()
    return frozenset(tuple(w[k : k + n]) for k in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])


def test_packing_counts_fillings_after_the_first_descent():
    counts = {6: 2, 3: 3, 2: 4, 1: 1}
    assert sum(t for _, t in packing.best_fit(counts, 10)) == 4
    assert sum(t for _, t in packing.complete(counts, 10, nodes=1)) == 3


def test_bands_follow_the_threshold():
    for percent in (70, 80, 85, 100):
        assert (1 - (percent / 100) ** minhash.ROWS) ** minhash.bands(percent) <= minhash.MISS
    assert minhash.bands(85) == 25 and minhash.bands(minhash.STAGE_PERCENT) == 38


def test_minhash_matches_brute_force(spark, corpus):
    rnd, made = random.Random(5), list(corpus)
    words = [f"w{k}" for k in range(50)]
    for k in range(12):
        text = rnd.choices(words, k=rnd.randint(2, 120))
        for c in range(8):
            made.append((10_000 + 10 * k + c, " ".join(w if rnd.random() > 0.012 * c else rnd.choice(words) for w in text)))
    for percent, n in ((85, 3), (80, 5)):
        got = {r.doc_id: r for r in minhash.near_duplicates(rows_of(spark, made), percent, n).collect()}
        sets = {i: shingles(t, n) for i, t in made}
        links = {i: {i} for i in sets}
        for i, a in sets.items():
            for j, b in sets.items():
                if i < j and a and b and 100 * len(a & b) >= percent * len(a | b):
                    links[i].add(j), links[j].add(i)
        for i in sets:
            seen, todo = {i}, [i]
            while todo:
                for j in links[todo.pop()] - seen:
                    seen.add(j), todo.append(j)
            assert (got[i].n_shingles, got[i].component_id, got[i].kept) == (len(sets[i]), min(seen), i == min(seen))


def test_minhash_large_bucket_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 8)
    text = [f"w{k}" for k in range(200)]
    rows = [(i, " ".join([*text[: 100 + i % 9], f"x{i}", *text[100 + i % 9 :]])) for i in range(60)]
    got = minhash.near_duplicates(rows_of(spark, rows)).collect()
    assert {r.component_id for r in got} == {0}


def test_posterior_bound():
    assert [minhash.least_matches(64, 0.85, m) for m in (1e-9, 1e-5, 0.5)] == sorted(minhash.least_matches(64, 0.85, m) for m in (1e-9, 1e-5, 0.5))
    assert minhash.least_matches(64, 0.85, 1e-5) < 0.85 * 64


def test_quality_rules_match_brute_force(spark, corpus):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r.doc_id: r for r in quality.op6_quality_rules(spark, SF).collect()}
    for i, t in corpus:
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        lines = t.split("\n")
        dup = sum(1 for k, line in enumerate(lines) if re.search(r"[^\x20\x09-\x0D]", line) and line in lines[:k])
        runs = [tuple(w[k : k + 8]) for k in range(len(w) - 7)]
        n, covered = collections.Counter(runs), set()
        for k, r in enumerate(runs):
            if n[r] > 1:
                covered.update(range(k, k + 8))
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(covered))
        assert r.base_failed == (len(w) < 20 or 100 * len(covered) > 30 * len(w)) and not (r.base_failed and r.kept)
    assert docs.count() == len(got)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r.doc_id: r for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    tox = [(labels[r.doc_id].toxic, r.predicted) for r in toxicity.op2_toxicity(spark, sf).where("held_out").collect() if r.doc_id in labels]
    assert sum(a == b for a, b in tox) / len(tox) > 0.93
    good = [(labels[r.doc_id].quality, r.kept) for r in quality.op6_quality_rules(spark, sf).collect() if r.doc_id in labels and zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert sum(bool(a) == b for a, b in good) / len(good) > 0.95
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").collect()}
    said = [(langs[r.doc_id], r.lang_pred) for r in language.op5_language_id(spark, sf).where("held_out").collect()]
    assert sum(a == b for a, b in said) / len(said) > 0.98


def test_language_mixture(spark):
    model = language.train(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    rows = spark.read.parquet(f"{SF}/documents.parquet").where("length(text) > 800")
    en, fr = (rows.where(F.col("lang") == x).orderBy("doc_id").first().text[:700] for x in ("en", "fr"))
    got = {r.doc_id: r for r in language.identify(rows_of(spark, [(1, f"{en} {fr}"), (2, "123 ,."), (3, None), (4, fr)]), model).collect()}
    assert got[1].n_languages >= 2 and got[4].lang_pred == "fr" and (got[2].lang_pred, got[3].lang_pred) == ("und", "und")


def test_label_model_sees_no_labels_and_discounts_copies():
    rng = np.random.default_rng(6)
    y = rng.random(4000) < 0.3
    good = [np.where(y, rng.random(4000) < 0.8, rng.random(4000) < 0.05) for _ in range(6)]
    noise = rng.random(4000) < 0.3
    votes = np.column_stack([*good, noise, noise, noise]).astype(float)
    post, rates, corr, parent = toxicity.label_model(votes)
    assert ((post > 0.5) == y).mean() > 0.95 and corr[6, 7] > 0.9 and rates[1, 0] > 0.7 > 0.4 > rates[1, 6]
    assert sum(parent[k] in (6, 7, 8) for k in (6, 7, 8)) == 2


def test_label_model_is_expectation_maximisation():
    """Without dependent voters the posterior is a fixed point of plain EM, written out row by row."""
    rng = np.random.default_rng(7)
    y = rng.random(20_000) < 0.4
    votes = np.column_stack([np.where(y, rng.random(20_000) < a, rng.random(20_000) < b) for a, b in ((0.9, 0.1), (0.8, 0.05), (0.7, 0.2), (0.85, 0.1))]).astype(float)
    post, rates, _, parent = toxicity.label_model(votes, rounds=500)
    assert (parent == -1).all()
    prior = post.mean()
    for v, p in zip(votes[:300], post[:300], strict=True):
        odds = prior / (1 - prior)
        for k, x in enumerate(v):
            odds *= rates[1, k] / rates[0, k] if x else (1 - rates[1, k]) / (1 - rates[0, k])
        assert abs(odds / (1 + odds) - p) < 5e-3


def test_license_scan_matches_sql(spark):
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = sorted(map(str, con.execute(f"SELECT doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score FROM ({licenses.ORACLE_SQL})").fetchall()))
    assert sorted(str(tuple(r)) for r in licenses.op9_license_scan(spark, SF).collect()) == want
    text = "Licensed under CC BY-NC 4.0. " + "x " * 150 + "MIT\nLicense general public license"
    r = licenses.scan(rows_of(spark, [(1, text)])).first()
    assert (r.n_base, r.first_word, r.last_word, r.base_labels, r.labels) == (2, 157, 159, "gpl,mit", "cc-by-nc,gpl,mit")
    plan = licenses.op9_license_scan(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_pipeline(spark):
    import corpus_pipeline as cp

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    packed = cp.run(spark, SF)
    assert packed.count() > 0 and set(packed.columns) >= {"doc_id", "piece", "sequence_id", "offset"}
    assert len(cp.STAGES) == 5 and packed.select("doc_id").distinct().count() < docs.count()
