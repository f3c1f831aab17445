"""First-fit decreasing by tournament tree, the filling up, and whole packings against the tokenizer."""

import random
import time
import zlib

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from relspark.llm import treepack

DOC = "doc_id long, text string"


def plain_first_fit(lengths, capacity):
    rooms, out = [], []
    for k in sorted(range(len(lengths)), key=lambda k: -lengths[k]):
        at = next((i for i, r in enumerate(rooms) if r >= lengths[k]), len(rooms))
        if at == len(rooms):
            rooms.append(capacity), out.append([])
        rooms[at] -= lengths[k]
        out[at].append((k, 0, lengths[k]))
    return out


def test_tournament_is_first_fit():
    rnd = random.Random(1)
    for n in [0, 1, 2, 3, 7, 64, 65, 300]:
        for top in (3, 40, 64):
            lengths = [rnd.randint(1, top) for _ in range(n)]
            assert treepack.first_fit_decreasing(lengths, 64) == plain_first_fit(lengths, 64)
    began = time.time()
    treepack.first_fit_decreasing([rnd.randint(1, 1024) for _ in range(50_000)])
    assert time.time() - began < 10


def test_fill_up_leaves_no_padding_and_few_cuts():
    rnd = random.Random(2)
    for n in [0, 1, 2, 5, 100, 700]:
        lengths = [rnd.randint(1, rnd.choice([3, 64])) for _ in range(n)]
        packed = treepack.first_fit_decreasing(lengths, 64)
        done = treepack.fill_up([list(s) for s in packed], 64)
        sizes = [sum(x for _, _, x in s) for s in done]
        assert all(s == 64 or s & (s - 1) == 0 for s in sizes) and sum(s < 64 for s in sizes) <= 6
        spans = sorted(r for s in done for r in s)
        for k, x in enumerate(lengths):
            own, at = [r for r in spans if r[0] == k], 0
            for _, a, m in own:
                assert a == at and m > 0
                at += m
            assert at == x
        open_ = sum(sum(x for _, _, x in s) < 64 for s in packed)
        assert len(spans) - len(lengths) <= open_ + 6


def checked(rows, got, capacity):
    """Every id of every document lies in one piece, and sequences are gapless and need no padding."""
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    own = {i: [np.array([*t.encode(x or "", add_special_tokens=False).ids, 0], "<u4") for j, x in rows if j == i] for i in {i for i, _ in rows}}
    for i, texts in own.items():
        mine = [r for r in got if r.doc_id == i]
        assert sum(r.length for r in mine) == sum(map(len, texts))
        for r in mine:
            assert any(len(x) == r.doc_tokens and zlib.crc32(x[r.start : r.start + r.length].tobytes()) == r.ids_crc32 for x in texts)
        if len(texts) == 1:
            at = 0
            for r in sorted(mine, key=lambda r: r.start):
                assert r.start == at
                at += r.length
            assert at == len(texts[0])
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append(r)
    for pieces in sequences.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at == capacity or (at < capacity and at & (at - 1) == 0)


def test_packing_is_whole(spark):
    rnd = random.Random(3)
    rows = [(k, " ".join(rnd.choices(["alpha", "beta", "é", "中", "\n\n", "x" * 30], k=rnd.choice([0, 3, 20, 90, 400])))) for k in range(150)]
    rows += [(500, None), (501, ""), (502, "the " * 30_000), (503, " the" * 63), (7, "again"), (7, "again"), (None, "no id"), (504, "a <|endoftext|> b")]
    docs = spark.createDataFrame(rows, DOC).withColumns({"start": F.lit("s"), "length": F.lit(1), "part": F.lit("p"), "ids": F.lit(0), "deal": F.lit("d")})
    for capacity, group in ((64, 20), (1024, 2048)):
        checked(rows, treepack.pack(docs, capacity, group).collect(), capacity)
    assert treepack.pack(docs.limit(0)).count() == 0


def test_registered_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = treepack.op12_tree_packing(spark, sf).collect()
    checked(rows, got, 1024)
    assert len(got) < 1.3 * sum(-(-r.doc_tokens // 1024) for r in {x.doc_id: x for x in got}.values())
