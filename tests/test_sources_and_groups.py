"""Strategies of sources, merged counters, conditions of groups as text, the mode, and duplicate groups."""

import random
import time

import pytest
from pyspark.sql import functions as F

from relspark.functions import rows as rw
from relspark.functions import strategies as st
from relspark.operators import counters, filters, ranking, statistics
from relspark.operators import resolution as rs
from relspark.plans import sel

RAW = "source_id string, name string, title string, url string, infoHash string, hint_filename string, hint_folder string, hint_size double, hint_folder_size string, binge_group string"


def read(spark, rows, strategies=st.STRATEGIES, services=(("svc_a", "[SA"),)):
    full = [tuple(r.get(c.split()[0]) for c in RAW.split(", ")) for r in rows]
    sources = spark.createDataFrame([("f", "first_line_folder"), ("a", "arrow_folder"), ("b", "boxed_lines"), ("s", "store"), ("u", "usenet"), ("t", "labelled"), ("x", "no such")], "source_id string, strategy string")
    raw = spark.createDataFrame([(*r, n) for n, r in enumerate(full)], RAW + ", n int")
    got = st.source_rows(raw, sources, services, dict(strategies) | {"labelled": st.tagged("svc_t")})
    return {r.n: r for r in got.collect()}


def test_each_kind_reads_in_its_own_way(spark):
    h = "ab" * 20
    got = read(
        spark,
        [
            {"source_id": "none", "name": "[SA+] x", "title": "Show.S01E02.mkv\n👤 5 💾 2 GB 🌐 Site 1h", "url": f"http://a/{h}/b"},
            {"source_id": "f", "title": "The Pack\nShow.S01E02.mkv", "url": "https://h/resolve/svc/key/hash/name/7/file.mkv"},
            {"source_id": "f", "title": "Show.S01E02\nShow.S01E02.mkv", "url": "https://h/7/file.mkv"},
            {"source_id": "a", "title": "📂 Pack ┈➤ Show S01E02 mkv\n💾 1 GB / 💾 9 GB\n🔗 Site"},
            {"source_id": "a", "title": "🚫 Streams Found\n⚙️ Filtered 3"},
            {"source_id": "a", "title": "Content Warning: no", "infoHash": "z"},
            {"source_id": "b", "name": "Yours", "title": "📦 2 GB\nSome-\nName.mkv"},
            {"source_id": "b", "name": "Cast", "title": "Pick a file"},
            {"source_id": "s", "name": "Usenet", "title": "a", "binge_group": f"g|{h}"},
            {"source_id": "s", "name": "Store", "title": "a", "binge_group": f"g|{h.upper()}", "url": "http://x"},
            {"source_id": "u", "title": "a", "url": "http://x"},
            {"source_id": "t", "name": "Instant", "title": "a\nSize 1 GB | Age: 3d\nSource: Two"},
            {"source_id": "x", "title": "invalid user apikey"},
            {"source_id": None, "title": None, "url": "http://x/y.m3u8", "hint_filename": "F.mkv", "hint_size": 1.6, "hint_folder": "f", "hint_folder_size": "2"},
        ],
    )
    assert 4 not in got and len(got) == 13
    r = got[0]
    assert (r.filename, r.size, r.indexer, r.service.id, r.service.cached, r.duration, r.type, r.seeders, r.info_hash) == ("Show.S01E02.mkv", 2 * 2**30, "Site 1h", "svc_a", True, 3_600_000, "debrid", 5, h)
    assert r.bitrate == round(2 * 2**30 * 8 / 3600)
    assert (got[1].folder, got[1].file_index) == ("The Pack", 7)
    assert (got[2].folder, got[2].file_index) == (None, None)  # the folder says the same as the file, whatever its ending
    assert (got[3].folder, got[3].filename, got[3].folder_size, got[3].indexer) == ("Pack", "Show.S01E02.mkv", 9 * 2**30, "Site")
    assert got[5].failure == "Content Warning: no" and got[5].filename is None and got[5].type is None
    assert (got[6].filename, got[6].library, got[6].message) == ("Some Name.mkv".replace(" ", ""), True, None)
    assert (got[7].filename, got[7].library, got[7].message) == (None, False, "Cast - Pick a file")
    assert (got[8].type, got[8].info_hash) == ("usenet", None) and (got[9].type, got[9].info_hash) == ("http", h)
    assert got[10].type == "usenet"
    assert (got[11].service.id, got[11].service.cached, got[11].age, got[11].indexer) == ("svc_t", True, 72.0, "Two")
    assert got[12].failure == "Invalid account or apikey or token"
    assert (got[13].filename, got[13].size, got[13].folder, got[13].folder_size, got[13].type) == ("F.mkv", 2, None, None, "live")


def test_counters_merge(spark):
    kind = "total string, batch int, rows long, largest long, classes map<string,long>, samples map<string,array<string>>"
    rows = [
        ("a", 2, 5, 9, {"x": 1, "y": 2}, {"r": ["3", "4"], "q": []}), ("a", 1, None, 4, {"y": 5}, {"r": ["1", "2"]}), ("a", 3, 1, None, None, None),
        (None, 1, 7, 1, {}, {"r": ["9"]}),
    ]
    df = spark.createDataFrame(rows, kind)
    got = {r.total: r for r in counters.merge_counters(df, ["total"], ["rows"], ["classes"], ["samples"], "batch", 3, ["largest"]).collect()}
    assert (got["a"].rows, got["a"].largest, got["a"].batches, got["a"].classes, got["a"].samples) == (6, 9, 3, {"x": 1, "y": 7}, {"r": ["1", "2", "3"]})
    assert (got[None].rows, got[None].classes, got[None].samples) == (7, {}, {"r": ["9"]})
    assert counters.merge_counters(df.limit(0), ["total"], ["rows"], ["classes"]).count() == 0


def test_mode_of_a_large_request(spark):
    rnd = random.Random(1)
    values = [rnd.choice([1.0, 2.0, 3.0, None]) for _ in range(100_000)]
    seen, best, want = {}, 0, None
    for v in values:
        if v is not None:
            seen[v] = seen.get(v, 0) + 1
            if seen[v] > best:
                best, want = seen[v], v
    df = spark.createDataFrame([("r", k, v) for k, v in enumerate(values)] + [("empty", 0, None)], "request_id string, pos int, seeders double").coalesce(1)
    began = time.time()
    got = {r.request_id: r.m for r in df.select("request_id", sel.compile_value("mode(values(streams, 'seeders'))", df).alias("m")).distinct().collect()}
    assert got == {"r": want, "empty": 0.0} and time.time() - began < 60


def test_conditions_of_groups_as_text(spark):
    rows = spark.createDataFrame([(1, k, g, t, c) for k, (g, t, c) in enumerate([(0, 5, True), (0, 7, False), (1, 9, True), (2, 1, None), (3, 4, True)])], "request_id int, pos int, group_no int, elapsed int, cached boolean")
    found = lambda *texts, sequential=True: sorted(r.group_no for r in rs.fetched_groups(rows, [None, *[t and sel.group_condition(t, rows, query_type="movie") for t in texts]], sequential).collect())
    assert found("count(totalStreams) == 2", "count(previousStreams) == 1", "count(cached(totalStreams)) > 2") == [0, 0, 1, 2]
    assert found("totalTimeTaken == 7 and previousGroupTimeTaken == 7 and queryType == 'movie'", "totalTimeTaken == 16", "previousGroupTimeTaken == 1") == [0, 0, 1, 2, 3]
    assert found("count(cached(previousStreams)) > 1", "true") == [0, 0]
    assert found(None, "count(totalStreams)", "0", sequential=False) == [0, 0, 2]
    for bad in ("count(streams) > 1", "nothing(totalStreams)", "count(totalStreams", "queryTypes == 'x'"):
        with pytest.raises(sel.SelError):
            sel.group_condition(bad, rows)


def test_duplicate_groups_of_long_chains(spark):
    rnd = random.Random(2)
    chain = list(range(300))
    rnd.shuffle(chain)
    rows = [(1, p, [f"k{at}", f"k{at + 1}"]) for p, at in enumerate(chain)]
    rows += [(2, p, rnd.sample([f"x{k}" for k in range(60)], rnd.choice([0, 1, 2, 2]))) for p in range(80)] + [(None, 5, ["a"]), (None, 3, ["a", None]), (3, 7, None), (3, 8, [None])]
    root = {}
    for request in {r[0] for r in rows}:
        mine = {p: set(ks or []) - {None} for r, p, ks in rows if r == request}
        label = {p: p for p in mine}
        changed = True
        while changed:
            changed = False
            for p in mine:
                for q in mine:
                    if mine[p] & mine[q] and label[q] < label[p]:
                        label[p], changed = label[q], True
        root |= {(request, p): x for p, x in label.items()}
    df = spark.createDataFrame(rows, "request_id int, pos long, keys array<string>")
    out = ranking.duplicate_groups(df, "request_id", "pos", "keys")
    assert {(r.request_id, r.pos): r.dup_group for r in out.collect()} == root and out.count() == len(rows)
    assert "Python" not in out._jdf.queryExecution().executedPlan().toString() and "Pandas" not in out._jdf.queryExecution().executedPlan().toString()


def test_content_support_names_and_kinds(spark):
    rows = [(1, 0, "movie", True, "Plain")] * 3 + [(1, 0, "Movies ", True, "Tokyo")] + [(2, 0, "movie", True, "a"), (2, 0, "series", False, "eztv"), (2, 0, "x", True, "EZTV"), (2, 0, "x", True, "EZTV")]
    df = spark.createDataFrame(rows, "source int, service int, kind string, hit boolean, name string")
    got = {r.source: r for r in statistics.content_support(df, "source", "service", "kind", F.col("hit"), F.lit(True), "name").collect()}
    # Both names of the kind count; the name of most probes hints, not the smallest.
    assert (got[1].movies, got[1].series, got[1].anime, got[1].kinds) == (pytest.approx(0.9), 0.0, 0.0, ["movies"])
    assert (got[2].movies, got[2].series, got[2].kinds) == (pytest.approx(0.45), pytest.approx(0.25), ["movies"])


def test_names_join_in_any_case(spark):
    usage = spark.createDataFrame([("NYAA", 1), ("nyaa", 2), ("other", 3), (None, 4)], "name string, n int")
    known = spark.createDataFrame([("Nyaa", 7), ("nyaa", 8), ("None", 9)], "name string, id int")
    assert sorted(tuple(r) for r in statistics.named_usage(usage, known, "name", "id").select("n", "known_name", "id").collect()) == [(1, "nyaa", 8), (2, "nyaa", 8)]


def test_ranges_by_kind_and_class(spark):
    r, k = filters.Range, filters.KindRanges
    assert r.normalised(0, 50, 1, 50) == r(0, None) and r.normalised(1, 50, 1, 50) is None  # equality with the extreme, not beyond
    rows = spark.createDataFrame(
        [(1, "movie", False, "1080p", 5, 5.0), (2, "movie", True, "720p", 5, 5.0), (3, "series", True, "1080p", 5, 0.0), (4, "series", False, "1080p", 0, None), (5, "series", True, None, 5, 9.0)],
        "id int, request_type string, is_anime boolean, resolution string, size int, bitrate double",
    )
    found = lambda **p: {x.id for x in filters.decide(rows.withColumns({"type": F.lit("http"), "filename": F.lit("f")}), filters.Profile(**p)).where("not keep").collect()}
    assert found(kind_size=k(movies=r(low=9))) == {1, 2}
    assert found(kind_sizes={"720p": k(movies=r(low=1))}, kind_size=k(movies=r(low=9))) == {1}
    assert found(kind_size=k(series=r(low=9))) == {3, 5}  # anime without a range of its own takes that of series; size 0 is unknown
    assert found(kind_size=k(series=r(low=9), anime=r(low=1))) == set()
    assert found(kind_sizes={"1080p": k(series=r(high=1))}, kind_size=k(anime=r(low=1))) == set()  # the general anime range stands before the resolution's series
    assert found(kind_bitrate=k(series=r(low=0, high=0))) == {5} and found(kind_bitrate=k(series=r(low=1))) == {3}


def test_patterns_look_at_indexers_and_folders(spark):
    rows = spark.createDataFrame([(1, "f", "Bad", "x"), (2, "f", "ok", "bad"), (3, "f", "ok", None)], "id int, filename string, indexer string, folder_name string").withColumn("release_group", F.lit(None).cast("string"))
    assert {r.id for r in filters.decide(rows, filters.Profile(exclude_patterns=("(?i)bad",))).where("keep").collect()} == {3}


def test_texts_of_a_row_are_read_once(spark):
    raw = spark.createDataFrame([("f", "a", "b")], "source_id string, name string, title string")
    sources = spark.createDataFrame([("f", "first_line_folder")], "source_id string, strategy string")
    plan = st.source_rows(raw, sources, [], st.STRATEGIES | {"labelled": st.tagged("svc_t")})._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(r"\d+h(?:") == 1  # the duration
    assert plan.count("[KMGT]i?B") == 3  # the size by the text and by the name, the folder's size by the text
    assert plan.count("instr(") == 6  # file and folder are cut out of the text for the size; the units of these sizes and of the hint's


def test_text_behind_a_mark_by_its_plain_pattern(spark):
    rnd = random.Random(3)
    signs = ["🌐", "⚙️", "🔗", "👤", "💾", "\n", "\r", "\r\n", "\u0085", " ", " ", "⌚", "⌙", "⌜", "☁️", "\U0001f1e6", "a", "b c", " ", "\t", "é", "中", "𝔘", "\x00"]
    df = spark.createDataFrame([("".join(rnd.choices(signs, k=rnd.randint(0, 9))),) for _ in range(4000)] + [(None,)], "t string")
    pattern = rf"(?:{'|'.join(rw.INDEXER_MARKS)})\s*([^{rw._EMOJI}\n]*?)(?=[{rw._EMOJI}]|$|\n)"
    plain = F.when(F.col("t").rlike(pattern), F.trim(F.regexp_extract("t", pattern, 1)))
    assert df.where(~rw.text_behind(F.col("t"), rw.INDEXER_MARKS).eqNullSafe(plain)).count() == 0
