"""Operators against plain sequential statements and small literal tables."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from relspark.functions import formatting as fm
from relspark.functions import parsing as ps
from relspark.functions import similarity as sim
from relspark.operators import filters as flt
from relspark.operators import identity as idt
from relspark.operators import maintenance as mt
from relspark.operators import ranking as rk
from relspark.operators import statistics as st
from relspark.plans import sel
from relspark.plans.template import Template
from relspark.sources import readers, sinks


def one(spark, *columns, **values):
    """Values of columns over one row."""
    rows = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()] or [F.lit(1).alias("_")])
    return tuple(rows.select(*columns).first())


def test_greedy_limit_is_sequential(spark):
    rnd = random.Random(1)
    rows = [(r, p, rnd.choice("abc"), rnd.choice(["x", "y", None])) for r in range(6) for p in range(30)]
    df = spark.createDataFrame(rows, "request_id long, place long, source_id string, resolution string")
    got = {(r.request_id, r.place) for r in rk.greedy_limit(df, {"source_id": 3, "resolution": 2}, total=5).collect()}
    want = set()
    for r in range(6):
        seen, passed = {}, 0
        for _, p, s, x in [q for q in rows if q[0] == r]:
            good = passed < 5
            if good:
                for key, most in ((("s", s), 3), (("x", x), 2)):
                    if key[1] is None:
                        continue
                    seen[key] = seen.get(key, 0) + 1
                    if seen[key] > most:
                        good = False
                        break
            if good:
                passed += 1
                want.add((r, p))
    assert got == want


def test_greedy_limit_by_windows_of_one_shuffle(spark):
    rnd = random.Random(2)
    rows = [(rnd.choice([None, 1, 2, 3]), p, rnd.choice(["a", "b", None]), rnd.choice([1.0, 2.0, float("nan"), None]), rnd.choice("xyz"), rnd.choice([True, False, False, None])) for p in range(160)]
    df = spark.createDataFrame(rows, "request_id int, place int, a string, b double, c string, free boolean")
    limits = {"a": 4, "b": 3, "c": 5}

    def walk(total, passthrough):
        for request in (None, 1, 2, 3):
            seen, passed = {}, 0
            for r in [r for r in rows if r[0] == request]:
                good = total is None or passed < total
                if good and not (passthrough and r[5]):
                    for d, value in zip("abc", r[2:5], strict=True):
                        if value is None or value != value:
                            continue
                        seen[d, value] = seen.get((d, value), 0) + 1
                        if seen[d, value] > limits[d]:
                            good = False
                            break
                if good:
                    passed += 1
                    yield r[1]

    for total in (None, 0, 6, 12):
        for passthrough in (None, "free"):
            found = rk.greedy_limit(df, limits, total, passthrough=passthrough)
            assert found.columns == df.columns
            assert sorted(r.place for r in found.collect()) == sorted(walk(total, passthrough))
    plan = rk.greedy_limit(df, limits, 6)._jdf.queryExecution().executedPlan().toString()
    assert "Pandas" not in plan and "Arrow" not in plan and plan.count("Exchange") == 1


def test_greedy_unique_only_kept_rows_add_keys(spark):
    df = spark.createDataFrame([(1, "a", "p", "t1"), (2, "a", "q", "t2"), (3, "b", "q", "t3"), (4, "c", "r", "t2")], "pos int, k string, m string, title string")
    assert [r.pos for r in rk.greedy_unique(df, ["k", "m"], "title", "pos").orderBy("pos").collect()] == [1, 3, 4]


def grouped(spark, *rows):
    """Rows (id, type, service, cached, seeders, source) of one duplicate group."""
    full = [(1, "t", k, *r) for k, r in enumerate(rows)]
    return spark.createDataFrame(full, "request_id int, title string, pos long, id string, type string, service_id string, cached boolean, seeders int, source_id string")


def kept_by(df, mode):
    return sorted(r.id for r in rk.dedup_mode(df, ["request_id", "title"], mode).collect())


def test_classes_that_drive_out_others(spark):
    c, u, u2, p, h = ("c", "debrid", "a", True, None, "s"), ("u", "debrid", "a", False, 5, "s"), ("u2", "usenet", "b", None, 5, "s"), ("p", "p2p", None, None, 9, "s"), ("h", "http", None, None, None, "s")
    everything = grouped(spark, c, u, u2, p, h)
    assert kept_by(everything, "aggressive") == ["c", "h"]
    assert kept_by(everything, "conservative") == ["c", "h", "u2"]
    assert kept_by(everything, "keep_all") == ["c", "h", "p", "u", "u2"]
    without_cached = grouped(spark, u, u2, p, h)
    assert kept_by(without_cached, "aggressive") == ["h", "p"]
    assert kept_by(without_cached, "conservative") == ["h", "p", "u", "u2"]
    assert kept_by(grouped(spark, u, u2), "aggressive") == ["u", "u2"]
    # A service type without a service is no uncached row.
    assert kept_by(grouped(spark, p, ("d", "debrid", None, False, None, "s")), "aggressive") == ["d", "p"]


def test_winners_of_each_mode(spark):
    rows = [("a", "debrid", "x", True, 50, "s2"), ("b", "debrid", "y", True, 1, "s1"), ("c", "debrid", "y", True, 90, "s1"), ("d", "p2p", None, None, 3, "s1"), ("e", "p2p", None, None, 7, "s1")]
    win = lambda mode, df: sorted(r.id for r in rk.dedup_winners(df, ["request_id", "title"], mode, ["y", "x"], ["s2", "s1"], ["debrid", "p2p"]).collect())
    df = grouped(spark, *rows)
    # Seeders decide between p2p rows, never between cached ones.
    assert win("single_result", df) == ["b", "e"]
    assert win("per_addon", df) == ["a", "b", "e"]
    assert win("per_service", df.where("service_id is not null")) == ["a", "b"]
    with pytest.raises(Exception, match="needs a service"):
        win("per_service", df)


def test_dedup_driver_keeps_excluded_and_passthrough_rows(spark):
    rows = [("a", "debrid", "x", True, 1, "s1"), ("b", "debrid", "x", False, 1, "out"), ("c", "debrid", "x", True, 1, "s1"), ("d", "live", None, None, None, "s1"), ("e", "archive", None, None, None, "s1"), ("f", "debrid", "x", True, 1, "s1")]
    df = grouped(spark, *rows).withColumn("keys", F.when(F.col("id") != "f", F.array(F.lit("k"))))
    run = lambda **more: sorted(r.id for r in rk.deduplicate(df, "request_id", "keys", excluded=F.col("source_id") == "out", **more).collect())
    assert run() == ["a", "b", "d", "e", "f"]
    assert run(strict=True) == ["a", "b", "d", "f"]
    assert run(passthrough=F.col("id") == "c") == ["a", "b", "c", "d", "e", "f"]
    assert run(modes={"cached": "disabled"}) == ["a", "b", "c", "d", "e", "f"]


def test_as_of_keeps_probes_before_all_starts(spark):
    probes = spark.createDataFrame([(1, 1), (1, 5), (1, 9), (2, 3)], "k int, at int")
    mappings = spark.createDataFrame([(1, 4, "x"), (1, 8, "y")], "k int, start int, name string")
    run = lambda **more: [tuple(r) for r in idt.latest_start(probes, mappings, ["k"], "at", "start", ["name"], **more).orderBy("k", "at").collect()]
    assert run() == [(1, 1, None, None, False), (1, 5, 4, "x", True), (1, 9, 8, "y", True), (2, 3, None, None, False)]
    assert run(fallback=True)[0] == (1, 1, 4, "x", False)


def test_units_of_text(spark):
    hours = lambda t: one(spark, ps.age_hours(F.lit(t)))[0]
    assert [hours(t) for t in ("30m", "12h", "3D", "1y", "3 d", "2.5h", "5w")] == [0.5, 12.0, 72.0, 8760.0, None, None, None]
    rate = lambda t: one(spark, ps.bitrate_bps(F.lit(t)))[0]
    assert [rate(t) for t in ("5 Mbps", "1.5tbps", "640", "x 5 Mbps", "5 MB")] == [5e6, 1.5e12, 640.0, None, None]
    ms = lambda t: one(spark, ps.duration_ms(F.lit(t)))[0]
    assert [ms(t) for t in ("1h 2m 3s", "x [45m]", "1h:30m", "abc5m", "5mb", "7s")] == [3723000, 2700000, 5400000, 0, 0, 7000]
    length = lambda x: one(spark, fm.format_duration(F.lit(x)))[0]
    assert [length(x) for x in (300_000, 30_000, 61_000, 3_600_000)] == ["5m", "0m:30s", "1m:1s", "1h:0m:0s"]


def test_episode_maps(spark):
    e = lambda t: tuple(one(spark, ps.episodes(F.lit(t)))[0])
    assert e('{"1": {"5": {}, "7": {}}}') == (1, 5, 7, 2) and e('{"1": {"1": {}}, "2": {"1": {}}}') == (None, None, None, 0)
    assert e("{}") == (None, None, None, 0) and e('{"3": {}}') == (3, None, None, 0)
    assert one(spark, ps.content_class(F.lit(0)), ps.content_class(F.lit(11)), ps.content_class(F.lit(10))) == ("season_pack", "season_pack", "multi_episode")


def test_candidate_bands(spark):
    rows = [(1, "a", 0.95, 0, 10.0), (2, "a", 0.93, 1, 0.0), (3, "a", 0.9, 1, 0.0), (4, "a", 0.9, None, 0.0), (5, "a", 0.93, None, 0.0), (6, "a", 0.99, 2, 0.0), (7, "a", 0.9, 0, 25.0), (7, "b", 0.9, 0, 0.0), (8, "a", 0.7, 0, 0.0)]
    df = spark.createDataFrame(rows, "probe int, cand string, sim double, gap int, pop double")
    got = {r.probe: r.status for r in idt.decide_candidate(df, "probe", F.col("sim"), F.col("gap"), F.col("pop"), "cand").collect()}
    assert got == {1: "exact", 2: "strong", 3: "ambiguous", 4: "strong", 5: "exact", 6: "ambiguous", 7: "ambiguous", 8: "ambiguous"}


def test_upsert_takes_the_last_of_repeated_keys(spark):
    old, new = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), spark.createDataFrame([(2, "x"), (2, "y"), (3, "z")], "k int, v string")
    assert sorted(tuple(r) for r in mt.upsert(old, new, ["k"]).collect()) == [(1, "a"), (2, "y"), (3, "z")]


def test_overrides_hit_a_rule_once(spark):
    rules = spark.createDataFrame([("n", "p", 1.0), ("m", "q", 2.0)], "name string, pattern string, score double")
    over = spark.createDataFrame([("p", "by pattern", 5.0, False), ("n", "by name", 6.0, False), ("m", None, None, True)], "key string, name string, score double, disabled boolean")
    assert [tuple(r) for r in readers.overridden(rules, over).collect()] == [("by pattern", "p", 5.0)]


def test_error_classes(spark):
    kinds = [one(spark, flt.message_class(F.lit(m)))[0] for m in ("HTTP 429", "Too many requests", "rate limit hit", "could not generate", "Request timed out", "403")]
    assert kinds == ["ratelimit", "ratelimit", "ratelimit", "hard", "timeout", "forbidden"]


def test_publish_replaces_the_pointer_in_one_step(spark, tmp_path):
    root = f"file://{tmp_path}/t"
    for version, n in (("v1", 3), ("v2", 5)):
        mt.publish(spark.range(n), root, version, {"some": F.col("id") >= 0})
    assert mt.current(spark, root).count() == 5
    with pytest.raises(ValueError):
        mt.publish(spark.range(2), root, "v3", {"none": F.col("id") < 0})
    assert mt.current(spark, root).count() == 5


def test_duplicate_groups_are_transitive_and_order_free(spark):
    rows = [(1, 1, ["a"]), (1, 2, ["b"]), (1, 3, ["a", "b"]), (1, 4, []), (1, 5, None)]
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "request_id long, pos long, keys array<string>")
        assert {r.pos: r.dup_group for r in rk.duplicate_groups(df, "request_id", "pos", "keys").collect()} == {1: 1, 2: 1, 3: 1, 4: 4, 5: 5}


def test_session_counter_fires_and_resets(spark):
    base = dt.datetime(2024, 1, 1)
    at = [0, 10, 20, 30, 5000, 5010, 5020]
    df = spark.createDataFrame([(1, base + dt.timedelta(seconds=s)) for s in at], "user_id int, ts timestamp")
    got = [(r["count"], r.fires) for r in mt.session_counter(df, ["user_id"], "ts", 100, 3).orderBy("ts").collect()]
    assert got == [(1, False), (2, False), (3, True), (1, False), (1, False), (2, False), (3, True)]


def test_profile_edges(spark):
    df = spark.createDataFrame([("a", None, None, ["en", "fr"], True), ("b", "1080p", 5, ["en"], False), ("c", "720p", 0, [], None)], "id string, resolution string, seeders int, languages array<string>, cached boolean")
    keep = lambda p: [r.id for r in flt.decide(df, p).where("keep").orderBy("id").collect()]
    assert keep(flt.Profile(languages=flt.Dimension(excluded=("en", "Unknown")))) == ["a"]
    assert keep(flt.Profile(scalars={"resolution": flt.Dimension(excluded=("Unknown",))})) == ["b", "c"]
    assert keep(flt.Profile(exclude_uncached=True)) == ["a", "c"]
    assert keep(flt.Profile(cache_rules=(flt.CacheRule(False, services=("x",), all_of=True),))) == ["a", "b", "c"]
    assert flt.Range.normalised(0, 100, 0, 100) is None and flt.Range.normalised(1, 100, 0, 100) == flt.Range(1, None)


def test_release_gate_and_bitrate(spark):
    gate = flt.release_gate(F.col("d"), F.lit(True), 2)
    assert [one(spark, flt.release_gate(F.lit(d), F.lit(True), 2))[0] for d in (-10, -2, 0, 5)] == [False, True, True, True] and gate is not None
    assert one(spark, flt.derived_bitrate(F.lit(None).cast("double"), F.lit(6000), F.lit(None), F.lit(1), F.lit(6), F.lit(False), F.lit(0)))[0] == 133.0


def test_parsing(spark):
    got = one(spark, ps.first_token(F.col("n"), ps.RESOLUTION_TOKENS), F.array_join(ps.all_tokens(F.col("n"), ps.VISUAL_TOKENS), ","), ps.release_group(F.col("n")), ps.season_episode(F.col("n"))["episode"], n="A.Show.S02E11.2160p.HDR.DV.WEB-DL-GRP.mkv")
    assert got == ("2160p", "HDR,DV", "GRP", 11)
    assert one(spark, ps.first_token(F.lit("my2160pix"), ps.RESOLUTION_TOKENS))[0] is None
    assert one(spark, ps.size_bytes(F.lit("1.5 GB")), ps.duration_ms(F.lit("none")), ps.age_hours(F.lit("3d")), ps.bitrate_bps(F.lit("5 Mbps"))) == (1610612736, 0, 72.0, 5e6)
    assert one(spark, ps.info_hash(F.lit("x/" + "aB" * 20 + "/0")))[0] == "ab" * 20
    assert one(spark, ps.service_of(F.lit("[RD+] x"), [("rd", "RD"), ("ad", "AD")])["cached"])[0] is True
    assert one(spark, ps.jaccard(F.lit("a b"), F.lit("b c")))[0] == pytest.approx(1 / 3)
    assert one(spark, ps.noise(F.lit(""), ["x"], ["y"]), ps.noise(F.lit("x y z"), ["x"], ["y"])) == (999, 4)
    assert ps.literal_pattern("/ab+/in") == ("(?i)ab+", True)
    with pytest.raises(ValueError):
        ps.bounded_pattern("(a+)+b")


def test_formatting(spark):
    assert one(spark, fm.format_bytes(F.lit(1_500_000_000)), fm.format_bytes(F.lit(0)), fm.format_duration(F.lit(3723000)), fm.small_caps(F.lit("Ab")), fm.season_label(F.array(F.lit(1), F.lit(3)))) == ("1.5 GB", "0 B", "1h:2m:3s", "ᴀʙ", "S01-03")
    assert one(spark, fm.half_up(F.lit(-2.5)), fm.half_up(F.lit(2.5))) == (-2.0, 3.0)


def test_similarity(spark):
    df = spark.createDataFrame([("Käse & Brot+", "kase"), (None, "x")], "a string, b string")
    assert [r[0] for r in df.select(sim.normalise_title("a")).collect()] == ["kaeseandbrot+", None]
    assert one(spark, sim.fuzzy_ratio(F.lit("abcd"), F.lit("abxd")), sim.fuzzy_partial(F.lit("bc"), F.lit("abcd"))) == (75.0, 100.0)


def test_sel_errors_and_mode(spark):
    df = spark.createDataFrame([(1, i, str(i), v) for i, v in enumerate([5, 7, 7, 5, 9])], "request_id int, pos int, id string, seeders int")
    assert df.select(sel.compile_value("mode(values(streams, 'seeders'))", df)).first()[0] == 7.0
    assert sel.rule_name("/*# hidden */ /* Best */ streams") == "Best"
    assert sel.select_rows(df, "true").count() == 5 and sel.select_rows(df, "[]").count() == 0
    assert sel.select_rows(df, "seeders(streams, 0, 0)").count() == 5
    assert sel.require_any(df, ["seeders(streams, 9)", "count(streams) == 4 ? slice(streams, 0, 1) : []"]).count() == 2
    for bad in ("streams +", "nope(streams)", "values(streams, 'colour')", "cached(3)", "percentile(values(streams, 'seeders'), 200)", "a = 1"):
        with pytest.raises(sel.SelError):
            sel.compile_rows(bad, df)


def test_template(spark):
    t = Template({"s.name": (F.lit("ab"), "text"), "s.n": (F.lit(12.0), "number"), "s.l": (F.array(F.lit("x"), F.lit("y")), "list"), "s.f": (F.lit(False), "flag"), "s.e": (F.lit(""), "text")})
    shown = lambda text: one(spark, t.compile(text))[0]
    assert shown("{s.name::upper}-{s.n}-{s.l::last}") == "AB-12-y"
    assert shown("{s.f::istrue::or::s.n::>=10[\"yes\"||\"no\"]}") == "yes"
    assert shown("{s.f::isfalse::and::s.e::exists[\"yes\"||\"no\"]}") == "no"
    assert shown("a\n\n{tools.removeLine}b\nc") == "a\nc"
    assert shown("{s.gone}") == "{unknown_propertyName(s.gone)}" and shown("{s.name::nope}") == "{unknown_modifier(nope)}"
    assert shown("{s.name::replace('a','c')}{s.name::~B[\"!\"||\"?\"]}") == "cb!"


def test_identity_helpers(spark):
    assert one(spark, idt.prefixes(F.lit("a bc def gh")))[0] == ["a bc def", "a bc"]
    files = spark.createDataFrame([(1, 0, 5.0), (1, 1, 5.0), (2, 0, -500.0)], "k int, file_index int, s double")
    assert [(r.k, r.file_index, r.file_score) for r in idt.best_file(files, "k", F.col("s")).orderBy("k").collect()] == [(1, 0, 5.0), (2, 0, 0.0)]


def test_statistics_helpers(spark):
    df = spark.createDataFrame([(3.0,), (3.0,)], "x double")
    assert [r.n for r in st.scaled_by(df, {"x": "n"}).collect()] == [1.0, 1.0]
    assert one(spark, st.change_ratio(F.array(F.lit(1), F.lit(2)), F.array(F.lit(2), F.lit(3))))[0] == pytest.approx(2 / 2)


def test_sources_and_sinks(spark, tmp_path):
    (tmp_path / "s.json").write_text('{"url": "u", "name": "n"}\nbroken\n{"name": "no link"}\n')
    assert [r.url for r in readers.streams(spark, str(tmp_path / "s.json")).collect()] == ["u"]
    (tmp_path / "bad.json").write_text("broken\n")
    with pytest.raises(readers.AllRowsInvalid):
        readers.streams(spark, str(tmp_path / "bad.json"))
    (tmp_path / "m.json").write_text(json.dumps({"id": "a", "types": ["movie"], "resources": [{"name": "stream"}, {"name": "meta", "types": ["series"], "idPrefixes": ["tt"]}]}))
    assert sorted((r.resource, tuple(r.types)) for r in readers.capabilities(spark, str(tmp_path / "m.json")).collect()) == [("meta", ("series",)), ("stream", ("movie",))]
    (tmp_path / "log.txt").write_text("source=a\nfail x\nsource=b\nfail y\n")
    log = readers.text_log(spark, str(tmp_path / "log.txt"), r"(?:source=(\w+))?(?:fail (\w+))?", ["source", "error"], carry=["source"])
    assert sorted((r.source, r.error) for r in log.where("error is not null").collect()) == [("a", "x"), ("b", "y")]
    (tmp_path / "r.json").write_text('{"values": [{"name": "n", "pattern": "p", "score": 2}]}')
    rules = readers.rules(spark, str(tmp_path / "r.json"))
    over = spark.createDataFrame([("p", "renamed", None, None)], "key string, name string, score double, disabled boolean")
    assert [tuple(r) for r in readers.overridden(rules, over).collect()] == [("renamed", "p", 2.0)]
    kept, dropped = sinks.search_rows(spark.createDataFrame([("u",), (None,)], "url string"), ["url", "hash"], ["url"])
    assert kept.count() == 1 and dropped.first()[0] == 1
    sinks.ranked_csv(spark.createDataFrame([("a", 0.5)], "k string, score double"), str(tmp_path / "csv"), {"score": 4}, [F.col("k")])
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).first().score == "0.5000"


def test_publish_checks_before_it_switches(spark, tmp_path):
    root = f"file://{tmp_path}/t"
    good = spark.createDataFrame([(1,)], "k int")
    mt.publish(good, root, "v1", {"key": F.col("k").isNotNull()})
    with pytest.raises(ValueError):
        mt.publish(spark.createDataFrame([(None,)], "k int"), root, "v2", {"key": F.col("k").isNotNull()})
    assert mt.current(spark, root).first().k == 1


def test_streams(spark, tmp_path):
    from relspark.streaming import jobs

    base = dt.datetime(2024, 1, 1)
    rows = spark.createDataFrame([(1, base + dt.timedelta(seconds=s)) for s in (0, 10, 20, 30)], "user_id long, ts timestamp")
    rows.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    q = jobs.counter_stream(stream, ["user_id"], "ts", 60_000, 3).writeStream.format("memory").queryName("fires").outputMode("append").option("checkpointLocation", str(tmp_path / "c1")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert [(r["count"], r.fires) for r in spark.table("fires").orderBy("ts").collect()] == [(1, False), (2, False), (3, True), (1, False)]
    jobs.upsert_stream(stream, str(tmp_path / "out"), ["user_id", "ts"], str(tmp_path / "c2")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out/v1")).count() == 4


def test_title_match(spark):
    from relspark.operators import matching as mc

    df = spark.createDataFrame([(1, "The Käse", ["the kaese"]), (2, "Other", ["the kaese"]), (3, None, ["x"]), (4, "the kaesa", ["nothing", "the kaese"])], "id int, title string, wanted array<string>")
    assert {r.id: r.title_ok for r in mc.title_match(df, "title", "wanted").collect()} == {1: True, 2: False, 3: False, 4: True}


def test_more_parsing(spark):
    got = one(
        spark, ps.media_score(F.lit(5), F.lit("1080p"), F.lit("movie"), {"1080p": 0.8}, {"movie": 1.0}), ps.any_pattern(F.lit("[Grp] x - 01"), [r"^\[[^\]]+\]"]), ps.mapped(F.lit(" EN"), {"en": "English"}),
        ps.leading_year(F.lit("1999-2003")), ps.leading_year(F.lit(None).cast("string")), ps.roman_variants(F.lit("rocky ii")), ps.in_script(F.lit("abЖ")),
        ps.preprocessed(F.lit("One / Two"), F.array(F.lit("one"))), ps.preprocessed(F.lit("A/B"), F.array(F.lit("a/b"))), ps.preprocessed(F.lit("Name (x)"), F.array(F.lit("name"))), ps.refined_series_title(F.lit("show complete 02"), F.lit(2), ["complete"]),
    )
    assert got == (pytest.approx(0.9), True, "English", 1999, 0, ["rocky ii", "rocky 11", "rocky 2"], True, "One", "A/B", "Name", "show")


def test_size_bins_leave_borders_out(spark):
    mib, gib = 2**20, 2**30
    got = one(spark, *[fm.size_bin(F.lit(n).cast("long")).alias(str(i)) for i, n in enumerate((None, 0, 1, 100 * mib, 100 * mib + 1, gib, gib + 1, 5 * gib, 6 * gib, 12 * gib))])
    assert got == (None, None, "0-100MB", "5GB+", "100-300MB", "5GB+", "1-2GB", "3-5GB", "5-7GB", "11-17GB")


def test_epochs_and_search_text(spark):
    other = F.lit(7)
    got = one(spark, *[ps.epoch_seconds(F.lit(t), other).alias(str(i)) for i, t in enumerate(("1970-01-01T00:01:00Z", "1970-01-01T00:01:00.999Z", "1970-01-01T01:01:00+0100", "1970-01-01 00:01:00", "", None, "1970-13-01T00:00:00Z"))])
    assert got == (60, 60, 60, 7, 7, 7, 7)
    text = lambda last: ps.search_text([F.lit("a b"), F.lit(""), F.lit(None).cast("string")], F.lit(1999), F.lit(3), F.lit(7), F.lit(last).cast("int"), [F.lit("k")])
    got = one(spark, text(7).alias("a"), text(101).alias("b"), text(None).alias("c"))
    assert got == ("a b 1999 season 3 s03 episode 7 e07 k", "a b 1999 season 3 s03 episode 7 e07 episode 101 e101 k", "a b 1999 season 3 s03 episode 7 e07 k")


def test_crosswalk_branches(spark):
    schema = "m int, imdb string, mal int, kind string, starts array<struct<source:int,season:int,episode:int>>, synonyms array<string>"
    mappings = spark.createDataFrame(
        [(1, "t1", 10, "TV", [(0, 1, 1)], ["x"]), (2, "t1", None, "TV", [(0, 1, 13)], []), (3, "t1", 12, "MOVIE", None, None), (4, "t1", 13, "TV", [(1, 1, 13)], ["X SEASON-3 part"]), (5, None, 14, "TV", [(1, 1, 5)], None), (6, "t2", 15, "TV", [], [])],
        schema,
    )
    asked = [(1, "imdb", "t1", 1, 12), (2, "imdb", "t1", 1, 13), (3, "imdb", "t1", None, None), (4, "imdb", "t1", 3, 2), (5, "imdb", "t1", 4, 2), (6, "mal", "14", 1, 9), (7, "imdb", "t2", None, None), (8, "imdb", "t9", 1, 1), (9, "imdb", None, 1, 1), (10, "imdb", "t1", 0, 1)]
    requests = spark.createDataFrame(asked, "r int, id_type string, id_value string, season int, episode int")
    got = {x.r: (x.m, x.start) for x in idt.crosswalk(requests, mappings, ["imdb", "mal"], "r", "m", ["imdb"]).collect()}
    assert got == {1: (1, 1), 2: (2, 13), 3: (3, None), 4: (4, None), 5: (1, None), 6: (5, None), 7: (6, None), 8: (None, None), 9: (None, None), 10: (1, None)}


def test_reclaim_needs_statistics(spark):
    counts = spark.createDataFrame([("a", 3), ("b", 3), ("c", 0), ("d", 3)], "table_name string, row_count long")
    stats = spark.createDataFrame([("a", 2.0, 5.0), ("b", 0.0, 5.0), ("c", 2.0, 5.0)], "table_name string, estimated_rows double, total_bytes double")
    assert {r.table_name: r.reclaimed for r in mt.reclaimable(counts, stats).collect()} == {"a": 7, "b": 0, "c": 0, "d": 0}


def test_release_titles_by_form(spark):
    from relspark.functions import titles as tt

    names = {
        "The.Film.1999.1080p.BluRay.x264-GRP.mkv": ("The Film", 1999), "[Sub] Some Show v2 [x][ABCDEF12].episode": ("Some Show", None), "A.I.Story.2001.DVD": ("A.I. Story", 2001),
        "Dr.Who.A.B.1996.x": ("Dr. Who A.B.", 1996), "2012.2009.BluRay": ("2012", 2009), "1999 - Long Title": ("Long Title", 1999), "d41d8cd98f00b204e9800998ecf8427e": None, "...": None, "ABC xyz": None,
        "no year": None, "": None, None: None,
    }
    rows = spark.createDataFrame(list(enumerate(names)), "k int, raw string").select("k", tt.release_title(F.col("raw")).alias("s")).orderBy("k").collect()
    assert [r.s and (r.s.title, r.s.year) for r in rows] == list(names.values())
    mirrored = spark.sql("SELECT 'p027.9991.mliF' AS raw").select(tt.release_title(F.col("raw")).alias("s")).first().s
    assert (mirrored.title, mirrored.year) == ("Film", 1999)
    both = spark.sql("SELECT 'Film / Movie 2004' AS raw").select(tt.release_title(F.col("raw")).alias("s")).first().s
    assert both.titles == ["Film / Movie", "Film", "Movie"]


def test_movie_titles_and_latin(spark):
    from relspark.functions import titles as tt

    rows = spark.createDataFrame([("The Lord of the Rings",), ("2012",), ("Ça & là",), (None,), ("Größe",), ("ábc",)], "t string").select(tt.movie_title(F.col("t")).alias("f")).collect()
    assert [r.f for r in rows] == ["lordrings", "2012", "cala", "", "groesse", "bc"]
    assert spark.sql("SELECT 'Москва Ёж plain' AS t").select(tt.latin(F.col("t")).alias("f")).first().f == "Moskva Ezh plain"


def test_groups_stop_at_the_first_failed_condition(spark):
    from relspark.operators import resolution as rs

    rows = spark.createDataFrame([("q", None, 5), ("q", 1, 9), ("q", 2, 1), ("q", 3, 1)], "request_id string, group_no int, elapsed int")
    found = lambda conditions, sequential: sorted((r.group_no or 0) for r in rs.fetched_groups(rows, conditions, sequential).collect())
    yes, no = (lambda *a: F.lit(True)), (lambda *a: F.lit(False))
    assert found([None, yes, no, yes], True) == [0, 1]
    assert found([None, None, None, None], True) == [0, 1, 2, 3]
    assert found([None, None, yes, None], False) == [0, 2]
    assert found([None, yes, lambda pn, an, pt, at: at == 14, yes], True) == [0, 1, 2, 3]
    assert found([None, yes, lambda pn, an, pt, at: at == 9, yes], False) == [0, 1, 2, 3]
    assert found([None, lambda *a: F.lit(None).cast("boolean"), yes], True) == [0]


def test_pruning_waits_for_the_drain(spark):
    from relspark.operators import maintenance as mt

    rows, left = spark.range(10), spark.range(1)
    with pytest.raises(ValueError):
        mt.prune(rows, F.col("id") > 5, left)
    assert mt.prune(rows, F.col("id") > 5, left.where("id > 5")).count() == 6


def test_phases_resume(spark, tmp_path):
    from relspark.operators import maintenance as mt

    ran = []

    def phase(name, make):
        return name, lambda tables: ran.append(name) or make(tables)

    first, second = phase("a", lambda t: spark.range(5)), phase("b", lambda t: t["a"].where("id > 1"))
    broken = phase("b", lambda t: t["a"].select(F.raise_error(F.lit("lost"))))
    with pytest.raises(Exception, match="lost"):
        mt.run_phases(spark, str(tmp_path), [first, broken])
    assert mt.run_phases(spark, str(tmp_path), [first, second]) == {"a": 5, "b": 3}
    assert ran == ["a", "b", "b"]


def test_request_constants_and_random(spark):
    from relspark.plans import sel

    rows = spark.createDataFrame([("q", 1, "p2p"), ("q", 2, "http"), ("r", 1, "http")], "request_id string, pos int, type string")
    value = lambda text, **c: [r.v for r in rows.withColumn("v", sel.compile_value(text, rows, constants=c)).orderBy("request_id", "pos").collect()]
    assert value("season") == [-1] * 3 and value("ongoingSeason") == [False] * 3
    assert value("ongoingSeason", hasNextEpisode=True, season=2, latestSeason=2) == [True] * 3
    a = value("random(10)")
    assert a[0] == a[1] != a[2] and all(0 <= x < 10 for x in a)
    with pytest.raises(sel.SelError):
        sel.mark_passthrough(rows, "passthrough(streams, 'nothing')")


def test_vocabularies_of_names(spark):
    vocabularies = {"r": ps.RESOLUTION_TOKENS, "q": ps.QUALITY_TOKENS, "e": ps.ENCODE_TOKENS}
    lists = {"v": ps.VISUAL_TOKENS, "a": ps.AUDIO_TOKENS, "c": ps.CHANNEL_TOKENS}
    cases = [
        ("Film.2019.UHD.BluRay.REMUX.HDR10+.DV.TrueHD.7.1.Atmos.H.265", ("2160p", "BluRay REMUX", "HEVC"), (["HDR10+", "DV"], ["Atmos", "TrueHD"], ["7.1"])),
        ("Film.1920x1080.BDRip.x264.DTS-HD.MA.5.1.10bit", ("1080p", "BluRay", "AVC"), (["10bit"], ["DTS-HD MA"], ["5.1"])),
        ("Show 1080i WEB DDP5.1 HDR10 H264", ("1080p", "WEB-DL", "AVC"), (["HDR10"], ["DD+"], ["5.1"])),
        ("Show.FHD.WEB-DLRip.AV1.EAC3.2.0.SDR", ("1080p", "HDRip", "AV1"), (["SDR"], ["DD+"], ["2.0"])),
        ("Old.SD.HDCAM.DivX.DTS", ("480p", "CAM", "DivX"), ([], ["DTS"], [])),
        ("Old.800p.HC.xvid.3D.HSBS.DTS-X.FLAC", ("720p", "HC HD-Rip", "XviD"), (["3D", "H-SBS"], ["DTS:X", "FLAC"], [])),
        ("premux bluray none", (None, None, None), ([], [], [])),
    ]
    rows = spark.createDataFrame([(i, n) for i, (n, *_) in enumerate(cases)], "i int, n string")
    n = F.col("n")
    got = rows.select("i", *[ps.first_token(n, v).alias(k) for k, v in vocabularies.items()], *[ps.all_tokens(n, v).alias(k) for k, v in lists.items()]).orderBy("i").collect()
    for r, (name, one_of, many) in zip(got, cases, strict=True):
        assert ((r.r, r.q, r.e), (r.v, r.a, r.c)) == (one_of, many), name


def test_number_modifiers(spark):
    t = Template({"s.n": (F.lit(1_254_600_000.0), "number"), "s.p": (F.lit(70.0), "number"), "s.z": (F.lit(0.0), "number"), "s.b": (F.lit("  "), "text")})
    shown = lambda text: one(spark, t.compile(text))[0]
    assert shown("{s.n::bytes} {s.n::rbytes} {s.n::rbytes2} {s.n::sbytes} {s.n::bitrate} {s.n::rbitrate}") == "1.25 GB 1 GB 1 GiB 1.25 GB 1.25 Gbps 1 Gbps"
    assert shown("{s.p::star} {s.p::pstar} {s.z::pstar} {s.z::bitrate}{s.z::sbitrate}") == "★★★⯪ ★★★⯪☆ ☆☆☆☆☆ 0 bps0 bps"
    assert shown('{s.b::exists["yes"||"no"]}') == "no"
