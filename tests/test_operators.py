"""Small hand-computed cases."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.functions import text as T
from tidemark.operators import frames as fr
from tidemark.operators import intervals as iv
from tidemark.operators import notes as nt
from tidemark.operators import pixels as px
from tidemark.operators import speech as sp
from tidemark.operators import store as st
from tidemark.plans.select import select_frames
from tidemark.sources import signals, transcripts


def one(spark, expr, value="x", kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(expr(F.col("v"))).first()[0]


@pytest.mark.parametrize("t, out", [(0, "00:00"), (65, "01:05"), (5999, "99:59"), (6001, "100:01")])
def test_ms(spark, t, out):
    assert one(spark, T.ms, t, "long") == out


def test_text_functions(spark):
    assert one(spark, T.hms, 3725, "long") == "01:02:05"
    assert one(spark, T.slug, "  Hello, World! -- ") == "hello-world"
    assert one(spark, T.slug, "!!") == "section"
    assert one(spark, T.human_bytes, 512, "long") == "512 B"
    assert one(spark, T.human_bytes, 1536, "long") == "1.5 KB"
    assert one(spark, T.normal, "  A\t b \n C ") == "a b c"
    assert one(spark, T.flat, "É A-b  c!") == " ab c"
    assert set(one(spark, T.numbers, "1,250. and 3.5 in twenty ways")) == {"1250", "3.5", "20"}
    assert one(spark, T.screen_terms, "The C++17 kernel-level of it is fun") == ["c++17", "kernel-level", "fun"]


def test_vtt_without_hour_is_dropped_and_repeats_count_once(spark):
    vtt = "WEBVTT\n\n00:00:01.000 --> 00:00:02.000\n<c>one</c>\n\n00:02.000 --> 00:03.000\nlost\n\n00:00:04.000 --> 00:00:05.000\none\ntwo <b>bold</b>\n"
    got = transcripts.parse_vtt(spark.createDataFrame([(1, vtt)], "video_id long, content string")).orderBy("pos").collect()
    assert [(r.hms, r.line) for r in got] == [("00:00:01", "one"), ("00:00:04", "two bold")]


def test_segments_in_both_forms(spark):
    seg = [{"start": 0.0, "end": 1.5, "text": "a"}, {"start": 2, "end": 3, "text": "b"}]
    files = spark.createDataFrame([(1, json.dumps(seg)), (2, json.dumps({"segments": seg})), (3, "{}")], "video_id long, content string")
    got = transcripts.parse_segments(files).orderBy("video_id", "seq").collect()
    assert [(r.video_id, r.seq, r.end) for r in got] == [(1, 0, 1.5), (1, 1, 3.0), (2, 0, 1.5), (2, 1, 3.0)]


def test_signals_fall_back_to_candidates(spark):
    span = {"start": 1, "end": 2, "reason": "r", "confidence": "low"}
    files = spark.createDataFrame([(1, json.dumps({"ad_spans": [], "ad_candidates": [span]})), (2, json.dumps({"ad_spans": [span], "uncertain": [1.5]})), (3, "{}")], "video_id long, content string")
    got = {r.video_id: r for r in signals.parse_signals(files).collect()}
    assert [len(got[k].ad_spans) for k in (1, 2, 3)] == [1, 1, 0]
    assert got[2].uncertain == [1.5] and got[3].sections == []


def test_literals_and_names(spark):
    spans = one(spark, signals.parse_spans, "01:00-01:30, 1:00:00-1:00:05")
    assert [tuple(s) for s in spans] == [(60, 90), (3600, 3605)]
    assert one(spark, signals.named_time, "01-02-03-x.png") == 3723
    assert one(spark, signals.named_time, "02-03-x.png") == 123
    assert one(spark, signals.named_time, "x.png") is None
    assert one(spark, signals.frame_index, "/a/b2/f000012.jpg") == 12


def test_gap_of_exactly_25_merges(spark):
    ev = spark.createDataFrame([(1, 3), (1, 28), (1, 54), (2, 100)], "video_id long, t long")
    got = sorted(tuple(r) for r in sp.merge_gaps(ev).collect())
    assert got == [(1, 0, 36), (1, 46, 62), (2, 92, 108)]


def test_subscribed_is_no_promotion(spark):
    lines = spark.createDataFrame([(1, 0, 0, "every subscribed client"), (1, 1, 5, "do Subscribe now")], "video_id long, seq long, t long, text string")
    assert [r.seq for r in sp.hits(lines, sp.AD).collect()] == [1]


def test_digest_and_nulls(spark):
    rows = [(1, k, t, f"w{k}") for k, t in enumerate([0, 5, 19, 20, 45, 46])]
    got = sp.digest_blocks(spark.createDataFrame(rows, "video_id long, seq long, t long, text string")).orderBy("block_start").collect()
    assert [(r.block_start, r.text) for r in got] == [(0, "w0 w1 w2"), (20, "w3"), (45, "w4 w5")]


def test_intervals(spark):
    pts = spark.createDataFrame([(1, k, t) for k, t in enumerate([0, 10, 22, 23, 60])], "video_id long, idx long, t long")
    spans = spark.createDataFrame([(1, 10, 22), (1, 50, 40)], "video_id long, start long, end long")
    assert sorted(r.t for r in iv.exclude(pts, spans).collect()) == [0, 23, 60]
    marks = spark.createDataFrame([(1, 12), (2, 0)], "video_id long, s long")
    got = {r.t: r.near for r in iv.flag_near(pts, marks, "near", 12).collect()}
    assert got == {0: True, 10: True, 22: True, 23: True, 60: False}


def test_nearest_line_takes_the_earlier_of_two(spark):
    lines = spark.createDataFrame([(1, 0, 0, "a"), (1, 1, 10, "b"), (1, 2, 10, "c")], "video_id long, seq long, t long, text string")
    pts = spark.createDataFrame([(1, 0, 5), (1, 1, 6), (2, 2, 1)], "video_id long, idx long, t long")
    got = {r.idx: (r.seq, r.gap) for r in iv.nearest_line(pts, lines).collect()}
    assert got == {0: (0, 5), 1: (1, 4), 2: (None, None)}


def frame_rows(spark, values, inks=None):
    """Frames whose distance to the one before is given: each flips that many bits of the last."""
    p, rows = 0, []
    for k, n in enumerate(values):
        p ^= (1 << n) - 1
        rows.append((1, k, 2 * k, p - (1 << 64) if p >> 63 else p, 0, (inks or [0.1] * len(values))[k]))
    return spark.createDataFrame(rows, "video_id long, idx long, t long, p long, d long, ink double")


def test_otsu_and_small_inputs(spark):
    v = spark.createDataFrame([(1, x) for x in [0, 1, 2, 1, 50, 52, 51, 50, 0, 1]] + [(2, x) for x in [1, 9]] + [(3, 4)] * 9, "video_id long, nb long")
    got = {r.video_id: r.otsu for r in fr.otsu(v).collect()}
    assert 2 < got[1] <= 50 and got[2] == 9 and got[3] == 4


def test_candidates_final_skips_fade_and_finds_removed_content(spark):
    f = fr.neighbor_distance(frame_rows(spark, [0, 0, 0, 0, 10, 0, 0, 60], [0.5, 0.5, 0.5, 0.5, 0.3, 0.3, 0.05, 0.2]))
    got = sorted((r.idx, r.role, r.plateau_s) for r in fr.candidates(f).collect())
    # the faded frame 6 is skipped; the four frames before the change had more ink
    assert got == [(3, "state-before", 8.0), (5, "final", 4.0), (7, "final", 2.0)]


def test_chained_dedup_compares_with_the_last_kept(spark):
    got = [(r.idx, r.d) for r in fr.chained_dedup(frame_rows(spark, [0, 12, 12, 30, 5])).orderBy("idx").collect()]
    assert got == [(0, 999), (3, 30)]


def test_leader_clusters_need_time_apart_and_spare_protected(spark):
    rows = [(1, k, t, "final", prot, p, 0) for k, (t, p, prot) in enumerate([(0, 0, False), (10, 0, False), (100, 1, False), (200, 0, True), (300, 3, False)])]
    got = fr.leader_clusters(spark.createDataFrame(rows, "video_id long, idx long, t long, role string, protected boolean, p long, d long")).orderBy("cluster").collect()
    assert [(r.idx, r.recurs_at, r.is_divider) for r in got] == [(0, [0, 100, 300], True), (1, [10], False), (3, [200], False)]


def test_chunks_cover_the_whole(spark):
    v = spark.createDataFrame([(1, 4000.0), (2, 100.0), (3, 0.0)], "video_id long, duration double")
    cuts = spark.createDataFrame([(1, 1400, "Part: Two!")], "video_id long, t long, title string")
    got = fr.plan_chunks(v, cuts).orderBy("video_id", "chunk").collect()
    one_ = [(r.start, r.end, r.snapped) for r in got if r.video_id == 1]
    assert one_[0] == (0.0, 1400.0, True) and one_[-1][1] == 4000.0
    assert all(a[1] == b[0] for a, b in zip(one_, one_[1:]))
    assert not [r for r in got if r.video_id == 3]


def test_selection_protects_and_reports_holes(spark):
    f = frame_rows(spark, [0, 0, 60, 0, 60, 0])
    out = select_frames(f, spark.createDataFrame([(1, 0, 4), (1, 1, 400)], "video_id long, seq long, t long"), spark.createDataFrame([], "video_id long, t long"), spark.createDataFrame([], "video_id long, start long, end long"))
    assert out["kept"].count() == 3
    assert [r.t for r in out["holes"].collect()] == [400]


def notes(spark, *lines):
    return spark.createDataFrame([(1, k + 1, x) for k, x in enumerate(lines)], "doc_id long, line_no long, raw string")


def test_numbers_by_line_state(spark):
    speech = spark.createDataFrame([(1, "twelve hundred and 640 px")], "doc_id long, text string")
    n = notes(spark, "has 640 and 641", "> 99 quoted", "> **External check:** 98", "> 97", "# 96", "> 95", "plain 94", "> 93", "```", "92", "```", "# External references", "91", "# Next", "v90 1.5 7 10 `89` 88.png")
    got = {r.number for r in nt.numeric_provenance(n, speech).collect()}
    # the marked block goes on over the heading; it ends at a plain line
    assert got == {"641", "99", "94", "93", "1.5"}


def test_quotes_and_sections(spark):
    speech = spark.createDataFrame([(1, "[00:00:01] we will now look at the whole picture of it all")], "doc_id long, text string")
    good, bad = '> "we will now look at the whole picture of it"', 'the lecturer says "we never did look at the whole picture"'
    assert [r.line_no for r in nt.quotes(notes(spark, good, bad, "x"), speech).collect()] == [2]
    assert {(r.kind, r.section) for r in nt.sections(notes(spark, "# Key takeaways", "## transcription uncertainties")).collect()} == {("missing", "Things worth revisiting"), ("missing", "External references"), ("retired", "Transcription uncertainties")}
    files = spark.createDataFrame([(1, "a.png"), (1, "b.png")], "doc_id long, target string")
    n = notes(spark, "[x](a.png) [y](c.md) [z](https://e.org/q) [w](#top)")
    assert [r.target for r in nt.broken_links(n, files).collect()] == ["c.md"]
    assert [r.target for r in nt.orphans(n, files).collect()] == ["b.png"]


def test_lint_sees_through_emphasis_and_spares_code(spark):
    n = notes(spark, "# A", "", "12:34 range", "at 12:34 then", "a white **rectangle**", "```", "he draws it", "```", "| 1:02 |")
    assert {(r.line_no, r.label) for r in nt.voice_lint(n).collect()} == {(4, "inline timestamp"), (5, "colour/shape description")}


def test_upsert_keeps_what_is_empty(spark):
    old = spark.createDataFrame([("a", "A", 1, "p", 2)], "channel_id string, name string, tier int, params string, videos_seen long")
    new = spark.createDataFrame([("a", None, 0, ""), ("b", "B", None, "q")], "channel_id string, name string, tier int, params string")
    got = {r.channel_id: tuple(r) for r in st.upsert(old, new).collect()}
    assert got == {"a": ("a", "A", 0, "p", 3), "b": ("b", "B", None, "q", 1)}


def test_sinks(spark, tmp_path):
    lines = spark.createDataFrame([(1, 1, 61, "b"), (1, 0, 0, "a")], "video_id long, seq long, t long, text string")
    st.write_transcripts(lines, str(tmp_path / "out"))
    assert [r.value for r in spark.read.text(str(tmp_path / "out")).filter("video_id = 1").collect()] == ["[00:00:00] a", "[00:01:01] b"]
    got = st.json_manifest(lines, "seq").first().json
    assert [x["text"] for x in json.loads(got)] == ["a", "b"]
    assert st.gate_status(spark.createDataFrame([(True,), (False,)], "ok boolean")).first().exit_code == 1


def pictures(spark, n=9, size=24, move=True):
    rng = np.random.default_rng(1)
    base = rng.integers(0, 255, (size, size))
    rows = []
    for k in range(n):
        x = base.copy()
        if move:
            x[:6, (2 * k) % size : (2 * k) % size + 4] = 0
        rows.append((1, k, 2 * k, size, x.ravel().tolist()))
    return base, spark.createDataFrame(rows, "video_id long, idx long, t long, height int, grey array<int>")


def test_pixels(spark):
    base, f = pictures(spark)
    feats = px.frame_features(f).collect()
    assert all(len(r.phash) == 4 and len(r.dhash) == 4 and 0 <= r.ink <= 0.5 for r in feats)
    m = px.motion(f).first()
    assert m.kind in ("localized", "content-only", "global") and len(m.grid) == 9 and m.grid[0] > m.grid[8] == 0
    d = px.deocclude(f, spark.createDataFrame([(1, 8.0), (1, 500.0)], "video_id long, at double")).collect()
    assert len(d) == 1 and d[0].accepted and np.array_equal(np.array(d[0].grey), base.ravel())
    assert px.camera_static(f).first().static
    same = px.dct_hash(base.astype(float))
    assert same == px.dct_hash(base.astype(float)) and sum((a ^ b).bit_count() for a, b in zip(same, px.dct_hash(base + 1.0))) <= 2


def test_stream(spark, tmp_path):
    import datetime as dt

    from tidemark.streaming import ad_sessions

    t0 = dt.datetime(2024, 1, 1)
    at = lambda s: t0 + dt.timedelta(seconds=s)
    rows = [(1, at(0), "please subscribe"), (1, at(25), "promo code"), (1, at(90), "sign up"), (1, at(4000), "subscribe")]
    spark.createDataFrame(rows, "video_id long, at timestamp, text string").coalesce(1).write.parquet(str(tmp_path / "in"))
    lines = spark.readStream.schema("video_id long, at timestamp, text string").parquet(str(tmp_path / "in"))
    q = ad_sessions(lines, late="0 seconds").writeStream.format("memory").queryName("ads").outputMode("append").start()
    q.processAllAvailable()
    q.stop()
    got = sorted(((r.start - t0).total_seconds(), (r.end - t0).total_seconds()) for r in spark.table("ads").collect())
    assert got == [(-8.0, 33.0), (82.0, 98.0)]


def test_selection_with_own_thresholds_uses_each_videos_cluster(spark):
    """Two videos of the same shape, one noisier: its candidates 100 s apart join under its own, wider limit only."""
    steps = {1: [0] + [2] * 9 + [40] + [2] * 60 + [41] + [2] * 9, 2: [0] + [40] * 9 + [63] + [40] * 60 + [64] + [40] * 9}
    frames = None
    for v, values in steps.items():
        f = frame_rows(spark, values).withColumn("video_id", F.lit(v).cast("long"))
        frames = f if frames is None else frames.union(f)
    none = spark.createDataFrame([], "video_id long, seq long, t long, start long, end long")
    limits = {r.video_id: r.cluster for r in fr.calibrate(frames).collect()}
    assert limits[1] != limits[2]
    kept = select_frames(frames, none.select("video_id", "seq", "t"), none.select("video_id", "t"), none.select("video_id", "start", "end"), cut=None)["kept"].collect()
    own = fr.neighbor_distance(frames)
    for v, limit in limits.items():
        cal = fr.calibrate(frames).filter(F.col("video_id") == v).first()
        picked = fr.candidates(own.filter(F.col("video_id") == v), cal.cut, cal.settle).withColumn("protected", F.lit(False)).join(frames.select("video_id", "idx", "p", "d"), ["video_id", "idx"])
        want = [(r.idx, r.cluster, r.recurs) for r in fr.leader_clusters(picked, limit).collect()]
        assert sorted(want) == sorted((r.idx, r.cluster, r.recurs) for r in kept if r.video_id == v)


def test_png_and_sheets(spark):
    import struct
    import zlib

    rows = [(1, k, 2 * k, 2, [10 * k, 20, 30, 40]) for k in range(23)]
    frames = spark.createDataFrame(rows, "video_id long, idx long, t long, height int, grey array<int>")
    sheets = px.contact_sheets(fr.sheet_layout(frames), side=(2, 2), gap=1)
    got = {r.sheet: r for r in sheets.collect()}
    assert sorted(got) == [0, 1] and (got[0].height, len(got[0].grey) // got[0].height) == (16, 13) and got[1].height == 4
    page = np.array(got[0].grey).reshape(16, 13)
    assert page[0].tolist() == [255] * 13 and page[1:3, 1:3].tolist() == [[0, 20], [30, 40]] and page[4:6, 4:6].tolist() == [[50, 20], [30, 40]]
    data = bytes(px.as_png(sheets).filter("sheet = 1").first().png)
    assert data[:8] == b"\x89PNG\r\n\x1a\n" and struct.unpack(">II", data[16:24]) == (13, 4)
    at = data.index(b"IDAT")
    body = zlib.decompress(data[at + 4 : at + 4 + struct.unpack(">I", data[at - 4 : at])[0]])
    assert [body[k * 14 + 1 : k * 14 + 14] for k in range(4)] == [bytes(got[1].grey[k * 13 : k * 13 + 13]) for k in range(4)]


def test_motion_looks_at_the_first_pairs_and_names_the_ninth(spark):
    still, rows = [[0] * 36], []
    for k in range(8):
        image = np.zeros((6, 6), int)
        image[0:2, 4:6] = 100 * (k % 2)
        rows.append((1, k, 6, image.ravel().tolist()))
    rows += [(1, 8 + k, 6, [200 * (k % 2)] * 36) for k in range(4)] + [(2, 0, 6, still[0])]
    got = px.motion(spark.createDataFrame(rows, "video_id long, idx long, height int, grey array<int>"), max_pairs=7).collect()
    assert [(r.video_id, r.place, r.kind, round(r.mean, 6)) for r in got] == [(1, "top-R", "localized", round(4 / 36, 6))]


def test_long_caption_blocks_are_whole(spark):
    body = "\n".join(f"line {k}" for k in range(3000))
    got = transcripts.parse_vtt(spark.createDataFrame([(1, f"00:00:01.000 --> 00:00:02.000\n{body}")], "video_id long, content string"))
    assert got.count() == 3000


def test_number_words_are_whole_words(spark):
    assert set(one(spark, T.numbers, "One, stone; twenty-one _two (five) tenfold six")) == {"1", "20", "5", "6"}


def test_pictures_are_read_from_files(spark, tmp_path):
    images = [np.arange(12).reshape(3, 4) * 20, np.arange(12).reshape(3, 4)[::-1] * 3]
    for k, x in enumerate(images):
        (tmp_path / "v").mkdir(exist_ok=True)
        (tmp_path / "v" / f"f{k + 1:06d}.png").write_bytes(px.png(x))
    got = px.read_frames(spark, f"{tmp_path}/v", "f*.png").orderBy("idx").collect()
    assert [(r.idx, r.t, r.height, list(r.grey)) for r in got] == [(k + 1, 2 * k, 3, x.ravel().tolist()) for k, x in enumerate(images)]
