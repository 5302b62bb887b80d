import gzip
import hashlib
import random
import struct
import zlib

import public_tokenizers as P
import pytest
import tiktoken
from pyspark.sql import functions as F

from tidemark.llm import bpe, common, media, warc

RANKS = bpe.read_ranks(None, P.path("byte_bpe_multi_50k.tiktoken"))
LIB = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})


@pytest.fixture(scope="module")
def coder():
    return bpe.Bpe(dict(RANKS), P.PATTERN)


def test_media_round_trip(awkward):
    back = {(r.id, r.n_bytes): r for r in media.read_back(media.store_texts(awkward)).collect()}
    for i, t in [(r.doc_id, r.text or "") for r in awkward.collect()]:
        b = t.encode()
        r = back[i, len(b)]
        assert bytes(r.payload) == media.pad(b) and len(r.payload) % 192 == 0 and r.payload[len(b) :].strip(b" ") == b""
        assert bytes(r.media) == media.build(media.pad(b))


def test_index_of_media(spark, empty):
    payload = bytes(range(192)) * 130
    rows = spark.createDataFrame([(1, media.build(payload), 5), (2, None, 5), (3, b"", 5), (4, media.build(payload)[:-40], 5), (5, b"\0\0\0\x04junk", 5)], "id long, media binary, tracks long")
    got = {r.id: r for r in media.index_media(rows).collect()}
    (t,) = got[1].tracks
    assert (t.codec, t.timescale, t.duration, t.n_samples, len(t.keyframes)) == ("raw ", 25, 130, 130, 9)
    key = t.keyframes[1]
    assert (key.sample, key.time, key.size) == (16, 16, 192) and media.build(payload)[key.offset : key.offset + key.size] == payload[16 * 192 : 17 * 192]
    assert got[2].tracks is None and got[2].problem is None and got[3].tracks == []
    assert got[4].problem and got[5].problem
    assert media.store_texts(empty).count() == 0


def test_damaged_tables_cost_no_more_than_their_file(spark):
    box, full = media._box, media._full

    def movie(*tables, data=b""):
        entry = full(b"stsd", struct.pack(">I", 1), box(b"raw "))
        return box(b"mdat", data) + box(b"moov", box(b"trak", box(b"mdia", box(b"minf", box(b"stbl", entry, *tables)))))

    nested = b""
    for _ in range(1200):
        nested = box(b"moov", nested)
    stco, stsc = full(b"stco", struct.pack(">II", 1, 8)), full(b"stsc", struct.pack(">IIII", 1, 1, 1 << 28, 1))
    files = [
        nested,
        movie(full(b"stsz", struct.pack(">II", 1, 1 << 28)), stco, stsc),
        movie(full(b"stsz", struct.pack(">II", 0, 1 << 31)), stco, stsc),
        movie(full(b"stsz", struct.pack(">II", 4, 2)), stco, full(b"stsc", struct.pack(">IIII", 1, 0, 2, 1)), full(b"stts", struct.pack(">III", 1, 2, 1)), data=bytes(8)),
        movie(full(b"stsz", struct.pack(">II", 4, 2)), stco, full(b"stsc", struct.pack(">IIII", 1, 1, 2, 1)), full(b"stts", struct.pack(">III", 1, (1 << 32) - 1, 1)), data=bytes(8)),
        box(b"moof", box(b"traf", full(b"tfhd", struct.pack(">I", 1)), full(b"trun", struct.pack(">I", (1 << 32) - 1)))),
        box(b"moof", box(b"traf", full(b"trun", struct.pack(">I", 0)))),
    ]
    rows = spark.createDataFrame([(k, f) for k, f in enumerate(files)], "id long, media binary")
    assert all(r.problem and r.tracks is None for r in media.index_media(rows).collect())


def test_fragments():
    """Samples of two fragments: sizes of their own, then those that the movie's defaults give."""
    box, full = media._box, media._full
    head = box(b"moov", box(b"trak", full(b"tkhd", struct.pack(">III", 0, 0, 7), flags=7), box(b"mdia", full(b"mdhd", struct.pack(">IIII", 0, 0, 25, 0)), box(b"minf", box(b"stbl", full(b"stsd", struct.pack(">I", 1), box(b"raw ")), full(b"stsz", struct.pack(">II", 0, 0)), full(b"stsc", struct.pack(">I", 0)), full(b"stco", struct.pack(">I", 0)))))), box(b"mvex", full(b"trex", struct.pack(">5I", 7, 1, 10, 4, media.NOT_ALONE))))

    def piece(at, traf, data):
        size = len(box(b"moof", traf(0)))
        return box(b"moof", traf(size + 8)) + box(b"mdat", data)

    one = piece(len(head), lambda by: box(b"traf", full(b"tfhd", struct.pack(">I", 7), flags=0x20000), full(b"tfdt", struct.pack(">I", 0)), full(b"trun", struct.pack(">IiI", 2, by, 0), struct.pack(">IIII", 10, 3, 10, 5), flags=0x305)), b"abcdefgh")
    two = piece(len(head) + len(one), lambda by: box(b"traf", full(b"tfhd", struct.pack(">II", 7, 0), flags=0x20020), full(b"tfdt", struct.pack(">I", 20)), full(b"trun", struct.pack(">Ii", 2, by), flags=0x1)), b"ijklmnop")
    data = head + one + two
    (t,) = media.tracks(memoryview(data))
    assert (t.codec, t.timescale, t.duration) == ("raw ", 25, 40)
    assert t.sizes.tolist() == [3, 5, 4, 4] and t.times.tolist() == [0, 10, 20, 30] and t.keys.tolist() == [0, 2, 3]
    assert media.samples(data, t) == b"abcdefghijklmnop"


def test_boxes_of_other_writers():
    """64-bit sizes, a box to the end, own sample sizes, no table of keyframes, version 1 headers."""
    box, full = media._box, media._full
    stbl = box(
        b"stbl", full(b"stsd", struct.pack(">I", 1), box(b"twos", bytes(28))), full(b"stts", struct.pack(">IIIII", 2, 2, 10, 1, 5)),
        full(b"stsz", struct.pack(">IIIII", 0, 3, 4, 5, 6)), full(b"stsc", struct.pack(">IIIIIII", 2, 1, 1, 1, 2, 2, 1)), full(b"co64", struct.pack(">IQQ", 2, 16, 30)),
    )
    head = struct.pack(">I", 1 << 24) + struct.pack(">QQIQ", 0, 0, 48000, 25) + bytes(4)
    moov = box(b"moov", box(b"trak", box(b"mdia", box(b"mdhd", head), full(b"hdlr", bytes(4), b"soun"), box(b"minf", stbl))))
    data = struct.pack(">I4sQ", 1, b"mdat", 16 + 40) + bytes(range(40)) + moov + struct.pack(">I4s", 0, b"free") + b"rest"
    (t,) = media.tracks(memoryview(data))
    assert (t.codec, t.handler, t.timescale, t.duration) == ("twos", "soun", 48000, 25)
    assert t.offsets.tolist() == [16, 30, 35] and t.sizes.tolist() == [4, 5, 6] and t.times.tolist() == [0, 10, 20] and t.keys.tolist() == [0, 1, 2]
    assert media.samples(data, t) == data[16:20] + data[30:41]


def test_bpe_as_the_library(spark, awkward, empty, coder):
    got = sorted(((r.id, r.ids, bytes(r.decoded)) for r in bpe.encode(awkward, RANKS, P.PATTERN).collect()), key=repr)
    want = sorted(((r.doc_id, LIB.encode_ordinary(r.text or ""), (r.text or "").encode()) for r in awkward.collect()), key=repr)
    assert got == want
    assert bpe.encode(empty, RANKS, P.PATTERN).count() == 0
    rng = random.Random(5)
    for _ in range(500):
        t = "".join(rng.choice(" \n\t'sabtheéü123.,!-　\x1c٠क🙂") for _ in range(rng.randrange(80)))
        assert coder.encode(t).tolist() == LIB.encode_ordinary(t)


def test_bpe_fit_is_what_merging_says(coder):
    rng = random.Random(6)
    ids = list(RANKS.values())
    for _ in range(4000):
        a, b = rng.choice(ids), rng.choice(ids)
        assert coder._apart(a, b) == (coder.merge(coder.tokens[a] + coder.tokens[b]) == [a, b])


def test_bpe_appends_and_edits(coder):
    rng = random.Random(7)
    alphabet = b"abcdethin xyz .,\xc3\xa9"
    p = bpe.Piece(coder, bytes(rng.choice(alphabet) for _ in range(300)))
    whole = lambda d: coder.back(coder.extend(d, []))
    looked = 0
    for k in range(60):
        if k % 3 == 0:
            p.append(bytes(rng.choice(alphabet) for _ in range(rng.randrange(9))))
        else:
            s = rng.randrange(len(p.data))
            looked += p.edit(s, min(len(p.data), s + rng.randrange(5)), bytes(rng.choice(alphabet) for _ in range(rng.randrange(5))))
        assert p.ids == whole(p.data) and len(p.last) == len(p.data)
    assert looked < 40 * 200  # an edit does not redo the rest
    assert coder.decode(p.ids) == p.data


PAGES = "page_id long, url string, html string, archive string, offset long"


def test_warc(spark, tmp_path):
    big = "<p>" + "long " * 50_000
    rows = [(5, "http://a/?q=1%20x", "same"), (3, "http://b\r\nX: y", "same"), (9, None, "same"), (1, "u", None), (2, "u", ""), (None, "u", "same"), (None, "u", "alone"), (7, "é", big), (7, "é", big), (8, "v", big)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], PAGES)
    folder = "file://" + str(tmp_path / "w")
    index = warc.write(df, folder)
    got = sorted(((r.page_id, r.url, r.record_type, r.refers_to, r.payload_bytes, r.payload_digest, r.payload and bytes(r.payload)) for r in warc.read(index, folder).collect()), key=repr)
    first = {"same": 3, "": 1, big: 7, "alone": None}
    want = []
    for i, u, h in rows:
        h = h or ""
        again = first[h] is not None and i != first[h]
        want.append((i, u, "revisit" if again else "response", first[h] if again else None, len(h.encode()), warc.digest(h.encode()), None if again else h.encode()))
    assert got == sorted(want, key=repr)
    # the files are plain concatenated members
    data = b"".join(gzip.open(f).read() for f in sorted((tmp_path / "w").iterdir()))
    assert data.count(b"WARC/1.1\r\n") == len(rows)
    # a selection reads only its ranges
    some = index.filter("page_id IN (1, 8)")
    assert sorted(r.page_id for r in warc.read(some, folder, payloads=False).collect()) == [1, 8]
    # short payloads are all responses
    index = warc.write(df, folder + "2", least=10)
    assert {r.page_id: r.record_type for r in warc.read(index, folder + "2").filter("page_id IN (5, 3, 8)").collect()} == {5: "response", 3: "response", 8: "revisit"}


def test_warc_empty(spark, tmp_path):
    folder = "file://" + str(tmp_path / "w")
    index = warc.write(spark.createDataFrame([], PAGES), folder)
    assert index.count() == 0 and warc.read(index, folder).count() == 0


def test_reads_are_coalesced():
    rows = [("a", 0, 10), ("a", 10, 5), ("a", 15 + warc.GAP_BYTES, 5), ("a", 21 + 2 * warc.GAP_BYTES, 5), ("b", 0, 3)]
    assert [(a, s, e, len(p)) for a, s, e, p in warc._reads(rows)] == [("a", 0, 20 + warc.GAP_BYTES, 3), ("a", 21 + 2 * warc.GAP_BYTES, 26 + 2 * warc.GAP_BYTES, 1), ("b", 0, 3, 1)]
