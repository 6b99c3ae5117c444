"""The index of video files that the test writes."""

import struct

import pytest
from pyspark.sql import functions as F

from kinetrace.sources import mp4, video


def box(kind, *parts):
    body = b"".join(parts)
    return struct.pack(">I4s", 8 + len(body), kind) + body


def full(kind, *parts, version=0):
    return box(kind, bytes([version, 0, 0, 0]), *parts)


def rows(kind, values, code):
    return full(kind, struct.pack(">I", len(values)), *[struct.pack(">" + code, *v) for v in values])


def write(path, images, per_chunk=3, codec=b"jpeg", sync=None, late=None, opening=None, wide=False, moov_first=False, fragmented=False):
    """A track of 30 frames a second whose chunks have other data between them."""
    def moov(at):
        spots, place = [], at
        for k in range(0, len(images), per_chunk):
            place += 7
            spots.append((place,))
            place += sum(map(len, images[k : k + per_chunk]))
        whole, rest = divmod(len(images), per_chunk)
        runs = ([(1, per_chunk, 1)] if whole else []) + ([(whole + 1, rest, 1)] if rest else [])
        entry = box(codec, bytes(24), struct.pack(">HH", 64, 48), bytes(50), box(b"conf", b"xyz"))
        tables = [full(b"stsd", struct.pack(">I", 1), entry), rows(b"stts", [(len(images), 1001)], "II"), rows(b"stsc", runs, "III"), full(b"stsz", struct.pack(">II", 0, len(images)), *[struct.pack(">I", len(i)) for i in images])]
        tables.append(rows(b"co64", spots, "Q") if wide else rows(b"stco", spots, "I"))
        if sync is not None:
            tables.append(rows(b"stss", [(s + 1,) for s in sync], "I"))
        if late is not None:
            tables.append(rows(b"ctts", [(1, x) for x in late], "II"))
        edit = [box(b"edts", rows(b"elst", [(5, opening, 65536)], "IiI"))] if opening is not None else []
        sound = box(b"trak", box(b"mdia", full(b"hdlr", bytes(4), b"soun", bytes(13))))
        own = box(b"trak", *edit, box(b"mdia", full(b"mdhd", struct.pack(">IIIII", 0, 0, 30000, len(images) * 1001, 0)), full(b"hdlr", bytes(4), b"vide", bytes(13)), box(b"minf", box(b"stbl", *tables))))
        return box(b"moov", sound, own, *([box(b"mvex")] if fragmented else []))

    data = b"".join(b"between" + b"".join(images[k : k + per_chunk]) for k in range(0, len(images), per_chunk))
    head = box(b"ftyp", b"isom", bytes(4))
    ahead = len(head) + (len(moov(0)) if moov_first else 0) + 8
    parts = [moov(ahead), box(b"mdat", data)]
    path.write_bytes(head + b"".join(parts if moov_first else parts[::-1]))


IMAGES = [b"\xff\xd8" + bytes([i]) * (i + 1) + b"\xff\xd9" for i in range(11)]


def test_counts_rates_times(spark, tmp_path):
    write(tmp_path / "a.mp4", IMAGES)
    write(tmp_path / "b.mp4", IMAGES[:4], per_chunk=2, wide=True, moov_first=True)
    write(tmp_path / "none.mp4", [])
    got = {r.video.rsplit("/", 1)[1]: r for r in mp4.facts(spark, str(tmp_path)).collect()}
    assert [(got[k].n_frames, got[k].codec, got[k].width, got[k].height) for k in ("a.mp4", "b.mp4", "none.mp4")] == [(11, "jpeg", 64, 48), (4, "jpeg", 64, 48), (0, "jpeg", 64, 48)]
    assert got["a.mp4"].fps == pytest.approx(30000 / 1001) and got["none.mp4"].fps is None and b"xyz" in got["a.mp4"].config
    table = mp4.frame_table(spark, str(tmp_path), rows=4)
    for r in table.collect():
        raw = (tmp_path / r.video.rsplit("/", 1)[1]).read_bytes()
        assert raw[r.start : r.start + r.size] == IMAGES[r.sample] and r.frame_index == r.sample == r.group and r.seconds == pytest.approx(r.sample * 1001 / 30000)
    assert table.count() == 15
    meant = table.select("video", "frame_index")
    faults = video.encoding_faults(mp4.probes(mp4.facts(spark, str(tmp_path))), meant, 30000 / 1001)
    assert {r.fault for r in faults.collect()} == {None}


def test_only_asked_ranges_are_read(spark, tmp_path):
    write(tmp_path / "a.mp4", IMAGES)
    table = mp4.frame_table(spark, str(tmp_path))
    name = table.first().video
    asks = spark.createDataFrame([(name, 4), (name, 5), (name, 9), (name, 4), (name, 99)], "video string, frame_index long")
    spans = mp4.byte_ranges(mp4.needed(table, asks)).orderBy("start").collect()
    assert [(s.n_samples, s.stop - s.start) for s in spans] == [(2, len(IMAGES[4] + IMAGES[5])), (1, len(IMAGES[9]))]
    raw, log = (tmp_path / "a.mp4"), tmp_path / "log"

    class Watched:
        def __init__(self, path):
            self.f = open(raw, "rb")

        def __enter__(self):
            return self

        def __exit__(self, *_):
            self.f.close()

        def seek(self, *a):
            return self.f.seek(*a)

        def read(self, n):
            with open(log, "a") as out:
                out.write(f"{n}\n")
            return self.f.read(n)

    got = mp4.frames_at(table, mp4.facts(spark, str(tmp_path)), asks, opener=Watched).collect()
    assert {r.frame_index: bytes(r.image) for r in got} == {k: IMAGES[k] for k in (4, 5, 9)}
    assert sum(map(int, log.read_text().split())) == sum(len(IMAGES[k]) for k in (4, 5, 9))


def test_groups_and_reordered_frames(spark, tmp_path):
    # Shown as 0 2 1 4 3, 5 7 6 9 8, 10; sync samples 0, 5, 10.
    late = [1001, 2002, 0, 2002, 0] * 2 + [1001]
    write(tmp_path / "a.mp4", IMAGES, codec=b"avc1", sync=[0, 5, 10], late=late, opening=1001)
    table = mp4.frame_table(spark, str(tmp_path))
    got = table.orderBy("sample").collect()
    assert [r.group for r in got] == [0] * 5 + [5] * 5 + [10] and [r.sync for r in got].count(True) == 3
    shown = [k * 1001 + d - 1001 for k, d in enumerate(late)]
    visible = sorted(x for x in shown if x >= 0)
    assert [r.frame_index for r in got] == [visible.index(x) if x >= 0 else None for x in shown]
    wanted = next(r.frame_index for r in got if r.sample == 7)
    asks = spark.createDataFrame([(got[0].video, wanted)], "video string, frame_index long")
    assert sorted(r.sample for r in mp4.needed(table, asks).collect()) == [5, 6, 7]
    facts = mp4.facts(spark, str(tmp_path))
    with pytest.raises(Exception, match="needs a decoder"):
        mp4.frames_at(table, facts, asks).collect()
    r = mp4.frames_at(table, facts, asks, decoder=lambda codec, config, raw: [x + codec.encode() for x in raw]).first()
    assert bytes(r.image) == IMAGES[7] + b"avc1"


def test_files_that_cannot_be_read(tmp_path):
    write(tmp_path / "f.mp4", IMAGES, fragmented=True)
    (tmp_path / "s.mp4").write_bytes(box(b"moov", box(b"trak", box(b"mdia", full(b"hdlr", bytes(4), b"soun")))))
    write(tmp_path / "ok.mp4", IMAGES, moov_first=True)
    raw = (tmp_path / "ok.mp4").read_bytes()
    (tmp_path / "cut.mp4").write_bytes(raw[:300])
    (tmp_path / "few.mp4").write_bytes(raw.replace(struct.pack(">II", 11, 1001), struct.pack(">II", 9, 1001)))
    for name, words in (("f", "fragmented"), ("s", "no video"), ("cut", "cut off"), ("few", "duration")):
        with open(tmp_path / f"{name}.mp4", "rb") as f, pytest.raises(video.VideoError, match=words):
            mp4.track_samples(mp4.video_track(f))
