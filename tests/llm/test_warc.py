import base64
import hashlib
import os

import zstandard

from itemsync.llm import warc

PAGES = [
    (3, "http://a", "<p>x</p>"),
    (1, "http://b", "<p>x</p>"),
    (2, None, None),
    (5, "http://c", ""),
    (7, "http://d\r\nX: y", "WARC/1.1\r\n\r\nbody\r\n\r\n"),
    (8, "http://e", "é" * 40_000),
    (9, "http://e", "é" * 40_000),
    (1, "http://b", "<p>x</p>"),
    (None, "http://f", "<p>x</p>"),
]
KIND = "page_id bigint, url string, html string, revisit string, bundle string"


def expected(pages, least=0):
    first: dict = {}
    for i, _, h in pages:
        if i is not None:
            first[h or ""] = min(i, first.get(h or "", i))
    out = []
    for i, _, h in pages:
        data = (h or "").encode()
        revisit = len(data) >= least and i != first.get(h or "")
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((i is None, i or 0, len(data), digest, "revisit" if revisit else "response", first[h or ""] if revisit else None))
    return sorted(out)


def test_archive_round_trip(spark):
    pages = spark.createDataFrame([(*p, "x", "y") for p in PAGES], KIND)
    for least in (0, 10):
        rows = warc.archived(pages, min_bytes=least).collect()
        assert sorted((r[0] is None, r[0] or 0, *r[1:]) for r in rows) == expected(PAGES, least)
    assert warc.archived(pages.limit(0)).count() == 0


def test_frames_stand_alone(spark, folder):
    pages = spark.createDataFrame([(n, f"http://{n}", f"page {n} " * 50, "x", "y") for n in range(60)], KIND).coalesce(1)
    index = warc.write(pages, folder, frame_bytes=2000, bundle_bytes=4000).cache()
    assert index.count() > 5 and len(os.listdir(folder)) == index.select("bundle").distinct().count() > 1
    got = {r.page_id: r.payload.decode() for r in warc.read(index, folder).collect()}
    assert got == {n: f"page {n} " * 50 for n in range(60)}
    # a whole bundle is an ordinary Zstandard stream of frames, with the seek table skipped
    name = os.path.join(folder, sorted(os.listdir(folder))[0])
    with open(name, "rb") as file:
        data = zstandard.ZstdDecompressor().stream_reader(file, read_across_frames=True).read()
        frames = warc.read_seek_table(file)
    assert data.startswith(b"WARC/1.1\r\n") and len(data) == sum(f[3] for f in frames)
