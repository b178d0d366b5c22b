import base64
import glob
import hashlib
import os

import zstandard

from plumbline.llm import warc
from plumbline.session import new_table_path


def sha(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def brute(rows, least=0):
    out = []
    for page_id, _, html in rows:
        ids = [p for p, _, h in rows if (h or "") == (html or "") and p is not None]
        size = len((html or "").encode())
        first = max(ids) if ids else None
        revisit = size >= least and first is not None and page_id != first
        out.append((page_id, size, sha(html), "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=str)


def run(spark, rows, settings=warc.Settings(), parts=3):
    path = new_table_path(spark, "archives")
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, payload string")
    warc.write(pages.repartition(parts), path, settings)
    found = warc.read(spark, path).collect() if rows else []
    assert all(r["intact"] for r in found)
    return path, sorted((tuple(r[c] for c in ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))
                         for r in found), key=str), found


def pages():
    body = "<html><head><title>{}</title></head><body><p>Some text that pages share</p>{}</body></html>"
    rows = [(i, f"http://h{i % 9}.example.com/p/{i}", body.format(i, "word " * (i % 23))) for i in range(300)]
    rows += [(1000 + i, "http://copy.example.com/", "one copied page") for i in range(40)]
    rows += [(2000, "http://e.example.com/", ""), (2001, None, None), (2002, "http://é.example.com/a b\r\nX: y", "é😀\r\n\r\nWARC/1.1"),
             (None, "http://n.example.com/", "no id"), (None, "http://n.example.com/", "one copied page"),
             (3000, "u", "\x00\x1f\n" * 200_000), (7, "again", "other payload of a known id")]
    return rows


def test_round_trip(spark):
    rows = pages()
    path, found, raw = run(spark, rows)
    assert found == brute(rows)
    assert {r["page_id"]: r["url"] for r in raw}[2000] == "http://e.example.com/"
    files = glob.glob(os.path.join(path.removeprefix("file:"), "part-*"))
    assert files
    for file in files:  # the dictionary leads, and every record is a frame of its own that any decoder can read
        content = open(file, "rb").read()
        assert int.from_bytes(content[:4], "little") == warc.DICTIONARY_FRAME
        size = int.from_bytes(content[4:8], "little")
        data = zstandard.ZstdCompressionDict(content[8:8 + size])
        text = zstandard.ZstdDecompressor(dict_data=data).stream_reader(content, read_across_frames=True).read()
        assert text.startswith(b"WARC/1.1\r\nWARC-Type: warcinfo") and text.count(b"WARC-Record-ID: ") == len(list(warc.records(content)))


def test_small_payloads_are_all_responses(spark):
    rows = [(1, "a", "tiny"), (2, "b", "tiny"), (3, "c", "long enough"), (4, "d", "long enough")]
    _, found, _ = run(spark, rows, warc.Settings(min_bytes=5))
    assert found == brute(rows, 5)


def test_repeated_rows_and_empty_table(spark):
    rows = [(5, "a", "x"), (5, "a", "x"), (4, "a", "x")]
    _, found, _ = run(spark, rows, parts=1)
    assert [f[3] for f in found] == ["revisit", "response", "response"] and len(found) == 3
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    path = new_table_path(spark, "archives")
    warc.write(pages, path)
    assert warc.read(spark, path).count() == 0


def test_the_dictionary_pays(spark):
    rows = pages()
    sizes = []
    for settings in (warc.Settings(), warc.Settings(sample_records=0)):
        path, _, _ = run(spark, rows[:300], settings, parts=1)
        file, = glob.glob(os.path.join(path.removeprefix("file:"), "part-*"))
        content = open(file, "rb").read()
        lead = 8 + int.from_bytes(content[4:8], "little") if content[:4] == (warc.DICTIONARY_FRAME).to_bytes(4, "little") else 0
        sizes.append(len(content) - lead)
    assert sizes[0] < 0.6 * sizes[1]


def test_large_pages_have_a_dictionary(spark):
    html = ["".join(f"<p>Paragraph {i * j % 997} of a page that is long</p>" for j in range(1_500)) for i in range(1, 9)]
    rows = [(i, f"http://h.example.com/{i}", h) for i, h in enumerate(html)]
    assert min(map(len, html)) > warc.Settings().sample_bytes
    path, found, _ = run(spark, rows, parts=1)
    assert found == brute(rows)
    for name in glob.glob(os.path.join(path.removeprefix("file://").removeprefix("file:"), "part-*")):
        magic, length = warc.struct.unpack_from("<II", open(name, "rb").read(8))
        assert magic == warc.DICTIONARY_FRAME and length


def test_many_tasks_send_no_more_to_the_driver(spark, monkeypatch):
    """The sample is as large as wanted, not that large from every task."""
    sent = []
    train = warc.train_dictionary
    monkeypatch.setattr(warc, "train_dictionary", lambda records, size: sent.append(records) or train(records, size))
    rows = [(i, f"http://h{i % 9}.example.com/{i}", f"<p>page {i} " + "word " * 900) for i in range(3_000)]
    settings = warc.Settings(sample_records=50)
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    for parts in (2, 40):
        assert warc.sample_dictionary(pages.repartition(parts), settings)
    assert sorted(sent[0]) == sorted(sent[1]) and len(sent[0]) == 50
    # A third of all rows are one page.
    again = pages.union(spark.createDataFrame([rows[0]] * 1_500, pages.schema)).repartition(7)
    warc.sample_dictionary(again, settings)
    assert sorted(sent[2]) == sorted(sent[0])
    few = pages.where("page_id < 20").union(spark.createDataFrame([rows[0]] * 900, pages.schema))
    warc.sample_dictionary(few, settings)
    assert len(sent[3]) == 20
    warc.sample_dictionary(pages.limit(0), settings)
    assert len(sent) == 4


def test_archives_are_rolled(spark):
    rows = [(i, f"http://h.example.com/{i}", hashlib.sha512(str(i).encode()).hexdigest() * 20) for i in range(400)]
    path, found, _ = run(spark, rows, warc.Settings(row_bytes=4_000, archive_rows=4), parts=1)
    assert found == brute(rows)
    files = glob.glob(os.path.join(path.removeprefix("file://").removeprefix("file:"), "part-*"))
    assert len(files) > 2
    for name in files:  # each is an archive of its own
        content = open(name, "rb").read()
        magic, length = warc.struct.unpack_from("<II", content)
        assert magic == warc.DICTIONARY_FRAME and length and len(content) < 8 + length + 4 * 20_000
        assert next(warc.records(content)).startswith(b"WARC/1.1\r\nWARC-Type: warcinfo")
