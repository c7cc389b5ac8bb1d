import base64
import gzip
import hashlib
import os

import pytest

from freshet.llm import warc
from freshet.session import working_dir

SF = "/root/testdata/sf0.001"
ROWS = [(1, "http://a", "x"), (5, "http://b", "x"), (3, None, "x"), (2, "u\r\nx", None), (None, "n", ""), (7, "z", "zz"), (5, "dup", "x"), (8, "é", "ü" * 3000)]


def files(root):
    folder = root.removeprefix("file://")
    return {f: open(f"{folder}/{f}", "rb").read() for f in os.listdir(folder) if f.endswith(".gz")}


def test_whole_table(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    payloads = {r.page_id: (r.html or "").encode() for r in pages.collect()}
    largest = {}
    for i, p in payloads.items():
        largest[p] = max(i, largest.get(p, i))
    rows = warc.archive_report(pages).collect()
    assert len(rows) == len(payloads)
    for r in rows:
        payload = payloads[r.page_id]
        assert r.payload_bytes == len(payload)
        assert r.payload_digest == base64.b32encode(hashlib.sha1(payload).digest()).decode()
        revisit = largest[payload] != r.page_id
        assert (r.record_type, r.refers_to) == (("revisit", largest[payload]) if revisit else ("response", None))


def test_same_files_however_the_rows_were_dealt(spark):
    many = ROWS + [(100 + i, "h", f"long {i} " * 50) for i in range(80)]
    df = spark.createDataFrame(many, "page_id long, url string, html string")
    written = []
    for parts in (1, 5):
        root = working_dir(spark, "warc-test")
        manifest = warc.write_archives(df.repartition(parts), root, file_bytes=3000, shard_bytes=9000).collect()
        written.append(files(root))
        assert {m.file: (m.bytes, m.sha256) for m in manifest} == {f: (len(b), hashlib.sha256(b).hexdigest()) for f, b in written[-1].items()}
        assert all(len(b) <= 3000 or m.records == 1 for m in manifest for f, b in written[-1].items() if f == m.file)
        assert len({m.shard for m in manifest}) > 2 and sum(m.records for m in manifest) == len(many)
    assert written[0] == written[1]
    ids = []
    for name in sorted(written[0]):
        records = gzip.decompress(written[0][name]).split(b"WARC/1.1\r\n")[1:]
        ids += [int(r.split(b"X-Page-ID: ")[1].split(b"\r")[0]) for r in records if b"X-Page-ID: " in r.split(b"\r\n\r\n")[0]]
    assert ids == sorted(ids)


def test_nulls_repeats_and_revisits(spark):
    df = spark.createDataFrame([(*r, "clash") for r in ROWS], "page_id long, url string, html string, shard string")
    root = working_dir(spark, "warc-test")
    warc.write_archives(df, root)
    rows = sorted(((r.page_id or -1, r.record_type, r.refers_to, r.payload_bytes, r.payload) for r in warc.read_archives(spark, root).collect()), key=str)
    assert [r[:4] for r in rows] == sorted(
        [(-1, "revisit", 2, 0), (1, "revisit", 5, 1), (2, "response", None, 0), (3, "revisit", 5, 1), (5, "response", None, 1), (5, "revisit", 5, 1), (7, "response", None, 2), (8, "response", None, 6000)], key=str
    )
    assert [bytes(r[4]) for r in rows if r[0] == 8] == [("ü" * 3000).encode()]


def record_ids(root):
    return [line for data in files(root).values() for line in gzip.decompress(data).split(b"\r\n") if line.startswith(b"WARC-Record-ID")]


def test_repeated_rows_come_in_pieces(spark):
    """A page repeated 50 times, and 60 payloads without a page id: neither makes a large shard."""
    rows = [(9, "u", "same")] * 50 + [(4, "u", "same")] * 3 + [(None, "u", f"payload {i % 40}") for i in range(60)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    root = working_dir(spark, "warc-test")
    manifest = warc.write_archives(df, root, file_bytes=2000, shard_bytes=6000, copies=4).collect()
    assert max(sum(m.records for m in manifest if m.shard == s) for s in {m.shard for m in manifest}) <= 16
    assert max(m.bytes for m in manifest) <= 2000 and any(m.file.endswith("-0001.warc.gz") for m in manifest)
    read = warc.read_archives(spark, root).collect()
    assert sorted((r.page_id or 0, r.record_type, r.refers_to or 0) for r in read) == sorted(
        [(9, "response", 0)] + [(9, "revisit", 9)] * 49 + [(4, "revisit", 9)] * 3 + [(0, "response", 0)] * 40 + [(0, "revisit", 0)] * 20
    )
    ids = record_ids(root)
    assert len(set(ids)) == len(ids) == len(rows) + len(manifest)
    spread = warc.write_archives(df.repartition(7), working_dir(spark, "warc-test"), file_bytes=2000, shard_bytes=6000, copies=4)
    assert sorted(spread.collect()) == sorted(manifest)


def test_small_repeats_are_responses_and_a_long_payload_is_whole(spark):
    long = "long " * 400_000
    df = spark.createDataFrame([(1, "u", "s")] * 9 + [(2, "u", long), (3, "v", long)], "page_id long, url string, html string")
    root = working_dir(spark, "warc-test")
    warc.write_archives(df, root, least=2, copies=4)
    read = warc.read_archives(spark, root).collect()
    assert sorted((r.page_id, r.record_type, r.payload_bytes) for r in read) == [(1, "response", 1)] * 9 + [(2, "revisit", 2_000_000), (3, "response", 2_000_000)]
    assert [bytes(r.payload) for r in read if r.page_id == 3] == [long.encode()]
    assert len(set(record_ids(root))) == 12


def test_smaller_payloads_are_all_responses(spark):
    df = spark.createDataFrame(ROWS, "page_id long, url string, html string")
    root = working_dir(spark, "warc-test")
    warc.write_archives(df, root, least=2)
    assert {r.record_type for r in warc.read_archives(spark, root).collect()} == {"response"}


def test_unlisted_files_do_not_count_and_damage_is_found(spark):
    root = working_dir(spark, "warc-test")
    df = spark.createDataFrame(ROWS, "page_id long, url string, html string")
    assert warc.archive_report(df.limit(0), root).collect() == []
    warc.write_archives(df, root)
    folder = root.removeprefix("file://")
    with open(f"{folder}/.half.tmp", "wb") as file:
        file.write(b"x")
    assert warc.read_archives(spark, root).count() == len(ROWS)
    name = next(f for f in os.listdir(folder) if f.endswith(".gz"))
    data = open(f"{folder}/{name}", "rb").read()
    with open(f"{folder}/{name}", "wb") as file:
        file.write(data[:-9])
    with pytest.raises(Exception, match="ends within"):
        warc.read_archives(spark, root).collect()
    # Cut between two records every record left is whole, and yet one is missing.
    ends = [i for i in range(1, len(data)) if data[i : i + 3] == b"\x1f\x8b\x08"]
    with open(f"{folder}/{name}", "wb") as file:
        file.write(data[: ends[-1]])
    with pytest.raises(Exception, match="not the file that the manifest lists"):
        warc.read_archives(spark, root).collect()
