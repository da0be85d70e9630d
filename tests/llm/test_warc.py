import gzip
import hashlib
import os
import random

import pytest

from ripplelog.llm import warc
from ripplelog.llm.frames import cut
from ripplelog.llm.records import _filesystem

SCHEMA = "page_id long, url string, html string, kind string, digest string, file string, offset string"
COLUMNS = ["page_id", "payload_bytes", "digest", "kind", "refers_to"]


def table(spark, rows):
    return spark.createDataFrame([(*r, "c", "c", "c", "c") for r in rows], SCHEMA).repartition(3)


def brute(rows):
    groups = {}
    for number, (key, url, html) in enumerate(rows):
        groups.setdefault((html or "").encode(), []).append((key is None, key or 0, url or "", number))
    out = []
    for payload, members in groups.items():
        members.sort()
        first = None if members[0][0] else members[0][1]
        for place, (none, key, _, _) in enumerate(members):
            again = len(payload) >= 100 and place > 0
            kind, refers = ("revisit", first) if again else ("response", None)
            out.append((None if none else key, len(payload), hashlib.sha256(payload).hexdigest(), kind, refers))
    return out


def key(row):
    return tuple((x is None, str(x)) for x in row)


def check(spark, rows, **options):
    got = warc.deduplicated_pages(table(spark, rows), **options)
    assert sorted(map(tuple, got.select(COLUMNS).collect()), key=key) == sorted(brute(rows), key=key)
    return got


def test_equals_brute_force(spark):
    rng = random.Random(4)
    texts = ["é" * 50, "x" * 99, "y" * 100, "z" * 5000, "", None, "漢" * 33, "漢" * 34, "a\r\n\r\nWARC/1.1\r\n" * 20]
    rows = [(i, f"http://h/{i}", rng.choice(texts) if i % 3 else f"{i} " * 60) for i in range(200)]
    check(spark, rows)
    check(spark, rows, file_bytes=2000, level=0)


def test_one_payload_held_by_most_pages(spark):
    check(spark, [(i, None, "same " * 40 if i % 4 else f"own {i} " * 40) for i in range(1500)])


def test_odd_rows(spark):
    long, text = "word " * 400_000, "t" * 200
    rows = [(None, None, None), (None, None, text), (1, "u\r\nWARC-Type: revisit", text), (1, "v", text), (2, None, ""), (3, "\x00 ü", long), (4, "", long)]
    check(spark, rows)
    check(spark, [(None, "a", text), (None, "b", text)])
    check(spark, [])


def test_files_are_archives_of_members_with_full_headers(spark, tmp_path):
    text = "p" * 300
    raw, target = str(tmp_path / "raw"), str(tmp_path / "new")
    index = warc.write_archives(table(spark, [(5, "http://b", text), (3, "http://a", text), (9, "http://c", "q" * 300)]), raw)
    assert {r.kind for r in index.collect()} == {"response"} and index.count() == 3
    found = warc.write_deduplicated(warc.resolve_revisits(index), raw, target).collect()
    by = {r.page_id: r for r in found}
    old = {r.page_id: r for r in index.collect()}
    whole = b"".join(gzip.decompress(open(f"{target}/{n}", "rb").read()) for n in sorted(os.listdir(target)) if n.endswith(".gz"))
    assert whole.count(b"WARC/1.1\r\n") == 3 and whole.count(text.encode()) == 1
    with open(f"{target}/{by[5].file}", "rb") as file:
        file.seek(by[5].offset)
        fields, block = warc.parsed(gzip.decompress(file.read(by[5].length)))
    assert fields["warc-type"] == "revisit" and fields["warc-profile"].endswith("identical-payload-digest")
    assert fields["warc-refers-to"] == f"<{old[3].record_id}>" and fields["warc-refers-to-target-uri"] == "http://a"
    assert fields["warc-record-id"] == f"<{old[5].record_id}>" and fields["x-refers-to-page-id"] == "3"
    assert fields["warc-payload-digest"] == "sha256:" + hashlib.sha256(text.encode()).hexdigest()
    assert block.endswith(b"Content-Length: 300\r\n\r\n") and int(fields["content-length"]) == len(block)
    back = warc.read_archives(cut(spark.createDataFrame(found, index.schema), "again"), target, payloads=True)
    assert {r.page_id: r.payload for r in back.collect()} == {5: None, 3: text.encode(), 9: b"q" * 300}


def test_archives_of_other_origin_with_revisits(spark, tmp_path):
    """Revisit records and records of other kinds in files that come without an index."""
    old = str(tmp_path / "old")
    store, root = _filesystem(old)
    store.create_dir(root)
    text, none = b"r" * 200, dict.fromkeys(warc._NAMES)
    digest = hashlib.sha256(text).hexdigest()
    head = {"record_id": "urn:uuid:1", "date": "2020-01-01T00:00:00Z", "digest": digest, "payload_bytes": 200}
    info = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    bare = b"WARC/1.0\r\nWARC-Type: response\r\nContent-Length: 200\r\n\r\n" + text + b"\r\n\r\n"
    files = {
        "a.warc.gz": [gzip.compress(info), warc.record(none | head | {"kind": "revisit", "record_id": "urn:uuid:2", "page_id": 1}, None, 6)],
        "b.warc.gz": [warc.record(none | head | {"kind": "response", "page_id": 7, "uri": "http://x"}, text, 6), gzip.compress(bare)],
        "c.warc.gz": [warc.record(none | {"kind": "revisit", "record_id": "urn:uuid:3", "digest": "0" * 64, "page_id": 4}, None, 6)],
        "d.warc.gz": [],
    }
    for name, parts in files.items():
        with open(f"{root}/{name}", "wb") as out:
            out.write(b"".join(parts))
    index = cut(warc.index_archives(spark.createDataFrame([(n,) for n in files], "file string"), old), "index")
    target = str(tmp_path / "new")
    rows = warc.read_archives(warc.write_deduplicated(warc.resolve_revisits(index), old, target), target).collect()
    assert sorted(((r.page_id, r.kind, r.refers_to, r.refers_to_id) for r in rows), key=key) == sorted(
        [(1, "revisit", 7, "urn:uuid:1"), (7, "response", None, None), (None, "revisit", 7, "urn:uuid:1"), (4, "revisit", None, None)], key=key
    )


def test_damage_is_an_error(spark, tmp_path):
    raw = str(tmp_path / "raw")
    index = warc.write_archives(table(spark, [(1, None, "k" * 500)]), raw, level=0)
    path = f"{raw}/{index.first().file}"
    data = bytearray(open(path, "rb").read())
    data[data.index(b"kkkk")] = ord("K")
    open(path, "wb").write(data)
    with pytest.raises(Exception):
        warc.read_archives(index, raw).collect()
    open(path, "wb").write(bytes(data[:200]))
    with pytest.raises(Exception):
        warc.index_archives(index, raw).collect()
    with pytest.raises(ValueError, match="not a WARC"):
        warc.parsed(b"HTTP/1.1 200\r\n\r\n")
