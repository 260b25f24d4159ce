"""WARC records in ZIP packages: round trips, foreign packages, damage."""

import base64
import gzip
import hashlib
import io
import json
import os
import random
import struct
import zipfile
import zlib

import pytest
from pyspark.sql import functions as F

from barsmith.llm import warc


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def plain(rows):
    """(page_id, bytes, digest, type, refers_to) of each row, from the definitions."""
    most = {}
    for page_id, _, html in rows:
        if page_id is not None:
            most[html or ""] = max(most.get(html or "", page_id), page_id)
    out = []
    for page_id, _, html in rows:
        last = most.get(html or "")
        first = last is None or page_id == last
        kind = ("response", None) if first else ("revisit", last)
        out.append((page_id, len((html or "").encode()), digest(html), *kind))
    return sorted(out, key=str)


def table(spark, rows):
    return spark.createDataFrame(rows, "page_id bigint, url string, html string")


ODD = [
    (1, "http://a/", "<p>same</p>"),
    (2, "http://a/", "<p>same</p>"),
    (3, None, None),
    (4, "", ""),
    (5, "http://x/{a} b\r\nEvil: 1", "\r\n\r\nWARC/1.1\r\n\r\n"),
    (6, "http://ü/", "grüß 🙂 " * 30_000),
    (7, "http://b/", "own"),
    (7, "http://c/", "own"),
    (None, "http://d/", "own"),
    (None, "http://e/", "without an id"),
    (None, "http://e/", "without an id"),
    (-8, "http://f/", "<p>same</p>"),
]


@pytest.mark.parametrize("package_bytes", [1, 1 << 28])
def test_pages_come_back(spark, tmp_path, package_bytes):
    manifest = warc.write(table(spark, ODD), str(tmp_path), package_bytes)
    ranges = warc.ranges(manifest)
    got = sorted(map(tuple, warc.pages(warc.records(ranges)).collect()), key=str)
    assert got == plain(ODD)
    read = warc.records(ranges, payloads=True).collect()
    assert all(r.error is None for r in read)
    payloads = {bytes(r.payload).decode() for r in read if r.payload is not None}
    assert payloads == {html or "" for _, _, html in ODD}
    assert sum(r.records for r in manifest.collect()) == len(ODD)


def test_packages_are_zip_files_that_others_read(spark, tmp_path):
    manifest = warc.write(table(spark, ODD).coalesce(1), str(tmp_path))
    (path,) = [r.package for r in manifest.collect()]
    with zipfile.ZipFile(path) as package:
        assert package.testzip() is None
        assert package.namelist() == [warc.ARCHIVE, warc.INDEX, "datapackage.json"]
        data = package.read(warc.ARCHIVE)
        for line in package.read(warc.INDEX).decode().splitlines():
            facts = json.loads(line.split(" ", 2)[2])
            record = gzip.decompress(data[facts["offset"] : facts["offset"] + facts["length"]])
            assert record.startswith(b"WARC/1.1\r\n") and facts["digest"].encode() in record
        assert [tuple(m) for m in warc.directory(warc.File(path))] == [
            (i.filename, 0, i.header_offset + 30 + len(i.filename) + extra(path, i), i.file_size)
            for i in package.infolist()
        ]


def extra(path, info):
    """Length of the extra fields of a member's own header."""
    with open(path, "rb") as f:
        f.seek(info.header_offset + 28)
        return struct.unpack("<H", f.read(2))[0]


def test_what_a_lost_task_leaves_is_not_read(spark, tmp_path):
    manifest = warc.write(table(spark, ODD), str(tmp_path))
    left = warc.Package(f"{tmp_path}/part-00000-lost.zip")
    left.add(warc.record(99, "u", b"x", b"d" * 20, None), "u", b"d" * 20)
    left.close()
    assert warc.records(warc.ranges(manifest)).count() == len(ODD)
    assert warc.records(warc.ranges(warc.packages(spark, str(tmp_path)))).count() == len(ODD) + 1


def many(n=300):
    rng = random.Random(3)
    return [(i, f"http://h{i % 7}/{i}", "x" * rng.randrange(5000)) for i in range(n)]


def archive(rows, packed=True):
    out = b""
    for page_id, url, html in rows:
        data = warc.record(page_id, url, html.encode(), hashlib.sha1(html.encode()).digest(), None)
        out += data if packed else gzip.decompress(data)
    return out


def read_back(spark, *paths):
    packages = spark.createDataFrame([(str(p),) for p in paths], "package string")
    return sorted(map(tuple, warc.pages(warc.records(warc.ranges(packages))).collect()))


def test_archives_without_an_index_and_bytes_before_the_zip(spark, tmp_path):
    rows = many()
    for name, packed in (("data.warc.gz", True), ("data.warc", False)):
        body = io.BytesIO()
        with zipfile.ZipFile(body, "w") as package:
            package.writestr("readme.txt", "no records here", zipfile.ZIP_DEFLATED)
            package.writestr(f"archive/{name}", archive(rows, packed))
            package.comment = b"a comment with PK\x05\x06 in it"
        path = tmp_path / f"{name}.zip"
        path.write_bytes(b"#!/bin/sh\n" * 11 + body.getvalue())
        want = sorted((i, len(h), digest(h), "response", None) for i, _, h in rows)
        assert read_back(spark, path) == want


def test_zip64_directories(spark, tmp_path):
    """A package whose sizes, places and counts all stand in ZIP64 fields."""
    rows, name = many(5), b"archive/data.warc.gz"
    data = archive(rows)
    local = struct.pack("<4s5H3L2H", b"PK\3\4", 45, 0, 0, 0, 0, zlib.crc32(data), 0xFFFFFFFF, 0xFFFFFFFF, len(name), 20)
    local += name + struct.pack("<2H2Q", 1, 16, len(data), len(data)) + data
    more = struct.pack("<2H", 0xCAFE, 3) + b"abc" + struct.pack("<2H3Q", 1, 24, len(data), len(data), 0)
    entry = struct.pack(
        "<4s6H3L5H2L", b"PK\1\2", 45, 45, 0, 0, 0, 0, zlib.crc32(data), 0xFFFFFFFF, 0xFFFFFFFF, len(name), len(more), 0, 0, 0, 0, 0xFFFFFFFF
    ) + name + more
    at = len(local)
    end64 = struct.pack("<4sQ2H2L4Q", b"PK\6\6", 44, 45, 45, 0, 0, 1, 1, len(entry), at)
    locator = struct.pack("<4sLQL", b"PK\6\7", 0, at + len(entry), 1)
    end = struct.pack("<4s4H2LH", b"PK\5\6", 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 0)
    path = tmp_path / "long.zip"
    path.write_bytes(local + entry + end64 + locator + end)
    with zipfile.ZipFile(path) as package:
        assert package.read(name.decode()) == data
    assert read_back(spark, path) == sorted((i, len(h), digest(h), "response", None) for i, _, h in rows)


def test_damage_is_reported(spark, tmp_path):
    (tmp_path / "none.zip").write_bytes(b"no package")
    (tmp_path / "empty.zip").write_bytes(b"")
    data = bytearray(archive(many(2), packed=False))
    data[-5] ^= 1  # in the payload of the last record
    with zipfile.ZipFile(tmp_path / "wrong.zip", "w") as package:
        package.writestr("archive/data.warc", bytes(data))
    with zipfile.ZipFile(tmp_path / "squeezed.zip", "w", zipfile.ZIP_DEFLATED) as package:
        package.writestr("archive/data.warc", bytes(data))
    listed = warc.packages(spark, str(tmp_path))  # Spark leaves out empty files
    found = warc.members(listed.union(spark.createDataFrame([(str(tmp_path / "empty.zip"),)], listed.schema))).collect()
    said = {os.path.basename(r.package): (r.method, r.error and r.error.split(":")[0]) for r in found}
    assert said == {"none.zip": (None, "ValueError"), "empty.zip": (None, "ValueError"), "wrong.zip": (0, None), "squeezed.zip": (8, None)}
    errors = [r.error for r in warc.records(warc.ranges(warc.packages(spark, str(tmp_path)))).orderBy("start").collect()]
    assert errors == [None, "the payload has another digest"]


def test_what_is_lost_of_a_manifest_is_an_error(spark, tmp_path):
    """Pages that cannot all be read back are no result, whatever part of a package is damaged."""
    manifest = warc.write(table(spark, many(40)).repartition(2), str(tmp_path))
    first = manifest.orderBy("package").first().package
    with open(first, "rb") as f:
        whole = f.read()
    place = {name: (at, size) for name, _, at, size in warc.directory(warc.File(first))}
    (index, size), (data, _) = place[warc.INDEX], place[warc.ARCHIVE]
    line = whole.index(b"\n", index) - index + 1  # of the index, its first
    damaged = {
        "records of": whole[:index] + b"\n" * line + whole[index + line :],
        "without a place": whole[: index + size - 9] + b"\n" + b"x" * 8 + whole[index + size :],
        "gzip": whole[:data] + b"\x1f\x8b" + b"x" * 8 + whole[data + 10 :],
        "central directory": whole[:-9],
        "ValueError": b"no package",
    }
    for said, now in damaged.items():
        with open(first, "wb") as f:
            f.write(now)
        found = warc.records(warc.ranges(manifest))
        assert found.where("error is not null").count() > 0, said
        with pytest.raises(Exception, match="not read back"):
            warc.pages(found).count()
    os.remove(first)
    with pytest.raises(Exception, match="not read back.*No such file"):
        warc.pages(warc.records(warc.ranges(manifest))).count()


def test_damage_within_packages_of_others_is_reported(spark, tmp_path):
    """Each found record stays, and one with an error says that others may be missing."""
    rows = many(6)
    with zipfile.ZipFile(tmp_path / "short.zip", "w") as package:
        package.writestr("archive/data.warc.gz", archive(rows)[:-3])
    with zipfile.ZipFile(tmp_path / "index.zip", "w") as package:
        package.writestr("archive/data.warc.gz", archive(rows))
        package.writestr("indexes/index.cdxj", "!head 1.0\n\ncom,h)/ 2020 {")
    body = io.BytesIO()
    with zipfile.ZipFile(body, "w") as package:
        package.writestr("archive/data.warc.gz", archive(rows))
    (tmp_path / "cut.zip").write_bytes(body.getvalue()[:-40])
    (tmp_path / "none.zip").write_bytes(b"no package")
    ranges = warc.ranges(warc.packages(spark, str(tmp_path)))
    seen = sorted((os.path.basename(r.package), r.error and r.error.split(":")[0]) for r in ranges.where("error is not null").collect())
    wrong = [("cut.zip", "ValueError"), ("index.zip", "JSONDecodeError"), ("none.zip", "ValueError"), ("short.zip", "EOFError")]
    assert seen == wrong
    found = warc.records(ranges).collect()
    assert sorted((os.path.basename(r.package), r.error.split(":")[0]) for r in found if r.error) == wrong[:2] + wrong[3:]
    assert sorted(r.record_id for r in found if not r.error) == [f"<urn:page:{i}>" for i in range(5)]


def test_empty_table_and_one_payload_in_most_rows(spark, tmp_path):
    manifest = warc.write(table(spark, []), str(tmp_path / "a"))
    assert warc.pages(warc.records(warc.ranges(manifest))).count() == 0 and manifest.count() == 0
    rows = spark.range(3000).select(
        F.col("id").alias("page_id"),
        F.lit("u").alias("url"),
        F.when(F.col("id") % 3 > 0, F.lit("hot" * 500)).otherwise(F.col("id").cast("string")).alias("html"),
        F.lit(1).alias("digest"),
        F.lit(2).alias("refers"),
    )
    got = warc.pages(warc.records(warc.ranges(warc.write(rows, str(tmp_path / "b"))))).groupBy("record_type", "refers_to").count()
    assert {tuple(r) for r in got.collect()} == {("response", None, 1001), ("revisit", 2999, 1999)}
