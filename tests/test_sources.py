"""Readers and sinks on files of their own: CSV by ranges against the plain reader."""

from __future__ import annotations

import csv
import random
import zipfile

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from glyphforge.sources import archives, csv_ranges, readers, sinks


def state_machine(lines, within):
    """The state before each line and after the last, character by character."""
    out = []
    for line in lines:
        out.append(within)
        k, start = 0, not within
        quoted = within
        while k < len(line):
            c = line[k]
            if quoted:
                if c == '"':
                    if line[k + 1 : k + 2] == '"':
                        k += 1
                    else:
                        quoted, start = False, False
            elif c == ",":
                start = True
            elif c == '"' and start:
                quoted, start = True, False
            else:
                start = False
            k += 1
        within = quoted
    return [*out, within]


def test_effects_of_lines():
    rng = random.Random(4)
    for _ in range(400):
        lines = ["".join(rng.choice('a,"" x') for _ in range(rng.randint(0, 9))) for _ in range(rng.randint(0, 12))]
        both = csv_ranges.effects(pa.array(lines, pa.string()))
        for first in (False, True):
            assert csv_ranges.inside(*both, first).tolist() == state_machine(lines, first)


def csv_text(rng, rows, ending, nasty):
    cells = ["plain", "", "two words", "é漢", 'say "hi"', "line\nbreak", "cr\r\nlf", "\n", "a,b", '"', "\n\n,\n", "x" * 90]
    quote = lambda c: '"' + c.replace('"', '""') + '"' if any(x in c for x in '",\r\n') else c
    out = ["id,first name,last"]
    for k in range(rows):
        line = [str(k), quote(rng.choice(cells)), quote(rng.choice(cells))]
        if nasty and rng.random() < 0.1:
            line[1] = '5" pipe'
        out.append(",".join(line))
        if rng.random() < 0.02:
            out.append("")
    return ending.join(out) + (ending if rng.random() < 0.5 else "")


def told(path):
    """The rows below the header, by Python's own reader; blank cells are trimmed by none, missing ones do not occur."""
    with open(path, encoding="utf-8-sig", newline="") as f:
        return [tuple(r) for r in csv.reader(f) if r][1:]


@pytest.mark.parametrize(("ending", "nasty"), [("\n", False), ("\r\n", False), ("\n", True)])
def test_csv_by_ranges(spark, tmp_path, ending, nasty):
    rng = random.Random(7)
    for k in range(3):
        (tmp_path / f"part {k}.csv").write_bytes((("﻿" if k < 2 else "") + csv_text(rng, [250, 30, 1][k], ending, nasty)).encode())
    for path in (f"{tmp_path}/part 0.csv", str(tmp_path)):
        want = sorted(row for p in ([path] if path.endswith("csv") else sorted(tmp_path.iterdir())) for row in told(p))
        for size in (211, 1000, 1 << 20):
            got = readers.read_csv(spark, path, range_bytes=size)
            assert got.columns == ["id", "first name", "last"]
            assert sorted(map(tuple, got.collect())) == want
    got = readers.read_csv(spark, f"{tmp_path}/part 0.csv", ordinal=True, range_bytes=211)
    assert csv_ranges.lines_of(spark, f"{tmp_path}/part 0.csv", 211).rdd.getNumPartitions() >= 8
    assert [r.id for r in sorted(got.collect(), key=lambda r: r._ord)] == [str(k) for k in range(250)]


def test_csv_ranges_edges(spark, tmp_path):
    """A cell longer than many ranges, many ranges inside it, all ways of telling ranges where they start; odd files."""
    long = "\n".join(f"line {k}, with ""quotes""" for k in range(400))
    (tmp_path / "a.csv").write_text("k,v\n1,\"" + long + "\"\n2,x\n\"3\",\"y\n\"\n4,open \"quote\n")
    want = sorted(readers.read_csv(spark, f"{tmp_path}/a.csv").collect())
    assert len(want) == 4 and want[0].v == long
    assert sorted(readers.read_csv(spark, f"{tmp_path}/a.csv", range_bytes=100).collect()) == want
    rows = csv_ranges.rows_of(spark, f"{tmp_path}/a.csv", 100, most_broadcast=0)
    assert sorted(r.text.split(",")[0] for r in rows.collect()) == ['"3"', "1", "2", "4", "k"]
    (tmp_path / "b.csv").write_text("only,a,header\n")
    assert readers.read_csv(spark, f"{tmp_path}/b.csv", range_bytes=3).collect() == []
    (tmp_path / "c.csv").write_text("")
    assert readers.read_csv(spark, f"{tmp_path}/c.csv", range_bytes=3).count() == 0
    (tmp_path / "d.csv").write_text('"a\nb",c\n1,2\n')  # a header over two ranges
    got = readers.read_csv(spark, f"{tmp_path}/d.csv", range_bytes=2)
    assert got.columns == ["a\nb", "c"] and [tuple(r) for r in got.collect()] == [("1", "2")]


def test_inside_of_no_lines():
    assert csv_ranges.inside(np.zeros(0, bool), np.zeros(0, bool), True).tolist() == [True]


# ---- archives


def test_archive_by_ranges(spark, tmp_path):
    """1,000 members by four tasks and more: names of three encodings, all ways of packing, unsafe members, a file before the archive."""
    want = {}
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        for k in range(1000):
            data = f"content {k} ".encode() * (k % 50)
            info = zipfile.ZipInfo(f"폴더/파일 {k}.txt" if k % 2 else f"plain/{k}.txt")
            info.compress_type = [zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED, zipfile.ZIP_BZIP2, zipfile.ZIP_LZMA][k % 4]
            z.writestr(info, data)
            want[info.filename] = data
        for bad in ("/abs.txt", "../up.txt", "a/../../b.txt", "dir/", "C:/x.txt"):
            z.writestr(bad, b"")
    raw = (tmp_path / "a.zip").read_bytes()
    (tmp_path / "a.zip").write_bytes(b"#!/bin/sh\n" + raw)
    got = readers.read_archives(spark, str(tmp_path / "a.zip"), contents=True, members=250)
    assert got.rdd.getNumPartitions() == 5
    assert {r.member: bytes(r.content) for r in got.collect()} == want
    assert {r.member: r.size for r in readers.read_archives(spark, str(tmp_path), members=10**6).collect()} == {k: len(v) for k, v in want.items()}


def test_archive_of_old_names(spark, tmp_path):
    """Names of bytes in cp949 that nothing marks: Python writes them as cp437 if told so."""
    name = "한글.txt".encode("cp949").decode("cp437")

    class Old(zipfile.ZipInfo):
        def _encodeFilenameFlags(self):
            return self.filename.encode("cp437"), self.flag_bits & ~0x800

    with zipfile.ZipFile(tmp_path / "old.zip", "w") as z:
        z.writestr(Old(name), b"x")
    assert [r.member for r in readers.read_archives(spark, str(tmp_path)).collect()] == ["한글.txt"]


def test_large_directory(tmp_path):
    """More members than the old end record can count."""
    path = tmp_path / "many.zip"
    with zipfile.ZipFile(path, "w") as z:
        for k in range(66_000):
            z.writestr(zipfile.ZipInfo(str(k)), b"")
    with path.open("rb", buffering=0) as f:
        d = archives.directory(f, path.stat().st_size)
        assert d.entries == 66_000
        assert [m.name for m in archives.members(f, d, 65_990, 65_993)] == ["65990", "65991", "65992"]


def test_bad_archives(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("a.txt", b"some content")
    data = bytearray((tmp_path / "a.zip").read_bytes())
    data[data.index(b"some")] ^= 1
    (tmp_path / "a.zip").write_bytes(bytes(data))
    assert readers.read_archives(spark, str(tmp_path)).count() == 1
    with pytest.raises(Exception, match="damaged"):
        readers.read_archives(spark, str(tmp_path), contents=True).collect()
    (tmp_path / "a.zip").write_bytes(b"none")
    with pytest.raises(Exception, match="not a ZIP archive"):
        readers.read_archives(spark, str(tmp_path)).collect()
    with pytest.raises(Exception, match="nowhere"):
        readers.read_archives(spark, str(tmp_path / "nowhere")).collect()


def test_archives_written_or_not(spark, tmp_path):
    """A run that fails leaves what was there, and no temporary files; one that succeeds replaces it."""
    out = str(tmp_path / "out")
    df = spark.range(40).repartition(4)
    sinks.write_archives(df, out, F.concat(F.lit("m"), "id"), F.col("id").cast("string"))
    old = sorted(p.name for p in (tmp_path / "out").iterdir())
    assert sum(n.endswith(".zip") for n in old) == 4
    broken = F.when(F.col("id") == 33, F.raise_error(F.lit("stop"))).otherwise(F.col("id").cast("string"))
    with pytest.raises(Exception, match="stop"):
        sinks.write_archives(df, out, F.concat(F.lit("n"), "id"), broken)
    assert [n for n in sorted(p.name for p in (tmp_path / "out").iterdir()) if not n.endswith(".tmp")] == old
    sinks.write_archives(df.limit(3), out, F.concat(F.lit("k"), "id"), F.lit(""))
    assert sorted(r.member[0] for r in readers.read_archives(spark, out).collect()) == ["k"] * 3


def test_ranges_of_an_archive_are_bounded(spark, tmp_path):
    """each range passes over the entries before it, so an archive has a fixed number of ranges at most."""
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        for i in range(1000):
            z.writestr(f"{i}", "x")
    ranges = archives.ArchiveReader({"path": str(tmp_path / "a.zip"), "members": "2"}).partitions()
    assert len(ranges) <= archives.RANGES and [r.first for r in ranges[1:]] == [r.last for r in ranges[:-1]] and ranges[-1].last == 1000
    assert readers.read_archives(spark, str(tmp_path), members=2).select("member").distinct().count() == 1000


def test_ranges_of_the_csv_query_are_bounded(spark, monkeypatch):
    """F8: a task's range does not grow with the file."""
    from glyphforge.plans import file_queries

    asked = []
    kept = readers.read_csv
    monkeypatch.setattr(csv_ranges, "RANGE_BYTES", 20_000)
    monkeypatch.setattr(file_queries.readers, "read_csv", lambda spark, path, **k: asked.append(k["range_bytes"]) or kept(spark, path, **k))
    got = file_queries.csv_by_ranges(spark, "/root/testdata/sf0.001")
    assert asked == [20_000] and got.count() == spark.read.parquet("/root/testdata/sf0.001/documents.parquet").count()
