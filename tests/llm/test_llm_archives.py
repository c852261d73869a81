"""Archives: exact round trip, and salvage of damaged ones."""

import gzip
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from corpusloom.llm import warc

PAGES = "page_id bigint, url string, html string"


def pages_of(spark, rows):
    frame = spark.createDataFrame(rows, PAGES)
    for name in ("name", "payload", "digest", "size"):
        frame = frame.withColumn(name, F.lit("x"))
    return frame


def expected(rows):
    first = {}
    for i, _, html in rows:
        data = (html or "").encode()
        if len(data) >= 100 and i is not None:
            first[data] = min(i, first.get(data, i))
    out = []
    for i, _, html in rows:
        data = (html or "").encode()
        refers = first.get(data)
        refers = None if refers == i else refers
        kind = "response" if refers is None else "revisit"
        out.append((i, len(data), hashlib.sha256(data).hexdigest(), kind, refers))
    return sorted(out, key=repr)


def round_trip(spark, path, rows):
    warc.write(pages_of(spark, rows), path)
    back = warc.read_pages(spark, path)
    back = back.withColumns({c: F.col(c).cast("bigint") for c in ("page_id", "refers_to")})
    return sorted((tuple(r) for r in back.collect()), key=repr)


ROWS = [
    (5, "http://a/é?x=1 2", "<p>é</p>" * 40),
    (3, "http://b", "<p>é</p>" * 40),
    (9, None, "<p>é</p>" * 40),
    (9, "http://again", "<p>é</p>" * 40),
    (None, "http://c", "<p>é</p>" * 40),
    (1, "http://d\r\nX: y", ""),
    (2, "http://e", None),
    (4, "http://f", "short"),
    (6, "http://f", "short"),
    (7, "http://g", "WARC/1.1\r\nWARC-Type: response\r\n\r\n\x00\x1f " * 9),
    (8, "http://h", "x" * 99 + "é"),
    (10, "http://i", "x" * 99 + "é"),
]


def test_round_trip(spark, tmp_path):
    assert round_trip(spark, str(tmp_path / "a"), ROWS) == expected(ROWS)
    assert round_trip(spark, str(tmp_path / "b"), []) == []


def test_large_records_go_plain(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "RECORDS_PER_FILE", {200: 4000})
    assert round_trip(spark, str(tmp_path / "a"), ROWS) == expected(ROWS)


def test_files_are_standard_gzip(spark, tmp_path):
    warc.write(pages_of(spark, ROWS), str(tmp_path / "a"))
    data = b"".join(gzip.decompress(p.read_bytes()) for p in sorted((tmp_path / "a").glob("part-*")))
    assert data.count(b"WARC-Record-ID: ") == len(ROWS)


def records(n, seed=0):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        payload = bytes(rng.choices(range(256), k=rng.randint(0, 400)))
        digest = hashlib.sha256(payload).hexdigest()
        out.append((f"urn:page:{i}", payload, warc.record(str(i), "http://x", digest, len(payload), payload, None)))
    return out


def found(data):
    rows = list(warc.salvage(data))
    covered = sorted({(r["offset"], r["length"]) for r in rows})
    at = 0
    for offset, length in covered:  # every byte is a record's or a gap's
        assert offset == at
        at += length
    assert at == len(data)
    return {r["record_id"]: r["payload"] for r in rows if r["kind"] == "record"}, [
        r for r in rows if r["kind"] == "gap"
    ]


@pytest.mark.parametrize("packed", [True, False])
def test_salvage_recovers_everything_outside_the_damage(packed):
    made = records(30)
    parts = [warc.member(x) if packed else x for _, _, x in made]
    whole, gaps = found(b"".join(parts))
    assert whole == {i: p for i, p, _ in made} and not gaps
    rng = random.Random(1)
    for _ in range(40):
        hurt = rng.randrange(30)
        bad = bytearray(parts[hurt])
        kind = rng.choice(["flip", "cut", "junk", "zero"])
        if kind == "flip":
            bad[rng.randrange(len(bad))] ^= 1 << rng.randrange(8)
        elif kind == "cut":
            del bad[rng.randrange(1, len(bad)) :]
        elif kind == "junk":
            bad[:0] = b"\x1f\x8b\x08 WARC/ junk\n"
        else:
            bad[10:40] = bytes(30)
        rows, gaps = found(b"".join([*parts[:hurt], bytes(bad), *parts[hurt + 1 :]]))
        for k, (name, payload, _) in enumerate(made):
            if k != hurt:
                assert rows[name] == payload, kind
        if kind == "junk":
            assert gaps[0]["length"] == 15 and len(rows) == 30
        elif rows.get(made[hurt][0]) != made[hurt][1]:
            assert gaps or made[hurt][0] not in rows


def test_salvage_reasons_and_ends():
    (_, _, a), (_, _, b) = records(2)
    assert [g["reason"] for g in found(b"nothing here")[1]] == ["no version line"]
    assert found(b"") == ({}, [])
    rows, gaps = found(warc.member(a)[:-3])
    assert not rows and gaps[0]["reason"] == "member is cut off"
    rows, gaps = found(a.replace(b"sha256:", b"sha256:0", 1) + b)
    assert list(rows) == ["urn:page:1"] and gaps[0]["reason"] == "digest differs"
    rows, _ = found(warc.member(a + b))
    assert len(rows) == 2


def test_one_damaged_record_of_a_member_leaves_the_others():
    made = records(3)
    bad = made[1][2].replace(b"WARC-Block-Digest: sha256:", b"WARC-Block-Digest: sha256:0", 1)
    whole = warc.member(made[0][2] + bad + made[2][2])
    rows, gaps = found(whole + warc.member(made[1][2]))
    assert rows == {name: payload for name, payload, _ in made}
    (gap,) = gaps
    assert (gap["offset"], gap["length"]) == (0, len(whole))
    start, end = len(made[0][2]), len(made[0][2]) + len(bad)
    assert gap["reason"] == f"digest differs (bytes {start} to {end} of the member)"
    # The same records unpacked lose the same one.
    rows, gaps = found(made[0][2] + bad + made[2][2])
    assert sorted(rows) == [made[0][0], made[2][0]] and len(gaps) == 1


def test_long_urls_and_large_payloads_come_back(spark, tmp_path, monkeypatch):
    """Headers of any length; files by size of what they hold."""
    monkeypatch.setattr(warc, "RECORDS_PER_FILE", {1000: 3, 50_000: 2})
    rows = [(i, "http://h/" + "u" * (30 * i), "x" * (7 * i) + str(i)) for i in range(12)]
    rows += [(20, "http://h/" + "é" * 100_000, "tiny"), (21, "http://h", "p" * 40_000), (22, "u" * 70_000, "p" * 40_000)]
    assert round_trip(spark, str(tmp_path / "a"), rows) == expected(rows)
    files = [f for f in (tmp_path / "a").iterdir() if f.name.startswith("part-")]
    assert max(f.read_bytes().count(b"\x1f\x8b\x08") for f in files) <= 3


def test_gaps_are_reported_by_file(spark, tmp_path):
    made = records(5)
    parts = [warc.member(x) for _, _, x in made]
    (tmp_path / "x.warc.gz").write_bytes(parts[0] + parts[1][:40] + b"".join(parts[2:]))
    (tmp_path / "y.warc").write_bytes(made[1][2])
    rows = warc.read(spark, str(tmp_path)).collect()
    gap = [r for r in rows if r.kind == "gap"]
    assert len(gap) == 1 and gap[0].offset == len(parts[0]) and gap[0].length == 40
    assert gap[0].file.endswith("x.warc.gz")
    assert sorted(r.record_id for r in rows if r.kind == "record") == [f"urn:page:{i}" for i in range(5)]
    assert {bytes(r.payload) for r in rows if r.kind == "record"} == {p for _, p, _ in made}
