"""Archives written and read back, and archives that are damaged."""

import base64
import hashlib
import random

import zstandard

from recordlens.llm.warc import (
    DICTIONARY_FRAME,
    SEPARATOR,
    archive,
    page_number,
    read_archives,
    record,
    records_of,
    write_archives,
)

SCHEMA = "page_id long, url string, html string, payload string, digest int, path string"


def prose(rng, n):
    return "".join(f"<p>{rng.choice(['one', 'zwei', 'trois', 'ночь'])} {rng.random()}</p>" for _ in range(n))


def pages(spark, rows):
    return spark.createDataFrame([(*r, "clash", 3, "x") for r in rows], SCHEMA).repartition(3)


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def expected(rows, min_bytes=0):
    out = []
    for page_id, _, html in rows:
        n = len((html or "").encode())
        same = [p for p, _, other in rows if (other or "") == (html or "") and p is not None]
        first = max(same) if len(same) and n >= min_bytes else None
        copies = sum((other or "") == (html or "") for _, _, other in rows)
        revisit = first is not None and copies > 1 and page_id != first
        out.append(
            (page_id, n, digest(html), "revisit" if revisit else "response", first if revisit else None)
        )
    return sorted(out, key=repr)


def rows_of(found):
    names = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    frame = found.select(
        page_number(found.record_id).alias("page_id"), "payload_bytes", "payload_digest",
        "record_type", page_number(found.refers_to).alias("refers_to"), "problem",
    )
    got = frame.collect()
    assert all(r.problem is None for r in got)
    return sorted((tuple(r[n] for n in names) for r in got), key=repr)


def odd_rows():
    rng = random.Random(3)
    rows = [(i, f"http://a.example/{i}", prose(rng, rng.randrange(40))) for i in range(60)]
    rows += [(100 + i, "http://copies.example", "<p>copy</p>") for i in range(40)]
    rows += [(200, None, None), (201, "", ""), (202, "http://x\r\nWARC-Type: bad", "a\r\n\r\nb\r\n\r\n")]
    rows += [(None, "u", "<p>copy</p>"), (None, None, "only without id"), (None, "v", "only without id")]
    rows += [(210, "u", "twice"), (210, "u", "twice"), (-5, "u", "negative"), (-6, "u", "negative")]
    rows += [(220, "long", prose(rng, 30_000)), (221, "퟿ ünï", "P*M\x18\0\0\0\0 WARC/1.1")]
    return rows


def test_round_trip(spark, tmp_path):
    rows = odd_rows()
    write_archives(pages(spark, rows), str(tmp_path / "a"), archive_bytes=1 << 16)
    assert len(list((tmp_path / "a").glob("part-*"))) > 5
    assert rows_of(read_archives(spark, str(tmp_path / "a"))) == expected(rows)


def test_payloads_come_back(spark, tmp_path):
    rows = odd_rows()
    write_archives(pages(spark, rows), str(tmp_path / "a"))
    found = {r.record_id: r for r in read_archives(spark, str(tmp_path / "a")).collect()}
    for page_id, url, html in rows:
        if page_id is not None:
            one = found[f"urn:page:{page_id}"]
            assert one.payload is None or bytes(one.payload) == (html or "").encode()
            assert (one.payload is None) == (one.record_type == "revisit")
            assert "\r" not in (one.target_uri or "")
    assert found["urn:page:5"].target_uri == "http://a.example/5"


def test_small_payloads_are_responses(spark, tmp_path):
    rows = odd_rows()
    write_archives(pages(spark, rows), str(tmp_path / "a"), min_bytes=6)
    assert rows_of(read_archives(spark, str(tmp_path / "a"))) == expected(rows, 6)


def test_empty_table(spark, tmp_path):
    write_archives(pages(spark, odd_rows()).limit(0), str(tmp_path / "a"))
    assert read_archives(spark, str(tmp_path / "a")).collect() == []


def some_records(n=200):
    rng = random.Random(1)
    bodies = [prose(rng, 30).encode() for _ in range(n)]
    return [record(f"urn:page:{i}", b, hashlib.sha1(b).digest(), len(b)) for i, b in enumerate(bodies)]


def test_a_frame_for_each_record_behind_the_dictionary():
    frames = list(archive(some_records()))
    assert len(frames) == 201
    assert int.from_bytes(frames[0][:4], "little") == DICTIONARY_FRAME
    made = zstandard.ZstdCompressionDict(
        zstandard.ZstdDecompressor().decompress(frames[0][8:]), dict_type=zstandard.DICT_TYPE_FULLDICT
    )
    unpacker = zstandard.ZstdDecompressor(dict_data=made)
    assert [unpacker.decompress(f) for f in frames[1:]] == some_records()
    # The dictionary may also lie there uncompressed, and separators may follow any frame.
    plain = frames[0][:4] + len(made.as_bytes()).to_bytes(4, "little") + made.as_bytes()
    data = plain + b"".join(f + SEPARATOR.encode() for f in frames[1:])
    found = list(records_of(data))
    assert [r["record_id"] for r in found] == [f"urn:page:{i}" for i in range(200)]
    assert all(r["problem"] is None for r in found)


def test_other_compressors_frames():
    """Frames of unknown size, of several blocks, and with runs."""
    body = b"z" * 300_000 + random.Random(2).randbytes(400_000)
    one = record("urn:page:1", body, hashlib.sha1(body).digest(), len(body))
    for options in ({"write_content_size": False}, {"write_checksum": True}, {"level": 19}):
        packer = zstandard.ZstdCompressor(**options).compressobj()
        frame = packer.compress(one) + packer.flush()
        (found,) = records_of(frame)
        assert found["problem"] is None and found["payload"] == body


def problem(data):
    return [r["problem"] for r in records_of(data)]


def test_damage_is_reported_and_the_rest_is_read():
    pack = zstandard.ZstdCompressor(write_checksum=True).compress
    good = some_records(3)
    cases = {
        "no WARC header": b"HTTP/1.1 200 OK",
        "malformed header line": good[1].replace(b"WARC-Type:", b"WARC-Type"),
        "no warc-date": good[1].replace(b"WARC-Date:", b"X-Date:"),
        "content-length is not the block's": good[1][:-1],
        "payload digest does not match": good[1].replace(b"<p>", b"<q>", 1),
        "HTTP content-length is not the payload's": record("urn:page:1", b"abc", b"", 4),
        "no HTTP head": good[1].replace(b"HTTP/1.1", b"FTPP/1.1"),
    }
    for name, bad in cases.items():
        assert problem(pack(good[0]) + pack(bad) + pack(good[2])) == [None, name, None]
    # Two records in a frame are not one.
    assert problem(pack(good[0] + good[1])) == ["content-length is not the block's"]
    # A flipped byte inside a frame costs that record alone.
    frames = [pack(r) for r in good]
    frames[1] = frames[1][:-8] + bytes([frames[1][-8] ^ 255]) + frames[1][-7:]
    assert [p is None for p in problem(b"".join(frames))] == [True, False, True]
    # A cut file ends in one problem.
    assert problem(b"".join(frames[::2])[:-5]) == [None, "frame cut short"]
    assert problem(b"not an archive") == ["not a frame"]
    assert problem(b"") == []
