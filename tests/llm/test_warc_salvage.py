import gzip
import hashlib
import io
import random

import pytest

from tidemark.llm import warc_salvage
from tidemark.llm.warc_salvage import Gap, Record, member, payload_of, salvage

PAGES = [(f"{i}", f"http://example.org/{i}", (f"<p>page {i}</p>" * (i % 7 * 20 + 1)).encode()) for i in range(20)]


def archive(plain=False):
    members = [member(p, u, b, None) for p, u, b in PAGES]
    return [gzip.decompress(m) for m in members] if plain else members


def read(data):
    return list(salvage(io.BytesIO(data)))


@pytest.mark.parametrize("plain", [False, True])
def test_reads_back_what_was_written(plain):
    parts = archive(plain)
    found = read(b"".join(parts))
    assert [payload_of(r) for r in found] == [b for _, _, b in PAGES]
    assert [r.length for r in found] == [len(p) for p in parts]


@pytest.mark.parametrize("plain", [False, True])
@pytest.mark.parametrize("chunk", [1 << 20, 37])
def test_salvages_around_every_kind_of_damage(plain, chunk, monkeypatch):
    monkeypatch.setattr(warc_salvage, "CHUNK", chunk)
    source = random.Random(7)
    for trial in range(60):
        parts = archive(plain)
        broken = sorted(source.sample(range(len(parts)), 3))
        for b in broken:
            data = bytearray(parts[b])
            kind = source.choice(["flip", "cut", "noise"])
            if kind == "flip":
                # In a gzip member any changed byte of the body or the checksum counts; some header bytes don't matter.
                place = source.randrange(12, len(data)) if not plain else data.index(b"<p>") + source.randrange(5)
                data[place] ^= 1 << source.randrange(8)
            elif kind == "cut":
                del data[source.randrange(len(data) // 3, len(data) - 1) :]
            else:
                data[:] = bytes(source.randrange(32, 127) for _ in range(source.randint(1, 400)))
            parts[b] = bytes(data)
        found = read(b"".join(parts))
        whole = [payload_of(r) for r in found if isinstance(r, Record)]
        want = [b for i, (_, _, b) in enumerate(PAGES) if i not in broken]
        assert [w for w in whole if w in want] == want, trial
        at = 0
        for piece in found:
            assert piece.offset == at
            at += piece.length
        assert at == sum(map(len, parts))
        gaps = [g for g in found if isinstance(g, Gap)]
        assert gaps and all(g.reason for g in gaps)


def test_nothing_and_noise():
    assert read(b"") == []
    assert [(g.offset, g.length) for g in read(b"no archive at all")] == [(0, 17)]
    assert [type(x) for x in read(b"\x1f\x8b\x08")] == [Gap]


def test_pages_round_trip(frame, rows):
    text = "<p>" + "a page of more than a hundred bytes " * 4 + "é</p>"
    data = [(5, "u", text), (3, "u", text), (9, "v w", text), (7, "u", "short"), (8, "u", "short"), (1, None, None), (2, "u", "")]
    data += [(None, "u", text), (11, "u", "long" * 200_000), (12, "u", "x" * 100), (13, "u", "x" * 100), (14, "u", "x" * 99), (15, "u", "x" * 99)]
    data += [(3, "u", text)]
    got = rows(warc_salvage.page_records(frame(data, "page_id long, url string, html string")))
    first = {}
    for i, _, h in data:
        if h and len(h.encode()) >= 100 and i is not None:
            first[h] = min(first.get(h, i), i)
    want = []
    for i, _, h in data:
        b = (h or "").encode()
        f = first.get(h)
        again = f is not None and (i is None or f < i)
        want.append((i, len(b), hashlib.sha256(b).hexdigest(), "revisit" if again else "response", f if again else None))
    assert got == sorted(want, key=repr)


def test_gaps_are_logged_with_their_file(spark, tmp_path):
    parts = archive()
    parts[4] = parts[4][:-9]
    (tmp_path / "a.warc.gz").write_bytes(b"".join(parts))
    files = spark.createDataFrame([(str(tmp_path / "a.warc.gz"),)], "path string")
    found = warc_salvage.read_archives(files, f"file://{tmp_path}", payloads=True).collect()
    gaps = [r for r in found if r["gap"]]
    assert [(g["offset"], g["length"]) for g in gaps] == [(sum(map(len, parts[:4])), len(parts[4]))]
    assert sorted(bytes(r["payload"]) for r in found if not r["gap"]) == sorted(b for i, (_, _, b) in enumerate(PAGES) if i != 4)


def test_missing_file_fails(spark, tmp_path):
    files = spark.createDataFrame([(str(tmp_path / "none.warc"),)], "path string")
    with pytest.raises(Exception, match="no archive"):
        warc_salvage.read_archives(files, f"file://{tmp_path}").collect()


def test_no_pages(frame):
    assert warc_salvage.page_records(frame([], "page_id long, url string, html string")).collect() == []


def plain_record(number, payload, extra=b"", digest=True):
    claim = f"WARC-Payload-Digest: sha256:{hashlib.sha256(payload).hexdigest()}\r\n".encode() if digest else b""
    head = b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:x:%d>\r\n" % number + claim + extra
    return head + b"Content-Length: %d\r\n\r\n" % len(payload) + payload + b"\r\n\r\n"


def numbers(found):
    return [int(r.headers["warc-record-id"][7:-1]) for r in found if isinstance(r, Record)]


def test_long_headers_are_read_whole():
    data = plain_record(1, b"a" * 200, b"WARC-Target-URI: http://x/" + b"y" * 200_000 + b"\r\n") + plain_record(2, b"b")
    assert numbers(salvage(io.BytesIO(data))) == [1, 2]
    # A header whose blank line is lost ends at the next version line.
    broken = plain_record(1, b"a" * 200).replace(b"\r\n\r\n", b"\r\n", 1).replace(b"\r\n\r\n", b"\r\n") + plain_record(2, b"b")
    found = list(salvage(io.BytesIO(broken)))
    assert numbers(found) == [2] and isinstance(found[0], Gap)


def test_members_of_several_records():
    parts = [plain_record(i, bytes([65 + i]) * 3000, digest=i % 2 == 0) for i in range(4)]
    whole = gzip.compress(b"".join(parts))
    tail = gzip.compress(plain_record(9, b"z"))
    assert numbers(salvage(io.BytesIO(whole + tail))) == [0, 1, 2, 3, 9]
    # Damage to one of them loses that one.
    bad = parts[2].replace(b"C" * 3000, b"C" * 2999 + b"x")
    found = list(salvage(io.BytesIO(gzip.compress(parts[0] + parts[1] + bad + parts[3]) + tail)))
    assert numbers(found) == [0, 1, 3, 9] and sum(isinstance(f, Gap) for f in found) == 1


def test_a_member_that_breaks_off_keeps_what_passed():
    source = random.Random(1)
    parts = [plain_record(i, source.randbytes(40_000)) for i in range(4)]
    whole = gzip.compress(b"".join(parts))
    tail = gzip.compress(plain_record(9, b"z"))
    found = list(salvage(io.BytesIO(whole[:110_000] + tail)))
    assert numbers(found) == [0, 1, 9] and sum(isinstance(f, Gap) for f in found) == 1
    # Without digests nothing vouches for them but the checksum.
    parts = [plain_record(i, source.randbytes(40_000), digest=False) for i in range(4)]
    assert numbers(salvage(io.BytesIO(gzip.compress(b"".join(parts))[:110_000] + tail))) == [9]
