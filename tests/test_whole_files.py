"""Fingerprints cover the content of files of any size."""

import os

import pytest

from stallbook.sources.fingerprint import changed_files, fingerprint


@pytest.mark.parametrize("limit", [10, 1 << 20])
def test_a_rewrite_of_equal_length_and_time_is_seen(spark, tmp_path, limit):
    path, other = tmp_path / "a b.csv", tmp_path / "other.csv"
    path.write_bytes(b"one,1\ntwo,2\n" * 500 + b"\xff\x00\r\n")
    other.write_bytes(b"x" * 5000)
    times = os.stat(path)
    before = spark.createDataFrame(fingerprint(spark, str(tmp_path), limit).collect())
    assert before.count() == 2 and changed_files(before, fingerprint(spark, str(tmp_path), limit)).isEmpty()
    for new in (b"one,1\ntwo,3\n" + b"one,1\ntwo,2\n" * 499 + b"\xff\x00\r\n", b"one,1\ntwo,2\n" * 500 + b"\xfe\x00\r\n"):
        path.write_bytes(new)
        os.utime(path, ns=(times.st_atime_ns, times.st_mtime_ns))
        changed = changed_files(before, fingerprint(spark, str(tmp_path), limit)).collect()
        assert [r["path"].endswith("b.csv") for r in changed] == [True]


@pytest.mark.parametrize("split", [64, 1 << 20])
def test_swapped_and_moved_lines_are_seen_at_every_size(spark, tmp_path, split):
    lines = [b"line %d" % (n % 700) for n in range(2000)]
    path = tmp_path / "ledger.csv"
    kept = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split * 64))
    try:
        digests = set()
        swapped = [*lines[:100], lines[101], lines[100], *lines[102:]]
        far = [lines[1999], *lines[1:1999], lines[0]]
        for content in (lines, swapped, far, [*lines[1:], lines[0]], lines[:1999], [*lines, b""]):
            path.write_bytes(b"\n".join(content))
            whole, small = fingerprint(spark, str(path)).first(), fingerprint(spark, str(path), 10).first()
            assert whole.content_digest == small.content_digest and (whole.of_content, small.of_content) == (True, False)
            digests.add(whole.content_digest)
        assert len(digests) == 6
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", kept)


def test_digests_do_not_depend_on_splits(spark, tmp_path):
    path = tmp_path / "data.csv"
    path.write_bytes(b"".join(b"line %d,\xe9\n" % n for n in range(5000)))
    whole = fingerprint(spark, str(path), 10).first()
    kept = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        assert fingerprint(spark, str(path), 10).first() == whole
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", kept)
