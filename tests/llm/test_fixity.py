import hashlib

import pytest
from ledgerlens.llm import fixity, registry
from ledgerlens.llm.staging import keep
from pyspark.sql import functions as F


def test_oracle_sql(spark, sf_dir, duck):
    got = registry.op6_fixity(spark, sf_dir)
    res = duck.execute(registry.oracle_sql()["op6_fixity"])
    names = [d[0] for d in res.description]
    assert sorted(map(tuple, got.select(*names).collect())) == sorted(res.fetchall())


def _brute_tree(records):
    """{(archive, level, node): hash}"""
    out, level = {}, {}
    for a, o, h in sorted(records):
        level.setdefault((a, o >> 16), []).append(f"{o}:{h}")
    for i, bits in enumerate(fixity.LEVELS):
        now = {k: hashlib.sha256(",".join(v).encode()).hexdigest() for k, v in level.items()}
        out.update({(a, i, n): h for (a, n), h in now.items()})
        level = {}
        step = fixity.LEVELS[i + 1] - bits if i + 1 < len(fixity.LEVELS) else 0
        for a, n in sorted(now):
            level.setdefault((a, n >> step), []).append(f"{n}:{now[a, n]}")
    return out


def _records(n, size=30_000, archives=3):
    return [(i % archives, (i // archives) * size, hashlib.sha256(str(i).encode()).hexdigest()) for i in range(n)]


def test_damage_is_located(spark):
    ours = _records(900)
    theirs = [r for r in ours if r[:2] != (0, 30_000)]
    theirs = [(a, o, "0" * 64) if (a, o) == (1, 60_000 * 20) else (a, o, h) for a, o, h in theirs] + [(1, 7, "f" * 64), (9, 0, "e" * 64)]
    frame = lambda r, name: keep(spark.createDataFrame([(*x, 30_000) for x in r], "archive bigint, offset bigint, hash string, size bigint"), name)
    a, b = frame(ours, "ours"), frame(theirs, "theirs")
    assert {(r.archive, r.level, r.node): r.hash for r in fixity.tree(a).collect()} == _brute_tree(ours)
    roots, bad, nodes = fixity.audit(a, b)
    assert {r.archive for r in roots.collect() if r.root != r.replica_root} == {0, 1, 9}
    assert {(r.archive, r.offset, r.ours is None, r.theirs is None) for r in bad.collect()} == {(0, 30_000, False, True), (1, 1_200_000, False, False), (1, 7, True, False), (9, 0, True, False)}
    # the intact archive is looked at in its root only
    assert nodes.where("archive = 2").count() == 1 and nodes.where("archive = 0").count() < 60
    got = {r.archive: r for r in fixity.report(a, b).collect()}
    assert got[2].intact and not got[0].intact and got[0].bad == "30000:missing" and got[1].bad == "7:extra,1200000:changed" and got[9].n_records == 0


def test_layout_and_defined_cases(spark):
    rows = [(i % 40, f"u{i % 7}", f"<p>{i % 11}é</p>", "k") for i in range(500)] + [(None, None, None, "k")] * 3 + [(5, "", "", "k")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, archive string")
    recs = fixity.warc_records(pages).withColumn("hash", F.sha2("record", 256)).withColumn("size", F.octet_length("record").cast("bigint"))
    got = fixity.laid_out(recs, 64).orderBy("archive", "offset").collect()
    assert len(got) == len(rows)
    at = {}
    for r in got:
        assert r.offset == at.get(r.archive, 0) and len(r.record.encode()) == r.size
        at[r.archive] = r.offset + r.size
    assert sorted(at) == list(range(-(-len(rows) // 64)))
    key = [((r.page_id is not None, r.page_id or 0), (r.url is not None, r.url or ""), r.hash) for r in got]
    assert key == sorted(key)
    assert any(r.record.endswith("Content-Length: 10\r\n\r\n<p>3é</p>\r\n\r\n") for r in got)
    empty = keep(fixity.laid_out(recs.limit(0)).drop("record"), "none")
    assert fixity.report(empty, empty).count() == 0


def test_too_large_an_archive_is_refused(spark):
    big = keep(spark.createDataFrame([(0, 1 << 33, "a", 1)], "archive bigint, offset bigint, hash string, size bigint"), "big")
    with pytest.raises(Exception, match="4 GiB"):
        fixity.tree(big)
