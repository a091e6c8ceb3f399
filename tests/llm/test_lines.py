import random

import brute
from ledgerlens.llm import lines, registry
from pyspark.sql import functions as F


def _keys(spark, forms):
    df = spark.createDataFrame([(f,) for f in forms], "f string")
    return {r.f: set(r["keys"]) for r in lines.with_keys(df, "f").collect()}


def _forms(docs):
    return sorted({brute.normal_line(x) for _, t in docs for x in (t or "").split("\n")} - {""})


def _kept(df):
    rows = df.orderBy("rid", "line_no").collect()
    order = {rid: i for i, rid in enumerate(dict.fromkeys(r.rid for r in rows))}
    return {(order[r.rid], r.line_no) for r in rows if r.kept and r.line_no is not None}


def _docs():
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9)))
    base = [" ".join(word() for _ in range(n)) for n in (3, 12, 40, 90, 140)]
    docs = []
    for i in range(25):
        mine = []
        for b in base:
            w = b.split()
            for _ in range(rng.randint(0, 2)):
                w[rng.randrange(len(w))] += rng.choice("xyz")
            mine.append(rng.choice((" ", "  ", " - ")).join(w).capitalize() + rng.choice(("", ".", "!")))
        docs.append((100 - i, "\n".join([*mine, "", "posted 12:30", f"page {i} of 25", "***", word()])))
    return docs + [(None, docs[0][1]), (5, None), (6, ""), (7, "***\n\n---"), (8, "same\nsame\nSAME 1\nsame 22")]


def test_groups_equal_brute_force(spark):
    docs = _docs()
    df = spark.createDataFrame(docs, "doc_id bigint, text string").coalesce(1)
    want = brute.kept_lines(docs, _keys(spark, _forms(docs)))
    assert _kept(lines.occurrences(df)) == want
    near = len({(r, k) for r, (_, t) in enumerate(docs) if t is not None for k in range(len(t.split("\n")))}) - len(want)
    assert near > 100


def test_dedup_returns_the_kept_lines(spark):
    docs = _docs()
    want = brute.kept_lines(docs, _keys(spark, _forms(docs)))
    df = spark.createDataFrame([(d, t, "k", 1) for d, t in docs], "doc_id bigint, text string, kept string, line_no int").coalesce(1)
    out = lines.dedup_lines(df)
    assert out.columns == df.columns
    expected = {}
    for r, (d, t) in enumerate(docs):
        if t is None:
            expected[d] = None
            continue
        all_ = t.split("\n")
        left = [x for k, x in enumerate(all_) if (r, k) in want]
        if len(left) == len(all_) or any(brute.normal_line(x) for x in left):
            expected[d] = "\n".join(left)
    assert {r.doc_id: r.text for r in out.collect()} == expected


def test_repeated_rows_lose_their_lines_once(spark):
    df = spark.createDataFrame([(1, "alpha beta\ngamma delta")] * 3, "doc_id bigint, text string")
    assert [r.text for r in lines.dedup_lines(df).collect()] == ["alpha beta\ngamma delta"]
    assert sorted(r.n_removed for r in lines.report(df).collect()) == [0, 2, 2]


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    assert lines.report(df).count() == 0 and lines.dedup_lines(df).count() == 0


def _edited(rng, text, n_edits, kinds="xid"):
    """`text` after n random edits: exchanged, inserted or deleted characters."""
    t = list(text)
    for _ in range(n_edits):
        i, kind = rng.randrange(1, len(t) - 1), rng.choice(kinds)
        t[i:i + (kind != "i")] = [] if kind == "d" else [rng.choice([c for c in "qwzßжい" if c != t[i]])]
    return "".join(t)


def _line(rng, n_words):
    if n_words == 0:  # without spaces
        return "".join(chr(rng.randint(0x4E00, 0x9000)) for _ in range(40))
    return " ".join("".join(rng.choice("abcdefghijklmnoprstuvy") for _ in range(rng.randint(2, 9))) for _ in range(n_words))


def test_recall_by_edits(spark):
    """Pairs that are similar by their edits alone, on lines of 2 to 100 words and on lines without spaces: the share with a common key."""
    rng, pairs = random.Random(11), {}
    for n_words in (0, 2, 3, 5, 12, 20, 50, 100):
        base = [_line(rng, n_words) for _ in range(40)]
        for n_edits, kinds in ((1, "xid"), (2, "x"), (2, "xid"), (4, "x"), (4, "xid")):
            made = [(brute.normal_line(b), brute.normal_line(_edited(rng, b, n_edits, kinds))) for b in base]
            similar = [(a, b) for a, b in made if a != b and 10 * n_edits <= max(len(a), len(b))]
            if len(similar) > 10:
                pairs[n_words, n_edits, kinds] = similar
    keys = _keys(spark, sorted({x for some in pairs.values() for p in some for x in p}))
    found = {k: round(sum(bool(keys[a] & keys[b]) for a, b in some) / len(some), 2) for k, some in pairs.items()}
    print(found)
    assert all(v == 1 for (_, n, _), v in found.items() if n == 1)
    assert all(v >= 0.7 for (_, n, _), v in found.items() if n == 2) and all(v >= 0.9 for (w, n, _), v in found.items() if n == 2 and w >= 20)


def test_copies_with_one_typo_go(spark):
    """End to end: of 200 lines each with a copy with one changed letter, no copy stays."""
    rng = random.Random(12)
    base = [_line(rng, n) for n in (0, 5, 12, 50) for _ in range(50)]
    docs = [(i, b) for i, b in enumerate(base)] + [(1000 + i, _edited(rng, b, 1)) for i, b in enumerate(base)]
    got = lines.report(spark.createDataFrame(docs, "doc_id bigint, text string").repartition(4)).collect()
    assert {r.doc_id for r in got if r.n_removed} == {1000 + i for i in range(200)}


def test_buckets_of_unlike_and_of_near_lines(spark):
    """A bucket with one group of near lines, and one whose lines share a beginning only."""
    rng = random.Random(13)
    near = _line(rng, 15)
    docs = [(i, _edited(rng, near, 1 + i % 2)) for i in range(60)]
    start = _line(rng, 12)
    docs += [(100 + i, f"{start} {_line(rng, 9)}") for i in range(40)]
    keys = _keys(spark, _forms(docs))
    assert _kept(lines.occurrences(spark.createDataFrame(docs, "doc_id bigint, text string").coalesce(1))) == brute.kept_lines(docs, keys)


def test_very_long_lines(spark):
    """Lines of over a megabyte, one with an edit, one with words that have changed places."""
    rng = random.Random(14)
    words = [_line(rng, 1) for _ in range(250_000)]
    other = words.copy()
    other[100_000], other[100_050] = "zzz", "qqq"
    docs = [(1, " ".join(words)), (2, " ".join(other)), (3, "x" * 2_000_000), (4, "x" * 1_000_000 + "y" + "x" * 999_999)]
    got = {r.doc_id: r.n_removed for r in lines.report(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()}
    assert got == {1: 0, 2: 1, 3: 0, 4: 1}


def test_query_on_whole_table(spark, sf_dir):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = registry.op7_lines(spark, sf_dir).collect()
    assert {r.doc_id: r.n_lines for r in got} == {d: len(t.split("\n")) for d, t in docs.items()}
    # lines with equal normal forms stay at most once
    gone = {(r.doc_id, int(k)) for r in got for k in r.removed.split(",") if k}
    forms = [brute.normal_line(x) for d, t in docs.items() for k, x in enumerate(t.split("\n")) if (d, k) not in gone]
    assert len(gone) == sum(r.n_removed for r in got) > 0
    assert len([f for f in forms if f]) == len({f for f in forms if f})


def test_unlike_lines_of_a_bucket_make_no_pairs(spark, monkeypatch):
    """Lines that share a passage only: no table that is written, and no join, has a row for each pair of them."""
    rng = random.Random(15)
    end = _line(rng, 20)
    docs = [(i, f"{_line(rng, 22)} {end}") for i in range(150)]
    docs += [(1000 + i, f"{_edited(rng, docs[3 * i][1][:60], 2)}{docs[3 * i][1][60:]}") for i in range(30)]
    sizes, write = [], lines.keep

    def counted(df, name):
        out = write(df, name)
        sizes.append((out.count(), name))
        return out

    monkeypatch.setattr(lines, "keep", counted)
    got = _kept(lines.occurrences(spark.createDataFrame(docs, "doc_id bigint, text string").coalesce(1)))
    assert got == brute.kept_lines(docs, _keys(spark, _forms(docs))) and len(got) < 180
    assert max(sizes)[0] < 10 * len(docs), max(sizes)


def test_letter_counts_refuse_no_similar_pair(spark):
    rng = random.Random(16)
    pairs = [(a, _edited(rng, a, rng.randint(1, 8))) for a in (_line(rng, n) for n in (5, 12, 20) for _ in range(60))]
    pairs += [(_line(rng, 5), _line(rng, 5)) for _ in range(40)]
    df = spark.createDataFrame([(a, b, brute.edit_distance(a, b)) for a, b in pairs], "a string, b string, d int")
    both = [lines._letters(F.col(c)) for c in "ab"]
    got = df.select(lines._apart(*both, F.col("d")).alias("refused"), lines._apart(*both, F.lit(0)).alias("any"),
                    lines._similar(F.col("a"), F.col("b"), F.col("d")).alias("near"), lines._similar(F.col("a"), F.col("b"), F.col("d") - 1).alias("nearer")).collect()
    assert not any(r.refused for r in got) and any(r["any"] for r in got)
    assert all(r.near and not r.nearer for r in got)


def test_last_class_meets_only_what_is_apart(spark, monkeypatch):
    """Lines that differ by a word in the middle: each is compared once, not with both the first and the last class."""
    rng = random.Random(17)
    words = _line(rng, 50).split()
    docs = [(i, " ".join([*words[:25], f"{rng.choice('qwxz')}{chr(97 + i // 26)}{chr(97 + i % 26)}q", *words[25:]])) for i in range(40)]
    compared, linked = [], lines._linked

    def counted(pairs, *more):
        compared.append(pairs.count())
        return linked(pairs, *more)

    monkeypatch.setattr(lines, "_linked", counted)
    assert len(_kept(lines.occurrences(spark.createDataFrame(docs, "doc_id bigint, text string")))) == 1
    assert sum(compared) == 39, compared


def test_normal_forms(spark):
    """Against the plain regular expressions, with runs of every ASCII character that is neither letter nor digit."""
    rng = random.Random(18)
    chars = "".join(map(chr, range(128))) + "  \t\t  ,.-aZ09éßЖ字  "
    texts = ["".join(rng.choice(chars) for _ in range(rng.randint(0, 30))) for _ in range(2000)]
    texts += ["a" + "".join(rng.choice("  ,b1") for _ in range(rng.randint(0, 9))) for _ in range(500)]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", lines.normalised(F.col("t")).alias("n")).collect()
    assert all(r.n == brute.normal_line(r.t) for r in got)
