import brute
import numpy as np
import pytest
from ledgerlens.llm import bloomlm, langid, quality, registry
from pyspark.sql import functions as F


def test_language_held_out(spark, sf_dir):
    docs = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = registry.op10_language(spark, sf_dir).collect()
    assert len(got) == len(docs) and all(r.held_out == (brute.fold(r.doc_id, 3) == 1) and 0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out]
    assert np.mean([docs[r.doc_id] == r.lang_pred for r in held]) > 0.97


def test_language_equals_plain_naive_bayes(spark):
    docs = [(i, t, lang) for i, (t, lang) in enumerate([("the cat and the dog", "en"), ("le chat et le chien", "fr"), ("Der Hund und die Katze!", "de"), ("this AND that", "en"), ("ça va très bien", "fr")])]
    model = langid.train(spark.createDataFrame(docs, "doc_id bigint, text string, lang string"))
    langs, tables = model.langs, langid._tables()

    def cells(text):
        return [c for _, _, found in langid._grams([text.encode()], tables) for bucket, _ in found for c in bucket.tolist()]

    counts = np.full((len(langs), langid.ORDERS * langid.BUCKETS), 0.5)
    for _, t, lang in docs:
        np.add.at(counts[langs.index(lang)], cells(t), 1)
    counts = counts.reshape(len(langs), langid.ORDERS, -1)
    logp = np.log(counts / counts.sum(axis=2, keepdims=True)).reshape(len(langs), -1)
    for text in ("the dog", "le chien", "die", "x", "été"):
        total = logp[:, cells(text)].sum(axis=1) + np.log(np.array([sum(x == k for _, _, x in docs) for k in langs]) / len(docs))
        names, scores, fit, size = langid._predict([text.encode()], tables, model)
        p = np.exp(total - total.max())
        assert names[0] == langs[total.argmax()] and abs(scores[0] - p.max() / p.sum()) < 1e-3
        assert size[0] == len(cells(text)) and abs(fit[0] - logp[total.argmax(), cells(text)].sum()) < 1e-2


def _cells_by_text(texts, tables):
    out = [[[] for _ in range(langid.ORDERS)] for _ in texts]
    for rows, _, found in langid._grams(texts, tables):
        for n, (bucket, of) in enumerate(found):
            for b, i in zip(bucket.tolist(), of.tolist(), strict=True):
                out[rows[i]][n].append(b)
    return out


def test_language_grams_do_not_depend_on_steps(monkeypatch):
    texts = [b"ab", "ñ 1 x".encode(), b"", None, b"c", ("Ünï " * 40 + "日本語テスト 🙂 " * 30).encode(), b"  --  ", b"x" * 333, "Wörter, 12 + ЖЗИ!".encode() * 9]
    tables = langid._tables()
    whole = [_cells_by_text([t], tables)[0] for t in texts]
    for step in (1, 2, 5, 64, 1 << 17):
        monkeypatch.setattr(langid, "STEP", max(step, 4))
        assert _cells_by_text(texts, tables) == whole
    assert whole[1] == _cells_by_text(["  Ñ--x".encode()], tables)[0] and whole[2] == whole[3] == _cells_by_text([b" - "], tables)[0]


def test_language_of_a_64_megabyte_text(spark):
    import tracemalloc
    docs = [(1, "the cat and the dog walk home", "en"), (2, "le chat et le chien rentrent", "fr")]
    model = langid.train(spark.createDataFrame(docs, "doc_id bigint, text string, lang string"))
    text, tables = b"The dog and the cat, " * (3 << 20), langid._tables()
    tracemalloc.start()
    names, scores, _, size = langid._predict([text], tables, model)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(text) > 60 << 20 and names[0] == "en" and scores[0] == 1.0 and size[0] > 180_000_000 and peak < 64 << 20


def test_texts_unlike_their_language_go(spark):
    rng = np.random.default_rng(5)
    en = "the of and to in is that was for on are with as his they be at one have this from by hot word but what some we can out other were all there when up use your how said an each she".split()
    fr = "le de un être et à il avoir ne je son que se qui ce dans en du elle au pour pas vous par sur faire plus dire me on mon lui nous comme mais pouvoir avec tout y aller voir bien".split()
    docs = [(i, " ".join(rng.choice(en if i % 2 else fr, rng.integers(5, 400)).tolist()), "en" if i % 2 else "fr", "k") for i in range(200)]
    odd = [(1000, "Все счастливые семьи похожи друг на друга, каждая несчастливая семья несчастлива по-своему. " * 3, None, "k"),
           (1001, "qzx wvkj xxqz zzkw jqxv kkzq wxvz qqjx " * 8, None, "k"), (1002, "中文句子没有空格但是有很多汉字" * 9, None, "k")]
    some = [(2000, " ".join(en), None, "k"), (2001, "Il voir bien tout y aller.", None, "k")]
    kept = {r.doc_id for r in langid.keep_identified(spark.createDataFrame(docs + odd + some, "doc_id bigint, text string, lang string, lang_pred string")).collect()}
    assert kept == {d[0] for d in docs + some}


def test_language_is_learned_from_every_text(spark):
    """More rows than the 20,000 of a language that were once taken as a sample: the counts are those of all."""
    docs = spark.range(45_000).selectExpr("id doc_id", "concat(char(97 + id % 26), char(97 + id % 23)) text", "'en' lang")
    every = langid.train(docs)
    n = np.exp(every.matrix[:langid.BUCKETS, 0].astype(float) + every.base[:langid.BUCKETS])
    # counts plus 0.5 in every bucket; a text has two letters and a space on each side
    assert abs(0.5 / n.min() - (45_000 * 4 + 0.5 * langid.BUCKETS)) < 1
    typical = langid._typical(docs, every)["en"]
    texts = [(chr(97 + i % 26) + chr(97 + i % 23)).encode() for i in range(45_000)]
    _, _, fit, size = langid._predict(texts, langid._tables(), every)
    assert abs(typical[0] - (fit / size).mean()) < 1e-4


def test_language_defined_cases(spark):
    rows = [(1, "hello there", "en", "k"), (2, None, "en", "k"), (3, "", "fr", "k"), (4, "123 !!", "fr", "k"), (5, "bonjour mes amis", "fr", "k"), (None, "hello", None, "k"), (6, "hi " * 50_000, None, "k"), (7, "x", " ", "k")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, lang_pred string")
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.report(df).collect()}
    assert got[2] == got[3] == got[4] == ("und", 0.0) and got[1][0] in ("en", "fr", "und")
    kept = langid.keep_identified(df)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} >= {1, 5} and not {2, 3, 4} & {r.doc_id for r in kept.collect()}
    none = df.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in langid.report(none).collect()} == {"und"}
    assert langid.keep_identified(none).count() == df.count()
    blank = df.withColumn("lang", F.lit(""))
    assert {r.lang_pred for r in langid.report(blank).collect()} == {"und", ""}
    assert {r.lang_pred for r in kept.collect()} == {"k"}
    assert langid.report(df.limit(0)).count() == 0
    with pytest.raises(ValueError, match="languages"):
        langid.train(spark.range(200).selectExpr("id doc_id", "'a' text", "cast(id as string) lang"))


def test_quality_held_out(spark):
    sf = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = registry.op5_quality(spark, sf).collect()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) and r.held_out == (brute.fold(r.doc_id, 5) == 0) for r in got)
    held = [(r.score, labels[r.doc_id]) for r in got if r.held_out and r.doc_id in labels]
    good, bad = [s for s, y in held if y == 1], [s for s, y in held if y == 0]
    auc = np.mean([(a > b) + 0.5 * (a == b) for a in good for b in bad])
    assert auc > 0.8 and np.mean(np.array(good) >= 0.3) > 0.97


def test_quality_votes_equal_plain_neighbours():
    rng = np.random.default_rng(3)
    texts = [rng.integers(97, 105 + 6 * (i % 2), 200).astype(np.uint8).tobytes() for i in range(60)]
    projection = rng.standard_normal((quality.FEATURES, 8)).astype(np.float32)
    known = quality._unit(rng.standard_normal((40, 8))).astype(np.float32)
    y = (np.arange(40) % 3 > 0).astype(float)
    got = quality._votes([*texts, None, b""], (projection, known, y), 5)
    for t, s in zip(texts, got, strict=False):
        v = quality._features([t])[0] @ projection
        c = known @ (v / np.linalg.norm(v))
        near = np.argsort(-c)[:5]
        w = np.maximum(c[near], 0)
        assert abs(s - (w @ y[near] / w.sum() if w.sum() else y.mean())) < 1e-4
    assert got[-1] == got[-2] == y.mean()


def test_quality_defined_cases(spark):
    docs = spark.createDataFrame([(i, t, 1.0) for i, t in [(1, "a fine text"), (2, None), (3, ""), (None, "no id"), (4, "x " * 50_000), (5, "!!! $$$"), (5, "!!! $$$")]], "doc_id bigint, text string, score double")
    labels = spark.createDataFrame([(1, 1, 0), (5, 0, 0), (5, 1, 0), (4, None, 0), (None, 1, 1), (77, 1, 0)], "doc_id bigint, quality int, toxic int")
    got = quality.report(docs, labels).collect()
    assert len(got) == 7 and all(0 <= r.score <= 1 for r in got)
    assert {r.score for r in quality.report(docs, labels.limit(0)).collect()} == {0.5}
    assert quality.report(docs.limit(0), labels).count() == 0


def _scores(df):
    return {r.doc_id: r for r in df.collect()}


def test_unigram_base_equals_brute_force(spark, sf_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    got, want = _scores(registry.op9_language_model(spark, sf_dir)), brute.unigrams(docs)
    for d, (tokens, known, total, base) in want.items():
        r = got[d]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (tokens, known, total) and abs(r.base_score - base) < 1e-7 * abs(base)
        assert r.held_out == (brute.fold(d, 7) == 2) and r.score <= 0
    held = [got[d] for d, _ in docs if got[d].held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_small_head_gives_the_same_base(spark, sf_dir):
    """Words outside the broadcast ones take the other way to their counts."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    want = _scores(bloomlm.report(docs))
    for d, r in _scores(bloomlm.report(docs, head=50, slice_tokens=5000)).items():
        assert (r.n_tokens, r.n_known) == (want[d].n_tokens, want[d].n_known) and abs(r.base_score - want[d].base_score) < 1e-7 * abs(r.base_score)


def test_filter_counts():
    rng = np.random.default_rng(4)
    h = rng.integers(0, 2**63, 20_000, dtype=np.uint64) * np.uint64(2)
    level = rng.integers(1, 9, len(h))
    f = bloomlm.Filter(1 << 22)
    for j in range(1, 9):
        f.insert(h[level >= j], j)
    want = np.ceil(bloomlm.MIN_COUNT * bloomlm.STEP ** (level - 1) - 1e-6)
    got = f.least_counts(h)
    assert (got >= want).all() and (got == want).mean() > 0.95
    other = rng.integers(0, 2**63, 20_000, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    assert (f.least_counts(other) > 0).mean() < 0.05


def test_built_filter_holds_the_counted_bigrams(spark, sf_dir):
    texts = spark.read.parquet(f"{sf_dir}/documents.parquet").select("text")
    counts = bloomlm.word_counts(texts)
    head = bloomlm._head(counts, 1 << 20)[:2]
    f = bloomlm.build_filter(bloomlm.bigram_levels(texts, head, 4))
    tokens, first = bloomlm._tokens([r.text.encode() for r in texts.collect()])
    h, _, usable = bloomlm._bigrams(tokens, first, bloomlm._lookup(head, tokens))
    seen, n = np.unique(h[usable], return_counts=True)
    level = 1 + np.floor(np.log(n / 2) / np.log(1.5) + 1e-9)
    got = f.least_counts(seen)
    assert (got[n >= 2] >= np.ceil(2 * 1.5 ** (level[n >= 2] - 1) - 1e-6)).all() and (got[n < 2] > 0).mean() < 0.1


def test_filter_in_parts_scores_as_the_whole_one(spark, sf_dir):
    """A filter many times larger than its bound is cut into parts; no level of a bigram is dropped."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(60)
    docs = docs.unionAll(docs.withColumn("doc_id", F.col("doc_id") + 10_000))
    counts = bloomlm.word_counts(docs.select("text"))
    parts = bloomlm.Filters(bloomlm.bigram_levels(docs.select("text"), bloomlm._head(counts, 1 << 20)[:2], 4), 1 << 16)
    assert len(parts) > 1
    want = _scores(bloomlm.report(docs))
    got = _scores(bloomlm.report(docs, filter_bits=1 << 16))
    assert got.keys() == want.keys()
    for d, r in got.items():
        assert (r.n_tokens, r.n_known) == (want[d].n_tokens, want[d].n_known)
        assert abs(r.score - want[d].score) < 1e-7 * abs(r.score) and abs(r.base_score - want[d].base_score) < 1e-7 * abs(r.base_score)


def test_weight_is_chosen_on_all_training_texts(spark, monkeypatch):
    """One long text of a set phrase outweighs many short ones of random words."""
    rng = np.random.default_rng(10)
    rows = [(i, " ".join(f"w{k}" for k in rng.integers(0, 300, 3))) for i in range(8000)] + [(8000, "x y z " * 50_000)]
    assert brute.fold(8000, 7) != 2
    seen, tune = {}, bloomlm._tune

    def spied(texts, shared, *more):
        seen["model"], seen["weight"] = shared.value, tune(texts, shared, *more)
        return seen["weight"]

    monkeypatch.setattr(bloomlm, "_tune", spied)
    bloomlm.report(spark.createDataFrame(rows, "doc_id bigint, text string")).count()
    m = bloomlm.Model(*seen["model"], 0.0)
    tokens, first = bloomlm._tokens([t.encode() for d, t in rows if brute.fold(d, 7) != 2])
    count = bloomlm._lookup(m.head, tokens)
    share, context = m.bigram(tokens, first, count, 1)
    p, share = m.unigram(np.maximum(count - 1, 0))[context], share[context]
    gain = [np.log((w * share + (1 - w) * p) / p).sum() for w in bloomlm._GRID]
    assert max(gain) > 0 and seen["weight"] == bloomlm._GRID[int(np.argmax(gain))]


def test_language_model_defined_cases(spark):
    rows = [(1, None), (2, ""), (3, "a b a b"), (None, "a b"), (4, "z " * 100_000), (3, "a b a b")]
    df = spark.createDataFrame([(d, t, 0.0) for d, t in rows], "doc_id bigint, text string, base double")
    got = bloomlm.report(df).collect()
    assert len(got) == 6 and {(r.doc_id, r.n_tokens) for r in got} == {(1, 1), (2, 1), (3, 5), (None, 3), (4, 100_001)}
    assert all(r.held_out for r in got if r.doc_id is None)
    assert bloomlm.report(df.limit(0)).count() == 0
    only_held = bloomlm.report(df.where("doc_id is null")).collect()
    assert [(r.n_known, r.train_tokens, r.base_score, r.score) for r in only_held] == [(0, 0, 0.0, 0.0)]


def test_scores_do_not_depend_on_the_head(spark, sf_dir):
    """Bigrams with words outside the broadcast ones count, gain and are tuned on as all others, also over parts of the filter."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(60)
    docs = docs.unionAll(docs.withColumn("doc_id", F.col("doc_id") + 10_000)).select("doc_id", "text")
    docs = docs.unionAll(spark.createDataFrame([(20_000, None), (None, "only here only here"), (20_001, "zq zq zq vj zq"), (20_001, "zq zq zq vj zq")], docs.schema))
    want = docs.select("doc_id", "text").exceptAll(docs.limit(0)).count()
    rows = lambda **k: sorted(((r.doc_id or -1, r.n_tokens, r.n_known, r.base_score, r.score) for r in bloomlm.report(docs, **k).collect()))
    whole = rows()
    assert len(whole) == want
    for k in ({"head": 50}, {"head": 0, "slice_tokens": 5000}, {"head": 200, "filter_bits": 1 << 16}):
        got = rows(**k)
        assert [r[:3] for r in got] == [r[:3] for r in whole]
        assert np.allclose([r[3:] for r in got], [r[3:] for r in whole], rtol=1e-9), k
    assert any(abs(r[4] - r[3]) > 1 for r in whole)
