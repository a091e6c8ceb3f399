"""Secret scan: keyed patterns plus a randomness test battery, in SQL functions only.

Base kinds, each leftmost and non-overlapping: `assign` (a key word, a sign and
a value of 6 or more characters), `access` (AKIA..., 20 or more), `hex` (24 or
more lower-case hex digits).

The battery looks at the other runs of 20 or more characters of the base64
alphabets, with up to two '=' as padding; a '=' elsewhere ends a run, so that the
value after 'name=' is a run of its own. The encoding is inferred from the characters used: hex (16 symbols),
base32 (32) or base64 (64). Three tests ask whether the symbols could be random:
chi-squared uniformity over the alphabet (Wilson-Hilferty), the runs test on
the upper and lower half of the alphabet, and lag-1 serial correlation. A run
stays if none of them rejects at LEVEL / 3.

Passing proves little for a short run, so discoveries are controlled by length:
under the null hypothesis that a run of n symbols is ordinary text, drawn with
the symbol frequencies of the corpus outside its runs of 20 or more characters
(in the case and alphabet of the run's encoding), the uniformity statistic has
the mean and variance of a multinomial's sum of squares. Random runs have no
part in the frequencies, however many there are. A table of English letters
counts as PRIOR letters more, which decides only if there is next to no text.
Its lower tail is the run's p-value; short runs cannot reach a small one. The
Benjamini-Hochberg step over all candidates of the corpus keeps the false discovery rate
at FDR. Frequencies and ranks cover all rows; only the frequencies (64 numbers)
and a histogram of p-values (at most 30,001 bins) reach the driver.

Positions are code points, end exclusive. Defined cases: a null text is empty;
a text without findings has the hash of the empty string and empty spans;
repeated rows and null ids are reported each; extra columns are left alone; an
empty table gives no rows; texts are taken whole, as one string; runs with equal
p-values are accepted or refused together.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .staging import keep

# The three base patterns, and the least lengths of their matches.
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
ASSIGN_VALUE, ACCESS_LENGTH, HEX_LENGTH = 6, 20, 24

KINDS = ("assign", "access", "hex", "random")
RUN = r"[A-Za-z0-9+/_-]{20,}={0,2}"
LEVEL = 0.003
FDR = 0.01
ALPHABETS = {"hex": "0123456789abcdef", "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
             "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"}
#: Letters of English text, e to z by frequency a thousand; they count as PRIOR letters of the corpus.
ENGLISH = dict(zip("etaoinshrdlcumwfgypbvkjxqz", (127, 91, 82, 75, 70, 67, 63, 61, 60, 43, 40, 28, 28, 24, 24, 22, 20, 20, 19, 15, 10, 8, 2, 2, 1, 1), strict=True))
PRIOR = 1000
_SPAN = "array<struct<start:int,kind:int,end:int,run:string>>"


def _found(text: Column, pattern: str, flags: str, kind: int, least: int, group: int | None = None, with_run: bool = False) -> Column:
    """Spans of the matches of `pattern` whose match (or group) has `least` or more characters."""
    # every step of the lead-in consumes the text up to the next match, so lengths add up to positions
    lead = F.lit(f"(?s{flags})(.*?)(?:({pattern})|\\z)")
    part = lambda g: F.regexp_extract_all(text, lead, F.lit(g))
    steps = F.arrays_zip(F.transform(part(1), F.length).alias("before"), part(2).alias("match"), F.transform(part(2 + (group or 0)), F.length).alias("size"))

    def step(acc, x):
        start = acc["at"] + x["before"]
        end = start + F.length(x["match"])
        span = F.array(F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"), (x["match"] if with_run else F.lit(None).cast("string")).alias("run")))
        return F.struct(end.alias("at"), F.when(x["size"] >= least, F.concat(acc["out"], span)).otherwise(acc["out"]).alias("out"))

    none = F.array().cast(_SPAN)
    spans = F.aggregate(steps, F.struct(F.lit(0).alias("at"), none.alias("out")), step, lambda acc: acc["out"])
    return F.when(text.rlike(f"(?{flags or 's'}){pattern}"), spans).otherwise(none)


def _listed(spans: Column) -> Column:
    """kind:start:end by start, then kind."""
    name = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", name[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _phi(z: Column) -> Column:
    """Standard normal distribution function (Zelen and Severo's polynomial, error below 1e-7)."""
    t = 1 / (1 + 0.2316419 * F.abs(z))
    tail = F.exp(-z * z / 2) * 0.3989422804014327 * t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    return F.when(z > 0, 1 - tail).otherwise(tail)


def battery(runs: DataFrame) -> DataFrame:
    """`runs` (a column `run`) with encoding, k, n, symbols, chi2 and p_random, the least
    of the three tests' p-values times three; runs of no encoding are left out."""
    body = F.regexp_replace(F.translate("run", "-_", "+/"), "=+$", "")
    encoding = (F.when(body.rlike("^[0-9]*$"), None).when(body.rlike("^([0-9a-f]+|[0-9A-F]+)$"), "hex")
                .when(body.rlike("^[A-Z2-7]+$"), "base32").otherwise("base64"))
    alphabet = functools.reduce(lambda c, kv: c.when(F.col("encoding") == kv[0], kv[1]), ALPHABETS.items(), F.when(F.lit(False), ""))
    df = (runs.withColumn("encoding", encoding).where("encoding is not null")
          .withColumn("body", F.when(F.col("encoding") == "hex", F.lower(body)).otherwise(body)).withColumn("alphabet", alphabet)
          .withColumn("k", F.length("alphabet")).withColumn("n", F.length("body")).where("n > 2")
          .withColumn("symbols", F.expr("transform(split(body, '(?<=.)(?=.)'), c -> instr(alphabet, c) - 1)")))
    n, k, df_ = F.col("n").cast("double"), F.col("k"), F.col("k") - 1.0
    squares = F.expr("aggregate(transform(array_distinct(symbols), s -> size(filter(symbols, x -> x = s))), 0D, (a, m) -> a + m * 1D * m)")
    df = (df.withColumn("chi2", squares * k / n - n).withColumn("mean", F.expr("aggregate(symbols, 0D, (a, x) -> a + x) / n"))
          .withColumn("high", F.expr("size(filter(symbols, x -> 2 * x >= k))").cast("double"))
          .withColumn("turns", F.expr("aggregate(sequence(1, n - 1), 1D, (a, i) -> a + IF((2 * symbols[i] >= k) != (2 * symbols[i - 1] >= k), 1, 0))"))
          .withColumn("spread", F.expr("aggregate(symbols, 0D, (a, x) -> a + (x - mean) * (x - mean))"))
          .withColumn("lagged", F.expr("aggregate(sequence(1, n - 1), 0D, (a, i) -> a + (symbols[i] - mean) * (symbols[i - 1] - mean))")))
    z_chi = (F.pow(F.col("chi2") / df_, 1 / 3) - (1 - 2 / (9 * df_))) / F.sqrt(2 / (9 * df_))
    mu = 2 * F.col("high") * (n - F.col("high")) / n + 1
    var = (mu - 1) * (mu - 2) / (n - 1)
    z_runs = F.when(var > 0, (F.col("turns") - mu) / F.sqrt(var))
    z_serial = F.when(F.col("spread") > 0, (F.col("lagged") / F.col("spread") + 1 / (n - 1)) * F.sqrt(n - 1))
    # a run in one half of the alphabet, or of one symbol, is as far from random as can be
    two_sided = lambda z: F.coalesce(2 * (1 - _phi(F.abs(z))), F.lit(0.0))
    return df.withColumn("p_random", F.least(F.lit(1.0), 3 * F.least(1 - _phi(z_chi), two_sided(z_runs), two_sided(z_serial)))).drop(
        "alphabet", "body", "mean", "high", "turns", "spread", "lagged")


def letters(text: Column, docs: DataFrame) -> dict[str, int]:
    """How often each base64 symbol stands outside the runs of 20 or more characters of all rows."""
    # the rest of a text is made inside the generator, so that it is made once
    rest = docs.select(F.explode(F.array(F.translate(F.regexp_replace(text, RUN, " "), "-_", "+/"))).alias("rest"))
    absent = lambda c: F.octet_length("rest") - F.octet_length(F.replace("rest", F.lit(c), F.lit("")))
    got = rest.agg(*[F.sum(absent(c).cast("bigint")).alias(f"n{i}") for i, c in enumerate(ALPHABETS["base64"])]).first()
    return {c: got[i] or 0 for i, c in enumerate(ALPHABETS["base64"])}


def moments(counts: dict[str, int]) -> dict[str, tuple[float, float]]:
    """Sums of the squares and cubes of the symbols' shares in ordinary text, for each encoding."""
    total, out = sum(ENGLISH.values()), {}
    for encoding, alphabet in ALPHABETS.items():
        fold = {"hex": str.lower, "base32": str.upper}.get(encoding, str)
        m = dict.fromkeys(alphabet, 0.0)
        for part, scale in ((counts, 1.0), (ENGLISH, PRIOR / total)):
            for c, n in part.items():
                if fold(c) in m:
                    m[fold(c)] += n * scale
        shares = [x / sum(m.values()) for x in m.values()]
        out[encoding] = (sum(q**2 for q in shares), sum(q**3 for q in shares))
    return out


def discoveries(tested: DataFrame, ordinary: dict[str, tuple[float, float]], fdr: float = FDR, level: float = LEVEL) -> DataFrame:
    """Rows of a stored `battery` table that are random by the tests and found at the false
    discovery rate; `ordinary`: the `moments` of ordinary text."""
    of = lambda i: functools.reduce(lambda c, e: c.when(F.col("encoding") == e, ordinary[e][i]), ALPHABETS, F.when(F.lit(False), 0.0))
    n, k, s2, s3 = F.col("n").cast("double"), F.col("k"), F.col("s2"), F.col("s3")
    mean = k * (1 - s2) + n * (k * s2 - 1)
    # the sum of squares is n and twice the number of equal pairs, whose variance is known
    var = F.pow(k / n, 2) * 2 * n * (n - 1) * (2 * (n - 2) * F.greatest(s3 - s2 * s2, F.lit(0.0)) + s2 * (1 - s2))
    scored = tested.withColumn("s2", of(0)).withColumn("s3", of(1)).withColumn("z0", (F.col("chi2") - mean) / F.sqrt(var))
    # bins of 0.001 in z, from -30 to 0; the normal tail is monotonous, so ranks by z are ranks by p
    scored = scored.withColumn("bin", F.floor(F.greatest(F.least("z0", F.lit(0.0)), F.lit(-30.0)) * 1000).cast("int"))
    rank, best, total = 0, None, scored.count()
    for r in sorted(scored.groupBy("bin").agg(F.count(F.lit(1)).alias("m"), F.max(_tail("z0")).alias("p")).collect(), key=lambda r: r["bin"]):
        rank += r["m"]
        if r["p"] <= fdr * rank / total:
            best = r["bin"]
    found = scored.where(F.col("bin") <= best) if best is not None else scored.where(F.lit(False))
    return found.where(F.col("p_random") >= level)


def _tail(z: str) -> Column:
    """Lower normal tail, by its asymptotic bound where the polynomial is too coarse."""
    x = F.col(z)
    return F.when(x < -4, F.exp(-x * x / 2) / (-x * 2.5066282746310002)).otherwise(_phi(x))


def scan(docs: DataFrame, id_columns: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The id columns, `base` and `spans` (arrays of start, kind, end by start then kind) of every row."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    base = F.concat(_found(text, ASSIGN, "i", 0, ASSIGN_VALUE, 2), _found(text, ACCESS, "", 1, ACCESS_LENGTH), _found(text, f"{HEX[:-1]}{{{HEX_LENGTH},}}", "", 2, HEX_LENGTH))
    rows = docs.select(*id_columns, base.alias("base"), _found(text, RUN, "", 3, 20, with_run=True).alias("runs"))
    rows = rows.withColumn("runs", F.filter("runs", lambda r: ~F.exists("base", lambda b: (b["start"] < r["end"]) & (r["start"] < b["end"]))))
    rows = keep(rows.withColumn("rid", F.monotonically_increasing_id()), "scanned")
    tested = keep(battery(rows.select("rid", F.explode("runs").alias("r")).select("rid", "r.start", "r.end", "r.run")), "tested")
    random = (discoveries(tested, moments(letters(text, docs))).select("rid", F.struct("start", F.lit(3).alias("kind"), "end", F.lit(None).cast("string").alias("run")).alias("s"))
              .groupBy("rid").agg(F.collect_list("s").alias("random")))
    return rows.drop("runs").join(random, "rid", "left").select(
        *id_columns, F.array_sort("base").alias("base"), F.array_sort(F.concat("base", F.coalesce("random", F.array().cast(_SPAN)))).alias("spans"))


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_random of every row."""
    number = lambda spans, kind: F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")
    return scan(docs).select("doc_id", *[number("base", i).alias(f"n_{KINDS[i]}") for i in range(3)],
                             F.sha2(_listed(F.col("base")), 256).alias("base_sha256"), _listed(F.col("spans")).alias("spans"), number("spans", 3).alias("n_random"))


def redact(docs: DataFrame, mask: str = "[SECRET]") -> DataFrame:
    """`docs` with every span (overlapping ones as one) replaced by `mask`."""
    names = docs.columns
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))]).withColumn("text", F.col(f"c{names.index('text')}").cast("string"))
    found = scan(plain, tuple(plain.columns))
    step = lambda acc, s: F.struct(
        F.when(s["start"] >= acc["at"], F.concat(acc["out"], F.substr("text", acc["at"] + 1, s["start"] - acc["at"]), F.lit(mask))).otherwise(acc["out"]).alias("out"),
        F.greatest(acc["at"], s["end"]).alias("at"))
    whole = F.aggregate("spans", F.struct(F.lit("").alias("out"), F.lit(0).alias("at")), step, lambda acc: F.concat(acc["out"], F.substr("text", acc["at"] + 1)))
    cleaned = F.when(F.col("text").isNull(), None).otherwise(whole)
    return found.select(*[(cleaned if n == "text" else F.col(f"c{i}")).alias(f"c{i}") for i, n in enumerate(names)]).toDF(*names)
